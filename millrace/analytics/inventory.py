"""Stock per item and store from counts (snapshots) and later movements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.tables import grid, hot_keys, latest_by, salted_join
from millrace.scratch import materialise


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """Newest count per item and store; equal times fall back to the other columns."""
    return latest_by(snapshots, ["item_id", "store_id"], ["date_time"])


def countable_changes(changes: DataFrame, stores: DataFrame) -> DataFrame:
    """Movements of known stores, without pick-up-in-store records of the online shop."""
    known = stores.select("store_id", F.col("name").alias("_store_name"))
    return (
        changes.join(known, "store_id")
        .filter(~((F.col("_store_name") == "online") & (F.col("change_type") == "bopis")))
        .select("store_id", "item_id", "date_time", "quantity")
    )


def moved_since(changes: DataFrame, latest: DataFrame, how: str = "inner", max_rows: int = 5_000_000) -> DataFrame:
    """Movements since the count, summed per item and store.

    Where one item of a store has more than ``max_rows`` movements, these are
    summed per moment first and then dealt over several tasks for the join.
    """
    keys = ["item_id", "store_id"]
    counted = latest.select(*keys, F.col("date_time").alias("_counted_at"))
    hot = hot_keys(changes, keys, max_rows)
    amount, rows = F.sum("quantity").alias("quantity"), F.count("*").alias("_rows")
    steps = (changes.withColumn("_rows", F.lit(1)) if hot is None
             else changes.groupBy(*keys, "date_time").agg(amount, rows))
    return (
        salted_join(steps, counted, keys, how, hot, ["date_time"])
        .filter(F.col("_counted_at").isNull() | (F.col("date_time") >= F.col("_counted_at")))
        .groupBy(*keys)
        .agg(F.sum("quantity").alias("_moved"), F.max("date_time").alias("_moved_at"),
             F.sum("_rows").alias("_movements"))
    )


def _stock(rows: DataFrame) -> DataFrame:
    counted = F.coalesce("_counted", F.lit(0))
    moved = F.coalesce("_moved", F.lit(0))
    return rows.select(
        "store_id",
        "item_id",
        "name",
        counted.cast("bigint").alias("snapshot_quantity"),
        moved.cast("bigint").alias("change_quantity"),
        (counted + moved).cast("bigint").alias("current_inventory"),
        F.col("_counted_at").alias("last_inventory_date"),
        F.greatest("_counted_at", "_moved_at").alias("last_change_quantity_date"),
    )


def _never_counted(item: DataFrame, store: DataFrame, counts: DataFrame) -> DataFrame:
    """One row without a store for each item that some store never counted."""
    n_stores = store.agg(F.count("*")).scalar()
    seen = counts.groupBy("item_id").agg(F.count("*").alias("_seen"))
    kinds = dict(counts.dtypes)
    return (
        item.join(seen, "item_id", "left")
        .filter(F.coalesce("_seen", F.lit(0)) < n_stores)
        .select(
            "item_id",
            F.lit(None).cast(kinds["store_id"]).alias("store_id"),
            F.lit(None).cast(kinds["_counted"]).alias("_counted"),
            F.lit(None).cast(kinds["_counted_at"]).alias("_counted_at"),
            "name",
            F.lit(None).cast("bigint").alias("_moved"),
            F.lit(None).cast(kinds["_counted_at"]).alias("_moved_at"),
        )
    )


def current_stock(
    items: DataFrame,
    stores: DataFrame,
    snapshots: DataFrame,
    changes: DataFrame,
    mode: str = "reference",
) -> DataFrame:
    """Latest count plus the movements since.

    ``reference`` keeps the published result: all stores that never counted an
    item merge into one row whose store is NULL. That row only depends on how
    many stores counted the item, so no item x store product is formed.
    ``fixed`` returns one row for each item and store, and counts movements of
    stores without a snapshot too.
    """
    item = items.select("item_id", "name")
    store = stores.select("store_id").distinct()
    latest = (
        latest_snapshots(snapshots.select("item_id", "store_id", "date_time", "quantity"))
        .join(store, "store_id", "left_semi")
    )
    latest = materialise(latest, "latest-counts")  # one row per item and store, read three times
    counts = latest.select(
        "item_id", "store_id",
        F.col("quantity").alias("_counted"), F.col("date_time").alias("_counted_at"),
    )
    kept = countable_changes(changes, stores)

    if mode == "fixed":
        rows = (
            grid(item, store)
            .join(counts, ["item_id", "store_id"], "left")
            .join(moved_since(kept, latest, "left"), ["item_id", "store_id"], "left")
        )
        return _stock(rows)
    if mode != "reference":
        raise ValueError(f"unknown mode {mode}")

    counted = (
        counts.join(item, "item_id")
        .join(moved_since(kept, latest), ["item_id", "store_id"], "left")
        .drop("_movements")
    )
    return _stock(counted.unionByName(_never_counted(item, store, counts)))


def stock_of_balances(items: DataFrame, stores: DataFrame, balances: DataFrame, change_types: DataFrame | None = None,
                      mode: str = "reference") -> DataFrame:
    """The result of ``current_stock`` from kept balances: one row per item and store is read, and no movement.

    ``change_types`` names the kinds of movement, if the balances were kept by its id. Dimensions are applied here, so a store
    or kind that becomes known late counts with all its movements.
    """
    if mode not in ("reference", "fixed"):
        raise ValueError(f"unknown mode {mode}")
    keys = ["item_id", "store_id"]
    item, store = items.select("item_id", "name"), stores.select("store_id").distinct()
    rows = balances.join(stores.select("store_id", F.col("name").alias("_store_name")), "store_id")
    moves = rows.select(*keys, "_store_name", F.inline("moved"))
    if change_types is not None:
        named = change_types.select(F.col("change_type_id").cast("string").alias("kind"), "change_type")
        moves = moves.join(named, "kind").withColumn("kind", F.col("change_type"))
    moved = (
        moves.filter(~((F.col("_store_name") == "online") & (F.col("kind") == "bopis")))
        .groupBy(*keys)
        .agg(F.sum("quantity").alias("_moved"), F.timestamp_micros(F.max("at")).alias("_moved_at"))
    )
    counts = rows.filter("counted_at IS NOT NULL").select(
        *keys, F.col("counted").alias("_counted"), F.timestamp_micros("counted_at").alias("_counted_at"))
    if mode == "fixed":
        return _stock(grid(item, store).join(counts, keys, "left").join(moved, keys, "left"))
    counts = materialise(counts, "counts")  # read twice, one row per counted item and store
    counted = counts.join(item, "item_id").join(moved, keys, "left")
    return _stock(counted.unionByName(_never_counted(item, store, counts)))


def transaction_documents(changes: DataFrame, part_size: int = 10_000, tasks: int | None = None) -> DataFrame:
    """One document per transaction with its items as an array of structs, made in ``tasks`` parts if given.

    A transaction with more than ``part_size`` items is written as several
    numbered parts, so no array grows without bound.
    """
    key = ["trans_id"]
    rows = changes.withColumn("trans_id", F.expr("substring(trans_id, 2, length(trans_id) - 2)"))
    # counted by a hash first: it is shorter than an id, and mostly there is no large transaction
    digest = rows.select(F.xxhash64("trans_id").alias("_digest"))
    large = None if hot_keys(digest, ["_digest"], part_size) is None else hot_keys(rows, key, part_size)
    entries = F.sort_array(F.collect_list(F.struct("item_id", "quantity"))).alias("items")
    first = [F.min(c).alias(c) for c in ("date_time", "store_id", "change_type_id")]
    if large is None:  # rows go to their transaction once, and nothing is grouped before that, because most ids are rare
        dealt = rows.repartition("trans_id") if tasks is None else rows.repartition(tasks, "trans_id")
        whole = dealt.groupBy("trans_id").agg(*first, entries)
        return whole.select("trans_id", F.lit(0).alias("part"), "date_time", "store_id", "change_type_id", "items")
    # identical rows are first counted, so a repeated row is one entry however often it occurs
    counted = rows.groupBy("trans_id", "item_id", "quantity").agg(
        F.count("*").alias("_n"), *first)
    copies = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    # aim at half a part on average, so that no part outgrows the limit by the luck of the hash
    parts = F.coalesce(F.ceil(F.col("_n_items") * 2 / F.lit(part_size)), F.lit(1))
    deal = F.pmod(F.xxhash64("item_id", "quantity", "_copy"), parts).cast("int")
    parted = copies.join(large.withColumnRenamed("_n", "_n_items"), key, "left").withColumn("part", deal)
    return parted.groupBy("trans_id", "part").agg(*first, entries)


def item_rows(documents: DataFrame) -> DataFrame:
    """Back from transaction documents to one row per item."""
    return (
        documents.select("date_time", "trans_id", "store_id", "change_type_id",
                         F.explode("items").alias("_item"))
        .select("trans_id", "store_id", "date_time", "change_type_id",
                F.col("_item.item_id").alias("item_id"), F.col("_item.quantity").alias("quantity"))
    )
