"""Stock balances kept up to date by what changed.

Per key the state holds the newest count and, per moment and kind of movement since then, the moved quantity. A micro-batch touches the
state of its own keys only: a movement is added to its moment, a newer count replaces the older one and drops the moments before it,
an older count and a movement before the count change nothing. The order of arrival does not matter, so late counts and late
movements give what a run over everything would.

Rows are summed per key, moment and kind before they are shuffled, so a key with a third of all movements sends one row a moment and
input batch. The state of a key grows with the moments since its last count. It is a table in groups of keys: a micro-batch reads the groups
it touches, folds its rows into them in Spark, which spills what does not fit into memory, and writes them under its number, so a repeated
batch replaces itself. Of each group the newest two versions are kept. The number of groups is written when the balances are begun, and follows
the size of the first micro-batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace.operators.tables import latest_by
from millrace.scratch import shuffles_removed
from millrace.sources.files import exists, remove, sub_folders
from millrace.streaming.once import bucket_count
from millrace.streaming.runs import EachBatch, batch_dir, each_batch, write_batch

ROWS = ["key", "at", "is_count", "kind", "quantity", "n"]
KEPT = pa.schema([("key", pa.string()), ("at", pa.int64()), ("is_count", pa.bool_()), ("kind", pa.string()), ("quantity", pa.int64()), ("n", pa.int64())])
GROUPS = 16  # at least
GROUP_ROWS = 500_000  # rows of the first micro-batch for each group


def micros(at: str | Column) -> Column:
    return F.unix_micros((F.col(at) if isinstance(at, str) else at).cast("timestamp"))


def counts_and_movements(counts: DataFrame, movements: DataFrame, keys: Sequence[str], kind: str, at: str = "date_time",
                         quantity: str = "quantity") -> DataFrame:
    """One stream of both, in microseconds and whole quantities; rows without a time tell nothing and are left out."""
    none = F.lit(None)
    counted = counts.select(*keys, micros(at).alias("at"), F.coalesce(F.col(quantity), F.lit(0)).cast("bigint").alias("counted"),
                            none.cast("string").alias("kind"), none.cast("bigint").alias("moved"), none.cast("bigint").alias("n"))
    moved = movements.select(*keys, micros(at).alias("at"), none.cast("bigint").alias("counted"), F.col(kind).cast("string").alias("kind"),
                             F.coalesce(F.col(quantity), F.lit(0)).cast("bigint").alias("moved"), F.lit(1).cast("bigint").alias("n"))
    return counted.unionByName(moved).filter("at IS NOT NULL")


def partial_sums(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one key, moment and kind within an input batch as one row; of several counts of a moment the largest."""
    by, names = [*keys, "at", "kind", "is_count"], rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.append_column("is_count", table.column("counted").is_valid())
            done = table.group_by(by).aggregate([("counted", "max"), ("moved", "sum"), ("n", "sum")])
            done = done.rename_columns([c.removesuffix("_max").removesuffix("_sum") if c not in by else c for c in done.column_names])
            yield from done.select(names).cast(batch.schema).to_batches()

    return rows.mapInArrow(run, rows.schema)


def fold_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """What the state keeps of (key, at, is_count, kind, quantity, n): each key's newest count, and a row per moment and kind since then."""
    code, keys = pd.factorize(rows["key"])
    at, is_count = rows["at"].to_numpy(np.int64), rows["is_count"].to_numpy(bool)
    counts = pd.DataFrame({"code": code, "at": at, "quantity": rows["quantity"].to_numpy(np.int64)})[is_count]
    counts = counts.sort_values(["code", "at", "quantity"]).drop_duplicates("code", keep="last")
    since = np.full(len(keys), np.iinfo(np.int64).min)
    since[counts["code"]] = counts["at"]
    kept = ~is_count & (at >= since[code])
    moves = pd.DataFrame({"code": code, "at": at, "kind": rows["kind"], "quantity": rows["quantity"], "n": rows["n"]})[kept]
    moves = moves.groupby(["code", "at", "kind"], dropna=False, as_index=False)[["quantity", "n"]].sum()
    both = pd.concat([counts.assign(kind=None, n=0, is_count=True), moves.assign(is_count=False)], ignore_index=True)
    both["key"] = np.asarray(keys, object)[both["code"]]
    return both[["key", "at", "is_count", "kind", "quantity", "n"]]


def folded(state: tuple | None, rows: Iterable[tuple]) -> tuple:
    """The state of one key, (counted, counted_at, at, kind, moved, n), after some (at, counted, kind, moved, n); a count has no n."""
    counted, counted_at, *tail = state if state is not None else (None, None, [], [], [], [])
    before = [("", counted_at, True, None, counted, 0)] if counted_at is not None else []
    before += [("", a, False, k, m, n) for a, k, m, n in zip(*tail)]
    new = [("", at, True, None, quantity, 0) if n is None or n != n else ("", at, False, kind, moved, n) for at, quantity, kind, moved, n in rows]
    after = fold_rows(pd.DataFrame(before + new, columns=ROWS))
    count, moves = after[after["is_count"]], after[~after["is_count"]]
    newest = (int(count["quantity"].iloc[0]), int(count["at"].iloc[0])) if len(count) else (None, None)
    return (*newest, *(moves[c].tolist() for c in ("at", "kind", "quantity", "n")))


def balance_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """(key, counted, counted_at, moved) of folded rows; ``moved`` tells quantity, last moment and number of movements of each kind."""
    code, keys = pd.factorize(rows["key"])
    rows = rows.assign(code=code)
    out = np.full((len(keys), 4), None, object)  # objects, because a column of numbers with NULL would become floats
    out[:, 0] = keys
    counts, moves = rows[rows["is_count"]], rows[~rows["is_count"]]
    out[counts["code"], 1], out[counts["code"], 2] = counts["quantity"], counts["at"]
    sums = moves.groupby(["code", "kind"], dropna=False, as_index=False).agg({"quantity": "sum", "at": "max", "n": "sum"})
    moved: list[list[str]] = [[] for _ in keys]
    names = {k: json.dumps(k) for k in sums["kind"].dropna().unique()}
    for c, kind, quantity, last, n in zip(*(sums[x].tolist() for x in ("code", "kind", "quantity", "at", "n"))):
        moved[c].append(f'{{"kind":{names.get(kind, "null")},"quantity":{quantity},"at":{last},"n":{n}}}')
    out[:, 3] = [f"[{','.join(m)}]" for m in moved]
    return pd.DataFrame(out, columns=["key", "counted", "counted_at", "moved"], copy=False)


def to_bytes(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, KEPT, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, KEPT) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def newest_versions(spark: SparkSession, state: str, before: int) -> dict[str, str]:
    """The folder of each group's newest version from a micro-batch earlier than ``before``; versions older than those are removed."""
    found: dict[str, str] = {}
    if not exists(spark, state):
        return found
    for batch in sorted(int(f.split("=")[1]) for f in sub_folders(spark, state)):
        if batch >= before:
            break
        groups = sub_folders(spark, batch_dir(state, batch))
        if not groups:
            remove(spark, batch_dir(state, batch))
        for group in groups:
            if group in found:
                remove(spark, found[group])
            found[group] = f"{batch_dir(state, batch)}/{group}"
    return found


def folded_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What the state keeps of (grp, keys, at, is_count, kind, quantity, n): each key's newest count, and a row per moment and kind since then.

    ``_touched`` tells of all rows of a key whether one of them is ``_new``.
    """
    of_key = Window.partitionBy("grp", *keys)  # a group is in one task, and what follows needs no other exchange
    newest = F.max(F.when(F.col("is_count"), F.struct("at", "quantity"))).over(of_key)
    marked = rows.repartition("grp").select("*", newest.alias("_newest"), F.max("_new").over(of_key).alias("_touched"))
    since = F.when(F.col("is_count"), (F.col("at") == F.col("_newest.at")) & (F.col("quantity") == F.col("_newest.quantity")))
    kept = marked.filter(F.col("_newest").isNull() | since.otherwise(F.col("at") >= F.col("_newest.at")))
    counted, moved = F.max(F.when(F.col("is_count"), F.col("quantity"))), F.sum(F.when(~F.col("is_count"), F.col("quantity")))
    return kept.groupBy("grp", *keys, "at", "is_count", "kind").agg(
        F.coalesce(counted, moved).alias("quantity"), F.sum("n").alias("n"), F.max("_touched").alias("_touched"))


def balances_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, counted, counted_at, moved) of folded rows; ``moved`` tells quantity, last moment and number of movements of each kind."""
    sums = rows.groupBy("grp", *keys, "is_count", "kind").agg(F.sum("quantity").alias("quantity"), F.max("at").alias("at"), F.sum("n").alias("n"))
    of_count = lambda c: F.max(F.when(F.col("is_count"), F.col(c)))
    moved = F.collect_list(F.when(~F.col("is_count"), F.struct("kind", "quantity", "at", "n")))
    return sums.groupBy("grp", *keys).agg(of_count("quantity").alias("counted"), of_count("at").alias("counted_at"), moved.alias("moved")).drop("grp")


def fold(target: str, state: str, keys: Sequence[str], groups: int = GROUPS) -> EachBatch:
    """Fold a micro-batch of ``counts_and_movements`` into the state, and write the balances of the keys it touched."""
    keys = list(keys)

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        held = newest_versions(spark, f"{state}/rows", batch_id)
        wanted = groups if held else max(groups, df.count() // GROUP_ROWS)
        group = F.pmod(F.xxhash64(*keys), F.lit(bucket_count(spark, f"{state}/groups", wanted))).cast("int")
        new = partial_sums(df, keys).select(
            group.alias("grp"), *keys, "at", F.col("counted").isNotNull().alias("is_count"), "kind",
            F.coalesce("counted", "moved", F.lit(0)).cast("bigint").alias("quantity"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.lit(True).alias("_new"))
        if held:
            touched = {f"grp={r[0]}" for r in df.select(group).distinct().collect()}  # at most as many numbers as groups
            paths = [path for name, path in held.items() if name in touched]
            if paths:
                kind = T.StructType([f for f in new.schema if f.name != "_new"])
                past = spark.read.schema(kind).option("basePath", f"{state}/rows").parquet(*paths).select(*kind.names)
                new = new.unionByName(past.withColumn("_new", F.lit(False)))
        after = folded_rows(new, keys).persist()
        try:
            write_batch(after.drop("_touched"), f"{state}/rows", batch_id, ["grp"])
            write_batch(balances_of(after.filter("_touched"), keys), target, batch_id)
        finally:
            after.unpersist()

    return write


def follow(stream: DataFrame, keys: Sequence[str], target: str, checkpoint: str, groups: int = GROUPS) -> None:
    """Fold everything that has arrived into the balances; each micro-batch adds the balances of the keys it touched."""
    with shuffles_removed(stream.sparkSession):
        each_batch(stream, fold(target, f"{checkpoint}-state", keys, groups), checkpoint)


def current_balances(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The newest balance of every key."""
    return latest_by(spark.read.parquet(target), keys, ["batch_id"]).drop("batch_id")
