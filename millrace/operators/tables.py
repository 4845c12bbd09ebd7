"""Small keyed-table operators built on aggregates that combine before the shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.scratch import materialise
from millrace.session import task_count


def pack(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in cols])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    ``max_by`` merges map-side, so a key holding a third of all rows costs one
    row per input partition in the shuffle, unlike a ranking window.
    Ties beyond ``order`` are broken by the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    ranked = pack([*order, *rest])
    return (
        df.groupBy(*keys)
        .agg(F.max(ranked).alias("_row"))
        .select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key (``row_number() = 1``)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = pack([*order, *rest])
    return (
        df.groupBy(*keys)
        .agg(F.min(ranked).alias("_row"))
        .select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )


def earliest_new_by(df: DataFrame, past: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, of keys that ``past`` does not hold.

    Rows and past keys meet in one grouping, so the rows are shuffled and sorted once; NULL equals NULL.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    rows = df.select(*keys, pack([*order, *rest]).alias("_row"), F.lit(False).alias("_past"))
    known = past.select(*keys, F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(True).alias("_past"))
    return (
        rows.unionByName(known)
        .groupBy(*keys)
        .agg(F.min("_row").alias("_row"), F.max("_past").alias("_past"))
        .filter(~F.col("_past"))
        .select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on key columns in which NULL equals NULL, as it does in a grouping."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows and their count ``_n``, or None if there are none.

    One counting pass; if there are any, they are written (at most rows / max_rows
    entries), so the planner knows their size when they are joined.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows)
    return None if counted.isEmpty() else materialise(counted, "hot-keys")


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str, hot: DataFrame | None,
                spread: Sequence[str], salts: int | None = None) -> DataFrame:
    """``big`` joined to ``small`` (one row per key) with the rows of hot keys dealt over ``salts`` tasks (all, if not given).

    Only rows of hot keys get a salt, from a hash of the ``spread`` columns, and
    only their row of ``small`` is repeated. Without hot keys it is a plain join.
    """
    if hot is None:
        return keyed_join(big, small, keys, how)
    salts = salts or task_count(big.sparkSession)
    mark = hot.select(*keys, F.lit(True).alias("_hot"))
    deal = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    dealt = keyed_join(big, mark, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), deal).otherwise(F.lit(0))).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = keyed_join(small, mark, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return keyed_join(dealt, repeated, [*keys, "_salt"], how).drop("_salt")


def grid_blocks(left: DataFrame, right: DataFrame, spread: int) -> tuple[int, int]:
    """Shares of the left and of the right side of a product; each row is repeated for every share of the other."""
    few = lambda side: side.limit(spread + 1).count() <= spread
    if few(right):
        return spread * spread, 1
    return (1, spread * spread) if few(left) else (spread, spread)


def grid(left: DataFrame, right: DataFrame, spread: int | None = None) -> DataFrame:
    """Each row of one dimension paired with each row of another.

    The result is the product by definition. It is made by an equi join on a
    ``spread`` x ``spread`` block number: each block pairs one share of the left
    with one share of the right, so no side is ever held whole by a task, and
    the planner still broadcasts a side whose size it knows to be small. Unless
    given, there are four blocks per task of the session, so none stays idle.
    A side of up to ``spread`` rows goes whole to every block, and the rows of the other are not repeated.
    """
    a, b = grid_blocks(left, right, spread or max(8, math.ceil(math.sqrt(4 * task_count(left.sparkSession)))))
    lhs = (
        left.withColumn("_a", F.pmod(F.xxhash64(*left.columns), F.lit(a)).cast("int"))
        .withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
        .repartition(task_count(left.sparkSession), "_a", "_b")
    )
    rhs = (
        right.withColumn("_b", F.pmod(F.xxhash64(*right.columns), F.lit(b)).cast("int"))
        .withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(a - 1))))
    )
    return lhs.join(rhs, ["_a", "_b"]).drop("_a", "_b")
