"""Keyed change handling: delete, upsert, type 1 and 2 histories, change feeds, as-of reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.aggregates import neighbours
from millrace.operators.tables import hot_keys, keyed_join, latest_by, pack, salted_join

DELETE_FLAG = "_deleted"


def delete_where(df: DataFrame, predicate: str) -> DataFrame:
    """Remove rows for which the predicate is TRUE; rows where it is NULL stay."""
    return df.filter(~F.coalesce(F.expr(f"({predicate})"), F.lit(False)))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Source rows replace target rows of the same key; the newest by ``order`` wins within the source."""
    both = target.withColumn("_new", F.lit(0)).unionByName(
        source.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_by(both, keys, ["_new", *order]).drop("_new")


def _flag(changes: DataFrame, delete_when: str | None) -> DataFrame:
    flag = F.lit(False) if delete_when is None else F.coalesce(F.expr(f"({delete_when})"), F.lit(False))
    return changes.withColumn(DELETE_FLAG, flag)


def refuse_ties(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Raise at run time if two different rows of a key share a sequence value."""
    rest = [c for c in changes.columns if c not in keys and c not in sequence]
    if not rest:
        return changes.dropDuplicates([*keys, *sequence])
    tied = changes.groupBy(*keys, *sequence).agg(
        F.min(pack(rest)).alias("_lo"), F.max(pack(rest)).alias("_hi"))
    checked = tied.withColumn("_row", F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo"))
                              .otherwise(F.raise_error(F.lit("rows of one key share a sequence value"))))
    return checked.select(*[c if c in keys or c in sequence else F.col(f"_row.`{c}`").alias(c)
                            for c in changes.columns])


def newest_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str],
                   delete_when: str | None = None) -> DataFrame:
    """The newest change per key, deletes kept as tombstones so that late rows stay ignored."""
    return latest_by(_flag(changes, delete_when), keys, sequence)


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    delete_when: str | None = None,
    ignore_null_updates: bool = False,
    columns: Sequence[str] | None = None,
    on_tie: str = "largest",
) -> DataFrame:
    """Latest state per key. A key whose newest change is a delete is absent."""
    if on_tie == "error":
        changes = refuse_ties(changes, keys, sequence)
    if ignore_null_updates:
        state = _last_non_null(changes, keys, sequence, delete_when)
    else:
        state = newest_changes(changes, keys, sequence, delete_when).filter(~F.col(DELETE_FLAG)).drop(DELETE_FLAG)
    return state.select(*columns) if columns else state


def _last_non_null(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str],
                   delete_when: str | None, max_rows: int = 5_000_000) -> DataFrame:
    """Per column the last non-NULL value since the key's last delete."""
    at = pack(sequence)
    rows = _flag(changes, delete_when)
    gone = rows.filter(DELETE_FLAG).groupBy(*keys).agg(F.max(at).alias("_gone"))
    marked = salted_join(rows, gone, keys, "left", hot_keys(rows, keys, max_rows), sequence)
    alive = marked.filter(
        ~F.col(DELETE_FLAG) & (F.col("_gone").isNull() | (at > F.col("_gone"))))
    rest = [c for c in changes.columns if c not in keys and c not in sequence]
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in rest]
    out = alive.groupBy(*keys).agg(F.max(at).alias("_at"), *last)
    return out.select(*[c if c in keys or c in rest else F.col(f"_at.`{c}`").alias(c) for c in changes.columns])


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    delete_when: str | None = None,
    tracked: Sequence[str] | None = None,
    max_rows: int = 5_000_000,
    unique: bool = True,
) -> DataFrame:
    """Validity intervals per key.

    A version starts where a tracked column differs from the previous change or
    the previous change was a delete; it ends at the next version or delete.
    Untracked columns show the last change inside the version. Changes of a key
    that share a sequence value are reduced to the one with the largest values
    when ``unique`` is False.
    """
    if not unique:
        changes = latest_by(changes, [*keys, sequence], [])
    rest = [c for c in changes.columns if c not in keys and c != sequence]
    tracked = list(tracked) if tracked is not None else rest
    loose = [c for c in rest if c not in tracked]
    rows = _flag(changes, delete_when)
    rows = rows.select(*keys, sequence, DELETE_FLAG, pack(rest).alias("_now"))
    hot = hot_keys(rows, keys, max_rows)  # keys that are not hot here have no more edges than changes
    seen = neighbours(rows, keys, sequence, max_rows=max_rows, hot=hot,
                      previous={"_was": "_now", "_was_deleted": DELETE_FLAG})
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"_now.`{c}`").eqNullSafe(F.col(f"_was.`{c}`")) for c in tracked], F.lit(False))
    starts = F.col("_was_deleted").isNull() | F.col("_was_deleted") | differs
    edges = seen.filter(F.col(DELETE_FLAG) | starts)
    # the change just before the next edge is the last one inside this version
    closed = neighbours(edges, keys, sequence, max_rows=max_rows, hot=hot,
                        following={"__END_AT": sequence, "_until": "_was"})
    closed = closed.filter(~F.col(DELETE_FLAG))
    if loose:
        final = rows.groupBy(*keys).agg(F.max_by("_now", sequence).alias("_final"))
        closed = keyed_join(closed, final, keys)
        last = F.when(F.col("__END_AT").isNull(), F.col("_final")).otherwise(F.col("_until"))
    else:
        last = F.col("_now")
    values = [(last if c in loose else F.col("_now")).getField(c).alias(c) for c in rest]
    return closed.select(*keys, *values, F.col(sequence).alias("__START_AT"), "__END_AT")


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter("__END_AT is null")


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Rows of a validity-interval table that were open at ``moment``."""
    return history.filter((F.col("__START_AT") <= moment)
                          & (F.col("__END_AT").isNull() | (F.col("__END_AT") > moment)))


# ---- change feeds --------------------------------------------------------------------------

def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """What turns ``before`` into ``after``; each key occurs at most once on either side."""
    rest = [c for c in before.columns if c not in keys]
    a = before.select(*keys, pack(rest).alias("_a"))
    b = after.select(*[F.col(k).alias(f"_b_{k}") for k in keys], pack(rest).alias("_b"))
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    merged = [F.coalesce(F.col(k), F.col(f"_b_{k}")).alias(k) for k in keys]

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("_row"))

    events = (
        F.when(F.col("_a").isNull(), F.array(change("insert", "_b")))
        .when(F.col("_b").isNull(), F.array(change("delete", "_a")))
        .when(~F.col("_a").eqNullSafe(F.col("_b")),
              F.array(change("update_preimage", "_a"), change("update_postimage", "_b")))
    )
    return a.join(b, same, "full").select(*merged, F.inline(events)).select(
        *keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest],
        "_change_type", F.lit(version).cast("bigint").alias("_commit_version"))


def feed_changes(feed: DataFrame) -> DataFrame:
    """A feed without the rows that only describe the state before an update."""
    return feed.filter(F.lower("_change_type") != "update_preimage")


FEED_DELETE = "lower(_change_type) = 'delete'"


def apply_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after all changes of a feed."""
    base = target.withColumn("_change_type", F.lit("insert")).withColumn(
        "_commit_version", F.lit(-1).cast("bigint"))
    state = scd1(base.unionByName(feed_changes(feed)), keys, ["_commit_version"], FEED_DELETE)
    return state.select(*target.columns)


# ---- whole-table versions ------------------------------------------------------------------

def write_version(df: DataFrame, base: str, version: int) -> None:
    """A snapshot under its own directory; writing a version twice replaces it."""
    df.write.mode("overwrite").parquet(f"{base}/version={version}")


def read_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{base}/version={version}")


def version_history(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(base).groupBy("version").agg(F.count("*").alias("records"))


def restore(spark: SparkSession, base: str, version: int, as_version: int) -> None:
    """Make an old snapshot the newest one."""
    write_version(read_version(spark, base, version), base, as_version)
