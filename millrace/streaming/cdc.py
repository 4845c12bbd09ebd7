"""Type 1 and type 2 targets kept up to date from a stream.

Each micro-batch only writes what it touched, under its batch number, and the
current table is assembled on read. A repeated batch replaces itself, so the
targets are exactly-once without rewriting the whole table per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.changes import DELETE_FLAG, newest_changes, scd2
from millrace.operators.tables import keyed_join, latest_by
from millrace.streaming.runs import EachBatch, write_batch


def scd1_batches(base: str, keys: Sequence[str], sequence: Sequence[str],
                 delete_when: str | None = None, columns: Sequence[str] | None = None) -> EachBatch:
    """Write the batch's newest change per key; deletes stay as tombstones."""
    def write(df: DataFrame, batch_id: int) -> None:
        newest = newest_changes(df, keys, sequence, delete_when)
        if columns:
            newest = newest.select(*dict.fromkeys([*keys, *sequence, *columns, DELETE_FLAG]))
        write_batch(newest, base, batch_id)
    return write


def scd1_table(spark: SparkSession, base: str, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Newest change per key over all batches, without deleted keys."""
    rows = spark.read.parquet(base).drop("batch_id")
    return latest_by(rows, keys, sequence).filter(~F.col(DELETE_FLAG)).drop(DELETE_FLAG)


def compact_scd1(spark: SparkSession, base: str, keys: Sequence[str], sequence: Sequence[str], target: str) -> None:
    """Fold the batches into one file set; tombstones are kept so that late rows stay ignored."""
    rows = spark.read.parquet(base).drop("batch_id")
    write_batch(latest_by(rows, keys, sequence), target, -1)


def scd2_batches(log: str, versions: str, keys: Sequence[str], sequence: str, delete_when: str | None = None,
                 tracked: Sequence[str] | None = None, buckets: int = 16) -> EachBatch:
    """Append the batch to a change log, then recompute the histories of the keys it touched.

    Rows may arrive in any order, because a touched key is rebuilt from its whole
    log. The log is split by a hash of the key and only the touched buckets are read.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        # rebalancing gathers each bucket into few files and still splits a hot one
        split = df.withColumn("_bucket", bucket).hint("rebalance", "_bucket")
        write_batch(split, log, batch_id, ["_bucket"])
        rows = spark.read.parquet(log)
        touched = rows.filter(F.col("batch_id") == batch_id).select(*keys, "_bucket").distinct()
        used = [r[0] for r in touched.select("_bucket").distinct().collect()]  # at most ``buckets`` numbers
        touched = touched.drop("_bucket")
        past = rows.filter((F.col("batch_id") <= batch_id) & F.col("_bucket").isin(used)).drop("batch_id", "_bucket")
        past = keyed_join(past, touched, keys, "left_semi")
        built = scd2(past, keys, sequence, delete_when, tracked, unique=False)
        # a key whose history became empty still has to hide its older versions
        marked = keyed_join(touched, built, keys, "left")
        write_batch(marked, versions, batch_id)
    return write


def scd2_table(spark: SparkSession, versions: str, keys: Sequence[str]) -> DataFrame:
    """Per key the versions written by the newest batch that touched it."""
    rows = spark.read.parquet(versions)
    newest = rows.groupBy(*keys).agg(F.max("batch_id").alias("_newest"))
    return (
        keyed_join(rows, newest, keys).filter((F.col("batch_id") == F.col("_newest")) & F.col("__START_AT").isNotNull())
        .drop("batch_id", "_newest")
    )
