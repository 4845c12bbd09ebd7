"""Every key once, however late, however often and in whatever order its rows arrive.

A watermark forgets: a row below it is dropped, or counted twice. Here the keys of all rows that were kept form an index, a table of key
columns alone in buckets by a hash of the key. A micro-batch is reduced to one row per key, and its keys are looked up in the buckets it
touches. The first batch is the load of the history and meets no index, so it is one plain grouping; later batches read the index's key
columns of the buckets they touch, and never the rows.

Rows, keys and the report of a batch are written under its number, so a repeated batch replaces itself. Rows whose keys hold a NULL are
compared like others, NULL being equal to NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.operators.tables import earliest_by, earliest_new_by
from millrace.sources.files import exists
from millrace.streaming.runs import EachBatch, batch_dir, write_batch

BUCKETS = 64
REPORT = "batch_id bigint, arrived bigint, kept bigint, repeated bigint, below_watermark bigint, newest timestamp"


def bucket_count(spark: SparkSession, base: str, wanted: int) -> int:
    """The number of buckets the index was begun with; it is written with the index, so that no later run can take another."""
    layout = f"{base}/layout"
    if not exists(spark, layout):
        spark.range(1).select(F.lit(wanted).alias("buckets")).write.mode("overwrite").parquet(layout)
    return spark.read.schema("buckets int").parquet(layout).first()["buckets"]


def keep_first(target: str, index: str, keys: Sequence[str], event_time: str, delay: str = "1 hour", buckets: int = BUCKETS) -> EachBatch:
    """Append each key's earliest row of the batch that brings the key first; later ones of the key are repeats.

    ``delay`` drops nothing: the report counts the rows a watermark of that delay would have lost.
    """
    keys = list(keys)

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        n = bucket_count(spark, index, buckets)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
        known = f"{index}/keys"
        at = F.col(event_time).cast("timestamp")
        reported = report(spark, index).filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        counts = [F.count(F.lit(1)).alias("arrived"), F.max(F.unix_micros(at)).alias("newest")]
        if reported:
            counts.append(F.count(F.when(at < F.lit(reported).cast("timestamp") - F.expr(f"INTERVAL {delay}"), 1)).alias("below_watermark"))
        seen = Observation()  # counted while the rows are written, so that the batch need not be kept
        rows = df.observe(seen, *counts)
        if exists(spark, known):
            touched = [r[0] for r in df.select(bucket.alias("b")).distinct().collect()]  # at most n numbers
            past = spark.read.parquet(known).filter((F.col("batch_id") < batch_id) & F.col("_bucket").isin(touched)).select(*keys)
            first = earliest_new_by(rows, past, keys, [event_time])
        else:
            first = earliest_by(rows, keys, [event_time])
        write_batch(first, target, batch_id)
        kept = spark.read.schema(df.schema).parquet(batch_dir(target, batch_id))
        write_batch(kept.select(*keys, bucket.alias("_bucket")), known, batch_id, ["_bucket"])
        found, n_kept = seen.get, kept.count()
        told = {"arrived": found["arrived"], "kept": n_kept, "repeated": found["arrived"] - n_kept, "below_watermark": found.get("below_watermark", 0)}
        row = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in told.items()],
                                    F.timestamp_micros(F.lit(found["newest"]).cast("bigint")).alias("newest"))
        write_batch(row, f"{index}/report", batch_id)

    return write


def report(spark: SparkSession, index: str) -> DataFrame:
    """One row per batch: rows that arrived, were kept and were repeats, and those a watermark would have dropped."""
    path = f"{index}/report"
    rows = spark.read.schema(REPORT).parquet(path) if exists(spark, path) else spark.createDataFrame([], REPORT)
    return rows.select("batch_id", "arrived", "kept", "repeated", "below_watermark", "newest")


def kept_rows(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch_id")
