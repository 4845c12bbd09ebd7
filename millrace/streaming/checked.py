"""Rules counted while a micro-batch is written, and the log they leave.

The counts are observed in the pass that writes the rows: nothing is scanned again. Each batch adds one row per rule under its number, so a
repeated batch replaces its counts as it replaces its rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.operators.quality import passes, passes_all
from millrace.streaming.runs import EachBatch, write_batch

LOG = "name string, passed_records bigint, failed_records bigint, dropped_records bigint, output_records bigint"


def checked(dataset: str, sink: EachBatch, log: str, drop: Mapping[str, str] | None = None, warn: Mapping[str, str] | None = None) -> EachBatch:
    """``sink`` behind rules: rows failing one of ``drop`` do not reach it, failures of ``warn`` are only counted.

    ``sink`` runs one action on the rows it is given.
    """
    drop, warn = dict(drop or {}), dict(warn or {})
    rules = {**drop, **warn}

    def write(df: DataFrame, batch_id: int) -> None:
        seen = Observation()
        good = passes_all(drop) if drop else F.lit(True)
        counters = [F.count(F.lit(1)).alias("rows"), F.count(F.when(good, 1)).alias("good")]
        observed = df.observe(seen, *counters, *[F.count(F.when(passes(p), 1)).alias(f"rule_{i}") for i, p in enumerate(rules.values())])
        sink(observed.filter(good) if drop else observed, batch_id)
        found = seen.get
        rows = [(name, found[f"rule_{i}"], found["rows"] - found[f"rule_{i}"], found["rows"] - found["good"], found["good"]) for i, name in enumerate(rules)]
        write_batch(df.sparkSession.createDataFrame(rows, LOG).coalesce(1), f"{log}/dataset={dataset}", batch_id)

    return write


def rule_log(spark: SparkSession, log: str) -> DataFrame:
    """One row per dataset, batch and rule."""
    rows = spark.read.option("basePath", log).parquet(log)
    return rows.select(F.col("dataset").cast("string").alias("dataset"), F.col("batch_id").cast("bigint").alias("batch_id"), *[f.split()[0] for f in LOG.split(", ")])


def rule_totals(spark: SparkSession, log: str) -> DataFrame:
    """The counts of all batches."""
    sums = [F.sum(c).alias(c) for c in ("passed_records", "failed_records", "dropped_records", "output_records")]
    return rule_log(spark, log).groupBy("dataset", "name").agg(*sums)


def progress_events(spark: SparkSession, log: str) -> DataFrame:
    """The same as progress records of an event log, one per dataset and batch, as ``quality.log_metrics`` reads them."""
    rule = F.struct("dataset", "name", "passed_records", "failed_records")
    each = rule_log(spark, log).groupBy("dataset", "batch_id").agg(
        F.sort_array(F.collect_list(rule)).alias("expectations"), F.max("dropped_records").alias("dropped_records"), F.max("output_records").alias("num_output_rows"))
    progress = F.struct(F.lit("COMPLETED").alias("status"), F.struct("num_output_rows").alias("metrics"),
                        F.struct("dropped_records", "expectations").alias("data_quality"))
    return each.select(F.concat_ws("-", "dataset", "batch_id").alias("id"), F.lit(None).cast("timestamp").alias("timestamp"),
                       F.to_json(F.struct(progress.alias("flow_progress"))).alias("details"))
