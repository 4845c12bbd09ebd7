"""Row-quality rules: named predicates, actions on failing rows, and metrics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

Rules = Mapping[str, str]


def passes(predicate: str) -> Column:
    """A row passes only when the predicate is TRUE; NULL counts as failed."""
    return F.coalesce(F.expr(f"({predicate})"), F.lit(False))


def passes_all(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, (passes(p) for p in rules.values()))


def drop_failing(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that pass every rule."""
    return df.filter(passes_all(rules))


def quarantine(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(passing rows, failing rows with the names of the rules they broke)."""
    broken = F.array_compact(F.array(*[F.when(~passes(p), F.lit(n)) for n, p in rules.items()]))
    return drop_failing(df, rules), df.filter(~passes_all(rules)).withColumn("broken_rules", broken)


def _counters(rules: Rules) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("input_records"),
            F.count(F.when(passes_all(rules), 1)).alias("passing_records")]
    return cols + [F.count(F.when(passes(p), 1)).alias(f"rule_{i}") for i, p in enumerate(rules.values())]


def rule_metrics(df: DataFrame, dataset: str, rules: Rules, action: str = "warn") -> DataFrame:
    """One row per rule, all rules counted in one pass over the table."""
    return _long(df.agg(*_counters(rules)), dataset, rules, action)


def _long(counted: DataFrame, dataset: str, rules: Rules, action: str) -> DataFrame:
    failing = F.col("input_records") - F.col("passing_records")
    dropped = failing if action == "drop" else F.lit(0).cast("bigint")
    each = F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"rule_{i}").alias("passed_records"))
        for i, n in enumerate(rules)
    ])
    return counted.select("input_records", dropped.alias("dropped_records"), F.inline(each)).select(
        F.lit(dataset).alias("dataset"), "name", "passed_records",
        (F.col("input_records") - F.col("passed_records")).alias("failed_records"),
        "dropped_records", (F.col("input_records") - F.col("dropped_records")).alias("output_records"))


def write_checked(df: DataFrame, dataset: str, rules: Rules, path: str, action: str = "warn") -> DataFrame:
    """Write the table and return its rule metrics, counted while it was written."""
    seen = Observation(f"rules-{dataset}")
    observed = df.observe(seen, *_counters(rules))
    (drop_failing(observed, rules) if action == "drop" else observed).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    counted = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in seen.get.items()])
    return _long(counted, dataset, rules, action)


def quality_totals(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("dataset").agg(
        F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))


def row_count_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side and whether they agree."""
    parts = [df.select(F.lit(n).alias("t")) for n, df in tables.items()]
    counted = reduce(DataFrame.unionAll, parts).groupBy("t").agg(F.count("*").alias("n"))
    side = counted.agg(*[
        F.coalesce(F.max(F.when(F.col("t") == n, F.col("n"))), F.lit(0)).alias(f"{n}_rows") for n in tables
    ])
    names = [F.col(f"{n}_rows") for n in tables]
    same = reduce(lambda a, b: a & b, (names[0] == c for c in names[1:]))
    return side.withColumn("same_count", same)


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values (approximate by default), min and max as text."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(names):
        aggs += [F.count(F.col(c)).alias(f"n{i}"), distinct(F.col(c)).alias(f"d{i}"),
                 F.min(F.col(c)).cast("string").alias(f"lo{i}"), F.max(F.col(c)).cast("string").alias(f"hi{i}")]
    each = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("records"),
                 (F.col("_rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct_values"),
                 F.col(f"lo{i}").alias("lowest"), F.col(f"hi{i}").alias("highest"))
        for i, c in enumerate(names)
    ])
    return df.agg(*aggs).select(F.inline(each))


# ---- a job's event log ---------------------------------------------------------------------

def lineage(log: DataFrame) -> DataFrame:
    """Output, inputs and flow type of each defined dataset, oldest first."""
    path = "$.flow_definition."
    return (
        log.select(
            "id", "timestamp",
            F.get_json_object("details", path + "output_dataset").alias("output_dataset"),
            F.get_json_object("details", path + "input_datasets").alias("input_datasets"),
            F.get_json_object("details", path + "flow_type").alias("flow_type"))
        .filter(F.col("output_dataset").isNotNull())
        .orderBy("timestamp", "id")
    )


PROGRESS = """struct<flow_progress: struct<
    status: string,
    metrics: struct<num_output_rows: bigint>,
    data_quality: struct<
        dropped_records: bigint,
        expectations: array<struct<dataset: string, name: string,
                                   passed_records: bigint, failed_records: bigint>>>>>"""


def log_metrics(log: DataFrame) -> DataFrame:
    """Long metrics table (one row per rule) from progress records of an event log."""
    parsed = log.withColumn("p", F.from_json("details", PROGRESS).getField("flow_progress"))
    return (
        parsed.filter(F.col("p.metrics.num_output_rows").isNotNull())
        .select("id", "timestamp", F.col("p.status").alias("status_update"),
                F.col("p.metrics.num_output_rows").alias("output_records"),
                F.col("p.data_quality.dropped_records").alias("dropped_records"),
                F.inline("p.data_quality.expectations"))
        .select("id", "dataset", "name", "passed_records", "failed_records", "status_update",
                "dropped_records", "output_records", "timestamp")
    )
