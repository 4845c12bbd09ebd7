"""Users and their spend: raw files, anonymised users, joined features, scored segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.analytics.segments import nearest_centre
from millrace.functions.clean import anonymise_users
from millrace.operators import quality
from millrace.plans.airline import RAW_RULES, READABLE
from millrace.scratch import scratch_path
from millrace.sources.files import RESCUED, rescue_columns, rescue_json
from millrace.streaming import checked, runs

FEATURES = ["age", "annual_income", "spending_core"]
ID_RULES = {"valid_id": "id is not null"}
FEATURE_RULES = {f"valid_{c}": f"{c} is not null" for c in FEATURES}


def user_features(users: DataFrame, spend: DataFrame) -> DataFrame:
    """Users left-joined to their spend; rows without all features are dropped."""
    return quality.drop_failing(users.join(spend, ["id"], "left"), FEATURE_RULES)


def score_users(features: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Batch or streaming inference with a fitted model's centres."""
    return features.withColumn("segment", nearest_centre(centres)(*[F.col(c).cast("double") for c in FEATURES]))


class Users:
    """Paths of one deployment; ``run`` takes in whatever files arrived since the last call.

    Fields and values that do not fit the schema are kept in a side column and counted, at every hop in the pass that writes it.
    """

    def __init__(self, spark: SparkSession, users: str, users_schema: T.StructType, spend: str, spend_schema: T.StructType,
                 centres: Sequence[Sequence[float]]):
        self.spark, self.users, self.users_schema, self.spend, self.spend_schema, self.centres = spark, users, users_schema, spend, spend_schema, centres
        self.base = scratch_path(spark, "users")
        self.rules = f"{self.base}/rules"

    def run(self) -> None:
        spark, base, cp = self.spark, self.base, f"{self.base}/checkpoints"
        follow = lambda name, schema: runs.new_files(spark, f"{base}/{name}/*", "parquet", schema)
        kept = lambda name, *rules: checked.checked(name, runs.batch_log(f"{base}/{name}"), self.rules, *rules)
        lines = rescue_json(spark.readStream.text(self.users), self.users_schema)
        runs.each_batch(lines, kept("users_raw", READABLE, RAW_RULES), f"{cp}/users_raw")
        raw = follow("users_raw", T.StructType([*self.users_schema.fields, T.StructField(RESCUED, T.StringType())]))
        runs.each_batch(anonymise_users(raw).drop(RESCUED), kept("users_silver", None, ID_RULES), f"{cp}/users_silver")
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in self.spend_schema.fields])
        spend = rescue_columns(runs.new_files(spark, self.spend, "csv", texts, header=True), self.spend_schema)
        runs.each_batch(spend, kept("spend", None, RAW_RULES), f"{cp}/spend")
        silver = follow("users_silver", spark.read.parquet(f"{base}/users_silver").drop("batch_id").schema)
        joined = silver.join(spark.read.parquet(f"{base}/spend").drop("batch_id", RESCUED), ["id"], "left")
        score = lambda df, k: runs.write_batch(score_users(df, self.centres), f"{base}/users", k)
        runs.each_batch(joined, checked.checked("users", score, self.rules, FEATURE_RULES), f"{cp}/users")

    def gold(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/users").drop("batch_id")

    def metrics(self) -> DataFrame:
        return checked.rule_totals(self.spark, self.rules)
