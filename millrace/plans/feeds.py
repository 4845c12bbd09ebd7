"""Table changes read as a stream and applied to type 1 and type 2 targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.changes import FEED_DELETE, feed_changes
from millrace.scratch import scratch_path
from millrace.streaming import cdc, histories, runs


class FeedTargets:
    def __init__(self, spark: SparkSession, feed: str, keys: Sequence[str], tracked: Sequence[str] | None = None):
        self.spark, self.feed, self.keys, self.tracked = spark, feed, list(keys), tracked
        self.base = scratch_path(spark, "feed")
        self._history = histories.History(spark, f"{self.base}/history", self.keys, "_commit_version", FEED_DELETE, tracked)

    def run(self) -> None:
        cp = f"{self.base}/checkpoints"
        changes = feed_changes(runs.table_stream(self.spark, self.feed))
        runs.each_batch(changes, cdc.scd1_batches(
            f"{self.base}/scd1", self.keys, ["_commit_version"], FEED_DELETE), f"{cp}/scd1")
        self._history.follow(changes)

    def latest(self) -> DataFrame:
        return cdc.scd1_table(self.spark, f"{self.base}/scd1", self.keys, ["_commit_version"]).drop("_change_type", "_commit_version")

    def history(self) -> DataFrame:
        return self._history.table().drop("_change_type")
