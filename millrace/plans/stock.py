"""Inventory: dimension files, counts and movement documents to current stock.

Each run reads what is new: documents become movement rows, each kept once however late it comes; counts and movements are folded into
the balances of the items and stores they touch; the stock is read from the balances.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.analytics import inventory
from millrace.operators import quality
from millrace.scratch import scratch_path, shuffles_removed
from millrace.streaming import balances, once, runs

DOCUMENT_SCHEMA = ("trans_id string, date_time timestamp, store_id int, change_type_id bigint, "
                   "items array<struct<item_id: bigint, quantity: int>>")
SNAPSHOT_SCHEMA = "item_id bigint, store_id int, date_time timestamp, quantity int"
CHANGE_SCHEMA = "trans_id string, store_id int, date_time timestamp, change_type_id bigint, item_id bigint, quantity int"
KEYS = ["item_id", "store_id"]


STOCK_RULES = {"positive_stock": "current_inventory > 0"}


class Stock:
    def __init__(self, spark: SparkSession, items: str, stores: str, change_types: str, snapshots: str, documents: str):
        self.spark = spark
        self.sources = {"item": items, "store": stores, "change_type": change_types}
        self.snapshot_files, self.document_files = snapshots, documents
        self.base = scratch_path(spark, "stock")

    def run(self) -> None:
        """Take in what has arrived; shuffle files of a step go when it has written."""
        with shuffles_removed(self.spark):
            self._run()

    def _run(self) -> None:
        spark, base = self.spark, self.base
        cp = f"{base}/checkpoints"
        schemas = {"item": "item_id bigint, name string", "store": "store_id int, name string",
                   "change_type": "change_type_id bigint, change_type string"}
        for name, path in self.sources.items():
            runs.land(runs.new_files(spark, path, "csv", schemas[name], header=True), f"{base}/{name}", f"{cp}/{name}")
        counts = runs.new_files(spark, self.snapshot_files, "csv", SNAPSHOT_SCHEMA, header=True)
        runs.each_batch(counts, runs.history_and_latest(
            f"{base}/history", f"{base}/latest", KEYS, ["date_time"]), f"{cp}/snapshots")
        documents = runs.new_files(spark, self.document_files, "json", DOCUMENT_SCHEMA)
        runs.each_batch(inventory.item_rows(documents), once.keep_first(
            f"{base}/changes", f"{base}/index", ["trans_id", "item_id"], "date_time"), f"{cp}/changes")
        both = balances.counts_and_movements(
            runs.new_files(spark, f"{base}/history/*", "parquet", SNAPSHOT_SCHEMA),
            runs.new_files(spark, f"{base}/changes/*", "parquet", CHANGE_SCHEMA), KEYS, "change_type_id")
        balances.follow(both, KEYS, f"{base}/balances", f"{cp}/balances")

    def arrivals(self) -> DataFrame:
        """Per batch of documents: rows that arrived, were kept or were repeats, and how late some were."""
        return once.report(self.spark, f"{self.base}/index")

    def metrics(self, mode: str = "reference") -> DataFrame:
        """How many rows of the current stock are positive; the others are reported and kept."""
        return quality.rule_metrics(self.current(mode), "current_stock", STOCK_RULES)

    def current(self, mode: str = "reference") -> DataFrame:
        """Stock from the balances; the movements are not read again."""
        read = lambda n: self.spark.read.parquet(f"{self.base}/{n}")
        kept = balances.current_balances(self.spark, f"{self.base}/balances", KEYS)
        return inventory.stock_of_balances(read("item"), read("store"), kept, read("change_type"), mode)
