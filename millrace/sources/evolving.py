"""Incremental files whose fields grow: nothing that arrives is lost, and the schema follows.

The schema is a list of versions in a table of its own. A batch is parsed with the newest one; fields it does not know, and values that do not
fit, stay as JSON text in ``_rescued_data``. Fields found there become the next version, with the narrowest type that all their values
have, and later batches carry them as columns. Rows from before are filled from their rescued text when the table is read, so they need
not be written again.

Batches, versions and texts are written under the batch's number: a repeated batch replaces itself.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.sources.files import CORRUPT, RESCUED, exists, rescue_columns, rescue_json
from millrace.streaming.runs import each_batch, write_batch

# tried in this order, by the cast and the form of the text (a cast alone takes t for true and drops the time of a day); text if none fits
KINDS = {"bigint": r"^[+-]?\d+$", "double": r"\d", "date": r"^\d{4}-\d\d-\d\d$", "timestamp": r"^\d{4}-\d\d-\d\d[ T]", "boolean": r"^(?i:true|false)$"}
MOST_FIELDS = 10_000  # new fields of one batch; more are an error and not a schema


class Evolving:
    """A table fed from a folder of JSON lines or headed CSV files."""

    def __init__(self, spark: SparkSession, source: str, fmt: str, base: str, first: str | T.StructType, max_files: int = 1000):
        if fmt not in ("json", "csv"):
            raise ValueError(f"no evolving source for {fmt}")
        self.spark, self.source, self.fmt, self.base, self.max_files = spark, source, fmt, base, max_files
        self.first = T.StructType.fromDDL(first) if isinstance(first, str) else first

    # ---- versions ------------------------------------------------------------------------------

    def versions(self) -> list[tuple[int, T.StructType]]:
        """(batch that found it, schema), oldest first; the first stands before all batches."""
        found = [(-1, self.first)]
        if exists(self.spark, f"{self.base}/schemas"):
            rows = self.spark.read.schema("batch_id bigint, schema string").parquet(f"{self.base}/schemas").collect()  # one a version
            found += [(r.batch_id, T.StructType.fromJson(json.loads(r.schema))) for r in sorted(rows, key=lambda r: r.batch_id)]
        return found

    def schema(self, before: int | None = None) -> T.StructType:
        """The newest schema, or the one that a batch was parsed with."""
        return [s for b, s in self.versions() if before is None or b < before][-1]

    # ---- ingest --------------------------------------------------------------------------------

    def run(self) -> None:
        """Take in the files that arrived since the last run."""
        reader = self.spark.readStream.option("maxFilesPerTrigger", self.max_files)
        if self.fmt == "json":
            each_batch(reader.text(self.source), self._lines, f"{self.base}/checkpoint")
        else:
            found = reader.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").load(self.source).select("path")  # the contents are not read here
            each_batch(found, self._files, f"{self.base}/checkpoint")

    def _lines(self, df: DataFrame, batch_id: int) -> None:
        self._store(rescue_json(df.select("value"), self.schema(batch_id)), batch_id)

    def _files(self, df: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in df.collect()]  # max_files at most
        if not paths:
            return
        # files of one header are read together, by name and not by place
        lines = self.spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        heads = (lines.filter("start = 0").withColumn("n", F.monotonically_increasing_id())
                 .groupBy("file").agg(F.min_by("value", "n").alias("head")))
        by_head: dict[str, list[str]] = {}
        for r in heads.collect():  # one a file
            by_head.setdefault(r.head, []).append(r.file)
        schema, parts = self.schema(batch_id), []
        for _, files in sorted(by_head.items()):
            texts = self.spark.read.csv(files, header=True, inferSchema=False)
            parts.append(rescue_columns(texts, schema))
        if parts:
            self._store(reduce(DataFrame.unionByName, parts), batch_id)

    def _store(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{self.base}/rows", batch_id)
        schema = self.schema(batch_id)
        written = self.spark.read.schema(rows.schema).parquet(f"{self.base}/rows/batch_id={batch_id}")
        pairs = (written.filter(F.col(RESCUED).isNotNull()).select(F.explode(F.from_json(RESCUED, "map<string,string>")).alias("field", "text"))
                 .filter(~F.col("field").isin([CORRUPT, *schema.names])))
        fits = [F.every(F.col("text").try_cast(k).isNotNull() & F.col("text").rlike(form)).alias(k) for k, form in KINDS.items()]
        new = pairs.filter("text IS NOT NULL").groupBy("field").agg(*fits).orderBy("field").limit(MOST_FIELDS + 1).collect()
        if len(new) > MOST_FIELDS:
            raise ValueError(f"more than {MOST_FIELDS} new fields in one batch")
        if new:
            kinds = {r.field: next((k for k in KINDS if r[k]), "string") for r in new}
            grown = T.StructType([*schema.fields, *[T.StructField(f, T._parse_datatype_string(k)) for f, k in kinds.items()]])
            write_batch(self.spark.createDataFrame([(grown.json(),)], "schema string").coalesce(1), f"{self.base}/schemas", batch_id)

    # ---- reading -------------------------------------------------------------------------------

    def table(self) -> DataFrame:
        """All rows with all columns; earlier rows get the later columns from what was rescued, and what is left stays rescued."""
        schema = self.schema()
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])).parquet(f"{self.base}/rows")
        later = [f for f in schema.fields if f.name not in self.first.names]
        if not later:
            return rows.drop("batch_id")
        held = F.from_json(RESCUED, "map<string,string>")

        def value(f: T.StructField) -> Column:
            return F.coalesce(F.col(f"`{f.name}`"), held[f.name].try_cast(f.dataType))

        # a value that does not fit its column is still to be seen
        left = F.map_filter(held, lambda k, v: ~reduce(lambda a, b: a | b, [(k == f.name) & v.try_cast(f.dataType).isNotNull() for f in later]))
        rescued = F.when(F.size(left) > 0, F.to_json(left)).alias(RESCUED)
        names: Sequence[str] = [f.name for f in later]
        return rows.select(*[value(f).alias(f.name) if f.name in names else F.col(f"`{f.name}`") for f in schema.fields], rescued)
