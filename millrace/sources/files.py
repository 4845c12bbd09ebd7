"""File sources: schema hints, rescued data, corrupt records, binary files, tables by name."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def hinted_schema(spark: SparkSession, path: str, fmt: str, hints: str | T.StructType,
                  sampling: float = 1.0, **options) -> T.StructType:
    """Infer a schema (JSON and CSV honour ``sampling``), then override or add the hinted columns."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("inferSchema", True)
    if fmt in ("csv", "json") and sampling < 1.0:
        reader = reader.option("samplingRatio", sampling)
    found = reader.load(path).schema
    hints = T._parse_datatype_string(hints) if isinstance(hints, str) else hints
    wanted = {f.name: f for f in hints.fields}
    fields = [wanted.pop(f.name, f) for f in found.fields]
    return T.StructType([*fields, *wanted.values()])


def stored_schema(spark: SparkSession, at: str, infer: Callable[[], T.StructType]) -> T.StructType:
    """A schema inferred by the first run and kept as JSON in the folder ``at``; later runs read it and look at no data."""
    try:
        return T.StructType.fromJson(json.loads(spark.read.text(at).first()[0]))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    found = infer()
    spark.createDataFrame([(found.json(),)], "value string").coalesce(1).write.text(at)
    return found


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which the permissive JSON and CSV readers keep bad records."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _fit(raw: Column, schema: T.StructType, line: Column) -> list[Column]:
    """Typed columns from a map of texts, and the misfits as one JSON text."""
    def value(f: T.StructField) -> Column:
        text = raw[f.name]
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(text, f.dataType)
        return text.try_cast(f.dataType)

    typed = {f.name: value(f) for f in schema.fields}
    misfit = [
        F.when(raw[n].isNotNull() & v.isNull(), F.create_map(F.lit(n), raw[n])) for n, v in typed.items()
    ]
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    extra = F.map_filter(raw, lambda k, v: ~F.array_contains(known, k) & v.isNotNull())
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    odd = F.map_concat(extra, *[F.coalesce(m, empty) for m in misfit])
    broken = F.to_json(F.create_map(F.lit(CORRUPT), line))
    rescued = F.when(raw.isNull(), broken).when(F.size(odd) > 0, F.to_json(odd))
    return [*[v.alias(n) for n, v in typed.items()], rescued.alias(RESCUED)]


def rescue_json(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse JSON lines; fields that do not fit and lines that do not parse go to ``_rescued_data``.

    Works on batch and streaming text sources.
    """
    raw = F.from_json(F.col(column), "map<string,string>", {"mode": "PERMISSIVE"})
    bad = F.try_parse_json(F.col(column)).isNull()
    parsed = lines.select(F.col(column).alias("_line"), F.when(~bad, raw).alias("_raw"))
    return parsed.select(*_fit(F.col("_raw"), schema, F.col("_line")))


def rescue_columns(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """The same for a frame whose columns were read as text, such as a headed CSV file."""
    pairs = [x for c in texts.columns for x in (F.lit(c), F.col(c))]
    return texts.select(F.create_map(*pairs).alias("_raw")).select(*_fit(F.col("_raw"), schema, F.lit(None)))


def id_from_path(pattern: str, column: str = "path") -> Column:
    return F.regexp_extract(F.col(column), pattern, 1)


def register_tables(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> None:
    """Temp views over table directories."""
    for name, path in paths.items():
        spark.read.format(fmt).load(path).createOrReplaceTempView(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, on whatever file system it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def sub_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the directories right under ``base`` on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path)
                  if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def date_spine(df: DataFrame, day: str, step_days: int = 1) -> DataFrame:
    """One row per calendar step between the first and last day of a table."""
    ends = df.agg(F.min(day).cast("date").alias("lo"), F.max(day).cast("date").alias("hi"))
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval {step_days} days"))).alias("day"))
