"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)


def create_if_absent(df: DataFrame, path: str) -> None:
    """Write only if nothing is there yet."""
    df.write.mode("ignore").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may have new columns; read back with ``read_evolving``."""
    df.write.mode("append").parquet(path)


def read_evolving(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def split_json(df: DataFrame, path: str, files: int) -> None:
    """JSON lines in a given number of evenly filled files."""
    df.repartition(files).write.mode("overwrite").json(path)


def row_document(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns))


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a declared schema; a NULL in a column declared NOT NULL fails the job."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in {f.name}")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)
