"""Telling rows apart whose id does not: null ids and ids that stand at several texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.decontam import digest
from millrace.scratch import materialise


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a further column that no two rows share and that grows with the id, and its name; of rows equal in id and text one stays.

    Ids that are neither null nor repeated are the key themselves, and only they are shuffled to find that out. Otherwise rows are numbered
    by id (null ones last) and the digest of the text, copies of a row being dropped before anything is joined.
    """
    name = unused(docs, "row_key")
    ids = docs.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
    if ids.filter("id IS NULL OR n > 1").isEmpty():
        return docs.withColumn(name, F.col(id_col)), name
    same = unused(docs, "text_digest")
    once = materialise(docs.withColumn(same, digest(F.col(text_col))).dropDuplicates([id_col, same]), "rows")
    order = once.select(F.col(id_col).alias("key_id"), F.col(same).alias("key_digest")).orderBy(F.col("key_id").asc_nulls_last(), "key_digest")
    keys = materialise(order.select("key_id", "key_digest", F.monotonically_increasing_id().alias(name)), "row-keys")
    on = once[id_col].eqNullSafe(keys["key_id"]) & (once[same] == keys["key_digest"])
    return once.join(keys, on).select(*[once[c] for c in docs.columns], keys[name]), name
