"""From raw documents to token ids: each stage is written as Parquet and read again as the next one's documents.

Every stage works on all rows its predecessor kept. Decisions hold for rows, not for ids: rows with a null id or with one that stands at
several texts are judged each by its own text, and one of rows equal in id and text stays. Extra columns are carried along until the
last stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, decontam, near_dup, pii, quality
from millrace.llm.rows import row_key
from millrace.scratch import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer accepts; it is fitted on the documents at hand."""
    return quality.accepted(docs, quality.train(docs))


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id (null ones last), of each group of near copies."""
    keyed, key = row_key(docs)
    copies = near_dup.near_duplicates(keyed, id_col=key).filter("NOT kept").select(F.col("doc_id").alias("copy__"))
    return keyed.join(copies.hint("merge"), keyed[key] == copies["copy__"], "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontam.decontaminate(docs, benchmark).filter("contaminated")
    found = found.select(F.col("doc_id").alias("hit__"), F.col("text_digest").alias("hit_text__"))
    same = docs["doc_id"].eqNullSafe(found["hit__"]) & (decontam.digest(docs["text"]) == found["hit_text__"])
    return docs.join(found.hint("merge"), same, "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    masked = pii.mask(docs, pii.train())
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, n_tokens, ids, decoded_sha256): the ids as little-endian 32-bit numbers."""
    import public_tokenizers as vocabularies
    out = bpe.with_tokens(docs.select("doc_id", "lang", "source", "n_chars", "text"), vocabularies.path("byte_bpe_50k.tiktoken"),
                          vocabularies.PATTERN)
    return out.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("text", "decoded")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_first_of_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("byte_bpe", to_token_ids),
]
ORACLE_SQL = None  # the classifier and the random field have no SQL form; tests/llm holds the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
