"""One registered query per operator; SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import align, bpe, ctw, decontam, fingerprints, langid, licenses, near_dup, pii, quality, runs, toxicity, warc
from millrace.session import task_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_semi_markov_pii(spark, sf_dir):
    """Personal data in every document: pattern spans, and those the semi-Markov field adds."""
    found = pii.find(read(spark, sf_dir, "documents"), pii.train())
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op2_minhash_near_dup(spark, sf_dir):
    """Near-duplicate groups of all documents."""
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op2_minhash_near_dup"] = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex({ASCII_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)),
reach AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n_shingles, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query
def op3_prefix_hash_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, with their likeness."""
    docs = read(spark, sf_dir, "documents")
    return fingerprints.edited_pairs(docs, 3 * task_count(spark)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_prefix")


@query
def op5_byte_bpe(spark, sf_dir):
    """Token ids of every document and the bytes they decode to, as digests."""
    import public_tokenizers as vocabularies
    out = bpe.round_trip(read(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_benchmark_decontamination(spark, sf_dir):
    """Words of every document inside benchmark windows."""
    out = decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


ORACLES["op6_benchmark_decontamination"] = rf"""
WITH doc AS (
    SELECT doc_id, list_filter(string_split_regex({ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
item AS (
    SELECT item_id, list_filter(string_split_regex({ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
win AS (
    SELECT item_id, least(10, len(words)) AS n, unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1),
        lambda i: array_to_string(words[i:i + 9], ' '))) AS phrase FROM item WHERE len(words) > 0),
place AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM doc),
gram AS (
    SELECT doc_id, pos, n, array_to_string(words[pos:pos + n - 1], ' ') AS phrase
    FROM place, (SELECT DISTINCT n FROM win) WHERE pos + n - 1 <= len(words)),
found AS (SELECT gram.doc_id, gram.pos, gram.n, win.item_id FROM gram JOIN win ON win.phrase = gram.phrase AND win.n = gram.n),
hit AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS spot FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc.doc_id, len(words) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op10_toxic_segments(spark, sf_dir):
    """Toxicity of every document by its maximum-scoring passages."""
    docs = read(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", (toxicity.fold(F.col("doc_id")) == 2).alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "best", "total", "start", "end")


@query
def op9_context_tree_scores(spark, sf_dir):
    """Log probability of every document by words and by the weighted context tree."""
    return ctw.score(read(spark, sf_dir, "documents"))


@query
def op8_zstd_warc(spark, sf_dir):
    """Every page through a Zstandard WARC archive and back."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


# DuckDB has SHA-1 in hexadecimal only; base32 takes five bits at a time from the 160
ORACLES["op8_zstd_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS largest FROM p)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(
        ((('0x' || hex[(i * 5) // 4 + 1:(i * 5) // 4 + 2] || CASE WHEN (i * 5) // 4 = 39 THEN '0' ELSE '' END)::INTEGER)
            // (CASE (i * 5) % 4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END)) % 32 + 1)::INTEGER]), '') AS payload_digest,
    CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM d
"""


@query
def op7_weak_label_quality(spark, sf_dir):
    """Votes, weak label and score of every document."""
    docs = read(spark, sf_dir, "documents")
    return quality.judged(docs, quality.train(docs))


@query
def op4_license_scan(spark, sf_dir):
    """Licence notices in every document."""
    docs = read(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


@query
def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words in every document, some of which first get a periodic tail."""
    return runs.digests(runs.find(read(spark, sf_dir, "documents"), seed=runs.repeated_tail))


@query
def op11_language_bitmasks(spark, sf_dir):
    """Language of every document by n-gram filters with a bit a language."""
    docs = read(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.train(docs))
    return out.select("doc_id", (langid.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "n_grams", "second")


@query
def op12_tokenizer_alignment(spark, sf_dir):
    """Groups of two tokenizers' tokens in every document, and how frequent their links are in the corpus."""
    import public_tokenizers as vocabularies
    out = align.align(read(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model"), digest=True)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").cast("string").alias("groups_sha256"))
