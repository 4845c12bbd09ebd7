"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates, links confirmed on full sets.

A document's set holds its distinct 5-word shingles (words are parted by white space, A-Z lower-cased); a document of fewer
words has its whole word sequence as one shingle, and one without words or with a null text has an empty set that is linked
with nothing. Two documents are linked if they share at least 75 of 100 parts of the union of their sets.

How the work stays bounded:

* Documents of equal sets form a class at once (one row per class goes on), so exact copies cost no pairs.
* One hash per shingle fills ``BINS`` bins; empty bins borrow from a filled one along a fixed random probe order of their own
  (optimal densification). ``ROWS`` neighbouring bins form a band, and equal bands put classes into one bucket. At a
  similarity of 0.75 a pair shares none of the 40 buckets with probability (1 - 0.75**5)**40 = 2e-5.
* A bucket yields a star: its smallest member with each other one. Confirmed stars are joined to components, and a bucket of n
  copies costs n - 1 pairs. Only where a bucket still holds several components can a link be missing. The members of such
  buckets are compared across components by prefix filtering, which is exact: with all shingles in one order (rare ones first), two
  sets of n and m shingles that are linked share one of the first n - ceil(0.75 n) + 1, and the first they share stands so early
  that enough shingles, 75 (n + m) / 175, are left from it on. Variants of one text that are not linked begin with
  their own rare shingles and meet nowhere, however large their bucket is.
* Both sides of a pair are sets recomputed from the texts, which are smaller than the sets; a hub's pairs are dealt over salts.
* Joins that move texts or buckets are merge joins at every size, so that a small run shows the plan of a large one.

Odd input: a document with a null id is returned with its set size, a null component and kept; rows that repeat an id are
compared each on its own and share the id's links; equal texts are linked and the smallest id is kept; empty tables give empty
results; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.text import Words, buffers, chunks, column, distinct, grams, separators, table
from millrace.scratch import materialise

WORDS = 5
BINS, ROWS = 200, 5
PERCENT = 75
HUB_PAIRS = 500  # pairs of one hub in a salt
ORDER_SLOTS = 1 << 18  # counters that order shingles; any order is exact, a better one yields fewer candidates
_SPACE = separators()
_probes: dict[int, np.ndarray] = {}


def probe_order(bins: int, tries: int) -> np.ndarray:
    """For each bin the bins it asks in turn when it is empty; the same everywhere."""
    have = _probes.get(bins)
    if have is None or have.shape[1] < tries:
        _probes[bins] = have = np.random.RandomState(7).randint(0, bins, (tries, bins)).T.astype(np.int32)
    return have[:, :tries]


def shingle_sets(col: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    words = Words(*buffers(col), _SPACE)
    return sets_of(words)


def sets_of(words: Words) -> list[np.ndarray]:
    hashes, all5, first = words.hashes, grams(words.hashes, WORDS), words.first
    out = []
    for d in range(len(first) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= WORDS:
            out.append(distinct(all5[a: b - WORDS + 1]))
        else:
            out.append(grams(hashes[a:b], b - a) if b > a else hashes[:0])
    return out


def signature(s: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The smallest hash of each bin of a sorted, non-empty set, empty bins filled by densification."""
    where = ((s >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = where[1:] != where[:-1]
    value, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    value[where[new]], filled[where[new]] = s[new], True
    empty = np.flatnonzero(~filled)
    done, tries = 0, 16
    source = np.arange(bins)
    while len(empty):
        if done >= 8192:  # a bin that asked so often takes the first filled one
            source[empty] = np.flatnonzero(filled)[0]
            break
        asked = probe_order(bins, 8192)[empty, done:done + tries]
        hit = filled[asked]
        found = hit.any(axis=1)
        source[empty[found]] = asked[found, hit[found].argmax(axis=1)]
        empty, done, tries = empty[~found], done + tries, tries * 8
    return value[source]


def bands(s: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band; the band's number is part of it."""
    rows = signature(s).reshape(BINS // ROWS, ROWS)
    out = np.arange(BINS // ROWS, dtype=np.uint64)
    for k in range(ROWS):
        out = out * np.uint64(0x9E3779B97F4A7C15) + rows[:, k]
        out ^= out >> np.uint64(29)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, buckets) for every row of (doc_id, text)."""
    schema = "n_shingles int, digest binary, buckets array<long>"

    def run(batches):
        for batch, col in chunks(batches):
            sets = shingle_sets(col)
            out = table(schema, [[len(s) for s in sets],
                                 [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                                 [bands(s).view(np.int64) if len(s) else None for s in sets]])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")


def texts_of(ids: DataFrame, src: DataFrame) -> DataFrame:
    """(rep, text) of the given reps."""
    return (src.join(ids.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
            .withColumnRenamed("doc_id", "rep"))


def confirmed(pairs: DataFrame, src: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough.

    A hub in very many pairs is dealt over salts, each with a copy of its text.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    texts = texts_of(needed, src)
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_PAIRS).cast("int").alias("n"))
    spread = (pairs.join(parts.filter("n > 1"), "a", "left")
              .withColumn("salt", F.when(F.col("n") > 1, F.pmod(F.xxhash64("b"), F.col("n"))).otherwise(F.lit(0)).cast("int")))
    hubs = (parts.join(texts.withColumnRenamed("rep", "a").hint("merge"), "a")
            .select("a", F.explode(F.sequence(F.lit(0), F.col("n") - F.lit(1))).alias("salt"), F.col("text").alias("text_a")))
    both = (spread.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .join(hubs.hint("merge"), ["a", "salt"]).select("a", "b", "text_a", "text_b"))

    def run(batches):
        for batch, col in chunks(batches, "text_b"):
            left = column(batch, "text_a")
            ids = left.dictionary_encode()
            hub_sets = shingle_sets(ids.dictionary)
            keep = [alike(hub_sets[k], s) for k, s in zip(ids.indices.to_pylist(), shingle_sets(col))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    if min(len(x), len(y)) * 100 < PERCENT * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(rep, component) for every end of an edge (a, b): the smallest id that can be reached.

    Every node takes the smallest label among its neighbours and itself, then the label of that label; the rounds end when
    nothing changes. Labels are written each round, so a lost executor costs one round.
    """
    both = materialise(edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
                       .union(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "links")
    labels = materialise(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("seen"))
        step = labels.join(near, "x").select("x", "label", F.least("label", "seen").alias("low"))
        hop = labels.select(F.col("x").alias("low"), F.col("label").alias("far"))
        new = materialise(step.join(hop, "low").select("x", F.least("low", "far").alias("label"),
                                                       (F.least("low", "far") < F.col("label")).alias("moved")), "labels")
        if new.filter("moved").isEmpty():
            return new.select(F.col("x").alias("rep"), F.col("label").alias("component"))
        labels = new.select("x", "label")


def sizes_fit(n: str, m: str):
    return F.least(F.col(n), F.col(m)).cast("long") * 100 >= F.greatest(F.col(n), F.col(m)).cast("long") * PERCENT


def across_components(members: DataFrame, src: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of different components among (rep, component), by prefix filtering: no linked pair is missing."""
    kind = members.schema["rep"].dataType.simpleString()
    texts = materialise(texts_of(members, src).join(members.hint("merge"), "rep").select("rep", "component", "text"), "open")

    def counted(batches):
        n = np.zeros(ORDER_SLOTS, np.int64)
        for _, col in chunks(batches):
            for s in shingle_sets(col):
                n += np.bincount((s & np.uint64(ORDER_SLOTS - 1)).astype(np.int64), minlength=ORDER_SLOTS) if len(s) > 4096 else 0
                if len(s) <= 4096:
                    np.add.at(n, (s & np.uint64(ORDER_SLOTS - 1)).astype(np.int64), 1)
        some = np.flatnonzero(n)
        yield table("slot int, n long", [some.astype(np.int32), n[some]])

    rows = texts.select("text").mapInArrow(counted, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(ORDER_SLOTS, np.int64)
    often[rows["slot"].to_numpy(int)] = rows["n"].to_numpy(int)
    often = src.sparkSession.sparkContext.broadcast(often)  # ORDER_SLOTS numbers

    def prefixes(batches):
        for batch, col in chunks(batches):
            index, first, size, place = [], [], [], []
            for d, s in enumerate(shingle_sets(col)):
                rare = s[np.lexsort((s, often.value[(s & np.uint64(ORDER_SLOTS - 1)).astype(np.int64)]))]
                rare = rare[: len(s) + (-PERCENT * len(s)) // 100 + 1]
                index.append(np.full(len(rare), d))
                first.append(rare)
                size.append(np.full(len(rare), len(s)))
                place.append(np.arange(len(rare)))
            index = pa.array(np.concatenate(index))
            out = table("shingle long, n int, pos int", [np.concatenate(first).view(np.int64), *(np.concatenate(x).astype(np.int32) for x in (size, place))])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), *out.columns],
                                             ["rep", "component", *out.schema.names])

    entries = materialise(texts.mapInArrow(prefixes, f"rep {kind}, component {kind}, shingle long, n int, pos int"), "prefixes")
    mixed_ = entries.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    entries = materialise(entries.join(mixed_.select("shingle"), "shingle", "left_semi"), "prefixes")
    left = entries.select("shingle", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("p_a"), F.col("component").alias("c_a"))
    right = entries.select("shingle", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("p_b"), F.col("component").alias("c_b"))
    needed = PERCENT * (F.col("n_a") + F.col("n_b")).cast("long")
    whole = 100 + PERCENT
    return (left.join(right, "shingle")
            .filter((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & sizes_fit("n_a", "n_b")
                    & (whole * (F.col("n_a") - F.col("p_a")) >= needed) & (whole * (F.col("n_b") - F.col("p_b")) >= needed))
            .select("a", "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; kept marks the smallest id of each component."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(signatures(src), "signatures")
    known = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialise(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    members = (known.join(classes.select(F.col("rep").alias("doc_id"), "digest").hint("merge"), ["doc_id", "digest"], "left_semi")
               .dropDuplicates(["doc_id", "digest"]))
    entries = members.select(F.col("doc_id").alias("rep"), "n_shingles", F.explode("buckets").alias("bucket"))
    stars = entries.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    buckets = materialise(entries.join(stars.hint("merge"), "bucket").select("bucket", "rep", "n_shingles", "hub"), "buckets")
    hub_sizes = members.select(F.col("doc_id").alias("hub"), F.col("n_shingles").alias("hub_n"))
    pairs = materialise(buckets.filter("rep != hub").select("hub", "rep", "n_shingles").distinct().join(hub_sizes.hint("merge"), "hub")
                        .filter(sizes_fit("n_shingles", "hub_n")).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = materialise(confirmed(pairs, src), "links")
    groups = components(spark, links)
    placed = buckets.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed_ = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    rest = materialise(placed.join(mixed_.select("bucket"), "bucket", "left_semi").select("rep", "component").distinct(), "open")
    more = materialise(across_components(rest, src).join(pairs, ["a", "b"], "left_anti"), "pairs")
    extra = materialise(confirmed(more, src), "links")
    groups = components(spark, links.union(extra))
    of_class = classes.join(groups, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = rows.drop("buckets").join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
