"""Toxicity by maximum-scoring segments.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased, and hashed to ``BUCKETS`` slots. A word's score is the
difference of its log odds in toxic and clean training documents, each smoothed by a Dirichlet prior in proportion to the word's
share of both, less ``DRIFT``, so that ordinary words count slightly against. A linear scan over a document's scores yields all
maximal-scoring segments (passages that cannot be made better by adding or removing words); their scores follow an extreme-value law in
clean text, whose scale and place are fitted on clean documents, so that a passage's significance does not depend on the document's length.
The document's score is a logistic curve over the significance of its best passage and of all significant passages.

Training rows: labelled documents whose crc32(doc_id as text) mod 4 is 0 or 1 give the word counts; near-identical documents
(the smallest 5-word shingle in each of ``BINS`` ranges of hashes is the same, or missing from both) share one vote. Those with 3 calibrate, about ``CALIBRATION_ROWS`` of them at most, chosen by hash. Rows with 2 are
never used. Labels, language, source and ids are not inputs of a score.

Odd input: null and empty texts have no passage and get the score of a text without evidence; null ids are scored; labels with nulls
are ignored, and of contradicting labels the toxic one counts; an empty table gives an empty result, and with no labels at
all every word scores 0 and the score is the prior of one half of ``THRESHOLD``. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import Words, buffers, chunks, distinct, grams, separators, table
from millrace.scratch import materialise

BUCKETS = 1 << 20
PRIOR = 200.0  # words of prior weight, over both classes
DRIFT = 0.15
SMOOTH = 0.1  # of a toxic document, for a word seen in none
LIMIT = 6.0  # of a word's score either way
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3
BINS = np.uint64(16)
_ALNUM = separators("alnum")


def fold(col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def slots(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(44)).astype(np.int64)


def segments(score: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) of a sequence, in linear time.

    Runs of one sign are merged first. The list holds candidates (left sum, right sum, start, end); a new one is joined to the
    nearest earlier candidate with a smaller left sum, if that one's right sum is smaller than the new one's.
    """
    sums = np.concatenate([[0.0], np.cumsum(score)])
    up = score > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], up, [False]]).astype(np.int8)))
    held: list[tuple[float, float, int, int, int]] = []  # the last: where the nearest smaller left sum stands
    for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        left, right, k = float(sums[start]), float(sums[end]), len(held) - 1
        while True:
            while k >= 0 and held[k][0] >= left:
                k = held[k][4]
            if k < 0 or held[k][1] >= right:
                held.append((left, right, start, end, k))
                break
            left, _, start, _, before = held[k]
            del held[k:]
            k = before
    return [(r - l, a, b) for l, r, a, b, _ in held]


def vote_group(shingles: np.ndarray) -> int:
    """A number that documents share if their smallest hashes in all of ``BINS`` ranges agree."""
    h = np.sort(shingles)
    bins = h // (np.uint64((1 << 64) - 1) // BINS + np.uint64(1))
    smallest = h[np.concatenate([[True], bins[1:] != bins[:-1]])] if len(h) else h
    return int.from_bytes(hashlib.blake2b(smallest.tobytes(), digest_size=8).digest(), "little", signed=True)


@dataclass
class Model:
    scores: np.ndarray  # per slot
    scale: float = 1.0  # of the extreme-value law
    place: float = 0.0
    weights: tuple[float, ...] = (-2.0, 0.0, 0.0)

    def evidence(self, found: list[tuple[float, int, int]], n: int) -> tuple[float, float, int, int]:
        """Significance of the best passage, sum over all significant ones, and where the best is."""
        if not found:
            return 0.0, 0.0, 0, 0
        base = self.place + math.log(max(2, n))
        above = [(self.scale * s - base, a, b) for s, a, b in found]
        best = max(above)
        return max(0.0, best[0]), sum(x for x, _, _ in above if x > 0), best[1], best[2]

    def probability(self, best: float, total: float) -> float:
        b, w, v = self.weights
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, b + w * best + v * math.log1p(total)))))


def with_labels(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: list[int]) -> DataFrame:
    """(doc_id, vote group, distinct slots, label) of labelled rows in some folds; texts do not move."""
    schema = "grp long, slots binary"

    def run(batches):
        for batch, col in chunks(batches):
            words = Words(*buffers(col), _ALNUM)
            at, shingles, own = words.first, grams(words.hashes, 5), slots(words)
            group, packed = [], []
            for d in range(len(col)):
                a, b = int(at[d]), int(at[d + 1])
                few = shingles[a: b - 4] if b - a >= 5 else words.hashes[a:b]
                group.append(vote_group(few))
                packed.append(distinct(own[a:b]).astype("<u4").tobytes())
            out = table(schema, [group, packed])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(fold(F.col("doc_id")).isin(folds))
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}").join(known, "doc_id")


def word_scores(rows: DataFrame) -> np.ndarray:
    """Score per slot from labelled (grp, slots, y); the driver gets at most one row per slot."""
    rows = materialise(rows.select("grp", "slots", "y"), "slots")
    votes = rows.groupBy("grp", "y").agg((1.0 / F.count("*")).alias("w"))
    weighted = rows.join(votes, ["grp", "y"]).select("slots", "y", "w")

    def run(batches):
        sums = np.zeros((2, BUCKETS))
        for batch in batches:
            for s, y, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                sums[1 if y else 0, np.frombuffer(s, "<u4")] += w
        some = np.flatnonzero(sums.any(axis=0))
        for k in range(0, len(some), 50_000):
            part = some[k:k + 50_000]
            yield table("slot int, clean double, toxic double", [part.astype(np.int32), sums[0, part], sums[1, part]])

    counts = (weighted.mapInArrow(run, "slot int, clean double, toxic double")
              .groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas())
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    clean[counts["slot"].to_numpy(int)] = counts["clean"].to_numpy(float)
    toxic[counts["slot"].to_numpy(int)] = counts["toxic"].to_numpy(float)
    n_clean, n_toxic = clean.sum(), toxic.sum()
    if not n_clean or not n_toxic:
        return np.zeros(BUCKETS, np.float32)
    share = (clean + toxic) / (n_clean + n_toxic)
    prior_clean, prior_toxic = PRIOR * n_clean / (n_clean + n_toxic), PRIOR * n_toxic / (n_clean + n_toxic)
    seen = share > 0
    out = np.zeros(BUCKETS)
    out[seen] = (np.log((toxic[seen] + prior_toxic * share[seen] + SMOOTH) / (n_toxic + prior_toxic))
                 - np.log((clean[seen] + prior_clean * share[seen] + SMOOTH * n_clean / n_toxic) / (n_clean + prior_clean)))
    # a difference within two standard errors of 0 is no evidence for toxicity
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    out = np.where((out > 0) & (out < 2 * error), 0.0, out)
    return (np.clip(out, -LIMIT, LIMIT) - DRIFT).astype(np.float32)


def fitted(model: Model, sample: list[tuple[np.ndarray, int, int]]) -> Model:
    """Extreme-value law from clean documents, then the logistic curve, both on rows that gave no word counts.

    ``sample``: passage scores, words, label.
    """
    if len({y for _, _, y in sample}) < 2:
        return model
    top = np.array([max(s, default=0.0) for s, n, y in sample if y == 0 and n])
    size = np.array([max(2, n) for _, n, y in sample if y == 0 and n])
    # by moments, on best scores less the growth with length: variance pi**2 / 6 and mean 0.5772 in units of the scale
    model.scale = math.pi / math.sqrt(6) / max(float(top.std()), 0.2)
    model.place = float(np.mean(model.scale * top - np.log(size))) - 0.5772
    x = np.array([model.evidence([(v, 0, 0) for v in s], n)[:2] for s, n, _ in sample])
    y = np.array([t for _, _, t in sample], float)
    f = np.column_stack([np.ones(len(x)), x[:, 0], np.log1p(x[:, 1])])
    w = np.zeros(3)
    for _ in range(100):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        g = f.T @ (y - p) - 0.5 * w
        h = (f * (p * (1 - p))[:, None]).T @ f + 0.5 * np.eye(3)
        step = np.linalg.solve(h, g)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = tuple(map(float, w))
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    model = Model(word_scores(with_labels(docs, labels, id_col, text_col, label_col, [0, 1])))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
              .filter(fold(F.col("doc_id")) == 3).groupBy("doc_id").agg(F.max("y").alias("y")))
    share = min(1.0, CALIBRATION_ROWS / max(1, chosen.count()))
    if share < 1:
        chosen = chosen.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = passages(src.filter(fold(F.col("doc_id")) == 3), model).join(chosen, "doc_id").toPandas()
    return fitted(model, [(np.frombuffer(p, "<f4").tolist(), int(n), int(y)) for p, n, y in zip(rows["passages"], rows["n"], rows["y"])])


def passages(src: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n, passages): number of words, and the scores of all maximal segments as 4-byte floats."""
    spread = src.sparkSession.sparkContext.broadcast(model.scores)  # BUCKETS numbers of 4 bytes

    def run(batches):
        for batch, col in chunks(batches):
            words = Words(*buffers(col), _ALNUM)
            each, at = spread.value[slots(words)].astype(float), words.first
            found = [np.array([s for s, _, _ in segments(each[at[d]: at[d + 1]])], "<f4").tobytes() for d in range(len(col))]
            out = table("n int, passages binary", [words.counts(), found])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n int, passages binary")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, best, total, start, end) per row: probability, significance of the best and of all passages, and the best
    passage's first word and the one after its last."""
    schema = "score double, best double, total double, start long, end long"
    spread = docs.sparkSession.sparkContext.broadcast(model.scores)
    law = Model(np.zeros(0), model.scale, model.place, model.weights)

    def run(batches):
        for batch, col in chunks(batches):
            words = Words(*buffers(col), _ALNUM)
            each, at = spread.value[slots(words)].astype(float), words.first
            rows = []
            for d in range(len(col)):
                own = each[at[d]: at[d + 1]]
                best, total, a, b = law.evidence(segments(own), len(own))
                rows.append((law.probability(best, total), best, total, a, b))
            out = table(schema, [list(c) for c in zip(*rows)] or [[]] * 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")
