"""Quality classifier from weak labels.

``VOTERS`` heuristic labellers look at a document and vote good (+1), bad (-1) or abstain (0). A latent-class model takes a document's true
quality as unknown and each labeller as independent given it; expectation-maximisation over the counts of all vote patterns
(at most 3**11 of them, counted in Spark over all documents) estimates every labeller's accuracy and the share of good
documents. An abstention is no evidence. The posterior of a document's pattern is its soft label. A linear scorer over hashed word shapes (letters as a and A,
digits as 0, doubled bytes once; single shapes, pairs, and words equal to the one before) learns the soft labels of about ``SAMPLE_DOCS`` documents, and scores
every document. They are chosen among those with enough words: a text with c copies stands for c times the sampled share of them, rounded up or
down by its hash, so copies weigh what they are and none crowds out other texts. No human label is used.

Odd input: texts of fewer than ``FEW_WORDS`` words, null and empty ones among them, get only abstentions, and the share of good documents as
their score, so they stay where most documents are good; null ids are passed through; repeated rows are judged each on its own; an empty table gives an
empty result. ``accepted`` keeps all columns; the other functions read only the named ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import Words, buffers, chunks, grams, mixed, separators, table
from millrace.scratch import materialise

SLOTS = 1 << 12
SAMPLE_DOCS = 4000
FEW_WORDS = 5
ECHO = mixed(np.array([1, 2], np.uint64))  # features of a word unlike and like the one before
THRESHOLD = 0.5
_SPACE = separators()

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK &= ~(_LETTER | _DIGIT)
_FIRST = np.ones(256, bool)  # bytes that begin a character
_FIRST[128:192] = False

SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[128:] = ord("a"), ord("a")
SHAPE[65:91] = ord("A")
SHAPE[48:58] = ord("0")

# name, bad from, good up to: the vote on a measure that is the larger the worse a text is
VOTERS = [
    ("marks", 0.08, 0.05),  # punctuation per character
    ("capitals", 0.3, 0.1),  # of ASCII letters
    ("lone", 0.1, 0.01),  # words that are one punctuation mark
    ("tabular", 0.02, 0.002),  # bars and tabs per character
    ("stutter", 0.2, 0.02),  # words that end in a doubled punctuation mark
    ("repeats", 0.5, 0.2),  # word triples that occur before
    ("echo", 0.2, 0.05),  # words equal to the one before
    ("digits", 0.2, 0.05),  # of characters
    ("long_words", 15.0, 10.0),  # mean length
    ("short_words", -2.0, -3.0),  # mean length, negated
    ("no_sentence", 0.999, 0.5),  # 1 if no word ends in a single . ! or ?
]


def measures(raw: np.ndarray, off: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """One row per document and one column per labeller, and the number of words."""
    def share(mask: np.ndarray, at: np.ndarray, over: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(over, 1)

    n, at = words.counts(), words.first
    one = np.ones(len(n))
    chars = share(_FIRST[raw], off, one)
    last = raw[words.end - 1] if len(raw) else raw
    before = np.where(words.end - words.start > 1, raw[np.maximum(words.end - 2, 0)], 0) if len(raw) else raw
    mark = _MARK[last]
    sentence = np.isin(last, list(b".!?")) & (last != before)
    triples = grams(words.hashes, 3)
    rows = words.rows()
    inside = rows[: len(triples)] == rows[2:] if len(triples) else np.zeros(0, bool)
    owner = rows[: len(triples)][inside]
    _, first = np.unique(triples[inside] ^ mixed(owner.astype(np.uint64)), return_index=True)
    distinct = np.bincount(owner[first], minlength=len(n))
    total = np.bincount(owner, minlength=len(n))
    echo = np.zeros(len(rows), bool)
    echo[1:] = (words.hashes[1:] == words.hashes[:-1]) & (rows[1:] == rows[:-1])
    mean = (chars - share((raw <= 32), off, one)) / np.maximum(n, 1)
    out = np.column_stack([
        share(_MARK[raw], off, chars), share(_UPPER[raw], off, share(_LETTER[raw], off, one)), share(mark & (words.end - words.start == 1), at, n),
        share((raw == 124) | (raw == 9), off, chars),
        share(mark & (last == before), at, n), np.where(total > 0, 1 - distinct / np.maximum(total, 1), 0.0), share(echo, at, n), share(_DIGIT[raw], off, chars),
        mean, -mean, share(sentence, at, one) == 0])
    return out, n


def votes(raw: np.ndarray, off: np.ndarray, words: Words) -> np.ndarray:
    """+1, -1 or 0 per document and labeller."""
    value, n = measures(raw, off, words)
    bad, good = np.array([v[1] for v in VOTERS]), np.array([v[2] for v in VOTERS])
    out = np.where(value >= bad, -1, np.where(value <= good, 1, 0))
    out[n < FEW_WORDS] = 0
    out[n < 30, -1] = np.maximum(out[n < 30, -1], 0)  # a short text may be no sentence
    return out


def patterns(cast: np.ndarray) -> list[str]:
    return ["".join("-0+"[v + 1] for v in row) for row in cast]


def features(raw: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, weights of unit length) of each document; both empty if it has too few words to be judged."""
    shaped = SHAPE[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = (shaped[1:] != shaped[:-1]) | ((shaped[1:] != ord("a")) & (shaped[1:] != ord("A")) & (shaped[1:] != ord("0")))
    keep[off[:-1][off[:-1] < len(raw)]] = True
    sums = np.concatenate([[0], np.cumsum(keep)])
    words = Words(shaped[keep], sums[off], _SPACE, lower=False)
    one, two = words.hashes, grams(words.hashes, 2)
    plain = Words(raw, off, _SPACE, lower=False).hashes  # the same words in full
    echo = np.concatenate([[False], plain[1:] == plain[:-1]])
    out = []
    for d in range(len(off) - 1):
        a, b = words.first[d], words.first[d + 1]
        if b - a < FEW_WORDS:
            out.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        slot, n = np.unique(np.concatenate([one[a:b], two[a: max(a, b - 1)], ECHO[echo[a + 1: b].astype(int)]]) >> np.uint64(52), return_counts=True)
        w = np.sqrt(n)
        out.append((slot.astype(np.int64), w / max(float(np.sqrt((w * w).sum())), 1e-9)))
    return out


@dataclass
class Model:
    posterior: dict[str, float]  # of being good, by vote pattern
    accuracy: dict[str, tuple[float, float]]  # per labeller: share of good votes on good, of bad votes on bad documents
    weights: np.ndarray
    intercept: float
    prior: float  # share of good documents, the score of a text that is too short to be judged

    def score(self, slots: np.ndarray, weight: np.ndarray) -> float:
        if not len(slots):
            return self.prior
        z = self.intercept + float(self.weights[slots] @ weight)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def latent_classes(counts: dict[str, int], rounds: int = 500) -> tuple[dict[str, float], dict[str, tuple[float, float]]]:
    """Posterior of good per pattern and the labellers' accuracies, by expectation-maximisation from the majority vote."""
    names = sorted(counts)
    if not names:
        return {}, {}
    n = np.array([counts[p] for p in names], float)
    seen = np.array([["-0+".index(c) for c in p] for p in names])
    cast = seen != 1
    q = np.clip(0.5 + (seen - 1).sum(axis=1) / (2.0 * np.maximum(cast.sum(axis=1), 1)) - 0.15 * (seen == 0).any(axis=1), 0.02, 0.98)
    right = np.zeros((2, len(VOTERS)))
    for _ in range(rounds):
        prior = np.array([((1 - q) * n).sum() + 1, (q * n).sum() + 1])
        log = np.tile(np.log(prior / prior.sum()), (len(names), 1))
        for c, weight in enumerate((n * (1 - q), n * q)):
            for v in range(len(VOTERS)):
                good, bad = weight[seen[:, v] == 2].sum() + 0.5, weight[seen[:, v] == 0].sum() + 0.5
                log[:, c] += np.where(cast[:, v], np.log(np.where(seen[:, v] == 2, good, bad) / (good + bad)), 0.0)
                right[c, v] = (good if c else bad) / (good + bad)
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return dict(zip(names, q.tolist())), {v[0]: (float(right[1, i]), float(right[0, i])) for i, v in enumerate(VOTERS)}


def fitted(rows: list[tuple[np.ndarray, np.ndarray]], soft: np.ndarray, copies: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights for soft labels of rows that count ``copies`` times, by accelerated gradient steps with a small ridge."""
    if not rows:
        return np.zeros(SLOTS), 0.0
    slot = np.concatenate([s for s, _ in rows])
    value = np.concatenate([w for _, w in rows])
    row = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    w, b = np.zeros(SLOTS), 0.0
    w_old, b_old = w, b
    part = copies / max(float(copies.sum()), 1.0)
    for t in range(rounds):
        pull = t / (t + 3)
        u, c = w + pull * (w - w_old), b + pull * (b - b_old)
        z = np.bincount(row, weights=u[slot] * value, minlength=len(rows)) + c
        e = (soft - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) * part
        w_old, b_old = w, b
        w = u + 2.0 * (np.bincount(slot, weights=e[row] * value, minlength=SLOTS) - 1e-5 * u)
        b = c + 2.0 * float(e.sum())
    return w, b


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Votes of all documents, their classes, and a scorer learned from the soft labels of a sample."""
    src = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))

    def vote(batches):
        for batch, col in chunks(batches):
            raw, off = buffers(col)
            words = Words(raw, off, _SPACE, lower=False)
            keys = batch.column(1).to_numpy()
            yield table("pattern string, key long", [patterns(votes(raw, off, words)), pa.array(keys, mask=words.counts() < FEW_WORDS)])

    # a row per text that can be judged; the others have no key, and one row in all
    texts = materialise(src.mapInArrow(vote, "pattern string, key long").groupBy("pattern", "key").agg(F.count("*").alias("n")), "texts")
    counted = texts.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("key").isNotNull(), F.col("n"))).alias("judged"))
    counted = counted.collect()  # at most 3**11 rows
    counts = {r.pattern: r.n for r in counted}
    posterior, accuracy = latent_classes(counts)
    total = sum(counts.values())
    share = min(1.0, SAMPLE_DOCS / max(sum(r.judged or 0 for r in counted), 1))
    copies = F.floor(F.col("n") * share + F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30))
    chosen = {r.key: r.copies for r in texts.filter("key IS NOT NULL").select("key", copies.alias("copies")).filter("copies > 0").collect()}

    def describe(batches):
        done = set()  # a chosen text is described once a task
        for batch, col in chunks(batches):
            new = [k for k, key in enumerate(batch.column(1).to_pylist()) if not (key in done or done.add(key))]
            col = col.take(pa.array(new, pa.int64()))
            raw, off = buffers(col)
            found = features(raw, off)
            yield table("key long, pattern string, slots binary, weights binary", [
                batch.column(1).take(pa.array(new, pa.int64())), patterns(votes(raw, off, Words(raw, off, _SPACE, lower=False))),
                [s.astype("<u2").tobytes() for s, _ in found], [w.astype("<f4").tobytes() for _, w in found]])

    described = src.filter(F.col("key").isin(list(chosen))).mapInArrow(describe, "key long, pattern string, slots binary, weights binary")
    sample = described.dropDuplicates(["key"]).toPandas().sort_values("key")  # about SAMPLE_DOCS rows at most
    rows = [(np.frombuffer(s, "<u2").astype(np.int64), np.frombuffer(w, "<f4").astype(float)) for s, w in zip(sample["slots"], sample["weights"])]
    weights, intercept = fitted(rows, np.array([posterior[p] for p in sample["pattern"]]), np.array([float(chosen[k]) for k in sample["key"]]))
    prior = sum(posterior[p] * n for p, n in counts.items()) / total if total else 1.0
    return Model(posterior, accuracy, weights, intercept, prior)


def judged(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, votes, weak_label, score, kept) of each row."""
    schema = "votes string, weak_label double, score double, kept boolean"

    def run(batches):
        for batch, col in chunks(batches):
            raw, off = buffers(col)
            cast = patterns(votes(raw, off, Words(raw, off, _SPACE, lower=False)))
            score = [model.score(s, w) for s, w in features(raw, off)]
            out = table(schema, [cast, [model.posterior.get(p) for p in cast], score, [s >= THRESHOLD for s in score]])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, all columns."""

    def run(batches):
        for batch, col in chunks(batches, text_col):
            keep = [model.score(s, w) >= THRESHOLD for s, w in features(*buffers(col))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
