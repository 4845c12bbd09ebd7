"""Document fingerprints from prefix polynomial hashes.

For code points c_0, c_1, ... the prefix arrays hold P(i) = sum of (c_j + 1) * B**j for j < i, modulo the Mersenne prime
2**31 - 1, for two bases B. A span's hash is (P(end) - P(start)) / B**start, so any two spans are compared in constant time,
and the longest common extension of two places is found by binary search. A fingerprint is the length, the hash of the whole text
and the ``SKETCH`` smallest mixed hashes among all spans of ``SPAN`` characters; texts of fewer than ``SHORT`` characters add a
sketch of their spans of ``SHORT_SPAN`` characters, which is compared if one text has fewer than half of ``SHORT``. The likeness of
two fingerprints is the Dice coefficient 2J / (1 + J) of the similarity J that the two bottom sketches estimate.

Odd input: a null text is the empty text, whose fingerprint has length 0 and no spans; it is like another empty text (1) and
unlike any other (0). A text shorter than a short span is one span. Equal texts have equal fingerprints. With neighbours, null ids come
last and rows of one id are ordered by their text's hash; a single row is its own neighbour; an empty table gives an empty
result. Further columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.text import column, distinct, mixed, table

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN, SKETCH = 24, 64
SHORT, SHORT_SPAN = 192, 4
_P = np.uint64(PRIME)
_powers: dict[int, np.ndarray] = {}


def folded_once(x: np.ndarray) -> np.ndarray:
    """Equal modulo the prime; below 2**32 if x is below 2**62."""
    return (x & _P) + (x >> np.uint64(31))


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = folded_once(folded_once(folded_once(x)))
    x -= _P * (x >= _P)
    return x


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    elif len(have) > n:
        return have
    while len(have) <= n:
        have = np.concatenate([have, reduced(have * np.uint64(pow(base, len(have), PRIME)))])
    _powers[base] = have
    return have


@functools.cache
def inverse(base: int) -> int:
    return pow(base, -1, PRIME)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, codes: np.ndarray, head: "PrefixHash | None" = None, cut: int = 0):
        """With ``head``, the text is the first ``cut`` code points of that text followed by ``codes``."""
        self.n = cut + len(codes)
        self.sums = []
        for k, base in enumerate(BASES):
            terms = folded_once((codes.astype(np.uint64) + np.uint64(1)) * powers(base, self.n)[cut: self.n])
            sums = np.zeros(self.n + 1, np.uint64)
            if head is not None:
                sums[: cut + 1] = head.sums[k][: cut + 1]
            sums[cut + 1:] = reduced(np.cumsum(terms) + sums[cut])
            self.sums.append(sums)

    def span(self, start: int, end: int) -> int:
        """Both hashes of a span as one number."""
        out = 0
        for base, sums in zip(BASES, self.sums):
            value = (int(sums[end]) - int(sums[start])) * int(powers(inverse(base), self.n)[start]) % PRIME
            out = out << 31 | value
        return out

    def windows(self, lo: int, hi: int, length: int = SPAN) -> np.ndarray:
        """Hashes of the spans of ``length`` characters that start at lo, ..., hi - 1."""
        sums, shift = self.sums[0], powers(inverse(BASES[0]), self.n)
        return reduced((sums[lo + length: hi + length] + _P - sums[lo:hi]) * shift[lo:hi])


def same(a: PrefixHash, i: int, b: PrefixHash, j: int, length: int) -> bool:
    return a.span(i, i + length) == b.span(j, j + length)


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """How many characters agree from place i of a and place j of b on."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if same(a, i, b, j, mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def smallest(x: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct numbers."""
    if len(x) > 8 * SKETCH:
        few = distinct(np.partition(x, 4 * SKETCH)[: 4 * SKETCH])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return distinct(x)[:SKETCH]


def folded(x: np.ndarray) -> np.ndarray:
    return (mixed(x) >> np.uint64(32)).astype(np.uint32)


def sketch(p: PrefixHash, known: np.ndarray | None = None, upto: int = 0) -> tuple[tuple[int, np.ndarray, np.ndarray], np.ndarray]:
    """(length, long sketch, short sketch) and the mixed hashes of all long spans; those that lie in the first ``upto``
    characters are taken from ``known``."""
    hashes = short = np.zeros(0, np.uint32)
    if p.n >= SPAN:
        have = min(max(0, upto - SPAN + 1), len(known)) if known is not None else 0
        new = folded(p.windows(have, p.n - SPAN + 1))
        hashes = np.concatenate([known[:have], new]) if have else new
    if 0 < p.n < SHORT:
        short = smallest(folded(p.windows(0, max(1, p.n - SHORT_SPAN + 1), min(p.n, SHORT_SPAN))))
    return (p.n, smallest(hashes), short), hashes


def written(p: PrefixHash, low: tuple[int, np.ndarray, np.ndarray]) -> str:
    """length-whole-long-short; hashes in hexadecimal, eight digits each."""
    return "-".join([str(p.n), f"{p.span(0, p.n):016x}", *(x.astype(">u4").tobytes().hex() for x in low[1:])])


def likeness(a: str, b: str) -> float:
    """From 0 to 1, of two written fingerprints."""
    if a == b:
        return 1.0
    parts = [x.split("-") for x in (a, b)]
    return alike(*[(int(n), *(np.frombuffer(bytes.fromhex(h), ">u4") for h in hashes)) for n, _, *hashes in parts])


def alike(x: tuple, y: tuple) -> float:
    small, large = min(x[0], y[0]), max(x[0], y[0])
    return dice(x[2], y[2]) if small < SHORT // 2 and large < SHORT else dice(x[1], y[1])


def dice(x: np.ndarray, y: np.ndarray) -> float:
    if not len(x) or not len(y):
        return 0.0
    both = np.concatenate([x, y])
    both.sort()
    twice = np.append(both[1:] == both[:-1], False)
    first = np.concatenate([[True], ~twice[:-1]])
    rank = np.cumsum(first)  # among the hashes of either
    # a full sketch tells about hashes up to its largest only
    limit = min(SKETCH, int(rank[-1])) if len(x) == SKETCH or len(y) == SKETCH else int(rank[-1])
    j = int((twice & (rank <= limit)).sum()) / limit
    return 2 * j / (1 + j)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of each row."""

    def run(batches):
        for batch in batches:
            prefixes = [PrefixHash(code_points(t.decode("utf-8", "replace"))) for t in column(batch, "text").to_pylist()]
            out = table("n_chars long, fingerprint string", [[p.n for p in prefixes], [written(p, sketch(p)[0]) for p in prefixes]])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def in_descending_order(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (block, doc_id, text, guest) so that within a block, ordered by (guest, doc_id descending), each row is followed by its
    successor in the order of the whole table, and the last by a guest: a copy of the next block's first row (for the last block,
    of the first row of all).

    Blocks are cut at quantiles of the id, so no task sees the whole order. The driver holds one cut and one first row's id per
    block. The text itself moves once.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType
    cuts = src.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 10 * blocks).alias("c")).first().c
    cuts = sorted(set(cuts or []))
    if cuts:
        block = F.size(F.filter(F.array(*[F.lit(c).cast(kind) for c in cuts]), lambda c: c < F.col("doc_id"))) + F.lit(1)
    else:
        block = F.lit(1)
    src = src.withColumn("block", F.when(F.col("doc_id").isNull(), 0).otherwise(block))
    src = src.withColumn("text_hash", F.xxhash64("text"))
    heads = sorted(src.groupBy("block").agg(F.max(F.struct("doc_id", "text_hash")).alias("head")).collect(), reverse=True)
    before = {heads[i].block: heads[i - 1].block for i in range(len(heads))}  # the first block's head follows the last block
    pairs = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("first_id", kind),
                          T.StructField("first_hash", T.LongType()), T.StructField("before", T.IntegerType())])
    known = docs.sparkSession.createDataFrame([(h.block, h.head.doc_id, h.head.text_hash, before[h.block]) for h in heads], pairs)
    guest = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    hosts = F.array(F.struct(F.col("block").alias("to"), F.lit(False).alias("guest")),
                    F.struct(F.when(guest, F.col("before")).alias("to"), F.lit(True).alias("guest")))
    return (src.join(F.broadcast(known), "block")  # one row per block
            .select("doc_id", "text", "text_hash", F.explode(hosts).alias("h"))
            .select(F.col("h.to").alias("block"), "doc_id", "text", "text_hash", F.col("h.guest").alias("guest"))
            .filter("block IS NOT NULL"))


def edited_pairs(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: its fingerprint, that of the text whose last third is replaced by the next document's beginning, that edited
    text, the likeness to both it and the next document, and how far text and edited text agree.
    """
    placed = in_descending_order(docs, blocks, id_col, text_col)
    kind = placed.schema["doc_id"].dataType.simpleString()
    ordered = (placed.repartition(max(1, blocks // 3), "block")
               .sortWithinPartitions("block", "guest", F.col("doc_id").desc_nulls_last(), F.col("text_hash").desc()))
    schema = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
              "near_next double, same_prefix long")

    def run(batches):
        from hashlib import sha256
        last = None  # the row that waits for its successor

        def finished(row, successor):
            _, _, text, p, low, hashes, fp = row
            third = p.n // 3
            keep, head = p.n - third, successor[2][:third]
            q = PrefixHash(code_points(head), p, keep)
            low_q, _ = sketch(q, hashes, keep)
            fq = written(q, low_q)
            return (row[1], p.n, sha256((text[:keep] + head).encode("utf-8", "replace")).hexdigest(), fp, fq,
                    1.0 if fp == fq else alike(low, low_q), 1.0 if fp == successor[6] else alike(low, successor[4]),
                    common_extension(p, 0, q, 0))

        for batch in batches:
            done = []
            ids, blocks_, guests = batch.column(1), batch.column(0).to_pylist(), batch.column(4).to_pylist()
            for i, raw in enumerate(column(batch, "text").to_pylist()):
                if guests[i] and (last is None or last[0] != blocks_[i]):
                    continue  # a guest's copy among repeated rows; the first has been used
                text = raw.decode("utf-8", "replace")
                p = PrefixHash(code_points(text))
                low, hashes = sketch(p)
                row = (blocks_[i], ids[i].as_py(), text, p, low, hashes, written(p, low))
                if last is not None and last[0] == row[0]:
                    done.append(finished(last, row))
                last = None if guests[i] else row
            if done:
                cols = list(zip(*done))
                out = table(schema, [list(c) for c in cols[1:]])
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], ids.type), *out.columns], ["doc_id", *out.schema.names])

    return ordered.mapInArrow(run, f"doc_id {kind}, {schema}")
