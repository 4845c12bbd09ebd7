"""Language identification with language-bitmask n-gram filters.

A text's words are its runs of letters (with their combining marks, lower-cased); its features are the 1 to 4 characters long n-grams of
words with a mark at each end. One bit-sliced Bloom filter holds the n-grams of all languages: a row of the table is a bitmask with one
bit a language, an n-gram is entered by setting its languages' bits in ``PROBES`` rows, and the AND of those rows is the mask of all languages that
contain it. A language that lacks the n-gram still shows its bit with a probability known from how full its slice is, so the
counts of set bits per language are corrected for it: (hits - p * n) / (1 - p). The language with the largest corrected count decides. Words are compared by 64-bit hashes, and a word that stands in a batch several times is looked up once.

A language contains an n-gram if it uses it at least once in ``1 / RARE`` n-grams of that length and not ``DOMINANCE`` times less often than some
other language; the first bounds the filter (no more than ``1 / RARE`` n-grams a language and length), the second keeps foreign words in a
large corpus from filling every mask. Rates come from at most about ``SAMPLE_DOCS`` documents a language, chosen by a hash of the
id; counting them, the masks and the filter's rows are Spark jobs. The driver gets the finished table, ``TABLE_BYTES`` at most.

Learning uses text and language of rows with both, whose crc32(doc_id as text) mod 5 is not 0. Odd input: a null id counts as the empty
text (so it is held out); a null text or one without a letter is ``und`` with score 0; a text of letters that no language contains goes to
the language with most documents, with score 0; so do ties, the name deciding between languages with equally many. Without any learned
language all rows are ``und``. Repeated rows are each judged; an empty table gives an empty result; only the named columns are read. More
than ``LANGUAGES`` different values of the language are refused.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.text import BASE, BASE_INVERSE, buffers, chunks, mixed, powers, table
from millrace.scratch import materialise

SIZES = (1, 2, 3, 4)
LANGUAGES = 1 << 10
SAMPLE_DOCS = 20_000  # a language
RARE = 1e-6
DOMINANCE = 8.0
SMOOTH = 1_000.0  # n-grams added to a language's total, so that one text does not make rates
PROBES = 3
SLOTS_EACH = 8  # rows of the table for each n-gram of the language with most
TABLE_BYTES = 1 << 26
BLOCK_ROWS = 1 << 14
CHUNK = 1 << 22  # bytes of text whose words are looked up at once
FLUSH = 1 << 22
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """The lower-case form of every letter and mark, 0 for other characters; and which are letters."""
    code, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LM":
            low = chr(i).lower()
            code[i], letter[i] = ord(low) if len(low) == 1 else i, kind == "L"
    return code, letter


def characters(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows, and the first of each row; bytes that are no UTF-8 become replacement characters."""
    raw, off = buffers(col)
    try:
        whole = raw.tobytes().decode()
    except UnicodeDecodeError:
        rows = [t.decode("utf-8", "replace") for t in col.to_pylist()]
        return (np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32),
                np.concatenate([[0], np.cumsum([len(t) for t in rows])]).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return np.frombuffer(whole.encode("utf-32-le"), np.uint32), starts[off]


@dataclass
class LetterWords:
    """The words of a batch: code points of all, and where each begins; ``edge[d]`` is the first word of row d."""
    seq: np.ndarray
    first: np.ndarray
    edge: np.ndarray
    has_letter: np.ndarray

    def hashes(self) -> np.ndarray:
        """64 bits that tell words apart."""
        n = len(self.seq)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(self.seq.astype(np.uint64)) * powers(BASE, n)[:n], out=sums[1:])
        return mixed((sums[self.first[1:]] - sums[self.first[:-1]]) * powers(BASE_INVERSE, n)[self.first[:-1]])

    def chosen(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points and beginnings of some words, one behind the other."""
        size = np.diff(self.first)[some]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(self.first[some] - first[:-1], size)
        return self.seq[at], first


def words_of(col: pa.Array) -> LetterWords:
    code, letter = alphabet()
    points, off = characters(col)
    low = code[points]
    word = np.concatenate([[False], low != 0, [False]])
    edge = np.zeros(len(points) + 1, bool)
    edge[off] = True
    begin = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
    first = np.cumsum(word[1:-1])[begin] - 1  # places among the letters alone
    seen = np.concatenate([[0], np.cumsum(letter[points])])
    return LetterWords(low[low != 0], np.append(first, int(word.sum())), np.searchsorted(begin, off), np.diff(seen[off]) > 0)


def ngrams(seq: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the n-grams of all words with the number of their word, in order.

    An n-gram is a number of 54 bits, the lowest three its size.
    """
    size = np.diff(first)
    word = np.append(np.repeat(np.arange(len(size)), size + 1), len(size))
    marked = np.zeros(len(seq) + len(size) + 1, np.uint64)  # a mark before every word and at the end
    marked[np.arange(len(seq)) + np.repeat(np.arange(len(size)), size) + 1] = seq
    for n in SIZES:
        m = max(0, len(marked) - n + 1)
        inner = marked[:m] != 0 if n == 1 else np.ones(m, bool)
        for k in range(1, n - 1):
            inner &= marked[k: k + m] != 0
        at = np.flatnonzero(inner) if n != 2 else np.arange(m)
        key = marked[at]
        for k in range(1, n):
            key = key * np.uint64(0x9E3779B97F4A7C15) + marked[at + k]
        yield (mixed(key + np.uint64(n)) >> np.uint64(13) << np.uint64(3)) | np.uint64(n), word[at]


def places(gram: np.ndarray, rows: int) -> list[np.ndarray]:
    """The table rows of n-grams; rows is a power of two."""
    h = mixed(gram)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64(rows - 1)).astype(np.int64) for k in range(PROBES)]


@dataclass
class Model:
    """Names in order of the mask's bits, the table (rows x bytes of the mask), and each language's false-positive rate."""
    names: list[str] = field(default_factory=list)
    bits: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.uint8))
    false: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """All languages containing each n-gram, as bytes of bits."""
        first, *more = places(gram, len(self.bits))
        out = self.bits[first]
        for p in more:
            out &= self.bits[p]
        return out

    def hits(self, seq: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word how many n-grams each language seems to contain, and how many there are."""
        words, width = len(first) - 1, self.bits.shape[1]
        hits, n = np.zeros((words, 8 * width), np.int32), np.zeros(words, np.int64)
        for gram, own in ngrams(seq, first):
            edge = np.searchsorted(own, np.arange(words + 1))
            n += np.diff(edge)
            masks = self.masks(gram)
            for byte in range(width):
                sums = np.zeros((len(gram) + 1, 8), np.int32)
                np.cumsum(np.unpackbits(masks[:, byte: byte + 1], axis=1, bitorder="little"), axis=0, out=sums[1:])
                hits[:, 8 * byte: 8 * byte + 8] += np.diff(sums[edge], axis=0)
        return hits[:, : len(self.names)], n

    def corrected(self, hits: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Number of n-grams that each language contains, without those that only seem so."""
        return np.maximum(0.0, hits - self.false * n[:, None]) / np.maximum(1e-9, 1.0 - self.false)

    def counts(self, words: LetterWords) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts and number of n-grams of each row; each different word is looked up once."""
        _, some, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        hits, n = self.hits(*words.chosen(some))
        rows = len(words.edge) - 1
        total = np.concatenate([[0], np.cumsum(n[which])])
        found = np.zeros((rows, len(self.names)))
        for k in range(len(self.names)):
            sums = np.concatenate([[0], np.cumsum(hits[which, k], dtype=np.int64)])
            found[:, k] = np.diff(sums[words.edge])
        total = np.diff(total[words.edge])
        return self.corrected(found, total), total


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def counted(rows: DataFrame) -> DataFrame:
    """(key, n) of (language number, text) rows: key is n-gram * LANGUAGES + language; one row a key and flush."""

    def run(batches):
        held, size = [], 0

        def summed():
            keys, n = (np.concatenate(c) for c in zip(*held))
            held.clear()
            key, where = np.unique(keys, return_inverse=True)
            return key, np.bincount(where, weights=n, minlength=len(key)).astype(np.int64)

        for batch, col in chunks(batches, size=CHUNK):
            words = words_of(col)
            lang = np.repeat(batch.column(batch.schema.get_field_index("lang")).to_numpy().astype(np.uint64), np.diff(words.edge))
            # each different word of a language once, with its number
            _, some, times = np.unique(words.hashes() + mixed(lang + np.uint64(1)), return_index=True, return_counts=True)
            for gram, own in ngrams(*words.chosen(some)):
                key, where = np.unique(gram * np.uint64(LANGUAGES) + lang[some][own], return_inverse=True)
                held.append((key, np.bincount(where, weights=times[own], minlength=len(key)).astype(np.int64)))
                size += len(key)
            if size > FLUSH:
                held.append(summed())
                size = len(held[-1][0])
                if size > FLUSH // 2:
                    key, n = held.pop()
                    size = 0
                    yield table("key long, n long", [key.view(np.int64), n])
        if held:
            key, n = summed()
            yield table("key long, n long", [key.view(np.int64), n])

    return rows.mapInArrow(run, "key long, n long")


def contained(counts: DataFrame) -> DataFrame:
    """(gram, lang) of the n-grams that languages contain, from (key, n)."""
    sums = materialise(counts.groupBy("key").agg(F.sum("n").alias("n"))
                       .select(F.shiftrightunsigned("key", 10).alias("gram"), F.col("key").bitwiseAND(F.lit(LANGUAGES - 1)).alias("lang"), "n"), "ngrams")
    sums = sums.withColumn("size", F.col("gram").bitwiseAND(F.lit(7)))
    totals = materialise(sums.groupBy("lang", "size").agg(F.sum("n").alias("total")), "totals")  # 4 rows a language
    rated = sums.join(totals, ["lang", "size"]).withColumn("rate", F.col("n") / (F.col("total") + SMOOTH))
    rated = rated.filter(F.col("n") >= F.col("total") * RARE).withColumn("top", F.max("rate").over(W.partitionBy("gram")))
    return materialise(rated.filter(F.col("rate") * DOMINANCE >= F.col("top")).select("gram", "lang"), "contained")


def filled(grams: DataFrame, languages: int) -> np.ndarray:
    """The table: rows of masks, set in Spark by blocks of rows."""
    width = (languages + 7) // 8
    most = grams.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    rows = BLOCK_ROWS
    while rows < SLOTS_EACH * most and 2 * rows * width <= TABLE_BYTES:
        rows *= 2

    def spread(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            gram, lang = batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy()
            at = np.concatenate(places(gram, rows))
            yield table("block long, place long, lang long", [at // BLOCK_ROWS, at % BLOCK_ROWS, np.tile(lang, PROBES)])

    def set_bits(part: pa.Table) -> pa.Table:
        block = np.zeros((BLOCK_ROWS, width), np.uint8)
        place, lang = part.column("place").to_numpy(), part.column("lang").to_numpy()
        np.bitwise_or.at(block, (place, lang // 8), (1 << (lang % 8)).astype(np.uint8))
        return pa.table({"block": part.column("block").slice(0, 1), "bits": pa.array([block.tobytes()], pa.binary())})

    one = grams.select("gram", "lang").mapInArrow(spread, "block long, place long, lang long").distinct()  # at most a table's bits
    out = np.zeros((rows, width), np.uint8)
    for block, bits in one.groupBy("block").applyInArrow(set_bits, "block long, bits binary").collect():
        out[block * BLOCK_ROWS: (block + 1) * BLOCK_ROWS] = np.frombuffer(bits, np.uint8).reshape(BLOCK_ROWS, width)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> Model:
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("name"))
    src = src.filter(F.col("text").isNotNull() & F.col("name").isNotNull() & (fold(F.col("doc_id")) != 0))
    kinds = src.groupBy("name").count().limit(LANGUAGES + 1).collect()
    if len(kinds) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different languages")
    if not kinds:
        return Model()
    kinds.sort(key=lambda r: (-r["count"], r["name"]))
    names = [r["name"] for r in kinds]
    number = F.create_map(*[F.lit(x) for i, v in enumerate(names) for x in (v, i)])
    share = F.create_map(*[F.lit(x) for r in kinds for x in (r["name"], int((1 << 30) * min(1.0, sample / r["count"])))])
    chosen = src.filter(F.pmod(F.xxhash64("doc_id", "name"), F.lit(1 << 30)) < F.element_at(share, F.col("name")))
    grams = contained(counted(chosen.select(F.element_at(number, F.col("name")).cast("long").alias("lang"), "text")))
    bits = filled(grams, len(names))
    ones = np.concatenate([np.unpackbits(bits[:, b: b + 1], axis=1, bitorder="little").mean(axis=0) for b in range(bits.shape[1])])
    return Model(names, bits, ones[: len(names)] ** PROBES)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_grams, second) per row.

    ``score`` is the decided language's corrected count as a share of its and the runner-up's; ``second`` names the runner-up.
    """
    schema = "lang_pred string, score double, n_grams long, second string"
    spread = docs.sparkSession.sparkContext.broadcast(model)  # TABLE_BYTES at most
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        own = spread.value
        names = np.array([*own.names, UNKNOWN], object)
        for batch, col in chunks(batches, size=CHUNK):
            words = words_of(col)
            has, rows, n = words.has_letter, len(col), len(own.names)
            found, seen = own.counts(words)
            total = np.zeros((rows, max(n, 1)))
            total[:, :n] = found
            order = np.argsort(-total, axis=1, kind="stable")
            at = np.arange(rows)
            best = np.where(has & (n > 0), order[:, 0], n)
            other = np.where(has & (n > 1), order[:, 1 if n > 1 else 0], n)
            top, next_ = total[at, order[:, 0]], np.where(other < n, total[at, np.minimum(other, max(n, 1) - 1)], 0.0)
            score = np.where(has & (top > 0), top / np.maximum(top + next_, 1e-9), 0.0)
            out = table(schema, [names[best].tolist(), score, seen, [None if i == n else names[i] for i in other.tolist()]])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", "lang_pred", "score", "n_grams", "second"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")
