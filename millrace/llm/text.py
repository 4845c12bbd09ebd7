"""Arrow string columns as byte arrays, and words hashed a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # text handled at once; a longer document is a chunk of its own

SPACE = b" \t\n\x0b\x0c\r"
_rng = np.random.RandomState(20)
BYTE_CODES = _rng.randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i up to n; kept for the life of the worker."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, CHUNK_BYTES), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def separators(keep: str = "") -> np.ndarray:
    """Which bytes part words: white space, or with keep="alnum" every other ASCII character too."""
    table = np.zeros(256, bool)
    if keep == "alnum":
        table[:128] = True
        for lo, hi in ((48, 58), (65, 91), (97, 123)):
            table[lo:hi] = False
    else:
        table[list(SPACE)] = True
    return table


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The text column as large_binary, nulls as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col.cast(pa.large_binary()), b"")


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column and the offsets of its rows in them."""
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], name: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The rows again in pieces of about ``size`` bytes of text, whole rows only."""
    for batch in batches:
        col = column(batch, name)
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
        start = 0
        while start < len(col):
            end = max(start + 1, int(np.searchsorted(off, off[start] + size, "right")) - 1)
            yield batch.slice(start, end - start), col.slice(start, end - start)
            start = end


class Words:
    """Words of a batch: ``hashes`` of all, and ``first[d]:first[d + 1]`` those of row d."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, separator: np.ndarray, lower: bool = True):
        self.raw = raw = LOWER[raw] if lower else raw
        n = len(raw)
        apart = np.ones(n + 1, bool)
        apart[:n] = separator[raw]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        word = ~apart[:n]
        before = np.ones(n, bool)
        before[1:] = apart[: n - 1] if n else apart[:0]
        self.start = np.flatnonzero(word & (before | edge[:n]))
        self.end = np.flatnonzero(word & (apart[1:] | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            n = len(self.raw)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE_CODES[self.raw] * powers(BASE, n)[:n], out=sums[1:])
            self._hashes = mixed((sums[self.end] - sums[self.start]) * powers(BASE_INVERSE, n)[self.start])
        return self._hashes

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; a sort is faster here than numpy's table of hashes."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for every n consecutive words (of the whole batch; callers drop those over an edge)."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + hashes[k: len(hashes) - n + 1 + k]
    return mixed(out)


def table(schema: str, columns: list) -> pa.RecordBatch:
    """A record batch from "name type, ..." and one list or array per column."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [pa.array(c, kinds[k]) if not isinstance(c, pa.Array) else c.cast(kinds[k])
              for (_, k), c in zip(fields, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])
