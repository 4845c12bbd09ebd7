"""Byte-level BPE encoding and decoding by a local rank file.

Rules for odd input: a null text is the empty text and has no tokens; a null doc_id is passed through; repeated rows are
encoded each on its own; an empty table gives an empty result; only the two named columns are read, so further columns
may have any name, and where a result column has the name of one it takes its place. The file is read by each Python worker from ``ranks``, a path that exists on every machine.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.text import CHUNK_BYTES, chunks, table

PIECE_CHARS = 1 << 16

# A space after a printable ASCII character: no match of the pattern reaches over the place before it, because only
# white space stands after the first character of a match that begins with white space, and a match that begins
# with something else holds none.
SAFE = re.compile(r"(?<=[!-~]) ")


@functools.lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str):
    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at safe places about every ``size`` characters; a stretch without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start: cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode_text(text: str, ranks: str, pattern: str) -> np.ndarray:
    enc = encoding(ranks, pattern)
    parts = [enc.encode_ordinary(p) for p in pieces(text)]
    return np.array(parts[0] if len(parts) == 1 else [i for p in parts for i in p], "<u4")


def decode_ids(ids: np.ndarray, ranks: str, pattern: str) -> bytes:
    return encoding(ranks, pattern).decode_bytes(ids.tolist())


def with_tokens(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``n_tokens``, ``ids`` (little-endian 32-bit numbers) and ``decoded`` (the bytes those ids stand for).

    A column of ``docs`` that has one of these names is replaced.
    """
    schema = "n_tokens long, ids binary, decoded binary"
    added = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    if text_col in added.names:
        kept = [c for c in docs.columns if c not in added.names]
        return with_tokens(docs.select(*kept, F.col(text_col).alias("_text_")), ranks, pattern, "_text_").drop("_text_")
    docs = docs.drop(*added.names)

    def run(batches):
        for batch, col in chunks(batches, text_col, CHUNK_BYTES):
            ids = [encode_text(t.decode("utf-8", "replace"), ranks, pattern) for t in col.to_pylist()]
            out = table(schema, [[len(x) for x in ids], [x.tobytes() for x in ids],
                                 [decode_ids(x, ranks, pattern) for x in ids]])
            yield pa.RecordBatch.from_arrays([*batch.columns, *out.columns], [*batch.schema.names, *out.schema.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded`` of each row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_tokens(src, ranks, pattern).drop("text")


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` as an array of numbers."""

    def run(batches):
        for batch, col in chunks(batches, "text", CHUNK_BYTES):
            ids = [encode_text(t.decode("utf-8", "replace"), ranks, pattern).astype(np.int32) for t in col.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded`` bytes of an array of ids; a null array is an empty one."""

    def run(batches):
        for batch in batches:
            raw = [decode_ids(np.array(x or [], np.int64), ranks, pattern) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "decoded"])

    src = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, decoded binary")
