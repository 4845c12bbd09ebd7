"""Two tokenizers' tokens of the same text, cut into groups at the byte offsets where tokens of both end, and how often ids are linked.

The text is encoded with a space before it: by a byte-level BPE (A, library ``tokenizers``) and by a piece model with byte fallback (B, library
``sentencepiece``, which adds the space itself). The character offsets of A and the spans in B's immutable proto are coarse cuts. A token whose
span is not as long as its decoded bytes (a part of a character of several bytes, a fallback byte, the added space) ends where its decoded bytes end,
counted from the last token before it that needs no such step. A text whose decoded bytes are not the text itself has no tokens.

Both tokenizers work unit by unit: a unit begins with a space behind another character than white space, or with a line end between two such characters.
No token of either crosses the place before a unit: A's pattern has no match with white space after another character, and no piece of
B has a space or line end behind another character (checked when the model is read; ``whole_text`` in the tests encodes without units). So
groups lie within units, and the units met before are looked up.

An id pair's count is the number of documents that hold it linked. The pairs grow with the corpus and are neither gathered nor broadcast:
documents are put in blocks of about ``BLOCK_BYTES`` of text, a block asks for its different pairs once, and the answers are brought to the block. Within a
group links are counted by distinct ids with their numbers, not listed one by one.

Odd input: null and empty texts have no tokens; null ids are kept, and each row counts as a document, so a repeated row counts again; an empty table
gives an empty result; only the named columns are read. Memory grows with the block, or with one longer text.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import chunks, table
from millrace.scratch import materialise, scratch_path

CHUNK = 1 << 21  # bytes of text whose units are looked up at once
BATCH_CHARS = 1 << 16  # of new units encoded at once
UNITS_KEPT = 1 << 18  # in each of two generations
LONGEST_KEPT = 80  # characters of a unit that is remembered
BLOCK_BYTES = 1 << 24
LISTED = 1 << 12  # links of a group that are listed before they are counted
UNIT = re.compile(r"(?<=\S)( |\n(?=\S))")
ONE = b"\x01\0\0\0"  # as a little-endian 32-bit number
ANCHOR = " a"  # encoded before every batch, so that the space which B adds is not one of a unit


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


@dataclass
class Pair:
    """Both tokenizers with the decoded bytes of their ids."""
    a: object
    b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    size_a: np.ndarray
    size_b: np.ndarray
    digits: list[bytes]
    young: dict
    old: dict


@functools.lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> Pair:
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    alphabet = byte_alphabet()
    names = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
    bytes_a = [bytes(alphabet.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    normal = [p for i, p in enumerate(pieces) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))]
    if any("▁" in p.lstrip("▁") or "\n" in p for p in normal):
        raise ValueError("a piece with a space or line end behind another character")
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    sizes = [np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b)]
    if len(bytes_a) * len(bytes_b) >= 1 << 32:
        raise ValueError("pairs of ids do not fit 32 bits")
    return Pair(a, b, bytes_a, bytes_b, *sizes, [b"%d" % i for i in range(max(len(bytes_a), len(bytes_b)))], {}, {})


def refined(start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the span's end where the span is as long as the decoded bytes, else counted on from the last such token."""
    sure = end - start == size
    sums = np.cumsum(size)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(size)), -1))
    base = np.where(last >= 0, end[last] - sums[last], 0)
    return base + sums


def encoded_a(pair: Pair, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and byte ends of A's tokens of a text that begins with its space."""
    enc = pair.a.encode(text, add_special_tokens=False)
    ids = np.array(enc.ids, np.int64)
    spans = np.fromiter(chain.from_iterable(enc.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
    if not text.isascii():
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        wide = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        spans = np.concatenate([[0], np.cumsum(wide)])[spans]
    return ids, refined(spans[:, 0], spans[:, 1], pair.size_a[ids])


def encoded_b(pair: Pair, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and byte ends of B's tokens of a text that begins with the space B adds."""
    proto = pair.b.encode(text[1:], return_type="proto")
    got = np.fromiter((v for p in proto.pieces for v in (p.id, p.begin, p.end)), np.int64, 3 * len(proto.pieces)).reshape(-1, 3)
    ids = got[:, 0]
    return ids, refined(got[:, 1] + 1, got[:, 2] + 1, pair.size_b[ids])


def links(ids_a: np.ndarray, ids_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, unit: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unit << 32 | pair, sorted, and how many links each has; groups g are ids_a[first_a[g]:first_a[g + 1]] and so for b."""
    n_a, n_b = np.diff(first_a), np.diff(first_b)
    few = n_a * n_b <= LISTED
    g = np.flatnonzero(few)
    n = (n_a * n_b)[g]
    own = np.repeat(g, n)
    k = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    keys = [unit[own] << 32 | ids_a[first_a[own] + k // n_b[own]] * vocabulary + ids_b[first_b[own] + k % n_b[own]]]
    times = [np.ones(len(own), np.int64)]
    for g in np.flatnonzero(~few).tolist():
        a, many_a = np.unique(ids_a[first_a[g]: first_a[g + 1]], return_counts=True)
        b, many_b = np.unique(ids_b[first_b[g]: first_b[g + 1]], return_counts=True)
        keys.append(unit[g] << 32 | (a[:, None] * vocabulary + b).ravel())
        times.append((many_a[:, None] * many_b).ravel())
    return summed(np.concatenate(keys), np.concatenate(times))


def summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their numbers."""
    if not len(key):
        return key, times
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(times[order], first)


def aligned(pair: Pair, units: list[str]) -> list[tuple | None]:
    """For each unit (tokens of A, of B, groups, links, the groups as text, distinct pairs, links of each or nothing if it is one); None if bytes differ.

    The units are encoded as one text; if they do not come out as units there, each is encoded alone.
    """
    text = ANCHOR + "".join(units)
    raw = text.encode()
    if len(units) > 1 and "▁" in text:  # B takes it for a space
        return [x for u in units for x in aligned(pair, [u])]
    (ids_a, end_a), (ids_b, end_b) = encoded_a(pair, text), encoded_b(pair, text)
    edge = np.cumsum([len(ANCHOR), *[len(u) if u.isascii() else len(u.encode()) for u in units]])
    same = (b"".join([pair.bytes_a[i] for i in ids_a.tolist()]) == raw and b"".join([pair.bytes_b[i] for i in ids_b.tolist()]) == raw
            and np.isin(edge, end_a).all() and np.isin(edge, end_b).all())
    if not same:
        return [None] if len(units) == 1 else [x for u in units for x in aligned(pair, [u])]
    skip_a, skip_b = np.searchsorted(end_a, edge[0], "right"), np.searchsorted(end_b, edge[0], "right")
    ids_a, end_a, ids_b, end_b = ids_a[skip_a:], end_a[skip_a:], ids_b[skip_b:], end_b[skip_b:]
    cut = np.intersect1d(end_a, end_b, assume_unique=True)
    first_a = np.concatenate([[0], np.searchsorted(end_a, cut, "right")])
    first_b = np.concatenate([[0], np.searchsorted(end_b, cut, "right")])
    unit = np.searchsorted(edge[1:], cut, "left")
    vocabulary = len(pair.bytes_b)
    key, times = links(ids_a, ids_b, first_a, first_b, unit, vocabulary)
    digits = pair.digits
    text_a, text_b = [digits[i] for i in ids_a.tolist()], [digits[i] for i in ids_b.tolist()]
    fa, fb = first_a.tolist(), first_b.tolist()
    group = [(text_a[fa[g]] if fa[g + 1] - fa[g] == 1 else b",".join(text_a[fa[g]: fa[g + 1]])) + b"|"
             + (text_b[fb[g]] if fb[g + 1] - fb[g] == 1 else b",".join(text_b[fb[g]: fb[g + 1]])) for g in range(len(cut))]
    groups = np.searchsorted(unit, np.arange(len(units) + 1)).tolist()
    per_unit = np.searchsorted(key >> 32, np.arange(len(units) + 1)).tolist()
    many = np.concatenate([[0], np.cumsum(np.diff(first_a) * np.diff(first_b))]).tolist()
    pairs, times = (key & 0xFFFFFFFF).astype("<u4"), times.astype("<u4")
    more = np.concatenate([[0], np.cumsum(times > 1)])[per_unit].tolist()
    out = []
    for u in range(len(units)):
        a, b, x, y = groups[u], groups[u + 1], per_unit[u], per_unit[u + 1]
        out.append((fa[b] - fa[a], fb[b] - fb[a], b - a, many[b] - many[a], b";".join(group[a:b]), pairs[x:y].tobytes(),
                    times[x:y].tobytes() if more[u + 1] > more[u] else b""))
    return out


def units_of(text: str) -> list[str]:
    """The text behind its added space, cut where no token of either tokenizer crosses."""
    parts = UNIT.split(text)
    return [" " + parts[0], *map(str.__add__, parts[1::2], parts[2::2])]


def looked_up(pair: Pair, wanted: set[str]) -> dict[str, tuple | None]:
    """Alignments of units, from the two generations of remembered ones or made now."""
    now, new = {}, []
    young, old = pair.young, pair.old
    for u in wanted:
        got = young.get(u, False)
        if got is False:
            got = old.get(u, False)
            if got is False:
                new.append(u)
                continue
            young[u] = got
        now[u] = got
    batch, size = [], 0

    def flush():
        for u, got in zip(batch, aligned(pair, batch)):
            now[u] = got
            if len(u) <= LONGEST_KEPT:
                young[u] = got
        batch.clear()

    for u in new:
        if u[-1].isspace():  # white space of the next unit would join it
            now[u] = aligned(pair, [u])[0]
            continue
        batch.append(u)
        size += len(u)
        if size > BATCH_CHARS:
            flush()
            size = 0
    if batch:
        flush()
    if len(young) > UNITS_KEPT:
        pair.old, pair.young = young, {}
    return now


def varints(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in as many bytes of seven bits as each needs, the lowest first; and where each ends."""
    x = x.astype(np.uint64)
    size = 1 + sum((x >> np.uint64(7 * k) > 0).astype(np.int64) for k in range(1, 10))
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        some = size > k
        part = (x[some] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8)
        out[(end - size)[some] + k] = part | np.where(size[some] > k + 1, 128, 0).astype(np.uint8)
    return out, end


def numbers(raw: bytes) -> np.ndarray:
    """What ``varints`` wrote."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    end = np.flatnonzero(b < 128)
    first = np.concatenate([[0], end[:-1] + 1])
    place = np.arange(len(b)) - np.repeat(first, end - first + 1)
    return np.add.reduceat((b & 127).astype(np.int64) << (7 * place), first)


def texts_aligned(pair: Pair, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of A, of B, groups, links, the groups as text) of each text; and (text number, pair, links) of all, by text and pair."""
    split = [units_of(t) if t else [] for t in texts]
    known = looked_up(pair, set().union(*split))
    without = {u for u, got in known.items() if got is None}
    rows, rows_of, pairs, times = [], [], [], []
    for d, units in enumerate(split):
        if not units or without and not without.isdisjoint(units):
            rows.append((0, 0, 0, 0, b""))
            continue
        a, b, g, l, text, p, t = zip(*map(known.__getitem__, units))
        rows.append((sum(a), sum(b), sum(g), sum(l), b";".join(text)))
        pairs.append(np.frombuffer(b"".join(p), "<u4"))
        if any(t):
            times.append(np.frombuffer(b"".join([n or ONE * (len(x) // 4) for n, x in zip(t, p)]), "<u4"))
        else:
            times.append(np.ones(len(pairs[-1]), np.uint32))
        rows_of.append(d)
    if not pairs:
        none = np.zeros(0, np.int64)
        return rows, none, none, none
    key = np.repeat(np.array(rows_of, np.int64), [len(p) for p in pairs]) << 32 | np.concatenate(pairs)
    key, n = summed(key, np.concatenate(times).astype(np.int64))
    return rows, key >> 32, key & 0xFFFFFFFF, n


SCHEMA = "block long, kind string, n_a long, n_b long, n_groups long, n_links long, groups binary, pairs binary, times binary"


def blocked(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """A row per document (kind doc) with its pairs as places in its block's list, and one per block (kind block) with that list.

    ``groups`` is the text of the groups, or its SHA-256 digest.
    """
    import hashlib
    kind = docs.schema["doc_id"].dataType
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        from pyspark import TaskContext
        pair = tokenizers_of(path_a, path_b)
        number, ids, rows, held, size = 0, [], [], [], 0
        task = TaskContext.get().partitionId() << 32  # blocks lie within a partition of the scan

        def closed():
            block = task + number
            own, pairs, times = (np.concatenate([h[k] for h in held]) for k in range(3))
            every, at, n = np.unique(pairs, return_inverse=True, return_counts=True)
            first = np.searchsorted(own, np.arange(len(rows) + 1))
            step = np.diff(at, prepend=0)
            starts = first[:-1][first[1:] > first[:-1]]
            step[starts] = at[starts]
            packed = []
            for x in (step, times):
                out, end = varints(x)
                edge = np.concatenate([[0], end])[first]
                packed.append([out[i:j].tobytes() for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())])
            cols = [list(c) for c in zip(*rows)]
            many = len(rows)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *table(SCHEMA, [
                [block] * many, ["doc"] * many, *cols, *packed]).columns], ["doc_id", *names])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, ids[0].type), *table(SCHEMA, [
                [block], ["block"], [0], [0], [0], [0], [b""], [varints(np.diff(every, prepend=0))[0].tobytes()], [varints(n)[0].tobytes()]]).columns], ["doc_id", *names])

        for batch, col in chunks(batches, size=CHUNK):
            texts = [t.decode("utf-8", "replace") for t in col.to_pylist()]
            got, own, pairs, times = texts_aligned(pair, texts)
            if digest:
                got = [(*g[:4], hashlib.sha256(g[4]).hexdigest().encode() if g[2] else b"") for g in got]
            held.append((own + len(rows), pairs, times))
            rows += got
            ids.append(batch.column(0))
            size += sum(map(len, texts)) + 64 * len(texts)
            if size >= BLOCK_BYTES:
                yield from closed()
                number += 1
                ids, rows, held, size = [], [], [], 0
        if rows:
            yield from closed()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, {SCHEMA}")


def asked(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): the pairs that documents of a block hold, and in how many of them."""

    def run(batches):
        for batch in batches:
            for block, pairs, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                pairs, n = np.cumsum(numbers(pairs)), numbers(n)
                for k in range(0, len(pairs), 100_000):
                    part = slice(k, k + 100_000)
                    yield table("block long, pair long, n long", [np.full(len(pairs[part]), block), pairs[part], n[part]])

    return blocks.select("block", "pairs", "times").mapInArrow(run, "block long, pair long, n long")


def tallied(each: DataFrame, vocabulary: int) -> tuple[DataFrame, DataFrame]:
    """(a, pair, count): documents that hold each pair; and (a, top): the highest count of each id of A, one row an id of the vocabulary."""
    counts = materialise(each.groupBy("pair").agg(F.sum("n").alias("count"))
                         .select(F.expr(f"pair div {vocabulary}").alias("a"), "pair", "count"), "counts")
    return counts, materialise(counts.groupBy("a").agg(F.max("count").alias("top")), "tops")


def pair_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n): in how many rows each pair of ids is linked, the table that maps one vocabulary to the other."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary = len(tokenizers_of(path_a, path_b).bytes_b)
    made = materialise(blocked(src, path_a, path_b, True).filter("kind = 'block'").select("block", "pairs", "times"), "blocks")
    return (asked(made).groupBy("pair").agg(F.sum("n").alias("n"))
            .select(F.expr(f"pair div {vocabulary}").alias("a"), F.expr(f"pair % {vocabulary}").alias("b"), "n"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row.

    ``groups`` are the ids "a1,a2|b1;a3|b2" in order as bytes, or with ``digest`` the hexadecimal SHA-256 of that. ``n_best`` counts the links whose
    pair is one of the most frequent of its id of A, ``count_sum`` adds the counts of all links.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    (blocked(src, path_a, path_b, digest).write.partitionBy("kind").option("compression", "zstd").parquet(path))
    made = spark.read.schema(f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {SCHEMA}").parquet(path)
    each = asked(made.filter("kind = 'block'"))
    vocabulary = len(tokenizers_of(path_a, path_b).bytes_b)
    counts, best = tallied(each, vocabulary)
    known = counts.join(best, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = each.join(known, "pair").select("block", "pair", "count", "best")
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups binary"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        count = right.column("count").to_numpy()[order]
        top = right.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        left = left.combine_chunks()
        pairs, times = (left.column(c).to_pylist() for c in ("pairs", "times"))
        step, times = numbers(b"".join(pairs)), numbers(b"".join(times))
        ends = np.cumsum([int((np.frombuffer(p, np.uint8) < 128).sum()) for p in pairs])
        first = np.concatenate([[0], ends])
        sums = np.concatenate([[0], np.cumsum(step)])
        at = sums[1:] - np.repeat(sums[first[:-1]], np.diff(first))  # places in the block's list, from 0 in each document
        per = [np.diff(np.concatenate([[0], np.cumsum(x[at] * times)])[first]) for x in (top, count)]
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(
            [left.column("doc_id").combine_chunks(), *table(schema, [left.column(c).combine_chunks() for c in ("n_a", "n_b", "n_groups", "n_links")]
                                                            + per + [left.column("groups").combine_chunks()]).columns],
            ["doc_id", *[x.split()[0] for x in schema.split(", ")]])])

    docs_of = made.filter("kind = 'doc'").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
    return docs_of.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, f"doc_id {kind}, {schema}")
