"""Periodic runs of words, found with suffix trees.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least ``LEAST`` words and ``EXPONENT``
periods long, that no neighbouring word extends keeping that period. Every run holds a Lyndon word as long as its period, under the
order of the words or under the reverse order, that is the longest Lyndon word at its place. So all runs are found from at most two candidates
a position: Ukkonen's algorithm builds the suffix trees of the words and of their reversal, an Euler tour with a table of range
minima answers the longest common extension of two places in constant time, and each candidate is extended both ways.

Trees are built only where a run can stand. In a run of length L and period q, L - q - 2 >= (3 q - 2) consecutive places (3 at least) see their three
words again within q places; ``regions`` keeps the stretches that meet this, with the words a run can reach beyond them. The test
only leaves out places that no run touches, so the result is that of the trees of the whole text.

Words are the texts between ASCII white space, compared by 64-bit hashes of their bytes for regions and by their bytes in the trees. Odd input: a null,
empty or blank text has no words and no runs; null ids are kept; repeated rows are each treated; an empty table gives an empty
result; only the named columns are read. A text is one row and is handled whole in one task; memory grows with its own words alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import Words, buffers, chunks, grams, mixed, separators, table

LEAST = 6  # words
EXPONENT = 4  # periods
_SPACE = separators()


class SuffixTree:
    """The suffix tree of numbers from 1 on, closed by a mark 0 that is smaller than all."""

    def __init__(self, word: list[int]):
        s = [*word, 0]
        n, k = len(s), max(s) + 1
        start, end, link, to = [0], [0], [0], {}
        leaves = []
        node, edge, along, waiting = 0, 0, 0, 0
        for i, c in enumerate(s):
            waiting += 1
            unlinked = 0
            while waiting:
                if not along:
                    edge = i
                key = node * k + s[edge]
                child = to.get(key)
                if child is None:
                    to[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[child]
                    length = min(end[child], i + 1) - first
                    if along >= length:
                        edge += length
                        along -= length
                        node = child
                        continue
                    if s[first + along] == c:
                        along += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    middle, leaf = len(start), len(start) + 1
                    start += (first, i)
                    end += (first + along, n)
                    link += (0, 0)
                    start[child] = first + along
                    to[key] = middle
                    to[middle * k + c] = leaf
                    to[middle * k + s[first + along]] = child
                    leaves.append(leaf)
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif along:
                    along -= 1
                    edge = i - waiting + 1
        self.n, self.nodes = n, len(start)
        length = np.array(end) - np.array(start)
        edges = np.fromiter(to.keys(), np.int64, len(to))
        child = np.fromiter(to.values(), np.int64, len(to))
        del to
        parent, symbol = np.divmod(edges, k)
        order = np.lexsort((symbol, parent))
        self.child, self.length = child[order], length
        self.first = np.searchsorted(parent[order], np.arange(self.nodes + 1))
        self.suffix = np.full(self.nodes, -1, np.int64)
        self.suffix[leaves] = np.arange(len(leaves))  # leaves are made from the longest suffix on

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths (in words) along the Euler tour, and the place of each suffix's leaf in it."""
        child, first, length = self.child.tolist(), self.first.tolist(), self.length.tolist()
        suffix = self.suffix.tolist()
        depth, depths, place, todo = [0] * self.nodes, [], [0] * self.n, [0]
        while todo:
            at = todo.pop()
            if at < 0:
                depths.append(depth[~at])
                continue
            if suffix[at] >= 0:
                place[suffix[at]] = len(depths)
                depths.append(self.n - suffix[at])
                continue
            below = depth[at]
            for e in range(first[at + 1] - 1, first[at] - 1, -1):
                c = child[e]
                depth[c] = below + length[c]
                todo += (c, ~at)
            todo.pop()  # no return before the first child
        return np.array(depths, np.int32), np.array(place, np.int64)

    def ranks(self, reverse: bool) -> np.ndarray:
        """The rank of each suffix; reversed, larger words come first, yet the end before them all."""
        child, first, suffix = self.child.tolist(), self.first.tolist(), self.suffix.tolist()
        closed = ((self.suffix >= 0) & (self.length == 1)).tolist()  # the edge holds the mark alone
        out, todo, rank = [0] * self.n, [0], 0
        while todo:
            at = todo.pop()
            if suffix[at] >= 0:
                out[suffix[at]] = rank
                rank += 1
                continue
            a, b = first[at], first[at + 1]
            if not reverse:
                todo += child[a:b][::-1]
            elif closed[child[a]]:
                todo += child[a + 1: b]
                todo.append(child[a])
            else:
                todo += child[a:b]
        return np.array(out, np.int64)


class Extensions:
    """Longest common extensions of two places in constant time: minima over a range of the Euler tour."""

    def __init__(self, tree: SuffixTree):
        depths, self.place = tree.tour()
        self.n = tree.n
        self.levels = [depths]
        width = 1
        while 2 * width <= len(depths):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For different places i and j (the end included, where nothing is common)."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp(b - a)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            out[some] = np.minimum(self.levels[k][a[some]], self.levels[k][b[some] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """How far the next smaller rank is: the length of the longest Lyndon word at each place."""
    values, out, held = rank.tolist(), [0] * len(rank), []
    for i, v in enumerate(values):
        while held and values[held[-1]] > v:
            j = held.pop()
            out[j] = i - j
        held.append(i)
    return np.array(out, np.int64)


def runs_of(word: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    n = len(word)
    if n < least:
        return np.zeros((0, 3), np.int64)
    dense = (np.unique(word, return_inverse=True)[1] + 1).tolist()
    tree = SuffixTree(dense)
    ahead = Extensions(tree)
    roots = [next_smaller(tree.ranks(reverse))[:n] for reverse in (False, True)]
    del tree
    behind = Extensions(SuffixTree(dense[::-1]))
    start = np.tile(np.arange(n), 2)
    period = np.concatenate(roots)
    some = start + period <= n - period  # room for a second root
    start, period = start[some], period[some]
    right = ahead(start, start + period)
    # the mirror place of i is n - 1 - i; the words before i are those after n - i there
    left = behind(n - start, n - start - period)
    length = left + period + right
    keep = length >= np.maximum(least, exponent * period)
    return np.unique(np.column_stack([(start - left)[keep], period[keep], length[keep]]), axis=0)[:, [0, 2, 1]]


def shortest_trace(least: int, exponent: int) -> int:
    """The fewest consecutive places of a run that see their three words again one period on."""
    few = min(max(least, exponent * q) - q - 2 for q in range(1, least + 1))
    if exponent < 3 or few < 1:
        raise ValueError("runs need an exponent of 3 and a length of 4 at least")
    return few


def regions(hashes: np.ndarray, first: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int]]:
    """Stretches [a, b) of the words of a batch that hold every run of its rows whole, with a word of context on each side."""
    few = shortest_trace(least, exponent)
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    triple = grams(hashes, 3)
    at = np.arange(len(triple))
    inside = row[: len(triple)] == row[2:] if len(triple) else np.zeros(0, bool)
    at = at[inside]
    if not len(at):
        return []
    key = mixed(triple[inside] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    gap = np.full(len(hashes) + 1, np.iinfo(np.int64).max)
    gap[at[order[:-1][same]]] = at[order[1:][same]] - at[order[:-1][same]]
    good = gap < np.iinfo(np.int64).max
    edge = np.zeros(len(good), bool)
    edge[first] = True
    while True:
        # consecutive good places of one row
        begins = np.flatnonzero(good & (edge | ~np.concatenate([[False], good[:-1]])))
        ends = np.flatnonzero(good & np.concatenate([edge[1:] | ~good[1:], [True]])) + 1
        room = (ends - begins + 2) // (exponent - 1)  # the longest period with so many places
        limit = np.repeat(np.where(ends - begins >= few, room, 0), ends - begins)
        places = np.flatnonzero(good)
        bad = places[gap[places] > limit]
        if not len(bad):
            break
        good[bad] = False
    if not len(begins):
        return []
    a = np.maximum(begins - 1, first[row[begins]])
    b = np.minimum(ends + room + 3, first[row[begins] + 1])
    order = np.argsort(a, kind="stable")
    out: list[tuple[int, int]] = []
    for x, y in zip(a[order].tolist(), b[order].tolist()):
        # a region ends with its row, so stretches of two rows never overlap
        if out and x < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out


def runs_in(words: list[bytes], a: int, b: int, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Runs of words[a:b], in places of the whole list."""
    number: dict[bytes, int] = {}
    coded = np.array([number.setdefault(w, len(number)) for w in words[a:b]], np.int64)
    found = runs_of(coded, least, exponent)
    found[:, 0] += a
    return found


def dropped(found: np.ndarray, n: int) -> np.ndarray:
    """Which words stand in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:n]) > 0


def longest(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the most words; of equal ones that with the smallest start, then period."""
    if not len(found):
        return None
    start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
    return start, length, period


def repeated_tail(doc_id: Column) -> tuple[Column, Column]:
    """(seed, chosen): rows whose crc32 of the id ends in 0 get a periodic tail, the rest stays; a null id is never chosen."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    return F.floor(h / 10).cast("long"), F.coalesce(h % 10 == 0, F.lit(False))


def tail_places(n: int, seed: int) -> np.ndarray:
    """For each word of n the place of the word that stands there once the tail repeats itself."""
    a = seed % n
    p = 1 + (n - a) // (3 + seed % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: Callable[[Column], tuple[Column, Column]] | None = None,
         least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, n_words, n_runs, start, length, period, runs, collapsed) per row.

    ``runs`` has a line "start,length,period" per run; ``collapsed`` are the words outside repetitions joined by one space; start, length
    and period are those of the longest run. ``seed`` gives (seed, chosen) columns of the id, for rows that first get a periodic tail.
    """
    schema = "n_words long, n_runs long, start long, length long, period long, runs string, collapsed binary"
    names = ["n_words", "n_runs", "start", "length", "period", "runs", "collapsed"]
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    number, chosen = seed(F.col("doc_id")) if seed else (F.lit(0).cast("long"), F.lit(False))
    src = src.withColumn("seed", F.coalesce(number, F.lit(0))).withColumn("chosen", chosen)

    def run(batches):
        for batch, col in chunks(batches):
            raw, off = buffers(col)
            words = Words(raw, off, _SPACE, lower=False)
            hashes, first = words.hashes, words.first
            seeds, picked = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            places = {}
            for d in np.flatnonzero(picked).tolist():
                n = int(first[d + 1] - first[d])
                if n:
                    places[d] = tail_places(n, seeds[d])
            if places:
                hashes = hashes.copy()
                for d, at in places.items():
                    own = hashes[first[d]: first[d + 1]]
                    hashes[first[d]: first[d + 1]] = own[at]
            stretches: dict[int, list[tuple[int, int]]] = {}
            for a, b in regions(hashes, first, least, exponent):
                d = int(np.searchsorted(first, a, "right")) - 1
                stretches.setdefault(d, []).append((a - int(first[d]), b - int(first[d])))
            rows = []
            for d, text in enumerate(col):
                own = text.as_py().split()  # bytes are split at ASCII white space
                if d in places:
                    own = [own[i] for i in places[d].tolist()]
                found = [runs_in(own, a, b, least, exponent) for a, b in stretches.get(d, ())]
                found = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                best = longest(found) or (None, None, None)
                left = [own[i] for i in np.flatnonzero(~dropped(found, len(own))).tolist()] if len(found) else own
                rows.append((len(own), len(found), *best, "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist()), b" ".join(left)))
            out = table(schema, [list(c) for c in zip(*rows)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *names])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(doc_id, text): the words of each row without the repetitions of any run."""
    return find(docs, id_col, text_col, **limits).select("doc_id", F.col("collapsed").cast("string").alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The result of ``find`` with ``runs`` and ``collapsed`` as SHA-256 digests and the exponent in thousandths."""
    return found.select("doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"), F.sha2("runs", 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
