"""Periodic runs: suffix trees, regions and whole rows against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import runs
from millrace.llm.queries import QUERIES
from millrace.llm.text import Words, buffers, separators
from tests.llm.test_llm_spark import ODD, SF, by_id, odd  # noqa: F401


def brute(w, least=runs.LEAST, exponent=runs.EXPONENT):
    """All runs by comparing the sequence with itself moved by each period."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            own = w[i:i + length]
            if length >= max(least, exponent * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda t: (t[0], t[2]))


def sequences(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        k, w = rng.choice([1, 2, 2, 3, 5]), []
        for _ in range(rng.randint(0, 6)):
            w += [rng.randint(1, k) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)
            w += [rng.randint(1, k) for _ in range(rng.randint(0, 4))]
        yield w


def test_runs_of_small_sequences():
    for w in sequences(600, 1):
        assert list(map(tuple, runs.runs_of(np.array(w, np.int64)).tolist())) == brute(w)


@pytest.mark.parametrize("least,exponent", [(6, 4), (4, 3), (9, 5)])
def test_regions_hold_every_run(least, exponent):
    for w in sequences(300, 2):
        text = b" ".join(b"w%d" % x for x in w)
        docs = [text, b"", text + b" z " + text, b" a\tb\n", b"q " + text[::-1]]
        words = Words(*buffers(pa.array(docs, pa.large_binary())), separators(), lower=False)
        found = {d: [] for d in range(len(docs))}
        for a, b in runs.regions(words.hashes, words.first, least, exponent):
            d = int(np.searchsorted(words.first, a, "right")) - 1
            assert b <= words.first[d + 1]
            first = int(words.first[d])
            found[d] += map(tuple, runs.runs_in(docs[d].split(), a - first, b - first, least, exponent).tolist())
        for d, text in enumerate(docs):
            assert found[d] == brute(text.split(), least, exponent)
    with pytest.raises(ValueError):
        runs.regions(words.hashes, words.first, 4, 2)


def test_suffix_tree_extensions():
    rng = random.Random(3)
    w = [rng.randint(1, 3) for _ in range(300)]
    common = runs.Extensions(runs.SuffixTree(w))
    i, j = np.array([rng.randrange(300) for _ in range(500)]), np.array([rng.randrange(301) for _ in range(500)])
    i, j = i[i != j], j[i != j]
    for a, b, c in zip(i.tolist(), j.tolist(), common(i, j).tolist()):
        n = 0
        while max(a, b) + n < 300 and w[a + n] == w[b + n]:
            n += 1
        assert c == n


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def check(row, doc_id, text, all_runs):
    words = expected(doc_id, text)
    best = min(all_runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    assert row.n_runs == len(all_runs) and row.n_words == len(words)
    if best is None:
        assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
    else:
        assert (row.start, row.length, row.period, row.exponent_milli) == (*best, 1000 * best[1] // best[2])
    gone = {i for s, n, q in all_runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in all_runs)
    assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
    assert row.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()


def test_odd_rows(odd):  # noqa: F811
    got = by_id(runs.digests(runs.find(odd, seed=runs.repeated_tail)))
    assert sum(map(len, got.values())) == len(ODD)
    check(got[1][0], 1, None, [])
    check(got[2][0], 2, "", [])
    check(got[None][0], None, ODD[8][1], [])
    assert (got[4][0].n_runs, got[4][0].length, got[4][0].period) == (1, 60_000, 3)
    assert len(got[7]) == 2 and got[7][0] == got[7][1]


def test_empty_table_and_collapse(spark, odd):  # noqa: F811
    assert runs.digests(runs.find(odd.limit(0))).count() == 0
    docs = spark.createDataFrame([(1, "go " * 9 + "home"), (2, "a b a b a b a b a c")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in runs.collapse(docs).collect()} == {1: "go home", 2: "a b c"}


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    some = 0
    for row in rows:
        words = expected(row.doc_id, docs[row.doc_id])
        number = {}
        coded = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        n, found = len(coded), []
        for q in range(1, n // 4 + 1):  # as brute(), a period at a time
            same = np.concatenate([[False], coded[:-q] == coded[q:], [False]])
            edge = np.flatnonzero(same[1:] != same[:-1])
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                own = words[a:b + q]
                if b + q - a >= max(6, 4 * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                    found.append((a, b + q - a, q))
        found.sort(key=lambda t: (t[0], t[2]))
        some += bool(found)
        check(row, row.doc_id, docs[row.doc_id], found)
    assert some >= 5
