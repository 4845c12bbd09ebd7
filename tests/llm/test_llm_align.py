"""Aligned tokens: units, offsets, groups and counts against whole texts encoded plainly."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as vocabularies
import pytest

from millrace.llm import align
from millrace.llm.queries import QUERIES
from tests.llm.test_llm_spark import CLASH, LONG, ODD, SF, by_id, odd  # noqa: F401

A, B = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model")
HARD = ["a", " a", "a ", "  ", "\n", "a\nb", "a \nb", "a\n b", "a\n\nb", "a\t b", "Don't stop", "x  y   z", "é€😀", "日本語 テスト", "नमस्ते दुनिया", "<|endoftext|> <s> <0x41> </s>",
        "▁", "a▁ b", "tab\there", "a  b", "a b \x1c c", "\x00 \x7f", "ﷺ ﬁ", "x" * 300, "12345 678", "a\r\nb", "é ö", "🏳️‍🌈 flag", "​ a​ b", "a\x85 b", "…  – a",
        "ꙮ ༀ 𐍈 \U0001F9FF"]


@pytest.fixture(scope="module")
def pair():
    return align.tokenizers_of(A, B)


def whole_text(pair, text):
    """Groups of (ids of A, ids of B) from the whole text at once, by decoded bytes alone."""
    if not text:
        return []
    full = " " + text
    a = pair.a.encode(full, add_special_tokens=False).ids
    b = pair.b.encode(text)
    ba, bb = [pair.bytes_a[i] for i in a], [pair.bytes_b[i] for i in b]
    if not b"".join(ba) == b"".join(bb) == full.encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = i, j
        while x < len(a) and ends_a[x] <= cut:
            x += 1
        while y < len(b) and ends_b[y] <= cut:
            y += 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return groups


def brute(pair, texts):
    """The contract's columns of all texts."""
    every = [whole_text(pair, t or "") for t in texts]
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in every]
    docs = Counter(p for c in linked for p in c)
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for groups, c in zip(every, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()),
                    sum(n for p, n in c.items() if docs[p] == top[p[0]]), sum(n * docs[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_byte_alphabet_decodes_every_byte(pair):
    text = " " + "".join(map(chr, range(0, 0x250))) + "日€😀"
    ids = pair.a.encode(text, add_special_tokens=False).ids
    assert b"".join(pair.bytes_a[i] for i in ids) == text.encode()


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(["a", "b", "the", " ", " ", "\n", "\t", "é", "日", "😀", ".", "'s", "1", " ", "-", "ß", "　", "ing"]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_units_give_the_tokens_of_the_whole_text(pair):
    texts = [*HARD, *random_texts(400, 1)]
    for text in texts:
        assert "".join(align.units_of(text)) == " " + text
    rows, own, pairs, times = align.texts_aligned(pair, texts)
    for d, (text, row) in enumerate(zip(texts, rows)):
        groups = whole_text(pair, text)
        assert row[4].decode() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups), text
        assert row[:3] == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))
        want = Counter(x * len(pair.bytes_b) + y for a, b in groups for x in a for y in b)
        some = own == d
        assert dict(zip(pairs[some].tolist(), times[some].tolist())) == want and row[3] == sum(want.values())


def test_offsets_refined_by_decoded_bytes(pair):
    for text in [t for t in HARD if "▁" not in t]:
        ids, end = align.encoded_a(pair, " " + text)
        assert end.tolist() == np.cumsum([len(pair.bytes_a[i]) for i in ids]).tolist()
        ids, end = align.encoded_b(pair, " " + text)
        assert end.tolist() == np.cumsum([len(pair.bytes_b[i]) for i in ids]).tolist()


def test_links_listed_and_counted_agree(monkeypatch):
    rng = np.random.RandomState(2)
    a, b = rng.randint(0, 6, 60), rng.randint(0, 5, 50)
    first_a, first_b = np.array([0, 10, 12, 40, 60]), np.array([0, 1, 20, 21, 50])
    unit = np.array([0, 0, 1, 3])
    one = align.links(a, b, first_a, first_b, unit, 7)
    monkeypatch.setattr(align, "LISTED", 20)
    two = align.links(a, b, first_a, first_b, unit, 7)
    want = Counter()
    for g in range(4):
        want.update(int(unit[g]) << 32 | int(x) * 7 + int(y) for x in a[first_a[g]:first_a[g + 1]] for y in b[first_b[g]:first_b[g + 1]])
    for key, times in (one, two):
        assert dict(zip(key.tolist(), times.tolist())) == want and (np.diff(key) > 0).all()


def test_varints():
    x = np.array([0, 1, 127, 128, 16383, 16384, 1 << 31, 0, (1 << 32) - 1])
    raw, end = align.varints(x)
    assert align.numbers(raw.tobytes()).tolist() == x.tolist() and end[0] == 1 and end[3] == 5
    assert len(align.numbers(b"")) == 0 and len(align.varints(np.zeros(0, np.int64))[0]) == 0


def test_forgotten_units_do_not_change_results(pair, monkeypatch):
    texts = random_texts(60, 3)
    want = align.texts_aligned(pair, texts)[0]
    monkeypatch.setattr(align, "UNITS_KEPT", 20)
    assert [row for t in texts for row in align.texts_aligned(pair, [t])[0]] == want


def columns(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups.decode() if isinstance(r.groups, (bytes, bytearray)) else r.groups)


@pytest.mark.parametrize("block", [1, 1 << 24])
def test_rows_against_brute_force(spark, pair, monkeypatch, block):
    monkeypatch.setattr(align, "BLOCK_BYTES", block)
    texts = [*HARD, *random_texts(150, 5), None, "", "same words", "same words", LONG[:20_000]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: columns(r) for r in align.align(docs, A, B, digest=True).collect()}
    want = brute(pair, texts)
    assert len(got) == len(texts) and all(got[i] == want[i] for i in range(len(texts)))


def test_pair_counts(spark, pair):
    texts = ["the cat", "the dog", "the cat", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter(p for t in texts for p in {(x, y) for a, b in whole_text(pair, t or "") for x in a for y in b})
    assert {(r.a, r.b): r.n for r in align.pair_counts(docs, A, B).collect()} == want


def test_odd_rows(spark, pair, odd):  # noqa: F811
    got = by_id(align.align(odd, A, B))
    want = brute(pair, [t for _, t in ODD])
    assert sum(map(len, got.values())) == len(ODD)
    for (i, _), w in zip(ODD, want):
        assert columns(got[i][0])[:6] == w[:6]
    assert got[7][0] == got[7][1] and align.align(odd.limit(0), A, B).count() == 0
    clash = spark.createDataFrame([(1, "a b", None, 3)], "doc_id long, text string, block string, n_a int")
    assert align.align(clash, A, B).count() == 1


def test_query_against_brute_force(spark, pair):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    ids = sorted(docs)
    want = dict(zip(ids, brute(pair, [docs[i] for i in ids])))
    rows = QUERIES["op12_tokenizer_alignment"](spark, SF).collect()
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows} == want and len(rows) == len(ids)
