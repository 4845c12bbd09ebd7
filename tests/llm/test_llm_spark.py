"""Operators on Spark: odd input, brute force on small fixtures, SQL, and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, duck
from millrace.llm import bpe, ctw, decontam, fingerprints, licenses, near_dup, pii, quality, toxicity, warc
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20_000
ODD = [(1, None), (2, ""), (3, "   \n "), (4, LONG), (5, "x" * 200_000), (6, "same text here now ok"), (7, "same text here now ok"), (7, "same text here now ok"),
       (None, "a null id with some words in it"), (9, "mail a@b.com +1 (614) 555-8001 or 1.2.3.4"), (10, "one"), (11, "9" * 50_000)]
CLASH = "component_id long, kept string, label int, score double, block long, held_out int, d int, v int, digest string, text_b string, n int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, equal texts, a repeated row, and columns named like the operators' own."""
    rows = [(i, t, None, None, len(t or ""), *[None] * 11) for i, t in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "text here now"), (None, "some words"), (3, None), (4, ""), (5, "lorem"), (1, "words in it")], "item_id long, text string")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r[0], []).append(r)
    return out


def test_pii_odd(odd):
    got = by_id(pii.find(odd, pii.train(lines=300, rounds=3)))
    assert sum(map(len, got.values())) == len(ODD) and got[1][0].spans == got[2][0].spans == "" and len(got[7]) == 2
    assert got[9][0].base == "email:5:12,ip:34:41,phone:13:30" and (got[9][0].n_email, got[9][0].n_card) == (1, 0)
    masked = {r.doc_id: r.text for r in pii.mask(odd, pii.train(lines=300, rounds=3)).collect()}
    assert masked[9] == "mail [EMAIL] [PHONE] or [IP]" and masked[1] is None and masked[4] == LONG


def test_near_duplicates_odd(odd):
    got = by_id(near_dup.near_duplicates(odd))
    assert sum(map(len, got.values())) == len(ODD)
    assert got[1][0].n_shingles == 0 and got[1][0].component_id == 1 and got[2][0].kept
    assert [r.component_id for r in got[7]] == [6, 6] and not got[7][0].kept and got[6][0].kept
    assert got[None][0].component_id is None and got[None][0].kept and got[4][0].n_shingles == 3


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 5, 8, 30, 60, 120]))] for _ in range(25)]
    docs = []
    for t in base:
        for _ in range(rng.randint(1, 12)):
            t2 = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in t]
            docs.append(" ".join(t2))
    rng.shuffle(docs)
    sets = []
    for t in docs:
        w = t.split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    label = list(range(len(docs)))
    moved = True
    while moved:
        moved = False
        for a in range(len(docs)):
            for b in range(a):
                if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    moved = True
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")))
    assert [got[k][0].component_id for k in range(len(docs))] == label
    assert [got[k][0].n_shingles for k in range(len(docs))] == [len(s) for s in sets]


def test_links_missing_from_stars_are_found(spark):
    """A chain: the smallest id is near the middle only, so a star around it misses the far end."""
    w = [f"w{k}" for k in range(200)]
    texts = [" ".join(w[:140]), " ".join(w[18:158]), " ".join(w[36:176])]
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[k][0].component_id for k in range(3)] == [0, 0, 0]
    members = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], "rep long, component long")
    src = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(0, 1), (1, 2)} <= {tuple(r) for r in near_dup.across_components(members, src).collect()}


def test_components_follow_long_paths(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101)]
    got = dict(near_dup.components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_fingerprints_odd_and_brute(spark, odd):
    out = fingerprints.edited_pairs(odd, 4).collect()
    assert len(out) == len(ODD)
    order = sorted(((i, t or "") for i, t in ODD), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, t) in enumerate(order):
        if i == 7 or i == 9:  # the repeated rows around have equal texts, so their order does not matter
            continue
        nxt, third = order[(k + 1) % len(order)][1], len(t) // 3
        row = next(r for r in out if r.doc_id == i)
        assert row.n_chars == len(t) and row.edited_sha256 == hashlib.sha256((t[:len(t) - third] + nxt[:third]).encode()).hexdigest()
    by = {r.doc_id: r for r in out}
    assert by[6].fingerprint == by[7].fingerprint and by[1].fingerprint == by[2].fingerprint and by[7].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd).collect()}
    assert all(plain[r.doc_id] == r.fingerprint for r in out)
    one = fingerprints.edited_pairs(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string"), 4).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1.0


def test_licenses_odd_and_found(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(
        [(50, "Some words.\nLicensed under the Apache License, Version 2.0.\nMore."), (51, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
         (52, "The license of the work is not known.")], "doc_id long, text string"))
    got = by_id(licenses.scan(docs, licenses.train(docs, copies=30)))
    assert got[50][0].licenses == "apache-2.0" and got[51][0].licenses == "cc-by-nc,mit" and got[52][0].licenses == ""
    assert got[1][0].n_paragraphs == 0 and got[4][0].licenses == "" and sum(map(len, got.values())) == len(ODD) + 3


def test_wrapped_and_embedded_notices_are_found(spark):
    bsd = licenses.TEMPLATES["bsd"][0]
    wrapped = bsd.replace("or without ", "or without\n")
    rng = random.Random(6)
    some = lambda n: " ".join("".join(rng.choice("abcdeghil") for _ in range(rng.randint(2, 9))) for _ in range(n))
    notice = "This work is licensed under a Creative Commons\n# Attribution-NonCommercial 4.0\n# International License."
    texts = [wrapped, " * " + wrapped.replace("\n", "\n * "), f"{some(900)} {bsd} {some(900)}", f"{some(20)}\n# {notice}\n{some(20)}",
             notice.split("\n")[0] + "\n\nAttribution to nobody is asked for.", f"{some(300)}\n{some(300)}", f"{some(9)}\n{some(9)}\n//\n{some(9)}\n\n{some(9)}",
             f"{some(500)} {licenses.TEMPLATES['mit'][1]} {notice} {some(500)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.train(docs, copies=30)).collect()}
    assert [got[k].licenses for k in range(8)] == ["bsd", "bsd", "bsd", "cc-by-nc", "", "", "", "cc-by-nc,mit"]
    assert [got[k].n_paragraphs for k in (0, 3, 5, 6)] == [1, 1, 1, 3] and [got[k].n_confirmed for k in (0, 2, 7)] == [1, 1, 2]


def test_licence_sample_holds_texts_and_not_nulls_or_copies(spark, monkeypatch):
    monkeypatch.setattr(licenses, "TRAINING_LINES", 60)
    seen, fit = [], licenses.fitted
    monkeypatch.setattr(licenses, "fitted", lambda lines, *a: seen.extend(t for t, c in lines if c == licenses.NONE) or fit(lines, *a))
    rng = random.Random(4)
    many = ["\n".join("".join(rng.choice("abcdeghil ") for _ in range(30)) for _ in range(10)) for _ in range(300)]
    rows = [(k, None) for k in range(3000)] + [(k, "\n".join(f"copied line {i}" for i in range(200))) for k in range(300)] + list(enumerate(many))
    licenses.train(spark.createDataFrame(rows, "doc_id long, text string"), copies=5)
    assert sum(any(line in t for t in many) for line in seen) >= 5


def test_bpe_odd(odd):
    import public_tokenizers as vocabularies
    ranks, pattern = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN
    clash = odd.select("doc_id", "text", F.lit("x").alias("n_tokens"), F.lit("y").alias("ids"), F.col("text").alias("decoded"))
    for text_col in ("text", "decoded"):
        rows = by_id(bpe.with_tokens(clash, ranks, pattern, text_col))
        assert rows[6][0].n_tokens == len(bpe.encoding(ranks, pattern).encode_ordinary("same text here now ok")) and rows[6][0].text == "same text here now ok"
    got = by_id(bpe.round_trip(odd, ranks, pattern))
    enc = bpe.encoding(ranks, pattern)
    for i, t in ODD:
        r = got[i][0]
        want = enc.encode_ordinary(t or "")
        assert r.n_tokens == len(want) and bytes(r.ids) == b"".join(x.to_bytes(4, "little") for x in want) and bytes(r.decoded) == (t or "").encode()
    back = by_id(bpe.decode(bpe.encode(odd, ranks, pattern), ranks, pattern))
    assert all(bytes(back[i][0].decoded) == (t or "").encode() for i, t in ODD)


def plain_hits(docs, items, length=10):
    words = lambda t: re.findall(decontam.WORD, (t or "").translate(str.maketrans(decontam.UPPER, decontam.LOWER)))
    wins = set()
    for i, t in items:
        w = words(t)
        wins |= {(i, tuple(w[s:s + length])) for s in range(max(1, len(w) - length + 1)) if w}
    out = []
    for i, t in docs:
        w, hit, seen = words(t), set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    seen |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), ",".join(sorted(seen))))
    return out


def test_decontamination_odd(spark, odd, bench):
    small = odd.filter("doc_id IS NULL OR doc_id NOT IN (4, 5, 11)")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"])) for r in decontam.decontaminate(small, bench).collect())
    want = plain_hits([x for x in ODD if x[0] not in (4, 5, 11)], [tuple(r) for r in bench.collect()])
    assert got == sorted((str(i), *rest) for i, *rest in want)
    big = by_id(decontam.decontaminate(odd.filter("doc_id = 4"), bench))
    assert big[4][0].n_hit == 20_000 and big[4][0].n_words == 60_000
    none = decontam.decontaminate(odd, bench.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r.contaminated for r in none)


def test_null_ids_with_equal_short_hashes_stay_apart(spark):
    """Texts whose 32-bit hashes meet are found among many; their rows have null ids."""
    dirty = "exam question one"
    n = spark.range(1).select(F.hash(F.lit(dirty)).alias("h")).first().h
    rows = spark.range(3_000_000).select(F.concat(F.lit("clean words "), F.col("id")).alias("text"))
    texts = [r.text for r in rows.filter(F.hash("text") == n).collect()] or ["clean words 181866"]
    docs = spark.createDataFrame([(None, dirty), *[(None, t) for t in texts], (None, "clean words here")], "doc_id long, text string")
    item = spark.createDataFrame([(1, dirty)], "item_id long, text string")
    got = sorted((r.n_words, r.n_hit, r.contaminated) for r in decontam.decontaminate(docs, item).collect())
    assert got == sorted([(3, 3, True)] + [(3, 0, False)] * (len(texts) + 1))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b x c d e"), (3, "a b x y z c d e"), (4, "e d c b a")], "doc_id long, text string")
    wins = decontam.windows(spark.createDataFrame([(1, "a b c d e")], "item_id long, text string"))
    index = decontam.build_index(decontam.identified(docs, "doc_id", "text"), wins.select(F.explode("terms").alias("term")).distinct())
    assert {r.d for r in decontam.matches(index, wins).collect()} == {1}
    assert {r.d for r in decontam.matches(index, wins, slack=1).collect()} == {1, 2}
    assert {r.d for r in decontam.matches(index, wins, slack=3).collect()} >= {1, 2, 3}


def test_quality_odd(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs)
    got = by_id(quality.judged(odd, model))
    assert sum(map(len, got.values())) == len(ODD) and got[1][0].score == model.prior and got[1][0].kept
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)
    assert quality.accepted(odd, model).columns == odd.columns
    empty = quality.train(odd.limit(0))
    assert quality.judged(odd.limit(0), empty).count() == 0


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    got = [(r.kept, labels[r.doc_id]) for r in quality.judged(docs, quality.train(docs)).collect() if r.doc_id in labels]
    good, bad = [k for k, y in got if y], [k for k, y in got if not y]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def test_quality_sample_holds_texts_and_not_nulls_or_copies(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 100)
    seen = {}
    fit = quality.fitted
    monkeypatch.setattr(quality, "fitted", lambda rows, soft, *n: seen.update(rows=rows, n=n) or fit(rows, soft, *n))
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdeghil") for _ in range(rng.randint(2, 9))) for _ in range(12)) + "." for _ in range(1500)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(k, None) for k in range(6000)] + [(None, "one text with a great many copies.")] * 1500
    quality.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    n = seen["n"][0] if seen["n"] else [1.0] * len(seen["rows"])
    usable = [c for (slots, _), c in zip(seen["rows"], n) if len(slots)]
    assert 35 <= len(usable) <= 70 and len(usable) == len(seen["rows"])  # half of the sample is the text with copies
    assert 80 <= sum(usable) <= 125 and 45 <= max(usable) <= 55


def test_warc_odd(spark):
    rows = [(1, "http://a/b c\r\n", "same"), (5, None, "same"), (3, "u", "same"), (None, "u", "same"), (2, "u", None), (4, "u", ""), (6, "é", "x" * 300_000),
            (7, "u", "ü\r\n\r\nWARC/1.1"), (8, "u", "twice"), (8, "u", "twice"), (None, None, "only null")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    want = Counter()
    for i, _, h in rows:
        h = h or ""
        first = max((p for p, _, t in rows if (t or "") == h and p is not None), default=None)
        response = first is None or i == first
        want[(i, len(h.encode()), warc.sha1(h.encode()), "response" if response else "revisit", None if response else first)] += 1
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0
    named = spark.createDataFrame([("", "u", "a", 1), (None, "u", "b", 2), ("", "u", "c", 3), ("%3E x", "u", "a", 4)], "page_id string, url string, html string, digest int")
    assert Counter((r.page_id, r.refers_to) for r in warc.round_trip(named).collect()) == {("", "%3E x"): 1, (None, None): 1, ("", None): 1, ("%3E x", None): 1}
    small = {r.page_id: r.record_type for r in warc.round_trip(pages.filter("page_id IN (1, 3, 5)"), revisit_from=10).collect()}
    assert set(small.values()) == {"response"}


def test_scores_odd_and_brute(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    words = lambda t: re.findall("[^\x20\x09-\x0d]+", t.translate(str.maketrans(decontam.UPPER, decontam.LOWER)))
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    c, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            c.update(words(t))
            ends += 1
    total, kinds = sum(c.values()) + ends, len(c) + 1
    log = lambda n: math.log10((n + 0.1) / (total + 0.1 * (kinds + 1)))
    want = sorted((str(i), held(i), len(words(t)) + 1, sum(c[w] > 0 for w in words(t)) + 1, total) for i, t in rows)
    got = ctw.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    base = {str(i): sum(log(c[w]) for w in words(t)) + log(ends) for i, t in rows}
    assert all(math.isclose(r.base_score, base[str(r.doc_id)], rel_tol=1e-9) for r in got) and all(r.score < 0 for r in got)
    own = [r for r in got if r.held_out and r.n_tokens > 50]
    assert all(r.bits_per_byte < 4.5 for r in own)
    assert ctw.score(docs.limit(0)).count() == 0


def test_blocks_are_closed_by_bytes(spark, monkeypatch):
    """4,096 long texts do not share a block, and texts without bytes do not fill one without end."""
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 100_000)
    docs = spark.range(4096).selectExpr("id AS doc_id", "repeat('abcdefghi ', 2000) AS text")
    none = spark.range(5000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text")
    for rows, most in ((docs, 6), (none, 100_000 // 64 + 1)):
        got = ctw.blocks(rows.coalesce(2)).groupBy("block").agg(F.count("*").alias("n")).collect()
        assert max(r.n for r in got) <= most and sum(r.n for r in got) == rows.count()
    one = spark.createDataFrame([(1, "x" * 300_000), (2, "y"), (3, "z" * 99_990), (4, None)], "doc_id long, text string").coalesce(1)
    at = {r.doc_id: r.block for r in ctw.blocks(one).collect()}
    assert len({at[1], at[2]}) == 2 and at[2] == at[3] and at[4] != at[3]


def test_the_tree_is_that_of_all_training_texts(spark, monkeypatch):
    """Contexts that only stand far inside a long text, texts longer than the sums kept at once, marks, and held-out rows, which count for nothing."""
    monkeypatch.setattr(ctw, "FLUSH", 3000)
    rng = random.Random(6)
    texts = ["ab c" * 20_000 + "qz qzqx" * 300, "", None, "A", "é" * 9]
    texts += ["".join(rng.choice("aabcde \x00é") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    rows = spark.createDataFrame([(i, t, i % 10 == 7) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean").repartition(5)
    train = [(t or "").encode() for i, t in enumerate(texts) if i % 10 != 7]
    symbol, _ = ctw.symbols_of(*ctw.buffers(ctw.pa.array(train, ctw.pa.large_binary())))
    for nodes, often in ((60, 8), (700, 8), (1 << 15, 8), (1 << 15, 3)):
        got, want = ctw.shape(rows, nodes, often), ctw.grown(symbol, nodes, often=often)
        assert (got.depth == want.depth).all() and (got.parent == want.parent).all() and (got.child == want.child).all()
    assert want.depth.max() == ctw.DEPTH and want.child[0, ord("q")] and want.child[0, ctw.END]


def test_toxicity_odd_and_held_out(spark, odd):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    nulls = spark.createDataFrame([(None, 1, 1), (5, None, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels.union(nulls))
    truth = dict(labels.select("doc_id", "toxic").collect())
    got = [(r.score, truth[r.doc_id]) for r in toxicity.score(docs, model).collect()
           if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    flagged = [y for s, y in got if s >= toxicity.THRESHOLD]
    assert sum(flagged) / len(flagged) > 0.75 and sum(flagged) / sum(y for _, y in got) > 0.75
    strange = by_id(toxicity.score(odd, model))
    assert sum(map(len, strange.values())) == len(ODD) and strange[1][0].score == strange[2][0].score < toxicity.THRESHOLD
    blank = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.score(odd.limit(0), blank).count() == 0 and all(r[0].score < 0.3 for r in by_id(toxicity.score(odd, blank)).values())


def test_votes_are_shared_by_near_copies_and_not_over_a_passage(spark):
    rng = random.Random(2)
    some = lambda n: " ".join("".join(rng.choice("abcdeghil") for _ in range(rng.randint(3, 9))) for _ in range(n))
    passage, long = some(80), some(500)
    texts = [f"{some(30)} {passage} {some(30)}" for _ in range(400)] + [long] * 50 + [f"{long} {long} more"] * 50 + ["few words"] * 9
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "0 AS toxic")
    got = toxicity.with_labels(docs, labels, "doc_id", "text", "toxic", [0, 1, 2, 3]).select("doc_id", "grp").toPandas().set_index("doc_id")["grp"]
    assert got[got.index < 400].nunique() >= 395 and got[got.index >= 400].nunique() == 2  # the doubled text has nearly the same shingles


@pytest.mark.parametrize("run", [
    lambda d, b: near_dup.near_duplicates(d), lambda d, b: pii.find(d, pii.train(lines=300, rounds=3)), lambda d, b: fingerprints.edited_pairs(d, 4),
    lambda d, b: decontam.decontaminate(d, b), lambda d, b: licenses.scan(d, licenses.train(d, copies=10))])
def test_empty_tables(odd, bench, run):
    assert run(odd.limit(0), bench).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(name, QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    import __spark_entry__ as entry
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_pipeline_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    good = quality.accepted(docs, quality.train(docs)).cache()
    texts = {r.doc_id: r.text for r in good.collect()}
    copies = {r.doc_id for r in near_dup.near_duplicates(good).filter("NOT kept").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i, _, hit, _ in plain_hits(sorted(texts.items()), items) if hit}
    assert set(out) == set(texts) - copies - dirty and copies and dirty
    field = pii.train()
    for i, r in out.items():
        assert r.decoded_sha256 == hashlib.sha256(pii.masked(texts[i], field).encode()).hexdigest()
        assert r.n_chars == len(pii.masked(texts[i], field)) and len(r.ids) == 4 * r.n_tokens


def test_pipeline_stages_on_odd_rows(spark, odd, tmp_path):
    sf = str(tmp_path)
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
            if name != "byte_bpe":
                assert docs.columns == odd.columns
        if docs.count():
            kept = {r.doc_id for r in docs.collect()}
            assert {1, 2, 6, None} <= kept and 7 not in kept


def test_pipeline_judges_rows_and_not_ids(spark, tmp_path):
    sf, rng = str(tmp_path), random.Random(5)
    some = lambda n: " ".join("".join(rng.choice("abcdeghil") for _ in range(6)) for _ in range(n))
    exam, copied, alone, extra = some(12), some(40), some(30), some(30)
    spark.createDataFrame([(1, exam)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = [(1, exam), (1, alone), (None, exam), (2, extra), (2, extra), (None, copied), (None, copied + " end"), (4, copied), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, Row_Key string")
    kept = corpus_pipeline.keep_first_of_near_copies(spark, docs, sf)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == {(1, exam): 1, (1, alone): 1, (2, extra): 1, (4, copied): 1, (None, None): 1}
    clean = corpus_pipeline.drop_contaminated(spark, docs, sf).select("doc_id", "text").collect()
    assert Counter(map(tuple, clean)) == Counter(r for r in rows if r[1] != exam)
