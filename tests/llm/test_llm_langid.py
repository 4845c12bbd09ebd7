"""Language identification: n-grams, filter and whole rows against plain Python, and held-out accuracy."""

import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.queries import QUERIES
from tests.llm.test_llm_spark import ODD, SF, by_id, odd  # noqa: F401

TEXTS = ["", "a", "Ab c", "  x-Yz 12 ", "Straße über", "नमस्ते दुनिया", "日本語 text", "\n\n", "é", "a1b2", "İI"]


def plain(text):
    """n-grams of one text, one size at a time, as strings with # for the marks."""
    kept = []
    for c in text:
        kind = unicodedata.category(c)[0]
        low = c.lower()
        kept.append((low if len(low) == 1 else c) if kind in "LM" else " ")
    out = {n: Counter() for n in langid.SIZES}
    for word in "".join(kept).split():
        for n in langid.SIZES:
            whole = f"#{word}#" if n > 1 else word
            out[n].update(whole[i:i + n] for i in range(len(whole) - n + 1))
    return out


def numbered(texts):
    """Which texts have a letter; and the operator's n-grams and texts, per size."""
    words = langid.words_of(pa.array([t.encode() if isinstance(t, str) else t for t in texts], pa.large_binary()))
    row = np.repeat(np.arange(len(texts)), np.diff(words.edge))
    return words.has_letter, [(gram, row[own]) for gram, own in langid.ngrams(words.seq, words.first)]


def test_ngrams_against_plain_python():
    has, grams = numbered(TEXTS)
    assert has.tolist() == [any(c.isalpha() for c in t) for t in TEXTS]
    known: dict[str, int] = {}
    for n, (gram, row) in zip(langid.SIZES, grams):
        assert (np.diff(row) >= 0).all() and (gram & np.uint64(7) == n).all()
        for d, text in enumerate(TEXTS):
            counts = Counter(gram[row == d].tolist())
            assert sorted(counts.values()) == sorted(plain(text)[n].values())
    # equal n-grams have equal numbers, others do not
    for n, (gram, row) in zip(langid.SIZES, numbered(["abcab"])[1]):
        words = "#abcab#" if n > 1 else "abcab"
        for g, w in zip(gram.tolist(), [words[i:i + n] for i in range(len(words) - n + 1)], strict=True):
            assert known.setdefault(w, g) == g
    assert len(set(known.values())) == len(known)


def test_bytes_that_are_no_utf8():
    has, grams = numbered([b"ab\xffcd", "ab", b"\xff"])
    assert has.tolist() == [True, True, False] and Counter(grams[0][1].tolist()) == {0: 4, 1: 2}


def test_filter_holds_every_entered_language_and_corrects(spark):
    rng = np.random.RandomState(1)
    gram = np.unique(rng.randint(1, 1 << 53, 6000).astype(np.uint64))
    members = rng.rand(len(gram), 11) < np.linspace(0.02, 0.6, 11)
    rows = [(int(g), l) for g, m in zip(gram, members) for l in np.flatnonzero(m).tolist()]
    bits = langid.filled(spark.createDataFrame(rows, "gram long, lang long"), 11)
    fill = np.concatenate([np.unpackbits(bits[:, b: b + 1], axis=1, bitorder="little").mean(axis=0) for b in range(2)])[:11]
    model = langid.Model([f"l{i}" for i in range(11)], bits, fill ** langid.PROBES)
    masks = np.unpackbits(model.masks(gram), axis=1, bitorder="little")[:, :11].astype(bool)
    assert (masks | ~members).all()  # nothing entered is missed
    others = np.unique(rng.randint(1 << 53, 1 << 54, 20_000).astype(np.uint64))
    both = np.concatenate([gram, others])
    hits = np.unpackbits(model.masks(both), axis=1, bitorder="little")[:, :11].sum(axis=0)
    got = model.corrected(np.array([hits, hits * 0]), np.array([len(both), 0]))
    assert np.abs(got[0] - members.sum(axis=0)).max() < 60 and not got[1].any()


def test_counts_are_those_of_each_row_alone(spark):
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der hund die katze", "de")] * 9)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    texts = ["the the hund", "", "katze, the katze!", "the the hund", "dog"]
    found, n = model.counts(langid.words_of(pa.array([t.encode() for t in texts], pa.large_binary())))
    for d, text in enumerate(texts):
        gram = [np.concatenate(g) if g else np.zeros(0, np.uint64) for g in [[g for g, _ in numbered([text])[1]]]][0]
        hits = np.unpackbits(model.masks(gram), axis=1, bitorder="little")[:, :2].sum(axis=0) if len(gram) else np.zeros(2)
        assert n[d] == len(gram) and np.allclose(found[d], model.corrected(hits[None, :], np.array([len(gram)]))[0])


def test_contained_against_plain_python(spark):
    docs = {0: ["ab ab abc", "abx"], 1: ["ab cd"], 2: ["zz ab " + "cd " * 40]}
    rows = [(l, t) for l, texts in docs.items() for t in texts]
    got = {(r.gram, r.lang) for r in langid.contained(langid.counted(spark.createDataFrame(rows, "lang long, text string"))).collect()}
    number = {}
    for t in [t for _, t in rows]:
        for n, (gram, _) in zip(langid.SIZES, numbered([t])[1]):
            order = []
            for word in t.split():
                whole = f"#{word}#" if n > 1 else word
                order += [whole[i:i + n] for i in range(len(whole) - n + 1)]
            number.update(zip(order, gram.tolist(), strict=True))
    want = set()
    for n in langid.SIZES:
        counts = {l: sum((plain(t)[n] for t in texts), Counter()) for l, texts in docs.items()}
        rate = {l: {w: k / (sum(c.values()) + langid.SMOOTH) for w, k in c.items()} for l, c in counts.items()}
        for w in set().union(*counts.values()):
            top = max(r.get(w, 0.0) for r in rate.values())
            want |= {(number[w], l) for l in docs if w in rate[l] and rate[l][w] * langid.DOMINANCE >= top}
    assert got == want


def test_odd_rows_and_small_models(spark, odd):  # noqa: F811
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("le chat", None)] * 30)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.names == sorted(model.names, key=lambda l: (-docs.filter((F.col("lang") == l) & F.col("text").isNotNull() & (langid.fold(F.col("doc_id")) != 0)).count(), l))
    assert set(model.names) == {"en", "de"}  # no text, no language
    got = by_id(langid.predict(odd, model))
    assert sum(map(len, got.values())) == len(ODD)
    assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 for i in (1, 2, 3, 11))
    assert got[None][0].lang_pred in model.names and got[7][0] == got[7][1]
    asked = spark.createDataFrame([(1, "katze und hund"), (2, "The DOG"), (3, "日本"), (4, "12 34")], "doc_id long, text string")
    rows = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3, 4)] == ["de", "en", model.names[0], "und"] and rows[3].score == 0
    nobody = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(asked, nobody).collect()} == {"und"}
    assert langid.predict(asked.limit(0), model).count() == 0
    alone = langid.train(docs.filter("lang = 'en'"))
    assert {r.doc_id: (r.lang_pred, r.second) for r in langid.predict(asked, alone).collect()} == {
        1: ("en", None), 2: ("en", None), 3: ("en", None), 4: ("und", None)}


def test_many_languages_are_refused(spark):
    many = spark.range(4 * langid.LANGUAGES).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        langid.train(many)


def test_twelve_languages_use_two_bytes(spark):
    """Words of different letters for each language, one of them rare."""
    rows = [(100 * l + i, " ".join(chr(97 + 2 * l) + chr(98 + 2 * (l + i % 2) % 24) for _ in range(20)), f"l{l:02d}") for l in range(12) for i in range(40 if l else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.names) == 12 and model.bits.shape[1] == 2
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(got[i] == l for i, _, l in rows)


def test_query_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = QUERIES["op11_language_bitmasks"](spark, SF)
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
