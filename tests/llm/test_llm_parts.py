"""Pieces of the operators against plain versions, without Spark."""

import hashlib
import itertools
import math
import random
from collections import Counter
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import bpe, ctw, decontam, fingerprints, licenses, near_dup, pii, quality, toxicity, warc
from millrace.llm.text import Words, buffers, separators


def as_column(texts):
    return pa.array([t.encode() for t in texts], pa.large_binary())


# --- words -------------------------------------------------------------------------------------------------------------------

def test_words_are_those_of_the_pattern():
    texts = ["", " ", "A b\tc", "é è", "one", " x  y ", "a\n\nb", "ÀB c"]
    for keep, pattern in (("", "[^\x20\x09-\x0d]+"), ("alnum", "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")):
        w = Words(*buffers(as_column(texts)), separators(keep))
        raw = w.raw.tobytes()
        got = [[raw[w.start[k]:w.end[k]].decode() for k in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
        low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
        assert got == [re.findall(pattern, t.translate(low)) for t in texts]


def test_equal_words_hash_alike_wherever_they_stand():
    w = Words(*buffers(as_column(["alpha beta", "x beta alpha", "ALPHA"])), separators())
    h = w.hashes
    assert h[0] == h[4] == h[5] and h[1] == h[3] and len(set(h.tolist())) == 3


# --- personal data -----------------------------------------------------------------------------------------------------------

def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_patterns_equal_the_regular_expressions():
    rng = random.Random(3)
    cases = ["a@b@c.de", "a@b.c@d.ef", "x@@y.zz", "@a.b", "a.b-c%+@x-1.y.z.", "1.2.3.4.5.6.7.8", "256.1.1.1.1", "001.02.3.4", "4111 1111-1111 1111",
             "4111111111111111", "+1 (614) 555-8001", "++1 2 3 4 5 6 7 8", "+1" + "(" * 50, "9" * 5000, "a" * 5000 + "@", "1." * 3000]
    alphabet = ["a", "Z", "1", "25", "0", ".", "@", "-", " ", "+", "(", ")", "é", "_", "\n"]
    cases += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    cases += ["".join(rng.choice(["4111", "1111", " ", "-", "1", "+"]) for _ in range(12)) for _ in range(500)]
    for text in cases:
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.fixture(scope="module")
def field():
    return pii.train(lines=500, rounds=4)


def test_field_decodes_the_best_segmentation(field):
    for text in ["call (614) 555-8001 x", "a [at] b.com 1", "4111 1111 1111"]:
        s = pii.Stretch(text, field.known)
        scores = field.scores(s)
        best = 0.0
        for r in range(3):  # all sets of up to two segments
            for chosen in itertools.combinations(range(len(s.candidates)), r):
                spans = sorted(s.candidates[c] for c in chosen)
                if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
                    best = max(best, sum(float(scores[c].max()) for c in chosen))
        where = {(s.spans[i][0], s.spans[j - 1][1]): c for c, (i, j) in enumerate(s.candidates)}
        got = field.decode(text)
        assert len(got) <= 2
        assert math.isclose(sum(float(scores[where[a, b]][pii.KINDS.index(k)]) for k, a, b in got), best, abs_tol=1e-9)


def test_field_finds_unseen_lines_and_leaves_numbers_alone(field):
    right = wanted = wrong = 0
    for text, gold in pii.generated_lines(200, seed=77):
        got = set(field.decode(text))
        right, wanted, wrong = right + len(got & set(gold)), wanted + len(gold), wrong + len(got - set(gold))
    assert right / wanted > 0.75 and wrong / wanted < 0.05
    for text in ["Version 2.0 of 2024-10-31 12:30", 'token = "0c497b5014f705c0be648d68b816f88c209136eb"', "plain words only", "1990-1995", ""]:
        assert pii.all_spans(text, field) == ([], [])


def test_added_spans_keep_off_base_spans_and_masking_covers_all(field):
    text = "x +1 (614) 555-8001 y (614) 555-8002 z a@b.com"
    base, spans = pii.all_spans(text, field)
    assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert "555" not in pii.masked(text, field) and "[EMAIL]" in pii.masked(text, field)


def forms(rng):
    """Generated entities by form; the long ones have more tokens than LONGEST, or reach further than AROUND."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda n=7: "".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(n))
    return {
        ("ip", "eight full groups"): ":".join("".join(rng.choice("0123456789abcdef") for _ in range(4)) for _ in range(8)),
        ("ip", "eight short groups"): ":".join("".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 4))) for _ in range(8)),
        ("email", "spelled, parts"): f"{name()}.{name(1)}.{name()} (at) {name()}.{name()} (dot) com",
        ("email", "spelled, many labels"): f"{name()} [at] {name(2)} [dot] {name(3)} [dot] {name()} [dot] org",
        ("email", "long local part"): f"{name(14)}.{name(14)}_{d(3)} (at) {name()} (dot) de",
        ("email", "long domain"): f"{name()} [at] {name(15)} [dot] {name(16)} [dot] net",
        ("email", "short spelled"): f"{name()} (at) {name()}.com",
        ("card", "dotted"): ".".join(rng.choice(["4111.1111.1111.1111", "5500.0000.0000.0004"]).split(".")),
        ("phone", "national"): f"({d(3)}) {d(3)}-{d(4)}",
    }


def test_every_form_is_found_whole():
    field, rng, missed = pii.train(), random.Random(8), {}
    for _ in range(60):
        for (kind, form), s in forms(rng).items():
            text = f"words before it {s} and behind"
            if (kind, 16, 16 + len(s)) not in pii.all_spans(text, field)[1]:
                missed.setdefault(form, []).append(s)
    assert {f: len(m) for f, m in missed.items() if len(m) > 6} == {}, {f: m[:2] for f, m in missed.items()}


def test_hexadecimal_pairs_are_no_addresses():
    field, rng = pii.train(), random.Random(9)
    texts = ["key " + ":".join(f"{rng.randrange(256):02x}" for _ in range(n)) + " end" for n in (6, 16, 20) for _ in range(40)]
    assert sum(bool(pii.all_spans(t, field)[1]) for t in texts) <= 6


def test_entities_that_are_no_candidates_are_refused(monkeypatch):
    monkeypatch.setattr(pii, "generated_lines", lambda lines, seed: [("ab 12 cd", [("phone", 0, 2)])])
    with pytest.raises(ValueError, match="no candidates"):
        pii.train.__wrapped__(lines=1)


# --- near duplicates ---------------------------------------------------------------------------------------------------------

def test_signatures_estimate_similarity_and_small_sets_fill_all_bins():
    rng = np.random.RandomState(0)
    for n, shared in ((400, 320), (40, 34), (8, 7)):
        agree = []
        for _ in range(60):
            u = rng.randint(0, 1 << 62, 2 * n - shared).astype(np.uint64) * np.uint64(4) + rng.randint(0, 4, 2 * n - shared).astype(np.uint64)
            a, b = np.unique(u[:n]), np.unique(u[n - shared:])
            agree.append((near_dup.signature(a) == near_dup.signature(b)).mean())
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.05
    assert len(set(near_dup.signature(np.array([5], np.uint64)).tolist())) == 1


def test_shingle_sets():
    sets = near_dup.shingle_sets(as_column(["a b c d e f", "A B  c d e\tf", "a b", "", "a b c d e a b c d e"]))
    assert (sets[0] == sets[1]).all() and [len(s) for s in sets] == [2, 2, 1, 0, 5]
    assert near_dup.alike(sets[0], sets[1]) and not near_dup.alike(sets[0], sets[4])


# --- fingerprints ------------------------------------------------------------------------------------------------------------

def test_prefix_hashes_answer_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(60):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 60)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(1, 60)))
        p, q = (fingerprints.PrefixHash(fingerprints.code_points(t)) for t in (a, b))
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        want = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
        assert fingerprints.common_extension(p, i, q, j) == want
        cut = rng.randint(0, len(a))
        joined = fingerprints.PrefixHash(fingerprints.code_points(b), p, cut)
        plain = fingerprints.PrefixHash(fingerprints.code_points(a[:cut] + b))
        assert all((x == y).all() for x, y in zip(joined.sums, plain.sums))


def test_likeness():
    def fp(t):
        p = fingerprints.PrefixHash(fingerprints.code_points(t))
        return fingerprints.written(p, fingerprints.sketch(p)[0])
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    other = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    assert fp(text) == fp("" + text) and fingerprints.likeness(fp(text), fp(text)) == 1.0
    assert 0.5 < fingerprints.likeness(fp(text), fp(text[:2000] + other[:1000])) < 0.85
    assert fingerprints.likeness(fp(text), fp(other)) < 0.1 and fingerprints.likeness(fp(""), fp("")) == 1.0
    assert fingerprints.likeness(fp(""), fp("a")) == 0.0 and fingerprints.likeness(fp("abcdefgh"), fp("abcdefgx")) > 0.5


# --- licences ----------------------------------------------------------------------------------------------------------------

def test_licence_classifier_separates_families():
    filler = "lorem ipsum dolor sit amet work version free terms use notice under".split()
    model = licenses.fitted(licenses.notices(40, 1, filler))
    held = licenses.notices(10, 2, filler)
    p = licenses.paragraphs_of([t for t, _ in held])
    prob = model.probabilities(*p.features(), len(p.document))
    y = np.array([c for _, c in held])[p.document]
    assert (prob.argmax(axis=1) == y).mean() > 0.9 and np.allclose(prob.sum(axis=1), 1)


def test_paragraphs_are_lines():
    p = licenses.paragraphs_of(["a b\nc", "", "\n\n", "d"])
    assert p.document.tolist() == [0, 0, 3] and np.diff(p.first).tolist() == [2, 1, 1]


# --- tokens ------------------------------------------------------------------------------------------------------------------

def test_pieces_are_cut_where_no_token_crosses():
    import public_tokenizers as vocabularies
    ranks, pattern = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN
    rng, enc = random.Random(4), bpe.encoding(ranks, pattern)
    alphabet = ["a", "Bc", " ", "  ", "\n", "'s", "é", "1", " ", "!", "\x1f", " ", "日本", "😀"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        ids = [i for part in bpe.pieces(text, 5) for i in enc.encode_ordinary(part)]
        assert ids == enc.encode_ordinary(text) and "".join(bpe.pieces(text, 5)) == text
        assert bpe.decode_ids(np.array(ids, np.int64), ranks, pattern).decode() == text
    long = "word " * 60_000 + "x" * 50_000
    assert bpe.encode_text(long, ranks, pattern).tolist() == enc.encode_ordinary(long)


# --- quality -----------------------------------------------------------------------------------------------------------------

def test_latent_classes_recover_accuracies():
    rng = np.random.RandomState(5)
    good = rng.rand(20_000) < 0.8
    accuracy = np.linspace(0.95, 0.7, len(quality.VOTERS))
    right = rng.rand(len(good), len(accuracy)) < accuracy
    cast = np.where(right == good[:, None], 1, -1)
    cast[rng.rand(*cast.shape) < 0.3] = 0
    names = quality.patterns(cast)
    counts = {}
    for n in names:
        counts[n] = counts.get(n, 0) + 1
    posterior, found = quality.latent_classes(counts)
    assert max(abs(found[v[0]][0] - a) + abs(found[v[0]][1] - a) for v, a in zip(quality.VOTERS, accuracy)) < 0.08
    assert ((np.array([posterior[n] for n in names]) >= 0.5) == good).mean() > 0.95


# --- archives ----------------------------------------------------------------------------------------------------------------

def test_records_and_damage():
    raw = warc.record("7", "http://x/é\r\ny", "grüß".encode(), None)
    assert warc.read_record(raw) == ("7", 6, warc.sha1("grüß".encode()), "response", None)
    assert warc.read_record(warc.record("8", "", b"abc", "7")) == ("8", 3, warc.sha1(b"abc"), "revisit", "7")
    assert warc.read_record(warc.record(None, "", b"", None))[0] is None
    for bad in (raw[:-1], raw.replace("grüß".encode(), "gruß ".encode()), raw.replace(b"WARC/1.1", b"WARC/9"), raw.replace(b"WARC-Date", b"X-Date")):
        with pytest.raises(ValueError):
            warc.read_record(bad)
    for bad in (b"", b"x" * 20, b"\x5d\x2a\x4d\x18\xff\xff\xff\x00"):
        with pytest.raises(ValueError):
            list(warc.frames(bad))


# --- language model ----------------------------------------------------------------------------------------------------------

def counted_contexts(texts, nodes=ctw.NODES, depth=ctw.DEPTH, often=1):
    raw, off = buffers(as_column(texts))
    tree = ctw.grown(ctw.symbols_of(raw, off)[0], nodes, depth, often)
    ctx, first = ctw.contexts(tree, raw, off)
    return tree, ctx, first


def names_of(tree):
    """The bytes of each node's context, the nearest first."""
    out = [()]
    byte = {int(c): b for n in range(len(tree.parent)) for b, c in enumerate(tree.child[n]) if c}
    for node in range(1, len(tree.parent)):
        out.append((*out[tree.parent[node]], byte[node]))
    return out


def test_weighting_equals_the_recursion():
    """Sequential KT products and the textbook recursion, on a short text; what stands at a node without a child is a child of its own."""
    texts = ["abab abba", "ab", "", "ba b1"]
    tree, ctx, _ = counted_contexts(texts, nodes=9, depth=3)
    key, n = np.unique(ctx, return_counts=True)
    got = ctw.weighted(tree, key, n.astype(float))
    assert got.shape == (len(tree.parent), 256)
    children = {k: np.flatnonzero(tree.parent[1:] == k) + 1 for k in range(len(tree.parent))}
    assert any(len(c) for k, c in children.items() if k)
    counts = {}

    def path(node):
        out = [node]
        while out[-1]:
            out.append(int(tree.parent[out[-1]]))
        return [*out, ("rest", node)] if len(children[node]) else out

    for k, c in zip(key.tolist(), n.tolist()):
        context, symbol = divmod(k, 256)
        for bit in range(8):
            for at in path(context):
                counts.setdefault(((bit, symbol >> (8 - bit)), at), [0, 0])[symbol >> (7 - bit) & 1] += c

    def kt(a, b):
        out = 0.0
        for i in range(a):
            out += math.log((i + 0.5) / (i + 1))
        for j in range(b):
            out += math.log((j + 0.5) / (a + j + 1))
        return out

    def weight(node, at):
        own = kt(*counts.get((node, at), (0, 0)))
        if isinstance(at, tuple) or not len(children[at]):
            return own
        below = kt(*counts.get((node, ("rest", at)), (0, 0))) + sum(weight(node, int(c)) for c in children[at])
        return math.log(0.5 * math.exp(own) + 0.5 * math.exp(below))

    def bit_probability(node, context, bit):
        """Weighted probability after one more bit over that before it."""
        before = weight(node, 0)
        for at in path(context):
            counts.setdefault((node, at), [0, 0])[bit] += 1
        after = weight(node, 0)
        for at in path(context):
            counts[(node, at)][bit] -= 1
        return math.exp(after - before)

    rng = random.Random(6)
    for _ in range(12):
        context, symbol = rng.randrange(len(tree.parent)), rng.choice([97, 98, 32, 255, 200])
        want = sum(math.log10(bit_probability((b, symbol >> (8 - b)), context, symbol >> (7 - b) & 1)) for b in range(8))
        assert math.isclose(float(got[context, symbol]), want, rel_tol=1e-4)
    assert np.allclose((10.0 ** got.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_contexts_do_not_reach_over_rows():
    tree, _, _ = counted_contexts(["xyz", "abc", "abc"])
    one, first = ctw.contexts(tree, *buffers(as_column(["xyz", "abc"])))
    two, _ = ctw.contexts(tree, *buffers(as_column(["abc"])))
    assert (one[first[1]:] == two).all()


def test_the_tree_holds_the_most_frequent_contexts():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aab ") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    seen = Counter()
    for t in texts:
        s = [ctw.END, *t.encode(), ctw.END]
        for i in range(1, len(s)):
            for d in range(min(4, i) + 1):  # back to the mark before the text
                seen[tuple(s[i - d:i][::-1])] += 1
    for nodes, often in ((20, 1), (10_000, 7)):
        tree, _, _ = counted_contexts(texts, nodes, 4, often)
        names = names_of(tree)
        counts = [seen[x] for x in names]
        assert len(set(names)) == len(names) == min(nodes, sum(n >= often or not x for x, n in seen.items()))
        assert min(counts) >= max([n for x, n in seen.items() if x not in set(names) and n >= often], default=0)
    # every byte is in its deepest context
    tree, ctx, first = counted_contexts(texts, 20, 4)
    names = names_of(tree)
    s = [ctw.END, *texts[0].encode(), ctw.END]
    for i, c in enumerate(ctx[first[0]: first[1]].tolist(), 1):
        back = tuple(s[max(0, i - 4):i][::-1])
        assert names[c // 256] == max((x for x in names if x == back[: len(x)]), key=len) and c % 256 == s[i]


def test_deep_contexts_of_other_letters():
    """Bits a byte on unseen texts are below those of a plain model of the three bytes before, in one-byte and in two-byte letters."""
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 4))) for _ in range(120)]
    word = lambda: "".join(parts[min(int(rng.expovariate(0.05)), 119)] for _ in range(rng.randint(1, 3)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(900)]
    letters = str.maketrans({c: chr(0x430 + i) for i, c in enumerate("abcdefghiklmnoprstu")})
    for some in (texts, [t.translate(letters) for t in texts]):
        train, test = some[:800], some[800:]
        tree, ctx, _ = counted_contexts(train, often=ctw.OFTEN)
        key, n = np.unique(ctx, return_counts=True)
        logs = ctw.weighted(tree, key, n.astype(float))
        own, _ = ctw.contexts(tree, *buffers(as_column(test)))
        size = sum(len(t.encode()) for t in test)
        bits = -logs.reshape(-1)[own].astype(float).sum() * math.log2(10) / size
        pairs, whole = Counter(), Counter()
        for t in train:
            s = [ctw.END] * 3 + [*t.encode(), ctw.END]
            for i in range(3, len(s)):
                pairs[(*s[i - 3:i], s[i])] += 1
                whole[tuple(s[i - 3:i])] += 1
        plain = 0.0
        for t in test:
            s = [ctw.END] * 3 + [*t.encode(), ctw.END]
            plain -= sum(math.log2((pairs[(*s[i - 3:i], s[i])] + 0.05) / (whole[tuple(s[i - 3:i])] + 0.05 * 256)) for i in range(3, len(s)))
        assert bits < plain / size


# --- toxicity ----------------------------------------------------------------------------------------------------------------

def test_segments_are_all_maximal_ones():
    def plain(x, a, b, out):
        best = max(((sum(x[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] > 1e-12:
            i = -best[2]
            j = i - best[1]
            out.append((round(best[0], 6), i, j))
            plain(x, a, i, out)
            plain(x, j, b, out)
        return out
    rng = np.random.RandomState(7)
    for _ in range(300):
        x = np.round(rng.randn(rng.randint(0, 16)), 3)
        assert sorted((round(s, 6), a, b) for s, a, b in toxicity.segments(x)) == sorted(plain(x.tolist(), 0, len(x), []))
    assert toxicity.segments(np.zeros(0)) == [] and len(toxicity.segments(np.ones(200_000))) == 1


def test_windows_words_pattern():
    assert re.findall(decontam.WORD, "A-b 9é_z") == ["A", "b", "9é", "z"]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
