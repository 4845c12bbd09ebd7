"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans the patterns miss.

The field segments a stretch of tokens into entities and single tokens outside. Entities have up to ``LONGEST`` tokens, but a whole
colon-separated address and a whole e-mail address, spelled or not, are candidates at any length. A candidate segment
is scored as a whole (its shape, digit count, checksum, parts, neighbours), and dynamic programming over segment ends chooses
boundaries and kinds together. It is trained here by maximum likelihood (forward-backward over segments) on generated
lines, written in the forms of ``positives`` and ``negatives`` among made-up words; the number of lines and the seed are parameters.

Only stretches around a seed (a long digit group, an @ or its spelled forms, colon-separated hexadecimal groups) can hold an entity, as
every candidate must contain one; everything else is outside by definition, so decoding the stretches alone decodes the whole text.
Spans of the patterns are kept as they are: stretches end at them.

Odd input: a null text is the empty text and has no spans; null ids are passed through; repeated rows are searched each on its own; an
empty table gives an empty result; only the named columns are read (``mask`` keeps all columns).
"""

from __future__ import annotations

import functools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import column, table

KINDS = ("email", "ip", "card", "phone")
LONGEST = 18
AROUND = 24  # characters on either side of a seed, or more if an e-mail address reaches further

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        # a run of local characters before a later @ cannot reach back over this one
        done = max(done, at + 1)
        at = text.find("@", done)


def addresses(text: str):
    for chain in _CHAIN.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the fixed patterns find, by kind and then place."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, find in (("ip", addresses), ("card", cards), ("phone", phones)):
            out += [(kind, *s) for s in find(text)]
    return out


# --- the semi-Markov field -------------------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_SPELLED = r"\((?:at|AT)\)|\[(?:at|AT)\]|\{(?:at|AT)\}"
_SEED = re.compile(rf"[0-9][0-9 ().\-/]{{5,}}[0-9]|@|{_SPELLED}|(?:[0-9A-Fa-f]{{1,4}}:){{3,}}")
_MARK = re.compile(rf"@|{_SPELLED}")
_RUN = re.compile(r"[A-Za-z]+|[0-9]+")
_SPELLED_DOT = r"(?:\((?:dot|DOT)\)|\[(?:dot|DOT)\]|\{(?:dot|DOT)\})"
_DOT_BEFORE = re.compile(_SPELLED_DOT)
_AFTER = re.compile(rf"[ \t]*[A-Za-z0-9-]+(?:(?:\.|[ \t]*{_SPELLED_DOT}[ \t]*)[A-Za-z0-9-]+)*")
_GROUPS = re.compile(r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){3,}")


def mail_around(text: str, a: int, b: int) -> tuple[int, int] | None:
    """The whole run of address characters around the mark at a:b, with spelled dots in it."""
    def local_before(end: int) -> int:
        start = end
        while start and text[start - 1] in _LOCAL:
            start -= 1
        return start

    def blank_before(end: int) -> int:
        while end and text[end - 1] in " \t":
            end -= 1
        return end

    domain, end = _AFTER.match(text, b), blank_before(a)
    start = local_before(end)
    if not domain or start == end:
        return None
    while _DOT_BEFORE.match(text, (dot := blank_before(start)) - 5):
        end = blank_before(dot - 5)
        more = local_before(end)
        if more == end:
            break
        start = more
    return start, domain.end()


def whole_addresses(text: str):
    """(start, end) of whole e-mail addresses around their marks, and of up to eight colon-separated hexadecimal groups."""
    for m in _MARK.finditer(text):
        if span := mail_around(text, *m.span()):
            yield span
    for m in _GROUPS.finditer(text):
        a, b = m.span()
        if text.count(":", a, b) < 8 and not text[a - 1: a].isalnum() and not text[b: b + 1].isalnum():
            yield a, b


def shape(s: str) -> tuple[str, str]:
    """Digits as 9 and letters as a: with run lengths up to 12, and with runs collapsed."""
    long = _RUN.sub(lambda m: ("9" if m.group()[0].isdigit() else "a") * min(12, len(m.group())), s)
    short = _RUN.sub(lambda m: "9" if m.group()[0].isdigit() else "a", s)
    return long[:60], short[:60]


@functools.lru_cache(maxsize=50_000)
def span_features(s: str) -> tuple[str, ...]:
    digits = "".join(c for c in s if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in s)
    long, short = shape(s)
    out = [f"long={long}" if len(long) <= 24 else "long=more", f"short={short}", f"digits={min(len(digits), 20)}", f"letters={min(letters, 3)}",
           f"first={'9' if s[0].isdigit() else 'a' if s[0].isalpha() else s[0]}", f"marks={''.join(sorted({c for c in s if not c.isalnum()}))[:8]}"]
    if 13 <= len(digits) <= 19 and not letters:
        out.append(f"checksum={luhn(digits)}")
    if _MARK.search(s):
        before, _, after = re.sub(_SPELLED, "@", s).partition("@")
        after = re.sub(r"\s*[\[({](?:dot|DOT)[\])}]\s*", ".", after).strip()
        out.append(f"mail={bool(before.strip())},{bool(re.fullmatch(r'[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}', after))},{s.count('@')}")
        out.append(f"mail_spaces={min(3, before.strip().count(' '))},{min(3, after.count(' '))}")
    if ":" in s:
        groups = s.split(":")
        out.append(f"hex={all(len(g) <= 4 and all(c in '0123456789abcdefABCDEF' for c in g) for g in groups)},{min(len(groups), 9)},{'::' in s}")
    return tuple(out)


def kind_of_char(c: str) -> str:
    return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


class Stretch:
    """Tokens of a piece of text and its candidate segments, grouped by where they end."""

    def __init__(self, text: str, known: dict[str, int] | None = None):
        self.text = text
        self.spans = [m.span() for m in _TOKEN.finditer(text)]
        n = len(self.spans)
        self.candidates: list[tuple[int, int]] = []
        seeds = [m.span() for m in _SEED.finditer(text)]
        for i in range(n):
            first = text[self.spans[i][0]]
            if not (first.isalnum() and first.isascii() or first in "+("):
                continue
            a = self.spans[i][0]
            if a and first.isalnum() and text[a - 1].isalnum() and text[a - 1].isascii() and not first.isdigit() and not text[a - 1].isdigit():
                continue
            seed = next((s for s in seeds if s[1] > a), None)
            for j in range(i, min(n, i + LONGEST)):
                b = self.spans[j][1]
                if text[self.spans[j][0]] == "\n" or seed is None:
                    break
                if text[b - 1].isalnum() and b > seed[0] + (text[seed[0]].isdigit()) * 6:
                    self.candidates.append((i, j + 1))
        starts, ends = {a: i for i, (a, _) in enumerate(self.spans)}, {b: j + 1 for j, (_, b) in enumerate(self.spans)}
        for a, b in whole_addresses(text) if seeds else ():
            if a in starts and b in ends and ends[b] - starts[a] > LONGEST:
                self.candidates.append((starts[a], ends[b]))
        self.features = [self.segment(i, j) for i, j in self.candidates]
        if known is not None:
            self.features = [[known[f] for f in fs if f in known] for fs in self.features]

    def segment(self, i: int, j: int) -> list[str]:
        a, b = self.spans[i][0], self.spans[j - 1][1]
        left = kind_of_char(self.text[a - 1]) if a else "^"
        right = kind_of_char(self.text[b]) if b < len(self.text) else "$"
        after = kind_of_char(self.text[b + 1]) if b + 1 < len(self.text) else "$"
        return [*span_features(self.text[a:b]), f"left={left}", f"right={right}", f"right2={right}{after}", f"tokens={min(j - i, LONGEST + 1)}"]


class Field:
    """Weights per feature and kind; a token outside scores 0."""

    def __init__(self, known: dict[str, int], weights: np.ndarray):
        self.known, self.weights = known, weights

    def scores(self, s: Stretch) -> np.ndarray:
        return np.array([self.weights[f].sum(axis=0) for f in s.features]) if s.features else np.zeros((0, len(KINDS)))

    def decode(self, text: str) -> list[tuple[str, int, int]]:
        """The best segmentation's entities, as character spans."""
        s = Stretch(text, self.known)
        scores, n = self.scores(s), len(s.spans)
        ending: dict[int, list[int]] = {}
        for c, (_, j) in enumerate(s.candidates):
            ending.setdefault(j, []).append(c)
        best, back = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for c in ending.get(j, ()):
                v = best[s.candidates[c][0]] + float(scores[c].max())
                if v > best[j]:
                    best[j], back[j] = v, c
        out, j = [], n
        while j > 0:
            if back[j] < 0:
                j -= 1
                continue
            i = s.candidates[back[j]][0]
            out.append((KINDS[int(scores[back[j]].argmax())], s.spans[i][0], s.spans[j - 1][1]))
            j = i
        return out[::-1]


def positives(rng: random.Random) -> tuple[str, str]:
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(rng.randint(2, 9)))
    kind = rng.choice(KINDS)
    if kind == "email":
        at = rng.choice(["@", " @ ", " (at) ", "(at)", " [at] ", "[at]"])
        dot = rng.choice([".", ".", " [dot] ", "(dot)", " (dot) "])
        user = rng.choice([name(), f"{name()}.{name()}", f"{name()}.{d(2)}", f"{name()}_{d(3)}"])
        host = rng.choice([name(), f"mail{d(1)}.{name()}"]).replace(".", dot)
        return kind, user + at + host + dot + rng.choice(["com", "org", "net", "de", "fr", "es"])
    if kind == "ip":
        if rng.random() < 0.5:
            return kind, ".".join(str(rng.randint(0, 255)) for _ in range(4))
        return kind, ":".join("".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 4))) for _ in range(8))
    if kind == "card":
        digits = d(15)
        digits += next(c for c in "0123456789" if luhn(digits + c))
        sep = rng.choice(["", " ", "-", ".", "/"])
        return kind, sep.join(digits[k:k + 4] for k in range(0, 16, 4))
    return kind, rng.choice([f"+1 ({d(3)}) {d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}",
                             f"1-{d(3)}-{d(3)}-{d(4)}", f"00{rng.randint(30, 60)} {d(2)} {d(7)}", f"0{d(2)}/{d(7)}", f"+{d(2)} {d(2)} {d(8)}"])


def negatives(rng: random.Random) -> str:
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    bad = d(16)
    bad = bad if not luhn(bad) else bad[:-1] + str((int(bad[-1]) + 1) % 10)
    x = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 32, 40, 64])))
    pairs = ":".join("".join(rng.choice("0123456789abcdef") for _ in range(2)) for _ in range(rng.choice([6, 16, 20])))
    return rng.choice([f"20{d(2)}-0{d(1)}-1{d(1)}", f"{d(2)}.{d(2)}.19{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(1)}.{d(1)}", f"{d(3)}.{d(3)}.{d(3)},00", bad, x,
                       f'"{x}"', f"{d(7)}", f"{d(9)}", f"{d(12)}", f"978-{d(1)}-{d(5)}-{d(3)}-{d(1)}", f"{d(4)}-{d(4)}", f"{d(1)}.{d(2)}.{d(3)}.{d(4)}",
                       f"{d(20)}", f"{d(2)} {d(2)} {d(2)} {d(2)}", f"{d(3)}/{d(4)}-{d(2)}", "word@", "@name", f"v{d(1)}.{d(2)}.{d(1)}", f"{d(5)}-{d(6)}",
                       f"19{d(2)}-20{d(2)}", f"{d(3)} {d(3)} {d(3)}", f"a@b", f"{d(10)}", f"{d(2)}:{d(2)}:{d(2)}:{d(3)}", f"{d(4)} {d(4)}", pairs])


def generated_lines(lines: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    rng, out = random.Random(seed), []
    junk = ["", "", "", ",", ".", "&&&", "***", "!!", ";", ")", '"']
    word = lambda: "".join(rng.choice("abdeghilnorstuéñü") for _ in range(rng.randint(1, 8)))
    for _ in range(lines):
        text, gold = "", []
        for _ in range(rng.randint(1, 3)):
            text += "".join(word() + " " for _ in range(rng.randint(0, 3)))
            if rng.random() < 0.5:
                kind, s = positives(rng)
                gold.append((kind, len(text), len(text) + len(s)))
            else:
                s = negatives(rng)
            text += s + rng.choice(junk) + " "
        out.append((text + word(), gold))
    return out


@functools.lru_cache(maxsize=2)
def train(lines: int = 900, seed: int = 11, rounds: int = 6, rate: float = 0.3, shrink: float = 1e-4) -> Field:
    """Weights by AdaGrad on the conditional log-likelihood of generated lines; features seen once only are left out."""
    data, read = [], [(Stretch(text), gold) for text, gold in generated_lines(lines, seed)]
    seen_in = Counter(f for s, _ in read for f in {f for fs in s.features for f in fs})
    known = {f: i for i, f in enumerate(sorted(f for f, n in seen_in.items() if n > 1))}
    for s, gold in read:
        s.features = [[known[f] for f in fs if f in known] for fs in s.features]
        where = {(s.spans[i][0], s.spans[j - 1][1]): c for c, (i, j) in enumerate(s.candidates)}
        if lost := [s.text[a:b] for _, a, b in gold if (a, b) not in where]:
            raise ValueError(f"generated entities that are no candidates: {lost}")
        data.append((s, [(where[a, b], KINDS.index(k)) for k, a, b in gold]))
    weights = np.full((len(known), len(KINDS)), -0.2)
    seen = np.full(weights.shape, 1e-6)
    field, rng = Field(known, weights), random.Random(seed)
    for _ in range(rounds):
        rng.shuffle(data)
        for s, gold in data:
            if not s.candidates:
                continue
            scores, n = field.scores(s), len(s.spans)
            total = np.logaddexp.reduce(scores, axis=1)
            ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
            ahead[0] = behind[n] = 0.0
            ending: dict[int, list[int]] = {}
            starting: dict[int, list[int]] = {}
            for c, (i, j) in enumerate(s.candidates):
                ending.setdefault(j, []).append(c)
                starting.setdefault(i, []).append(c)
            for j in range(1, n + 1):
                terms = [ahead[j - 1]] + [ahead[s.candidates[c][0]] + total[c] for c in ending.get(j, ())]
                ahead[j] = np.logaddexp.reduce(terms)
            for i in range(n - 1, -1, -1):
                terms = [behind[i + 1]] + [behind[s.candidates[c][1]] + total[c] for c in starting.get(i, ())]
                behind[i] = np.logaddexp.reduce(terms)
            first, past = np.array(s.candidates).T
            slope = -np.exp(ahead[first, None] + scores + behind[past, None] - ahead[n])
            for c, k in gold:
                slope[c, k] += 1.0
            flat = np.concatenate([np.array(f, int) for f in s.features])
            step = np.zeros((len(flat), len(KINDS)))
            step[:] = np.repeat(slope, [len(f) for f in s.features], axis=0)
            ids, inverse = np.unique(flat, return_inverse=True)
            g = np.zeros((len(ids), len(KINDS)))
            np.add.at(g, inverse, step)
            g -= shrink * weights[ids]
            seen[ids] += g * g
            weights[ids] += rate * g / np.sqrt(seen[ids])
    return field


def stretches(text: str, taken: list[tuple[int, int]]):
    """(start, end) of the pieces to decode: around each seed, within its line, up to the taken spans."""
    taken, at, last = sorted(taken), 0, None
    for m in _SEED.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at < len(taken) and taken[at][0] <= a and taken[at][1] >= b:
            continue
        first, past = (_MARK.fullmatch(text, a, b) and mail_around(text, a, b)) or (a, b)
        first, past = max(0, min(a - AROUND, first - 2)), max(b + AROUND, past + 2)  # an address is seen with what stands beside it
        low = max(text.rfind("\n", first, a) + 1, first, taken[at - 1][1] if at else 0)
        line = text.find("\n", b, past)
        high = min(line if line >= 0 else past, len(text))
        for t in taken[at:at + 1]:
            if t[0] >= a:
                high = min(high, max(t[0], a))
            elif t[1] < b:  # the seed begins in a taken span and goes on behind it
                low = t[1]
        if high <= low:
            continue
        if last and low <= last[1]:
            last = (last[0], max(high, last[1]))
        else:
            if last:
                yield last
            last = (low, high)
    if last:
        yield last


def all_spans(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    base = base_spans(text)
    taken = [(a, b) for _, a, b in base]
    added = []
    for low, high in stretches(text, taken):
        for kind, a, b in field.decode(text[low:high]):
            a, b = a + low, b + low
            if not any(x < b and a < y for x, y in taken):
                added.append((kind, a, b))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if added else base


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): pattern counts, pattern spans, and all spans as kind:start:end."""
    schema = "n_email long, n_ip long, n_card long, n_phone long, base string, spans string"

    def run(batches):
        for batch in batches:
            rows = []
            for raw in column(batch, "text").to_pylist():
                base, spans = all_spans(raw.decode("utf-8", "replace"), field)
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS), joined(base), joined(spans)))
            out = table(schema, [list(c) for c in zip(*rows)] or [[]] * 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")


def masked(text: str, field: Field) -> str:
    """Every span as [KIND]; of spans that overlap, the later ones extend the first."""
    out, at = [], 0
    for kind, a, b in sorted(all_spans(text, field)[1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def mask(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, personal data in the text replaced by its kind; a null text stays null."""

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index(text_col)
            texts = pa.array([None if t is None else masked(t, field) for t in batch.column(i).to_pylist()], batch.schema.field(i).type)
            yield batch.set_column(i, batch.schema.field(i), texts)

    return docs.mapInArrow(run, docs.schema)
