"""License scans: a paragraph classifier over hashed word n-grams, confirmed by comparison with templates.

A paragraph is a run of lines with words, so that blank lines and lines of comment marks end it; line ends and marks within do not count.
What is judged are its passages. First come the places where a template may stand: all windows of a template's length and a quarter more
that hold enough of its words and pairs, over line ends and anywhere in a long line, less those that lie in a better one. The other lines are
judged by themselves, in pieces of ``PIECE`` words. A passage's features are its distinct words, pairs and triples of words (alphanumeric, A-Z lower-cased), hashed to
``SLOTS``. A multinomial logistic regression with one class per licence family and one for everything else is trained here on notices
made from the templates (words dropped, swapped and added by a seeded generator) and on pieces of lines of the corpus that share at most a
few n-grams with any template: at most ``TRAINING_LINES`` distinct ones, from about as many documents chosen by a hash of id and text. A temperature fitted
on further generated lines and other lines of the corpus calibrates the probabilities, and a passage whose best family stays below ``CERTAIN`` is unknown. A family
is confirmed if at least ``CONFIRMED`` of a template's words and pairs occur in the passage.

Odd input: null and empty texts have no paragraphs; lines without words are none; null ids are passed through; repeated rows are scanned each
on its own; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import Words, buffers, chunks, distinct, grams, mixed, separators, table

SLOTS = 1 << 15
TRAINING_LINES = 3000
CERTAIN, CONFIRMED = 0.7, 0.6
PIECE = 64  # words
_ALNUM = separators("alnum")

# Notices as their licences ask for, or as commonly written; fixed values.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "mit": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Licensed under the BSD 3-Clause License."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "all-rights-reserved": ["Copyright the author. All rights reserved."],
}
FAMILIES = list(TEMPLATES)
NONE = len(FAMILIES)


class Paragraphs:
    """Words of a batch with the lines they stand in; a line of more than ``PIECE`` words counts as several."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        words = Words(raw, off, _ALNUM)
        line_ends = np.flatnonzero(raw == 10)
        line = np.searchsorted(line_ends, words.start)
        document = words.rows()
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (document[1:] != document[:-1])
        begin = np.flatnonzero(new)
        apart = np.ones(len(line), bool)  # a line without words, or a document's end, between this word and the one before
        apart[1:] = (line[1:] - line[:-1] > 1) | (document[1:] != document[:-1])
        self.block = np.cumsum(apart) - 1  # run of lines of each word
        self.block_document = document[apart]
        new |= (np.arange(len(line)) - np.repeat(begin, np.diff(np.append(begin, len(line))))) % PIECE == 0
        self.first = np.append(np.flatnonzero(new), len(line))  # of each paragraph's words
        self.document = document[self.first[:-1]]
        self.start = words.start[self.first[:-1]]
        self.line = np.cumsum(new) - 1  # paragraph of each word
        self.hashes = words.hashes

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        return features(self.hashes, self.line)


def features(hashes: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, slot) of every n-gram, each once per passage."""
    owner, slot = [], []
    for n in (1, 2, 3):
        g = grams(hashes, n)
        if len(g):
            inside = passage[: len(g)] == passage[n - 1:]
            owner.append(passage[: len(g)][inside])
            slot.append((g[inside] >> np.uint64(49)).astype(np.int64))
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = distinct(np.concatenate(owner) * SLOTS + np.concatenate(slot))
    return both // SLOTS, both % SLOTS


def paragraphs_of(texts: list[str]) -> Paragraphs:
    col = pa.array([t.encode() for t in texts], pa.large_binary())
    return Paragraphs(*buffers(col))


def parts(text_hashes: np.ndarray) -> set[int]:
    """Words and pairs, as hashes."""
    return set(text_hashes.tolist()) | set(grams(text_hashes, 2).tolist())


def template_parts() -> list[list[set[int]]]:
    return [[parts(paragraphs_of([t]).hashes) for t in ts] for ts in TEMPLATES.values()]


class Templates:
    """Where templates may stand in the words of a batch."""

    def __init__(self):
        each = [paragraphs_of([t]).hashes for ts in TEMPLATES.values() for t in ts]
        self.parts = [parts(h) for h in each]
        self.size = [len(h) + len(h) // 4 + 1 for h in each]
        self.words = distinct(np.concatenate(each))
        self.pairs = distinct(np.concatenate([grams(h, 2) for h in each]))
        # one column per template; the last row is for whatever is in no template
        self.has_word = np.array([[*np.isin(self.words, h), False] for h in each])
        self.has_pair = np.array([[*np.isin(self.pairs, grams(h, 2)), False] for h in each])

    def windows(self, p: Paragraphs) -> list[tuple[int, int]]:
        """(first word, one past the last) of passages that hold at least ``CONFIRMED`` of a template's parts, in order and without the lesser of two at one place."""
        n = len(p.hashes)
        if not n:
            return []

        def numbered(values: np.ndarray, known: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(known, values), len(known) - 1)
            return np.where(known[at] == values, at, len(known))

        word, pair = numbered(p.hashes, self.words), numbered(grams(p.hashes, 2), self.pairs)
        pair[p.block[1:] != p.block[:-1]] = len(self.pairs)
        last = np.append(np.flatnonzero(np.diff(p.block)) + 1, n)[p.block]  # one past the paragraph's last word
        places = np.arange(n)
        found = []
        for t, size in enumerate(self.size):
            hit, hits = self.has_word[t][word], self.has_pair[t][pair]
            sums, more = np.concatenate([[0], np.cumsum(hit)]), np.concatenate([[0], np.cumsum(hits)])
            end = np.minimum(places + size, last)
            # parts with their repetitions are at least the distinct ones
            enough = sums[end] - sums[:-1] + more[np.maximum(end - 1, places)] - more[places] >= CONFIRMED * len(self.parts[t])
            for a in np.flatnonzero(hit & enough).tolist():
                b = a + int(np.flatnonzero(hit[a: end[a]])[-1]) + 1
                part = len(parts(p.hashes[a:b]) & self.parts[t]) / len(self.parts[t])
                if part >= CONFIRMED:
                    found.append((part * len(self.parts[t]), a, b))
        kept, taken = [], {}
        for _, a, b in sorted(found, key=lambda f: (-f[0], f[2] - f[1], f[1])):
            held = [taken[k] for k in range(a, b) if k in taken]
            if 2 * len(held) <= b - a and not any(held.count(o) * 2 > kept[o][1] - kept[o][0] for o in set(held)):
                taken.update((k, len(kept)) for k in range(a, b) if k not in taken)
                kept.append((a, b))
        return sorted(kept)


@dataclass
class Model:
    weights: np.ndarray  # SLOTS x classes
    intercept: np.ndarray
    temperature: float = 1.0

    def probabilities(self, owner: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        return softmax(self.logits(owner, slot, n) / self.temperature)

    def logits(self, owner: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        size = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))
        first = np.searchsorted(owner, np.arange(n))
        rows = np.concatenate([self.weights[slot], np.zeros((1, self.weights.shape[1]), self.weights.dtype)])
        sums = np.add.reduceat(rows, first, axis=0) if n else np.zeros((0, len(self.intercept)))
        return sums * size[:, None] + self.intercept


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True) if len(z) else z


def notices(copies: int, seed: int, filler: list[str]) -> list[tuple[str, int]]:
    """Varied notices of every family, and lines that only resemble them."""
    rng, out = random.Random(seed), []
    word = lambda: rng.choice(filler)
    pool = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    for k, ts in enumerate(TEMPLATES.values()):
        for _ in range(copies):
            words = rng.choice(ts).split()
            if rng.random() < 0.5 and len(words) > 6:
                del words[rng.randrange(len(words))]
            if rng.random() < 0.3:
                words.insert(rng.randrange(len(words) + 1), word())
            if rng.random() < 0.3:
                words = [word() for _ in range(rng.randint(1, 4))] + words
            if rng.random() < 0.3:
                words += [word() for _ in range(rng.randint(1, 4))]
            out.append((" ".join(words), k))
    for _ in range(4 * copies):  # words of notices, but no notice
        out.append((" ".join(rng.choice(pool) if rng.random() < 0.4 else word() for _ in range(rng.randint(3, 14))), NONE))
    return out


def fitted(lines: list[tuple[str, int]], rounds: int = 150) -> Model:
    p = paragraphs_of([t for t, _ in lines])
    owner, slot = p.features()
    y = np.array([c for _, c in lines])[p.document]
    n, classes = len(y), NONE + 1
    model = Model(np.zeros((SLOTS, classes)), np.zeros(classes))
    size = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))
    target = np.eye(classes)[y]
    used, at = np.unique(slot, return_inverse=True)
    w, b, seen_w, seen_b = np.zeros((len(used), classes)), np.zeros(classes), 1e-6, 1e-6
    first = np.searchsorted(owner, np.arange(n))
    by_slot = np.argsort(at, kind="stable")
    slot_first = np.searchsorted(at[by_slot], np.arange(len(used)))
    for _ in range(rounds):
        z = np.add.reduceat(w[at], first, axis=0) * size[:, None] + b
        e = (target - softmax(z)) * size[:, None] / n
        g = np.add.reduceat(e[owner[by_slot]], slot_first, axis=0) - 1e-6 * w
        gb = e.sum(axis=0)
        seen_w, seen_b = seen_w + g * g, seen_b + gb * gb
        w += 0.5 * g / np.sqrt(seen_w)
        b += 0.5 * gb / np.sqrt(seen_b)
    model.weights[used], model.intercept = w, b
    return model


def train(docs: DataFrame, text_col: str = "text", copies: int = 60, seed: int = 5, id_col: str = "doc_id") -> Model:
    """The classifier from generated notices and a bounded sample of the corpus' lines."""
    known = set().union(*(s for ts in template_parts() for s in ts))

    def plain(batches):
        for _, col in chunks(batches):
            raw, off = buffers(col)
            p = Paragraphs(raw, off)
            out = []
            begin = p.hashes[p.first[:-1]] ^ np.diff(p.first).astype(np.uint64)
            for k in np.flatnonzero(mixed(begin) % np.uint64(8) == 0).tolist():
                h = p.hashes[p.first[k]: p.first[k + 1]]
                if len(parts(h) & known) <= 3:
                    end = np.flatnonzero(raw[p.start[k]: p.start[k] + 2000] == 10)
                    stop = min(p.start[k] + (int(end[0]) if len(end) else 2000), int(off[p.document[k] + 1]))
                    out.append(raw[p.start[k]: stop].tobytes().decode("utf-8", "ignore"))
            yield table("line string", [out])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    share = min(1.0, TRAINING_LINES / max(1, src.count()))
    chosen = src.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else src
    lines = chosen.select("text").mapInArrow(plain, "line string").distinct().orderBy(F.xxhash64("line"), "line").limit(TRAINING_LINES)
    corpus = [r.line for r in lines.collect()]
    filler = sorted({w for line in corpus[:200] for w in line.split()[:20]}) or ["the", "and"]
    model = fitted(notices(copies, seed, filler) + [(t, NONE) for t in corpus[::2]])
    held = notices(copies // 3, seed + 1, filler) + [(t, NONE) for t in corpus[1::2]]
    p = paragraphs_of([t for t, _ in held])
    y = np.array([c for _, c in held])[p.document]
    z = model.logits(*p.features(), len(y))
    rest = [(-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean(), t) for t in np.geomspace(0.2, 5, 60)]
    model.temperature = float(min(rest)[1])
    return model


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, n_confirmed, n_unknown, licenses, best_family, best_probability, best_overlap) per row.

    ``n_confirmed`` counts confirmed passages and ``licenses`` are their families, sorted and comma-joined; ``n_unknown`` counts passages that are likelier
    some licence than none, but neither certain nor confirmed; ``best_*`` describe the confirmed passage of the highest probability.
    """
    schema = ("n_paragraphs long, n_confirmed long, n_unknown long, licenses string, best_family string, best_probability double, "
              "best_overlap double")
    templates, places = template_parts(), Templates()
    weights = docs.sparkSession.sparkContext.broadcast(model.weights.astype(np.float32))  # SLOTS x classes numbers

    def run(batches):
        own = Model(weights.value, model.intercept, model.temperature)
        for batch, col in chunks(batches):
            p = Paragraphs(*buffers(col))
            windows = places.windows(p)
            covered = np.zeros(len(p.hashes) + 1, np.int64)
            for a, b in windows:
                covered[a] += 1
                covered[b] -= 1
            covered = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
            alone = np.flatnonzero(covered[p.first[1:]] == covered[p.first[:-1]])  # lines that hold no word of a window
            first = np.concatenate([p.first[:-1][alone], np.array([a for a, _ in windows], np.int64)])
            past = np.concatenate([p.first[1:][alone], np.array([b for _, b in windows], np.int64)])
            n, size = len(first), past - first
            begin = np.cumsum(size) - size
            words = np.arange(int(size.sum())) + np.repeat(first - begin, size)
            prob = own.probabilities(*features(p.hashes[words], np.repeat(np.arange(n), size)), n)
            document = p.block_document[p.block[first]]
            rows = [[k, 0, 0, set(), None, None, None] for k in np.bincount(p.block_document, minlength=len(col)).tolist()]
            for k in np.flatnonzero(prob[:, NONE] < 0.5).tolist() if n else []:
                family = int(prob[k, :NONE].argmax())
                here, certain = parts(p.hashes[first[k]: past[k]]), float(prob[k, family])
                overlap = max(len(here & t) / len(t) for t in templates[family])
                row = rows[document[k]]
                if certain >= CERTAIN and overlap >= CONFIRMED:
                    row[1] += 1
                    row[3].add(FAMILIES[family])
                    if row[5] is None or certain > row[5]:
                        row[4:] = [FAMILIES[family], certain, overlap]
                else:
                    row[2] += 1
            for row in rows:
                row[3] = ",".join(sorted(row[3]))
            out = table(schema, [list(c) for c in zip(*rows)] or [[]] * 7)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["doc_id", *out.schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")
