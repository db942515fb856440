"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Every line of every whole text is looked at in overlapping windows of ``WINDOWS`` words, a short line as a
whole. The words of a window (lower-cased, marks dropped) give sparse features, word n-grams of one to three
words that occur in a template; a multinomial logistic regression turns them into the probabilities of the
licence families and of "unknown". It is trained on the templates, on
variants of them (random cuts and foreign words), and on at most ``FIT_PARAGRAPHS`` paragraphs of
the corpus as "unknown" (those with the lowest hash; near copies of a template left out). A
temperature, fitted on examples kept out of training, calibrates the probabilities, so "unknown" gets what
the families cannot claim. A predicted family is confirmed when the window shares most word pairs with
one of its templates.

Whatever the classes say, every run of at most ``LONGEST`` words of a line that holds most word pairs of a
template is a confirmed finding, so a notice is found however long its line is; one of the pairs has to be
known to at most ``NAMING`` families, since pairs that more share name none of them. Where findings of several
families overlap, the one with the greater template share has the words; side by side they stay apart.
Findings of one family in a line, or in consecutive lines, are one.

A task holds the model, a text, and two bytes for each of its words; texts are read once and not shuffled.

Defined results: null and empty texts have no findings; equal rows get equal findings; lines without any
template word are unknown; without documents to learn from, the templates alone train the model. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.spread import lowest_hashes
from lodestrata.llm.words import slices, texts

# Notices that public licences ask to be reproduced, by family.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
    ],
    "reserved": [
        "All rights reserved.",
        "No part of this publication may be reproduced without prior permission of the publisher.",
    ],
}
FAMILIES = (*TEMPLATES, "unknown")
UNKNOWN = len(TEMPLATES)
FIT_PARAGRAPHS = 2000
FIT_CHARS = 2000  # longer paragraphs are scanned, but not learnt from
VARIANTS = 20
STEPS = 200
LEAST_PROBABILITY = 0.5
LEAST_SHARED = 0.6
WINDOWS = (12, 24, 48)  # words, each a half apart
LONGEST = WINDOWS[-1]  # as long as the longest template at least
NAMING = 3
PIECE_BYTES = 1 << 16
SEGMENT = 1 << 15  # words
FOREIGN, LINE_END = 0, 1  # codes; words of templates follow
# bytes of marks become blanks, capitals become small letters
_FOLD = bytes(32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_FOLD_LINES = bytes(1 if c == 10 else _FOLD[c] for c in range(256))


def words_of(paragraph: bytes) -> list[bytes]:
    return paragraph.translate(_FOLD).split()


def _grams(words: list[bytes]) -> Iterator[tuple[bytes, ...]]:
    for n in (1, 2, 3):
        yield from (tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def shared(words: list[bytes], template: list[bytes]) -> float:
    """Share of word pairs in common, of the shorter side; of words where there is no pair."""
    n = 2 if min(len(words), len(template)) > 1 else 1
    a, b = ({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (words, template))
    return len(a & b) / max(min(len(a), len(b)), 1)


@dataclass
class Classifier:
    """Weights per template n-gram; only words that occur in templates are looked at."""

    grams: dict[tuple[bytes, ...], int]
    known: frozenset[bytes]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[list[list[bytes]]]

    def rows(self, words: list[bytes]) -> list[int]:
        """Features of a paragraph: its distinct template n-grams."""
        found = set()
        hits = [i for i, w in enumerate(words) if w in self.known]
        for i in hits:
            for n in (1, 2, 3):
                gram = self.grams.get(tuple(words[i : i + n]))
                if gram is None:
                    if n > 1:
                        break
                    continue
                found.add(gram)
        return sorted(found)

    def probabilities(self, words: list[bytes]) -> np.ndarray:
        rows = self.rows(words)
        logits = (self.bias + self.weights[rows].sum(0) / np.sqrt(max(len(words), 1))) / self.temperature
        p = np.exp(logits - logits.max())
        return p / p.sum()


class Scanner:
    """The n-grams of a classifier as tables over word codes, and the searches in a coded text."""

    def __init__(self, model: Classifier):
        self.model = model
        self.words = [b"", b"\n", *sorted(model.known)]
        self.codes = {w: c for c, w in enumerate(self.words) if c > LINE_END} | {b"\x01": LINE_END}
        pairs = sorted(g for g in model.grams if len(g) == 2)
        number = {g: i + 1 for i, g in enumerate(pairs)}
        size = len(self.words)
        self.pair = np.zeros((size, size), np.int16)
        for g, i in number.items():
            self.pair[self.codes[g[0]], self.codes[g[1]]] = i
        # what an n-gram adds to each family over "unknown", as far as it adds
        gain = (model.weights[:, :UNKNOWN] - model.weights[:, [UNKNOWN]]).clip(0)
        triples = [g for g in model.grams if len(g) == 3]
        self.triple = np.zeros((len(pairs) + 1, size), np.int16)
        self.gains = np.zeros((size, UNKNOWN)), np.zeros((len(pairs) + 1, UNKNOWN)), np.zeros((len(triples) + 1, UNKNOWN))
        for g, row in model.grams.items():
            if len(g) == 1:
                self.gains[0][self.codes[g[0]]] = gain[row]
            elif len(g) == 2:
                self.gains[1][number[g]] = gain[row]
        for i, g in enumerate(triples):
            self.triple[number[g[:2]], self.codes[g[2]]] = i + 1
            self.gains[2][i + 1] = gain[model.grams[g]]
        self.margin = model.bias[:UNKNOWN] - model.bias[UNKNOWN]
        self.templates = [(f, {number[p] for p in zip(t, t[1:], strict=False)}) for f, ts in enumerate(model.templates) for t in ts]
        self.holds = np.zeros((len(pairs) + 1, len(self.templates)), bool)
        for j, (_, own) in enumerate(self.templates):
            self.holds[list(own), j] = True
        families = np.array([f for f, _ in self.templates])
        shared_by = np.array([len(set(families[row])) for row in self.holds])
        self.naming = self.holds & (shared_by <= NAMING)[:, None]

    def coded(self, text: bytes) -> np.ndarray:
        folded = text.translate(_FOLD_LINES).replace(b"\x01", b" \x01 ")
        parts, at = [], 0
        while at < len(folded):
            end = folded.find(b" ", at + PIECE_BYTES)
            end = len(folded) if end < 0 else end
            tokens = folded[at:end].split()
            parts.append(np.fromiter(map(self.codes.get, tokens, repeat(FOREIGN)), np.int16, len(tokens)))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int16)

    def plain(self, codes: np.ndarray) -> list[bytes]:
        """Words of codes; words that no template has are told apart by their place."""
        return [self.words[c] if c != FOREIGN else b"\x00%d" % i for i, c in enumerate(codes.tolist())]

    def claimed(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, float, float]]:
        """Windows that the classifier gives to a family: start, end, family, probability, template share."""
        firsts = np.concatenate([[0], ends + 1])
        sizes = np.append(ends, len(codes)) - firsts
        starts, stops = [], []
        for shorter, length in zip((0, *WINDOWS), WINDOWS, strict=False):
            own = sizes > shorter
            first, size, step = firsts[own], sizes[own], length // 2
            count = 1 + np.ceil((size - length).clip(0) / step).astype(np.int64)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(first, count) + np.minimum(nth * step, np.repeat((size - length).clip(0), count))
            starts.append(start)
            stops.append(np.minimum(start + length, np.repeat(first + size, count)))
        start, stop = np.concatenate(starts), np.concatenate(stops)
        order = np.argsort(start, kind="stable")
        start, stop = start[order], stop[order]
        edges = np.searchsorted(start, np.arange(0, len(codes) + SEGMENT, SEGMENT))
        for at, lo, hi in zip(range(0, len(codes), SEGMENT), edges[:-1], edges[1:], strict=False):
            part = codes[at : at + SEGMENT + LONGEST]
            pairs = self.pair[part[:-1], part[1:]]
            gains = self.gains[0][part]
            gains[:-1] += self.gains[1][pairs]
            gains[:-2] += self.gains[2][self.triple[pairs[:-1], part[2:]]]
            sums = np.concatenate([np.zeros((1, UNKNOWN)), np.cumsum(gains, 0)])
            a, b = start[lo:hi], stop[lo:hi]
            # a family cannot beat "unknown" by more than its n-grams add, each counted as often as it occurs
            most = (sums[b - at] - sums[a - at]) / np.sqrt(b - a)[:, None] + self.margin
            for i in np.flatnonzero((most > -1e-9).any(1)):
                words = self.plain(codes[a[i] : b[i]])
                if self.model.known.isdisjoint(words):
                    continue
                p = self.model.probabilities(words)
                family = int(p.argmax())
                if family != UNKNOWN and p[family] >= LEAST_PROBABILITY:
                    yield int(a[i]), int(b[i]), family, float(p[family]), max(shared(words, t) for t in self.model.templates[family])

    def matched(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, float, float]]:
        """Runs that hold most pairs of a template, as :meth:`claimed`."""
        pairs = self.pair[codes[:-1], codes[1:]]
        at = np.flatnonzero(pairs)
        number = pairs[at]
        present = np.zeros(len(self.holds), bool)
        present[number] = True
        for j in np.flatnonzero(self.naming[present].any(0)):
            family, own = self.templates[j]
            least = int(np.ceil(LEAST_SHARED * len(own) - 1e-9))
            hits = self.holds[number, j]
            where, what = at[hits], number[hits]
            near = len(where) >= least and (where[least - 1 :] - where[: len(where) - least + 1]) <= LONGEST - 2
            if not np.any(near):
                continue
            line = np.searchsorted(ends, where)
            yield from self._runs(family, own, least, self.naming[:, j], where.tolist(), what.tolist(), line.tolist(), codes)

    def _runs(self, family, own, least, naming, where, what, line, codes) -> Iterator[tuple[int, int, int, float, float]]:
        counts: dict[int, int] = {}
        left, best = 0, None
        for right, pair in enumerate(what):
            counts[pair] = counts.get(pair, 0) + 1
            while line[left] != line[right] or where[right] - where[left] > LONGEST - 2 or counts[what[left]] > 1:
                counts[what[left]] -= 1
                if not counts[what[left]]:
                    del counts[what[left]]
                left += 1
            if best and where[left] >= best[1]:
                yield self._run(best, family, own, codes)
                best = None
            if len(counts) >= least and (best is None or len(counts) > best[2]) and any(naming[p] for p in counts):
                best = where[left], where[right] + 2, len(counts)
        if best:
            yield self._run(best, family, own, codes)

    def _run(self, run, family, own, codes) -> tuple[int, int, int, float, float]:
        start, stop, count = run
        return start, stop, family, float(self.model.probabilities(self.plain(codes[start:stop]))[family]), count / len(own)


def train(unknown: list[bytes], seed: int = 11) -> Classifier:
    """Gradient descent on the penalised multinomial likelihood, then a temperature on kept-out examples."""
    rng = np.random.default_rng(seed)
    templates = [[words_of(t.encode()) for t in ts] for ts in TEMPLATES.values()]
    grams: dict[tuple[bytes, ...], int] = {}
    for ts in templates:
        for t in ts:
            for g in _grams(t):
                grams.setdefault(g, len(grams))
    known = frozenset(g[0] for g in grams if len(g) == 1)
    model = Classifier(grams, known, np.zeros((len(grams), len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0, templates)
    foreign = [w for u in unknown for w in words_of(u)] or [b"lorem"]
    examples: list[tuple[list[bytes], int]] = []
    for family, ts in enumerate(templates):
        for t in ts:
            examples.append((t, family))
            for _ in range(VARIANTS):
                keep = max(min(len(t), 4), int(len(t) * rng.uniform(0.6, 1.0)))
                start = rng.integers(0, len(t) - keep + 1)
                mixed = [foreign[i] for i in rng.integers(0, len(foreign), rng.integers(0, 4))]
                cut = int(rng.integers(0, len(mixed) + 1))
                examples.append((mixed[:cut] + t[start : start + keep] + mixed[cut:], family))
    for u in unknown:
        words = words_of(u)
        if words and max(shared(words, t) for ts in templates for t in ts) < LEAST_SHARED:
            examples.append((words, UNKNOWN))
    for _ in range(len(examples) // 4):  # template words out of context are unknown
        size = int(rng.integers(3, 15))
        pool = [t for ts in templates for t in ts]
        words = [(t := pool[rng.integers(len(pool))])[rng.integers(len(t))] if rng.random() < 0.3 else foreign[rng.integers(len(foreign))] for _ in range(size)]
        examples.append((words, UNKNOWN))
    x = np.zeros((len(examples), len(grams)))
    for i, (words, _) in enumerate(examples):
        x[i, model.rows(words)] = 1 / np.sqrt(max(len(words), 1))
    y = np.eye(len(FAMILIES))[[f for _, f in examples]]
    weight = 1 / y.sum(0).clip(1)[y.argmax(1)]
    weight /= weight.sum()
    held = np.arange(len(examples)) % 5 == 0
    fitted, speed = [model.weights, model.bias], [np.zeros_like(model.weights), np.zeros_like(model.bias)]
    for _ in range(STEPS):
        logits = x[~held] @ fitted[0] + fitted[1]
        p = np.exp(logits - logits.max(1, keepdims=True))
        off = (p / p.sum(1, keepdims=True) - y[~held]) * weight[~held, None]
        for w, v, g in zip(fitted, speed, (x[~held].T @ off + 1e-5 * fitted[0], off.sum(0)), strict=True):
            v *= 0.9
            v -= 20.0 * g
            w += v
    logits = x[held] @ fitted[0] + fitted[1]

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float(-((z - np.log(np.exp(z).sum(1, keepdims=True))) * y[held]).sum(1) @ weight[held])

    model.temperature = min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)
    return model


def fit(docs: DataFrame) -> Classifier:
    own = docs.where("text IS NOT NULL").select("text")
    rows = own.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    lines = own.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line").between(1, FIT_CHARS))
    sample = lowest_hashes(lines, rows, FIT_PARAGRAPHS, "line")
    return train(sorted({r["line"].encode() for r in sample.collect()}))


def findings(text: bytes, model: Classifier | Scanner) -> list[tuple[int, int, int, float, float]]:
    """Line numbers (first, last), family, probability and template share of each finding."""
    scanner = Scanner(model) if isinstance(model, Classifier) else model
    codes = scanner.coded(text)
    if not len(codes) or codes.max() <= LINE_END:
        return []
    ends = np.flatnonzero(codes == LINE_END)
    claims = [(False, c[4] >= LEAST_SHARED, c[3], c) for c in scanner.claimed(codes, ends)]
    ranked = sorted(claims + [(True, m[4], m[1] - m[0], m) for m in scanner.matched(codes, ends)], key=lambda r: r[:3])
    owner = np.full(len(codes), UNKNOWN, np.int8)
    for *_, (start, stop, family, _, _) in ranked:
        owner[start:stop] = family
    kept = [h for *_, h in ranked if 2 * np.count_nonzero(owner[h[0] : h[1]] == h[2]) > h[1] - h[0]]
    out: list[tuple[int, int, int, float, float]] = []
    last: dict[int, int] = {}
    for start, _, family, p, s in sorted(kept):
        line = int(np.searchsorted(ends, start))
        found = last.get(family)
        if found is not None and out[found][1] >= line - 1:
            out[found] = (out[found][0], line, family, max(out[found][3], p), max(out[found][4], s))
        else:
            last[family] = len(out)
            out.append((line, line, family, p, s))
    return out


def licences(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """``doc_id, first_line, last_line, family, probability, template_share, confirmed`` per finding."""
    model = model or fit(docs)
    names = np.array(FAMILIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for batch in slices(batches):
            rows = [(doc, *f) for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True) for f in findings(text, scanner)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.record_batch(
                {
                    "doc_id": pa.array(columns[0], pa.int64()),
                    "first_line": pa.array(columns[1], pa.int32()),
                    "last_line": pa.array(columns[2], pa.int32()),
                    "family": pa.array([names[f] for f in columns[3]], pa.string()),
                    "probability": pa.array(columns[4], pa.float64()),
                    "template_share": pa.array(columns[5], pa.float64()),
                    "confirmed": pa.array([s >= LEAST_SHARED for s in columns[5]], pa.bool_()),
                }
            )

    schema = "doc_id long, first_line int, last_line int, family string, probability double, template_share double, confirmed boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
