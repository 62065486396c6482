"""Licence scans: a trained paragraph classifier whose predictions templates confirm.

Paragraphs (lines up to a line without words) are classified in overlapping windows of words (WINDOWS), and line by line, by
multinomial logistic regression over hashed word 1-, 2- and 3-grams: licence families, "other licence" and "no licence".  Every
window of every paragraph is scored in full; sums over windows are differences of running sums, for all classes at once.

Training takes variants of the templates below (words dropped, corpus words around them), made-up notices for "other licence",
and for "no licence" windows of at most `max_paragraphs` corpus lines (a documented bound; those with half of the word pairs
of a template or a shape of notice are left out) as they are and with a few licence words strewn in.  After every pass small weights
are cut to nothing (L1), so the model is a short list of grams.  Two shapes of notice, the last template of every family with three or
more, and a fifth of the corpus lines are held out: a model fitted without them is scored on them.  Its temperature and the offset of
"no licence" are fitted to that, so that probabilities are calibrated on notices, shapes and lines that training hasn't seen.  The
final model is fitted on everything.

A family is reported only when its template confirms it: at least `contained` of the word pairs of one of its templates occur in
the window, among them all that tell families of like wording apart (TELLING).  A window has the family of its best confirmed template
(largest share, then longest); of windows that rest on mostly the same words the better one counts.  A paragraph with a window that is
likely a licence, but with none that is confirmed, counts as unknown.

The weights of the grams that have any are the only thing broadcast; one task fits them on the bounded sample.

Cases: a null or empty text is one empty paragraph without a licence; rows that repeat a doc_id are scanned each on their own;
without any corpus text nothing is learnt but the templates; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import compress, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import mix64, smallest_hashes, word_hashes

BITS = 17
SLICE = 40_000  # words that are scored at once

#: Notices as published by the licences' authors; fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "mit": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
        "The MIT License (MIT)",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
    "all-rights-reserved": ("All rights reserved.", "This material may not be copied or distributed. All rights reserved."),
}
#: Words that tell families of like wording apart: a template's own must all be there, and follow what they follow in it; fixed values.
TELLING = frozenset(b"general affero lesser 2 2.0 2.1 3 by by-nc by-sa attribution attribution-noncommercial attribution-sharealike mit isc bsd-style apache mozilla cc0 spdx-license-identifier".split())
OTHER, NONE = "other", "none"
#: (words, step) of the windows: any run of up to words - step words lies whole in one; the longest template has under 48.
WINDOWS = ((16, 4), (32, 8), (64, 16))
#: Shapes of notices of licences that are none of the families; fixed values.
NOTICES = ("Licensed under the {} License.", "Released under the {} License, version {}.", "This work is licensed under the {} terms.", "Distributed under the {} Public License.", "Copying is permitted under the {} licence.", "You may use this work under the terms of the {} License.")

_CLEAN = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 or c in (45, 46, 10) else 32) for c in range(256))
#: Dots and hyphens that begin or end a word.
_EDGES = re.compile(rb"(?<![^ \n])[.-]+|[.-]+(?![^ \n])")
CLASSES = (*TEMPLATES, OTHER, NONE)


def _cleaned(text: str | None) -> bytes:
    raw = b" " + (text or "").encode("utf-8", "surrogatepass").translate(_CLEAN) + b" "
    for _ in range(4):  # as _EDGES does, but quicker where few dots or hyphens stand together
        before = len(raw)
        for edge in (b". ", b".\n", b"- ", b"-\n"):
            raw = raw.replace(edge, edge[1:])
        for edge in (b" .", b"\n.", b" -", b"\n-"):
            raw = raw.replace(edge, edge[:1])
        if len(raw) == before:
            return raw
    return _EDGES.sub(b"", raw)


def _words(text: str | None) -> list[bytes]:
    """The words; one that follows itself counts once."""
    return [w for w, _ in groupby(_cleaned(text).split())]


def _grams(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the 1-, 2- and 3-grams, each by its first word."""
    with np.errstate(over="ignore"):
        two = mix64(h[:-1] * np.uint64(3) + h[1:])
        three = mix64(two[:-1] * np.uint64(5) + h[2:])
    return tuple((x >> np.uint64(64 - BITS)).astype(np.int64) for x in (h, two, three))


def _features(words: list[bytes]) -> np.ndarray:
    """All grams, with repeats, so that a window's score is a sum over its grams."""
    return np.concatenate(_grams(word_hashes(words)))


def _pairs(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:], strict=False)) or {(w, b"") for w in words}


#: Of each template all pairs, and those that must be there.
KNOWN = {name: [(x := _pairs(w := _words(t)), {p for p in x if p[1] in TELLING or p[0] == b"spdx-license-identifier"} | ({(w[0], w[1])} if w[0] in TELLING else set())) for t in texts] for name, texts in TEMPLATES.items()}


def confirmation(pairs: set[tuple[bytes, bytes]], name: str, contained: float = 0.8) -> tuple[float, int, set[tuple[bytes, bytes]]] | None:
    """Share and length of the family's template that words with these pairs hold best, and its pairs; None where they hold none."""
    held = [(len(x & pairs) / len(x), len(x), n) for n, (x, must) in enumerate(KNOWN[name]) if must <= pairs and len(x & pairs) >= contained * len(x)]
    return (*max(held)[:2], KNOWN[name][max(held)[2]][0]) if held else None


def confirmed(words: list[bytes], name: str, contained: float = 0.8) -> bool:
    return confirmation(_pairs(words), name, contained) is not None


@dataclass
class Scanner:
    grams: np.ndarray  # those with any weight
    rows: np.ndarray  # their weights for each class
    bias: np.ndarray
    temperature: float
    classes: list[str]
    accuracy: float = 1.0  # on the held-out texts, of the model without them

    @classmethod
    def of(cls, weights: np.ndarray, *rest) -> Scanner:
        grams = np.flatnonzero(weights.any(1))
        return cls(grams, weights[grams].astype(np.float32), *rest)

    @cached_property
    def weights(self) -> np.ndarray:
        """2^BITS x classes, made where it is used."""
        out = np.zeros((1 << BITS, len(self.classes)), np.float32)
        out[self.grams] = self.rows
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "weights"}

    def scores(self, h: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Calibrated scores of the windows [at, end) of words with hashes h; at ascends, and no window has more than WINDOWS' words."""
        out = np.zeros((len(at), len(self.classes)))
        longest = WINDOWS[-1][0]
        for begin in range(0, len(h), SLICE):
            low, high = np.searchsorted(at, [begin, begin + SLICE])
            if low == high:
                continue
            first, last, count = at[low:high] - begin, end[low:high] - begin, np.zeros(high - low)
            for k, ids in enumerate(_grams(h[begin : begin + SLICE + longest])):
                sums = np.zeros((len(ids) + 1, len(self.classes)))
                np.cumsum(self.weights[ids], axis=0, dtype=np.float64, out=sums[1:])
                stop = np.maximum(last - k, first)
                count += stop - first
                out[low:high] += sums[np.minimum(stop, len(ids))] - sums[np.minimum(first, len(ids))]
            out[low:high] /= np.sqrt(np.maximum(count, 1))[:, None]
        return (out + self.bias) / self.temperature

    def probabilities(self, words: list[bytes]) -> np.ndarray:
        """Of one window, plainly."""
        x = _features(words)
        return _softmax((self.weights[x].sum(0, dtype=np.float64) / np.sqrt(max(len(x), 1)) + self.bias)[None] / self.temperature)[0]


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _rows(plain: list[list[bytes]], templates: dict[int, list[str]], shapes: Sequence[str], rng: np.random.Generator, many: int, lost: float = 0.06) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and classes of variants of these templates and shapes, and of windows of plain lines."""
    pool = [w for p in plain for w in p] or [b"the"]
    legal = sorted({w for texts in templates.values() for t in texts for w in _words(t)})
    rows: list[tuple[list[bytes], int]] = []

    def window(words: list[bytes]) -> list[bytes]:
        size = (int(rng.integers(1, 8)), *(w for w, _ in WINDOWS))[int(rng.integers(0, len(WINDOWS) + 1))]
        at = int(rng.integers(0, max(len(words) - size, 0) + 1))
        return words[at : at + size]

    def varied(words: list[bytes]) -> list[bytes]:
        kept = [w for w in words if len(words) < 4 or rng.random() > lost] or words
        around = [pool[i] for i in rng.integers(0, len(pool), int(rng.integers(0, 25)))] if rng.random() < 0.5 else []
        cut = int(rng.integers(0, len(around) + 1))
        return around[:cut] + kept + around[cut:]

    for _ in range(-(-many // len(plain)) if plain else 0):  # a small corpus counts as much as the templates' variants
        for w in plain:
            own = window(w)
            rows.append((own, len(CLASSES) - 1))
            if rng.random() < 0.1:  # a word over and over
                rows.append(([own[0]] * len(own), len(CLASSES) - 1))
            if rng.random() < 0.3:  # ordinary prose may speak of licences
                mixed = list(own)
                for _ in range(int(rng.integers(1, 4))):
                    mixed.insert(int(rng.integers(0, len(mixed) + 1)), legal[int(rng.integers(0, len(legal)))] if legal else b"licence")
                rows.append((mixed, len(CLASSES) - 1))
    for c, texts in templates.items():
        rows += [(varied(_words(t)), c) for t in texts for _ in range(60)]
    for shape in shapes:
        for _ in range(60):
            name = b" ".join(pool[i] for i in rng.integers(0, len(pool), 2)).decode("utf-8", "replace")
            rows.append((varied(_words(shape.format(name, rng.integers(1, 9)))), len(CLASSES) - 2))
    order = rng.permutation(len(rows))
    return [_features(rows[i][0]) for i in order], np.array([rows[i][1] for i in order], np.int64)


def _fit(x: list[np.ndarray], y: np.ndarray, epochs: int, l1: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by stochastic gradients with a rate for each gram; after each pass weights shrink by l1, small ones to nothing."""
    weights, bias, seen = np.zeros((1 << BITS, len(CLASSES))), np.zeros(len(CLASSES)), np.full((1 << BITS, 1), 1e-6)
    for _ in range(epochs):
        for ids, c in zip(x, y, strict=True):
            scale = 1 / np.sqrt(max(len(ids), 1))
            p = _softmax((weights[ids].sum(0) * scale + bias)[None])[0]
            p[c] -= 1
            seen[ids] += scale * scale * (p @ p)
            weights[ids] -= 0.3 * scale * p / np.sqrt(seen[ids])
            bias -= 0.02 * p
        weights = np.sign(weights) * np.maximum(np.abs(weights) - l1, 0)
    return weights, bias


def _calibrated(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Temperature, and what to add to the score of "no licence", with the least loss on held-out texts."""
    best = (np.inf, 1.0, 0.0)
    for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0):
        for add in np.linspace(-4, 4, 33):
            moved = scores.copy()
            moved[:, -1] += add
            best = min(best, (float(-np.log(_softmax(moved / t)[np.arange(len(y)), y] + 1e-12).mean()), t, float(add)))
    return best[1], best[2]


def fitted(lines: list[str | None], epochs: int = 5, seed: int = 11) -> Scanner:
    """The scanner that these corpus lines (in a fixed order) and the templates give."""
    rng = np.random.default_rng(seed)
    shapes = [_pairs(_words(n.format("", ""))) for n in NOTICES]
    notice = lambda w: any(len(x & _pairs(w)) >= 0.5 * len(x) for x in shapes) or any(confirmed(w, name, 0.5) for name in KNOWN)
    corpus = [w for line in lines if (w := _words(line)) and not notice(w)]
    kept, held, templates = [w for i, w in enumerate(corpus) if i % 5], corpus[::5], {c: list(t) for c, t in enumerate(TEMPLATES.values())}
    x, y = _rows(kept, {c: t[:-1] if len(t) > 2 else t for c, t in templates.items()}, NOTICES[:-2], rng, 1500)
    weights, bias = _fit(x, y, epochs)
    x, y = _rows(held, {c: t[-1:] for c, t in templates.items()}, NOTICES[-2:] * 4, rng, 800, 0.18)
    scores = np.array([weights[ids].sum(0) / np.sqrt(max(len(ids), 1)) + bias for ids in x])
    temperature, add = _calibrated(scores, y)
    scores[:, -1] += add
    accuracy = float(((scores.argmax(1) == len(CLASSES) - 1) == (y == len(CLASSES) - 1)).mean())  # licence or none
    x, y = _rows(corpus, templates, NOTICES, rng, 1500)
    weights, bias = _fit(x, y, epochs)
    bias[-1] += add
    return Scanner.of(weights, bias, temperature, list(CLASSES), accuracy)


def train(docs: DataFrame, max_paragraphs: int = 4000) -> Scanner:
    """Fit on a line of each of max_paragraphs documents, those with the smallest hashes; one task does it."""
    texts = docs.where("text IS NOT NULL")
    lines = texts.select(F.xxhash64(F.lit("licence"), "doc_id", "text").alias("order"), "doc_id", F.split("text", "\n", -1).alias("l"))
    lines = smallest_hashes(lines, "order", texts.count(), max_paragraphs)
    line = F.element_at("l", (F.pmod("order", F.size("l").cast("long")) + 1).cast("int"))
    picked = lines.select("order", "doc_id", line.alias("line")).orderBy("order", "doc_id", "line").limit(max_paragraphs)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        s = fitted(group.sort_values(["order", "doc_id", "line"])["line"].tolist())
        return pd.DataFrame({"grams": [s.grams.tobytes()], "rows": [s.rows.tobytes()], "bias": [s.bias.tobytes()], "temperature": [s.temperature], "accuracy": [s.accuracy]})

    got = picked.withColumn("all", F.lit("all")).groupBy("all").applyInPandas(fit, "grams binary, rows binary, bias binary, temperature double, accuracy double").first()
    if got is None:
        return fitted([])
    return Scanner(np.frombuffer(got["grams"], np.int64), np.frombuffer(got["rows"], np.float32).reshape(-1, len(CLASSES)), np.frombuffer(got["bias"]), got["temperature"], list(CLASSES), got["accuracy"])


def _windows(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and paragraph of each window over paragraphs of these sizes, laid end to end."""
    first = np.cumsum(size) - size
    out = []
    for n, (words, step) in enumerate(WINDOWS):
        # The longer windows of a paragraph that one of the shorter ones holds would be the same again.
        pieces = np.where(size > (WINDOWS[n - 1][0] if n else 0), 1 + -(-np.maximum(size - words, 0) // step), 0)
        of = np.repeat(np.arange(len(size)), pieces)
        at = first[of] + step * (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        out.append((at, np.minimum(at + words, (first + size)[of]), of))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


@dataclass
class _Batch:
    """The words of some texts, laid end to end, with their paragraphs and windows."""

    words: list[bytes]
    hashes: np.ndarray
    of_doc: np.ndarray  # paragraph -> text
    at: np.ndarray
    end: np.ndarray
    of: np.ndarray  # window -> paragraph

    @classmethod
    def of_texts(cls, texts: Sequence[str | None]) -> _Batch:
        words: list[bytes] = []
        sizes: list[int] = []
        lines: list[int] = []
        for t in texts:
            split = [line.split() for line in _cleaned(t).split(b"\n")]
            sizes += map(len, split)
            sizes.append(0)  # a text ends its last paragraph
            lines.append(len(split) + 1)
            for own in split:
                words += own
        by_line, h = np.array(sizes, np.int64), word_hashes(words)
        line = np.repeat(np.arange(len(by_line)), by_line)
        again = np.concatenate([[False], (h[1:] == h[:-1]) & (line[1:] == line[:-1])])[: len(h)]
        if again.any():  # a word that follows itself counts once
            words, h, by_line = list(compress(words, ~again)), h[~again], by_line - np.bincount(line[again], minlength=len(by_line))
        starts = (by_line > 0) & (np.concatenate([[0], by_line[:-1]]) == 0)
        of_line = np.cumsum(starts) - 1
        of_doc = np.repeat(np.arange(len(texts)), lines)[starts]
        size = np.bincount(of_line[by_line > 0], by_line[by_line > 0], len(of_doc)).astype(np.int64)
        at, end, of = _windows(size)
        alone = np.flatnonzero((by_line > 0) & (by_line <= WINDOWS[-1][0]) & (by_line < size[np.maximum(of_line, 0)] if len(size) else False))
        stop = np.cumsum(by_line)[alone]  # a short notice on a line of its own
        at, end, of = (np.concatenate(x) for x in ((at, stop - by_line[alone]), (end, stop), (of, of_line[alone])))
        order = np.argsort(at, kind="stable")
        return cls(words, h, of_doc, at[order], end[order], of[order])


def scan(docs: DataFrame, scanner: Scanner, likely: float = 0.7, contained: float = 0.8, rows: int = 200) -> DataFrame:
    """doc_id, n_paragraphs, licences (confirmed families, sorted), n_confirmed, n_unknown, best (highest probability of a confirmed family)."""
    sent = docs.sparkSession.sparkContext.broadcast(scanner)
    names = ["doc_id", "n_paragraphs", "licences", "n_confirmed", "n_unknown", "best"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Scanner = sent.value
        for whole in batches:
            for a in range(0, whole.num_rows, rows):
                b = whole.slice(a, rows)
                of_docs = scanned(s, b.column(1).to_pylist(), likely, contained)
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*of_docs, strict=True), kinds[1:], strict=True))], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_paragraphs long, licences array<string>, n_confirmed long, n_unknown long, best double")


def scanned(s: Scanner, texts: Sequence[str | None], likely: float, contained: float) -> list[tuple[int, list[str], int, int, float]]:
    """n_paragraphs, licences, n_confirmed, n_unknown, best of each text."""
    x = _Batch.of_texts(texts)
    found: list[set[str]] = [set() for _ in texts]
    best, sure, likely_ones = [0.0] * len(texts), set(), set()
    claims: dict[int, list[tuple[float, int, float, str, set[int], int]]] = defaultdict(list)  # of each text
    if x.words:
        scores = s.scores(x.hashes, x.at, x.end)
        others = len(s.classes) - 1
        # The other classes' exp(score - none's score) must sum to likely / (1 - likely): one of them to its share at least.
        near = np.flatnonzero((scores[:, :-1].max(1) - scores[:, -1]) >= np.log(likely / (1 - likely) / others) - 1e-9)
        for i, p in zip(near.tolist(), _softmax(scores[near]), strict=True):
            if p[-1] > 1 - likely:
                continue
            likely_ones.add(int(x.of[i]))
            part, pairs = x.words[x.at[i] : x.end[i]], None
            for c, name in enumerate(s.classes[:-2]):
                if p[c] >= likely / 2:
                    pairs = pairs or _pairs(part)
                    if held := confirmation(pairs, name, contained):
                        places = {int(x.at[i]) + k for k, pair in enumerate(zip(part, part[1:], strict=False)) if pair in held[2]}
                        claims[int(x.of_doc[x.of[i]])].append((held[0], held[1], float(p[c]), name, places, int(x.of[i])))
    for d, own in claims.items():
        taken: dict[str, set[int]] = defaultdict(set)  # family -> places of its pairs
        for _, _, prob, name, places, paragraph in sorted(own, key=lambda c: (-c[0], -c[1], -c[2], c[3], c[5])):
            if any(2 * len(places & theirs) > len(places) for other, theirs in taken.items() if other != name):
                continue  # the words of a better one
            taken[name] |= places
            found[d].add(name)
            sure.add(paragraph)
            best[d] = max(best[d], prob)
    count = lambda paragraphs: np.bincount(x.of_doc[sorted(paragraphs)], minlength=len(texts)) if paragraphs else np.zeros(len(texts), np.int64)
    held, n_sure, n_unknown = np.bincount(x.of_doc, minlength=len(texts)), count(sure), count(likely_ones - sure)
    return [(max(int(held[d]), 1), sorted(found[d]), int(n_sure[d]), int(n_unknown[d]), best[d]) for d in range(len(texts))]
