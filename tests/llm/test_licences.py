"""The batch scan against every window scored plainly, precision and recall on planted notices, and prose that speaks of licences."""

import pickle

import numpy as np
import pytest

from pelagia.llm import licences


def words(rng, n, vocabulary=3000):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def scanner():
    rng = np.random.default_rng(1)
    return licences.fitted([words(rng, int(rng.integers(1, 60))) for _ in range(800)])


def plain(s, text, likely=0.7, contained=0.8):
    """Every window of every paragraph, one after another."""
    paragraphs, lines = [], []
    for line in [licences._words(x) for x in (text or "").split("\n")] + [[]]:
        if line:
            lines.append(line)
        elif lines:
            paragraphs.append(lines)
            lines = []
    claims, likely_ones, start = [], set(), 0
    for number, own in enumerate(paragraphs):
        flat = [w for line in own for w in line]
        parts = [(a, flat[a : a + size]) for size, step in licences.WINDOWS for a in range(0, max(len(flat) - size, 0) + step, step)]
        at = 0
        for line in own:
            if len(line) <= 64:
                parts.append((at, line))
            at += len(line)
        for a, part in parts:
            p = s.probabilities(part) if part else [0.0] * (len(s.classes) - 1) + [1.0]
            if p[-1] > 1 - likely:
                continue
            likely_ones.add(number)
            for c, n in enumerate(s.classes[:-2]):
                for template in licences.TEMPLATES[n]:
                    words = licences._words(template)
                    pairs, have = set(zip(words, words[1:])), list(zip(part, part[1:]))
                    telling = {x for x in pairs if x[1] in licences.TELLING or x[0] == b"spdx-license-identifier"} | ({(words[0], words[1])} if words[0] in licences.TELLING else set())
                    share = len(pairs & set(have)) / len(pairs)
                    if p[c] >= likely / 2 and share >= contained and telling <= set(have):
                        claims.append((-share, -len(pairs), -p[c], n, number, {start + a + i for i, x in enumerate(have) if x in pairs}))
        start += len(flat)
    best_of = {}
    for c in sorted(claims, key=lambda c: c[:5]):  # the best template of each family and window
        best_of.setdefault((c[3], c[4], frozenset(c[5])), c)
    taken, found, sure, best = {}, set(), set(), 0.0
    for _, _, prob, n, number, places in sorted(best_of.values(), key=lambda c: c[:5]):
        if not any(2 * len(places & theirs) > len(places) for other, theirs in taken.items() if other != n):
            taken[n] = taken.get(n, set()) | places
            found.add(n)
            sure.add(number)
            best = max(best, -prob)
    return max(len(paragraphs), 1), sorted(found), len(sure), len(likely_ones - sure), best


#: Notices in full, as projects print them, and the family that each must give alone.
FULL = {
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version.\n\nYou should have received a copy of the GNU General Public License\nalong with this program; if not, write to the Free Software\nFoundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301, USA.",
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "mit": 'MIT License\n\nCopyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n3. Neither the name of the copyright holder nor the names of its contributors\n   may be used to endorse or promote products derived from this software\n   without specific prior written permission.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "cc-by-sa-4.0": "Except where noted, content is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


@pytest.mark.parametrize("family", sorted(FULL))
def test_full_notices_give_their_own_family_alone(scanner, family):
    rng = np.random.default_rng(5)
    texts = [FULL[family], FULL[family].replace("\n", " "), f"{words(rng, 80)}\n\n# {FULL[family]}\n\n{words(rng, 80)}", FULL[family].upper(), FULL[family].replace("\n", "\n * ")]
    assert [r[1] for r in licences.scanned(scanner, texts, 0.7, 0.8)] == [[family]] * 5


def test_templates_and_identifiers_give_their_own_family_alone(scanner):
    rng = np.random.default_rng(6)
    for name, texts in licences.TEMPLATES.items():
        for t in texts:
            assert [r[1] for r in licences.scanned(scanner, [t, f"{words(rng, 20)}\n{t}\n{words(rng, 9)}", f"// {t}"], 0.7, 0.8)] == [[name]] * 3, t


def test_two_licences_of_one_paragraph(scanner):
    text = "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."
    assert licences.scanned(scanner, [text], 0.7, 0.8)[0][1] == ["apache-2.0", "mit"]
    assert licences.scanned(scanner, [FULL["gpl-2.0"] + "\n" + FULL["agpl-3.0"]], 0.7, 0.8)[0][1] == ["agpl-3.0", "gpl-2.0"]


def test_the_model_is_sparse_and_travels(scanner):
    again = pickle.loads(pickle.dumps(scanner))
    assert "weights" not in vars(again) and (again.weights == scanner.weights).all()
    assert len(scanner.grams) < 0.6 * 2**licences.BITS and (scanner.rows != 0).mean() < 0.2


def fixture():
    rng = np.random.default_rng(2)
    notices = [(n, t) for n, texts in licences.TEMPLATES.items() for t in texts]
    texts = [None, "", "\n\n", "...", "w1", "retry retry retry retry retry " * 20, words(rng, 20_000)]
    want = [set() for _ in texts]
    for i in range(120):
        name, notice = notices[int(rng.integers(0, len(notices)))]
        lines = [words(rng, int(rng.integers(1, 40))) for _ in range(int(rng.integers(1, 5)))]
        if i % 2:
            lines.insert(int(rng.integers(0, len(lines) + 1)), notice if i % 4 == 1 else notice.upper())
        texts.append(("\n\n" if i % 3 else "\n").join(lines))
        want.append({name} if i % 2 else set())
    return texts, want


def test_scan_is_every_window_scored(scanner):
    texts, _ = fixture()
    got = licences.scanned(scanner, texts, 0.7, 0.8)
    for text, mine in zip(texts, got, strict=True):
        n, found, sure, unknown, best = plain(scanner, text)
        assert mine[:4] == (n, found, sure, unknown) and abs(mine[4] - best) < 1e-4, (text or "")[:80]


def test_precision_and_recall_of_planted_notices(scanner):
    texts, want = fixture()
    got = [set(r[1]) for r in licences.scanned(scanner, texts, 0.7, 0.8)]
    hits = sum(len(g & w) for g, w in zip(got, want, strict=True))
    assert hits >= 0.95 * sum(map(len, want)) and hits >= 0.95 * sum(map(len, got))


def test_prose_about_licences_is_none(scanner):
    rng = np.random.default_rng(3)
    texts = [f"{words(rng, 12)} the licence {words(rng, 5)} copyright {words(rng, 12)}" for _ in range(50)]
    assert np.mean([bool(r[1]) for r in licences.scanned(scanner, texts, 0.7, 0.8)]) == 0
    assert np.mean([bool(r[3]) for r in licences.scanned(scanner, texts, 0.7, 0.8)]) <= 0.1


def test_long_slices_give_the_same_scores(scanner, monkeypatch):
    rng = np.random.default_rng(4)
    b = licences._Batch.of_texts([words(rng, 900), words(rng, 30), "Released under the MIT License."])
    whole = scanner.scores(b.hashes, b.at, b.end)
    monkeypatch.setattr(licences, "SLICE", 100)
    assert np.allclose(whole, scanner.scores(b.hashes, b.at, b.end), atol=1e-6)
    assert len(set(b.of.tolist())) == len(b.of_doc) == 3


def test_word_edges():
    assert licences._words("...a.b- -c.--- d-e v2.0. -.-.-.-.-.-.-.-.-.-") == [b"a.b", b"c", b"d-e", b"v2.0"]
