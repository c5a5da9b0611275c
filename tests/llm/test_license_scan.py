import random

import numpy as np
import pytest

from bibliospark.llm import license_scan as ls

from .helpers import docs_frame, rows, words


def test_notices_are_found_wherever_they_stand(spark):
    rng = random.Random(1)
    texts, want = [], []
    for i in range(120):
        before, after = words(rng, rng.randrange(30)), words(rng, rng.randrange(30))
        name = rng.choice([None, *ls.NOTICES])
        texts.append(" ".join([*before, ls.NOTICES[name].upper() if name else "", *after]))
        if name:
            want.append((i, name))
    assert rows(ls.scan(docs_frame(spark, texts)), "doc_id", "license") == sorted(want)


def test_containment_is_exact():
    known = ls.Templates(list(ls.NOTICES.items()))
    text = ls.NOTICES["MIT-text"].split()
    rng = random.Random(2)
    for edits in (0, 3, 8, 30):
        out = list(text)
        for at in rng.sample(range(len(out)), edits):
            out[at] = f"other{at}"
        raw = " ".join(words(rng, 50) + out + words(rng, 50)).encode()
        a, b = set(ls.shingles(ls.NOTICES["MIT-text"].encode()).tolist()), set(ls.shingles(raw).tolist())
        share = len(a & b) / len(a)
        got = known.matches(raw)
        assert ("MIT-text" in got) == (share >= ls.THRESHOLD)
        if "MIT-text" in got:
            assert np.isclose(got["MIT-text"][0], share)


def test_collision_probability_of_the_bands():
    for piece in (1, 2, 3, 4, 10):
        similarity = piece / (ls.WINDOW - ls.SHINGLE + 1)
        assert 1 - (1 - similarity) ** ls.bands_needed(piece) >= ls.COLLISION


def test_recall_against_brute_force():
    rng = random.Random(3)
    templates = [(f"t{i}", " ".join(words(rng, rng.choice([3, 5, 9, 40]), 200))) for i in range(40)]
    known = ls.Templates(templates)
    missed = total = 0
    for _ in range(200):
        name, text = rng.choice(templates)
        raw = " ".join(words(rng, rng.randrange(80), 200) + text.split() + words(rng, rng.randrange(80), 200)).encode()
        total += 1
        missed += name not in known.matches(raw)
    assert missed <= 1


def test_edge_rows(spark):
    notice = ls.NOTICES["MIT"]
    far = "word " * 50_000 + notice
    df = docs_frame(spark, [None, "", notice, (2, notice), (None, notice), (6, far), (7, "Released under the")]).selectExpr("*", "'x' AS license")
    assert rows(ls.scan(df), "doc_id", "license", "first_word") == [(None, "MIT", 0), (2, "MIT", 0), (2, "MIT", 0), (6, "MIT", 50_000)]
    assert ls.scan(df.limit(0)).count() == 0
    assert ls.scan(df, templates={}).count() == 0
    with pytest.raises(ValueError, match="fewer than"):
        ls.scan(df, templates={"short": "two words"})


GRANT = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version. This program is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS "
    'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)


@pytest.fixture(scope="module")
def known():
    return ls.Templates([(name, t) for name, texts in ls.production().items() for t in texts])


@pytest.mark.parametrize(
    ("text", "name"),
    [
        (GRANT.format("General Public License", 3, "General Public License"), "GPL-3.0-header"),
        (GRANT.format("General Public License", 2, "General Public License"), "GPL-2.0-header"),
        (GRANT.format("Lesser General Public License", "2.1", "Lesser General Public License"), "LGPL-2.1-header"),
        (GRANT.format("Affero General Public License", 3, "Affero General Public License"), "AGPL-3.0-header"),
        (BSD.format(""), "BSD-2-Clause-text"),
        (BSD.format(THIRD), "BSD-3-Clause-text"),
        ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
         "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
         "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
         "this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for "
         "the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
         "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.", "Unlicense-text"),
        ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
         "http://www.boost.org/LICENSE_1_0.txt)", "BSL-1.0-header"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under CC BY-NC-SA 3.0.", "CC-BY-NC-SA-3.0"),
    ],
)
def test_headers_and_texts_that_no_notice_has(known, text, name):
    rng = random.Random(4)
    for _ in range(5):
        got = known.matches(" ".join([*words(rng, rng.randrange(40)), text, *words(rng, rng.randrange(40))]).encode())
        assert [n for n in got if n.endswith(("-header", "-text"))] == [name] * name.endswith(("-header", "-text"))
        assert name in got and {n.split("-header")[0].split("-text")[0] for n in got} == {name.split("-header")[0].split("-text")[0]}


def test_bodies_without_a_header(known):
    from bibliospark.llm.license_texts import TEXTS

    for name, text in TEXTS.items():
        body = text.split()
        assert name in known.matches(" ".join(body).encode()), name
        assert {n for n in known.matches(" ".join(body[: len(body) // 2]).encode()) if n in TEXTS} == {name}


def test_every_template_names_only_its_license(known):
    for name, texts in ls.production().items():
        for text in texts:
            got = known.matches(f"some words before {text} and after".encode())
            assert got[name][0] == 1.0, (name, text)
            assert all(n.removesuffix("-header").removesuffix("-text") == name.removesuffix("-header").removesuffix("-text") for n in got), (name, got)


def test_of_two_versions_each_is_found_at_its_place(known):
    two, three = (f"Licensed under the GNU General Public License, version {v}." for v in (2, 3))
    got = known.matches(f"{two} {'word ' * 60} {three}".encode())
    assert got == {"GPL-2.0": (1.0, 0), "GPL-3.0": (1.0, 69)}
