"""License scans: MinHash bands over text windows, then exact containment (operator 4).

Every text is read as windows of ``WINDOW`` words, each starting ``STRIDE``
words after the last, so that any ``STRIDE + SHINGLE - 1`` consecutive words
lie in one window.  Templates are cut into pieces of ``STRIDE`` words.  A
window and a piece meet where one of their MinHash bands agrees; the number of
bands is chosen so that a piece within a window is met with at least
``COLLISION`` probability (a template of many pieces has as many chances).
Each template met is then verified at that place by the exact share of its
shingles that the text has there.  Of templates that share most shingles (two
versions of a notice), only those of the greatest share count at one place.

The templates are a parameter of bounded size (``MAX_WORDS`` words in all) and
travel to every task; the scan itself is row-local, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, as_binary, hash_words

SHINGLE, STRIDE = 3, 6
WINDOW = 2 * STRIDE
COLLISION, THRESHOLD = 0.9999, 0.8
MAX_WORDS = 2_000_000
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_TABLE = 22  # bits of the table that tells most windows apart from all pieces

PASSAGE = 60  # words of a passage of a long license text
RIVALS = 0.5  # share of the smaller of two templates beyond which they are told apart by containment

# Notices by which texts state their license.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def production() -> dict[str, list[str]]:
    """All templates: the notices, further forms, and the passages of whole license texts that tell them apart.

    A passage counts where the other licenses have less than ``THRESHOLD`` of
    its shingles, so sections that several licenses share name none of them.
    """
    from . import license_texts  # only the driver needs them

    out = {name: [text] for name, text in NOTICES.items()}
    for name, forms in license_texts.FORMS.items():
        out.setdefault(name, []).extend(forms)
    short = np.unique(np.concatenate([shingles(t.encode()) for forms in out.values() for t in forms]))
    whole = {name: np.unique(shingles(text.encode())) for name, text in license_texts.TEXTS.items()}
    for name, text in license_texts.TEXTS.items():
        others = np.concatenate([short, *[s for other, s in whole.items() if other != name]])
        split = text.split()
        parts = [split[at : at + PASSAGE] for at in range(0, len(split), PASSAGE)]
        told = []
        while parts:
            part = parts.pop()
            passage = " ".join(part)
            if len(part) >= PASSAGE // 4 and np.isin(shingles(passage.encode()), others).mean() < THRESHOLD:
                told.append(passage)
            elif len(part) >= PASSAGE // 2:  # half of it may tell the license
                parts += part[: len(part) // 2], part[len(part) // 2 :]
        out.setdefault(name, []).extend(told)
    return out


def shingles(text: bytes | None) -> np.ndarray:
    """Hashes of a text's shingles, in order; a shorter text is one shingle, one without words has none."""
    h = hash_words(_WORD.findall((text or b"").lower()))
    if not len(h):
        return h
    size = min(SHINGLE, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = (out ^ h[i : len(h) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def bands_needed(piece: int, collision: float = COLLISION) -> int:
    """Bands of one row with which a piece of so many shingles inside a window is met with this probability."""
    similarity = min(1.0, piece / (WINDOW - SHINGLE + 1))
    return 1 if similarity == 1.0 else math.ceil(math.log(1.0 - collision) / math.log(1.0 - similarity))


class Templates:
    """The pieces' bands, and each template's set of shingles; a name may have several templates."""

    def __init__(self, rows: list[tuple[str, str]], collision: float = COLLISION) -> None:
        self.names, self.sets, self.lengths = [], [], []
        pieces = []  # template, offset, shingles
        for name, text in sorted(rows):
            if len(_WORD.findall(text.encode().lower())) < SHINGLE:
                raise ValueError(f"template {name!r} has fewer than {SHINGLE} words")
            s = shingles(text.encode())
            per_piece = STRIDE - SHINGLE + 1
            for at in range(0, max(1, len(s) - per_piece + 1), per_piece):
                pieces.append((len(self.names), at, s[at : at + per_piece]))
            self.names.append(name)
            self.sets.append(np.unique(s))
            self.lengths.append(len(s))
        if sum(self.lengths) > MAX_WORDS:
            raise ValueError(f"templates of more than {MAX_WORDS} words in all")
        fewest = min((len(p) for _, _, p in pieces), default=1)
        odd = np.random.default_rng(3).integers(1 << 62, 1 << 63, bands_needed(fewest, collision), np.uint64)
        self.odd = odd * np.uint64(2) + np.uint64(1)
        found = []  # key, template, offset
        self.table = np.zeros(1 << _TABLE, bool)
        for template, at, p in pieces:
            low = self._rows(p).min(axis=1)
            self.table[(low & np.uint64((1 << _TABLE) - 1)).astype(np.int64)] = True
            found += [(key, template, at) for key in self._keys(np.arange(len(low)), low).tolist()]
        found.sort()
        self.keys = np.array([k for k, _, _ in found], np.uint64)
        self.pieces = np.array([(t, at) for _, t, at in found], np.int64).reshape(-1, 2)
        self.rivals = self._rivals()

    @staticmethod
    def _keys(bands: np.ndarray, low: np.ndarray) -> np.ndarray:
        return low ^ (bands.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _rivals(self) -> list[list[int]]:
        """Of each template, those of other names that share more than ``RIVALS`` of the smaller one's shingles."""
        having: dict[int, list[int]] = {}
        for t, s in enumerate(self.sets):
            for h in s.tolist():
                having.setdefault(h, []).append(t)
        out = []
        for t, s in enumerate(self.sets):
            shared = Counter(r for h in s.tolist() for r in having[h])
            out.append([
                r for r, n in sorted(shared.items())
                if self.names[r] != self.names[t] and n > RIVALS * min(len(s), len(self.sets[r]))
            ])
        return out

    def _rows(self, s: np.ndarray) -> np.ndarray:
        mixed = s[None, :] * self.odd[:, None]
        return mixed ^ (mixed >> np.uint64(32))

    def candidates(self, s: np.ndarray) -> set[tuple[int, int]]:
        """(template, shingle at which it would begin) of all windows that meet a piece."""
        per_window = WINDOW - SHINGLE + 1
        blocks = -(-len(s) // STRIDE)
        rows = np.full((len(self.odd), (blocks + 1) * STRIDE), _LAST)
        rows[:, : len(s)] = self._rows(s)
        rows = rows.reshape(len(self.odd), blocks + 1, STRIDE)
        rest = rows[:, 1:, : per_window - STRIDE].min(axis=2)
        low = np.minimum(rows[:, :-1].min(axis=2), rest)
        bands, windows = np.nonzero(self.table[(low & np.uint64((1 << _TABLE) - 1)).astype(np.int64)])
        keys = self._keys(bands, low[bands, windows])
        first, last = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found = set()
        for i in np.flatnonzero(last > first).tolist():
            start = int(windows[i]) * STRIDE
            found.update((template, start - at) for template, at in self.pieces[first[i] : last[i]].tolist())
        return found

    def matches(self, text: bytes | None, threshold: float = THRESHOLD) -> dict[str, tuple[float, int]]:
        """Best containment of each template found, and the word where its place begins.

        A place is the template's length and a window on either side of where it would begin.
        It does not count where a rival's place overlaps it and holds a greater share of the
        rival, or as great a share of a longer one.
        """
        s = shingles(text)
        best: dict[str, tuple[float, int]] = {}
        if not len(s) or not self.names:
            return best
        places: dict[int, set[tuple[float, int, int]]] = {}  # by template: share, first and last shingle
        for template, start in sorted(self.candidates(s)):
            low, high = max(0, start - WINDOW), start + self.lengths[template] + WINDOW
            here = np.isin(self.sets[template], s[low:high]).mean()
            if here >= threshold:
                at = low + np.flatnonzero(np.isin(s[low:high], self.sets[template]))
                places.setdefault(template, set()).add((float(here), int(at[0]), int(at[-1])))
        columns = {t: [np.array(c) for c in zip(*found)] for t, found in places.items()}
        for template, found in places.items():
            rivals = [(len(self.sets[r]) > len(self.sets[template]), *columns[r]) for r in self.rivals[template] if r in columns]
            name = self.names[template]
            for here, first, last in sorted(found, key=lambda x: (-x[0], x[1])):
                if here < best.get(name, (0.0, 0))[0]:
                    break
                if here == best.get(name, (0.0, 0))[0] and first >= best[name][1]:
                    continue
                if not any((((share > here) | longer & (share == here)) & (a <= last) & (b >= first)).any() for longer, share, a, b in rivals):
                    best[name] = (here, first)
                    break
        return best


def scan(
    docs: DataFrame,
    templates: dict[str, str | list[str]] | None = None,
    threshold: float = THRESHOLD,
    collision: float = COLLISION,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, license, containment, first_word) of every document and template name found in it.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  Null and blank texts match nothing; repeated rows give
    repeated results.  A template needs ``SHINGLE`` words; a name may have
    several.  Without ``templates`` all of ``production`` are looked for.
    """
    forms = production() if templates is None else templates
    pairs = [(name, t) for name, texts in forms.items() for t in ([texts] if isinstance(texts, str) else texts)]
    found = docs.sparkSession.sparkContext.broadcast(Templates(pairs, collision))

    def run(batches):
        known = found.value
        for batch in batches:
            rows = []
            for i, t in enumerate(as_binary(batch, "text")):
                rows += [(i, name, c, at) for name, (c, at) in sorted(known.matches(t, threshold).items())]
            at = pa.array([r[0] for r in rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.float64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                ],
                names=["doc_id", "license", "containment", "first_word"],
            )

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(named, run, "doc_id long, license string, containment double, first_word long")
