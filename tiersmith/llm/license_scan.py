"""License scan: winnowed fingerprints, then banded alignment (operator 2).

Templates are cut into words; hashes of ``GRAM`` consecutive words are
winnowed (the least of every ``WINDOW`` neighbours is kept) into an inverted
index from fingerprint to template and place.  The same selection of a text's
grams finds every run of ``GRAM + WINDOW - 1`` shared words.  Hits of one
template that are near each other make a candidate region; where the region
holds enough of the template's words, a local alignment within a band around
its diagonals gives the matched words, their share of the whole template and
the spans in the text.

Variants of a license share most of their words, so a share is not enough:
``TELLING`` names words of a template that must be matched, and words of its
relatives that must not stand between the matched ones.  Where templates
overlap in a text, the one that leaves least unmatched wins.

The templates are whole license texts (``licenses/*.txt``), the standard
notices of files, and statements by which texts name their license.
Templates are a parameter of bounded size, so texts are scanned in one narrow
pass.  Defined cases: null and blank texts give no rows; a template that
occurs several times in a text gives a row each time; texts are scanned whole;
repeated rows give their rows again; other columns are ignored; templates of
fewer than ``GRAM`` words are refused; a match over half of which lies within
a better one (a statement in a notice, a notice in a license) is part of it.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM, WINDOW = 3, 2
MIN_COVERAGE = 0.8
_EDGE = b".,;:!?\"'()[]<>*#/"

# Whole texts, as files of the package.
TEXTS = ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "Apache-2.0", "MPL-1.1", "MPL-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0",
         "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0", "CC-BY-SA-4.0")

_GNU = {"GPL": ("", ("2", "3")), "LGPL": ("Lesser ", ("2.1", "3")), "AGPL": ("Affero ", ("3",))}
_CC = [(kind, version) for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for version in ("4.0", "3.0")]
_FOREIGN = ("lesser", "library", "affero", "documentation")


def _gnu_notice(kind: str, version: str, terms: str) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General
        Public License as published by the Free Software Foundation, {terms} This program is distributed in the hope
        that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details. You should have
        received a copy of the GNU {kind}General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>."""


def _spdx(name: str, version: str) -> str:
    return f"{name}-{version}" if "." in version else f"{name}-{version}.0"


# Standard notices of files, and statements by which texts name their license.
TEMPLATES = {
    "MIT (statement)": "Released under the MIT License.",
    "Apache-2.0 (statement)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
        the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause (statement)": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause (statement)": "Released under the BSD 3-Clause License.",
    "ISC (statement)": "Released under the ISC License.",
    "MPL-2.0 (statement)": "Licensed under the Mozilla Public License, version 2.0.",
    "MPL-2.0 (notice)": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    **{f"{_spdx(name, v)} (statement)": f"This work is licensed under the GNU {kind}General Public License, version {v}."
       for name, (kind, versions) in _GNU.items() for v in versions},
    **{f"{_spdx(name, v)}-or-later (notice)": _gnu_notice(kind, v, f"either version {v} of the License, or (at your option) any later version.")
       for name, (kind, versions) in _GNU.items() for v in versions},
    **{f"{_spdx(name, v)}-only (notice)": _gnu_notice(kind, v, f"version {v} of the License.")
       for name, (kind, versions) in _GNU.items() for v in versions},
    **{f"CC-{kind}-{v} (statement)": f"Licensed under CC {kind} {v}." for kind, v in _CC},
}

# Words of a template that must be matched, and words that must not stand unmatched between matched ones.
TELLING: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "MIT (statement)": (("mit",), ()),
    "MIT": (("subject", "portions"), ()),
    "Apache-2.0 (statement)": (("apache", "2.0"), ()),
    "Apache-2.0 (notice)": (("apache", "2.0"), ()),
    "BSD-2-Clause (statement)": (("bsd", "2-clause"), ()),
    "BSD-3-Clause (statement)": (("bsd", "3-clause"), ()),
    "BSD-2-Clause": (("redistribution", "binary"), ("neither", "endorse", "advertising")),
    "BSD-3-Clause": (("neither", "endorse"), ("advertising",)),
    "ISC (statement)": (("isc",), ()),
    "ISC": (("appear", "copies"), ()),
    "MPL-2.0 (statement)": (("mozilla", "2.0"), ()),
    "MPL-2.0 (notice)": (("mozilla", "2.0"), ()),
    "GPL-3.0": ((), ("remote",)),
    "LGPL-2.0": ((), ("2.1",)),
    "LGPL-2.1": (("2.1", "lesser"), ()),
    "CC-BY-SA-4.0": (("sharealike", "4.0"), ("noncommercial", "noderivatives")),
    **{f"{_spdx(name, v)}{form}": ((*kind.lower().split(), "public", v, *(["later"] if "later" in form else [])),
                                   (*(w for w in _FOREIGN if w != kind.strip().lower()), *(["later"] if "only" in form else [])))
       for name, (kind, versions) in _GNU.items() for v in versions for form in (" (statement)", "-or-later (notice)", "-only (notice)")},
    **{f"CC-{kind}-{v} (statement)": (("cc", kind.lower(), v), ()) for kind, v in _CC},
}


def all_templates() -> dict[str, str]:
    """``TEMPLATES`` and the whole texts (about 200 kB)."""
    return TEMPLATES | {name: pkgutil.get_data(__package__, f"licenses/{name}.txt").decode() for name in TEXTS}


def words_of(text: str | None) -> list[bytes]:
    return [w.strip(_EDGE) for w in text.encode("utf-8", "surrogatepass").lower().split()] if text else []


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of each run of ``GRAM`` words; the largest value where a word is in no template."""
    n = len(codes) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(GRAM):
        part = codes[j: j + n]
        h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        known &= part > 0
    return np.where(known, h >> np.uint64(1), np.uint64(2 ** 64 - 1))


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Places of the least hash of every ``WINDOW`` neighbours (the last of equal ones)."""
    if len(hashes) <= WINDOW:
        return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())] if len(hashes) else [], int)
    windows = np.lib.stride_tricks.sliding_window_view(hashes[::-1], WINDOW)
    least = np.arange(len(windows)) + windows.argmin(axis=1)
    return np.unique(len(hashes) - 1 - least)


class Index:
    """Vocabulary of the templates and their fingerprints' places."""

    def __init__(self, templates: Mapping[str, str], telling: Mapping[str, tuple[Sequence[str], Sequence[str]]] = TELLING):
        self.names = list(templates)
        self.vocabulary: dict[bytes, int] = {}
        self.codes = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(t)]) for t in templates.values()]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, codes in enumerate(self.codes):
            if len(codes) < GRAM:
                raise ValueError(f"template {self.names[t]!r} has fewer than {GRAM} words")
            hashes = _grams(codes)
            for at in winnow(hashes).tolist():
                self.places.setdefault(int(hashes[at]), []).append((t, at))
        self.known = np.array(sorted(self.places), np.uint64)
        self.counts = [np.bincount(codes) for codes in self.codes]
        self.required, self.foreign = [], []
        for name, codes in zip(self.names, self.codes):
            required, foreign = telling.get(name, ((), ()))
            unknown = [w for w in required if self.vocabulary.get(w.encode(), 0) not in codes]
            if unknown:
                raise ValueError(f"template {name!r} has no {unknown}")
            self.required.append({self.vocabulary[w.encode()] for w in required})
            self.foreign.append({w.encode() for w in foreign})

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(template, first and last hit in the text, least and largest diagonal)."""
        hashes = _grams(codes)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        near = np.flatnonzero(self.known[at] == hashes)
        if not len(near):
            return []
        # Grams of unknown words never win a window, so only the neighbours of known grams matter.
        about = np.unique(np.concatenate([near + d for d in range(-WINDOW + 1, WINDOW)]))
        about = about[(about >= 0) & (about < len(hashes))]
        chosen = set()
        for part in np.split(about, np.flatnonzero(np.diff(about) > 1) + 1):
            chosen.update((part[0] + winnow(hashes[part])).tolist())
        hits: dict[int, list[tuple[int, int]]] = {}
        for at in sorted(chosen):
            for t, place in self.places.get(int(hashes[at]), ()):
                hits.setdefault(t, []).append((at, at - place))
        out = []
        for t, found in hits.items():
            size = len(self.codes[t])
            group = [found[0]]
            least = most = found[0][1]
            for hit in found[1:]:
                # The range of diagonals stays bounded, so that copies in a row are not strung together.
                if (hit[0] - group[-1][0] <= size and abs(hit[1] - group[-1][1]) <= band(size)
                        and max(most, hit[1]) - min(least, hit[1]) <= 2 * band(size)):
                    group.append(hit)
                    least, most = min(least, hit[1]), max(most, hit[1])
                else:
                    out.append((t, group))
                    group = [hit]
                    least = most = hit[1]
            out.append((t, group))
        return [(t, g[0][0], g[-1][0], min(d for _, d in g), max(d for _, d in g)) for t, g in out]

    def _most(self, t: int, codes: np.ndarray, low: int, high: int) -> int:
        """Words that an alignment about these diagonals can match at most."""
        size, slip = len(self.codes[t]), band(len(self.codes[t]))
        there = np.bincount(codes[max(0, low - slip): max(0, high + slip + size + 1)])
        n = min(len(there), len(self.counts[t]))
        return int(np.minimum(there[1:n], self.counts[t][1:n]).sum())

    def scan(self, text: str | None, min_coverage: float = MIN_COVERAGE) -> list[dict]:
        words = words_of(text)
        if len(words) < GRAM:
            return []
        get = self.vocabulary.get
        codes = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        found: list[tuple[int, int, list[int]]] = []
        seen: dict[int, list[tuple[int, int]]] = {}
        tried: dict[int, list[tuple[int, int]]] = {}
        # Regions of many words first: what they settle is not aligned again.
        for t, begin, end, low, high in sorted(self.regions(codes), key=lambda r: (r[0], r[1] - r[2], r[1], r[3])):
            size = len(self.codes[t])
            step = band(size) if size >= 64 else 1  # bands of long templates start and end on a grid: fewer different ones
            low, high = low // step * step, -(-high // step) * step
            if self._most(t, codes, low, high) / size < min_coverage:
                continue
            if any(a <= low and high <= b for a, b in tried.get(t, ())) or any(a <= begin and end + GRAM <= b for a, b in seen.get(t, ())):
                continue
            tried.setdefault(t, []).append((low, high))
            pairs = align(self.codes[t], codes, low, high)
            if len(pairs) / size < min_coverage:
                continue
            places = [d for _, d in pairs]
            seen.setdefault(t, []).append((places[0], places[-1] + 1))
            between = (w for a, b in zip(places, places[1:]) if b > a + 1 for w in words[a + 1: b])
            if self.required[t] <= set(codes[places].tolist()) and self.foreign[t].isdisjoint(between):
                found.append((3 * len(places) - size - (places[-1] + 1 - places[0]), t, places))
        taken: set[int] = set()
        out = []
        for _, t, places in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if 2 * sum(p in taken for p in places) <= len(places):
                taken.update(range(places[0], places[-1] + 1))
                out.append({"license": self.names[t], "matched": len(places), "coverage": len(places) / len(self.codes[t]),
                            "start": places[0], "stop": places[-1] + 1, "spans": spans(places), "_t": t})
        return [{k: v for k, v in row.items() if k != "_t"} for row in sorted(out, key=lambda r: (r["start"], r["_t"]))]


def band(size: int) -> int:
    """Words that an alignment may slip to either side."""
    return max(4, size // 8)


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Matched (template, text) places of the best local alignment whose
    diagonal (text minus template) stays within a band about ``low`` to ``high``."""
    slip = band(len(template))
    first, width, n = low - slip, high - low + 2 * slip + 1, len(text)
    at = np.arange(width)
    above = np.zeros(width + 1, np.int64)
    moves = np.zeros((len(template), width), np.uint8)
    top, top_at = 0, (0, 0)
    for i, code in enumerate(template.tolist()):
        # Diagonal k of the row above is one word back in both; k + 1 skips a template word, k - 1 a text word.
        a, b = max(0, -first - i), min(width, n - first - i)
        row = np.zeros(width + 1, np.int64)
        if a < b:
            same = text[first + i + a: first + i + b] == code
            score = above[a:b] + np.where(same, 2, -1)
            how = np.where(same, 1, 2)
            skipped = above[a + 1: b + 1] - 1
            how[skipped > score] = 3
            score = np.maximum(score, skipped)
            # Text words skipped at one point each: the best start of a run is a running maximum.
            best = np.maximum.accumulate(np.maximum(score, 0) + at[a:b]) - at[a:b]
            how[best > np.maximum(score, 0)] = 4
            how[best <= 0] = 0
            row[a:b], moves[i, a:b] = best, how
            k = int(best.argmax())
            if best[k] > top:
                top, top_at = int(best[k]), (i, a + k)
        above = row
    pairs = []
    i, k = top_at
    while top and i >= 0 and 0 <= k < width and moves[i, k]:
        how = moves[i, k]
        if how == 1:
            pairs.append((i, first + i + k))
        if how <= 2:
            i -= 1
        elif how == 3:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return pairs[::-1]


def spans(places: Sequence[int]) -> list[dict]:
    """Runs of consecutive places as start and stop (exclusive)."""
    out: list[dict] = []
    for p in places:
        if out and out[-1]["stop"] == p:
            out[-1]["stop"] = p + 1
        else:
            out.append({"start": p, "stop": p + 1})
    return out


MATCH = "struct<license:string,matched:long,coverage:double,start:long,stop:long,spans:array<struct<start:long,stop:long>>>"


def scan_licenses(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", templates: Mapping[str, str] | None = None,
                  min_coverage: float = MIN_COVERAGE, telling: Mapping[str, tuple[Sequence[str], Sequence[str]]] = TELLING) -> DataFrame:
    """A row per match: ``keep``, ``license``, ``matched`` words, ``coverage`` of
    the template, ``start`` and ``stop`` (word places in the text) and the
    ``spans`` of matched words.  Templates default to ``all_templates()``."""
    chosen, told = dict(all_templates() if templates is None else templates), dict(telling)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(chosen, told)
        for batch in batches:
            yield pd.Series([index.scan(t, min_coverage) for t in batch])

    found = F.pandas_udf(run, f"array<{MATCH}>")(F.col(text))
    return df.select(*keep, F.explode(found).alias("_m")).select(*keep, "_m.*")
