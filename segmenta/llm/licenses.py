"""Operator 6: licence scans.

Text and templates are normalised to lower-case words.  A passage of a text is compared with a template by the Dice
coefficient of their word-bigram multisets.  Size bounds prune: Dice >= t needs a passage of between t/(2-t) and (2-t)/t
times the template's bigrams, and at least t/(2-t) times that many shared ones, so only passages that begin and end at a
shared bigram, within those sizes, are looked at.  Per template the passage of the highest Dice is taken, then the best of
what does not overlap it, and so on.  Of passages of several templates that overlap, the one stays whose shared bigrams
exceed the threshold by the most, 2 * shared - t * (both sizes): a whole notice with the holder's name in it is not lost to a
sentence or to another licence's conditions within it.  Passages of like sizes compare by Dice.

Templates are the notices and sentences below, and the whole notices and terms in ``license_texts``; a name is the
licence's SPDX name with what the text is (``-line``, ``-notice``, ``-terms``).  README has the list's coverage.

Null and empty texts have no hits; ties go to the earlier passage, then to the template's name; repeated rows give
repeated results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pkgutil
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textarrays import distinct_chunks, ragged_take, text_rows, text_slices

#: The notices and terms that these licences ask users to state.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
        for more details.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc0-line": "Released into the public domain under CC0 1.0 Universal.",
}

#: Sibling versions of the sentences and notices above.
LICENSED = "This work is licensed under the GNU {} Public License{}."
NOTICE = """This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published
    by the Free Software Foundation, either version {2} of the License, or (at your option) any later version. This {0} is distributed
    in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
    A PARTICULAR PURPOSE. See the GNU {1} Public License for more details."""
ONLY = """This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public License, version {2},
    as published by the Free Software Foundation. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY
    WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} Public License
    for more details."""
GNU = (("gpl", "General", "program", ("1.0", "2.0", "3.0")), ("lgpl", "Library General", "library", ("2.0",)),
       ("lgpl", "Lesser General", "library", ("2.1", "3.0")), ("agpl", "Affero General", "program", ("3.0",)))
for name, kind, work, versions in GNU:
    for version in versions:
        said = version.removesuffix(".0")
        TEMPLATES.setdefault(f"{name}-{version}-line", LICENSED.format(kind, f", version {said}"))
        TEMPLATES.setdefault(f"{name}-{version}", NOTICE.format(work, kind, said))
        TEMPLATES[f"{name}-{version}-only"] = ONLY.format(work, kind, said)
    TEMPLATES[f"{name}{'-library' if kind == 'Library General' else ''}-line"] = LICENSED.format(kind, "")
for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    full = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    long_name = "-".join(full[x] for x in kind.split("-"))
    for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        TEMPLATES.setdefault(f"cc-{kind.lower()}-{version}-line", f"Licensed under CC {kind} {version}.")
        TEMPLATES[f"cc-{kind.lower()}-{version}"] = (f"This work is licensed under a Creative Commons {long_name} {version} "
                                                     f"{'International' if version == '4.0' else 'Unported' if version == '3.0' else 'Generic'} License.")
TEMPLATES |= {
    "apache-1.0-line": "Licensed under the Apache License, Version 1.0.",
    "apache-1.1-line": "Licensed under the Apache License, Version 1.1.",
    "mit-0-line": "Released under the MIT-0 License.",
    "isc-line": "Released under the ISC License.",
    "bsd-2-clause-line": "Released under the BSD 2-Clause License.",
    "bsd-3-clause-line": "Released under the BSD 3-Clause License.",
    "mpl-1.1": """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed
        under the License is distributed on an "AS IS" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License
        for the specific language governing rights and limitations under the License.""",
    "epl-1.0": """All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public
        License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html""",
    "epl-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
        available at https://www.eclipse.org/legal/epl-2.0/""",
    "epl-2.0-accompanies": """All rights reserved. This program and the accompanying materials are made available under the terms of the
        Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-v20.html""",
    "0bsd-notice": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    "unlicense-notice": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
        or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
        dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the
        public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment
        in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org""",
    "zlib-notice": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin
        of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in
        a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must
        be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or
        altered from any source distribution.""",
}
#: Whole notices and terms, one file each.
TEXTS = """agpl-3.0-terms apache-1.1-notice apache-2.0-terms artistic-1.0-terms bsd-2-clause-notice bsd-3-clause-notice bsd-4-clause-notice
    cc-by-4.0-terms cc-by-nc-4.0-terms cc-by-nc-nd-4.0-terms cc-by-nc-sa-4.0-terms cc-by-nd-4.0-terms cc-by-sa-4.0-terms cc0-1.0-terms
    epl-1.0-terms epl-2.0-terms gfdl-1.2-terms gfdl-1.3-terms gpl-1.0-terms gpl-2.0-terms gpl-3.0-terms isc-notice lgpl-2.0-terms
    lgpl-2.1-terms lgpl-3.0-terms mit-0-notice mit-notice mpl-1.1-terms mpl-2.0-terms ncsa-notice ofl-1.1-terms
    unicode-3.0-notice""".split()
TEMPLATES |= {name: pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode() for name in TEXTS}

WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Scanner:
    """Templates as bigram multisets over the templates' own words; other words are 0."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        self.names = sorted(templates)
        lists = [words(templates[n]) for n in self.names]
        self.word = {w: i + 1 for i, w in enumerate(sorted({w for one in lists for w in one}))}
        self.base = len(self.word) + 1
        coded = [[self.word[w] for w in one] for one in lists]
        self.bigrams = [Counter(a * self.base + b for a, b in zip(one, one[1:], strict=False)) for one in coded]
        self.sizes = np.array([sum(c.values()) for c in self.bigrams])
        self.known = np.array(sorted({g for c in self.bigrams for g in c}), np.int64)
        #: how often a template (row) has a known bigram (column)
        self.has = np.zeros((len(self.names), len(self.known)), np.int32)
        for row, c in zip(self.has, self.bigrams, strict=True):
            row[np.searchsorted(self.known, list(c))] = list(c.values())
        self.need = np.ceil(threshold / (2 - threshold) * self.sizes - 1e-9).astype(np.int64)
        self.most = (2 - threshold) / threshold * self.sizes + 1e-9

    def passages(self, t: int, at: np.ndarray, grams: np.ndarray) -> list[tuple[float, int, int, int]]:
        """(Dice, template, first, past last bigram) of the best non-overlapping passages of one template.

        ``grams``: columns of ``known`` found at the places ``at``.
        """
        has, size, need, most = self.has[t], int(self.sizes[t]), int(self.need[t]), float(self.most[t])
        keep = has[grams] > 0
        at, grams = at[keep], grams[keep]
        n = len(at)
        if n < need:
            return []
        starts = np.flatnonzero(at[need - 1:] - at[:n - need + 1] + 1 <= most)
        if not len(starts):
            return []
        # a bigram counts in a passage from i on unless as many before it, from i on, use up the template's
        full = np.full(n, -1, np.int64)
        order = np.argsort(grams, kind="stable")
        ranks = np.arange(n) - np.searchsorted(grams[order], grams[order], side="left")
        times = has[grams[order]]
        over = np.flatnonzero(ranks >= times)
        full[order[over]] = order[over - times[over]]

        def best(i: int, end: int):
            """The best passage that begins at i and ends before ``end``, for the heap."""
            last = min(int(np.searchsorted(at, at[i] + most, side="left")), end)
            if last - i < need:
                return None
            shared = np.cumsum(full[i:last] < i)
            length = at[i:last] - at[i] + 1
            dice = 2 * shared / (length + size)
            dice[length > most] = 0
            j = len(dice) - 1 - int(dice[::-1].argmax())
            return (-dice[j], -int(length[j]), i, i + j) if dice[j] >= self.threshold else None

        heap = [p for p in (best(int(i), n) for i in starts) if p]
        heapq.heapify(heap)
        firsts, lasts, out = [], [], []
        while heap:
            dice, length, i, j = heapq.heappop(heap)
            k = bisect(firsts, i)
            if k and lasts[k - 1] >= i:
                continue
            if k < len(firsts) and firsts[k] <= j:
                if again := best(i, firsts[k]):
                    heapq.heappush(heap, again)
                continue
            firsts.insert(k, i)
            lasts.insert(k, j)
            out.append((float(-dice), t, int(at[i]), int(at[j]) + 1))
        return out

    def scan(self, coded: np.ndarray) -> list[tuple[float, int, int, int]]:
        """Accepted passages of one text given as word codes, in order of their place."""
        if len(coded) < 2:
            return []
        grams = coded[:-1] * self.base + coded[1:]
        at = np.flatnonzero((coded[:-1] > 0) & (coded[1:] > 0))
        column = np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)
        hit = self.known[column] == grams[at]
        at, column = at[hit], column[hit]
        if not len(at):
            return []
        each, n = np.unique(column, return_counts=True)
        able = np.flatnonzero(np.minimum(self.has[:, each], n).sum(1) >= self.need)
        return sorted(self.disjoint([p for t in able for p in self.passages(int(t), at, column)]), key=lambda p: p[2])

    def disjoint(self, found: list[tuple[float, int, int, int]]) -> list[tuple[float, int, int, int]]:
        """The best passage, then the best of those that do not overlap it, …; of equal ones the higher Dice, the longer, the earlier."""
        out: list[tuple[float, int, int, int]] = []
        firsts: list[int] = []
        # 2 * shared - threshold * (both sizes) = (Dice - threshold) * (both sizes)
        excess = {p: round((p[0] - self.threshold) * (p[3] - p[2] + int(self.sizes[p[1]])), 6) for p in found}
        for p in sorted(found, key=lambda p: (-excess[p], -p[0], p[2] - p[3], p[2], p[1])):
            k = bisect(firsts, p[2])
            if (not k or out[k - 1][3] <= p[2]) and (k == len(out) or p[3] <= firsts[k]):
                firsts.insert(k, p[2])
                out.insert(k, p)
        return out


@lru_cache(maxsize=2)
def scanner_of(templates: tuple[tuple[str, str], ...], threshold: float) -> Scanner:
    """One scanner per worker, not one per task."""
    return Scanner(dict(templates), threshold)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hits, license, dice, hits`` for every row.

    ``license`` and ``dice``: the best hit (null without one); ``hits``: ``license:first word:past last word`` joined by commas.
    """
    items = tuple(sorted((templates or TEMPLATES).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(items, threshold)
        for b in text_slices(batches):
            chunks, codes, _, rows = distinct_chunks(b.column("text"))
            lists = [[scanner.word.get(w, 0) for w in words(c)] for c in chunks.to_pylist()]
            ptr = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
            flat = np.fromiter((x for one in lists for x in one), np.int64, int(ptr[-1]))
            coded, at = ragged_take(ptr, flat, codes)
            at = at[rows]
            hits = [scanner.scan(coded[at[i]:at[i + 1]]) for i in range(b.num_rows)]
            best = [min(h, key=lambda p: (-p[0], p[2] - p[3], p[2]), default=None) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(at)), pa.array([len(h) for h in hits], pa.int64()),
                 pa.array([x and scanner.names[x[1]] for x in best], pa.string()), pa.array([x and x[0] for x in best], pa.float64()),
                 pa.array([",".join(f"{scanner.names[t]}:{s}:{e + 1}" for _, t, s, e in h) for h in hits], pa.string())],
                names=[id_col, "n_words", "n_hits", "license", "dice", "hits"])

    schema = f"{id_col} long, n_words long, n_hits long, license string, dice double, hits string"
    return text_rows(docs, id_col, text_col).mapInArrow(run, schema)
