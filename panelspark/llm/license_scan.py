"""License scan by patience alignment with license templates.

A template is compared with a part of a text by words. Words that occur once in both are
anchors; the longest run of them that rises in both is kept, and the gaps between them
are aligned in the same way. What is matched, over the words of the template, is its
coverage. The words that identify a license (name, version, variant; ``IDENTITY``) must all
be matched, with no other word between them, so a near variant is not taken for it. In
templates of more than ``SHORT`` words only version and variant must be; another word of
the phrase may be changed, none put in. Titles and SPDX identifiers (``TITLES``) identify a
license as a whole, so they are found word for word.

The parts of a text that are worth aligning follow from the coverage asked for: a copy
that lacks at most ``m`` words of a template has one of any ``m + 1`` of them, so the
``m + 1`` words that are rarest in the text show all places where a copy can be. So
repeated licenses are found one by one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .base import utf8
from .decontamination import split_words

COVERAGE = 0.8

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_ADVERTISING = (
    " All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the organization."
)
_NO_NAME = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_GNU = (
    ("GPL-2.0", "", "2"),
    ("AGPL-3.0", "Affero ", "3"),
    ("LGPL-3.0", "Lesser ", "3"),
    ("LGPL-2.1", "Lesser ", "2.1"),
)
_GNU_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "{kind}General Public License as published by the Free Software Foundation, either version {version} "
    "of the License, or (at your option) any later version."
)
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

#: Identifiers of the SPDX license list, as they stand in source files.
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause "
    "BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 "
    "CC-BY-ND-4.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-3.0 ISC LGPL-2.1 "
    "LGPL-3.0 MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL NCSA OFL-1.1 PostgreSQL Python-2.0 Unlicense WTFPL Zlib"
).split()

#: Titles and identifiers, found only word for word.
TITLES = (
    *[(name, f"SPDX-License-Identifier: {name}") for name in SPDX],
    *[
        (name, f"GNU {kind}General Public License, version {version}")
        for name, kind, version in (("GPL-3.0", "", "3"), *_GNU)
    ],
    *[(f"CC-{by}-4.0", f"CC {by} 4.0") for by in ("BY-NC", *_CC)],
    ("MIT", "MIT License"),
    ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License 2.0"),
    ("Artistic-2.0", "Artistic License 2.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("OFL-1.1", "SIL Open Font License Version 1.1"),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
)

#: Public license notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        _BSD_2,
    ),
    ("BSD", "Released under the BSD License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("BSD-3-Clause", _BSD_2 + _NO_NAME),
    ("BSD-4-Clause", _BSD_2 + _ADVERTISING + _NO_NAME),
    *[
        (name, f"This work is licensed under the GNU {kind}General Public License, version {version}.")
        for name, kind, version in _GNU
    ],
    *[(name, _GNU_NOTICE.format(kind=kind, version=version)) for name, kind, version in _GNU],
    *[(f"CC-{by}-4.0", f"Licensed under CC {by} 4.0.") for by in _CC],
    *[
        (
            f"CC-{by}-4.0",
            f"This work is licensed under the Creative Commons {long} 4.0 International License.",
        )
        for by, long in _CC.items()
    ],
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute "
        "it freely, subject to the following restrictions:",
    ),
)
#: All that a scan looks for.
KNOWN = TEMPLATES + TITLES

#: Words of templates that short are all asked for where they identify the license.
SHORT = 20
VARIANTS = {b"affero", b"lesser", b"neither", b"advertising", b"attribution"}

#: Phrases that identify a license; those that are in a template must be in its copies.
_PHRASES = {
    "MIT": ("mit license",),
    "ISC": ("isc license",),
    "BSD": ("bsd license",),
    "BSD-2-Clause": ("bsd 2 clause license",),
    "BSD-3-Clause": ("bsd 3 clause license", "neither the name"),
    "BSD-4-Clause": ("all advertising materials",),
    "Apache-2.0": ("apache license version 2 0",),
    **{
        name: (
            f"gnu {kind.lower()}general public license",
            f"general public license version {version.replace('.', ' ')}",
            f"either version {version.replace('.', ' ')} of",
        )
        for name, kind, version in (("GPL-3.0", "", "3"), *_GNU)
    },
    **{
        f"CC-{by}-4.0": (
            f"cc {by.lower().replace('-', ' ')} 4 0",
            f"creative commons {long.lower().replace('-', ' ')} 4 0",
        )
        for by, long in (("BY-NC", "Attribution-NonCommercial"), *_CC.items())
    },
    "MPL-2.0": ("mozilla public license",),  # no other version has this notice
}


def _words(text: str) -> list[bytes]:
    return [w for part in split_words(text.encode()) for w in part]


IDENTITY = {name: [p.encode().split() for p in phrases] for name, phrases in _PHRASES.items()}
for _name, _title in TITLES:
    IDENTITY.setdefault(_name, []).append(_words(_title))


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest part of pairs (rising in the first) that rises in the second."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tails, y)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(y)
            at.append(i)
        else:
            tails[k], at[k] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two lists of words by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once: dict = {}
        for j in range(b0, b1):
            once[b[j]] = j if b[j] not in once else -1
        mine: dict = {}
        for i in range(a0, a1):
            if once.get(a[i], -1) >= 0:
                mine[a[i]] = i if a[i] not in mine else -1
        anchors = _rising([(i, once[w]) for w, i in mine.items() if i >= 0])
        if not anchors:
            continue
        left = (a0, b0)
        for i, j in anchors:
            todo.append((left[0], i, left[1], j))
            out.append((i, j))
            left = (i + 1, j + 1)
        todo.append((left[0], a1, left[1], b1))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        self.name = name
        self.words = _words(text)
        self.missing = int(len(self.words) * (1 - coverage) + 1e-9)
        self.slack = max(3, len(self.words) // 2)
        self.least = coverage * len(self.words) - 1e-9
        self.identity = [
            (i, i + len(p))
            for p in IDENTITY.get(name, ())
            for i in range(len(self.words) - len(p) + 1)
            if self.words[i : i + len(p)] == p
        ]
        whole = len(self.words) <= SHORT
        self.needed = {
            j: self.words[j]
            for first, end in self.identity
            for j in range(first, end)
            if whole or self.words[j].isdigit() or self.words[j] in VARIANTS
        }
        self.asked = frozenset(self.needed.values())
        if len(self.needed) == len(self.words):  # word for word: nothing may be put in
            self.slack = 0

    def identified(self, pairs: list[tuple[int, int]]) -> bool:
        """Whether the identifying phrases are matched, without other words put in."""
        if not self.identity:
            return True
        place = {j: i for i, j in pairs}
        return self.needed.keys() <= place.keys() and all(
            len({place[j] - j for j in range(first, end) if j in place}) <= 1 for first, end in self.identity
        )


def find_licenses(words: list[bytes], templates: list[Template], vocabulary: set) -> list[tuple]:
    """``(name, coverage, first, end)`` of the licenses in a text, best first where they
    overlap. Of overlapping findings the one with more matched words stays."""
    where: dict[bytes, list[int]] = {}
    for i, w in enumerate(words):
        if w in vocabulary:
            where.setdefault(w, []).append(i)
    found = []
    for t in templates:
        if not t.words or not where.keys() >= t.asked or sum(w in where for w in t.words) < t.least:
            continue
        rare = sorted(range(len(t.words)), key=lambda j: len(where.get(t.words[j], ())))
        starts = sorted(
            {i - j for j in rare[: t.missing + 1] for i in where.get(t.words[j], ())}
        )
        n, at = len(t.words), 0
        while at < len(starts):
            end = bisect_right(starts, starts[at] + t.slack, at)
            # a wide part, and if copies too near to each other spoil it, exact ones
            parts = [(max(0, starts[at] - t.slack), starts[end - 1] + n + t.slack)]
            parts += [(max(0, i), i + n) for i in starts[at:end]]
            best = None
            for low, high in parts:
                pairs = align(words[low:high], t.words)
                if len(pairs) >= t.least and t.identified(pairs):
                    span = (low + pairs[0][0], low + pairs[-1][0] + 1)
                    if best is None or (len(pairs), span[0] - span[1]) > (best[0], best[3] - best[4]):
                        best = (len(pairs), len(pairs) / n, t.name, *span)
                    if best[4] - best[3] <= n:  # else words of a notice beside it may be in the span
                        break
            if best is not None:
                found.append(best)
            at = end
    kept: list[tuple] = []
    spans: list[tuple[int, int]] = []  # of those kept, in order; they do not overlap
    for size, share, name, first, end in sorted(found, key=lambda f: (-f[0], -f[1], f[3], f[2])):
        k = bisect_left(spans, (first, end))
        if (k == 0 or spans[k - 1][1] <= first) and (k == len(spans) or end <= spans[k][0]):
            spans.insert(k, (first, end))
            kept.append((name, share, first, end))
    return sorted(kept, key=lambda k: k[2])


FINDINGS = "array<struct<license: string, coverage: double, first: bigint, end: bigint>>"


def licenses(
    text: Column, templates: tuple = KNOWN, coverage: float = COVERAGE
) -> Column:
    """Licenses of a text: name, coverage, and the span of words, in order."""

    @arrow_udf(FINDINGS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = [Template(n, t, coverage) for n, t in templates]
        vocabulary = {w for t in known for w in t.words}
        names = ("license", "coverage", "first", "end")
        kind = pa.list_(
            pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("end", pa.int64())])
        )
        for batch in batches:
            out = []
            for body in batch.to_pylist():
                words = [w for part in split_words(body or b"") for w in part]
                out.append([dict(zip(names, f)) for f in find_licenses(words, known, vocabulary)])
            yield pa.array(out, kind)

    return scan(utf8(text))


def scan_licenses(
    docs: DataFrame, text_col: str = "text", templates: tuple = KNOWN, coverage: float = COVERAGE
) -> DataFrame:
    """``doc_id`` and ``found`` (see :func:`licenses`) of every document.

    Null and empty texts have none. Texts are read whole, in one task each, whose memory
    follows the longest of them. Repeated rows give repeated results, an empty table none;
    other columns are not looked at. Of overlapping findings the one with the most matched
    words stays (ties: the larger coverage, then the first). A template without words is never found.
    """
    return docs.select(
        docs["doc_id"].alias("doc_id"), licenses(docs[text_col], templates, coverage).alias("found")
    )
