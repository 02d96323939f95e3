"""Patience alignment and license findings."""

import random
from itertools import combinations

import pytest

from panelspark.llm.license_scan import KNOWN, TEMPLATES, TITLES, Template, _rising, align, find_licenses, scan_licenses

SCHEMA = "doc_id long, text string, found string, license int"


def longest_rising(pairs):
    for n in range(len(pairs), 0, -1):
        for c in combinations(pairs, n):
            if all(a[1] < b[1] for a, b in zip(c, c[1:])):
                return n
    return 0


def plain_patience(a, b):
    """The same rule, written recursively on slices."""
    if not a or not b:
        return 0
    if a[0] == b[0]:
        return 1 + plain_patience(a[1:], b[1:])
    if a[-1] == b[-1]:
        return 1 + plain_patience(a[:-1], b[:-1])
    both = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 and b.count(w) == 1]
    run = _rising(both)
    if not run:
        return 0
    total, i0, j0 = len(run), 0, 0
    for i, j in [*run, (len(a), len(b))]:
        total += plain_patience(a[i0:i], b[j0:j])
        i0, j0 = i + 1, j + 1
    return total


@pytest.mark.parametrize("seed", range(60))
def test_alignment_equals_plain_version(seed):
    rng = random.Random(seed)
    words = "abcdefghijklmnop"[: rng.randint(2, 16)]
    a, b = rng.choices(words, k=rng.randint(0, 25)), rng.choices(words, k=rng.randint(0, 25))
    pairs = align(a, b)
    assert len(pairs) == plain_patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_rising_is_longest():
    rng = random.Random(1)
    for _ in range(60):
        pairs = list(enumerate(rng.sample(range(12), rng.randint(0, 9))))
        got = _rising(pairs)
        assert len(got) == longest_rising(pairs) and all(x[1] < y[1] for x, y in zip(got, got[1:]))


def scan(text, coverage=0.8, templates=TEMPLATES):
    known = [Template(n, t, coverage) for n, t in templates]
    words = [w for t in [text] for w in __import__("re").findall(rb"[0-9a-z\x80-\xff]+", t.lower().encode())]
    return find_licenses(words, known, {w for t in known for w in t.words}), words


@pytest.mark.parametrize("name,text", TEMPLATES)
def test_every_template_among_prose_twice_and_changed(name, text):
    prose = "the of is under this license that with was for and permission to use version " * 30
    found, _ = scan(f"{prose} {text} {prose} {text} {text} {prose}")
    assert [f[0] for f in found] == [name] * 3 and all(f[1] == 1 for f in found)
    words = text.split()
    if len(words) > 20:
        rng = random.Random(4)
        for _ in range(len(words) // 10):
            words[rng.randrange(len(words))] = "changed"
        found, _ = scan(f"{prose} {' '.join(words)} {prose}")
        assert [f[0] for f in found] == [name] and 0.8 <= found[0][1] < 1


def test_prose_has_no_license():
    rng = random.Random(3)
    vocabulary = sorted({w for _, t in TEMPLATES for w in t.lower().split()})
    assert scan(" ".join(rng.choices(vocabulary, k=4000)))[0] == []


def test_odd_tables(spark):
    notice = TEMPLATES[0][1]
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "é " * 100_000 + notice.upper(), "x", 1), (4, notice, "x", 1),
            (4, notice, "x", 1), (None, notice, "x", 1), (5, (notice + "\n") * 500, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["doc_id"] or 0, len(r["found"])) for r in scan_licenses(df).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (3, 1), (4, 1), (4, 1), (5, 500)]
    assert scan_licenses(df.limit(0)).count() == 0
    assert {len(r["found"]) for r in scan_licenses(df, templates=(("none", "..."),)).collect()} == {0}


def test_query_finds_the_notices(spark):
    from panelspark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {}
    for d in docs:
        names = {n for n, t in TEMPLATES if t.lower() in d["text"].lower()}
        want[d["doc_id"]] = ",".join(sorted(names))
    got = QUERIES["op8_license_scan"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["licenses"] for r in got} == want and any(want.values())


@pytest.mark.parametrize(
    "text,names",
    [
        ("Released under the BSD License.", ["BSD"]),
        ("Released under the Foo License.", []),
        ("Licensed under the MIT License.", ["MIT"]),
        ("Released under the MIT-0 License.", []),
        ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
        ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
        ("Licensed under CC BY-NC 3.0.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("This work is licensed under the GNU General Public License, version 1.", []),
        ([t for n, t in TEMPLATES if n == "GPL-3.0"][1].replace("version 3", "version 2"), ["GPL-2.0"]),
    ],
)
def test_near_variants_have_their_own_name(text, names):
    long = [t for n, t in TEMPLATES if n == "GPL-3.0"][1]
    for body in (text, f"see {text} {text}", f"{text} {long}"):
        found, _ = scan(body)
        want = names * (2 if body.startswith("see") else 1) + (["GPL-3.0"] if body.endswith(long) else [])
        assert [f[0] for f in found] == want


@pytest.mark.parametrize(
    "text,names",
    [
        ("MIT License", ["MIT"]),
        ("# SPDX-License-Identifier: MIT", ["MIT"]),
        ("// SPDX-License-Identifier: MIT-0", ["MIT-0"]),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", ["GPL-2.0"]),
        ("SPDX-License-Identifier: BSD-2-Clause-Patent", ["BSD-2-Clause-Patent"]),
        ("SPDX-License-Identifier: Foo-1.0", []),
        ("CC BY-SA 4.0", ["CC-BY-SA-4.0"]),
        ("CC BY-SA 3.0", []),
        ("GNU General Public License, version 2", ["GPL-2.0"]),
        ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["GPL-3.0"]),
        ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", ["LGPL-2.1"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
         "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", ["MPL-2.0"]),
        ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
         "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
         "binary, for any purpose, commercial or non-commercial, and by any means.", ["Unlicense"]),
        ("the license that MIT gave", []),
    ],
)
def test_titles_and_identifiers(text, names):
    prose = "words that stand before and after it, by the way, 4 or 2 of them "
    for body in (text, f"{prose} {text} {prose}", f"{prose} {text}"):
        assert [f[0] for f in scan(body, templates=KNOWN)[0]] == names


@pytest.mark.parametrize("name,text", TITLES)
def test_every_title_among_prose_twice(name, text):
    prose = "the of is under this license that with was for and permission to use version " * 3
    found, _ = scan(f"{prose} {text} {prose} {text} {text} {prose}", templates=KNOWN)
    assert [f[0] for f in found] == [name] * 3 and all(f[1] == 1 for f in found)


@pytest.mark.parametrize("seed", range(20))
def test_titles_equal_a_plain_search(seed):
    """All places of all titles, the longest first where they overlap."""
    rng = random.Random(seed)
    titles = [(n, Template(n, t, 0.8).words) for n, t in TITLES]
    some = rng.sample(titles, 6)
    parts = [w for _, w in some] + [w[:k] for _, w in some for k in (1, 2)]
    words = [w for _ in range(60) for w in rng.choice(parts)]
    places = [(-len(t), i, n) for n, t in titles for i in range(len(words)) if words[i : i + len(t)] == t]
    want = []
    for size, i, n in sorted(places, key=lambda p: p[:2]):
        if all(i - size <= k or i >= e for _, k, e in want):
            want.append((n, i, i - size))
    known = [Template(n, t, 0.8) for n, t in TITLES]
    found = find_licenses(words, known, {w for t in known for w in t.words})
    assert [(f[0], f[2], f[3]) for f in found] == sorted(want, key=lambda w: w[1])


def test_very_long_text_of_many_notices():
    """A megabyte of titles between words: every one is found at its place."""
    import time

    n = 40_000
    text = "words before MIT License and CC BY-SA 4.0 " * n
    start = time.perf_counter()
    found, words = scan(text, templates=KNOWN)
    assert time.perf_counter() - start < 60
    assert len(words) == 10 * n and [f[0] for f in found] == ["MIT", "CC-BY-SA-4.0"] * n
    assert [f[2] for f in found[::2]] == [10 * i + 2 for i in range(n)]
