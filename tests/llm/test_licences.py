"""Licence scan against plain cosines and a walk up the path."""

import math
import re
from collections import Counter

import pytest

from tessera.llm import licences as L
from tessera.llm.licence_texts import NOTICES

SCHEMA = "doc_id long, path string, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", low)


PAIRS = [(k, t) for k in sorted(NOTICES) for t in [f"SPDX-License-Identifier: {k}", *NOTICES[k]]]
TERMS = {w for _, t in PAIRS for w in words(t)}


def brute(texts):
    """Per text the best (licence, cosine) over lines, paragraphs and itself."""
    n = len(texts)
    df = Counter(w for t in texts for w in set(words(t or "")) & TERMS)
    idf = {w: math.log((n + 1) / (df[w] + 1)) + 1 for w in TERMS}
    rarest = math.log(n + 1) + 1
    vectors = [(k, {w: c * idf[w] for w, c in Counter(words(t)).items()}) for k, t in PAIRS]

    def best(unit):
        w = words(unit)
        if len(w) < L.LEAST_WORDS:
            return None
        v = {x: c * idf[x] for x, c in Counter(w).items() if x in TERMS}
        size = math.sqrt(sum(x * x for x in v.values()) + sum(x not in TERMS for x in w) * rarest**2)
        return min((-round(sum(v.get(x, 0) * y for x, y in t.items()) / size / math.sqrt(sum(y * y for y in t.values())), 9), k) for k, t in vectors)

    out = []
    for t in texts:
        lines = [x if words(x) else "" for x in (t or "").split("\n")]
        units = [t or "", *re.split(r"\n{2,}", "\n".join(lines)), *lines]
        found = [b for b in map(best, units) if b and -b[0] >= L.LEAST]
        out.append((min(found)[1], -min(found)[0], sorted({b[1] for b in found})) if found else (None, None, []))
    return out


MIT = NOTICES["MIT"][-1]
PROSE = "Some ordinary words about the weather and other things that are not a licence at all."
TEXTS = [
    None, "", PROSE, f"{PROSE}\nReleased under the MIT License.\n{PROSE}", MIT, f"Copyright 2020 A. Person\n\n{MIT}",
    "# SPDX-License-Identifier: BSD-3-Clause", "Licensed under CC BY-NC 4.0.", "licensed under the apache license version 2.0",
    "Licensed under the GNU General Public License, version 2.", "This work is licensed under the GNU General Public License, version 3.",
    "license", "the of and", MIT + " " + PROSE * 200, "Released under the MIT License.\nLicensed under CC BY 4.0.\n" + PROSE,
    "a\n\n" + "\n".join(NOTICES["Apache-2.0"][-1].split("\n")) + "\n\nb", "É日本 " * 5000,
]


def test_own_licences_equal_plain_cosines(spark):
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)
    want = brute(TEXTS)
    for r in L.licence_scan(df, "doc_id").collect():
        licence, cosine, every = want[r.doc_id]
        assert (r.licence, r.licences) == (licence, every), (r, want[r.doc_id])
        assert r.cosine == (pytest.approx(cosine, abs=1e-8) if cosine else None)
    assert [w[0] for w in want[3:11]] == [
        "MIT", "MIT", "MIT", "BSD-3-Clause", "CC-BY-NC-4.0", "Apache-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later"]


def test_every_word_has_its_own_weight(spark):
    """Words of no template weigh by their own document frequency."""
    common = "yes we really like our weather"
    line = "Yes, we really like: the code is released under the MIT License"
    texts = [line, line.replace("Yes, we really like", "Xylophone quux zyzzy plugh"), MIT + "\nyes yes yes"] + [common] * 60
    n = len(texts)
    df = Counter(w for t in texts for w in set(words(t)))
    idf = lambda w: math.log((n + 1) / (df[w] + 1)) + 1

    def cosine(unit):
        v = {w: c * idf(w) for w, c in Counter(words(unit)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        out = []
        for k, t in PAIRS:
            y = {w: c * idf(w) for w, c in Counter(words(t)).items()}
            out.append((sum(v.get(w, 0) * x for w, x in y.items()) / size / math.sqrt(sum(x * x for x in y.values())), k))
        return max(out)

    got = {r.doc_id: r for r in L.licence_scan(spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], SCHEMA), "doc_id").collect()}
    assert cosine(texts[0])[0] >= L.LEAST > cosine(texts[1])[0]
    assert (got[0].licence, got[0].cosine) == ("MIT", pytest.approx(cosine(texts[0])[0], abs=1e-8))
    assert got[1].licence is None and got[5].licence is None and got[2].licence == "MIT"


def test_headers_and_whole_texts(spark):
    """Headers that differ in a word or a version, and whole licence files
    with a line of their own."""
    program = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU"
    library = program.replace("program", "library")
    later = "as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
    only = "as published by\nthe Free Software Foundation, version 3."
    headers = {
        f"{program} General Public License {later}": "GPL-3.0-or-later", f"{program} Affero General Public License {later}": "AGPL-3.0-or-later",
        f"{library} Lesser General Public License {later}": "LGPL-3.0-or-later", f"{program} General Public License {only}": "GPL-3.0-only",
        f"{program} Affero General Public License {only}": "AGPL-3.0-only", f"{library} Lesser General Public License {only}": "LGPL-3.0-only",
    }
    whole = ["Apache-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "MPL-2.0", "CC0-1.0"]
    texts = [*headers, *(f"Copyright 2020 A. Person\n\n{NOTICES[k][0]}" for k in whole)]
    wanted = [*headers.values(), *whole]
    rows = [(i, f"d{i}/one.txt", t) for i, t in enumerate(texts)] + [(100 + i, f"d{i}/two.txt", PROSE) for i in range(len(texts))]
    got = {r.doc_id: r for r in L.licence_scan(spark.createDataFrame(rows, SCHEMA), "doc_id").collect()}
    assert [got[i].licence for i in range(len(texts))] == wanted
    assert [got[100 + i].licence for i in range(len(headers), len(texts))] == whole


def test_inheritance(spark):
    rows = [
        (1, "LICENSE", MIT), (2, "a/COPYING.txt", f"{PROSE}\nReleased under the Apache License, Version 2.0."),
        (3, "a/b/x.py", PROSE), (4, "a/b/c/LICENSE", PROSE), (5, "z.py", None), (6, "zz/y/q.py", PROSE), (7, None, PROSE),
        (8, "a/b/own.py", f"Released under the ISC License.\n{PROSE}"), (9, "d/one.txt", MIT), (10, "d/e/f", ""), (11, "a", PROSE), (3, "a/b/x.py", PROSE),
        (12, "ab/x", PROSE), (13, "d/two", "Licensed under CC BY 4.0."), (14, "d/g", PROSE),
    ]
    got = {}
    for r in L.licence_scan(spark.createDataFrame(rows, SCHEMA), "doc_id").collect():
        got.setdefault(r.doc_id, []).append((r.licence, r.basis, r.licence_file))
    assert got[3] == [("Apache-2.0", "inherited", "a/COPYING.txt")] * 2 and got[4] == got[3][:1]
    root = ("MIT", "inherited", "LICENSE")
    assert got[5] == got[6] == got[11] == got[12] == [root]
    assert got[7] == [(None, None, None)]
    assert got[8] == [("ISC", "line", None)]
    assert got[10] == got[14] == [("CC-BY-4.0", "inherited", "d/two")]  # equal cosines: the smaller licence


def test_empty_table(spark):
    assert L.licence_scan(spark.createDataFrame([], SCHEMA), "doc_id").count() == 0


def test_clashing_columns(spark):
    """Columns named like results, or like the operator's own, are ignored."""
    text = "SPDX-License-Identifier: MIT"
    names = ["licence", "cosine", "basis", "id", "directory", "own_licence", "whole", "ancestor", "word"]
    df = spark.createDataFrame([(1, "a/b.txt", text, *["x"] * len(names))], f"{SCHEMA}, {', '.join(f'{n} string' for n in names)}")
    r = L.licence_scan(df, "doc_id").first()
    assert (r.path, r.licence, r.basis) == ("a/b.txt", "MIT", "line")
