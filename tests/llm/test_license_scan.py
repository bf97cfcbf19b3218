from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter

import numpy as np

from gradewise.llm import license_scan, queries
from tests.llm import plain


def vector(text, idf, other):
    return {w: n * idf.get(w, other) for w, n in Counter(re.findall(plain.ALNUM, plain.lower(text))).items()}


def expected(texts):
    terms = {w for _, t in license_scan.TEMPLATES for w in re.findall(plain.ALNUM, plain.lower(t))}
    having = Counter(w for t in texts for w in terms & set(re.findall(plain.ALNUM, plain.lower(t or ""))))
    idf = {w: math.log((len(texts) + 1) / (having[w] + 1)) + 1 for w in terms}
    other = sum(idf.values()) / len(idf)
    templates = [(n, vector(t, idf, other)) for n, t in license_scan.TEMPLATES]
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def nearest(text):
        v = vector(text, idf, other)
        scores = [sum(v[w] * t[w] for w in v if w in t) / (norm(v) * norm(t)) if v else 0.0 for _, t in templates]
        best = max(range(len(scores)), key=lambda k: (round(scores[k], 9), -k))
        return round(scores[best], 9), -best

    out = []
    for text in texts:
        whole, line = nearest(text or ""), max(map(nearest, (text or "").split("\n")))
        best = whole if whole[0] >= license_scan.FILE_AT else line if line[0] >= license_scan.HEADER_AT else None
        out.append((templates[-best[1]][0] if best else None, whole[0] >= license_scan.FILE_AT))
    return out


def test_query(spark, sf):
    docs = plain.read(spark, sf, "documents").collect()
    want = dict(zip((d.doc_id for d in docs), expected([d.text for d in docs])))
    rows = queries.op1_license_scan(spark, sf).collect()
    assert {r.doc_id: (r.own_license, r.license_file) for r in rows} == want
    assert any(r.own_license for r in rows) and all(r.license == r.own_license for r in rows if r.own_license)


def test_inheritance(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "code"), (3, "a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
        (4, "a/y.py", "more code\n# Licensed under the Apache License, Version 2.0.\n" + plain.PROSE), (5, "ab/z.py", "code"), (6, None, "code"),
        (7, "a/d/w.py", None), (8, "a/SPDX", "SPDX-License-Identifier: BSD-3-Clause\n" + plain.PROSE), (8, "a/SPDX", "SPDX-License-Identifier: BSD-3-Clause\n" + plain.PROSE),
        (9, "a/b/OTHER", "Licensed under CC BY-NC 4.0."), (10, "/abs/q.py", ""),
    ], "id int, path string, text string").withColumnRenamed("id", "doc_id")
    clash = files.selectExpr("*", "1 AS id", "2 AS dir", "3 AS license")
    rows = license_scan.scan(clash).collect()
    assert sorted((r.doc_id, r.license, r.inherited_from) for r in rows) == [
        (1, "MIT", None), (2, "CC-BY-NC-4.0", "a/b"), (3, "CC-BY-NC-4.0", None), (4, "Apache-2.0", None), (5, None, None), (6, None, None),
        (7, "MIT", "a"), (8, "BSD-3-Clause", None), (8, "BSD-3-Clause", None), (9, "CC-BY-NC-4.0", None), (10, None, None),
    ]


def test_odd_rows(spark):
    docs = plain.odd_docs(spark).selectExpr("*", "concat('d/', doc_id) AS path")
    assert license_scan.scan(docs).where("license is not null").count() == 0
    assert license_scan.scan(docs).count() == docs.count()
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_root_directory_speaks_for_all(spark):
    files = spark.createDataFrame([(1, "LICENSE", "Released under the MIT License."), (2, "a/b.py", "code")], "doc_id int, path string, text string")
    assert {(r.license, r.inherited_from) for r in license_scan.scan(files).collect()} == {("MIT", None), ("MIT", "")}


def full_text(name):
    return pkgutil.get_data("gradewise.llm", f"licenses/{name}.txt").decode()


def test_full_texts_speak_for_their_directories(spark):
    prose = [(f"src/{i}.txt", plain.PROSE * 3 + f" unit {i}") for i in range(200)]
    # Another holder and other line ends than the template's.
    texts = [(n, f"Copyright (c) 2021 Some Body Else\n\n{' '.join(full_text(n).split())}\n") for n in license_scan.FULL_NAMES]
    files = [(f"{n}/COPYING", t) for n, t in texts] + [(f"{n}/a/b/x.py", "code") for n, _ in texts] + [
        ("any/file-name", texts[0][1]), ("any/x.py", "code"), ("named/LICENSE-MIT", "Copyright 2020 Some Body\n" * 20 + "Released under the MIT License."),
        ("named/x.py", "code"), ("notice/README", "Licensed under CC BY-NC 4.0."), ("notice/x.py", "code"), ("py/license.py", "Released under the MIT License."),
        ("py/x.py", "code"),
    ] + prose
    rows = license_scan.scan(spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "doc_id int, path string, text string")).collect()
    found = {r.path: r for r in rows}
    assert {n: found[f"{n}/COPYING"].license for n, _ in texts} == {n: n for n, _ in texts}
    assert all(found[f"{n}/COPYING"].license_file for n, _ in texts)
    assert {n: (found[f"{n}/a/b/x.py"].license, found[f"{n}/a/b/x.py"].inherited_from) for n, _ in texts} == {n: (n, n) for n, _ in texts}
    assert (found["any/x.py"].license, found["named/x.py"].license) == (texts[0][0], "MIT")
    # A notice is its file's own; only a licence file or a full text speaks for others.
    assert (found["notice/README"].license, found["notice/x.py"].license) == ("CC-BY-NC-4.0", None)
    assert (found["py/license.py"].license, found["py/x.py"].license) == ("MIT", None)
    assert all(found[p].license is None for p, _ in prose)


def test_headers_run_across_lines(spark):
    gnu = (
        "/*\n * Copyright (C) 2020 Some Body\n *\n * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU {} Public License\n"
        " * as published by the Free Software Foundation; either version {}\n * of the License, or (at your option) any later version.\n */\n"
    )
    apache = "# Licensed under the\n# Apache License,\n# Version 2.0 (the\n# License);\n"
    cases = [("GPL-2.0", gnu.format("General", 2)), ("GPL-3.0", gnu.format("General", 3)), ("AGPL-3.0", gnu.format("Affero General", 3)), ("Apache-2.0", apache)]
    files = [(n, f"{n}.c", header + plain.PROSE * 20) for n, header in cases]
    prose = [(f"p{i}", None, plain.PROSE * 3) for i in range(200)]
    rows = license_scan.scan(spark.createDataFrame(files + prose, "doc_id string, path string, text string")).collect()
    assert {r.doc_id: r.own_license for r in rows} == {n: n for n, _ in cases} | {d: None for d, _, _ in prose}


def test_windows_are_scored_exactly(spark):
    texts = [t for _, t in license_scan.TEMPLATES[:6]]
    files = spark.createDataFrame([(i, None, f"{plain.PROSE}\n{t} {plain.PROSE}") for i, t in enumerate(texts)], "doc_id int, path string, text string")
    weights, _ = license_scan.weigh(files)
    for text in (r.text for r in files.collect()):
        words = re.findall(plain.ALNUM, plain.lower(text))
        hashes = np.array([license_scan._terms(w)[0] for w in words])
        at = license_scan._places(hashes, license_scan.VOCABULARY)
        scores, _, _ = weights.windows(hashes, at, np.zeros(len(words), int), license_scan.HEADER_AT)
        idf = lambda w: float(weights.idf[p]) if (p := license_scan._places(license_scan._terms(w), license_scan.VOCABULARY)[0]) >= 0 else weights.other
        unit = lambda ws: {w: n * idf(w) for w, n in Counter(ws).items()}
        norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
        templates = [unit(re.findall(plain.ALNUM, plain.lower(t))) for _, t in license_scan.TEMPLATES]
        want = []
        for size in set(weights.sizes):
            for k in range(len(words) - size + 1):
                v = unit(words[k: k + size])
                # Whether a window is worked out hangs on the templates of its size; its score on all of them.
                if any(sum(v[w] * t[w] for w in v if w in t) / norm(v) / norm(t) >= license_scan.HEADER_AT for t, n in zip(templates, weights.sizes) if n == size):
                    want.append(max(sum(v[w] * t[w] for w in v if w in t) / norm(v) / norm(t) for t in templates))
        assert want and set(np.round(want, 6)) <= set(np.round(scores, 6)) and round(max(scores), 6) == round(max(want), 6)
