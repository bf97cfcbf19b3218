"""Licence scan: TF-IDF cosine of texts to licence texts and notices, then inheritance from ancestor directories.

Every text as a whole, every line and every window of as many words as a notice has is a sparse vector over words; a template's
terms weigh by how few texts have them (counted over all texts), any other word as the templates' average term. Whole texts
are compared with the full licence texts in `licenses/`, where a word that occurs n times weighs as 1 + ln n, so that common words
don't decide; whole texts, lines and windows are compared with the notices. A line or window near a notice is the file's
own header; windows run across lines, since notices are wrapped. A text near a full licence text, and a file with a licence file's name and a
licence of its own, speak for their directory. A file without a header takes the licence of the nearest ancestor directory that
such a file speaks for.

Lines that share only common terms with the notices, windows of too small a share and texts that lack too many of a licence's terms can't
reach the threshold (by Cauchy-Schwarz) and are passed over exactly. The templates are fixed and small; texts are read twice and
not shuffled. Inheritance joins small rows: distinct directories, their ancestors, and one licence for each directory.

Defined results: a null or empty text has no licence of its own; a null path inherits nothing; of several licence files in a directory the
best, then the first by path, counts; of lines and windows equally near the first template by name counts; repeated rows are judged alike;
other columns don't matter.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import tokens
from gradewise.llm.tables import stored

HEADER_AT = 0.6
FILE_AT = 0.5
FULL_AT = 0.8


def _gnu(work: str, name: str, version: str) -> str:
    return (
        f"This {work} is free software; you can redistribute it and/or modify it under the terms of the {name} Public License as published "
        f"by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
    )


# Notices by which files name their licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "This code is released under the 2-Clause BSD License, also called the Simplified BSD License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal."),
    ("AGPL-3.0", _gnu("program", "GNU Affero General", "3")),
    ("GPL-2.0", _gnu("program", "GNU General", "2")),
    ("GPL-3.0", _gnu("program", "GNU General", "3")),
    ("LGPL-2.0", _gnu("library", "GNU Library General", "2")),
    ("LGPL-2.1", _gnu("library", "GNU Lesser General", "2.1")),
    ("LGPL-3.0", _gnu("library", "GNU Lesser General", "3")),
    ("GPL-2.0", "This program is free software under the terms of the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Licences whose full text is compared with whole texts.
FULL_NAMES = [
    "Apache-2.0", "Artistic-1.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC",
    "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense",
]
FULL_TEXTS = [(n, pkgutil.get_data("gradewise.llm", f"licenses/{n}.txt").decode()) for n in FULL_NAMES]
# Fixed value: names of licence files, such as COPYING.LESSER, LICENSE-MIT or mit-license.txt, but not license.py.
LICENSE_NAME = (
    r"(?i)(^|/)([a-z0-9]+[-_.])?(un)?(licen[cs]es?|copying|copyright)"
    r"([-_.](mit|isc|zlib|boost|unlicense|lesser|lib|[al]?gpl|apache|bsd|mpl|cc|cc0|by|nc|g?fdl|clause|version|v)?[0-9.]*)*(\.(txt|md|rst|html?))?$"
)
# Fixed value: the marker of machine-readable licence lines, and the names it takes.
SPDX = re.compile(rb"SPDX-License-Identifier:\s*([A-Za-z0-9.+-]+)")


def _terms(text: str) -> np.ndarray:
    texts = tokens.texts_of(pa.array([text], pa.large_string()))
    starts, ends, _ = texts.spans(tokens.IS_ALNUM)
    return texts.hashes(starts, ends, tokens.LOWER_CODES)


VOCABULARY = np.unique(np.concatenate([_terms(t) for _, t in TEMPLATES]))
FULL_VOCABULARY = np.unique(np.concatenate([_terms(t) for _, t in FULL_TEXTS]))
COUNTED = np.union1d(VOCABULARY, FULL_VOCABULARY)


class Weights:
    """Inverse document frequencies of the templates' terms, and the templates as unit vectors."""

    def __init__(self, texts: int, having: np.ndarray, templates: list[tuple[str, str]], vocabulary: np.ndarray, least: float, damped: bool = False):
        self.idf = np.log((texts + 1) / (having + 1)) + 1
        self.other = float(self.idf.mean())
        self.damped = damped
        self.sizes, rows = [], []
        for _, template in templates:
            terms = _terms(template)
            row = self._times(np.bincount(np.searchsorted(vocabulary, terms), minlength=len(vocabulary))) * self.idf
            rows.append(row / np.linalg.norm(row))
            self.sizes.append(len(terms))
        self.templates = np.array(rows)
        # The commonest terms that together stay below the threshold for every template.
        order = np.argsort(self.idf, kind="stable")
        reach = np.sqrt(np.cumsum(self.templates[:, order] ** 2, 1).max(0))
        self.telling = np.ones(len(vocabulary), bool)
        self.telling[order[reach < least]] = False

    def _times(self, n: np.ndarray) -> np.ndarray:
        return np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0.0) if self.damped else n

    def hopeful(self, at: np.ndarray, unit: np.ndarray, units: int) -> np.ndarray:
        """Units that have one of the telling terms."""
        found = np.zeros(units, bool)
        found[unit[(at >= 0) & self.telling[at]]] = True
        return found

    def covering(self, at: np.ndarray, unit: np.ndarray, units: int, least: float) -> np.ndarray:
        """Units whose terms are enough of one template for a cosine of `least`."""
        mine = self.hopeful(at, unit, units)[unit] & (at >= 0)
        unit, place = np.divmod(np.unique(unit[mine] * len(self.idf) + at[mine]), len(self.idf))
        held = np.zeros(units)
        for t in self.templates:
            np.maximum(held, np.bincount(unit, (t * t)[place], units), out=held)
        return held >= least * least - 1e-9

    def nearest(self, words: np.ndarray, at: np.ndarray, unit: np.ndarray, hopeful: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(highest cosine, its template) of each hopeful unit, 0 of the others; `at` is a word's place in the vocabulary or -1."""
        best, which = np.zeros(len(hopeful)), np.zeros(len(hopeful), np.int64)
        some = np.flatnonzero(hopeful)
        if len(some):
            mine = hopeful[unit]
            of = np.searchsorted(some, unit[mine])
            # Occurrences of one word in one unit come together.
            order = np.lexsort((words[mine], of))
            w, of, place = words[mine][order], of[order], at[mine][order]
            lead = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (of[1:] != of[:-1]))))
            times = self._times(np.diff(np.append(lead, len(w))))
            of, place = of[lead], place[lead]
            weight = times * np.where(place >= 0, self.idf[place], self.other)
            norm = np.sqrt(np.bincount(of, weight * weight, len(some)))
            known = place >= 0
            scores = np.stack([np.bincount(of[known], weight[known] * t[place[known]], len(some)) for t in self.templates])
            best[some], which[some] = scores.max(0) / norm, scores.argmax(0)
        return best, which

    def windows(self, words: np.ndarray, at: np.ndarray, owner: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cosine, template, owner) of every window as long as a template that has a cosine of `least`.

        A word that comes again can only lengthen a window's vector, so the sum of the single squares bounds
        the cosine; only windows within that bound are worked out.
        """
        if not len(words):
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        weight = np.where(at >= 0, self.idf[at], self.other)
        squares = np.concatenate(([0.0], np.cumsum(weight * weight)))
        starts, sizes = [], []
        for size in set(self.sizes):
            n = len(words) - size + 1
            if n <= 0:
                continue
            dots = np.zeros(n)
            for t in (t for t, k in zip(self.templates, self.sizes) if k == size):
                sums = np.concatenate(([0.0], np.cumsum(np.where(at >= 0, weight * t[at], 0.0))))
                np.maximum(dots, sums[size:] - sums[:-size], out=dots)
            norm = np.sqrt(squares[size:] - squares[:-size])
            found = np.flatnonzero((dots >= (least - 1e-6) * norm) & (owner[:n] == owner[size - 1:]))
            starts.append(found)
            sizes.append(np.full(len(found), size))
        start, size = np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(sizes or [np.zeros(0, np.int64)])
        best, which = [np.zeros(0)], [np.zeros(0, np.int64)]
        # A repetitive text may have many candidates.
        for k in range(0, len(start), 10_000):
            s, n = start[k: k + 10_000], size[k: k + 10_000]
            unit = np.repeat(np.arange(len(s)), n)
            place = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s, n)
            scores, names = self.nearest(words[place], at[place], unit, np.ones(len(s), bool))
            best.append(scores)
            which.append(names)
        score = np.concatenate(best)
        near = score >= least
        return score[near], np.concatenate(which)[near], owner[start][near]


def _lines(texts: tokens.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(start, text) of each line."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    starts = np.sort(np.concatenate((texts.bounds[:-1], breaks + 1)), kind="stable")
    return starts, np.repeat(np.arange(len(texts)), texts.counted(breaks) + 1)


def _places(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def judged(texts: tokens.Texts, weights: Weights, full: Weights) -> list[tuple[str | None, float, bool, bool]]:
    """(licence or None, cosine, whether the text as a whole is a licence or a notice, whether it is a full licence text) of each text."""
    starts, ends, first = texts.spans(tokens.IS_ALNUM)
    hashes = texts.hashes(starts, ends, tokens.LOWER_CODES)
    at, owner = _places(hashes, VOCABULARY), tokens.owners(first)
    full_at = _places(hashes, FULL_VOCABULARY)
    text, text_which = full.nearest(hashes, full_at, owner, full.covering(full_at, owner, len(texts), FULL_AT))
    line_starts, line_owner = _lines(texts)
    # Empty texts at one place begin lines there too; a word belongs to the last line that begins before it.
    line = np.searchsorted(line_starts, starts, "right") - 1
    near, which = weights.nearest(hashes, at, line, weights.hopeful(at, line, len(line_starts)))
    hopeful = weights.hopeful(at, owner, len(texts))
    whole, whole_which = weights.nearest(hashes, at, owner, hopeful)
    # Windows of the texts that can be nearer to a notice than their lines are.
    settled = (text >= FULL_AT) | (whole >= FILE_AT)
    settled[line_owner[near >= 1 - 1e-9]] = True
    mine = (hopeful & ~settled)[owner]
    wide = weights.windows(hashes[mine], at[mine], owner[mine], HEADER_AT)
    near, which, line_owner = (np.concatenate(x) for x in zip((near, which, line_owner), wide))
    order = np.lexsort((which, -near, line_owner))
    lead = order[np.searchsorted(line_owner[order], np.arange(len(texts)))] if len(order) else order
    out: list[tuple[str | None, float, bool, bool]] = []
    for i in range(len(texts)):
        k = lead[i]
        if text[i] >= FULL_AT:
            out.append((FULL_TEXTS[text_which[i]][0], float(text[i]), True, True))
        elif whole[i] >= FILE_AT:
            out.append((TEMPLATES[whole_which[i]][0], float(whole[i]), True, False))
        elif near[k] >= HEADER_AT:
            out.append((TEMPLATES[which[k]][0], float(near[k]), False, False))
        else:
            out.append((None, float(near[k]), False, False))
    # A machine-readable line is exact.
    if np.flatnonzero(texts.data == ord(":")).size:
        for m in SPDX.finditer(texts.data.tobytes()):
            i = int(np.searchsorted(texts.bounds, m.start(), "right")) - 1
            if m.end() <= texts.bounds[i + 1]:
                out[i] = (m.group(1).decode(), 1.0, *out[i][2:])
    return out


def weigh(files: DataFrame, *, text_col: str = "text") -> tuple[Weights, Weights]:
    """Weights of the notices and of the full texts, from document frequencies over all texts; two rows of the vocabulary's length for each task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having, n = np.zeros(len(COUNTED), np.int64), 0
        for batch in batches:
            for _, _, texts in tokens.chunks(batch.column(0)):
                starts, ends, first = texts.spans(tokens.IS_ALNUM)
                at, owner = _places(texts.hashes(starts, ends, tokens.LOWER_CODES), COUNTED), tokens.owners(first)
                pairs = np.unique(owner[at >= 0] * len(COUNTED) + at[at >= 0])
                having += np.bincount(pairs % len(COUNTED), minlength=len(COUNTED))
                n += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(COUNTED), dtype=np.int32)), pa.array(np.concatenate(([n], having)))], names=["term", "n"],
        )

    counted = files.select(F.col(text_col).alias("text")).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}
    texts, having = found.get(-1, 0), np.array([found.get(k, 0) for k in range(len(COUNTED))])
    return (
        Weights(texts, having[np.searchsorted(COUNTED, VOCABULARY)], TEMPLATES, VOCABULARY, min(HEADER_AT, FILE_AT)),
        Weights(texts, having[np.searchsorted(COUNTED, FULL_VOCABULARY)], FULL_TEXTS, FULL_VOCABULARY, FULL_AT, damped=True),
    )


def scan(files: DataFrame, *, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Per file: id, path, own_license, similarity, license_file, license (own or inherited), inherited_from (a directory)."""
    weights, full = weigh(files, text_col=text_col)
    key = files.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.chunks(batch.column(2)):
                own, score, whole, text = zip(*judged(texts, weights, full))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(own, pa.string()),
                    pa.array(score, pa.float64()), pa.array(whole, pa.bool_()), pa.array(text, pa.bool_()),
                ], names=["id", "path", "own_license", "similarity", "license_file", "full_text"])

    found = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {key}, path string, own_license string, similarity double, license_file boolean, full_text boolean",
    )
    return inherit(found).withColumnRenamed("id", id_col)


def inherit(found: DataFrame) -> DataFrame:
    """Add license and inherited_from to files (`path`, `own_license`, `similarity`, `license_file`, `full_text`)."""
    placed = stored(found.withColumn("dir", F.regexp_replace("path", r"/?[^/]*$", "")), "licenses")
    speaks = (
        placed.where(F.col("dir").isNotNull() & F.col("own_license").isNotNull() & (F.col("full_text") | F.col("path").rlike(LICENSE_NAME))).groupBy("dir")
        .agg(F.min(F.struct(-F.col("similarity"), "path", "own_license")).getField("own_license").alias("dir_license"))
    )
    # Of each distinct directory all ancestors, itself and the root "" included.
    parts = F.split("dir", "/")
    ancestors = placed.select("dir").where("dir is not null").distinct().select(
        "dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"),
    ).select("dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("ancestor"))
    nearest = (
        ancestors.join(speaks.withColumnRenamed("dir", "ancestor"), "ancestor")
        .groupBy("dir").agg(F.max(F.struct("depth", "ancestor", "dir_license")).alias("near"))
        .select("dir", F.col("near.ancestor").alias("from"), F.col("near.dir_license").alias("dir_license"))
    )
    bare = F.col("own_license").isNull()
    return placed.join(nearest, "dir", "left").select(
        "id", "path", "own_license", "similarity", "license_file",
        F.coalesce("own_license", "dir_license").alias("license"), F.when(bare, F.col("from")).alias("inherited_from"),
    )
