"""Operator 10: license scans by sparse TF-IDF cosine to templates, then inheritance along directories.

Segments are every line, every whole text and, for each template, every run of as many words as the template has, over
line breaks too. A segment's vector holds the TF-IDF weights of the templates' terms; its length counts terms of no
template too, at the weight of a term seen nowhere. A segment is a notice of the template with the largest cosine of at
least THRESHOLD (ties: the first name). Of a template's runs that overlap, the best stays. Notices are counted from the
best one on, and one that overlaps a counted one isn't counted again. The inverse document frequencies of the
templates' terms, of which there is a fixed number, are counted over all texts.

A text is held against a template only where the template's terms that it has could reach the threshold in some
segment: without the others, the cosine is at most the length of the template's vector over those terms. This loses
nothing. What is found, without the texts, is written once before the inheritance reads it several times.

A file of which notices make up at least half of the words is a licence file, as is one named so (LICENSE, COPYING,
NOTICE); it licenses its directory. A file without a notice inherits from the nearest ancestor directory with a licence
file: the distinct directories are exploded into their ancestors, joined with the licensed ones by path, and the
deepest match is joined back to the files, so a directory of any size is resolved once.

Defined cases: null or empty text: no notice, may inherit; null path: no inheritance and no directory; several licence
files in a directory: the largest score, then the first path; cosines are rounded to nine digits, so that
equal ones tie; repeated rows each get a row; very long texts: every run is scored, by running sums; empty table: no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import materialize

THRESHOLD = 0.6
SLACK = 1e-6  # for rounding, where a bound or a running sum decides what is scored
TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"

#: Notices as the licences word them.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Creative Commons Attribution 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.',
    ],
}


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


class Scorer:
    def __init__(self, templates: dict[str, list[str]], df: dict[str, int], n_docs: int, threshold: float):
        self.threshold = threshold
        self.unseen = math.log(1 + n_docs) + 1
        self.idf = {t: math.log((1 + n_docs) / (1 + df.get(t, 0))) + 1 for ts in templates.values() for x in ts for t in terms(x)}
        self.vectors = []  # name, weights, words
        for name in sorted(templates):
            for x in templates[name]:
                v = {t: c * self.idf[t] for t, c in Counter(terms(x)).items()}
                norm = math.sqrt(sum(w * w for w in v.values()))
                self.vectors.append((name, {t: w / norm for t, w in v.items()}, len(terms(x))))
        self.row = {t: i for i, t in enumerate(sorted(self.idf))}
        self.squares = np.zeros((len(self.row), len(self.vectors)))
        for j, (_, v, _) in enumerate(self.vectors):
            for t, w in v.items():
                self.squares[self.row[t], j] = w * w

    def candidates(self, words: list[str]) -> list[int]:
        """The templates that some segment of these words may reach."""
        known = [self.row[t] for t in self.row.keys() & set(words)]
        return np.flatnonzero(self.squares[known].sum(axis=0) >= (self.threshold - SLACK) ** 2).tolist() if known else []

    def best(self, words: list[str], among: list[int]) -> tuple[float, str] | None:
        """(cosine, template name) of a notice."""
        weights = {t: c * self.idf.get(t, self.unseen) for t, c in Counter(words).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        if not norm or not among:
            return None
        found = max(((sum(w * weights.get(t, 0.0) for t, w in self.vectors[j][1].items()) / norm, self.vectors[j][0]) for j in among), key=lambda b: b[0])
        return found if found[0] >= self.threshold else None

    def score(self, segment: str) -> tuple[float, str, int] | None:
        """(cosine, template name, words) of a notice."""
        words = terms(segment)
        found = self.best(words, self.candidates(words))
        return (*found, len(words)) if found else None

    def runs(self, words: list[str], j: int) -> list[tuple[int, int]]:
        """Start and end of the runs of the template's length that are notices of it; of overlapping ones the best."""
        _, v, length = self.vectors[j]
        least = (self.threshold - SLACK) ** 2
        counts: Counter = Counter()
        norm = dot = 0.0
        hits = []
        for z, t in enumerate(words):
            w, c = self.idf.get(t, self.unseen), counts[t]
            norm, dot = norm + w * w * (2 * c + 1), dot + w * v.get(t, 0.0)
            counts[t] = c + 1
            if z >= length:
                t = words[z - length]
                w, c = self.idf.get(t, self.unseen), counts[t]
                norm, dot = norm - w * w * (2 * c - 1), dot - w * v.get(t, 0.0)
                counts[t] = c - 1
            if z >= length - 1 and dot * dot >= least * norm:
                hits.append((-round(dot * dot / norm, 9), z + 1 - length))
        taken, out = bytearray(len(words)), []
        for _, a in sorted(hits):
            if not taken[a] and not taken[a + length - 1]:
                taken[a : a + length] = b"\1" * length
                out.append((a, a + length))
        return out

    def scan(self, text: str) -> tuple[str | None, float | None, int, float]:
        """(licence, cosine, notices, share of the words in notices)."""
        low = text.lower()
        words = TERM.findall(low)
        among = self.candidates(words)
        if not among:
            return None, None, 0, 0.0
        segments = [(0, len(words), among)]
        at = 0
        for line in low.split("\n"):  # no term goes over a line break
            n = len(TERM.findall(line))
            segments.append((at, at + n, among))
            at += n
        segments += [(a, z, [j]) for j in among for a, z in self.runs(words, j)]
        hits = [(-round(h[0], 9), h[1], a, z) for a, z, js in segments if (h := self.best(words[a:z], js))]
        if not hits:
            return None, None, 0, 0.0
        covered, counted, n = bytearray(len(words)), bytearray(len(words)), 0
        for _, _, a, z in sorted(hits):
            covered[a:z] = b"\1" * (z - a)
            if counted.find(1, a, z) < 0:
                counted[a:z] = b"\1" * (z - a)
                n += 1
        top = min(hits)
        return top[1], -top[0], n, sum(covered) / len(words)


def frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """How many texts hold each term of the vocabulary, and how many texts there are; a row a term and task is all that is shuffled."""
    known = set(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                df[""] += 1
                df.update(known.intersection(terms(text or "")))
        if df:
            yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])

    rows = files.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = {r["term"]: r["n"] for r in rows}
    return df, df.pop("", 0)


def scan(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """files: doc_id, path, text. Returns doc_id, path, license, score, n_notices, origin (own, inherited, null), license_path."""
    rows = files.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string"))
    df, n = frequencies(rows, sorted({t for ts in templates.values() for x in ts for t in terms(x)}))
    scorer = Scorer(templates, df, n, threshold)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scorer.scan(t or "") for t in b.column("text").to_pylist()]
            cols = list(zip(*found)) if found else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("path"), *[pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.int64(), pa.float64()))]], names=["doc_id", "path", "license", "score", "n_notices", "share"])

    own = rows.mapInArrow(match, "doc_id long, path string, license string, score double, n_notices long, share double")
    own = materialize(own, "notices")
    own = own.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), ""))
    is_file = F.col("license").isNotNull() & F.col("dir").isNotNull() & ((F.col("share") >= 0.5) | F.col("path").rlike(FILE_NAME))
    order = F.struct((-F.col("score")).alias("s"), "path")
    licensed = own.where(is_file).groupBy("dir").agg(F.min_by(F.struct("license", "score", "path"), order).alias("from"))
    dirs = own.where("license is null and dir is not null").select("dir").distinct()
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("up")))
    near = dirs.select("dir", F.inline(above)).join(licensed.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max_by("from", "depth").alias("from"))
    out = own.join(near, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "doc_id",
        "path",
        F.coalesce("license", "from.license").alias("license"),
        F.coalesce("score", "from.score").alias("score"),
        "n_notices",
        F.when(mine, "own").when(F.col("from").isNotNull(), "inherited").alias("origin"),
        F.when(mine, F.col("path")).otherwise(F.col("from.path")).alias("license_path"),
    )
