"""Licence scans: TF-IDF cosine of passages to licence texts and headers, then inheritance from the nearest directory.

A template is a notice, a header, a title or a whole short licence. It is compared with passages of its own length anywhere in a text,
across lines. Tasks pick the passages by the template's own words; that only drops what could not reach the least similarity, since any
other word lengthens a passage's vector. The words of these passages are then weighed by their document frequencies, which Spark
counts over all documents, and joined back.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import materialize

# Texts of public licences, their headers and notices, by SPDX name
GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
AS_IS = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
NO_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software "
    "Foundation, either version {version} of the License, or (at your option) any later version."
)
APACHE = (
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License."
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
    "notice and this permission notice appear in all copies."
)
ZLIB = (
    "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of "
    "this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
    "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
TEXTS = {
    "AGPL-3.0-or-later": [GNU.format(name="Affero General Public License", version=3)],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", APACHE, "Apache License Version 2.0, January 2004"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause Simplified License", BSD, "BSD 2-Clause License"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license", f"{BSD} {NO_NAMES}", "BSD 3-Clause License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"],
    "GPL-2.0-only": ["This work is licensed under the GNU General Public License, version 2", "GNU General Public License Version 2, June 1991"],
    "GPL-2.0-or-later": [GNU.format(name="General Public License", version=2)],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3", "GNU General Public License Version 3, 29 June 2007"],
    "GPL-3.0-or-later": [GNU.format(name="General Public License", version=3)],
    "ISC": ["Licensed under the ISC License", ISC],
    "LGPL-3.0-only": ["This work is licensed under the GNU Lesser General Public License, version 3", "GNU Lesser General Public License Version 3"],
    "LGPL-3.0-or-later": [GNU.format(name="Lesser General Public License", version=3)],
    "MIT": ["Released under the MIT License", f"{GRANT} {AS_IS}", GRANT, "Licensed under the MIT License", "The MIT License (MIT)"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", UNLICENSE],
    "Zlib": [ZLIB],
}
TEMPLATES = [(name, text) for name, texts in TEXTS.items() for text in [*texts, f"SPDX-License-Identifier: {name}"]]
LEAST = 0.75  # cosine
WORDS = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def template_words(text: str) -> list[str]:
    return re.findall(WORDS, text.lower())


def idf(total: int, holding: int) -> float:
    return math.log((1 + total) / (1 + holding)) + 1


@dataclass(frozen=True)
class Template:
    """A licence text as a vector, and what is needed to look for it."""

    licence: str
    length: int  # words
    vector: dict[str, float]
    norm: float
    needed: frozenset[str]  # without one of these nothing reaches the least similarity

    @classmethod
    def of(cls, licence: str, text: str, weight: dict[str, float], least: float) -> Template:
        words = template_words(text)
        vector = {w: n * weight[w] for w, n in Counter(words).items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        needed, rest = set(), 0.0
        for word, w in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            rest += w * w
            if math.sqrt(rest) >= least * norm - 1e-9:
                needed.add(word)
        return cls(licence, len(words), vector, norm, frozenset(needed))

    def passages(self, words: list[str], weight: dict[str, float], least: float) -> list[int]:
        """Starts of passages that may be alike: at words of the template, most alike on its words first, none overlapping another."""
        found = []
        for start in [i for i, w in enumerate(words) if w in self.vector]:
            part = Counter(w for w in words[start : start + self.length] if w in self.vector)
            if self.needed.isdisjoint(part):
                continue
            values = [(n * weight[w], self.vector[w]) for w, n in part.items()]
            most = sum(a * b for a, b in values) / (self.norm * math.sqrt(sum(a * a for a, _ in values)))
            if most >= least - 1e-9:
                found.append((-round(most, 9), start))
        kept: list[int] = []
        for _, start in sorted(found):
            if all(abs(start - other) >= self.length for other in kept):
                kept.append(start)
        return kept


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """Rows (key, start, licence, similarity) for the passages whose cosine to a template is ``least`` or more.

    ``start`` counts words from 0. A passage is as long as its template, or what is left of the text; of overlapping passages for one template that most
    alike on the template's words is taken, then the first. Null and empty texts have none. Whole texts are read; document frequencies count every
    document, repeated rows too. Other columns are left aside.
    """
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    held = F.array_intersect(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)), F.array(*map(F.lit, vocabulary)))
    df = rows.select(F.explode(held).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in df.collect()}  # at most one row for each template word
    total = docs.count()
    weight = {w: idf(total, counts.get(w, 0)) for w in vocabulary}
    vectors = [Template.of(name, t, weight, least) for name, t in templates]
    needed = frozenset(w for t in vectors for w in t.needed)
    kind = dict(rows.dtypes)["key"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(WORDS)
        for batch in batches:
            out = []
            for i, body in enumerate(batch.column("text")):
                words = pattern.findall(body.as_py())
                if needed.isdisjoint(words):
                    continue
                present = set(words)
                for t, template in enumerate(vectors):
                    if not template.needed.isdisjoint(present):
                        for start in template.passages(words, weight, least):
                            out += [(i, t, start, w, n) for w, n in Counter(words[start : start + template.length]).items()]
            at, *columns = zip(*out) if out else [()] * 5
            columns = [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in ("row", "key")), *columns], ["row", "key", "template", "start", "word", "tf"])

    terms = materialize(rows.mapInArrow(look, f"row long, key {kind}, template int, start long, word string, tf long"), "licence-terms")
    others = materialize(terms.select("word").where(~F.col("word").isin(vocabulary)).distinct(), "licence-words")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORDS), F.lit(0)))).alias("word"))
    frequency = words.join(others, "word").groupBy("word").agg(F.count("*").alias("docs"))
    frequency = frequency.unionByName(docs.sparkSession.createDataFrame([(w, counts.get(w, 0)) for w in vocabulary], "word string, docs long"))
    frequency = materialize(frequency, "document-frequencies")
    spark = docs.sparkSession
    unit = spark.createDataFrame([(i, w, v / t.norm) for i, t in enumerate(vectors) for w, v in t.vector.items()], "template int, word string, unit double")
    names = spark.createDataFrame([(i, t.licence) for i, t in enumerate(vectors)], "template int, licence string")
    own = F.col("tf") * (F.log((1 + F.lit(total)) / (1 + F.col("docs"))) + 1)
    scored = terms.join(frequency, "word").join(F.broadcast(unit), ["template", "word"], "left").withColumn("w", own)  # as many rows as the templates have words
    scored = scored.groupBy("row", "key", "template", "start").agg((F.sum(F.col("w") * F.coalesce("unit", F.lit(0.0))) / F.sqrt(F.sum(F.col("w") * F.col("w")))).alias("similarity"))
    alike = scored.withColumn("similarity", F.round("similarity", 9)).where(F.col("similarity") >= least).join(F.broadcast(names), "template")
    return alike.select(F.col("key").alias(key), "start", "licence", "similarity")


def ancestors(path: str = "dir"):
    """The directory itself and those above it, nearest first: array of (far, dir)."""
    parts = F.split(F.col(path), "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(
        i.alias("far"), F.array_join(F.slice(parts, 1, F.size(parts) - i), "/").alias("dir")))


def assign(docs: DataFrame, found: DataFrame, key: str = "doc_id", path: str = "dir") -> DataFrame:
    """Rows (key, licence, similarity, inherited_from) for every row of ``docs`` (key, path of its directory).

    A document has the licence of its best passage (ties: smaller name). One without takes that of the nearest directory
    above it, its own first, in which a document has one: the licence most of those have (ties: smaller name). Where
    there is none, ``licence`` is null. Directories are resolved first, each once; documents then join their
    directory, so nothing is joined on a name that all share. A null path inherits nothing.
    """
    own = found.groupBy(F.col(key).alias("key")).agg(F.min(F.struct((-F.col("similarity")).alias("away"), "licence")).alias("best"))
    own = materialize(own.select("key", F.col("best.licence").alias("own"), (-F.col("best.away")).alias("similarity")), "own-licences")
    rows = docs.select(F.col(key).alias("key"), F.col(path).alias("dir"))
    votes = rows.join(own, "key").where("dir is not null").groupBy("dir", "own").agg(F.count("*").alias("n"))
    declared = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("less"), "own")).alias("top"))
    declared = materialize(declared.select("dir", F.col("top.own").alias("given")), "directory-licences")
    above = rows.select("dir").where("dir is not null").distinct().select(F.col("dir").alias("start"), F.inline(ancestors()))
    nearest = above.join(declared, "dir").groupBy("start").agg(F.min(F.struct("far", "dir", "given")).alias("near"))
    nearest = nearest.select(F.col("start").alias("dir"), F.col("near.given").alias("given"), F.col("near.dir").alias("origin"))
    joined = rows.join(own, "key", "left").join(nearest, "dir", "left")
    return joined.select(
        F.col("key").alias(key), F.coalesce("own", "given").alias("licence"), "similarity",
        F.when(F.col("own").isNull(), F.col("origin")).alias("inherited_from"))
