"""Licence scan by a positional index of rare licence words.

A template is a word sequence with mandatory key phrases at known places in
it: a short one is its phrase, a long one is a whole licence text or notice.
The index holds, for each template, postings (word, position) of those words of
its key phrases that have the highest inverse document frequency, counted over
all rows.  A file looks up which of its own words are indexed.  Each occurrence
gives, by relative position, the place where the template would have to start;
postings of one template are intersected there, and a place where ``AGREE`` of
them or more agree is a candidate.  (So the last ``AGREE`` - 1 postings, the most
frequent ones, are never looked up: a candidate has one of the others.)  A
candidate whose key phrases all stand at their own positions is a match.
Coverage is the share of the template's words found at their own positions.

All postings agree where the key phrases stand, so no match is lost, whatever the
other words.  With an altered key phrase a licence text is no match, but its
coverage still counts for ``near``, from ``NEAR`` on, if enough postings agree.

Everything is JVM-side array work on the file's own row: one small aggregate
for the frequencies, then one pass without a shuffle.  A posting's partners are
read at their places in the row's words, so nothing is grouped or sorted.  Only
the frequencies of the template words (a table as large as the template list)
reach the driver.

Null or empty text has no words and no match.  Rows, ids and extra columns
aren't looked at: each row is scanned alone, so repeated rows give equal
results, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import LOWER, UPPER, ascii_lower, fresh_names, read_table, text_or_empty

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


ANCHORS = 4  # rarest key-phrase words of a template that are indexed, all but one in a short one
AGREE = 2    # postings that have to agree on a place
NEAR = 0.6   # coverage from which a place without the key phrases counts as near


def _words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, text.translate(str.maketrans(UPPER, LOWER))) if w]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...] = ()  # mandatory; the whole text if there are none
    base: bool = False

    @property
    def words(self) -> list[str]:
        return _words(self.text)

    @property
    def key_phrases(self) -> list[tuple[int, list[str]]]:
        """(place in the template, words) of each mandatory phrase."""
        w, out = self.words, []
        for p in map(_words, self.phrases or (self.text,)):
            out.append((next(i for i in range(len(w)) if w[i:i + len(p)] == p), p))
        return out


# The base phrases and their labels, further licence phrases, then licence texts and notices.
TEMPLATES = [
    Template("gpl", "GNU General Public License", base=True),
    Template("apache", "Apache License", base=True),
    Template("cc-by", "CC BY", base=True),
    Template("mit", "MIT License", base=True),
    Template("gpl-3.0", "GNU General Public License version 3"),
    Template("gpl-2.0", "GNU General Public License version 2"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("apache-2.0", "Apache License, Version 2.0"),
    Template("cc-by-nc", "CC BY-NC"),
    Template("cc-by-sa", "CC BY-SA"),
    Template("cc-by-nd", "CC BY-ND"),
    Template("cc0", "CC0 1.0"),
    Template("bsd", "Redistribution and use in source and binary forms"),
    Template("mit-grant", "Permission is hereby granted, free of charge"),
    Template("mpl-2.0", "Mozilla Public License"),
    Template("epl", "Eclipse Public License"),
    Template("isc", "ISC License"),
    Template("unlicense", "free and unencumbered software"),
    Template("mit-text", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
        ("to deal in the Software without restriction", "sublicense, and/or sell copies")),
    Template("bsd-2-clause-text", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
        ("Redistribution and use in source and binary forms", "binary form must reproduce the above copyright notice")),
    Template("isc-text", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS.""", ("for any purpose with or without fee is hereby granted",)),
    Template("apache-2.0-notice", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
        ("Apache License, Version 2.0", "except in compliance with the License")),
    Template("gpl-3.0-notice", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
        ("GNU General Public License", "either version 3 of the License")),
    Template("mpl-2.0-notice", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
        ("Mozilla Public License, v. 2.0",)),
    Template("unlicense-text", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
        ("free and unencumbered software released into the public domain",)),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATOR), lambda w: w != "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(df: DataFrame, words_col: str, templates: list[Template]) -> dict[str, int]:
    """In how many rows each key-phrase word occurs; over all rows."""
    vocabulary = sorted({w for t in templates for _, p in t.key_phrases for w in p})
    seen = F.array_intersect(F.col(words_col), _strings(vocabulary))
    rows = df.select(F.explode(seen).alias("w")).groupBy("w").count().collect()  # at most one per vocabulary word
    return {r["w"]: r["count"] for r in rows}


def postings(template: Template, rows_with: dict[str, int]) -> list[tuple[int, str]]:
    """(position, word) of the rarest words of the key phrases, rarest first."""
    places = [(at + i, w) for at, p in template.key_phrases for i, w in enumerate(p)]
    places.sort(key=lambda x: (rows_with.get(x[1], 0), x[0]))
    return places[:min(ANCHORS, max(AGREE, len(places) - 1))]


def scan(df: DataFrame, text_col: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """``df`` with ``n_words``, ``matches``: array of (label, base, start of the
    first key phrase, coverage), by label and start, and ``near``: the largest
    coverage of a place, match or not.  Columns of these names are replaced."""
    kept = [c for c in df.columns if c.lower() not in ("n_words", "matches", "near")]
    words, hits, places = fresh_names(df, "words", "hits", "places")
    src = df.select(*kept, words_of(text_or_empty(text_col)).alias(words))
    rows_with = document_frequencies(src, words, templates)

    index, indexed = {}, []
    for k, t in enumerate(templates):
        anchors = postings(t, rows_with)
        for i, w in anchors[:len(anchors) - AGREE + 1]:
            index.setdefault(w, []).append(F.struct(F.lit(k).alias("t"), F.lit(i).alias("at")))
        indexed.append(F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _strings(t.words).alias("words"),
            F.array(*[F.struct(F.lit(i).alias("at"), F.lit(w).alias("w")) for i, w in anchors]).alias("anchors"),
            F.array(*[F.struct(F.lit(i).alias("at"), _strings(p).alias("words")) for i, p in t.key_phrases]).alias(
                "phrases")))
    templates_of = F.array(*indexed)
    rare_words = sorted(index)
    lists, rare = F.array(*[F.array(*index[w]) for w in rare_words]), _strings(rare_words)

    def found(word: Column, i: Column) -> Column:
        return F.when(word.isin(rare_words), F.struct(word.alias("w"), i.alias("i")))

    src = src.withColumn(hits, F.when(F.arrays_overlap(F.col(words), rare),
                                      F.filter(F.transform(words, found), lambda h: h.isNotNull())))

    def stands(c: Column, at: Column, word: Column) -> Column:
        return F.coalesce(F.get(F.col(words), c["start"] + at) == word, F.lit(False))

    def first_of_agreeing(c: Column) -> Column:
        """Enough postings agree, and this is the rarest of them: one candidate a place."""
        agree = F.filter(F.get(templates_of, c["t"])["anchors"], lambda a: stands(c, a["at"], a["w"]))
        return (F.size(agree) >= AGREE) & (F.get(agree, F.lit(0))["at"] == c["at"])

    def candidates(h: Column) -> Column:
        here = F.element_at(lists, F.array_position(rare, h["w"]).cast("int"))
        starts = F.transform(here, lambda p: F.struct(p["t"], p["at"], (h["i"] - p["at"]).alias("start")))
        return F.filter(starts, first_of_agreeing)

    def judged(c: Column) -> Column:
        t = F.get(templates_of, c["t"])
        same = F.filter(t["words"], lambda w, i: stands(c, i, w))
        whole = F.forall(t["phrases"], lambda p: F.forall(
            F.transform(p["words"], lambda w, i: stands(c, p["at"] + i, w)), lambda x: x))
        return F.struct(t["label"].alias("label"), t["base"].alias("base"),
                        (c["start"] + F.get(t["phrases"], F.lit(0))["at"]).alias("start"),
                        (F.size(same) / F.size(t["words"])).alias("coverage"), whole.alias("whole"))

    src = src.withColumn(places, F.transform(F.flatten(F.transform(F.col(hits), candidates)), judged))
    matches = F.array_sort(F.transform(
        F.filter(F.col(places), lambda x: x["whole"]),
        lambda x: F.struct(x["label"], x["base"], x["start"], x["coverage"])))
    none = F.array().cast("array<struct<label:string,base:boolean,start:int,coverage:double>>")
    near = F.array_max(F.transform(F.filter(F.col(places), lambda x: x["whole"] | (x["coverage"] >= NEAR)),
                                   lambda x: x["coverage"]))
    return src.select(*kept, F.size(words).cast("long").alias("n_words"), F.coalesce(matches, none).alias("matches"),
                      F.coalesce(near, F.lit(0.0)).alias("near"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every whole text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("matches")
    base = F.filter(m, lambda x: x["base"])
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["start"].cast("long"))
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(m).alias("labels"),
        F.col("near").alias("score"))


def _values(rows: list[str]) -> str:
    return ", ".join(rows)


def op1_sql() -> str:
    """The same by plain joins of all word positions with postings, templates and phrases."""
    template = _values([f"({k}, '{t.label}', {str(t.base).lower()}, {len(t.words)}, {t.key_phrases[0][0]}, "
                        f"{sum(len(p) for _, p in t.key_phrases)})" for k, t in enumerate(TEMPLATES)])
    word = _values([f"({k}, {i}, '{w}')" for k, t in enumerate(TEMPLATES) for i, w in enumerate(t.words)])
    phrase = _values([f"({k}, {at + i}, '{w}')" for k, t in enumerate(TEMPLATES) for at, p in t.key_phrases
                      for i, w in enumerate(p)])
    return rf"""
WITH template(k, label, base, size, first_at, needed) AS (VALUES {template}),
word(k, t, w) AS (VALUES {word}),
phrase(k, t, w) AS (VALUES {phrase}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (SELECT rid, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
rows_with AS (SELECT w, count(DISTINCT rid) AS n FROM p WHERE w IN (SELECT w FROM phrase) GROUP BY w),
ranked AS (SELECT k, t, phrase.w, row_number() OVER (PARTITION BY k ORDER BY coalesce(n, 0), t) AS rank,
        count(*) OVER (PARTITION BY k) AS places FROM phrase LEFT JOIN rows_with ON rows_with.w = phrase.w),
posting AS (SELECT k, t, w FROM ranked WHERE rank <= least({ANCHORS}, greatest({AGREE}, places - 1))),
candidate AS (SELECT p.rid, x.k, p.i - x.t AS start FROM p JOIN posting x ON x.w = p.w
    GROUP BY p.rid, x.k, p.i - x.t HAVING count(*) >= {AGREE}),
covered AS (SELECT c.rid, c.k, c.start, count(*) AS n FROM candidate c JOIN word x ON x.k = c.k
    JOIN p ON p.rid = c.rid AND p.i = c.start + x.t AND p.w = x.w GROUP BY c.rid, c.k, c.start),
stood AS (SELECT c.rid, c.k, c.start, count(*) AS n FROM candidate c JOIN phrase x ON x.k = c.k
    JOIN p ON p.rid = c.rid AND p.i = c.start + x.t AND p.w = x.w GROUP BY c.rid, c.k, c.start),
found AS (SELECT c.rid, t.label, t.base, c.start + t.first_at AS start, c.n / t.size AS coverage,
        coalesce(s.n = t.needed, false) AS whole
    FROM covered c JOIN template t ON t.k = c.k
    LEFT JOIN stood s ON s.rid = c.rid AND s.k = c.k AND s.start = c.start),
best AS (SELECT rid, max(coverage) AS score FROM found WHERE whole OR coverage >= {NEAR} GROUP BY rid),
g AS (SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
        max(start) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found WHERE whole GROUP BY rid)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(g.n_base, 0) AS BIGINT) AS n_base,
    CAST(g.first_word AS BIGINT) AS first_word, CAST(g.last_word AS BIGINT) AS last_word,
    coalesce(g.base_labels, '') AS base_labels, coalesce(g.labels, '') AS labels,
    CAST(coalesce(best.score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (rid) LEFT JOIN best USING (rid)
"""
