"""Operator 3: licence scans, in DataFrame functions only.

A trained classifier of paragraphs. A paragraph is a line with the lines that
go on with it: comment marks at the start of lines are dropped, and a line is
joined with the next one when it ends within a sentence and the next begins in
lower case, or when it has the length of a wrapped line. So a notice that
is wrapped in a source file is one paragraph, and lines of prose stay apart.

Features are the presence of word 1- and 2-grams; a multinomial logistic
regression tells the licence families of ``NOTICES`` and "none" apart. A
paragraph whose best class is a family is a finding. It is given to that family
when the probability reaches a threshold and the paragraph agrees with one of
the family's templates: it has ``SIMILAR`` of the 2-grams of the shorter of the
two, or the word of a template of one word. Otherwise it is ``unknown``: a
licence, but of no family that the model knows.

Training. Rows are the notices, each alone and after each lead-in, and at most
``BACKGROUND`` paragraphs of the documents without a licence word (a bounded
sample: those with the smallest hashes of id and text). Grams that over
``COMMON`` of the background has are no features, so only licence wording
carries weight, and a paragraph without any feature is "none". The regression
on these few hundred different rows is fitted on the driver. The threshold is
calibrated by leaving out: each notice is predicted by a model without it, each
family by a model without the family, all with the steps of the final model;
the least threshold that best separates the two is used.

Plan. Documents are split to paragraphs and words by native functions, and
paragraphs that share a word with the features go on: all others are "none"
whatever the weights. Equal paragraphs are classified once (a group-by, so
boilerplate on a third of all rows is one row a task); their grams meet the
weights and the templates (fixed small tables) in joins, and the findings
return by the text.

Edge cases. Null and empty texts and lines have no findings. Rows with a null
id and repeated rows each get a row of their own in ``scan``. An empty table
gives an empty result (the model is then fitted on the notices alone). Other
columns are not read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglab.llm.common import save

BACKGROUND, COMMON, SIMILAR, STEPS = 2000, 0.01, 0.5, 200
NONE, UNKNOWN = "none", "unknown"

# Short public notices by family, and lead-ins.
NOTICES: dict[str, tuple[str, ...]] = {
    "agpl-3.0": ("GNU Affero General Public License, version 3", "GNU AGPLv3", "AGPLv3", "SPDX-License-Identifier: AGPL-3.0-only",
                 "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "apache-2.0": ("the Apache License, Version 2.0", "Apache-2.0 license", "SPDX-License-Identifier: Apache-2.0",
                   "the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "bsd": ("the BSD License", "the BSD 3-Clause License", "the BSD 2-Clause License", "a BSD-style license", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "cc-by-4.0": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "the Creative Commons Attribution License"),
    "cc-by-nc-4.0": ("CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License",
                     "the Creative Commons Attribution-NonCommercial License"),
    "cc-by-sa-4.0": ("CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License",
                     "the Creative Commons Attribution-ShareAlike License"),
    "cc0-1.0": ("CC0 1.0", "CC0 1.0 Universal Public Domain Dedication", "the Creative Commons Zero public domain dedication"),
    "gpl-2.0": ("the GNU General Public License, version 2", "GNU GPLv2", "GPLv2", "SPDX-License-Identifier: GPL-2.0-only",
                "the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    "gpl-3.0": ("the GNU General Public License, version 3", "GNU GPLv3", "GPLv3", "SPDX-License-Identifier: GPL-3.0-only",
                "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "isc": ("the ISC License", "SPDX-License-Identifier: ISC",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "lgpl": ("the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License, version 3", "GNU LGPLv3", "LGPLv3",
             "the GNU Lesser General Public License as published by the Free Software Foundation"),
    "mit": ("the MIT License", "MIT license", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
    "mpl-2.0": ("the Mozilla Public License, version 2.0", "MPL-2.0", "the terms of the Mozilla Public License, v. 2.0",
                "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    "proprietary": ("All rights reserved.", "Copyright (c) 2020. All rights reserved.", "Proprietary and confidential. All rights reserved.",
                    "Unauthorized copying of this file, via any medium, is strictly prohibited."),
}
LEADS = ("", "Licensed under ", "Released under ", "This work is licensed under ", "This file is distributed under ", "This program is free software under ",
         "Code in this repository is available under the terms of ")
#: Short forms: "License: MIT" and the like are notices, too.
SHORT = {"agpl-3.0": "AGPL-3.0", "apache-2.0": "Apache-2.0", "bsd": "BSD", "cc0-1.0": "CC0", "gpl-2.0": "GPL-2.0", "gpl-3.0": "GPL-3.0", "isc": "ISC", "lgpl": "LGPL",
         "mit": "MIT", "mpl-2.0": "MPL-2.0"}
#: A line of so many characters may be wrapped, one of more is not.
WRAPPED, LONGEST = 50, 120
#: Words that keep a paragraph out of the background sample.
_LICENCE_WORD = r"(?i)licen[cs]e|copyright|rights reserved|public domain|warrant"
_SPLIT = r"[^\p{L}\p{N}.+]+|\.(?![0-9])"


def paragraphs_of(text: Column) -> Column:
    """The paragraphs of a text, in order."""
    plain = F.regexp_replace(text, r"(?m)^[ \t]*(?:[#;%*]+|//+|--+|/\*+)[ \t]*|\r$|[ \t]+$", "")
    joined = F.regexp_replace(plain, r"(?<=[\p{L}\p{N},;)\"'])\n(?=[a-z0-9(\"'])", " ")
    return F.split(F.regexp_replace(joined, rf"(?m)^([^\n]{{{WRAPPED},{LONGEST}}}[\p{{L}}\p{{N}},)])\n(?=[^\s])", "$1 "), "\n")


def notices(family: str) -> tuple[str, ...]:
    return NOTICES[family] + ((f"License: {SHORT[family]}",) if family in SHORT else ())


def _template(notice: str) -> list[str]:
    """What a paragraph must share with a notice: its 2-grams, or its only word."""
    grams = _plain_grams(notice)
    return sorted(g for g in grams if " " in g) or sorted(grams)


def words_of(line: Column) -> Column:
    """Lower-cased words; a point stays within a number."""
    return F.filter(F.split(F.lower(line), _SPLIT), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """The different 1- and 2-grams."""
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), F.slice(words, 2, F.size(words)),
                                                 lambda a, b: F.concat(a, F.lit(" "), b)))
    return F.array_distinct(F.concat(words, F.coalesce(pairs, F.array().cast("array<string>"))))


def _plain_grams(line: str) -> frozenset[str]:
    """The same, of one training row."""
    own = [w for w in re.split(r"[^\w.+]+|_|\.(?![0-9])", line.lower()) if w]
    return frozenset(own) | frozenset(f"{a} {b}" for a, b in zip(own, own[1:], strict=False))


class Model(NamedTuple):
    classes: list[str]
    grams: list[str]
    weights: np.ndarray
    bias: np.ndarray
    threshold: float


def _fit(rows: list[frozenset[str]], y: np.ndarray, share: np.ndarray, grams: list[str], classes: int, ridge: float = 0.02, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression on presence (Adam); ``share``: the weight of each row."""
    place = {g: k for k, g in enumerate(grams)}
    sparse = [[place[g] for g in r if g in place] for r in rows]
    column = np.array([c for r in sparse for c in r], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in sparse])
    # Sums over the runs of equal rows, and of equal columns.
    filled, starts = np.unique(row, return_index=True)
    by_column = np.argsort(column, kind="stable")
    used, heads = np.unique(column[by_column], return_index=True)
    truth = np.eye(classes)[y]
    values = [np.zeros((len(grams), classes)), np.zeros(classes)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        z = np.tile(values[1], (len(rows), 1))
        z[filled] += np.add.reduceat(values[0][column], starts)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        slope = (p / p.sum(axis=1, keepdims=True) - truth) * share[:, None]
        by_gram = ridge * values[0]
        by_gram[used] += np.add.reduceat(slope[row[by_column]], heads)
        for k, g in enumerate((by_gram, slope.sum(axis=0))):
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            values[k] = values[k] - 0.1 * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return values[0], values[1]


def _probabilities(row: frozenset[str], grams: dict[str, int], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    z = bias + weights[[grams[g] for g in row if g in grams]].sum(axis=0)
    p = np.exp(z - z.max())
    return p / p.sum()


def train(background: list[str], common: float = COMMON) -> Model:
    """The model from the notices and background paragraphs."""
    classes = [*sorted(NOTICES), NONE]
    rows, y, notice = [], [], []
    for k, family in enumerate(sorted(NOTICES)):
        for n, text in enumerate(notices(family)):
            for lead in LEADS:
                rows.append(_plain_grams(lead + text))
                y.append(k)
                notice.append((k, n))
    behind = [_plain_grams(b) for b in background]
    seen: dict[str, int] = {}
    for b in behind:
        for g in b:
            seen[g] = seen.get(g, 0) + 1
    rare = {g for r in rows for g in r if seen.get(g, 0) <= common * len(behind)}
    # A pair of common words tells nothing, however rare the pair: each feature holds a word that is a feature.
    grams = sorted(g for g in rare if " " not in g or rare.intersection(g.split(" ")))
    of = frozenset(grams)
    merged: dict[frozenset[str], float] = {frozenset(): 1.0}
    for b in behind:  # all of it together weighs as much as a family
        merged[b & of] = merged.get(b & of, 0) + len(rows) / len(NOTICES) / len(behind)
    truth = np.array([*y, *[len(classes) - 1] * len(merged)])
    everything = [*rows, *merged]
    share = np.array([*[1.0] * len(rows), *merged.values()])
    weights, bias = _fit(everything, truth, share, grams, len(classes))

    # Calibration: what a model says of families it knows, by a notice it has not seen, and of one it does not know.
    inside, outside = [], []
    place = {g: k for k, g in enumerate(grams)}
    marks = np.array([*notice, *[(-1, -1)] * len(merged)])
    for k, family in enumerate(sorted(NOTICES)):
        without = marks[:, 0] != k
        w, b = _fit([r for r, s in zip(everything, without, strict=True) if s], truth[without], share[without], grams, len(classes))
        outside += [_probabilities(r, place, w, b)[:-1].max() for r, m in zip(rows, notice, strict=True) if m[0] == k]
        for n in range(len(notices(family))):
            fold = ~((marks[:, 0] == k) & (marks[:, 1] == n))
            w, b = _fit([r for r, s in zip(everything, fold, strict=True) if s], truth[fold], share[fold], grams, len(classes))
            inside += [_probabilities(r, place, w, b)[k] for r, m in zip(rows, notice, strict=True) if m == (k, n)]
    known, other = np.array(inside), np.array(outside)
    threshold = max(np.linspace(0.1, 0.98, 89), key=lambda t: (known >= t).mean() + (other < t).mean())
    return Model(classes, grams, weights, bias, float(threshold))


def background(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = BACKGROUND) -> list[str]:
    """Paragraphs without a licence word, of at most 2,000 characters; the ``rows`` with the smallest hashes of id and text."""
    each = docs.select(F.col(id_col).alias("doc_id"), F.explode(paragraphs_of(F.col(text_col))).alias("text"))
    plain = each.where(F.length("text").between(1, 2000)).withColumn("h", F.xxhash64("doc_id", "text")).where(~F.col("text").rlike(_LICENCE_WORD))
    return [r.text for r in plain.orderBy("h", "text").select("text").limit(rows).collect()]


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per finding: row, doc_id, paragraph (from 0), text, family, probability, similarity."""
    spark = docs.sparkSession
    model = model or train(background(docs, id_col, text_col))
    vocabulary = F.array(*[F.lit(g) for g in model.grams if " " not in g])
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), paragraphs_of(F.col(text_col)).alias("paragraphs"))
    source = numbered.select("row", "doc_id", F.posexplode("paragraphs").alias("paragraph", "text"))
    lines = save(source.where(F.arrays_overlap(words_of(F.col("text")), vocabulary)), "licence-lines")

    classes = len(model.classes)
    weights = _table(spark, [(g, *map(float, w)) for g, w in zip(model.grams, model.weights, strict=True)],
                     "gram string, " + ", ".join(f"w{k} double" for k in range(classes)))
    different = lines.select("text").distinct().select("text", grams_of(words_of(F.col("text"))).alias("grams"))
    exploded = different.select("text", F.explode("grams").alias("gram"))
    sums = exploded.join(F.broadcast(weights), "gram").groupBy("text").agg(*[(F.sum(f"w{k}") + float(model.bias[k])).alias(f"z{k}") for k in range(classes)])
    scores = F.array(*[f"z{k}" for k in range(classes)])
    top = F.array_max(scores)
    named = sums.select("text", F.element_at(F.array(*map(F.lit, model.classes)), F.array_position(scores, top).cast("int")).alias("best"),
                        (1.0 / F.aggregate(scores, F.lit(0.0), lambda a, z: a + F.exp(z - top))).alias("probability")).where(F.col("best") != NONE)

    templates = [(f, n, _template(t)) for f in NOTICES for n, t in enumerate(notices(f))]
    pairs = _table(spark, [(g, f, n, len(gs)) for f, n, gs in templates for g in gs], "gram string, family string, template int, size int")
    mine = named.join(different, "text").select(
        "text", "best", "probability", F.explode("grams").alias("gram"), F.greatest(F.size(F.filter("grams", lambda g: F.contains(g, F.lit(" ")))), F.lit(1)).alias("own"))
    agree = mine.join(F.broadcast(pairs), [mine["gram"] == pairs["gram"], mine["best"] == pairs["family"]]).groupBy("text", "template").agg(
        (F.count(F.lit(1)) / F.least(F.first("own"), F.first("size"))).alias("part")).groupBy("text").agg(F.max("part").alias("similarity"))
    # Read again for each line that has the text; few different texts are findings.
    found = save(named.join(agree, "text", "left").select(
        "text", "probability", F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        F.when((F.col("probability") >= model.threshold) & (F.col("similarity") >= SIMILAR), F.col("best")).otherwise(F.lit(UNKNOWN)).alias("family")), "licence-texts")
    return lines.join(found, "text").select("row", "doc_id", "paragraph", "text", "family", "probability", "similarity")


def document_licences(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a finding: doc_id, n_lines (paragraphs), families (different ones, sorted, comma-joined), probability (the least)."""
    return scan(docs, model, id_col, text_col).groupBy("row", "doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.concat_ws(",", F.array_sort(F.collect_set("family"))).alias("families"),
        F.min("probability").alias("probability"), F.min("similarity").alias("similarity")).drop("row")
