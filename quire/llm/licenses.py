"""Licence scans: a paragraph classifier over sparse word n-grams, with templates to confirm what it says.

A softmax regression over word 1- to 3-grams is trained on the driver from the public notices below, parts and variants of them
(words left out, other words around them), against an unknown class made of ordinary prose and of legal-sounding prose that is
no licence. Its temperature and threshold are set on variants that it wasn't trained on. Each line is classified, and each
paragraph: the lines up to a blank one, joined, so that a wrapped notice is seen whole. What a paragraph is said to be counts if
it is confirmed by the family's templates, either way: most word pairs of a template stand in it, or most of its own stand in a
template; it holds what tells its version or variant from others (`MUST`, `NEVER`); and it holds a word that is told of licences (`told`), of which every template has so many that the first way can't do
without one. Texts and paragraphs without such a word are therefore left out before anything else is computed. Scoring uses DataFrame
functions only; the weights are a table of fixed size.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS"'
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES',
)
#: Fixed public notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "MIT License", "Released under the MIT License.", "Licensed under the MIT license.", "The MIT License (MIT)", "SPDX-License-Identifier: MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        _AS_IS + ", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD": ("Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", *_BSD, "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    "ISC": (
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS',
    ),
    "MPL-2.0": ("Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0": ("Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "Zlib": (
        "Licensed under the zlib License.", "SPDX-License-Identifier: Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "CC-BY": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0": ("Released under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all rights"),
}
#: Fixed words and word pairs that tell versions and variants apart: of the first a notice of the family must hold one, of the second none.
MUST = {
    "GPL-2.0": ("version 2", "gpl 2", "gplv2"), "GPL-3.0": ("version 3", "gpl 3", "gplv3"), "AGPL-3.0": ("affero", "agpl"), "LGPL": ("lesser general", "library general", "lgpl"),
    "CC-BY-SA": ("sharealike", "by sa"), "CC-BY-NC": ("noncommercial", "by nc"),
}
NEVER = {
    "GPL-2.0": ("affero", "agpl", "lesser", "lgpl"), "GPL-3.0": ("affero", "agpl", "lesser", "lgpl"), "Apache-2.0": ("version 1", "apache 1", "license 1"), "MPL-2.0": ("version 1", "v 1", "mpl 1"), "EPL-2.0": ("version 1", "license 1", "epl 1"),
    "CC-BY": ("sharealike", "noncommercial", "noderivatives", "noderivs", "by sa", "by nc", "by nd"), "CC-BY-SA": ("noncommercial", "noderivatives", "noderivs", "by nc", "by nd"), "CC-BY-NC": ("sharealike", "noderivatives", "noderivs", "nc sa", "nc nd"),
}
UNKNOWN = "unknown"
#: Fixed sentences that sound alike and are no licence.
OTHERS = (
    "All rights reserved.", "See the terms of service for details.", "The driver lost the license after the accident.", "A fishing license costs ten dollars.", "The version of the software was released in May.",
    "The public library is open to any person free of charge.", "The mit campus and the apache tribe are far away.", "The general asked the foundation for permission.", "The commons were open to the public without conditions.",
    "The source of the river is subject to change.", "Copyright law is taught in the second year.", "The program is free for all and you can come at any time.", "The copy of the file is available at the office without any warranty.",
    "The use of this file in the course is subject to the terms of the school.", "Permission to use the hall is granted to any person for a fee.", "The author of the book is liable for damages and the publisher is not.",
    "The software runs as is on any kind of machine.", "He was licensed under the old rules of the state.", "The license plate was found near the commons.", "We released the data into the public archive.",
)
#: Fixed words that stand in any prose.
PLAIN = frozenset("a above all an and any are as at be been but by can come did do else following for form free from has have held he her his how i if in including into is it its kind later law limited list made may means must name names no nor not of on one or other out own person persons purpose required same see shall she sell so subject such than that the their these they this those to under use used was we were what whether which who whom will with without written you your".split())
#: Share of a template's word pairs that confirms it, share of a paragraph's own (if it has so many words), and words of a line that may come before.
CONFIRM, WITHIN, WITHIN_WORDS = 0.6, 0.8, 8


def tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def ngrams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def pairs(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


@functools.cache
def told() -> list[str]:
    """Words of which a paragraph must hold one: of each template the longest, until too few of its pairs are without one.

    A paragraph without such a word can't hold CONFIRM of the pairs of any template, so none that the templates confirm as a
    whole is left out.
    """
    out: set[str] = set()
    for t in sorted((t for ts in TEMPLATES.values() for t in ts), key=len):
        every = pairs(tokens(t))
        for w in sorted(set(tokens(t)) - PLAIN, key=lambda w: (-len(w), w)):
            if sum(not out & set(p.split()) for p in every) < CONFIRM * len(every):
                break
            out.add(w)
    return sorted(out)


@functools.cache
def train(seed: int = 7) -> tuple[list[str], dict[str, list[float]], list[float], float, float]:
    """Families (unknown last), weights by n-gram, biases, temperature and threshold; the same at every call."""
    rng = random.Random(seed)
    filler = [w for t in OTHERS for w in tokens(t)] + sorted(PLAIN) + ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    families = [*TEMPLATES, UNKNOWN]

    def variants(words, times):
        yield words
        for _ in range(times):
            # a part of a long notice, as a wrapped one may be cut
            n = len(words) if len(words) < 20 or rng.random() < 0.5 else rng.randint(12, len(words))
            at = rng.randint(0, len(words) - n)
            kept = [w for w in words[at : at + n] if rng.random() > 0.08]
            yield [rng.choice(filler) for _ in range(rng.randint(0, 8))] + kept + [rng.choice(filler) for _ in range(rng.randint(0, 8))]

    rows = [(x, f) for f, ts in TEMPLATES.items() for t in ts for x in variants(tokens(t), 16)]
    # whole notices: the family's long templates one after another
    rows += [(x, f) for f, ts in TEMPLATES.items() for x in variants([w for t in ts if len(t) > 80 for w in tokens(t)] or tokens(ts[0]), 8)]
    rows += [(x, UNKNOWN) for t in OTHERS for x in variants(tokens(t), 12)]
    rows += [([rng.choice(filler) for _ in range(rng.randint(3, 60))], UNKNOWN) for _ in range(300)]
    rng.shuffle(rows)
    cut = len(rows) * 4 // 5
    vocabulary = sorted(set().union(*(ngrams(tokens(t)) for ts in TEMPLATES.values() for t in ts), *(ngrams(tokens(t)) for t in OTHERS)))
    at = {g: i for i, g in enumerate(vocabulary)}
    x, y = np.zeros((len(rows), len(vocabulary)), np.float32), np.array([families.index(f) for _, f in rows])
    for i, (words, _) in enumerate(rows):
        x[i, [at[g] for g in ngrams(words) if g in at]] = 1
    w, b, hot = np.zeros((len(vocabulary), len(families)), np.float32), np.zeros(len(families), np.float32), np.eye(len(families), dtype=np.float32)[y]
    for step in range(120):
        z = x[:cut] @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        rate = 1.0 if step < 80 else 0.3
        w -= rate * (x[:cut].T @ (p - hot[:cut]) / cut * 2 + 1e-4 * w)
        b -= rate * (p - hot[:cut]).mean(0)
    z = (x[cut:] @ w + b).astype(float)
    # the temperature under which held-out variants are likeliest, then a threshold that 99 of 100 unknown ones stay below

    def prob(t):
        p = np.exp((z - z.max(1, keepdims=True)) / t)
        return p / p.sum(1, keepdims=True)

    temperature = max((0.25, 0.5, 0.75, 1.0, 1.5, 2.0), key=lambda t: np.log(prob(t)[np.arange(len(z)), y[cut:]] + 1e-12).sum())
    top = prob(temperature)[y[cut:] == len(families) - 1, :-1].max(1)
    threshold = float(min(0.8, max(0.5, np.quantile(top, 0.99)))) if len(top) else 0.5
    return families, {g: w[i].astype(float).round(6).tolist() for g, i in at.items()}, b.astype(float).round(6).tolist(), float(temperature), threshold


def _grams(words: Column, n: int) -> Column:
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def _units(text: Column) -> Column:
    """The paragraphs of a text (lines up to a blank one): each one's lines, and the lines joined if there are several."""
    blocks = F.filter(F.split(text, "\\n[ \\t\\r]*(?:\\n[ \\t\\r]*)+"), lambda x: F.length(F.btrim(x, F.lit(" \t\r\n"))) > 0)
    lines = lambda b: F.filter(F.split(b, "\\n"), lambda x: F.length(F.btrim(x)) > 0)
    whole = lambda b, i: F.when(F.size(lines(b)) > 1, F.array(F.struct(i.alias("place"), F.lit(-1).alias("line"), b.alias("body")))).otherwise(F.array().cast("array<struct<place:int,line:int,body:string>>"))
    return F.flatten(F.transform(blocks, lambda b, i: F.concat(F.transform(lines(b), lambda x, j: F.struct(i.alias("place"), j.alias("line"), x.alias("body"))), whole(b, i))))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_notices, families, best_probability, notices of every row of docs (doc_id, text, ...).

    Paragraphs are lines up to a blank one. n_notices counts confirmed paragraphs, and confirmed lines whose paragraph isn't
    confirmed as their family; families lists the families in order of name, empty where there is none; notices holds each one's place
    (paragraph and line from 0, line -1 for a whole paragraph), family, probability and the share of word pairs found. Empty and
    null texts have no paragraphs. Rows that share a doc_id and a text are scanned as one and answered each. Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    families, weights, bias, temperature, threshold = train()
    spark = docs.sparkSession
    gate = f"(?i)(?<![a-z0-9])(?:{'|'.join(told())})(?![a-z0-9])"
    rows = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    found = rows.where(F.col("text").rlike(gate)).select("doc_id", F.xxhash64("text").alias("t"), F.inline(_units(F.col("text"))))
    found = found.where(F.col("body").rlike(gate)).distinct()
    found = found.withColumn("words", F.filter(F.split(F.lower("body"), "[^a-z0-9]+"), lambda w: w != ""))
    found = found.withColumn("pairs", F.array_distinct(_grams(F.col("words"), 2)))
    # a row for each n-gram of the vocabulary: some three thousand
    table = spark.createDataFrame([(g, w) for g, w in weights.items()], "gram string, w array<double>")
    key = ["doc_id", "t", "place", "line", "words", "pairs"]
    grams = found.select(*key, F.explode(F.array_distinct(F.concat("words", "pairs", _grams(F.col("words"), 3)))).alias("gram")).join(F.broadcast(table), "gram")
    k = len(families)
    z = grams.groupBy(*key).agg(*[F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(k)])
    z = z.select(*key, F.array(*[(F.col(f"z{i}") + bias[i]) / temperature for i in range(k)]).alias("z"))
    e = F.transform("z", lambda x: F.exp(x - F.array_max("z")))
    z = z.withColumn("e", e).withColumn("p", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, y: a + y)))
    named = z.withColumn("best", F.array_max(F.slice("p", 1, k - 1))).withColumn("family", F.element_at(F.array(*map(F.lit, families)), F.array_position("p", F.col("best")).cast("int")))
    named = named.where((F.col("best") >= threshold) & (F.col("family") != UNKNOWN))
    templates = F.create_map(*[x for f in families[:-1] for x in (F.lit(f), F.array(*[F.array(*map(F.lit, pairs(tokens(t)))) for t in TEMPLATES[f]]))])
    own = F.element_at(templates, F.col("family"))
    share = F.array_max(F.transform(own, lambda t: F.size(F.array_intersect(t, F.col("pairs"))) / F.size(t)))
    within = F.array_max(F.transform(own, lambda t: F.size(F.array_intersect(t, F.col("pairs"))) / F.greatest(F.size("pairs"), F.lit(1))))
    named = named.withColumn("share", F.greatest(share, within)).where((share >= CONFIRM) | ((F.size("words") >= WITHIN_WORDS) & (within >= WITHIN)))
    # what tells versions apart: wrapped lines of two versions are alike, so only what holds its own version counts
    held = F.concat("words", "pairs")
    of = lambda fixed: F.coalesce(F.try_element_at(F.create_map(*[x for f, ws in fixed.items() for x in (F.lit(f), F.array(*map(F.lit, ws)))]), F.col("family")))
    named = named.where(F.coalesce(F.arrays_overlap(held, of(MUST)), F.lit(True)) & ~F.coalesce(F.arrays_overlap(held, of(NEVER)), F.lit(False)))
    notices = named.groupBy("doc_id", "t").agg(F.array_sort(F.collect_list(F.struct("place", "line", "family", F.round("best", 6).alias("probability"), F.round("share", 6).alias("share")))).alias("n"))
    # a paragraph that is a notice as a whole is one, however many of its lines are of its family
    counted = F.filter("n", lambda x: (x["line"] < 0) | ~F.exists("n", lambda y: (y["line"] < 0) & (y["place"] == x["place"]) & (y["family"] == x["family"])))
    notices = notices.select(F.col("doc_id").alias("id"), F.col("t").alias("of"), counted.alias("notices"))
    blocks = F.size(F.filter(F.split("text", "\\n[ \\t\\r]*(?:\\n[ \\t\\r]*)+"), lambda x: F.length(F.btrim(x, F.lit(" \t\r\n"))) > 0))
    out = rows.select("doc_id", F.xxhash64("text").alias("t"), blocks.cast("long").alias("n_paragraphs"))
    out = out.join(notices, out["doc_id"].eqNullSafe(F.col("id")) & (F.col("t") == F.col("of")), "left")
    return out.select(
        "doc_id", "n_paragraphs", F.coalesce(F.size("notices"), F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct("notices.family")), ","), F.lit("")).alias("families"),
        F.array_max("notices.probability").alias("best_probability"), "notices",
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`scan` over all documents."""
    return scan(C.table(spark, sf_dir, "documents"))
