"""Licence scans: a paragraph classifier on word n-grams, confirmed by comparison with templates. DataFrame operations only."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import cut, read, unit

#: Notices of each licence family, as their publishers word them.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: Apache-2.0", "Released under the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT", "The MIT License (MIT)", "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Licensed under the BSD 3-Clause License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "SPDX-License-Identifier: BSD-3-Clause", "Released under the 2-clause BSD license.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GNU General Public License, version 2.", "Released under the GPL version 3.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "agpl": ("This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "You should have received a copy of the GNU Affero General Public License along with this program."),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Content is available under the Creative Commons Attribution License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 4.0."),
    "cc0": ("Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "This work is dedicated to the public domain under CC0."),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
    "proprietary": ("All rights reserved.", "Copyright 2020 Example Company. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the copyright holder.", "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential."),
}
#: Sentences that speak of licences and rights without granting any.
OTHER = (
    "A driving licence is required for the post.", "The restaurant lost its licence to sell alcohol.", "She is a licensed physician.", "The lecture covers copyright law and its history.",
    "The court ruled on the copyright case.", "Please renew your fishing license before spring.", "The warranty covers parts and labour for two years.", "The city issued a permit and a license to the shop.",
    "A software license can be expensive.", "Which license should I choose for my project?", "The minister spoke about public libraries.", "The foundation gave free software to schools.",
    "He asked for permission to use the hall.", "The general public was invited.", "Version 2.0 of the program was released.", "Redistribution of income was debated.", "Their licence number is printed on the van.",
    "Copyright infringement is a growing problem.", "The license expired last year.", "Students at MIT built a robot.", "An Apache helicopter landed at noon.", "The new version 3.0 of the software is faster.", "You may use the hall for free.", "All rooms are reserved for the guests.", "See the report for details.", "They reserved all rooms in the hotel.", "This work was done in the morning.",
)
#: Short names and identifiers of each licence family.
NAMES = {
    "apache": ("Apache License 2.0", "Apache-2.0", "Apache License", "Apache Software License", "Apache 2.0", "ASL 2.0"),
    "mit": ("MIT License", "MIT licence", "MIT/X11 license", "Expat license"),
    "bsd": ("BSD License", "BSD-3-Clause", "BSD-2-Clause", "BSD 3-Clause License", "new BSD license", "3-clause BSD"),
    "gpl": ("GPL", "GPLv3", "GPLv2", "GPLv2+", "GPLv3+", "GNU GPL", "GPL-2.0-only", "GPL-3.0-only", "GPL-3.0-or-later", "GNU General Public License"),
    "lgpl": ("LGPL", "LGPLv3", "LGPLv2.1", "GNU LGPL", "LGPL-2.1-or-later", "LGPL-3.0-only", "GNU Lesser General Public License"),
    "agpl": ("AGPL", "AGPLv3", "GNU AGPL", "AGPL-3.0-or-later", "GNU Affero General Public License"),
    "mpl": ("MPL", "MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License"),
    "isc": ("ISC License", "ISC-style license"),
    "cc-by": ("CC BY 4.0", "CC-BY-4.0", "CC BY 3.0", "CC-BY", "Creative Commons Attribution"),
    "cc-by-sa": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "CC-BY-SA", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "CC-BY-NC", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial"),
    "cc0": ("CC0", "CC0 1.0", "CC0-1.0", "CC0 public domain dedication"),
    "unlicense": ("Unlicense", "The Unlicense"),
}
#: Ways to name a licence, with which the classifier is taught.
FORMS = ("{}", "License: {}", "Licensed under the {}.", "Released under the {}.", "Distributed under the terms of the {}.", "This work is licensed under {}.", "SPDX-License-Identifier: {}", "See the {} for details.")
UNKNOWN = "unknown"
#: Paragraphs with one of these words may be notices and teach nothing of what is no licence. All paragraphs are scanned.
GATE = r"(?i)licen[cs]|copyright|spdx|creative commons|\bCC0\b|\bCC BY|public domain|rights reserved|redistribut|permission|unauthorized copying|\bGPL\b"
#: Paragraphs of the documents that teach what is no licence, at most about.
TRAIN_PARAGRAPHS = 1_000
#: Share of a template's word pairs that confirms it.
CONFIRMED = 0.6
#: Words of a window of a longer paragraph, and from one window to the next; every template fits into half a window.
WINDOW, STEP = 80, 40


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\d]+(?:[.\-][\p{L}\d]+)*"), F.lit(0))


def ngrams(tokens: Column, most: int = 3) -> Column:
    """The distinct 1- to ``most``-grams of an array of words."""
    def of(n: int) -> Column:
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(1, most + 1)])))


def pairs(tokens: Column) -> Column:
    """The distinct pairs of neighbouring words; of a single word itself."""
    starts = F.sequence(F.lit(1), F.size(tokens) - 1)
    two = F.when(F.size(tokens) > 1, F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, 2), " "))).otherwise(tokens)
    return F.array_distinct(two)


def parts(text: Column) -> Column:
    """The paragraphs of a text: what is between empty lines, or line ends after the end of a sentence."""
    return F.split(text, r"(?<=[.!?:])[ \t]*\r?\n|\n[ \t\r]*\n")


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (from 0), text: the paragraphs of each text."""
    return docs.filter("text IS NOT NULL").select("doc_id", F.posexplode(parts(F.col("text"))).alias("paragraph", "text"))


def notices() -> list[tuple[str, str]]:
    """(family, text): the templates, the two halves of longer ones, the names in every form, and sentences that are no notice."""
    out = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    for family, text in list(out):
        parts = text.split()
        if len(parts) >= 16:
            out += [(family, " ".join(parts[: len(parts) // 2])), (family, " ".join(parts[len(parts) // 2 :]))]
    out += [(family, form.format(name)) for family, names in NAMES.items() for name in names for form in FORMS]
    return out + [(UNKNOWN, text) for text in OTHER]


@dataclass
class Classifier:
    """A fitted classifier: the weights of each term for each class, their bases, the names of the classes, the temperature, and words of which every positive window has one."""

    weights: dict[str, list[float]]
    base: list[float]
    names: list[str]
    heat: float
    needed: list[str]


def needed_words(terms: list[str], weights: np.ndarray, base: np.ndarray, common: dict[str, int], templates: list[list[str]], confirmed: float) -> list[str]:
    """Words of which any window has at least one that the classifier can take for a family, or that holds ``confirmed`` of a template.

    A family f beats the last class, unknown, only if the terms of a window bring more than base[unknown] - base[f]. A
    term can be there only with all its words, so its gain is put down to its rarest word; the most common words, as
    many as cannot reach that margin together, are not needed. A word that is left over in every way is in no such window.
    """
    rare = lambda word: (-common.get(word, 0), word)
    needed: set[str] = set()
    for family in range(len(base) - 1):
        gain: Counter[str] = Counter()
        for term, x in zip(terms, weights[family] - weights[-1], strict=True):
            if x > 0:
                gain[max(term.split(" "), key=rare)] += float(x)
        left = float(base[-1] - base[family]) * 0.999
        for word in sorted(gain, key=rare):  # the most common first
            if gain[word] < left and word not in needed:
                left -= gain[word]
            else:
                needed.add(word)
    for wanted in templates:
        for word in sorted({w for pair in wanted for w in pair.split(" ")}, key=rare, reverse=True):
            bare = sum(not needed & set(pair.split(" ")) for pair in wanted)
            if bare < confirmed * len(wanted):
                break
            needed.add(word)
    return sorted(needed)


def learn(docs: DataFrame, bound: int = TRAIN_PARAGRAPHS, confirmed: float = CONFIRMED) -> Classifier:
    """Multinomial logistic regression on the n-grams of :func:`notices` and of about ``bound`` windows of the documents.

    Of as many documents, chosen by a hash of their texts, one window of one paragraph without a word of GATE is taken
    as no notice. The temperature is the one under which a third of the rows, left out of a first fit, are likeliest; it
    brings down the confidence of the final fit to what held-out rows bear out.
    """
    spark = docs.sparkSession
    names = [*TEMPLATES, UNKNOWN]
    label = F.element_at(F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(float(k)))]), F.col("family"))
    total = docs.count()
    chosen = docs.filter(unit(F.lit(3), F.xxhash64("text")) < F.lit(bound / max(1, total))).select(parts(F.col("text")).alias("ps"), F.abs(F.xxhash64("text") % 1_000_003).alias("h"))
    plain = chosen.select("h", F.element_at("ps", (F.col("h") % F.size("ps") + 1).cast("int")).alias("text")).filter(~F.col("text").rlike(GATE))
    several = windows(words(F.col("text")))
    plain = plain.select(F.lit(UNKNOWN).alias("family"), F.element_at(several, (F.col("h") % F.size(several) + 1).cast("int")).alias("tokens")).filter(F.size("tokens") > 0)
    given = spark.createDataFrame(notices(), "family string, text string").select("family", words(F.col("text")).alias("tokens"))
    rows = cut(given.withColumn("given", F.lit(True)).unionByName(plain.withColumn("given", F.lit(False))).select(label.alias("label"), "given", "tokens", ngrams(F.col("tokens")).alias("terms"), F.pmod(F.xxhash64("tokens"), F.lit(3)).alias("fold")))
    own = rows.filter("given").select(F.explode("terms").alias("term"), "label").distinct().groupBy("term").agg(F.collect_set("label").alias("of"))
    had = {r.term: {int(x) for x in r.of} for r in own.collect()}  # of the fixed notices
    vocabulary = sorted(had)
    common = {r.word: r.n for r in rows.filter("NOT given").select(F.explode(F.array_distinct("tokens")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").collect()}  # of a bounded sample
    terms = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features", binary=True)
    ready = cut(terms.transform(rows).select("label", "fold", "features")).coalesce(1)  # a bounded sample: one task is enough
    regression = LogisticRegression(family="multinomial", regParam=0.0002, maxIter=40)
    first = regression.fit(ready.filter("fold <> 0"))
    tested = first.transform(ready.filter("fold = 0")).select("label", vector_to_array("rawPrediction").alias("raw"))
    tested = tested.filter(F.col("label") < F.size("raw"))
    losses = []
    for t in (0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0):
        sums = F.log(F.aggregate(F.transform("raw", lambda x: F.exp(x / t)), F.lit(0.0), lambda a, x: a + x))  # noqa: B023
        losses.append((F.avg(sums - F.element_at("raw", (F.col("label") + 1).cast("int")) / t), t))
    found_losses = tested.agg(*[x.alias(str(k)) for k, (x, _) in enumerate(losses)]).first()
    best = min(((loss if loss is not None else 9.0, t) for loss, (_, t) in zip(found_losses, losses, strict=True)), key=lambda x: x[0])[1]
    model = regression.fit(ready)
    weights, base = model.coefficientMatrix.toArray().copy(), model.interceptVector.toArray()
    for k, term in enumerate(vocabulary):  # a term speaks for a family only if one of its notices has it
        for family in range(len(names) - 1):
            if family not in had[term]:
                weights[family, k] = min(weights[family, k], weights[-1, k])
    wanted = [list(r[0]) for r in template_pairs(spark).collect()]
    needed = needed_words(vocabulary, weights, base, common, wanted, confirmed)
    return Classifier(dict(zip(vocabulary, weights.T.tolist(), strict=True)), base.tolist(), names, best, needed)


def template_pairs(spark: SparkSession) -> DataFrame:
    """wanted, template, notice: the distinct word pairs of each template, its family and its number."""
    rows = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
    made = spark.createDataFrame([(name, k, text) for k, (name, text) in enumerate(rows)], "template string, notice int, text string")
    return made.select(pairs(words(F.col("text"))).alias("wanted"), "template", "notice")


def windows(tokens: Column) -> Column:
    """Overlapping windows of a paragraph's words; a paragraph of WINDOW words or fewer is one."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - WINDOW, F.lit(0)) + STEP, F.lit(STEP))
    several = F.transform(starts, lambda i: F.slice(tokens, i, WINDOW))
    return F.when(F.size(tokens) <= WINDOW, F.array(tokens)).otherwise(several)


def scan(docs: DataFrame, bound: int = TRAIN_PARAGRAPHS, least: float = 0.5, confirmed: float = CONFIRMED, made: Classifier | None = None) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity, confirmed, text: paragraphs that are taken for a licence notice.

    similarity is the largest share of the word pairs of one of the family's templates that a window of the paragraph has.
    Rows are those with a window whose likeliest class is a family with probability ``least`` or more, or that holds
    ``confirmed`` of a template of any family: the family is that of the template then, unless a template of the
    likeliest family is confirmed too. Of several windows the confirmed one, then the most probable one tells.

    Every paragraph is judged. Texts and windows without any of the classifier's needed words cannot be positive (see
    :func:`needed_words`) and are left out first; this changes no result. Null and empty texts have no paragraphs;
    repeated rows are repeated, null doc_ids stay, no rows give no rows. The vocabulary and the templates are fixed in size.
    """
    made = made or learn(docs, bound, confirmed)
    needed = F.array(*[F.lit(x) for x in made.needed])
    hopeful = docs.select("doc_id", "text").filter(F.arrays_overlap(words(F.col("text")), needed))
    paras = cut(paragraphs(hopeful).filter(F.arrays_overlap(words(F.col("text")), needed))).withColumn("row", F.monotonically_increasing_id())
    rows = paras.select("row", F.posexplode(windows(words(F.col("text")))).alias("window", "tokens")).filter(F.arrays_overlap("tokens", needed))
    spark = docs.sparkSession
    weights = spark.createDataFrame(list(made.weights.items()), "term string, weight array<double>")  # the fixed vocabulary
    terms = rows.select("row", "window", F.explode(ngrams(F.col("tokens"))).alias("term")).join(F.broadcast(weights), "term", "left")
    sums = [(F.coalesce(F.sum(F.element_at("weight", k + 1)), F.lit(0.0)) + x).alias(f"raw{k}") for k, x in enumerate(made.base)]
    summed = terms.groupBy("row", "window").agg(*sums).select("row", "window", F.array(*[f"raw{k}" for k in range(len(made.base))]).alias("raw"))
    rows = rows.join(summed, ["row", "window"])
    top = F.array_max("raw")
    rows = rows.withColumn("odds", F.transform("raw", lambda x: F.exp((x - top) / made.heat)))
    rows = rows.withColumn("share", F.transform("odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda a, y: a + y)))
    likeliest = F.array_position("share", F.array_max("share")).cast("int")
    called = F.element_at(F.array(*[F.lit(n) for n in made.names]), likeliest)
    templates = template_pairs(spark)
    known = F.array(*[F.lit(x) for x in sorted({x for r in templates.collect() for x in r[0]})])  # of the fixed templates
    scored = rows.select("row", "window", "share", called.alias("called"), F.array_intersect(pairs(F.col("tokens")), known).alias("own"))
    said = (F.col("called") != UNKNOWN) & (F.array_max("share") >= least)
    scored = cut(scored.withColumn("said", said).filter("said OR size(own) > 0"))
    size = F.size("wanted").alias("size")
    wanted = templates.select(F.explode("wanted").alias("pair"), "template", "notice", size)
    held = scored.select("row", "window", F.explode("own").alias("pair")).join(F.broadcast(wanted), "pair")
    held = held.groupBy("row", "window", "template", "notice").agg((F.count(F.lit(1)) / F.first("size")).alias("similarity"))
    held = held.groupBy("row", "window", "template").agg(F.max("similarity").alias("similarity"))
    spoken = scored.filter("said").select("row", "window", F.col("called").alias("template"), F.lit(0.0).alias("similarity"))
    near = held.union(spoken).groupBy("row", "window", "template").agg(F.max("similarity").alias("similarity"))
    near = near.join(scored.select("row", "window", "share", "called", "said"), ["row", "window"])
    near = near.filter((F.col("similarity") >= confirmed) | (F.col("said") & (F.col("template") == F.col("called"))))
    places = F.create_map(*[x for k, n in enumerate(made.names) for x in (F.lit(n), F.lit(k + 1))])
    found = F.struct(
        (F.col("similarity") >= confirmed).alias("confirmed"), (F.col("template") == F.col("called")).alias("agreed"),
        F.element_at("share", F.element_at(places, F.col("template"))).alias("probability"), "similarity", F.col("template").alias("family"),
    )
    best = near.groupBy("row").agg(F.max(found).alias("x"))
    return paras.join(best, "row").select("doc_id", "paragraph", "x.family", "x.probability", "x.similarity", "x.confirmed", "text")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"), F.round("similarity", 6).alias("similarity"), "confirmed")
