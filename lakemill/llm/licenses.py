"""Licence notices in texts, with DataFrame functions only.

Units of a text - its lines, and its blocks of several lines between blank ones - are normalised
to lower-case words and compared with templates by the Dice coefficient of their sets of word
bigrams. A unit of s bigrams and a template of m reach the coefficient t only if
t/(2-t) <= s/m <= (2-t)/t, so templates are met by an equal join on the admissible sizes.
The same bound names words of which a matching unit holds one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import text_of

THRESHOLD = 0.8

#: The wording of common licence notices.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions:",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
}


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def bigrams(words: Column) -> Column:
    last = F.size(words) - 2
    pairs = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)))
    return F.when(last >= 0, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def telling_words(patterns: list[list[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold for some pattern holds one.

    Such a unit shares at least t/(2-t) of the pattern's bigrams; words that touch more bigrams
    than may be missing cannot all be absent. Long words are taken first, as they are rare.
    """
    out: set[str] = set()
    for pattern in patterns:
        missing = len(pattern) * (1 - threshold / (2 - threshold))
        touched: set[str] = set()
        for word in sorted({w for p in pattern for w in p.split(" ")}, key=lambda w: (-len(w), w)):
            if len(touched) > missing + 1e-9:
                break
            out.add(word)
            touched |= {p for p in pattern if word in p.split(" ")}
    return sorted(out)


def template_patterns(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, pattern): the distinct bigrams of each template that has any."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    known = rows.select("license", normalised(F.col("text")).alias("words")).select("license", bigrams(F.col("words")).alias("pattern"))
    return known.where(F.size("pattern") > 0)


def find_notices(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """(id, kind, unit, license, similarity) of every unit and template at the threshold or above.

    `kind` is line or block, `unit` its number in the text from 0. A block of one line is only
    given as a line. Texts without any of the words that a match must hold are left out first. A null or empty text has no unit. Rows are independent: repeated rows and
    null ids are kept. Other columns are ignored. The templates are a parameter and travel with
    the job; their number is that of known licences, not of documents.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    known = template_patterns(docs.sparkSession, TEMPLATES if templates is None else templates)
    ratio = threshold / (2 - threshold)
    sizes = F.sequence(F.ceil(F.size("pattern") * ratio - 1e-9).cast("int"), F.floor(F.size("pattern") / ratio + 1e-9).cast("int"))
    index = known.select(F.explode(sizes).alias("size"), "license", "pattern")
    words = telling_words([r.pattern for r in known.collect()], threshold)  # a row a template
    # In a lambda, so that the lower-case text is made once for all words.
    told = F.exists(F.array(F.lower(text_of(text))), lambda t: reduce(Column.__or__, [t.contains(w) for w in words], F.lit(False)))
    body = F.regexp_replace(text_of(text), "\r\n?", "\n")
    units = F.concat(
        F.transform(F.split(body, "\n"), lambda u, i: F.struct(F.lit("line").alias("kind"), i.alias("unit"), u.alias("text"))),
        F.transform(F.split(body, r"\n[ \t]*\n\s*"), lambda u, i: F.struct(F.lit("block").alias("kind"), i.alias("unit"), u.alias("text"))),
    )
    parts = docs.where(told).select(F.col(f"`{id_col}`").alias("__id"), F.explode(units).alias("u")).where(
        (F.col("u.kind") == "line") | F.trim(F.col("u.text")).contains("\n")
    )
    # The words are a column of their own: within a lambda an expression would run for each element.
    worded = parts.select("__id", "u.kind", "u.unit", normalised(F.col("u.text")).alias("words"))
    sized = worded.select("__id", "kind", "unit", bigrams(F.col("words")).alias("found"))
    # Not nullable, so that the join adds no filter that would compute the bigrams twice.
    sized = sized.withColumn("size", F.coalesce(F.size("found"), F.lit(0)))
    met = sized.join(F.broadcast(index), "size")
    score = 2 * F.size(F.array_intersect("found", "pattern")) / (F.size("found") + F.size("pattern"))
    return met.select(F.col("__id").alias(id_col), "kind", "unit", "license", score.alias("similarity")).where(F.col("similarity") >= threshold)
