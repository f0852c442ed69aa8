"""License notices in texts: Dice coefficient of word bigrams against templates.

Lines, paragraphs and whole texts are the units. A unit of b distinct bigrams can only
reach a Dice coefficient of t with a template of n if b lies between n*t/(2-t) and
n*(2-t)/t; and it must share at least t/(2-t)*n of the template's bigrams, so it holds
one of any n - ceil(t/(2-t)*n) + 1 of them. Both bounds leave few candidates, and drop
none that could match. Everything runs as built-in expressions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import column

THRESHOLD = 0.8

# Short wordings of common license notices.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction,",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
# End of fixed values.

_UNIT_KINDS = (("line", r"\n"), ("paragraph", r"\n\s*\n"), ("text", None))


def template_bigrams(wording: str) -> list[str]:
    """Distinct word bigrams of a template, normalised as units are."""
    words = re.sub(r"[^\w]+|_", " ", wording.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _words(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def _signs(templates: list[list[str]], threshold: float) -> list[str]:
    """For each template enough bigrams that no match can do without all of them; shared ones last."""
    spread = {}
    for bigrams in templates:
        for pair in bigrams:
            spread[pair] = spread.get(pair, 0) + 1
    signs = set()
    for bigrams in templates:
        needed = math.ceil(round(threshold / (2 - threshold) * len(bigrams), 9))
        ranked = sorted(bigrams, key=lambda pair: (spread[pair], -len(pair), pair))
        signs.update(ranked[: len(bigrams) - needed + 1])
    return sorted(signs)


def scan_licenses(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, license, dice, n_units): the licenses whose notices a document holds.

    ``dice`` is the best coefficient of any unit, ``n_units`` the number of units whose
    best license it is. A unit counts for the template with the highest coefficient, of
    equal ones for the license first in order. A one-line document is a line, a paragraph
    and a text with the same words; it counts as one unit.

    Null, empty and one-word texts hold no license. Rows with equal ids are taken
    together; a null id is an id of its own. Documents without a license give no row, nor
    does an empty table. Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    known = [(name, template_bigrams(wording)) for name, wordings in sorted(templates.items()) for wording in wordings]
    known = [(name, bigrams) for name, bigrams in known if bigrams]
    low = min((math.ceil(len(b) * threshold / (2 - threshold) - 1e-9) for _, b in known), default=1)
    high = max((math.floor(len(b) * (2 - threshold) / threshold + 1e-9) for _, b in known), default=0)
    value = column(text)
    cut = [F.split(value, pattern) if pattern else F.array(value) for _, pattern in _UNIT_KINDS]
    # A unit's characters bound its words from above: units too short for any template go before they are split.
    units = F.filter(F.array_distinct(F.flatten(F.array(*cut))), lambda unit: F.length(unit) >= 2 * low + 1)
    worded = docs.where(value.isNotNull()).select(
        column(doc_id).alias("doc_id"), F.explode(F.transform(units, _words)).alias("words")
    )
    # Repeated words make fewer distinct bigrams, so only the lower bound holds for words.
    sized = worded.where(F.size("words") > low).select("doc_id", _bigrams(F.col("words")).alias("bigrams"))
    signs = F.array(*[F.lit(pair) for pair in _signs([b for _, b in known], threshold)])
    candidates = sized.where(F.size("bigrams").between(low, high) & F.arrays_overlap("bigrams", signs)).distinct()

    def against(name: str, bigrams: list[str]) -> Column:
        other = F.array(*[F.lit(pair) for pair in bigrams])
        dice = 2 * F.size(F.array_intersect("bigrams", other)) / (F.size("bigrams") + F.lit(len(bigrams)))
        fits = F.size("bigrams").between(
            math.ceil(len(bigrams) * threshold / (2 - threshold) - 1e-9),
            math.floor(len(bigrams) * (2 - threshold) / threshold + 1e-9),
        )
        return F.when(fits, F.struct((-dice).alias("less"), F.lit(name).alias("license")))

    best = candidates.withColumn("best", F.array_min(F.array_compact(F.array(*[against(*one) for one in known]))))
    return best.where(-F.col("best.less") >= threshold).groupBy("doc_id", F.col("best.license").alias("license")).agg(
        F.max(-F.col("best.less")).alias("dice"), F.count(F.lit(1)).alias("n_units")
    )


def oracle(threshold: float = THRESHOLD) -> str:
    """The same scan as a full comparison in SQL."""
    rows = ", ".join(
        "('{}', [{}])".format(name, ", ".join("'" + pair.replace("'", "''") + "'" for pair in template_bigrams(wording)))
        for name, wordings in sorted(TEMPLATES.items()) for wording in wordings
    )
    return f"""
    WITH templates(license, other) AS (VALUES {rows}),
    units AS (
        SELECT DISTINCT doc_id, unnest(list_concat(
            string_split(text, chr(10)), string_split_regex(text, '\\n\\s*\\n'), [text])) AS unit
        FROM documents WHERE text IS NOT NULL),
    worded AS (
        SELECT doc_id, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS words FROM units),
    pairs AS (
        SELECT DISTINCT doc_id, list_sort(list_distinct(
            [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))])) AS bigrams
        FROM worded WHERE len(words) BETWEEN 2 AND 400),
    scored AS (
        SELECT doc_id, bigrams, license,
            2 * len(list_intersect(bigrams, other)) / (len(bigrams) + len(other))::DOUBLE AS dice
        FROM pairs, templates),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id, bigrams ORDER BY dice DESC, license) AS place FROM scored)
    SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units
    FROM best WHERE place = 1 AND dice >= {threshold} GROUP BY doc_id, license"""
