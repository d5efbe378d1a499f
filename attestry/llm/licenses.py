"""Licence notices in texts by Dice similarity with templates."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.text import ascii_lower

LEAST_DICE = 0.8

#: Wordings of common licence notices, as their licences recommend or as people write them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "public-domain": "This is free and unencumbered software released into the public domain.",
}

#: Runs of ASCII characters that are neither digits nor small letters separate words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_bigrams(text: str) -> list[tuple[str, str]]:
    """The distinct word bigrams of a template, in order."""
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    words = [word for word in re.split(BETWEEN_WORDS, lowered) if word]
    return list(dict.fromkeys(zip(words, words[1:])))


def size_bounds(size: int, least: float) -> tuple[float, float]:
    """Between which set sizes a Dice coefficient of ``least`` is possible at all."""
    return size * least / (2 - least), size * (2 - least) / least


def _segments(text: Column) -> Column:
    """Lines, and paragraphs of several lines, of a lower-cased text."""
    lines = F.split(text, "\n", -1)
    paragraphs = F.filter(F.split(text, r"\n[\x20\x09-\x0D]*\n", -1), lambda x: F.contains(x, F.lit("\n")))
    return F.concat(lines, paragraphs)


def _bigrams(segment: Column) -> Column:
    words = F.filter(F.split(segment, BETWEEN_WORDS, -1), lambda word: word != "")
    return F.transform(
        F.filter(F.array(words), lambda x: F.size(x) > 1),
        lambda x: F.array_distinct(
            F.zip_with(
                F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.xxhash64(a, b)
            )
        ),
    )


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """Licence notices of every row of ``docs`` (doc_id, text).

    Columns: doc_id, matches (array of segment, license, dice). Segments are the lines of the text,
    then its paragraphs (lines between blank ones) of at least two lines, counted from 0. Segments
    and templates are compared as sets of word bigrams, A-Z lower-cased, without punctuation; a
    template is only intersected with segments whose set size allows ``least``. A segment has its
    most similar template, the first name on a tie. Null, empty and one-word texts match nothing,
    templates of one word are never found. Everything happens in the row's own scan task, with
    whole texts of any length; other columns are not read.
    """
    sets = {name: template_bigrams(text) for name, text in sorted(templates.items())}
    sets = {name: pairs for name, pairs in sets.items() if pairs}
    if not sets:
        raise ValueError("no template has a word bigram")
    bounds = {name: size_bounds(len(pairs), least) for name, pairs in sets.items()}
    least_size = min(low for low, _ in bounds.values())
    most_size = max(high for _, high in bounds.values())

    def best(segment: Column) -> Column:
        grams = segment["grams"]
        size = F.size(grams)
        scored = []
        for place, (name, pairs) in enumerate(sets.items()):
            own = F.array(*[F.xxhash64(F.lit(a), F.lit(b)) for a, b in pairs])
            low, high = bounds[name]
            dice = F.lit(2.0) * F.size(F.array_intersect(grams, own)) / (size + len(pairs))
            scored.append(
                F.when(
                    (size >= low) & (size <= high),
                    F.struct(dice.alias("dice"), F.lit(-place).alias("place"), F.lit(name).alias("license")),
                )
            )
        return F.struct(segment["segment"].alias("segment"), F.array_max(F.array(*scored)).alias("best"))

    grams = F.transform(
        _segments(ascii_lower(F.coalesce(F.col("text"), F.lit("")))),
        lambda segment, i: F.struct(i.alias("segment"), F.get(_bigrams(segment), F.lit(0)).alias("grams")),
    )
    sized = F.filter(grams, lambda x: F.size(x["grams"]).between(least_size, most_size))
    found = F.filter(F.transform(sized, best), lambda x: F.coalesce(x["best"]["dice"] >= least, F.lit(False)))
    return docs.select(
        "doc_id",
        F.transform(
            found,
            lambda x: F.struct(
                x["segment"].alias("segment"), x["best"]["license"].alias("license"), x["best"]["dice"].alias("dice")
            ),
        ).alias("matches"),
    )


def oracle(least: float = LEAST_DICE) -> str:
    """The scan in DuckDB's SQL: every segment against every template, no pruning."""
    rows = ",\n  ".join("('%s', '%s')" % (name, text.replace("'", "''")) for name, text in sorted(TEMPLATES.items()))
    lowered = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"list_filter(regexp_split_to_array(%s, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    grams = "list_distinct(list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1]))"
    return f"""
WITH templates(license, body) AS (VALUES
  {rows}
), template_sets AS (
  SELECT license, {grams} AS grams FROM (SELECT license, {words % (lowered % 'body')} AS words FROM templates)
), lowered AS (
  SELECT doc_id, {lowered % "coalesce(text, '')"} AS text FROM documents
), segments AS (
  SELECT doc_id, unnest(list_concat(string_split(text, chr(10)),
    list_filter(regexp_split_to_array(text, '\\n[\\x20\\x09-\\x0D]*\\n'), lambda x: contains(x, chr(10))))) AS segment
  FROM lowered
), sets AS (
  SELECT doc_id, {grams} AS grams
  FROM (SELECT doc_id, row_number() OVER () AS segment, {words % 'segment'} AS words FROM segments) WHERE len(words) > 1
), scored AS (
  SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams)) AS dice,
         row_number() OVER (PARTITION BY s.doc_id, s.number ORDER BY
           2.0::DOUBLE * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams)) DESC, license) AS place
  FROM (SELECT *, row_number() OVER () AS number FROM sets) s, template_sets t
), found AS (SELECT * FROM scored WHERE place = 1 AND dice >= {least})
SELECT d.doc_id, count(f.license) AS n_matches,
       coalesce((SELECT string_agg(license, ',' ORDER BY license) FROM (SELECT DISTINCT license FROM found WHERE doc_id = d.doc_id)), '') AS licenses,
       max(f.dice) AS best_dice
FROM documents d LEFT JOIN found f USING (doc_id) GROUP BY d.doc_id
"""
