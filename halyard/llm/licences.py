"""Licence recognition from sentences.

A text is normalised to words with one space between, so that line breaks, blank lines and comment
markers of a wrapped licence do not matter. Known licence sentences are found in it wherever
they stand, and the sequence of their identifiers is matched against ordered rules. A rule matches where its identifiers follow each other among the recognised sentences; sentences
that are no licence sentences may stand between. A rule that another matching rule contains is
not reported, so a full header is not also reported as its first line.

Everything happens inside the row: no shuffle, no join, no Python. The sentence table is a
parameter whose size bounds the work per sentence.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: licence sentences, normalised, and rules over their identifiers ----
SENTENCES = {
    "apache_2_short": "licensed under the apache license version 2 0",
    "apache_2_the_license": "licensed under the apache license version 2 0 the license",
    "apache_compliance": "you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "as_is_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "see_license": "see the license for the specific language governing permissions and limitations under the license",
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_disclaimer": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl_3_work": "this work is licensed under the gnu general public license version 3",
    "gpl_2_work": "this work is licensed under the gnu general public license version 2",
    "gpl_3_or_later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_2_or_later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc_by": "licensed under cc by 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0",
    "cc_by_nc": "licensed under cc by nc 4 0",
    "cc_by_nd": "licensed under cc by nd 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "all_rights_reserved": "all rights reserved",
}
RULES = (
    ("Apache-2.0", ("apache_2_short",)),
    ("Apache-2.0", ("apache_2_the_license", "apache_compliance")),
    ("Apache-2.0 header", ("apache_2_the_license", "apache_compliance", "apache_obtain", "as_is_basis", "see_license")),
    ("MIT", ("mit_released",)),
    ("MIT", ("mit_licensed",)),
    ("MIT text", ("mit_grant", "mit_notice", "mit_disclaimer")),
    ("MIT without disclaimer", ("mit_grant", "mit_notice")),
    ("GPL-3.0", ("gpl_3_work",)),
    ("GPL-2.0", ("gpl_2_work",)),
    ("GPL-3.0-or-later", ("gpl_3_or_later",)),
    ("GPL-3.0-or-later notice", ("gpl_3_or_later", "gpl_hope", "gpl_see")),
    ("GPL-2.0-or-later", ("gpl_2_or_later",)),
    ("GPL-2.0-or-later notice", ("gpl_2_or_later", "gpl_hope", "gpl_see")),
    ("BSD-2-Clause", ("bsd_redistribution",)),
    ("BSD-3-Clause", ("bsd_redistribution", "bsd_endorse")),
    ("CC-BY-4.0", ("cc_by",)),
    ("CC-BY-SA-4.0", ("cc_by_sa",)),
    ("CC-BY-NC-4.0", ("cc_by_nc",)),
    ("CC-BY-ND-4.0", ("cc_by_nd",)),
    ("CC0-1.0", ("cc0",)),
    ("Proprietary", ("all_rights_reserved",)),
)
# --- end of fixed values ----------------------------------------------------

#: Where the SQL ends a sentence: at .!?; before white space, or with its line.
BOUNDARY = r"[.!?;]+[\x20\x09-\x0D]+|[\x0A-\x0D]+"
NOT_WORD = "[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rules = Sequence[tuple[str, Sequence[str]]]


def check_rules(sentences: Mapping[str, str], rules: Rules) -> None:
    unknown = {i for _, ids in rules for i in ids} - set(sentences)
    if unknown:
        raise ValueError(f"rules name unknown sentences: {sorted(unknown)}")
    if any(not ids for _, ids in rules):
        raise ValueError("a rule needs a sentence")
    if any("," in i for i in sentences):
        raise ValueError("identifiers must not contain commas")


def pattern(identifiers: Sequence[str]) -> str:
    return "," + ",".join(identifiers) + ","


def contained_in(rules: Rules) -> dict[str, list[str]]:
    """Per rule pattern, the longer patterns that contain it."""
    patterns = [pattern(ids) for _, ids in rules]
    return {p: [q for q in patterns if p != q and p in q] for p in patterns}


def sentence_identifiers(text: Column, sentences: Mapping[str, str]) -> Column:
    """Identifiers of the known licence sentences of a text, in order, repeats included. Of
    sentences that start at one word the longest counts; the next is looked for after it."""
    if not sentences:
        return F.array().cast("array<string>")
    known = F.create_map(*[F.lit(x) for i, s in sentences.items() for x in (s, i)])
    longest_first = "|".join(sorted(set(sentences.values()), key=lambda s: (-len(s), s)))
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    normal = F.regexp_replace(lowered, NOT_WORD, " ")
    whole = F.lit(rf"\b(?:{longest_first})\b")
    return F.transform(F.regexp_extract_all(normal, whole, F.lit(0)), lambda s: F.element_at(known, s))


def scan_licences(
    docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Rules = RULES
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_sentences`` (licence sentences found),
    ``sentence_ids`` (comma-joined, in order), ``licences`` (names of the matching rules that
    no longer matching rule contains, in the order of the rules, each once, comma-joined).

    Null and empty texts have no sentences, so '' and ''. Repeated rows each give their row, a
    null doc_id stays null, an empty table gives no rows, and other columns are not read.
    """
    check_rules(sentences, rules)
    found = docs.select("doc_id", sentence_identifiers(F.col("text"), sentences).alias("__ids"))
    placed = found.withColumn(
        "__seq", F.concat(F.lit(","), F.array_join("__ids", ","), F.lit(","))
    )
    longer = contained_in(rules)

    def matches(p: str) -> Column:
        return F.contains(F.col("__seq"), F.lit(p))

    names = []
    for name, ids in rules:
        hit = matches(pattern(ids))
        for q in longer[pattern(ids)]:
            hit = hit & ~matches(q)
        names.append(F.when(hit, F.lit(name)))
    return placed.select(
        "doc_id",
        F.size("__ids").cast("long").alias("n_sentences"),
        F.array_join("__ids", ",").alias("sentence_ids"),
        F.when(F.size("__ids") == 0, F.lit(""))
        .otherwise(F.array_join(F.array_distinct(F.array_compact(F.array(*names))), ","))
        .alias("licences"),
    )
