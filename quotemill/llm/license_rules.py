"""Licences of texts by rules over known sentences.

Method. Known licence sentences are looked for in the normalised text, from one
break (a line's end or a mark) to another, whether or not lines are wrapped
inside them; the identifiers found, in order, are matched against
licence rules, each a sequence of identifiers that stand next to each other
among the known sentences. Rules are tried in order, and what a rule
matches is used up, so full texts go before short notices. All steps are
functions over the row's own arrays: there is no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences of licences and notices, normalised (lower case; letters and digits
# joined by single spaces), with their identifiers.
SENTENCES = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-you": "licensed under the apache license version 2 0 the license",
    "apache-may": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-asis": (
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "apache-see": (
        "see the license for the specific language governing permissions and limitations under the license"
    ),
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl3-or-later": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-see": "see the gnu general public license for more details",
    "mit-short": "released under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "mit-asis": (
        "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "reserved": "all rights reserved",
}

# Licence rules in the order in which they are tried.
RULES = (
    ("Apache-2.0", ("apache-you", "apache-may", "apache-copy", "apache-asis", "apache-see")),
    ("GPL-3.0-or-later", ("gpl3-or-later", "gpl-hope", "gpl-see")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("GPL-3.0-or-later", ("gpl3-or-later",)),
    ("Apache-2.0", ("apache-you",)),
    ("Apache-2.0", ("apache-short",)),
    ("GPL-3.0", ("gpl3-short",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("All-Rights-Reserved", ("reserved",)),
)


# Known sentences that the genuine notice sets as two paragraphs: the first word of the second one.
_PARAGRAPH = {"apache-copy": "http"}


def _pattern() -> str:
    """A known sentence from one break to another, longer ones first; | may stand between its words, ~ may not."""
    known = []
    for name, sentence in sorted(SENTENCES.items(), key=lambda x: -len(x[1])):
        first, *rest = sentence.split(" ")
        known.append(first + "".join(("[ |~]++" if _PARAGRAPH.get(name) == w else "[ |]++") + w for w in rest))
    return "(?<![a-z0-9])(?<![a-z0-9] )(" + "|".join(known) + ")(?! ?[a-z0-9])"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A known sentence begins and ends at a line's end, or at . ! ? : or ; before
    white space. Ends of lines and : or ; may also stand inside it, as notices
    are wrapped; blank lines and . ! ? may not, but where the genuine notice has one.
    """
    # ASCII lower case, so that lengths and matches do not depend on a locale. Then ~ is a break that
    # ends every sentence, and | one that may be a wrapped line's.
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ~|", "abcdefghijklmnopqrstuvwxyz  "
    plain = F.regexp_replace(F.translate(text, upper, lower), r"[.!?](?=[ \t\r\n])|\n(?=[^a-z0-9\n]*+\n)", "~")
    plain = F.regexp_replace(plain, r"[:;](?=[ \t\r\n])|\n", "|")
    plain = F.regexp_replace(plain, "[^a-z0-9~|]++", " ")
    known = F.create_map(*[F.lit(x) for name, words in SENTENCES.items() for x in (words, name)])
    found = F.regexp_extract_all(plain, F.lit(_pattern()), F.lit(1))
    return F.transform(found, lambda s: F.element_at(known, F.regexp_replace(s, "[^a-z0-9]+", " ")))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_known, licenses, n_unmatched) of every row.

    ``licenses`` joins the licences of the matching rules by "|", each once, in
    rule order; ``n_known`` counts known sentences and ``n_unmatched`` those that
    no rule used. A null or empty text has none, and an empty string as
    licences. Repeated rows and null ids are returned as they are; other
    columns are ignored.
    """
    ids = sentence_ids(F.coalesce(F.col(text_col), F.lit("")))
    found = docs.select(
        F.col(id_col), F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda x: F.concat(x, F.lit("|"))), "|")).alias("_left")
    )
    # Every identifier stands between bars of its own: "|a||b|".
    found = found.withColumns({"_n": F.regexp_count("_left", F.lit("[a-z0-9-]+")), "_got": F.array().cast("array<string>")})
    for name, sequence in RULES:
        pattern = F.lit("|" + "||".join(sequence) + "|")
        hit = F.contains(F.col("_left"), pattern)
        found = found.withColumns(
            {
                "_got": F.when(hit, F.array_append("_got", F.lit(name))).otherwise(F.col("_got")),
                "_left": F.replace(F.col("_left"), pattern, F.lit("|~|")),
            }
        )
    return found.select(
        id_col,
        F.col("_n").cast("long").alias("n_known"),
        F.array_join(F.array_distinct("_got"), "|").alias("licenses"),
        F.regexp_count("_left", F.lit("[a-z0-9-]+")).cast("long").alias("n_unmatched"),
    )


def oracle_sql() -> str:
    """`scan_licenses` of the table documents for DuckDB."""
    pairs = ", ".join(f"('{words}', '{name}')" for name, words in SENTENCES.items())
    sql = f"""
WITH known AS (SELECT map_from_entries(list((s, i))) AS m FROM (VALUES {pairs}) AS t(s, i)),
cut AS (
  SELECT doc_id, list_filter(list_transform(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.!?:;]+[ \\t\\r]+|[ \\t\\r]*\\n+'),
    lambda s: m[trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))]), lambda x: x IS NOT NULL) AS ids
  FROM documents, known),
s0 AS (SELECT doc_id, len(ids) AS n, [] :: VARCHAR[] AS got,
  '|' || array_to_string(list_transform(ids, lambda x: x || '|'), '|') AS rest FROM cut)"""
    for k, (name, sequence) in enumerate(RULES):
        pattern = "|" + "||".join(sequence) + "|"
        sql += f""",
s{k + 1} AS (SELECT doc_id, n, CASE WHEN contains(rest, '{pattern}') THEN list_append(got, '{name}') ELSE got END AS got,
  replace(rest, '{pattern}', '|~|') AS rest FROM s{k})"""
    last = f"s{len(RULES)}"
    order = ", ".join(f"'{name}'" for name in dict.fromkeys(name for name, _ in RULES))
    return sql + f"""
SELECT doc_id, n AS n_known, array_to_string(list_filter([{order}], lambda x: list_contains(got, x)), '|') AS licenses,
  len(regexp_extract_all(rest, '[a-z0-9-]+')) AS n_unmatched FROM {last}"""
