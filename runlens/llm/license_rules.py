"""Licence recognition by sentences and rules.

Texts are normalised (lower case, one blank for anything but letters and
digits) and known sentences in them get an identifier. A known sentence starts
at a sentence end, a line or an enumerator ("1.", "(a)"), and may be wrapped
over lines with indents or comment marks; it ends where a sentence or a line
does or where the next known sentence follows. Those of ``OPEN`` may go on: in
others, what follows can change the licence ("or any later version"). The
identifiers of neighbouring sentences form sequences (blank lines and
enumerators between them are nothing), and ordered rules consume them: an
earlier rule takes its sequence before a later, less specific one sees it. What
no rule takes is counted as unmatched. All happens inside the row.

The SQL twin knows a sentence only where it stands whole between two breaks, so
the two agree on notices of one line a sentence and differ on wrapped ones.

Defined cases: a missing or empty text has no sentences but counts as one;
``n_sentences`` counts the parts between breaks, so each line of a wrapped
sentence; repeated rules matches in one text count each; all rows stay; columns
named like an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import table, whole_text
from runlens.llm.registry import query

# Well-known sentences of licence notices, by identifier.
SENTENCES = {
    "S01": "Licensed under the Apache License, Version 2.0",
    "S02": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "S03": "you may not use this file except in compliance with the License",
    "S04": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "S05": 'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "S06": "See the License for the specific language governing permissions and limitations under the License",
    "S11": "Released under the MIT License",
    "S12": "Licensed under the MIT License",
    "S13": "The MIT License (MIT)",
    "S14": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "S15": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND',
    "S21": "This work is licensed under the GNU General Public License, version 3",
    "S22": "This work is licensed under the GNU General Public License, version 2",
    "S23": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "S24": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "S25": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "S26": "See the GNU General Public License for more details",
    "S31": "Licensed under CC BY 4.0",
    "S32": "Licensed under CC BY-SA 4.0",
    "S33": "Licensed under CC BY-NC 4.0",
    "S34": "Licensed under CC BY-ND 4.0",
    "S35": "Licensed under CC BY-NC-SA 4.0",
    "S36": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "S41": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "S42": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "S43": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "S44": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "S51": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "S61": "This is free and unencumbered software released into the public domain",
    "S71": "All rights reserved",
}

# Rules in the order in which they are tried.
RULES = (
    ("Apache-2.0", ("S02", "S03")),
    ("Apache-2.0", ("S02",)),
    ("Apache-2.0", ("S01",)),
    ("GPL-3.0-or-later", ("S23", "S25", "S26")),
    ("GPL-3.0-or-later", ("S23",)),
    ("GPL-2.0-or-later", ("S24", "S25", "S26")),
    ("GPL-2.0-or-later", ("S24",)),
    ("GPL-3.0-only", ("S21",)),
    ("GPL-2.0-only", ("S22",)),
    ("BSD-3-Clause", ("S41", "S42", "S43", "S44")),
    ("BSD-2-Clause", ("S41", "S42", "S43")),
    ("MIT", ("S13", "S14")),
    ("MIT", ("S14", "S15")),
    ("MIT", ("S13",)),
    ("MIT", ("S12",)),
    ("MIT", ("S11",)),
    ("CC-BY-NC-SA-4.0", ("S35",)),
    ("CC-BY-SA-4.0", ("S32",)),
    ("CC-BY-NC-4.0", ("S33",)),
    ("CC-BY-ND-4.0", ("S34",)),
    ("CC-BY-4.0", ("S31",)),
    ("CC-BY-4.0", ("S36",)),
    ("MPL-2.0", ("S51",)),
    ("Unlicense", ("S61",)),
)

# Fixed value: sentences known by how they begin.
OPEN = ("S15",)

BREAKS = r"[.!?]+[ \t\r\f]+|[ \t\r\f.!?;:]*\n"
GAP = "~"
ADDED = ("n_sentences", "n_known", "n_unmatched", "licenses")


def normal(sentence: str) -> str:
    kept = string.ascii_lowercase + string.digits
    return " ".join("".join(c if c in kept else " " for c in sentence.lower()).split())


# Marks are capitals, as normalised texts have none: END of a sentence, and where a known one starts and stops.
END, START, STOP = "X", "Y", "Z"
ENUMERATOR = r"(?:[0-9]{1,3}|[a-z]|[ivx]{1,4})"
ENDS = rf"[.!?]+[ \t\r\f\n]+|[)\]](?<=(?:^|\n)[^a-z0-9\n]{{0,20}}{ENUMERATOR}[)\]])[ \t]+"
BETWEEN = rf"^[ \n{END}]*(?:{ENUMERATOR}[ \n{END}]*)?$"


def known_pattern() -> str:
    """Known sentences, the longest first, over any number of lines."""
    words = {k: r"[ \n]+".join(normal(s).split()) for k, s in SENTENCES.items()}
    longest = sorted(words, key=lambda k: -len(words[k]))
    following = "|".join(words[k] for k in longest)
    stop = rf"(?= ?[\n{END}]| ?$|[ \n]+(?:{following})(?![a-z0-9]))"
    either = "|".join(words[k] + (r"(?![a-z0-9])" if k in OPEN else stop) for k in longest)
    return rf"(?:(?<![^\n{END}]) ?|\G )(?:{either})"


def normalised(text: Column) -> Column:
    """Letters, digits and single blanks, with line ends and sentence ends."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_replace(F.regexp_replace(lower, ENDS, END), rf"[^a-z0-9{END}\n]+", " ")


def sequence_of(text: Column) -> Column:
    """Identifiers of known sentences in order, with a gap wherever there is anything else between them."""
    sids = F.create_map(*[F.lit(x) for k, s in SENTENCES.items() for x in (normal(s), k)])
    marked = F.regexp_replace(normalised(text), known_pattern(), f"{START}$0{STOP}")
    part = lambda x, i: F.when(
        i % 2 == 1, sids[F.trim(F.regexp_replace(x, r"[ \n]+", " "))]
    ).otherwise(F.when(x.rlike(BETWEEN), F.lit("")).otherwise(F.lit(GAP)))
    return F.array_join(F.transform(F.split(marked, f"[{START}{STOP}]"), part), "")


def apply_rules(sequence: Column) -> tuple[Column, Column]:
    """(licences found, in order of rules; what is left of the sequence)."""
    found, left = [], sequence
    for name, ids in RULES:
        pattern = "".join(ids)
        found.append(F.when(F.contains(left, F.lit(pattern)), F.lit(name)))
        left = F.replace(left, F.lit(pattern), F.lit(GAP))
    return F.array_distinct(F.array_compact(F.array(*found))), left


def recognise(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_sentences, n_known, n_unmatched and licenses (array)."""
    docs = docs.select(*[c for c in docs.columns if c not in ADDED])
    licences, left = apply_rules(F.col("_seq"))
    count = lambda seq: (F.length(F.replace(seq, F.lit(GAP), F.lit(""))) / 3).cast("long")
    return (
        docs.select("*", F.size(F.split(whole_text(), BREAKS)).cast("long").alias("n_sentences"), sequence_of(whole_text()).alias("_seq"))
        .select("*", count(F.col("_seq")).alias("n_known"), count(left).alias("n_unmatched"), licences.alias("licenses"))
        .drop("_seq")
    )


def _sql() -> str:
    known = ", ".join(f"('{normal(s)}', '{k}')" for k, s in SENTENCES.items())
    lower = f"translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    steps, names, prior = [], [], "seq"
    for k, (name, ids) in enumerate(RULES):
        steps.append(f"replace({prior}, '{''.join(ids)}', '{GAP}') AS r{k}")
        names.append(f"CASE WHEN contains({prior}, '{''.join(ids)}') THEN '{name}' END")
        prior = f"r{k}"
    order = list(dict.fromkeys(name for name, _ in RULES))
    in_order = ", ".join(f"CASE WHEN list_contains(hits, '{n}') THEN '{n}' END" for n in order)
    return f"""
WITH known(sentence, sid) AS (VALUES {known}),
cut AS (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '{BREAKS}') AS parts FROM documents),
s AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS raw FROM cut),
f AS (SELECT doc_id, pos, sid, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before
      FROM s JOIN known ON trim(regexp_replace({lower}, '[^a-z0-9]+', ' ', 'g')) = sentence),
q AS (SELECT doc_id, count(*) AS n_known,
        string_agg(CASE WHEN before = pos - 1 THEN '' ELSE '{GAP}' END || sid, '' ORDER BY pos) AS seq FROM f GROUP BY 1),
m AS (SELECT doc_id, n_known, seq, {', '.join(steps)} FROM q),
h AS (SELECT doc_id, n_known, [{', '.join(names)}] AS hits, {prior} AS rest FROM m)
SELECT cut.doc_id, CAST(len(parts) AS BIGINT) AS n_sentences, CAST(coalesce(n_known, 0) AS BIGINT) AS n_known,
  CAST(coalesce(length(replace(rest, '{GAP}', '')) // 3, 0) AS BIGINT) AS n_unmatched,
  coalesce(array_to_string([{in_order}], ','), '') AS licenses
FROM cut LEFT JOIN h ON cut.doc_id = h.doc_id
"""


@query("op5_license_rules", _sql())
def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return recognise(docs).select(
        "doc_id", "n_sentences", "n_known", "n_unmatched", F.array_join("licenses", ",").alias("licenses")
    )
