from __future__ import annotations

from runlens.llm import license_rules
from tests.llm import brute

SCHEMA = "doc_id long, text string"
GPL = [license_rules.SENTENCES[k] for k in ("S23", "S25", "S26")]


def result(df):
    return {r.doc_id: (r.n_sentences, r.n_known, r.n_unmatched, list(r.licenses)) for r in license_rules.recognise(df).collect()}


def test_rules_in_order_and_gaps(spark):
    rows = [
        (1, "Foo bar. Released under the MIT License.\nx"),
        (2, "\n".join(GPL)),
        (3, "\n".join([GPL[0], "something else", GPL[1]])),
        (4, 'LICENSED under the  Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.'),
        (5, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\nAll rights reserved."),
        (6, None),
        (7, ""),
        (8, "no licence here. " * 20_000 + "\nReleased under the MIT License"),
    ]
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert got[1][1:] == (1, 0, ["MIT"])
    assert got[2][1:] == (3, 0, ["GPL-3.0-or-later"])
    assert got[3][1:] == (2, 1, ["GPL-3.0-or-later"])
    assert got[4][1:] == (2, 0, ["Apache-2.0"])
    assert got[5][1:] == (3, 1, ["CC-BY-NC-4.0"])
    assert got[6] == got[7] == (1, 0, 0, [])
    assert got[8][1:] == (1, 0, ["MIT"])


def test_brute_force_on_awkward_rows(spark):
    import re

    known = {license_rules.normal(s): k for k, s in license_rules.SENTENCES.items()}
    rows = brute.awkward_documents(7)
    names = list(license_rules.SENTENCES.values())
    rows += [(7000 + k, ".\n".join(names[k % len(names)] for k in range(k, k + 4))) for k in range(len(names))]
    want = {}
    for d, t in rows:
        parts = re.split(license_rules.BREAKS, t or "")
        ids = [known.get(license_rules.normal(p)) for p in parts]
        seq = "".join(license_rules.GAP if i is None else i for i in ids)
        hits = []
        for name, rule in license_rules.RULES:
            if "".join(rule) in seq:
                hits.append(name)
                seq = seq.replace("".join(rule), license_rules.GAP)
        want[d] = (len(parts), sum(i is not None for i in ids), seq.count("S"), list(dict.fromkeys(hits)))
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


def test_missing_ids_repeated_rows_and_extra_columns(spark):
    text = "Released under the MIT License"
    rows = [(1, text, "a"), (1, text, "a"), (None, text, "b"), (None, None, "c")]
    df = spark.createDataFrame(rows, SCHEMA + ", licenses string")
    assert sorted(len(r.licenses) for r in license_rules.recognise(df).collect()) == [0, 1, 1, 1]
    assert license_rules.recognise(df.filter("doc_id > 5")).count() == 0


GPL_NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MIT_TEXT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not
use this file except in compliance with the License. You may obtain a copy of
the License at

    http://www.apache.org/licenses/LICENSE-2.0

"""


def commented(text, mark):
    return "".join(f"{mark} {line}\n" for line in text.splitlines())


def test_wrapped_notices(spark):
    bsd3 = BSD_TEXT + BSD_NAME
    notices = {
        "GPL-3.0-or-later": (3, [GPL_NOTICE]),
        "MIT": (2, [MIT_TEXT]),
        "BSD-2-Clause": (3, [BSD_TEXT]),
        "BSD-3-Clause": (4, [bsd3, bsd3.replace("1. ", "(a) ").replace("2. ", "(b) ").replace("3. ", "c) "), bsd3.replace("\n   ", " ")]),
        "Apache-2.0": (3, [APACHE]),
    }
    rows, want = [], {}
    for name, (n_known, texts) in notices.items():
        for text in texts:
            for t in (text, commented(text, "#"), commented(text, " *"), commented(text, "//"), text.replace("\n", "\r\n")):
                want[len(rows)] = (n_known, [name])
                rows.append((len(rows), "Some words before.\n" + t))
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert {k: (v[1], v[3]) for k, v in got.items()} == want


def test_no_licence_from_words_that_go_on(spark):
    rows = [
        (1, "This work is licensed under the GNU General Public License, version 2.1"),
        (2, "This work is licensed under the GNU General Public License, version 2, or any later version."),
        (3, "It is not released under the MIT License."),
        (4, "Licensed under the Apache License, Version 2.0\n(the License)."),
        (5, BSD_TEXT.replace("\n2. ", "\nOne more condition applies.\n2. ")),
    ]
    got = {k: v[3] for k, v in result(spark.createDataFrame(rows, SCHEMA)).items()}
    assert got == {1: [], 2: [], 3: [], 4: ["Apache-2.0"], 5: []}
