"""Chat formatting and licence scans against their SQL, round trips and odd input."""

from pathlib import Path

import pytest
from oracle_compare import connect, differences
from pyspark.sql import functions as F
from surveyloom.llm import chat_format, license_scan

SF_DIR = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
TURNS = "conv_id long, turn long, role string, text string, n_turns int"


def test_round_trip_of_control_strings(spark):
    rows = [
        (1, 1, "us<|er\nx", "a<\\|b <| <\\\\| x<", 0), (1, 2, "assistant", "<|im_end|>\n", 0),
        (1, 3, None, None, 0), (2, 1, "assistant", "", 0), (None, None, "system", "s<", 0),
        (3, 2, "assistant", "<|lf|>", 0), (3, 1, "user", "long " * 30_000, 0),
        (3, 2, "assistant", "<|lf|>", 0),
    ]
    turns = spark.createDataFrame(rows, TURNS)
    out = chat_format.format_conversations(turns)
    back = out.select("conv_id", "valid", chat_format.read_turns(F.col("formatted")).alias("t"))
    found = {r.conv_id: [tuple(t) for t in r.t] for r in back.collect()}
    assert found[1] == [("us<|er\nx", rows[0][3]), ("assistant", "<|im_end|>\n"), ("", "")]
    assert found[None] == [("system", "s<")] and found[2] == [("assistant", "")]
    assert [t[1] for t in found[3]] == ["long " * 30_000, "<|lf|>", "<|lf|>"]


@pytest.mark.parametrize(
    ("roles", "valid"),
    [("user assistant", True), ("system user assistant user assistant", True), ("user", False),
     ("assistant", False), ("user user assistant", False), ("user assistant tool assistant", True),
     ("user assistant system user assistant", False)],
)
def test_order_of_turns(spark, roles, valid):
    rows = [(1, i, r, "x", 0) for i, r in enumerate(roles.split())]
    out = chat_format.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert out.valid is valid
    assert [s.text for s in out.segments if s.loss] == ["x"] * roles.split().count("assistant")


@given_tables
def test_chat_oracle(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    out = chat_format.conversation_digests(chat_format.with_specimen(turns))
    assert differences(out, connect(SF_DIR), chat_format.ORACLE) is None


@given_tables
def test_license_oracle(spark):
    out = license_scan.scan_licenses(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert differences(out, connect(SF_DIR), license_scan.oracle()) is None


def test_license_rules(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this\n"
           'software and associated documentation files (the "Software"), to deal in the Software\n'
           "without restriction, including without limitation the rights to use, copy, modify,\n"
           "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to\n"
           "permit persons to whom the Software is furnished to do so, subject to the following\n"
           "conditions:\n\nThe above copyright notice and this permission notice shall be included\n"
           "in all copies or substantial portions of the Software.\n")
    rows = [
        (1, "Text. Released under the MIT License."), (2, mit + "\nAll rights reserved."),
        (3, "no mark before\nLicensed under CC BY-NC 4.0.\nnor after"), (4, ""), (5, None),
        (6, "RELEASED UNDER   the mit license!"), (7, "not released under the MIT License"),
        (None, "All rights reserved."), (8, "All rights reserved. " * 5000),
    ]
    docs = spark.createDataFrame(
        [(*r, "x") for r in rows], "doc_id long, text string, license string"
    )
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert found[1].license == found[6].license == "MIT" and found[7].license is None
    assert found[2].sentence_ids == "mit_grant,mit_notice_kept,all_rights"
    assert (found[2].license, found[2].licenses) == ("MIT", "MIT,Proprietary")
    assert found[3].license == "CC-BY-NC-4.0" and found[None].license == "Proprietary"
    assert (found[4].n_sentences, found[5].n_sentences, found[8].n_sentences) == (0, 0, 5000)
    assert license_scan.scan_licenses(docs.where("false")).count() == 0


def test_no_python_in_the_plans(spark):
    turns = spark.createDataFrame([], TURNS)
    docs = spark.createDataFrame([], "doc_id long, text string")
    for frame in (chat_format.conversation_digests(turns), license_scan.scan_licenses(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE = """Copyright 2020 A. Person

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software"""
MIT = """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software."""
BSD = """Copyright (c) 2020 A. Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice"""


def test_standard_headers_plain_and_in_comments(spark):
    headers = {"MPL-2.0": (MPL, "mpl_header"), "Apache-2.0": (APACHE, "apache_header,apache_copy"),
               "MIT": (MIT, "mit_grant,mit_notice_kept"), "BSD": (BSD, "bsd_grant")}
    rows = []
    for name, (text, ids) in headers.items():
        for mark in ("", " * ", "# ", "// "):
            body = "\n".join((mark + line).rstrip() for line in text.split("\n"))
            rows.append((name, ids, f"/*\n{body}\n */\nint x = 1;"))
    docs = spark.createDataFrame(
        [(i, text) for i, (_, _, text) in enumerate(rows)], "doc_id long, text string"
    )
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    for i, (name, ids, text) in enumerate(rows):
        assert (found[i].license, found[i].sentence_ids) == (name, ids), text


def test_a_conversation_of_the_specimens_number_stays_apart(spark):
    rows = [(-1, 0, "user", "mine"), (-1, 1, "assistant", "yours"), (3, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat_format.conversation_digests(chat_format.with_specimen(turns)).collect()
    assert sorted((r.conv_id, r.n_turns) for r in found) == [(-1, 2), (-1, 2), (3, 1)]
    assert len({r.turns_sha256 for r in found}) == 3


BSD_TAIL = """
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
ENDORSE = """
3. Neither the name of the University nor the names of its contributors may be used to
   endorse or promote products derived from this software without specific prior
   written permission."""
RESERVED_BSD = BSD.replace("A. Person", "A. Person. All rights reserved.")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
HEADERS = {
    "BSD-2-Clause": RESERVED_BSD + BSD_TAIL, "BSD-3-Clause": RESERVED_BSD + BSD_TAIL + ENDORSE,
    "LGPL-2.1-or-later": LGPL,
    "AGPL-3.0-or-later": LGPL.replace("Lesser", "Affero").replace("; either\nversion 2.1", ", either\nversion 3"),
    "GPL-2.0-or-later": LGPL.replace("Lesser ", "").replace("2.1", "2"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or "
    "without fee is hereby granted, provided that the above\ncopyright notice and this permission notice "
    "appear in all copies.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or "
    "without fee is hereby granted.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms\nof the "
    "Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0/",
    "Zlib": "Permission is granted to anyone to use this software for any purpose,\nincluding commercial "
    "applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:",
    "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007",
    "MIT": "SPDX-License-Identifier: MIT", "MIT OR Apache-2.0": "SPDX-License-Identifier: MIT OR Apache-2.0",
    "Proprietary": "Copyright 2020. All rights reserved.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "OFL-1.1": "Licensed under the SIL Open Font License 1.1.",
}


def marked_headers():
    return [
        (name, "intro line\n\n" + "\n".join((mark + line).rstrip() for line in text.split("\n")) + "\n\nint x;")
        for name, text in HEADERS.items() for mark in ("", " * ", "# ", "// ")
    ]


def test_more_licences_plain_wrapped_and_in_comments(spark):
    rows = marked_headers()
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert [(rows[i][1], r.licenses) for i, r in found.items() if r.license != rows[i][0]] == []
    assert "Proprietary" not in found[0].licenses and found[0].licenses == "BSD-2-Clause"


def test_sql_knows_long_sentences_wherever_they_stand(spark):
    import duckdb
    from oracle_compare import differences

    texts = [t for _, t in marked_headers()]
    for header in (MPL, APACHE, MIT, BSD):
        texts += ["\n".join(mark + line for line in header.split("\n")) for mark in ("", " * ", "# ")]
    texts += ["word " + MIT.replace("\n", " ") + " and so on", MIT + " " + MIT, None, "", "All rights reserved. x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    assert differences(license_scan.scan_licenses(docs), connection, license_scan.oracle()) is None


def test_number_of_licences_and_notices():
    known = license_scan.known_sentences()
    licences = {name for name, _ in license_scan.RULES} | {n[3:] for n in known.values() if n[:3] == "is:"}
    assert len(licences) >= 60 and len(known) >= 200
