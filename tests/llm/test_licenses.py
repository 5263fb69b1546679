"""Canonical forms and lookups; the scan against its SQL twin."""

from candlelake.llm import licenses
from candlelake.llm.license_texts import LICENSES
from candlelake.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

SCHEMA = "doc_id long, text string, license string, digest int"


def test_scan(spark):
    mit = LICENSES[1][1]
    variants = [
        mit.upper(),
        "Copyright (c) 2020 A. Person\n\n" + mit,
        "/*\n * Copyright © 1999-2024 Some Body <x@y>\n * All rights reserved.\n */\n" + mit.replace(" ", "\n  "),
        mit.replace("sublicense", "sub-licence").replace('"', "“"),
    ]
    others = [mit + " And more.", mit[:-40], None, "", "just words", "Copyright 2020 me", "word " * 100_000, "licensed under cc by-nc 4.0"]
    rows = [(i, t, "x", 1) for i, t in enumerate(variants + others)] + [(None, mit, "x", 1), (1, mit, "x", 1)]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    found = [(r.doc_id, r.license) for r in got]
    assert sorted(found, key=str) == sorted(
        [(i, "MIT") for i in range(4)] + [(i, None) for i in range(4, 11)] + [(11, "CC-BY-NC-4.0"), (None, "MIT"), (1, "MIT")], key=str
    )
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_known_text_is_found(spark):
    docs = spark.createDataFrame([(i, t, "", 0) for i, (_, t) in enumerate(LICENSES)], SCHEMA)
    assert {r.doc_id: r.license for r in licenses.scan(docs).collect()} == {i: n for i, (n, _) in enumerate(LICENSES)}


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = QUERIES["op6_license_scan"](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLES["op6_license_scan"]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_full_texts_are_known():
    names = {name for name, text in LICENSES if len(text) > 1000}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= names


def test_planted_statements(spark):
    mit = LICENSES[1][1]
    rows = [
        (1, "Some prose.\nReleased under the MIT Licence!\nMore prose."),
        (2, "Some prose.\n\n" + mit.replace("and to permit", "and\nto permit") + "\nMore prose."),
        (3, "Prose that is not released under the MIT License."),
        (4, None),
        (5, ""),
        (6, "licensed under CC BY 4.0"),
    ]
    found = licenses.statements(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)).collect()
    got = {(r.doc_id, r.kind, r.number, r.license) for r in found}
    assert {(1, "line", 2, "MIT"), (6, "line", 1, "CC-BY-4.0")} <= got
    assert any(d == 2 and kind == "paragraph" and "MIT" in name.split(" or ") for d, kind, _, name in got)
    assert {d for d, *_ in got} == {1, 2, 6}
    assert licenses.statements(spark.createDataFrame([], SCHEMA)).count() == 0


AFFERO = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_planted_notices_and_edited_copies(spark):
    full = {name: text for name, text in LICENSES if len(text) > 5000}
    commented = "\n".join(f"# {line}" for line in AFFERO.splitlines())
    rows = [
        (1, "Prose before.\n\n" + AFFERO + "\n\nProse after."),
        (2, "def f():\n\n" + commented + "\n\npass"),
        (3, "This file is licensed under the Mozilla Public License 2.0"),
        (4, "spdx-license-identifier: AGPL-3.0-or-later"),
        (5, "x\n\nReleased under a Creative Commons BY-SA 4.0 licence.\n"),
        (6, "We were released under no licence at all. Distributed under pressure."),
        (7, AFFERO.replace("free", "costly")),
        (8, full["GPL-3.0"].replace("\n", "\r\n").upper()),
        (9, full["GPL-3.0"].replace("freedom", "liberty")),
    ]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    got = {}
    for r in licenses.statements(docs).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert {d: got.get(d) for d in range(1, 8)} == {
        1: {"AGPL-3.0"}, 2: {"AGPL-3.0"}, 3: {"MPL-2.0"}, 4: {"AGPL-3.0"}, 5: {"CC-BY-SA-4.0"}, 6: None, 7: None
    }
    # an edited copy is no known text as a whole, but most of its paragraphs are
    whole = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert whole == {**dict.fromkeys(range(1, 10)), 3: "MPL-2.0", 4: "AGPL-3.0", 8: "GPL-3.0"}
    assert any("GPL-3.0" in name for name in got[9])


def test_statements_equal_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = QUERIES["op6_license_statements"](spark, sf_dir)
    assert df.count() > 0
    assert differences(df, connect(sf_dir), ORACLES["op6_license_statements"]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
