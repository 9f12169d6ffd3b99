"""Licence scan: canonical forms, whole-text hits, SQL twin, edge rows."""

import os

import duckdb
import pytest

from freqscope.llm import licenses
from freqscope.llm.license_texts import DIGESTS, NOTICES, TEXTS

SF_SMALL = "/root/testdata/sf0.001"


def variants(text):
    yield text
    yield text.upper()
    yield "  " + text.replace("\n\n", "\n \n\t").replace(",", " ,") + "\n\n"
    yield "Copyright 2020 Some One\n(c) 2021 Another\nAll rights reserved.\n" + text
    yield text.replace("license", "licence").replace("License", "Licence").replace("sublicense", "sublicence")
    yield "/* " + text.replace("\n", "\n * ") + " */"


def test_equivalent_texts_are_found(spark):
    rows = [(k * 10 + j, v, name) for k, (name, t) in enumerate(TEXTS) for j, v in enumerate(variants(t))]
    df = spark.createDataFrame([(a, b, c) for a, b, c in rows], "doc_id long, text string, license string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(df).collect()}
    assert got == {a: c for a, _, c in rows}


def test_rewrapped_texts_are_found(spark):
    import textwrap
    wrap = lambda t, n: "\n".join("\n".join(textwrap.wrap(x, n, break_on_hyphens=False)) for x in t.split("\n"))
    rows = [(k * 100 + n, wrap(t, n), name) for k, (name, t) in enumerate(TEXTS) for n in range(45, 100)]
    rows = [(a, f"Copyright The Authors\n(c) Jane Doe\n{b}" if a % 2 else b, c) for a, b, c in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(df).collect()}
    assert got == {a: c for a, _, c in rows}


def test_long_licences_are_found(spark):
    folder = "/usr/share/common-licenses"
    name = lambda x: x if os.path.exists(f"{folder}/{x}") else x.removesuffix(".0")
    held = [(n, open(f"{folder}/{name(n)}").read()) for n, _ in DIGESTS if os.path.exists(f"{folder}/{name(n)}")]
    if not held:
        pytest.skip("no licence texts here")
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0"} <= {n for n, _ in held}
    forms = lambda t: (t, t.upper(), "Copyright 2020 Some One\n\n" + t, t.replace("\n", "\n * "))
    rows = [(k * 10 + j, f, n) for k, (n, t) in enumerate(held) for j, f in enumerate(forms(t))]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    assert {r["doc_id"]: r["license"] for r in licenses.scan(df).collect()} == {a: c for a, _, c in rows}
    assert len({d for _, d in DIGESTS} | {r["digest"] for r in licenses.known_digests(spark).collect()}) == len(DIGESTS) + len(TEXTS)


def test_changed_texts_are_not(spark):
    rows = [(k, t + " Except on Sundays.") for k, (_, t) in enumerate(TEXTS)] + [(99, "Permission is granted.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["license"] for r in licenses.scan(df).collect()} == {None}


def test_digests_are_distinct(spark):
    known = licenses.known_digests(spark).collect()
    assert len({r["digest"] for r in known}) == len({r["license"] for r in known}) == len(TEXTS)


def test_notices_and_edge_rows(spark, tmp_path):
    rows = [(1, "Some prose.\nreleased under the MIT Licence!\nMore."), (1, "Some prose.\nreleased under the MIT Licence!\nMore."),
            (2, None), (3, ""), (None, "\n".join(n for _, n in NOTICES)), (4, "licensed under the MIT License it is not"),
            (5, "word " * 60_000 + "\nLicensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, digest string, hits int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in licenses.op3_licenses(spark, str(tmp_path)).collect()]
    by = {r[0]: r for r in got}
    assert len(got) == len(rows) and by[1][3:] == ("MIT", 1) and by[4][3:] == ("", 0) and by[5][3:] == ("CC-BY-NC-4.0", 1)
    assert by[None][4] == len(NOTICES) and by[None][3] == ",".join(sorted({n for n, _ in NOTICES}))
    assert by[2][1] == by[3][1]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(licenses.OP3_SQL).fetchall(), key=str) == sorted(got, key=str)
    assert licenses.scan(df.limit(0)).count() == 0


def test_all_documents(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = [tuple(r) for r in licenses.op3_licenses(spark, SF_SMALL).collect()]
    assert sorted(con.execute(licenses.OP3_SQL).fetchall()) == sorted(got)


def test_plan_is_native(spark):
    plan = licenses.op3_licenses(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "hashpartitioning(doc_id" not in plan
