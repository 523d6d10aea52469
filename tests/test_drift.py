"""Sources that differ from the event schema: inference, report and tolerant reading on hand-made lines."""

import json
import os

import pytest

from churnlens.schema import EVENT_SCHEMA
from churnlens.sources.drift import drift_report, inferred_fields, read_events_open, read_variants

LINES = [
    '{"userId": "7", "length": 12.5, "ts": 1, "status": 200}',
    '{"userId": 8, "length": "13", "ts": "2", "status": 200.0, "a.b": {"x": [1, null]}}',
    '{"userId": null, "length": 9, "ts": 12345678901234567890, "status": 200.5, "page": {"name": "Home"}}',
    '{"userId": true, "length": [1], "ts": "soon", "status": "404", "a.b": 3}',
    "{}", "", "   ", "[1, 2]", "3", '{"userId": "9"', '{"userId": "1", "userId": "2"}', "not json",
]


@pytest.fixture
def path(scratch):
    where = os.path.join(scratch, "lines.json")
    with open(where, "w") as f:
        f.write("\n".join(LINES))
    return where


def test_report(spark, path):
    got = {(r["field"], r["type"]): (r["expected"], r["n"], r["share"], r["status"], r["lost"])
           for r in drift_report(read_variants(spark, path)).collect()}
    objects = 5  # {} among them; a repeated key, arrays, numbers and broken lines are no objects
    fields = {f for f, _ in got}
    assert fields == set(EVENT_SCHEMA.names) | {"a.b"}
    for f in set(EVENT_SCHEMA.names) - {"userId", "length", "ts", "status", "page"}:
        assert got[f, "absent"][1:] == (objects, 1.0, "absent", 0)
    assert got["userId", "string"] == ("string", 1, 0.2, "ok", 0)
    assert got["userId", "integer"] == ("string", 1, 0.2, "conflict", 0)
    assert got["userId", "null"] == ("string", 1, 0.2, "null", 0)
    assert got["userId", "boolean"] == ("string", 1, 0.2, "conflict", 0)
    assert got["length", "integer"] == ("double", 1, 0.2, "ok", 0)
    assert got["length", "string"][3:] == ("conflict", 0) and got["length", "array"][3:] == ("conflict", 1)
    assert got["ts", "string"][1:] == (2, 0.4, "conflict", 1) and got["ts", "number"][3:] == ("conflict", 1)
    assert got["status", "number"][1:] == (2, 0.4, "conflict", 1)
    assert got["page", "object"][3:] == ("conflict", 1) and got["page", "absent"][1] == 4
    assert got["a.b", "object"][0] is None and got["a.b", "integer"][3] == "unknown"
    for f in fields - {"a.b"}:
        assert sum(v[1] for (g, _), v in got.items() if g == f) == objects


def test_inferred_fields_merge_types(spark, path):
    got = {r["field"]: (r["merged_type"], r["n"]) for r in inferred_fields(read_variants(spark, path)).collect()}
    assert got["userId"] == ("VARIANT", 4) and got["a.b"] == ("VARIANT", 2)
    assert got["status"][0] == "VARIANT" and got["page"] == ("OBJECT<name: STRING>", 1)


def test_tolerant_reading_keeps_everything(spark, path):
    rows = read_events_open(spark, path).selectExpr("*", "to_json(_extra) AS extra", "to_json(_lost) AS lost").collect()
    whole, bad = [r for r in rows if r["_malformed"] is None], [r["_malformed"] for r in rows if r["_malformed"]]
    assert sorted(bad) == sorted(["[1, 2]", "3", '{"userId": "9"', '{"userId": "1", "userId": "2"}', "not json"])
    assert [(r["userId"], r["length"], r["ts"], r["status"], r["page"]) for r in whole] == [
        ("7", 12.5, 1, 200, None), ("8", 13.0, 2, 200, None), (None, 9.0, None, None, None),
        ("true", None, None, 404, None), (None, None, None, None, None)]
    assert [json.loads(r["extra"]) if r["extra"] else None for r in whole] == [
        None, {"a.b": {"x": [1, None]}}, None, {"a.b": 3}, None]
    assert [json.loads(r["lost"]) if r["lost"] else None for r in whole] == [
        None, None, {"ts": 12345678901234567890, "status": 200.5, "page": {"name": "Home"}},
        {"length": [1], "ts": "soon"}, None]


def test_a_source_without_lines(spark, scratch):
    where = os.path.join(scratch, "none.json")
    open(where, "w").close()
    variants = read_variants(spark, where)
    assert drift_report(variants).count() == 0 and inferred_fields(variants).count() == 0
    assert read_events_open(spark, where).count() == 0


def test_no_python_and_one_scan(spark, path):
    plan = inferred_fields(read_variants(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Python" not in plan
