from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from visitmill.operators import mapping
from visitmill.sources import modes
from visitmill.sources import pages as P

ROW = [{"a": 1}]
KEYS = ["content", "data", "subjectVisits", "items", "records", "results"]
BODIES = [
    (ROW, 1),
    *[({key: ROW}, 1) for key in KEYS],
    *[({"_embedded": {key: ROW}}, 1) for key in ("subjectVisits", "content", "data")],
    *[({"page": {key: ROW}}, 1) for key in ("content", "data")],
    ({"content": "x", "data": ROW}, 1),
    ({"content": [], "data": ROW}, 0),
    ({"rows": ROW}, 0),
    ({"page": {"items": ROW}}, 0),
    ({"_embedded": ROW}, 0),
    ("text", 0),
    ({}, 0),
]


def parsed(spark, bodies, pull="p"):
    rows = [(pull, i + 1, b if isinstance(b, bytes) else json.dumps(b)) for i, b in enumerate(bodies)]
    rows = [(p, n, b.decode() if isinstance(b, bytes) else b) for p, n, b in rows]
    return P.parse_pages(spark.createDataFrame(rows, "pull string, page int, body string"))


def test_rows_of_all_envelopes(spark):
    got = parsed(spark, [b for b, _ in BODIES]).select("page", F.size("rows").alias("n")).orderBy("page").collect()
    assert [r.n for r in got] == [n for _, n in BODIES]


TWO = [{"a": 1}, {"a": 2}]
MORE = [
    ({"content": []}, False),
    ({"content": ROW}, False),
    ({"content": TWO}, True),
    ({"content": TWO, "last": True}, False),
    ({"content": TWO, "last": False, "totalPages": 1}, True),
    ({"content": TWO, "last": "true", "totalPages": 5}, False),
    ({"content": TWO, "totalPages": 99}, True),
    ({"content": TWO, "totalPages": "1"}, True),
    ({"content": TWO, "totalPages": 1.5}, True),
    ({"content": TWO, "totalPages": True}, False),
    ({"content": TWO, "page": {"totalPages": 3}}, False),
    ({"content": TWO, "totalPages": None, "page": {"totalPages": 50}}, True),
    (TWO, False),
]


def test_has_more(spark):
    got = parsed(spark, [b for b, _ in MORE])
    more = P.has_more(F.col("payload"), F.col("page"), F.size("rows"), F.lit(2))
    assert [r[0] for r in got.orderBy("page").select(more).collect()] == [m for _, m in MORE]


@pytest.mark.parametrize(
    ("bodies", "last", "problem"),
    [
        ([{"data": TWO}, {"data": ROW}, {"data": TWO}], 2, None),
        ([{"data": TWO}, {"data": TWO}], 2, "no last page"),
        ([{"data": TWO}, b"no json", {"data": ROW}], 3, "unreadable page"),
        ([{"data": ROW}, b"no json"], 1, None),
        ([b"no json"], 1, "unreadable page"),
        ([TWO, {"data": TWO}], 1, None),
    ],
)
def test_extent(spark, bodies, last, problem):
    index = P.index_pages(parsed(spark, bodies), ["pull"], page_size=2, columns=["a"])
    extent = P.pull_extent(index, ["pull"])
    failed = problem is not None
    assert tuple(extent.first()) == ("p", last, failed, problem)
    known = P.pull_columns(index, extent, ["pull"]).collect()
    assert len(known) == (not failed)
    if not failed:
        kept = P.pages_in_pull(parsed(spark, bodies), known and P.pull_columns(index, extent, ["pull"]), ["pull"])
        assert sorted(r.page for r in kept.collect()) == list(range(1, last + 1))
        assert known[0].present == ["a"]


def numbered(spark, numbers, last):
    mark = F.when(F.col("id") == last, ',"last":true}').otherwise("}")
    body = F.concat(F.lit('{"data":[{}]'), mark)
    listed = spark.createDataFrame([(n,) for n in numbers], "id long")
    return listed.select(F.lit("p").alias("pull"), F.col("id").alias("page"), body.alias("body"))


@pytest.mark.parametrize(
    ("numbers", "last", "problem", "kept"),
    [
        (range(1, 2104), 2103, None, 2103),
        (range(1, 2104), None, "no last page", 0),
        ([1, 2, 4], 4, "missing page", 0),
        ([2, 3], 3, "missing page", 0),
        ([1, 1, 2, 2, 5], 2, None, 4),
    ],
)
def test_pages_beyond_two_thousand_gaps_and_ends(spark, numbers, last, problem, kept):
    pages = numbered(spark, numbers, last)
    index = P.index_pages(P.parse_pages(pages), ["pull"], page_size=1)
    extent = P.pull_extent(index, ["pull"])
    assert extent.first().problem == problem
    assert P.pages_in_pull(pages, extent, ["pull"]).count() == kept


def test_field_names_that_look_like_types(spark):
    record = {"VOIDED": 1, "AVOID": None, "OBJECT<": {"VOID": 2, "a:b": [{"VOID": None}]}, "q`q": True}
    flat = P.typed_records(P.explode_rows(parsed(spark, [[record]])))
    assert sorted(flat.columns) == ["AVOID", "OBJECT<.VOID", "OBJECT<.a:b", "VOIDED", "q`q"]
    assert (flat.first()["VOIDED"], flat.first()["OBJECT<.VOID"]) == (1, 2)


def test_records(spark):
    records = [{"studyId": 1.5, "cohort": [1, {"x": None}], "strata": {"k": 1}}, {"studyId": None, "formName": True}]
    rows = P.explode_rows(parsed(spark, [records]))
    present = mapping.present_targets(rows, ["pull"])
    assert sorted(present.first().present) == ["cohort", "formName", "studyId"]
    flat = mapping.normalize_records(rows.join(present, "pull"), keep=["position"]).orderBy("position").collect()
    assert [r.studyId for r in flat] == ["1.5", None]
    assert [r.cohort for r in flat] == ['[1,{"x":null}]', None]
    assert [r.formName for r in flat] == [None, "true"]
    assert [r.strata for r in flat] == ["", ""]


def test_repeated_keys_take_the_last(spark):
    rows = P.explode_rows(parsed(spark, [b'[{"a":1,"a":2}]']))
    assert rows.select(P.record_value(F.col("record"), "a")).first()[0] == "2"


def test_flatten(spark):
    records = [{"id": 1, "p": {"q": {"r": "x"}, "s": 2}, "l": [1, 2]}, {"id": 2, "p": {"s": 3.5}}]
    flat = P.typed_records(P.explode_rows(parsed(spark, [records])))
    assert sorted(flat.columns) == ["id", "l", "p.q.r", "p.s"]
    got = {r["id"]: (r["p.q.r"], float(r["p.s"]), r["l"]) for r in flat.collect()}
    assert got == {1: ("x", 2.0, [1, 2]), 2: (None, 3.5, None)}


def test_source_modes(spark):
    modes_of = [("API_FIRST", True), ("API_FIRST", False), ("SFTP_ONLY", True), ("API_ONLY", True)]
    status = spark.createDataFrame([(f"s{i}", m, ok) for i, (m, ok) in enumerate(modes_of)], "study string, mode string, api_ok boolean")
    api = spark.createDataFrame([(f"s{i}", "api") for i in range(4)], "study string, row string")
    files = spark.createDataFrame(
        [(f"s{i}", c, c) for i in range(4) for c in ("subject_visit", "misc")], "study string, row string, category string"
    )
    got: dict[str, set] = {}
    for r in modes.compose(api, files, status, "study").collect():
        got.setdefault(r.study, set()).add(r.row)
    assert got == {
        "s0": {"api", "misc"}, "s1": {"subject_visit", "misc"}, "s2": {"subject_visit", "misc"}, "s3": {"api"},
    }
