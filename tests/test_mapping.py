from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.operators import mapping
from visitmill.sources import landing, tables


def test_steps_follow_each_other():
    rules = {"SITE": "STUDY_SITE_NUMBER", "FORM": "FORM_NAME", "STUDY_ID": "cohort"}
    assert mapping.resolve_name(" site ", rules, S.SUBJECT_GROUP) == ("studySiteNumber", mapping.RULE)
    assert mapping.resolve_name("site", rules, S.MISC) == ("STUDY_SITE_NUMBER", mapping.RULE)
    assert mapping.resolve_name("form", rules, S.MISC) == ("formName", mapping.RULE)
    assert mapping.resolve_name("creation_ts", rules, S.SUBJECT_GROUP) == ("dateEntryDate", mapping.ALIAS)
    assert mapping.resolve_name("STUDY_ID", rules, S.MISC) == ("cohort", mapping.RULE)
    assert mapping.resolve_name("studyId", {}, S.MISC) == ("STUDYID", mapping.DIRECT)


def test_normalize(spark):
    df = spark.createDataFrame([(1, None, "x")], "subject_id int, ` Study_Site ` string, other string")
    row = mapping.normalize(df).first()
    assert row.asDict() == {**dict.fromkeys(S.TARGETS, ""), "subjectId": "1", "studySiteNumber": None}
    assert mapping.normalize(df).columns == S.TARGETS
    assert mapping.upper_names(df).columns == ["SUBJECT_ID", "STUDY_SITE", "OTHER"]


def test_two_columns_for_one_target(spark):
    df = spark.createDataFrame(
        [("alias", "direct", "rule"), ("alias", "direct", None), (None, "direct", None)],
        "STUDY_SITE_NUMBER string, STUDY_SITE string, SITE_ID string",
    )
    rules = {"SITE_ID": "studySiteNumber"}
    got = mapping.normalize(df, rules, category=S.SUBJECT_GROUP).select("studySiteNumber").collect()
    assert [r[0] for r in got] == ["rule", "alias", "direct"]


def test_active_rules(spark):
    rows = [
        (2, "misc", " a ", "x", True), (1, "misc", "A", "old", True), (3, "misc", "b", " ", True),
        (4, "misc", "", "y", True), (5, "misc", "c", "z", False), (6, "subject_visit", "a", "v", True),
    ]
    table = spark.createDataFrame(rows, "id int, type string, sourceColumn string, targetColumn string, isActive boolean")
    rules = mapping.collect_rules(table)
    assert rules == {"subject_visit": {"A": "v"}, "subject_group": {}, "misc": {"A": "x"}}
    assert {tuple(r) for r in mapping.rule_counts(table).collect()} == {("misc", 1), ("subject_visit", 1)}


def test_headers_as_a_join_agree_with_names(spark):
    names = [*S.SOURCE_TO_TARGET, *S.GROUP_ALIASES, " site ", "form", "x", "studyId"]
    table = spark.createDataFrame(
        [("misc", "SITE", "STUDY_SITE"), ("subject_group", "SITE", " sbj_coh_cohort_num "), ("misc", "FORM", "formName")],
        "category string, source string, target string",
    )
    headers = spark.createDataFrame([(c, n) for c in S.CATEGORIES for n in names], "category string, name string")
    rules = {c: {r.source: r.target for r in table.where(F.col("category") == c).collect()} for c in S.CATEGORIES}
    for row in mapping.resolve_headers(headers, table).collect():
        target, step = mapping.resolve_name(row.name, rules[row.category], row.category)
        want = (target, step) if target in S.TARGETS else (None, None)
        assert (row.target, row.step) == want, row


def test_header_names():
    assert landing.header_names("\ufeffA|B,c|\"x|y\"\r", "|") == ["A", "B,c", "x|y"]
    assert landing.header_names("A,A,B,A", ",") == ["A", "A.1", "B", "A.2"]


def test_view_of_an_unsaved_rule_is_an_error(spark):
    columns = "id int, type string, sourceColumn string, targetColumn string, description string, isActive boolean, " \
        "createdBy string, updatedBy string, createdAt timestamp, updatedAt timestamp"  # fmt: skip
    row = ("misc", "a", "b", None, True, None, None, None, None)
    good = mapping.mapping_view(spark.createDataFrame([(1, *row)], columns))
    assert good.first().category == "misc"
    with pytest.raises(Exception, match="must be saved"):
        mapping.mapping_view(spark.createDataFrame([(None, *row)], columns)).collect()


def test_lookups(spark):
    table = spark.createDataFrame([(3, "c", True), (2, "b", True), (1, "a", False)], "id int, studyId string, isActive boolean")
    assert tables.sponsor_row(table).first().studyId == "b"
    assert tables.study_row(table, "c").first().id == 3
    assert tables.study_row(table, "x").first() is None


def test_first_rows(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    got = mapping.first_rows(rows, ["g"], ["id"], 2).collect()
    assert sorted(tuple(r) for r in got) == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
