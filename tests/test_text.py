from __future__ import annotations

import re
from datetime import datetime
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import dates, text


def values(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def test_dictionary_is_whole():
    assert len(S.SOURCE_TO_TARGET) == 23 == len(set(S.TARGETS))
    assert S.SOURCE_TO_TARGET["DATA_ENTRY_DATE"] == "dateEntryDate"
    assert S.NORMALIZED.names == S.TARGETS


def test_strip_and_blank(spark):
    cases = ["  a b ", "\t\n", "", None, "\u3000x\x1c", "\xa0"]
    assert values(spark, text.strip, cases) == ["a b", "", "", None, "x", ""]
    assert values(spark, text.is_blank, cases) == [False, True, True, True, False, True]
    assert values(spark, text.blank_to_null, cases) == ["a b", None, None, None, "x", None]


def test_category(spark):
    cases = [
        "SubjectGrp_1.csv", "subject-GRP.csv", "subject_visit.csv", "SUBJECTVISITSUBJECTGRP", "subjectgroup.csv",
        "visitschedule.csv", "s_u_b_j_e_c_t_visit",
    ]
    want = ["subject_group", "subject_group", "subject_visit", "subject_group", "misc", "misc", "subject_visit"]
    assert values(spark, text.category, cases) == want


def brute_stem(label: str) -> str:
    name = PurePosixPath(label.strip()).name
    stem = PurePosixPath(name).stem if name else ""
    return (re.sub("[^A-Za-z0-9._-]+", "_", stem).strip("._-") or "part")[:200]


def test_safe_stem(spark):
    cases = [
        "a/b/x y.csv", "..", ".", "./", "/", "", ".bashrc", " /a/b.tar.gz/ ", "a//./", "___", ".csv", "a.", "..a",
        "é.csv", "a\nb.c\nsv", "x" * 250 + ".csv", "-_.a.-_.csv", "a/../b", "////", "a.b.", "a b.c d",
    ]
    assert values(spark, text.safe_stem, cases) == [brute_stem(c) for c in cases]


def test_numbered_stem_is_at_most_200(spark):
    df = spark.createDataFrame([("y" * 200, 0), ("y" * 200, 7), ("y" * 199, 1234), ("a", 5)], "b string, n int")
    got = [r[0] for r in df.select(text.numbered_stem(F.col("b"), F.col("n"))).collect()]
    assert got == ["y" * 200, "y" * 198 + "_7", "y" * 195 + "_1234", "a_5"]


def test_object_key(spark):
    df = spark.createDataFrame([("/in//", "a b.csv"), (" ", "x.csv")], "p string, l string")
    key = text.object_key(F.col("p"), F.lit("S"), F.lit("r"), F.col("l"))
    assert [r[0] for r in df.select(key).collect()] == ["in/S/normalized/r/a_b.parquet", "S/normalized/r/x.parquet"]


def test_delimiter(spark):
    cases = ["a|b|c,d", "a,b|c", "a|b\nx,y,z,w", "", "a,b\x0b|||", "x\u2028y||||", "|\r,,"]
    assert values(spark, text.delimiter, cases) == ["|", ",", "|", ",", ",", ",", "|"]


def test_na_tokens(spark):
    cases = ["NA", "na", "", "None", "none", " ", "0", None, "-1.#IND"]
    assert values(spark, text.na_to_null, cases) == [None, "na", None, None, "none", " ", "0", None, None]


def test_epoch(spark):
    cases = ["0", "1.5", "-1", "x", None, "1e300", "nan"]
    got = values(spark, lambda c: text.epoch_to_timestamp(c).cast("string"), cases)
    assert got == ["1970-01-01 00:00:00", "1970-01-01 00:00:01.5", "1969-12-31 23:59:59", None, None, None, None]


def test_settings(spark):
    assert values(spark, text.source_mode, [" api_first", "x", "", None, "API_ONLY"]) == [
        "API_FIRST", "SFTP_ONLY", "SFTP_ONLY", "SFTP_ONLY", "API_ONLY",
    ]
    assert values(spark, text.environment, ["Local_Localstack", None, "prod ", "other"]) == [
        "local-localstack", "local-compose", "prod", "local-compose",
    ]
    assert values(spark, text.depth, ["raw", " ", "Stage", "x"]) == ["RAW", "PUBLISH", "STAGE", "PUBLISH"]
    assert values(spark, text.runtime_mode, ["FULL", "localstack-full", None]) == [
        "localstack_full", "localstack_full", "compose",
    ]


def test_mode_precedence(spark):
    rows = [
        ("API_FIRST", "SFTP_ONLY", "API_ONLY"), (None, "SFTP_ONLY", "API_FIRST"), (None, "", "API_FIRST"),
        (None, None, " "), (None, None, None), (None, " ", "API_FIRST"),
    ]
    df = spark.createDataFrame(rows, "a string, c string, s string")
    got = [r[0] for r in df.select(text.resolve_mode(F.col("a"), F.col("c"), F.col("s"))).collect()]
    assert got == ["API_FIRST", "SFTP_ONLY", "API_FIRST", "API_ONLY", "API_ONLY", "SFTP_ONLY"]


def test_sponsor_and_endpoint(spark):
    assert values(spark, lambda c: text.sponsor(c, F.lit("t")), [" s ", " ", None]) == ["s", "t", "t"]
    assert values(spark, lambda c: text.endpoint(c, "h", ""), ["SFTP", "API"]) == ["h", None]


def test_argument_checks():
    assert text.check_study_id(" A1 ") == "A1"
    for bad in ["", " ", "a/b", "a\\b", "a..b"]:
        with pytest.raises(ValueError):
            text.check_study_id(bad)
    run = "6f1f6c3e-3f5b-4c1e-9d57-0a2c1f0b8a11"
    assert text.check_run_id(f" {run.upper()} ") == run
    with pytest.raises(ValueError):
        text.check_run_id("run")
    for bad in [0, 101]:
        with pytest.raises(ValueError):
            text.check_limit(bad)
    assert text.check_tenant("a_1") == "a_1"
    for bad in ["A", "1a", "", "a-b", "a" * 64]:
        with pytest.raises(ValueError):
            text.check_tenant(bad)


def test_hash(spark):
    import hashlib

    assert values(spark, text.sha256, ["é"]) == [hashlib.sha256("é".encode()).hexdigest()]


def test_typed_dates(spark):
    day, month = dates.DAY_FIRST_FORMS, dates.MONTH_FIRST_FORMS

    def typed(forms):
        return lambda c: dates.typed(c, forms).cast("timestamp_ntz")

    cases = ["03-Feb-2021 04:05:06 PM", "16/06/2025 06:40", "3-Aug-23", "14-OCT-2025", "11/10/2022 0:00", "x", None]
    assert values(spark, typed(day), cases) == [
        datetime(2021, 2, 3, 16, 5, 6), datetime(2025, 6, 16, 6, 40), datetime(2023, 8, 3),
        datetime(2025, 10, 14), None, None, None,
    ]
    assert values(spark, typed(month), ["11/10/2022 0:00", "08/03/2023 10:45:00 AM"]) == [
        datetime(2022, 11, 10), datetime(2023, 8, 3, 10, 45),
    ]
