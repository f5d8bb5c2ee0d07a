from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.operators import arms

CONFIG = (
    "studyId string, armResolutionMode string, edcArmColumn string, impalaArmColumn string, strataToArmMapping string"
)
CONFIGS = [
    ("F", "FLAT_RATE", None, None, None),
    ("E", "EDC_ONLY", " strata ", None, None),
    ("E2", "EDC_ONLY", "nothing", None, None),
    ("G", "IMPALA_GROUP_MAP_TO_ARM", None, None, '{"1":"one"}'),
    ("G2", "IMPALA_GROUP_MAP_TO_ARM", None, "cohort", '{"c":"see"}'),
    ("M", "MANUAL_MAPPING", None, None, None),
    ("C", "IMPALA_BUDGET_ARM_FROM_COLUMN", None, "cohort", None),
    ("H", "HYBRID", None, None, None),
    ("X", "OTHER", None, None, None),
]
STUDIES = [c[0] for c in CONFIGS]


def test_modes(spark):
    visits = spark.createDataFrame([(s, n, f"own {n}") for s in STUDIES for n in ("a", "b")], "studyId string, subjectId string, strata string")
    groups = spark.createDataFrame(
        [r for s in STUDIES for r in [(s, "a", "c", "1", 1), (s, "a", "late", "late", 2), (s, "b", "", "2", 1)]],
        "studyId string, subjectId string, cohort string, strata string, ordinal int",
    )
    manual = spark.createDataFrame(
        [r for s in STUDIES for r in [(s, "b", "hand", 1)]], "studyId string, subjectId string, subject_group string, ordinal int"
    )
    rows = visits.join(arms.arm_config(spark.createDataFrame(CONFIGS, CONFIG)), "studyId")
    rows = arms.attach_groups(rows, groups, order="ordinal")
    rows = arms.attach_manual(rows, manual, order="ordinal")
    got = {(r.studyId, r.subjectId): r.arm for r in arms.resolve_arm(rows, flat_arm="flat").collect()}
    assert len(got) == 2 * len(STUDIES)
    assert {s: (got[s, "a"], got[s, "b"]) for s in STUDIES} == {
        "F": ("flat", "flat"), "E": ("own a", "own b"), "E2": (None, None), "G": ("one", None), "G2": ("see", None),
        "M": (None, "hand"), "C": ("c", None), "H": ("1", "hand"), "X": (None, None),
    }


def registry(spark, *rows):
    return spark.createDataFrame(list(rows), "studyId string, siteId string, subjectId string, assignedBudgetArm string, isActive boolean")


def test_first_arm_stays(spark):
    rows = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "y"), (3, "a", "x"), (4, "b", None), (5, "b", "z"), (6, "c", "q"), (7, "d", None)],
        "n int, subjectId string, arm string",
    ).select("n", F.lit("S").alias("studyId"), F.lit("1").alias("siteId"), "subjectId", "arm")
    known = registry(spark, ("S", "1", "c", "p", True), ("S", "1", "a", "gone", False), ("S", "1", "e", "r", True))
    kept = arms.known_arms(rows, known, order="n")
    got = arms.check_registry(rows, kept, row_id=["n"]).orderBy("n").collect()
    assert [(r.registered_arm, r.arm_changed) for r in got] == [
        ("x", False), ("x", True), ("x", False), ("z", False), ("z", False), ("p", True), (None, False),
    ]
    new = arms.new_subjects(kept, "run", F.current_timestamp(), "me")
    assert {(r.subjectId, r.assignedBudgetArm, r.firstSeenRunId) for r in new.collect()} == {("a", "x", "run"), ("b", "z", "run")}
    assert set(new.columns) == set(S.SUBJECT_REGISTRY.names) - {"id"}


def test_schedule(spark):
    visits = spark.createDataFrame([(1, "S", 1, "F", "P"), (2, "S", 2, "F", "P"), (3, "S", 1, None, "P")], "n int, studyId string, visitNumber int, formName string, procedureName string")
    schedule = spark.createDataFrame(
        [("S", 1, "F", "P", 1), ("S", 1, "F", "P", 0), ("S", 3, "F", "P", 1)],
        "studyId string, visitNumber int, formName string, procedureName string, optionalVisitFlag int",
    )
    got = arms.join_schedule(visits, schedule).orderBy("n").collect()
    assert [(r.optionalVisitFlag, r.in_schedule) for r in got] == [(0, True), (None, False), (None, False)]


@pytest.mark.parametrize(
    ("mode", "want"), [("PER_TIMEPOINT", [1, 2, 3, 4, 5]), ("IGNORE", [1, 4, 5]), ("LUMP_SUM", [1, 4])]
)
def test_pay_modes(spark, mode, want):
    rows = spark.createDataFrame(
        [(2, "a", "1"), (1, "a", None), (3, "a", "2"), (5, "b", ""), (4, "b", " ")], "n int, subjectId string, timePostDose string"
    ).select("n", F.lit("S").alias("studyId"), "subjectId", F.lit("1").alias("subjectVisitNumber"), F.lit("P").alias("procedureName"), "timePostDose")
    assert sorted(r.n for r in arms.apply_pay_mode(rows, mode, order="n").collect()) == want
    by_column = rows.withColumn("mode", F.lit(mode))
    assert sorted(r.n for r in arms.apply_pay_mode(by_column, F.col("mode"), order="n").collect()) == want


def test_unknown_pay_mode(spark):
    with pytest.raises(ValueError):
        arms.apply_pay_mode(spark.range(1), "ALL", order="id")
    none = spark.createDataFrame([(1, None)], "n int, timePostDose string").withColumn("mode", F.lit(None).cast("string"))
    assert arms.apply_pay_mode(none, F.col("mode"), order="n", key=["n"]).count() == 1


def test_contact_reason(spark):
    df = spark.createDataFrame([(True, " "), (True, "x"), (False, None), (None, None)], "h boolean, c string")
    got = [r[0] for r in df.select(arms.contact_reason(F.col("h"), F.col("c"))).collect()]
    assert got == ["visitContactMode is blank.", None, None, None]
