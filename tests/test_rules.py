from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.operators import eligibility as E
from visitmill.operators.eligibility import Rule
from visitmill.plans import validate
from visitmill.sinks.normalized import write_split

VALUES = ["5", "05", "x", "", " ", None, "10"]
# Operator, expected value, and whether each value passes.
CASES = [
    ("EQUALS", "5", [1, 0, 0, 0, 0, 0, 0]),
    ("NOT_EQUALS", "5", [0, 1, 1, 1, 1, 1, 1]),
    ("IN", " 5 ,x,", [1, 0, 1, 0, 0, 0, 0]),
    ("IN", None, [0, 0, 0, 0, 0, 0, 0]),
    ("NOT_IN", "5,x", [0, 1, 0, 1, 1, 1, 1]),
    ("GREATER_THAN", "5", [0, 0, 0, 0, 0, 0, 1]),
    ("GREATER_THAN", "x", [0, 0, 0, 0, 0, 0, 0]),
    ("LESS_THAN", "9.5", [1, 1, 0, 0, 0, 0, 0]),
    ("IS_NOT_NULL", None, [1, 1, 1, 0, 0, 0, 1]),
    ("IS_NULL", None, [0, 0, 0, 1, 1, 1, 0]),
]


def rows(spark):
    return spark.createDataFrame([(i, v, "S1") for i, v in enumerate(VALUES)], "i int, v string, studyId string")


@pytest.mark.parametrize(("operator", "expected", "want"), CASES)
def test_operators(spark, operator, expected, want):
    rule = Rule("R", "v", operator, expected, "no")
    got = rows(spark).select("i", E.passes(rule).alias("ok")).orderBy("i").collect()
    assert [int(r.ok) for r in got] == want


def test_scope_reasons_and_blocking(spark):
    rules = [
        Rule("B", "v", "IS_NOT_NULL", None, "blank", kind="BLOCKING"),
        Rule("A", "v", "EQUALS", "5", "not five"),
        Rule("C", "v", "EQUALS", "5", "other study", study_id="S2"),
        Rule("D", "v", "NOT_EQUALS", "x", "is x", study_id="S1"),
    ]
    got = E.evaluate(rows(spark), rules).orderBy("i").collect()
    assert [r.reasons for r in got] == [
        [], ["not five"], ["not five", "is x"], *[["not five", "blank"]] * 3, ["not five"],
    ]
    assert [r.blocking for r in got] == [False, False, False, True, True, True, False]
    assert E.evaluate(rows(spark), []).where("size(reasons) > 0 OR blocking").isEmpty()


def test_bad_rules(spark):
    with pytest.raises(ValueError, match="unknown column"):
        E.evaluate(rows(spark), [Rule("A", "w", "IS_NULL", None, "r")])
    with pytest.raises(ValueError):
        Rule("A", "v", "LIKE", None, "r")


def rule_table(spark, *rules):
    return spark.createDataFrame(
        rules,
        "ruleId string, studyId string, columnName string, operator string, expectedValue string, "
        "rejectionReason string, ruleKind string, isActive boolean",
    )


def test_rules_as_data_agree_with_expressions(spark):
    made = [Rule(f"R{i:02}", "v", o, e, f"r{i}", [None, "S1", "S2"][i % 3], ["BLOCKING", "NON_BLOCKING"][i % 2]) for i, (o, e, _) in enumerate(CASES)]
    table = rule_table(spark, *[(r.rule_id, r.study_id, r.column, r.operator, r.expected, r.reason, r.kind, True) for r in made], ("X", None, "v", "IS_NULL", None, "off", None, False))
    df = rows(spark).unionByName(rows(spark).withColumn("studyId", F.lit("S2"))).unionByName(rows(spark).withColumn("studyId", F.lit(None).cast("string")))
    columns = ["i", "v", "studyId", "reasons", "blocking"]
    want = sorted(str(r) for r in E.evaluate(df, made).select(columns).collect())
    assert sorted(str(r) for r in E.evaluate_table(df, table).select(columns).collect()) == want
    assert E.evaluate_table(df, table.limit(0)).where("size(reasons) > 0 OR blocking").isEmpty()
    for bad in [("A", None, "w", "IS_NULL", None, "r", None, True), ("A", None, "v", "LIKE", None, "r", None, True)]:
        with pytest.raises(ValueError):
            E.evaluate_table(df, rule_table(spark, bad))


def test_the_plan_does_not_grow_with_the_rules(spark):
    many = spark.range(20_000).select(
        F.concat(F.lit("R"), "id").alias("ruleId"), F.concat(F.lit("S"), F.col("id") % 50).alias("studyId"),
        F.lit("v").alias("columnName"), F.lit("EQUALS").alias("operator"), F.col("id").cast("string").alias("expectedValue"),
        F.col("ruleId").alias("rejectionReason"), F.lit(None).cast("string").alias("ruleKind"), F.lit(True).alias("isActive"),
    )
    few, all_ = (E.evaluate_table(rows(spark), t)._jdf.queryExecution().analyzed().toString() for t in (many.limit(10), many))
    assert len(all_) < 1.5 * len(few)
    # 400 rules of the study, each of which wants a number that no row has.
    assert {r.i: len(r.reasons) for r in E.evaluate_table(rows(spark), many).collect()} == dict.fromkeys(range(7), 400)


def test_the_index_agrees_with_expressions(spark, monkeypatch):
    """All operators, blocks of two rules, values shared by rules, rules of all studies, null and unlisted studies."""
    import random

    rng = random.Random(3)
    monkeypatch.setattr(E, "FEW_RULES", 0)
    monkeypatch.setattr(E.rule_index, "BLOCK", 2)
    cases = [(o, e) for o, e, _ in CASES] * 2 + [(o, e) for o in ("GREATER_THAN", "LESS_THAN") for e in ("-1", "0", "4.5", "5", "7", "NaN", None, "10")]
    cases += [("EQUALS", None), ("NOT_EQUALS", None), ("NOT_EQUALS", " "), ("EQUALS", " "), ("EQUALS", ""), ("IN", "5,5,10"), ("NOT_IN", None), ("NOT_IN", "5,5")]
    made = [
        Rule(f"R{i:02}", rng.choice("vw"), o, e, f"r{i}", rng.choice([None, "S1", "S2"]), rng.choice(["BLOCKING", "NON_BLOCKING"]))
        for i, (o, e) in enumerate(cases * 2)
    ]
    table = rule_table(spark, *[(r.rule_id, r.study_id, r.column, r.operator, r.expected, r.reason, r.kind, True) for r in made])
    df = rows(spark).unionByName(rows(spark).withColumn("studyId", F.lit("S2"))).unionByName(rows(spark).withColumn("studyId", F.lit(None).cast("string")))
    df = df.unionByName(df).withColumn("w", F.when(F.col("i") != 3, F.col("i") - 1.0))
    columns = ["i", "v", "studyId", "reasons", "blocking"]
    want = sorted(str(r) for r in E.evaluate(df, made).select(columns).collect())
    assert sorted(str(r) for r in E.evaluate_table(df, table).select(columns).collect()) == want
    monkeypatch.setattr(E.skew, "fits_broadcast", lambda *_, **__: False)
    assert sorted(str(r) for r in E.evaluate_table(df, table, row_id=["i"]).select(columns).collect()) == want


def test_rows_of_one_value_share_what_it_fails(spark, monkeypatch):
    """2000 rows of three values against 300 rules: what is written on the way has no list per row. Joined by broadcast and by shuffle."""
    table = spark.range(300).select(
        F.concat(F.lit("R"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("ruleId"), F.when(F.col("id") % 3 > 0, "S1").alias("studyId"),
        F.lit("v").alias("columnName"), F.when(F.col("id") < 200, "EQUALS").otherwise("LESS_THAN").alias("operator"),
        F.when(F.col("id") < 200, F.col("id") % 2).otherwise(F.lit(2)).cast("string").alias("expectedValue"), F.col("id").cast("string").alias("rejectionReason"),
        F.when(F.col("id") == 0, "BLOCKING").alias("ruleKind"), F.lit(True).alias("isActive"),
    )
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("v"), F.when(F.col("id") % 2 == 0, "S1").alias("studyId"))
    written, kept = [], E.cut_lineage
    for module in (E, E.rule_index):
        monkeypatch.setattr(module, "cut_lineage", lambda frame: written.append(kept(frame)) or written[-1])
    for rows_sent in (50_000, 0):
        monkeypatch.setattr(E.skew, "BROADCAST_ROWS", rows_sent)
        judged = E.evaluate_table(df, table, row_id=["id"]).cache()
        assert judged.where("size(reasons) <> failedRules OR wrongRule IS NOT NULL").isEmpty() and judged.count() == 2000
        own = {r.v: (r.n, r.first, r.blocking) for r in judged.where("studyId = 'S1'").select("v", F.col("failedRules").alias("n"), F.col("reasons")[0].alias("first"), "blocking").distinct().collect()}
        assert own == {"0": (100, "1", False), "1": (100, "0", True), "2": (300, "0", True)}
        shared = {r.v: r.n for r in judged.where("studyId IS NULL").select("v", F.col("failedRules").alias("n")).distinct().collect()}
        assert shared == {"0": 33, "1": 34, "2": 100}
    lists = [w for w in written if any(t.startswith("array") for _, t in w.dtypes)]
    assert lists and max(w.count() for w in lists) <= 300


@pytest.mark.parametrize("few", [0, 64])
def test_a_bad_rule_fails_its_own_study(spark, monkeypatch, few):
    monkeypatch.setattr(E, "FEW_RULES", few)
    bad = [("B1", "S2", "w", "IS_NULL", None, "r", None, True), ("B2", "S3", "v", "LIKE", None, "r", None, True), ("B3", "S4", "v", "IN", "5", "r", "MILD", True)]
    good = [("A", None, "v", "EQUALS", "5", "not five", None, True), ("C", "S2", "v", "EQUALS", "5", "not five either", None, True)]
    every = rows(spark).drop("studyId").join(spark.createDataFrame([(f"S{i}",) for i in range(1, 5)], "studyId string")).where("i < 2")
    got = {(r.studyId, r.i): (r.reasons, r.blocking) for r in E.evaluate_table(every, rule_table(spark, *bad, *good)).collect()}
    assert got["S1", 0] == ([], False) and got["S1", 1] == (["not five"], False)
    for study, what in (("S2", "Rule B1: unknown column w"), ("S3", "Rule B2: unknown operator LIKE"), ("S4", "Rule B3: unknown kind MILD")):
        assert got[study, 0] == got[study, 1] == ([what], True)


def test_status_lists(spark):
    cases = [
        ("A", "A, B", None, False), ("C", "A, B", None, True), (None, "A", None, True), (None, None, "A", False),
        ("A", None, " A", True), ("A", "A", "A", True), ("A", " , ", None, False), ("A", None, None, False),
    ]
    df = spark.createDataFrame(cases, "s string, p string, n string, want boolean")
    skips = E.status_skips(F.col("s"), E.listed(F.col("p")), E.listed(F.col("n")))
    assert df.where(skips != F.col("want")).isEmpty() and df.where(skips.isNull()).isEmpty()


def test_status_order(spark):
    df = spark.createDataFrame([(a, b, c, d) for a in (True, False) for b in (True, False) for c in (True, False) for d in (True, False)], "a boolean, b boolean, c boolean, d boolean")
    for r in df.withColumn("s", E.row_status(*map(F.col, "abcd"))).collect():
        want = "SKIPPED" if r.a else "FAILED_ELIGIBILITY" if r.b else "FAILED_STRATA" if r.c else "FAILED_IMMUTABILITY" if r.d else "VALID"
        assert r.s == want and r.s in S.ROW_STATUSES


def test_split_and_counts(spark, tmp_path):
    df = spark.createDataFrame(
        [("r", "VALID", False), ("r", "SKIPPED", False), ("r", "FAILED_STRATA", True), ("q", "VALID", None)],
        "run string, status string, blocking boolean",
    )
    assert {tuple(r) for r in E.status_counts(df, ["run"]).collect()} == {("r", 3, 1, 1, True), ("q", 1, 1, 0, False)}
    write_split(E.split_valid(df), str(tmp_path / "split"))
    back = spark.read.parquet(str(tmp_path / "split"))
    assert {(r.is_valid, r["count"]) for r in back.groupBy("is_valid").count().collect()} == {("true", 2), ("false", 2)}


def test_all_stages(spark):
    visits = spark.createDataFrame(
        [
            (1, "S", "10", "a", "ON", "1", "x", "phone"), (2, "S", "10", "a", "ON", "1", "y", "phone"),
            (3, "S", "10", "b", "OFF", "1", "x", "phone"), (4, "S", "10", "b", "ON", "0", "x", "phone"),
            (5, "S", "10", "c", "ON", "1", " ", "phone"), (6, "S", "10", "b", "ON", "1", "z", " "),
            (7, "S", "10", "d", "ON", "1", "x", "phone"), (8, "T", "10", "a", "ON", "1", "x", None),
        ],
        "n int, studyId string, studySiteNumber string, subjectId string, subjectStatus string, flag string, "
        "cohort string, visitContactMode string",
    )
    configs = spark.createDataFrame(
        [("S", "EDC_ONLY", " cohort ", None, "OFF", True)],
        "studyId string, armResolutionMode string, edcArmColumn string, payableSubjectStatuses string, "
        "nonPayableSubjectStatuses string, hasVisitContactMode boolean",
    )
    registry = spark.createDataFrame(
        [("S", "10", "d", "other", True)],
        "studyId string, siteId string, subjectId string, assignedBudgetArm string, isActive boolean",
    )
    rules = [Rule("R", "flag", "EQUALS", "1", "flag is off")]
    checked = validate.validate(visits, configs, rules, registry, order="n", row_id=["n"])
    got = checked.rows.orderBy("n").collect()
    assert {r.subjectId for r in checked.arms.where("is_new").collect()} == {"a"}
    assert [r.status for r in got] == [
        "VALID", "FAILED_IMMUTABILITY", "SKIPPED", "FAILED_ELIGIBILITY", "FAILED_STRATA", "FAILED_ELIGIBILITY",
        "FAILED_IMMUTABILITY", "FAILED_STRATA",
    ]
    assert got[5].reasons == ["visitContactMode is blank."]
    assert [r.registered_arm for r in got][:2] == ["x", "x"] and got[6].registered_arm == "other"


def test_validation_writes_split_registry_and_counts(spark, tmp_path):
    visits = spark.createDataFrame(
        [(1, "S", "10", "a", "1", "F", "P", None), (2, "S", "10", "a", "1", "F", "P", "30 min"), (3, "S", None, "b", "2", "F", "P", None)],
        "n int, studyId string, studySiteNumber string, subjectId string, subjectVisitNumber string, formName string, "
        "procedureName string, timePostDose string",
    ).withColumns({"subjectStatus": F.lit("ENROLLED"), "visitNumber": F.col("subjectVisitNumber")})
    configs = spark.createDataFrame([("S", "FLAT_RATE", "IGNORE", None, None)], "studyId string, armResolutionMode string, pkPayMode string, payableSubjectStatuses string, nonPayableSubjectStatuses string")
    schedule = spark.createDataFrame([("S", "1", "F", "P", 1)], "studyId string, visitNumber string, formName string, procedureName string, optionalVisitFlag int")
    for run in ("one", "two"):
        validate.validate_run(spark, visits, configs, [], str(tmp_path), run, order="n", row_id=["n"], schedule=schedule)
    got = spark.read.parquet(f"{tmp_path}/{validate.ROWS}").where("run_id = 'one'").orderBy("n").collect()
    assert [(r.n, r.status, r.in_schedule, r.optionalVisitFlag) for r in got] == [
        (1, "VALID", True, 1), (2, "SKIPPED", True, 1), (3, "VALID", False, None),
    ]
    registry = spark.read.schema(S.SUBJECT_REGISTRY).parquet(f"{tmp_path}/{validate.REGISTRY}").collect()
    assert sorted((r.subjectId, r.siteId or "", r.firstSeenRunId) for r in registry) == [("a", "10", "one"), ("b", "", "one")]
    log = spark.read.schema(validate.LOG).parquet(f"{tmp_path}/{validate.LOG_TABLE}").collect()
    assert sorted((r.runId, r.totalRows, r.validRows, r.skippedRows, r.blocked) for r in log) == [("one", 3, 2, 1, False), ("two", 3, 2, 1, False)]


def test_a_run_is_published_once(spark, tmp_path, monkeypatch):
    """Repeated, interrupted or twice at once: one result, and nothing left of what does not count."""
    visits = spark.createDataFrame([(1, "S", "a", "10"), (2, "S", "b", "10")], "n int, studyId string, subjectId string, studySiteNumber string").withColumns(
        {"subjectStatus": F.lit("ENROLLED"), "cohort": F.lit("c")}
    )
    configs = spark.createDataFrame([("S", "FLAT_RATE", None, None)], "studyId string, armResolutionMode string, payableSubjectStatuses string, nonPayableSubjectStatuses string")
    new_subjects = validate.arms.new_subjects

    def run(run_id="r 1/ä"):
        validate.validate_run(spark, visits, configs, [], str(tmp_path), run_id, order="n", row_id=["n"])

    def broken(*_):
        raise RuntimeError("gone")

    def state():
        rows = sorted((r.run_id, r.n) for r in spark.read.parquet(f"{tmp_path}/{validate.ROWS}").collect())
        seen = sorted(r.subjectId for r in validate.published(spark, str(tmp_path), validate.REGISTRY).collect())
        return rows, seen, [(r.runId, r.totalRows) for r in validate.published(spark, str(tmp_path), validate.LOG_TABLE).collect()]

    monkeypatch.setattr(validate.arms, "new_subjects", broken)
    with pytest.raises(RuntimeError):
        run()
    assert validate.published(spark, str(tmp_path), validate.REGISTRY).count() == 0
    once = [("r 1/ä", 1), ("r 1/ä", 2)], ["a", "b"], [("r 1/ä", 2)]

    def overtaken(*args):
        monkeypatch.setattr(validate.arms, "new_subjects", new_subjects)
        run()
        return new_subjects(*args)

    # Another attempt of the run is published while this one is at work.
    monkeypatch.setattr(validate.arms, "new_subjects", overtaken)
    run()
    assert state() == once
    run()
    assert state() == once
    run("two")
    assert state()[1] == ["a", "b"] and len(state()[0]) == 4


def test_what_a_crash_left_goes_with_the_next_attempt(spark, tmp_path):
    from visitmill.sinks import publish

    tables, out = ["t"], str(tmp_path)
    left = publish.folder_of(spark, out, "t", "r", "crashed")
    spark.range(3).write.parquet(left)
    schema = spark.range(1).schema
    assert publish.read(spark, out, "t", schema).count() == 0
    with publish.attempt(spark, out, "r", tables) as own:
        spark.range(2).write.parquet(publish.folder_of(spark, out, "t", "r", own))
    assert publish.read(spark, out, "t", schema).count() == spark.read.parquet(f"{out}/t").count() == 2
    with publish.attempt(spark, out, "r", tables) as again:
        assert again is None
    assert not publish.claim(spark, f"{out}/published/r", "other")
