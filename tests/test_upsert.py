from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.operators import upsert
from visitmill.plans import seed
from visitmill.sinks import versions

RULE = {"ruleId": "R1", "columnName": "c", "operator": "EQUALS", "expectedValue": "1", "rejectionReason": "r"}
SITES = [{"sourceColumn": s, "targetColumn": "studySiteNumber"} for s in ("SITE_ID", "STUDY_SITE_ID", "SBJ_SITE_NUM")]


def at(day):
    return F.lit(datetime(2024, 1, day)).cast("timestamp")


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_rules_are_updated_but_keep_who_made_them(spark):
    first = upsert.seed_rules(empty(spark, S.ELIGIBILITY_RULE), [dict(RULE, createdBy="me"), dict(RULE, ruleId="R2")], at(1))
    again = [dict(RULE, createdBy="you", isActive=False, ruleKind="BLOCKING", updatedBy="you"), dict(RULE, ruleId="R3")]
    rows = {r.ruleId: r for r in upsert.seed_rules(first, again, at(2)).collect()}
    assert [(i, rows[i].id) for i in sorted(rows)] == [("R1", 1), ("R2", 2), ("R3", 3)]
    one = rows["R1"]
    assert (one.createdBy, one.updatedBy, one.isActive, one.ruleKind) == ("me", "you", False, "BLOCKING")
    assert (one.createdAt.day, one.updatedAt.day) == (1, 2)
    assert (rows["R2"].createdBy, rows["R2"].ruleKind, rows["R2"].updatedAt.day) == ("seed-sponsor", "NON_BLOCKING", 1)


def test_last_source_of_a_target_stays(spark):
    rows = [dict(SITES[0], createdBy="a"), *SITES[1:]]
    got = upsert.seed_mappings(empty(spark, S.COLUMN_MAPPING), [(S.SUBJECT_GROUP, rows)], at(1)).collect()
    assert [(r.id, r.type, r.sourceColumn, r.createdBy) for r in got] == [(1, "subject_group", "SBJ_SITE_NUM", "a")]


def test_categories_do_not_meet(spark):
    base = upsert.seed_mappings(empty(spark, S.COLUMN_MAPPING), [(S.SUBJECT_GROUP, SITES[:1])], at(1))
    got = upsert.seed_mappings(base, [(S.MISC, SITES[1:2])], at(1)).collect()
    assert {(r.id, r.type, r.sourceColumn) for r in got} == {(1, "subject_group", "SITE_ID"), (2, "misc", "STUDY_SITE_ID")}


def test_only_the_lowest_id_of_a_repeated_key_is_updated(spark):
    base = spark.createDataFrame([(5, "k", "x"), (3, "k", "y"), (9, "j", "z")], "id int, key string, v string")
    new = spark.createDataFrame([("k", "new", 0), ("m", "m", 2), ("l", "l", 1)], "key string, v string, ordinal int")
    for limit in (0, 100):
        got = {tuple(r) for r in upsert.upsert(base, new, ["key"], row_id="id", broadcast_rows=limit).collect()}
        assert got == {(5, "k", "x"), (3, "k", "new"), (9, "j", "z"), (10, "l", "l"), (11, "m", "m")}


@pytest.mark.parametrize("limit", [0, 100])
def test_unique_keys(spark, limit):
    base = spark.createDataFrame([("a", 1, "b0"), ("b", 2, "b0")], "key string, v int, createdBy string")
    new = spark.createDataFrame(
        [("b", 20, "s0", 0), ("c", 30, "s1", 1), ("c", 31, "s2", 2)], "key string, v int, createdBy string, ordinal int"
    )
    got = upsert.upsert(base, new, ["key"], broadcast_rows=limit)
    assert {tuple(r) for r in got.collect()} == {("a", 1, "b0"), ("b", 20, "b0"), ("c", 31, "s1")}


def test_seed_without_values_is_refused(spark):
    base = spark.createDataFrame([("k", 1)], "key string, v int")
    with pytest.raises(ValueError, match="no value for: v"):
        upsert.upsert(base, spark.createDataFrame([("k", 0)], "key string, ordinal int"), ["key"])
    with pytest.raises(KeyError, match="operator"):
        upsert.seed_rules(empty(spark, S.ELIGIBILITY_RULE), [{"ruleId": "x", "columnName": "c", "rejectionReason": "r"}], at(1))


def write(tmp_path, payload):
    path = tmp_path / "seed.json"
    path.write_text(json.dumps(payload))
    return str(path)


def test_seed_file(spark, tmp_path):
    path = write(
        tmp_path,
        {"eligibility_rule": [RULE], "subject_group_column_mapping": SITES,
         "misc_column_mapping": [{"sourceColumn": "FORM", "targetColumn": "formName"}]},
    )
    tables = str(tmp_path / "tables")
    seed.seed_tenant(spark, "demo", path, tables)
    place = f"{tables}/demo/data_column_mapping"
    before = versions.read_current(spark, place, S.COLUMN_MAPPING).drop("updatedAt").orderBy("id").collect()
    seed.seed_tenant(spark, "demo", path, tables)
    after = versions.read_current(spark, place, S.COLUMN_MAPPING).drop("updatedAt").orderBy("id").collect()
    assert before == after
    rules = versions.read_current(spark, f"{tables}/demo/eligibility_rule", S.ELIGIBILITY_RULE)
    mappings = versions.read_current(spark, f"{tables}/demo/data_column_mapping", S.COLUMN_MAPPING)
    assert [r.ruleId for r in rules.collect()] == ["R1"]
    assert {(r.id, r.type, r.sourceColumn) for r in mappings.collect()} == {(1, "subject_group", "SBJ_SITE_NUM"), (2, "misc", "FORM")}
    assert versions.current_version(spark, f"{tables}/demo/eligibility_rule") == 2
    assert rules.where("updatedAt < createdAt").isEmpty()


@pytest.mark.parametrize("payload", [[], "x", {"eligibility_rule": {}}, {"misc_column_mapping": "x"}])
def test_bad_seed_files(spark, tmp_path, payload):
    with pytest.raises(ValueError):
        upsert.read_seed(spark, write(tmp_path, payload))


def test_two_seeds_at_once_both_count(spark, tmp_path):
    """The second writer to claim a version makes its change on what the first one wrote."""
    from pyspark.sql import functions as F

    root, schema = str(tmp_path), spark.range(1).schema
    assert versions.read_current(spark, root, schema).count() == 0
    seen = []

    def add(first, rival=None):
        def change(base):
            seen.append(sorted(r.id for r in base.collect()))
            if rival is not None and len(seen) == 1:
                versions.update(spark, root, schema, add(rival))
            return base.unionByName(spark.range(first, first + 1))

        return change

    assert versions.update(spark, root, schema, add(1, rival=7)) == 2
    assert sorted(r.id for r in versions.read_current(spark, root, schema).collect()) == [1, 7]
    assert seen == [[], [], [7]] and versions.current_version(spark, root) == 2
    with pytest.raises(Exception, match="broken"):
        versions.update(spark, root, schema, lambda base: base.unionByName(spark.range(1)).select(F.raise_error(F.lit("broken")).alias("id")))
    assert versions.current_version(spark, root) == 2


def test_seed_of_many_lines_and_files(spark, tmp_path):
    """Order is that of paths, lines and lists; blank lines count for nothing."""
    folder = tmp_path / "seed"
    folder.mkdir()
    for name, numbers in (("b", range(300, 600)), ("a", range(300))):
        docs = [json.dumps({"eligibility_rule": [dict(RULE, ruleId=f"R{n % 200}", expectedValue=str(n), createdBy=str(n))]}) for n in numbers]
        (folder / f"{name}.json").write_text("\n\n".join([*docs, json.dumps({"other": 1})]))
    seed.seed_tenant(spark, "demo", str(folder), str(tmp_path / "tables"), lines=True)
    rules = versions.read_current(spark, f"{tmp_path}/tables/demo/eligibility_rule", S.ELIGIBILITY_RULE)
    got = {(r.id, r.ruleId, r.expectedValue, r.createdBy) for r in rules.collect()}
    assert got == {(n + 1, f"R{n}", str(n + 400), str(n)) for n in range(200)}


def test_nulls_and_defaults_of_a_seed(spark):
    rows = [RULE, dict(RULE, ruleId="R2", isActive=None, createdBy=None, ruleKind=None), dict(RULE, ruleId="R3", isActive=0, expectedValue=5)]
    got = upsert.seed_rules(empty(spark, S.ELIGIBILITY_RULE), rows, at(1)).orderBy("id").collect()
    assert [(r.isActive, r.createdBy, r.ruleKind, r.expectedValue) for r in got] == [
        (True, "seed-sponsor", "NON_BLOCKING", "1"), (False, None, None, "1"), (False, "seed-sponsor", "NON_BLOCKING", "5"),
    ]


def test_bad_lines_and_rows_are_told(spark, tmp_path):
    path = tmp_path / "seed.json"
    good = json.dumps({"misc_column_mapping": SITES[:1]})
    for bad in ('{"misc_column_mapping": [1]}', "{", '{"misc_column_mapping": null}', "7"):
        path.write_text(f"{good}\n{bad}\n")
        with pytest.raises(ValueError, match="seed.json"):
            upsert.read_seed(spark, str(path), lines=True)
    path.write_text(f'{good}\n{{"misc_column_mapping": [{{"sourceColumn": "x"}}]}}\n')
    with pytest.raises(KeyError, match="targetColumn"):
        seed.seed_tenant(spark, "demo", str(path), str(tmp_path / "tables"), lines=True)
    path.write_text("")
    for lines in (False, True):
        with pytest.raises(ValueError):
            upsert.read_seed(spark, str(path), lines=lines)
