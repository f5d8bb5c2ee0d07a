"""Joins and numbering with a key that holds a third of the rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.operators import stems
from tests.test_text import brute_stem


def skewed(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 7).alias("v"))


def test_hot_keys_are_found(spark):
    rows = skewed(spark)
    zero = spark.range(1).select(F.xxhash64(F.lit(0).cast("long"))).first()[0]
    assert skew.hot_key_hashes(rows, ["k"]) == [zero]
    assert skew.hot_key_hashes(rows.where("k <> 0"), ["k"]) == []
    assert skew.hot_key_hashes(rows.limit(0), ["k"]) == []


def test_salted_join_equals_plain_join(spark):
    rows = skewed(spark)
    lookup = spark.range(0, 6000, 2).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    plain = rows.join(lookup, "k", "left")
    for how in ("left", "inner"):
        salted = skew.lookup_join(rows, lookup, ["k"], row_id=["id"], how=how, broadcast_rows=0, salts=8)
        want = plain if how == "left" else plain.where("name IS NOT NULL")
        assert salted.count() == want.count()
        assert salted.exceptAll(want.select(salted.columns)).isEmpty()


def test_hot_rows_are_spread(spark):
    rows = skewed(spark)
    lookup = spark.range(6000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    joined = skew.salted_join(rows, lookup, ["k"], row_id=["id"], salts=16).where("k = 0")
    parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 1 and max(p["count"] for p in parts) < 2000


def test_null_keys_stay(spark):
    rows = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    lookup = spark.createDataFrame([("a", 1)], "k string, x int")
    for limit in (0, 10):
        got = skew.lookup_join(rows, lookup, ["k"], broadcast_rows=limit).select("id", "x").collect()
        assert {tuple(r) for r in got} == {(1, None), (2, 1)}


def test_rows_with_variants_and_maps(spark):
    rows = skewed(spark, 300).select("id", "k", F.parse_json(F.lit("{}")).alias("v"), F.create_map(F.lit(1), "id").alias("m"))
    lookup = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    joined = skew.salted_join(rows, lookup, ["k"], salts=4)
    assert joined.count() == 300 and joined.where("x = k * 2").count() == 300


def test_fits_broadcast(spark):
    assert skew.fits_broadcast(spark.range(5), 5) and not skew.fits_broadcast(spark.range(6), 5)
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("x"))
    assert skew.fits_broadcast(wide, 5, 4000) and not skew.fits_broadcast(wide, 5, 2000)
    assert skew.fits_broadcast(spark.range(0), 0)


def test_ordinals_by_ranges(spark):
    rows = skewed(spark, 3000).withColumn("at", F.col("id") * 1_000_003 - 10**9)
    for cuts in (None, [], skew.range_cuts(rows, "at", per_range=50)):
        got = skew.bucketed_ordinal(rows, ["k"], "at", "n", cuts).collect()
        seen: dict[int, int] = {}
        for row in sorted(got, key=lambda r: r["at"]):
            assert row.n == seen.get(row.k, 0)
            seen[row.k] = row.n + 1
        assert len(got) == 3000


def test_ranges_stay_balanced_with_an_outlier(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") == 0, 10**18).otherwise(F.col("id")).alias("at"))
    cuts = skew.range_cuts(rows, "at", per_range=1000)
    sizes = rows.groupBy(skew.range_number(F.col("at"), cuts).alias("r")).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 1200
    assert skew.range_cuts(rows, "at") == [] and skew.range_cuts(rows.limit(0), "at") == []


@pytest.mark.parametrize("cuts", [[], [5], [0, 3, 3, 9], list(range(0, 70, 7))])
def test_range_number(spark, cuts):
    got = spark.range(-2, 80).select("id", skew.range_number(F.col("id"), cuts).alias("r")).collect()
    assert all(r.r == sum(c <= r.id for c in cuts) for r in got)


def test_null_groups_are_numbered(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, at long")
    for cuts in ([], [2]):
        got = skew.bucketed_ordinal(rows, ["g"], "at", "n", cuts).orderBy("at").collect()
        assert [r.n for r in got] == [0, 1, 0]


def brute_stems(labels: list[str]) -> list[str]:
    used: set[str] = set()
    out = []
    for label in labels:
        base = name = brute_stem(label)
        n = 0
        while name in used:
            n += 1
            name = f"{base[: 200 - len(f'_{n}')]}_{n}"
        used.add(name)
        out.append(name)
    return out


def check_stems(spark, labels, per_range):
    df = spark.createDataFrame(list(enumerate(labels)), "i long, l string")
    got = {r.i: r.stem for r in stems.unique_stems(df, F.col("l"), "i", per_range=per_range).collect()}
    assert [got[i] for i in range(len(labels))] == brute_stems(labels)


def test_unique_stems_of_plain_labels(spark):
    check_stems(spark, ["a.csv", "b.csv", "a.csv", "x/a.txt", "c.csv", "a"], None)
    check_stems(spark, ["a", "a", "a_1"], None)
    check_stems(spark, ["a_1", "a", "a"], 1)


def test_unique_stems_that_meet(spark):
    pool = ["a", "a_1", "a_2", "a_1_1", "a_3", "b", "b_1", "c_01", "a_2_1", "a_10"]
    for seed in (1, 2):
        rng = random.Random(seed)
        check_stems(spark, [rng.choice(pool) + ".csv" for _ in range(70)], 9)


def test_unique_stems_with_a_hot_label(spark):
    labels = ["hot" if i % 3 == 0 else f"hot_{i}" if i % 5 == 0 else f"f{i}" for i in range(300)]
    check_stems(spark, labels, 16)


def test_unique_stems_cut_at_the_limit(spark):
    pool = ["y" * 200, "y" * 199, "y" * 198 + "_1", "y" * 197 + "_10", "z"]
    rng = random.Random(5)
    check_stems(spark, [rng.choice(pool) for _ in range(30)], None)


def test_unique_stems_within_a_scope(spark):
    rows = [(s, i, "a") for s in ("one", "two", None, "") for i in range(3)]
    df = spark.createDataFrame(rows, "s string, i long, l string")
    got = stems.unique_stems(df, F.col("l"), "i", scope=["s"]).orderBy("s", "i").collect()
    assert [r.stem for r in got] == ["a", "a_1", "a_2"] * 4
    longs = df.withColumn("l", F.repeat(F.lit("y"), 250))
    assert stems.unique_stems(longs, F.col("l"), "i", scope=["s"]).count() == 12


def test_cut_stems_take_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(stems, "cut_lineage", lambda df, own=stems.cut_lineage: (written.append(1), own(df))[1])
    labels = ["y" * 220 + "ab"[i % 2] for i in range(300)]
    check_stems(spark, labels, None)
    assert len(written) <= 8


def test_many_small_groups_need_no_ranges(spark, monkeypatch):
    """240 rows of 80 scopes, ranges of 50: no group is large, so none is cut into ranges and joined to their totals. Names are made once."""
    monkeypatch.setattr(skew, "RANGE_ROWS", 50)
    cuts, own = [], skew.bucketed_sum_before

    def watched(df, group, order, flag, name, found=None):
        cuts.append(found)
        return own(df, group, order, flag, name, found)

    monkeypatch.setattr(skew, "bucketed_sum_before", watched)
    kinds = [["a", "a", "a_1"], ["a_1", "a", "a"], ["a", "a_2", "a"], ["b_2", "b", "b"]]
    rows = [(s, 3 * s + at, label) for s in range(80) for at, label in enumerate(kinds[s % 4])]
    made = spark.sparkContext.accumulator(0)

    def count(label):
        made.add(1)
        return label

    df = spark.createDataFrame(rows, "s long, i long, l string")
    named = stems.unique_stems(df, F.udf(count)("l"), "i", scope=["s"])
    got = {r.i: r.stem for r in named.collect()}
    for s in range(80):
        assert [got[3 * s + at] for at in range(3)] == brute_stems(kinds[s % 4])
    assert len(cuts) >= 4 and all(found == [] for found in cuts) and made.value == len(rows)
