from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from visitmill.llm import common
from visitmill.llm import near_dup as N

from .conftest import near, plain


def brute_force(pairs, threshold=0.8):
    """id → (class, links, text links) by comparing all sets that share a shingle."""
    sets = {}
    for d, text in pairs:
        words = re.findall(r"\w+", (text or "").lower())
        span = min(5, len(words))
        sets[d] = frozenset(tuple(words[i : i + span]) for i in range(len(words) - span + 1)) if words else frozenset()
    by_set = defaultdict(list)
    for d, s in sets.items():
        if s:
            by_set[s].append(d)
    unique = list(by_set)
    where, common = defaultdict(list), Counter()
    for i, s in enumerate(unique):
        for x in s:
            where[x].append(i)
    for found in where.values():
        common.update((a, b) for k, b in enumerate(found) for a in found[:k])
    parent = list(range(len(unique)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links, text_links = Counter(), Counter()
    for (a, b), n in common.items():
        if n >= threshold * (len(unique[a]) + len(unique[b]) - n) - 1e-9:
            text_links.update((a, b))
            links[a] += len(by_set[unique[b]])
            links[b] += len(by_set[unique[a]])
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, s in enumerate(unique):
        least[root(i)] = min(least.get(root(i), by_set[s][0]), *by_set[s])
    out = {d: (d, 0, 0) for d, s in sets.items() if not s}
    for i, s in enumerate(unique):
        for d in by_set[s]:
            out[d] = (least[root(i)], links[i] + len(by_set[s]) - 1, text_links[i])
    return out


def found(df):
    return {r.doc_id: (r.class_id, r.n_links, r.n_text_links) for r in df.collect()}


def family(size: int, words: int = 120):
    """Near copies of one text, each with two words of its own; and texts that share only a passage."""
    base = [f"w{i}" for i in range(words)]
    rng = np.random.default_rng(3)
    out = []
    for i in range(size):
        own = list(base)
        for place in rng.integers(0, words, 2):
            own[place] = f"x{i}y{place}"
        out.append((i, " ".join(own)))
    out += [(size + i, " ".join([*base[:30], *(f"z{i}q{j}" for j in range(90))])) for i in range(40)]
    return out


def test_query_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(N.op7_near_duplicates(spark, small)) == brute_force(rows)


def test_edge_rows(docs, crowded, nothing):
    got = plain(N.near_duplicates(docs), "doc_id", "class_id", "n_links", "n_text_links")
    assert plain(N.near_duplicates(crowded), "doc_id", "class_id", "n_links", "n_text_links") == got
    by_id = {g[0]: g[1:] for g in got if g[0] is not None}
    assert by_id[1] == (1, 0, 0) and by_id[2] == (2, 0, 0) and by_id[3] == (3, 0, 0)
    # 10 and 12 are copies, 11 differs in two words.
    assert by_id[10] == (10, 2, 1) and by_id[11] == (10, 2, 1) and by_id[12] == (10, 2, 1)
    # Equal words: 4 twice, 5, and the row without id.
    assert by_id[4] == (4, 3, 0) and by_id[5] == (4, 3, 0)
    assert (None, 4, 3, 0) in got and len(got) == docs.count()
    assert N.near_duplicates(nothing).count() == 0


def test_an_id_with_different_texts(spark):
    """Each text of an id is searched and verified, and goes or stays by itself."""

    def copy(word, change=None):
        return " ".join("other" if i == change else f"{word}{i}" for i in range(120))

    rows = [(1, copy("a")), (5, copy("a", 7)), (5, copy("b")), (5, copy("c")), (6, copy("b", 9)), (7, copy("c", 3)), (8, copy("d"))]
    want = sorted([(1, 1, 1, 1), (5, 1, 1, 1), (5, 5, 1, 1), (5, 5, 1, 1), (6, 5, 1, 1), (7, 5, 1, 1), (8, 8, 0, 0)], key=repr)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert plain(N.near_duplicates(df), "doc_id", "class_id", "n_links", "n_text_links") == want
    wide = df.selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    left = corpus_pipeline.drop_near_duplicates(spark, wide, "")
    assert plain(left, "doc_id", "text") == sorted([rows[0], rows[2], rows[3], rows[6]], key=repr)


def test_large_family_in_split_nodes_and_tiles(spark, monkeypatch):
    rows = family(220)
    monkeypatch.setattr(N, "NODE", 24)
    monkeypatch.setattr(N, "PART_TEXTS", 50)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(N.near_duplicates(df)) == brute_force(rows)
    monkeypatch.setattr(N, "FEW_EDGES", 0)
    monkeypatch.setattr(N, "ROOTS", 2)
    assert found(N.near_duplicates(df)) == brute_force(rows)


def template(size: int, shared: int = 300, own: int = 80):
    """Texts of one template, similar by 0.64 and linked with none, but for two near copies of the first."""
    rows = [(i, " ".join([*(f"s{j}" for j in range(shared)), *(f"t{i}o{j}" for j in range(own))])) for i in range(size)]
    return [*rows, (size, rows[0][1] + " end"), (size + 1, "start " + rows[0][1])]


def test_a_template_is_not_compared(spark, monkeypatch):
    """A loose cluster falls apart into the texts that share a rare shingle, and no link is lost."""
    rows, seen = template(300), []
    monkeypatch.setattr(N, "PART_TEXTS", 50)
    split = N.split_clusters

    def watched(sets, threshold):
        out = split(sets, threshold).cache()
        seen.append((sets.count(), out.count()))
        return out

    monkeypatch.setattr(N, "split_clusters", watched)
    got = found(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute_force(rows) and got[300] == (0, 2, 2)
    assert seen == [(302, 3)]


def test_prefix_keys_meet_where_sets_are_similar():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size, share = int(rng.integers(1, 400)), rng.uniform(0.75, 1)
        x = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: max(1, int(share * len(x)))], rng.integers(0, 1 << 62, int(rng.integers(0, 40)), dtype=np.uint64)]))
        common = np.unique(rng.choice(x, min(len(x), 30)))
        counts = rng.integers(1, 9, len(common))
        same = len(np.intersect1d(x, y))
        if same >= 0.8 * (len(x) + len(y) - same):
            assert len(np.intersect1d(*[N.prefix_keys(z, common, counts, 0.8) for z in (x, y)]))


def test_prefix_is_the_longest_that_reaches_the_recall():
    k = N.prefix_length(0.8, N.RECALL)
    assert 1 - (1 - 0.8**k) ** N.TREES >= N.RECALL > 1 - (1 - 0.8 ** (k + 1)) ** N.TREES
    assert N.prefix_length(0.1, 0.999999) == 1


def test_signatures_estimate_similarity():
    forest, rng = N.Forest(N.TREES, N.DEPTH, 4), np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    y = np.concatenate([x[:800], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    agree = (forest.signature(x) == forest.signature(y)).mean()
    assert abs(agree - 800 / 1200) < 0.15


@pytest.mark.parametrize("few", [0, 50_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(N, "FEW_EDGES", few)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(plain(N.components(df), "id", "root"))
    assert got == {**{i: 0 for i in range(1, 41)}, 150: 100, 200: 100, 301: 300}
    assert N.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [(3, 5), (1, 1), (0, 0)])
def test_groups_stay_whole_across_batches(sizes):
    import pyarrow as pa

    keys = np.repeat(np.arange(7), [1, 4, 9, 2, 1, 6, 3])
    batches, at = [], 0
    for step in [*sizes, 4, 2, 100]:
        batches.append(pa.RecordBatch.from_arrays([pa.array(keys[at : at + step])], names=["k"]))
        at += step
    groups = [g.column("k").to_pylist() for g in N._runs(iter(batches), ["k"])]
    assert [k for g in groups for k in g] == keys.tolist()
    assert all(not set(a) & set(b) for i, a in enumerate(groups) for b in groups[:i])


def test_near_text_is_near():
    a, b = (set(N.shingles(near(i), N.Words()).tolist()) for i in (10, 150))
    assert 0.8 <= len(a & b) / len(a | b) < 1


def test_batches_for_python_are_bounded(spark):
    """The session's own bound stays; where there is none, a batch is at most one row over the bound."""

    spark.conf.unset(common.BATCH_SETTING)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), "id", F.lit(" ")), 60_000).alias("text")).coalesce(1)
    rows = {r.doc_id: r.n_links for r in N.near_duplicates(docs).collect()}
    assert rows == dict.fromkeys(range(40), 0)

    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"n": [batch.nbytes], "rows": [batch.num_rows]})

    for n, many in docs.mapInArrow(sizes, "n long, rows long").collect():
        assert n <= common.BATCH_BYTES + 2 * n // many
    spark.conf.set(common.BATCH_SETTING, "1m")
    common.bounded_batches(spark)
    assert spark.conf.get(common.BATCH_SETTING) == "1m"
    spark.conf.unset(common.BATCH_SETTING)
