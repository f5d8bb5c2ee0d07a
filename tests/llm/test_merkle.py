from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from visitmill.llm import merkle

from .conftest import plain


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    texts = [None if v is None else str(v) for v in values]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(digests):
    """Root, and per leaf the siblings with their side, level by level."""
    proofs, places, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, at in enumerate(places):
            other = at ^ 1
            proofs[i].append(("", "") if other >= len(level) else (level[other], "") if at & 1 else ("", level[other]))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        places = [at >> 1 for at in places]
    return level[0], proofs


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars): doc_id, leaf, subroot, root, proof."""
    groups = {}
    for d, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf([d, source, lang, n, text]), d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g])]) for g in names]
    root, upper = tree([t[0] for t in trees])
    out = []
    for g, (subroot, proofs), above in zip(names, trees, upper):
        out += [(x[3], x[2], subroot, root, p + above) for x, p in zip(sorted(groups[g]), proofs)]
    return sorted(out, key=repr)


def found(df):
    rows = merkle.manifest(df, merkle.LEAF)
    return sorted(((r.id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in rows.collect()), key=repr)


def test_edge_rows(docs, crowded, nothing, rows):
    assert found(docs) == brute(rows)
    assert found(crowded) == brute(rows)
    assert found(nothing) == []
    one = docs.where("doc_id = 14")
    only = merkle.manifest(one, merkle.LEAF).first()
    assert only.leaf == only.subroot == only.root and only.proof == []


@pytest.mark.parametrize("spread", [1, 1_000, 1 << 40, -(1 << 41)])
def test_many_leaves_over_blocks_and_directories(spark, spread, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3)
    monkeypatch.setattr(merkle, "DIRECTORY_BITS", 3)
    rows = [(i * spread, f"t{i}", ["a", "b", None, "ä"][(i * i) % 4], "s", i) for i in range(150)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")) == brute(rows)


def test_ids_at_the_bounds_and_hot_ids(spark):
    """Least and largest id, and an id and a null id that hold a third of the rows each."""
    rows = [(v, "t", "en", "s", 0) for v in (-(1 << 63), (1 << 63) - 1, -1, 0, 1)]
    rows += [(7, f"x{i % 40}", "en", "s", i % 3) for i in range(200)] + [(None, f"y{i % 50}", "en", "s", None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert found(df) == brute(rows)


def test_proofs_show_any_change(docs):
    tampered = merkle.leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.LEAF])
    rows = merkle.manifest(docs, merkle.LEAF, other_leaf=tampered)
    folded = rows.select("root", merkle.fold(F.col("leaf"), F.col("proof")).alias("same"), merkle.fold(F.col("other_leaf"), F.col("proof")).alias("other"), F.col("leaf") == F.col("other_leaf"))
    for root, same, other, unchanged in folded.collect():
        assert same == root and (other == root) == unchanged
    digests = rows.select("proof", merkle.proof_digest(F.col("proof")).alias("d")).collect()
    assert all(r.d == sha("".join(a + b for a, b in r.proof)) for r in digests)


def test_names_of_groups_by_bytes(spark):
    rows = [(i, "t", g, "s", 0) for i, g in enumerate(["b", "", None, "B", "é", "zz", "𝔘", "￿", "b"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(df) == brute(rows) and len(plain(df, "lang")) == 9
