"""Queries with SQL against DuckDB; the others against plain code or held-out labels."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import digest
from visitmill.llm import queries

from .conftest import plain
from .test_operators import naive_entropy_spans

SQL = sorted(queries.ORACLES)


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def db(small):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", SQL)
def test_query_with_sql(spark, db, small, name):
    df = queries.QUERIES[name](spark, small)
    result = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, df.collect())[0] == digest(columns, result.fetchall())[0]


@pytest.mark.parametrize("name", ["op3_mixing", "op4_chat_format"])
def test_native_queries_run_no_python(spark, small, name, capsys):
    queries.QUERIES[name](spark, small).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def test_secrets(spark, small, texts):
    def base(text):
        kinds = [
            ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
            ("access", r"AKIA[A-Z0-9]+", 18, 0),
            ("hex", r"[0-9a-f]+", 16, 0),
        ]
        out = []
        for order, (kind, form, least, group) in enumerate(kinds):
            out += [(m.start(), order, kind, m.end()) for m in re.finditer(form, text, re.ASCII) if len(m.group(group)) >= least]
        return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]

    rows = queries.QUERIES["op5_secrets"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(want))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert [s for s in r.spans.split(",") if s and not s.startswith("entropy")] == want
        entropy = [f"entropy:{a}:{b}" for a, b in naive_entropy_spans(texts[r.doc_id])]
        assert [s for s in r.spans.split(",") if s.startswith("entropy")] == entropy


def test_byte_bpe(spark, small, texts):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    from visitmill.llm.bpe import read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = queries.QUERIES["op8_byte_bpe"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)))
        assert r.decoded_sha256 == sha(texts[r.doc_id])


def test_language_of_held_out_rows(spark, small):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_language_id"](spark, small).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_of_held_out_rows(spark, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = queries.QUERIES["op10_quality"](spark, small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = ([r.score for r in held if labels[r.doc_id] == y] for y in (1, 0))
    ranked = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert not ranked or sum(ranked) / len(ranked) >= 0.75


def test_pipeline_against_plain_code(spark, small, texts):
    """Each stage is held against plain code on what the one before it left."""
    from .test_near_dup import brute_force

    docs = spark.read.parquet(f"{small}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, small).cache()
        left[name] = {r.doc_id: r.text for r in docs.collect()}
        assert set(docs.columns) == set(before.columns)
    assert set(left["language_id"]) <= {d for d, t in texts.items() if any(c.isalpha() for c in t)}
    assert len(left["language_id"]) >= 0.97 * len(texts)

    blank = " \t\n\x0b\x0c\r"
    keys = {d: [line.strip(blank).encode().lower().decode() for line in t.split("\n")] for d, t in left["language_id"].items()}
    holders: dict[str, set] = {}
    for d, found in keys.items():
        for key in found:
            if len(key) >= 20:
                holders.setdefault(key, set()).add(d)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= 3}
    want = {}
    for d, t in left["language_id"].items():
        stays = [line for line, k in zip(t.split("\n"), keys[d]) if gone.get(k, d) == d]
        if stays and (len(stays) == len(keys[d]) or "\n".join(stays)):
            want[d] = "\n".join(stays)
    assert left["line_dedup"] == want

    classes = brute_force(list(want.items()))
    assert set(left["near_duplicates"]) == {d for d in want if classes[d][0] == d}
    assert set(left["mixing"]) <= set(left["near_duplicates"])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert plain(last, "doc_id", "decoded_sha256") == sorted(((d, sha(t)) for d, t in left["mixing"].items()), key=repr)


def test_run_gives_the_last_stage(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
