"""Edge cases of the other operators: nulls, empty and very long texts, ties, repeats, clashing columns, no rows."""

from __future__ import annotations

import math
import random
import re
import string
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from visitmill.llm import bpe, chat, exact_dedup, language, line_dedup, mixing, quality, secrets, top_k

from .conftest import LINE, LONG, plain


def squeezed(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_exact_dedup(docs, crowded, nothing, rows):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    groups = {}
    for d, text, *_ in rows:
        groups.setdefault(squeezed(text), []).append((-len(text or ""), d is None, d))
    got = plain(exact_dedup.exact_dedup(docs), *columns)
    want = []
    for d, text, *_ in rows:
        found = groups[squeezed(text)]
        best = min(found, key=lambda g: (g[0], g[1], g[2] or 0))
        want.append((d, best[2], len(found), d == best[2] and -len(text or "") == best[0]))
    assert [g[:4] for g in got] == sorted(want, key=repr)
    assert plain(exact_dedup.exact_dedup(crowded), *columns) == got
    assert plain(exact_dedup.exact_dedup(docs, trie_bytes=2_000), *columns) == got
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_trie_holds_prefixes_and_forks():
    trie = exact_dedup.Trie(lambda a, b: a + b)
    keys = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abc", b"", b"\x00\xff", b"\x00"]
    for k in keys:
        trie.insert(k, 1)
    assert dict(trie.items()) == Counter(keys)


@pytest.mark.parametrize("most", [500, 5_000, 10**9])
def test_owners_with_spills(tmp_path, most):
    rng = random.Random(1)
    keys = [b"shared prefix " * rng.randint(0, 3) + bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(3000)]
    found = list(exact_dedup.owners(((k, 1) for k in keys), lambda a, b: a + b, str(tmp_path), most))
    assert dict(found) == Counter(keys) and len(found) == len(set(keys))
    assert not list(tmp_path.iterdir())


def test_line_dedup(docs, crowded, nothing):
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(docs).collect() if r.doc_id}
    assert got[7] == ("first", 2, 1) and got[8] == ("second", 3, 2) and got[9] == (f"third\n{LINE}", 2, 0)
    assert got[1] == (None, 1, 0) and got[2] == ("", 1, 0) and got[6][0] == LONG
    # The same line in 4 (twice) and in a row without id: the largest id keeps it, in all its rows.
    assert got[4] == ("The house is by the river.", 1, 0)
    assert ("", 1, 1) in [tuple(r)[1:] for r in line_dedup.line_dedup(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    wide = line_dedup.line_dedup(crowded)
    assert set(wide.columns) == set(crowded.columns)
    assert plain(wide, "doc_id", "text", "n_lines", "n_dropped") == plain(line_dedup.line_dedup(docs), "doc_id", "text", "n_lines", "n_dropped")
    assert wide.where("key = 'mine' AND r1 = 'mine'").count() == docs.count()
    assert line_dedup.line_dedup(nothing).count() == 0


def test_line_dedup_counts_an_id_once(spark):
    rows = [(5, f"{LINE}\na"), (5, f"{LINE}\nb"), (7, LINE)]
    few = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(line_dedup.line_dedup(few, by_id=True), "doc_id", "text") == sorted(rows, key=repr)
    wide = few.selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    assert plain(corpus_pipeline.drop_repeated_lines(spark, wide, ""), "doc_id", "text") == sorted(rows, key=repr)
    more = spark.createDataFrame([*rows, (9, LINE)], "doc_id long, text string")
    assert plain(line_dedup.line_dedup(more, by_id=True), "doc_id", "text") == [(5, "a"), (5, "b"), (7, ""), (9, LINE)]


VOCABULARY = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257, b" the": 258, b"\xc3\xbc": 300, b"xyz": 301}


@pytest.fixture()
def vocabulary(tmp_path):
    import base64

    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in VOCABULARY.items()))
    return str(path)


def test_bpe_round_trip(docs, crowded, nothing, rows, vocabulary):
    pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
    encoded = bpe.bpe_encode(crowded, vocabulary, pattern)
    assert set(encoded.columns) == set(crowded.columns) - {"text"}
    decoded = bpe.bpe_decode(encoded, vocabulary)
    texts = sorted((d, (t or "")) for d, t, *_ in rows if d)
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in decoded.collect() if r.doc_id) == texts
    assert decoded.where("spans = 'mine'").count() == docs.count()
    assert bpe.bpe_digests(nothing, vocabulary, pattern).count() == 0


def test_bpe_merges_by_rank_and_takes_whole_tokens(vocabulary, monkeypatch):
    ranks = bpe.read_ranks(vocabulary)
    model = bpe.model_bytes(ranks)
    whole = bpe.unreached(model, ranks)
    assert whole == {b"xyz": 301}
    encoder = bpe.Encoder(model, r" ?\p{L}+|\s+|.", whole)
    ids = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(["the the", "thx", "", "xyz", "axyz"])]
    assert ids == [[257, 258], [256, ord("x")], [], [301], [97, 120, 121, 122]]
    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    monkeypatch.setattr(bpe, "AT_A_TIME", 3)
    assert encoder.encode(["the thx the the thx"])[0] == b"".join(encoder.encode(["the thx", " the", " the thx"]))


def test_secrets(docs, crowded, nothing):
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find_secrets(docs).collect() if r.doc_id}
    assert [s for s in got[15] if s[0] != "entropy"] == [
        ("assign", 0, 28), ("access", 8, 28), ("assign", 33, 57), ("hex", 58, 76),
    ]
    assert got[1] == got[2] == got[4] == []
    assert plain(secrets.find_secrets(crowded), "doc_id", "spans") == plain(secrets.find_secrets(docs), "doc_id", "spans")
    assert secrets.find_secrets(nothing).count() == 0


def test_entropy_of_windows_is_kept_up_step_by_step():
    rng = random.Random(2)
    run = "".join(rng.choices("abcdefgh0123", k=60)) + "a" * 40 + "".join(rng.choices("ABCDEFxyz0189+/", k=50))
    window, threshold = 20, 2.9

    def bits(part):
        return -sum(n / len(part) * math.log2(n / len(part)) for n in Counter(part).values())

    covered = {i for at in range(len(run) - window + 1) if bits(run[at : at + window]) >= threshold - 1e-9 for i in range(at, at + window)}
    spans = list(secrets.hot_windows(run, window, threshold))
    assert {i for a, b in spans for i in range(a, b)} == covered
    assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_entropy_spans_and_their_allow_list():
    scanner = secrets.Scanner(secrets.Scan())
    key = "qT7xR2mK9vB4nW8zL3pY6cHd"
    assert scanner.spans(f"é {key}.") == [(2, 3, 2 + len(key))]
    for harmless in ("internationalisierungsbehoerde", "123e4567-e89b-12d3-a456-426614174000", "qT7xR2mK9vEXAMPLEzL3pY6cHd", "-" * 60, "20240101123456789012345"):
        assert not [s for s in scanner.spans(harmless) if s[1] == 3]


def test_entropy_class_of_a_part_after_a_name():
    scanner = secrets.Scanner(secrets.Scan())
    rng = random.Random(7)
    for name in ("SIGNING_KEY=", "signing-key/", "KEY_"):
        for _ in range(200):
            key = "".join(rng.choices("0123456789ABCDEF", k=64))
            covered = {i for a, k, b in scanner.spans(f"{name}{key} end") if k == 3 for i in range(a, b)}
            alone = {i for a, k, b in scanner.spans(key) if k == 3 for i in range(a, b)}
            assert {i - len(name) for i in covered} >= alone and len(alone) > 50
    assert not [s for s in scanner.spans("order_id=20240101123456789012345") if s[1] == 3]


def test_stand_in_words_hide_their_own_part_only():
    scanner = secrets.Scanner(secrets.Scan())
    key = "Zq8R3vT1mK9sLw2PzX7dHb4Yc6NfGa5J"
    for before, after in (("/api/example/callback/key=", ""), ("", "/EXAMPLE"), ("placeholder=", "-changeme"), ("example" + "a" * 60, "")):
        text = f"{before}{key}{after}"
        covered = {i for a, k, b in scanner.spans(text) if k == 3 for i in range(a, b)}
        assert covered >= set(range(len(before), len(before) + len(key)))
    for harmless in ("path/qT7xR2mK9vEXAMPLEzL3pY6cHd/of", "exampleexample-placeholder-qT7xR2mK9vchangemeL3pY6cHd", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxx"):
        assert scanner.spans(harmless) == []


@pytest.mark.parametrize("joint", ["-", "/", "=", "_", "+-", "-a", "A/", "-aB_"])
def test_long_runs_of_joints_end(joint):
    scanner = secrets.Scanner(secrets.Scan())
    for text in (joint * (1_000_000 // len(joint)) + "7" * 27, "7q" + joint * (1_000_000 // len(joint)), "-" * 29 + "9" * 27):
        start = time.perf_counter()
        scanner.threshold(text)
        assert time.perf_counter() - start < 1
    start = time.perf_counter()
    for boundary in ("-" * 1_000_000 + "20240101123456789012345", "-" * 29 + "293582696224464812345678901"):
        assert not [x for x in scanner.spans(boundary) if x[1] == 3]
    assert time.perf_counter() - start < 10


def naive_entropy_spans(text, window=20):
    """Entropy spans by plain loops: runs, parts with a stand-in word cut out, each window judged anew."""
    joints, widest = set("+/_=-"), set(string.ascii_letters + string.digits + "+/_=-")
    classes = [(set(string.digits), 9.9), (set(string.hexdigits), 2.9), (set(string.ascii_uppercase + "234567"), 3.7), (widest, 3.8)]

    def parts(run):
        out, at = [], 0
        for i, c in enumerate([*run, "-"]):
            if c in joints:
                out.append((at, run[at:i]))
                at = i + 1
        return out

    def threshold(run):
        words = [p for _, p in parts(run)]
        if all(p[1:] == "" or (p[0].isalpha() and all(c in string.ascii_lowercase for c in p[1:])) for p in words) and not any(p[:1].isdigit() for p in words):
            return None
        if all(c in string.ascii_uppercase for p in words for c in p):
            return None
        if re.fullmatch("-".join(f"[0-9a-fA-F]{{{n}}}" for n in (8, 4, 4, 4, 12)), run):
            return None
        return next(t for members, t in classes if set(run) <= members)

    covered = set()
    for run in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        hidden = [False] * len(run.group())
        for at, part in parts(run.group()):
            if re.search("example|placeholder|changeme|xxxxxx", part, re.I):
                assert len(part) <= 40, "longer parts keep what is far from the word"
                hidden[at : at + len(part)] = [True] * len(part)
                for step, i in ((-1, at - 1), (1, at + len(part))):
                    while 0 <= i < len(hidden) and run.group()[i] in joints:
                        hidden[i] = True
                        i += step
        for piece in re.finditer("o+", "".join("x" if h else "o" for h in hidden)):
            whole = run.group()[piece.start() : piece.end()]
            limit = threshold(whole)
            if limit is None:
                continue
            for at in range(len(whole) - window + 1):
                part = whole[at : at + window]
                least = limit
                for start, name in parts(whole):
                    if start <= at and at + window <= start + len(name) and (own := threshold(name)) is not None:
                        least = min(least, own)
                if -sum(n / window * math.log2(n / window) for n in Counter(part).values()) >= least - 1e-9:
                    first = run.start() + piece.start() + at
                    covered |= set((first + i, first + i + 1) for i in range(window))
    out = []
    for a, b in sorted(covered):
        if out and out[-1][1] == a:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def test_entropy_spans_equal_a_naive_scan():
    rng = random.Random(8)
    scanner = secrets.Scanner(secrets.Scan())
    alphabets = ["0123456789", "0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567", string.ascii_letters + string.digits, string.ascii_lowercase]
    for _ in range(600):
        pieces = []
        for _ in range(rng.randint(1, 5)):
            pieces.append("".join(rng.choices(rng.choice(alphabets), k=rng.choice([3, 19, 20, 21, 34]))) if rng.random() < 0.8 else rng.choice(["example", "Placeholder9", "word", "Word"]))
            pieces.append(rng.choice(["-", "/", "=", "_", "--", " ", "é"]))
        text = "".join(pieces)
        assert [(a, b) for a, k, b in scanner.spans(text) if k == 3] == naive_entropy_spans(text), text



CHAT = [
    (1, 0, "user", "a <|im_end|> b"), (1, 1, "user", "more <\\|x"), (1, 2, "assistant", "yes\n"), (1, 3, "assistant", None),
    (2, None, None, "no role"), (2, 5, "tool\n<|im_sep|>", ""), (2, 5, "tool\n<|im_sep|>", ""), (2, 5, "assistant", "tie"),
    (None, 1, "assistant", "<" * 5 + "|" * 3), (3, 0, "assistant", LONG + "<|im_sep|>"),
]


def test_chat(spark, monkeypatch):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("mine"))
    formatted = chat.format_chat(df)
    read = formatted.select("conv_id", chat.read_chat(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted")
    got = {r.conv_id: ([(t.role, t.text) for t in r.t], r.l) for r in read.collect()}
    by = {}
    for conv, turn, role, text in CHAT:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        assert got[conv] == (turns, "".join(x for r, x in turns if r == "assistant"))
    first = next(r.formatted for r in read.collect() if r.conv_id == 1)
    assert first == (
        "<|im_start|>user\na <\\|im_end|> b<|im_sep|>more <\\\\|x<|im_end|>\n<|im_start|>assistant\nyes\n<|im_sep|><|im_end|>\n"
    )
    monkeypatch.setattr(chat, "BLOCK", 2)
    assert plain(chat.format_chat(df), "conv_id", "loss_spans") == plain(formatted, "conv_id", "loss_spans")
    assert chat.chat_digests(chat.format_chat(df.limit(0))).count() == 0


def brute_top(vectors, queries, k):
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def test_top_k(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.9]) for _ in range(rng.choice([3, 4]))]) for i in range(120)]
    bad = [(500, None), (501, [0.1, None]), (502, [float("nan")]), (503, [float("inf")]), (None, [0.1])]
    twice = [(0, [9.0, 9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows + bad + twice, "vec_id long, embedding array<float>").withColumn("shard", F.lit("mine"))
    vectors = {i: [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)] for i, v in rows}
    queries = [i for i in vectors if i % 10 == 0]
    want = brute_top(vectors, queries, 5)
    columns = ["query_id", "rank", "vec_id", "score"]
    monkeypatch.setattr(top_k, "FAN_IN", 2)
    monkeypatch.setattr(top_k, "CELLS", 64)
    for shard, block in ((10_000, 10_000), (16, 4)):
        assert plain(top_k.top_k(df, lambda i: i % 10 == 0, shard=shard, block=block), *columns) == want
    few = df.where("vec_id IN (10, 20, 31)")
    assert plain(top_k.top_k(few, lambda i: i % 10 == 0), *columns) == brute_top({i: vectors[i] for i in (10, 20, 31)}, [10, 20], 5)
    assert top_k.top_k(df.limit(0), lambda i: i % 10 == 0).count() == 0


def test_top_k_of_every_row(spark, monkeypatch):
    """Rows that repeat an id are candidates of their own, but for the query's id; equal to all pairs in plain code."""
    rng = random.Random(6)
    rows = [(rng.choice([1, 10, 20, 7, *range(60)]), [rng.choice([-0.5, 0.0, 0.25, 0.9]) for _ in range(3)]) for _ in range(300)]
    rows += [(1, [9.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0])] + [(10, [0.5, 0.5, 0.5])] * 60 + [(5, None), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("mine"))
    usable = [(i, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)]) for i, v in rows if i is not None and v]
    want = []
    for q in sorted({i for i, _ in usable if i % 10 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(u, v)), c) for i, u in usable if i == q for c, v in usable if c != q)
        want += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:5], 1)]
    monkeypatch.setattr(top_k, "FAN_IN", 2)
    for shard, block in ((10_000, 10_000), (16, 4)):
        got = top_k.top_k(df, lambda i: i % 10 == 0, shard=shard, block=block, every_row=True)
        assert plain(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)


def test_top_k_beyond_floating_point(spark):
    rows = [(0, [1.0e15, 3.0]), (1, [1.0e15, 1.0]), (2, [1.0e15, 2.0]), (3, [1.0e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r["rank"]) for r in top_k.top_k(df, lambda i: i == 0).collect()]
    assert sorted(got) == [(1, 1), (2, 2), (3, 3)]


TARGETS = {"source": {"a": 0.5, "b": 0.2, "c": 0.3}, "lang": {"en": 0.6, "de": 0.4, "xx": 1.0}}


def test_mixing_reaches_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 30) + "x", rng.choice(["en", "en", "de"]), rng.choice("aaabbc"), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mix(df, targets=TARGETS, sweeps=5).cache()
    whole = mixed.agg(F.sum(F.col("mix_tokens") * F.col("mix_probability"))).first()[0]
    for margin, wanted in (("source", TARGETS["source"]), ("lang", {"en": 0.375, "de": 0.25})):
        total = sum(wanted.values())
        for r in mixed.groupBy(margin).agg(F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("w"), F.sum(F.when(F.col("mix_kept"), F.col("mix_tokens"))).alias("k")).collect():
            assert r.w / whole == pytest.approx(wanted[r[0]] / total, abs=1e-3)
    kept = mixed.agg(F.sum(F.when(F.col("mix_kept"), F.col("mix_tokens")))).first()[0]
    assert kept == pytest.approx(whole, rel=0.1)
    assert mixed.agg(F.max("mix_probability")).first()[0] == pytest.approx(1.0)


def test_mixing_to_a_budget(spark, nothing):
    """One small document of a new source and language is kept whole and costs the others nothing."""
    rng = random.Random(4)
    rows = [(i, "w " * 30 + "x", rng.choice(["en", "en", "de"]), rng.choice("aaabbc"), 0) for i in range(3000)]
    df = spark.createDataFrame([*rows, (9999, "FIVE WORDS OF ANOTHER KIND", "xx", "stray", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mix(df, kept_share=0.95).cache()
    weight = F.col("mix_tokens") * F.col("mix_probability")
    kept = mixed.agg(F.sum(weight) / F.sum("mix_tokens"), F.max("mix_probability"), F.min("mix_probability")).first()
    assert kept[0] == pytest.approx(0.95, abs=1e-3) and kept[1] <= 1 and kept[2] > 0.8
    assert mixed.where("source = 'stray'").first().mix_probability == 1
    wide = mixing.mix(df, targets=TARGETS, kept_share=0.3).groupBy("source").agg(F.sum(weight).alias("w")).collect()
    got = {r.source: r.w / sum(x.w for x in wide) for r in wide}
    assert [got[v] for v in "abc"] == pytest.approx([0.5, 0.2, 0.3], abs=1e-3) and not got["stray"]
    assert mixing.mix(nothing, kept_share=0.5).count() == 0
    assert corpus_pipeline.mix_sources(spark, df, "").count() > 0.9 * len(rows)


@pytest.mark.parametrize("share", [None, 0.01])
def test_mixing_of_near_diagonal_sources_is_within_tolerance(spark, share):
    """Sources that are nearly all in one language need many sweeps; a fixed number of them would not do."""
    rows, at = [], 0
    for source in range(4):
        for lang in range(4):
            for _ in range(497 if source == lang else 1):
                rows.append((at, "w " * 10, f"l{lang}", f"s{source}", 0))
                at += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wanted = {"source": {f"s{i}": 0.25 for i in range(4)}, "lang": {f"l{i}": x for i, x in enumerate((0.31, 0.23, 0.23, 0.23))}}
    tolerance = 1e-4 * (share or 1)
    mixed = mixing.mix(df, targets=wanted, kept_share=share, tolerance=tolerance).cache()
    weight = F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("w")
    whole = mixed.agg(weight).first()[0]
    for margin, shares in wanted.items():
        got = {r[0]: r.w / whole for r in mixed.groupBy(margin).agg(weight).collect()}
        assert all(abs(got[v] - x) < 4e-4 for v, x in shares.items())
    if share:
        assert whole / (10 * at) == pytest.approx(share, rel=1e-3)


def test_mixing_tells_targets_that_exclude_each_other(spark):
    rows = [(i, "one two", "en" if i % 2 else "de", "a" if i % 2 else "b", 0) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    with pytest.warns(UserWarning, match="targets are met up to"):
        mixing.mix(df, targets={"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "de": 0.9}}, sweeps=4)


def test_mixing_edge_rows(docs, crowded, nothing, monkeypatch):
    added = ["doc_id", "text", "mix_tokens", "mix_topic", "mix_probability", "mix_kept"]
    plainly = plain(mixing.mix(docs, sweeps=2), *added)
    assert len(plainly) == docs.count() and all(0 <= r[4] <= 1 for r in plainly)
    assert {r[3] for r in plainly if r[0] in (1, 2, 3)} == {"none"} and {r[5] for r in plainly if r[0] in (1, 2, 3)} == {False}
    wide = mixing.mix(crowded, sweeps=2)
    assert set(crowded.columns) <= set(wide.columns) and wide.where("chance = 'mine' AND topic = 'mine'").count() == docs.count()
    assert plain(wide, *added) == plainly
    assert mixing.mix(nothing).count() == 0
    monkeypatch.setattr(mixing.skew, "fits_broadcast", lambda *_, **__: False)
    again = plain(mixing.mix(docs, sweeps=2), *added)
    assert [r[:4] + r[5:] for r in again] == [r[:4] + r[5:] for r in plainly]


def sentences(spark):
    words = {"en": "the river and house with of", "fr": "le fleuve et la maison avec", "de": "der fluss und das haus mit"}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=rng.randint(4, 60))), lang) for i in range(240) for lang in [["en", "fr", "de"][i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_edge_rows(spark, docs, crowded, nothing):
    net = language.fit(sentences(spark), F.lit(True), steps=120)
    found = language.identify(crowded, net)
    assert set(found.columns) == set(crowded.columns)
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect() if r.doc_id}
    assert [got[d] for d in (1, 2, 3, 13)] == [("und", 0.0)] * 4
    assert got[4][0] == "en" and all(0 <= s <= 1 for _, s in got.values()) and got[14][0] in net.languages
    assert plain(found, "doc_id", "lang_pred", "score") == plain(language.identify(docs, net), "doc_id", "lang_pred", "score")
    assert found.where("spans = 'mine'").count() == docs.count()
    assert language.identify(nothing, net).count() == 0
    assert language.fit(nothing, F.lit(True)) is None
    assert plain(language.identify(docs, None), "lang_pred", "score") == [("und", 0.0)] * docs.count()


def test_language_does_not_depend_on_neighbours_or_cuts(monkeypatch):
    rng = np.random.default_rng(1)
    net = language.Network.fresh(["a", "b"], 4, rng)
    texts = [bytes(rng.integers(65, 90, n, dtype=np.uint8)) for n in (0, 1, 223, 224, 225, 1000, 5000)]
    alone = np.concatenate([language.predict(net, [t])[0] for t in texts])
    together, votes = language.predict(net, texts)
    assert np.allclose(alone, together) and votes.sum(axis=1).tolist() == [len(t) for t in texts]


def test_language_gradients():
    rng = np.random.default_rng(2)
    net = language.Network.fresh(["a", "b", "c"], 3, rng)
    net.table, net.recur, net.out = (w.astype(np.float32) for w in (net.table, net.recur, net.out))
    x, y = rng.integers(0, 256, (7, 5), dtype=np.uint8), np.array([0, 1, 2, 1, 0])
    weight = np.full((7, 5), 1 / 35, np.float32)
    _, grads = net.gradients(x, y, weight)
    for w, g in zip(net.weights(), grads):
        for place in zip(*[rng.integers(0, s, 6) for s in w.shape]):
            if w is net.table:
                place = (*place[:2], int(x[place[0], place[1]]), place[3])
            kept, step = w[place], 1e-2
            w[place] = kept + step
            up, _ = net.gradients(x, y, weight)
            w[place] = kept - step
            down, _ = net.gradients(x, y, weight)
            w[place] = kept
            assert (up - down) / (2 * step) == pytest.approx(float(g[place]), abs=2e-3)


def test_quality(spark, docs, crowded, nothing):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choices("river house garden letter window".split(), k=20)), 1) for i in range(60)]
    poor = [(100 + i, f"spam{i % 5} " * 20, 0) for i in range(40)]
    df = spark.createDataFrame(good + poor, "doc_id long, text string, quality int")
    model = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality"), F.lit(True))
    scores = {r.doc_id: r.score for r in quality.score_quality(df.select("doc_id", "text"), model).collect()}
    assert min(scores[d] for d, *_ in good) > max(scores[d] for d, *_ in poor)
    wide = quality.score_quality(crowded, model)
    assert set(wide.columns) == set(crowded.columns) - {"text"} and wide.where("ids = 'mine'").count() == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in wide.collect())
    assert quality.score_quality(nothing, model).count() == 0
    assert quality.fit(nothing, df.select("doc_id", "quality"), F.lit(True)) is None
    assert plain(quality.score_quality(docs, None), "score") == [(0.5,)] * docs.count()


def test_quality_of_a_text_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(3)
    slopes = rng.normal(size=quality.BUCKETS).astype(np.float32)
    texts = [t.encode() for t in ("", "a", "ab ab", " x \n y", "same same", "same", "Ünï côdé 日本", "word " * 50)]
    alone = [quality.score_texts(slopes, 0.1, [t])[0] for t in texts]
    assert quality.score_texts(slopes, 0.1, texts) == pytest.approx(alone, abs=1e-9)
    bags = [quality.bag(t, quality.BUCKETS) for t in texts]
    assert [1 / (1 + math.exp(-(float(slopes[i] @ s) + 0.1))) for i, s in bags] == pytest.approx(alone, abs=1e-4)


def scalar_labels(net, text):
    """Probabilities of every byte by scalar loops; each block starts anew, a little before its first byte."""
    core, context, h, out = language.CORE, language.CONTEXT, net.out.shape[0] // 2, []
    for start in range(0, len(text), core):
        window = [text[i] if 0 <= i < len(text) else 0 for i in range(start - context, start + core + context)]
        states = {}
        for d in (0, 1):
            state = [0.0] * h
            for t in range(len(window)) if d == 0 else range(len(window) - 1, -1, -1):
                z, n = (
                    [max(-1.0, min(1.0, float(net.table[d, g, window[t], u]) + sum(state[v] * float(net.recur[d, g, v, u]) for v in range(h)))) for u in range(h)]
                    for g in (0, 1)
                )
                state = [(s + b + a * (s - b)) / 2 for s, a, b in zip(state, z, n)]
                states[d, t] = state
        for t in range(context, context + min(core, len(text) - start)):
            both = states[0, t] + states[1, t]
            e = [math.exp(float(net.bias[c]) + sum(x * float(net.out[u, c]) for u, x in enumerate(both))) for c in range(len(net.languages))]
            out.append([x / sum(e) for x in e])
    return out


def test_language_equals_a_scalar_loop():
    rng = np.random.default_rng(7)
    net = language.Network.fresh(["a", "b", "c"], 3, rng)
    text = ("Ab é1 — “Größe” 日本 😀 ﬁn. " * 12).encode()
    letters = [c.isalpha() for c in text.decode() for _ in c.encode()]
    each = scalar_labels(net, text)
    want = np.array([p for p, ok in zip(each, letters) if ok]).mean(axis=0)
    p, votes = language.predict(net, [text])
    assert p[0] == pytest.approx(want, abs=1e-4) and votes.sum() == sum(letters)
    assert language.letter_bytes(text).tolist() == letters


def test_language_of_a_text_of_several_pieces(monkeypatch):
    """Borders of pieces see their neighbours, so a long text is labelled as if it were one piece."""
    rng = np.random.default_rng(8)
    net = language.Network.fresh(["a", "b"], 4, rng)
    text = bytes(rng.integers(97, 122, 5 * language.CORE + 50, dtype=np.uint8))
    whole = language.predict(net, [text])
    monkeypatch.setattr(language, "TOGETHER", 1)
    cut = language.predict(net, [text])
    assert np.allclose(whole[0], cut[0], atol=1e-6) and (whole[1] == cut[1]).all()


def test_language_sample_is_spread_over_many_languages(spark, monkeypatch):
    rows = [(i, f"word number {i} of a text", f"l{i % 700}") for i in range(2100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    windows = language.sample_windows(df, F.lit(True), per_language=2)
    assert len({lang for lang, _ in windows}) > 500
    monkeypatch.setattr(language, "MOST_DOCUMENTS", 100)
    assert 30 < len(language.sample_windows(df, F.lit(True))) / language.WINDOWS < 250
    net = language.fit(df, F.lit(True), steps=1)
    assert len(net.languages) > 30 and language.identify(df.limit(5), net).count() == 5


def naive_features(text, buckets):
    """Buckets of a text from its bytes, one n-gram, word and word pair at a time, in whole numbers."""
    blank, wide, out = set(b" \t\n\x0b\x0c\r"), 1 << 64, Counter()
    data, shift = b" " + text + b" ", 64 - (buckets - 1).bit_length()
    multiplier = int(quality.MULTIPLIER)
    for n in quality.NGRAMS:
        for at in range(len(data) - n + 1):
            if not any(b in blank for b in data[at + 1 : at + n - 1]):
                h = n
                for b in data[at : at + n]:
                    h = (h * 259 + b + 1) % wide
                out[(h * multiplier % wide) >> shift] += 1
    words = data.split()
    for word in words:
        h = len(word)
        for place, b in enumerate(word):
            term = (b + 1) * (2 * place + 1) * multiplier % wide
            term = (term ^ (term >> 29)) * 0xBF58476D1CE4E5B9 % wide
            h += term
        out[(h % wide * multiplier % wide) >> shift] += 1
    out.update(0 if a == b else 1 for a, b in zip(words, words[1:]))
    return out


def test_quality_equals_a_dictionary_of_features():
    rng = np.random.default_rng(4)
    slopes = rng.normal(size=1 << 10).astype(np.float32)
    for text in ("", " ", "a", "the the cat", "Größe — 日本 x", "word " * 30, "a\tb\nab ab\rab"):
        found = naive_features(text.encode(), len(slopes))
        logit = sum(float(slopes[b]) * n for b, n in found.items()) / max(1, sum(found.values())) + 0.2
        assert quality.score_texts(slopes, 0.2, [text.encode()])[0] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-6)


def test_quality_sample_is_not_starved_by_a_long_text(spark):
    rows = [(i, f"text number {i} " * 5, i % 2) for i in range(300)] + [(1000, "long " * 700_000, 1), (1001, "long " * 200_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    found = quality.sample_labelled(df.select("doc_id", "text"), df.select("doc_id", "quality"), F.lit(True))
    assert len(found) == 302 and max(len(t) for _, t in found) == quality.SAMPLE_CHARS
