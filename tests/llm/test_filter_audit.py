from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from visitmill.llm import filter_audit as audit

from .conftest import plain

LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    first = {}
    for d, text, *_ in rows:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    out = []
    for d, text, _, source, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": d is not None and d > first[text],
        }
        out.append((d, source or "", {f for f, v in fails.items() if v}))
    return out


def brute(rows, labels):
    good, toxic = ({d for d, *l in labels if l[i] == 1} for i in (0, 1))
    out, parts = [], {}
    for d, part, fails in failures(rows):
        parts.setdefault(part, []).append((d, fails))
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                every = [x for x in docs if f in x[1]]
                lines.append((part, "".join(order), step, len(left), len(gone), len(every) - len(gone),
                              sum(x[1] == {f} for x in docs), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), f))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out, key=repr)


COLUMNS = ["part", "filter_order", "step", *audit.NUMBERS]


def test_edge_rows(spark, docs, crowded, nothing, rows):
    labels = [(4, 1, 0), (4, 0, 1), (6, 1, None), (10, None, 1), (None, 1, 1), (99, 1, 1), (12, 0, 0), (7, 1, 1)]
    table = spark.createDataFrame(labels, LABELS)
    want = brute(rows, [x for x in labels if x[0] is not None])
    assert plain(audit.filter_audit(audit.mask_cells(docs, table)), *COLUMNS) == want
    clash = table.withColumn("id", F.lit("mine")).withColumn("mask", F.lit("mine"))
    assert plain(audit.filter_audit(audit.mask_cells(crowded, clash)), *COLUMNS) == want
    assert audit.filter_audit(audit.mask_cells(nothing, table)).count() == 0
    none = [(*r[:7], 0, 0, r[9]) for r in want]
    assert plain(audit.filter_audit(audit.mask_cells(docs, table.limit(0))), *COLUMNS) == sorted(none, key=repr)


def test_random_texts(spark):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        words = rng.choices([*"abcdefgh", "Hot", "X#", "é"], k=rng.choice([3, 49, 50, 80])) + [f"w{j}" for j in range(rng.choice([0, 30, 120]))]
        rows.append((i // 2 if i % 7 == 0 else i, rng.choice([" ", "\n", "\x0b \t"]).join(words), "en", rng.choice(["a", "b", None, ""]), 0))
    rows += [(200 + i, "the same text", "en", "a", 0) for i in range(60)]
    labels = [(i, rng.choice([0, 1]), rng.choice([0, 1])) for i in range(0, 260, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert plain(audit.filter_audit(audit.mask_cells(df, spark.createDataFrame(labels, LABELS))), *COLUMNS) == brute(rows, labels)


def test_gray_walk_gives_all_subsets():
    rng = random.Random(1)
    cells = {m: (rng.randint(0, 9), rng.randint(0, 5)) for m in rng.sample(range(32), 20)}
    for subset, state in enumerate(audit.gray_walk(cells, 5)):
        assert state == tuple(sum(c[k] for m, c in cells.items() if not m & subset) for k in range(2))
    assert audit.gray_walk({}, 2) == [(0, 0, 0)] * 4


def test_words_of_long_texts(monkeypatch):
    text = b"one two\x0bthree one \x1f \xc2\xa0two " * 50
    whole = audit.words_of(text)
    monkeypatch.setattr(audit, "LONG_TEXT", 10)
    assert audit.words_of(text) == whole == (len(text.split()), len(set(text.split())))
