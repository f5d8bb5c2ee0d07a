from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitmill.llm import queries, toxicity

from .conftest import LONG, plain


def planted_votes(rng, n=4000):
    """Votes of voters with known accuracies; the fifth copies the fourth nine times out of ten."""
    y = rng.random(n) < 0.3
    accuracies, votes = [0.9, 0.8, 0.75, 0.7, 0.7], np.zeros((n, 5), np.int8)
    for j, a in enumerate(accuracies):
        right = np.where(rng.random(n) < a, y, ~y)
        votes[:, j] = np.where(rng.random(n) < 0.7, np.where(right, toxicity.TOXIC, toxicity.CLEAN), toxicity.ABSTAIN)
    copied = rng.random(n) < 0.9
    votes[copied, 4] = votes[copied, 3]
    return y, votes, accuracies


def test_label_model_finds_accuracies_and_links():
    y, votes, accuracies = planted_votes(np.random.default_rng(4))
    model = toxicity.fit_label_model(votes)
    assert [{a, b} for a, b, _ in model.links] == [{3, 4}]
    assert model.accuracies(votes)[:3] == pytest.approx(accuracies[:3], abs=0.06)
    right = ((model.posterior(votes) > 0.5) == y).mean()
    most = (((votes == toxicity.TOXIC).sum(axis=1) > (votes == toxicity.CLEAN).sum(axis=1)) == y).mean()
    assert right > 0.85 and right > most


def texts_and_labels():
    rng = np.random.default_rng(6)
    words = np.array("river house garden letter window table street paper flower water".split())
    texts, labels = [], []
    for i in range(400):
        text = rng.choice(words, 30).tolist()
        if i % 4 == 0:
            text[int(rng.integers(30))] = ["idiot", "zorgulix", "Zorguland", "scum"][i // 4 % 4]
        texts.append(" ".join(text))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_classifier_learns_words_that_no_list_holds():
    texts, labels = texts_and_labels()
    finder = toxicity.Finder(toxicity.train(texts[:300], labels[:300]))
    assert all((finder.score(t) >= 0.7) == y for t, y in zip(texts[300:], labels[300:]))
    assert finder.score("zorgulo") >= 0.7 > finder.score("zebra") and finder.score(LONG + " idiot " + LONG) >= 0.7 > finder.score(LONG)


def test_lists_alone_teach_without_labels():
    texts, _ = texts_and_labels()
    finder = toxicity.Finder(toxicity.train(texts, [None] * len(texts)))
    assert finder.score("you idiot") > finder.score("a garden by the river")


def test_scores_equal_a_plain_search(monkeypatch):
    weights = {" ab": 1.0, " abc ": 0.5, " é": -0.25, " x1 ": 2.0}
    finder = toxicity.Finder(toxicity.Classifier(weights, -1.0))
    for size in (3, toxicity.PIECE):
        monkeypatch.setattr(toxicity, "PIECE", size)
        for text in ("", "ab", "abc", "cab", "ABC-abd", "x1_É", "x1x", "  \n", "été Abc x1", "_ab ab" * 9):
            words = re.findall(r"[^\W_]+", text.lower())
            logit = -1 + sum(w for t, w in weights.items() if any(v == t.strip() if t.endswith(" ") else v.startswith(t.strip()) for v in words))
            assert finder.score(text) == pytest.approx(1 / (1 + np.exp(-logit)))
    assert toxicity.Finder(toxicity.Classifier({}, 0.0)).score("any") == 0.5


def test_edge_rows(spark, docs, crowded, nothing):
    texts, labels = texts_and_labels()
    known = spark.createDataFrame(list(zip(range(400), texts, labels)), "doc_id long, text string, toxic int")
    classifier = toxicity.fit(known.select("doc_id", "text"), known.select("doc_id", "toxic"), F.lit(True))
    wide = toxicity.score_toxicity(crowded, classifier)
    assert set(wide.columns) == set(crowded.columns) - {"text"} and wide.where("ids = 'mine'").count() == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in wide.collect())
    got = {r.doc_id: r.score for r in wide.collect()}
    assert got[1] == got[2] == got[3] and plain(wide, "doc_id", "score") == plain(toxicity.score_toxicity(docs, classifier), "doc_id", "score")
    assert toxicity.score_toxicity(nothing, classifier).count() == 0
    empty = known.select("doc_id", "toxic").limit(0)
    assert toxicity.fit(nothing, empty, F.lit(True)) is None and toxicity.fit(docs, empty, F.lit(True)) is not None
    assert plain(toxicity.score_toxicity(docs, None), "score", "predicted") == [(0.0, 0)] * docs.count()


def test_query_on_held_out_rows(spark, small):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = queries.QUERIES["op11_toxicity"](spark, small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.85 * len(held)
