"""Toxicity by weak supervision.

Many voters look at a text: word lists, patterns, and terms that labelled texts suggest. Each votes toxic or clean,
or abstains. A generative label model finds, by expectation maximisation, how
often each is right and which of them repeat each other; known labels are one more voter, trusted by a stated share. Its posteriors are
the soft labels that a sparse linear classifier over terms learns from. Only that classifier scores texts.

All of it is learned in numpy from a bounded sample of labelled rows; every whole text is scored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.common import extended, held_out, query, sample_window, slices, table, uniform

# The sample: documents per class (without labels, twice as many of all), and code points of each; a longer text counts
# with a window of that length.
DOCUMENTS, SAMPLE_CHARS, SEED = 2000, 32 * 1024, 23
# Terms: beginnings of words of these lengths, and whole words; in at least so many sampled texts.
PREFIXES, MIN_TEXTS = (3, 4, 5, 6, 7), 4
TERMS, TERM_VOTERS, PRECISION = 4000, 48, 0.8
# Of the label model: rounds for each link, nats from which two voters are linked, share of known labels held to be right.
ROUNDS, LINK, TRUST = 12, 0.05, 0.98
STEPS, MORE_STEPS, PENALTY = 150, 1500, 2e-5  # of the classifier
THRESHOLD = 0.7
# Code points that are looked at at a time.
PIECE = 1 << 20

ABSTAIN, TOXIC, CLEAN = 0, 1, 2

# Word lists of the voters, per language.
LEXICONS = {
    "english": "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting clown imbecile "
    "retard dumb filthy vermin jerk bastard bitch fool freak garbage pig",
    "german": "idiot idioten dumm dummkopf trottel abschaum depp arschloch widerlich ekelhaft wertlos versager drecksack "
    "schwachkopf miststück blödmann hurensohn",
    "french": "idiot idiote imbécile crétin connard salaud ordure débile minable abruti pourriture dégoûtant raté bouffon",
    "spanish": "idiota imbécil estúpido estúpida basura escoria asqueroso patético inútil payaso cretino tonto cabrón perdedor",
}
PATTERNS = {
    "address": re.compile(r"\b(?:you|du|tu|vous|eres|usted)\b.{0,20}\b(?:idiot|moron|scum|trash|loser|stupid|dumm|imbécil|crétin)", re.I),
    "go_away": re.compile(r"\b(?:shut up|go to hell|get lost|drop dead|halt.s maul|ferme.la|cállate)\b", re.I),
    "masked": re.compile(r"\b[A-Za-z]{1,3}[*@#$%]{2,6}[A-Za-z]{0,3}\b"),
    "shouts": re.compile(r"!{2,}"),
    "capitals": re.compile(r"\b[A-Z]{4,}\b(?:\W+\b[A-Z]{4,}\b){3}"),
}
WORD = re.compile(r"[^\W_]+")
GAPS = re.compile(r"[\W_]+")


def words_in(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def terms_of(words: set[str]) -> set[str]:
    """``" abc"`` for words that begin with abc, ``" abc "`` for the word itself."""
    found = {f" {w} " for w in words if len(w) >= PREFIXES[0]}
    for n in PREFIXES:
        found.update(f" {w[:n]}" for w in words if len(w) >= n)
    return found


@dataclass
class Presence:
    """Which terms are in which texts: sorted pairs (text, term number)."""

    terms: list[str]
    texts: np.ndarray
    columns: np.ndarray
    many: int

    @classmethod
    def of(cls, texts: Sequence[str]) -> Presence:
        # What may be frequent is found by counts of hashes first, so that the many rare terms are never held.
        mask = (1 << 22) - 1
        buckets = np.zeros(mask + 1, np.int32)
        for text in texts:
            found = terms_of(words_in(text))
            np.add.at(buckets, np.fromiter((hash(t) & mask for t in found), np.int64, len(found)), 1)
        number: dict[str, int] = {}
        rows, columns = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for i, text in enumerate(texts):
            often = [number.setdefault(t, len(number)) for t in terms_of(words_in(text)) if buckets[hash(t) & mask] >= MIN_TEXTS]
            rows.append(np.full(len(often), i, np.int32))
            columns.append(np.array(often, np.int32))
        at, held = np.concatenate(rows), np.concatenate(columns)
        counts = np.bincount(held, minlength=len(number))
        terms = sorted(t for t, n in number.items() if counts[n] >= MIN_TEXTS)
        place = np.full(len(number), -1, np.int32)
        place[[number[t] for t in terms]] = np.arange(len(terms), dtype=np.int32)
        kept = place[held] >= 0
        return cls(terms, at[kept], place[held[kept]], len(texts))

    def weigh(self, weight: np.ndarray) -> np.ndarray:
        """Per term the weight of the texts that hold it."""
        return np.bincount(self.columns, weight[self.texts], len(self.terms))

    def distinct(self, chosen: np.ndarray) -> np.ndarray:
        """``chosen`` without terms that stand in just the texts of another one; the longest beginning of words stays."""
        number = np.full(len(self.terms), -1)
        number[chosen] = np.arange(len(chosen))
        kept = number[self.columns] >= 0
        # Two sums of random numbers tell the sets of texts apart.
        marks = np.random.default_rng(SEED).integers(0, 1 << 62, (2, self.many), dtype=np.int64)
        sums = np.zeros((2, len(chosen)), np.int64)
        for total, mark in zip(sums, marks):
            np.add.at(total, number[self.columns[kept]], mark[self.texts[kept]])
        best: dict[tuple, int] = {}
        for i, term in enumerate(chosen.tolist()):
            key = (int(sums[0, i]), int(sums[1, i]))
            name = self.terms[term]
            held = best.get(key)
            if held is None or (not name.endswith(" "), len(name), name) > (not (h := self.terms[held]).endswith(" "), len(h), h):
                best[key] = term
        return np.array(sorted(best.values()), np.int64)

    def column(self, term: int) -> np.ndarray:
        held = np.zeros(self.many, bool)
        held[self.texts[self.columns == term]] = True
        return held


def suggested_terms(presence: Presence, toxic: np.ndarray, clean: np.ndarray) -> list[int]:
    """Terms that cover the toxic texts, each chosen for those that the ones before it miss."""
    if not presence.terms or not toxic.any():
        return []
    hits, misses = presence.weigh(toxic.astype(float)), presence.weigh(clean.astype(float))
    # Classes are sampled alike, so these are shares of their classes.
    precision = (hits + 0.5) / (hits + misses * max(1.0, toxic.sum()) / max(1.0, clean.sum()) + 1)
    length = np.array([len(t) for t in presence.terms])
    open_, chosen = toxic.astype(float), []
    least = max(3, 0.002 * toxic.sum())
    while len(chosen) < TERM_VOTERS:
        fresh = presence.weigh(open_)
        value = np.where((precision >= PRECISION) & (fresh >= least), fresh * precision**8, 0)
        best = value.max()
        if not best:
            break
        # Among equals the longest, which says least about other words.
        ties = np.flatnonzero(value >= best * (1 - 1e-9))
        term = int(ties[np.argmax(length[ties])])
        chosen.append(term)
        open_[presence.column(term)] = 0
    return chosen


def cast_votes(texts: Sequence[str], presence: Presence, suggested: Sequence[int]) -> tuple[np.ndarray, list[str]]:
    """Votes (text × voter) and the voters' names."""
    columns, names = [], []
    lists = {name: set(words.split()) for name, words in LEXICONS.items()}
    every = set().union(*lists.values())
    words = [words_in(t) & every for t in texts]
    for name, listed in lists.items():
        columns.append([TOXIC if w & listed else ABSTAIN for w in words])
        names.append(f"list:{name}")
    for name, pattern in PATTERNS.items():
        columns.append([TOXIC if pattern.search(t) else ABSTAIN for t in texts])
        names.append(f"pattern:{name}")
    for term in suggested:
        columns.append(np.where(presence.column(term), TOXIC, ABSTAIN))
        names.append(f"term:{presence.terms[term]}")
    votes = np.array(columns, np.int8).T.reshape(len(texts), len(names))
    calm = np.where((votes == TOXIC).any(axis=1), ABSTAIN, CLEAN)
    quiet = [CLEAN if "!" not in t and not PATTERNS["capitals"].search(t) else ABSTAIN for t in texts]
    return np.column_stack([votes, calm, np.array(quiet, np.int8)]).astype(np.int8), [*names, "none:terms", "none:shouts"]


@dataclass
class LabelModel:
    """Share of toxic texts, a tree of linked voters, and per voter the chance of each vote by class and parent's vote."""

    prior: float
    parents: list[int]
    tables: list[np.ndarray]  # class × vote of the parent × vote
    links: list[tuple[int, int, float]]  # voter, its parent, nats they share within a class

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, (parent, chances) in enumerate(zip(self.parents, self.tables)):
            above = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int8)
            logs += np.log(chances[:, above, votes[:, j]]).T
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(axis=1)

    def accuracies(self, votes: np.ndarray) -> list[float]:
        """Per voter the estimated share of its votes that are right, abstentions left out."""
        p = self.posterior(votes)
        right = [(p * (v == TOXIC)).sum() + ((1 - p) * (v == CLEAN)).sum() for v in votes.T]
        return [float(r / max(1, (v != ABSTAIN).sum())) for r, v in zip(right, votes.T)]


def _tables(votes: np.ndarray, p: np.ndarray, parents: Sequence[int]) -> list[np.ndarray]:
    out = []
    for j, parent in enumerate(parents):
        above = votes[:, parent].astype(int) if parent >= 0 else np.zeros(len(votes), int)
        cell = above * 3 + votes[:, j]
        counts = np.stack([np.bincount(cell, w, 9).reshape(3, 3) for w in (1 - p, p)]) + 0.1
        out.append(counts / counts.sum(axis=2, keepdims=True))
    return out


def shared_nats(votes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Per pair of voters the information that their votes share within the classes."""
    n, m = votes.shape
    hot = np.zeros((n, m, 3), np.float32)
    hot[np.arange(n)[:, None], np.arange(m)[None, :], votes] = 1
    flat, total = hot.reshape(n, 3 * m), np.zeros((m, m))
    for weight in (1 - p, p):
        mass = max(1e-9, weight.sum())
        joint = ((flat * weight[:, None].astype(np.float32)).T @ flat).reshape(m, 3, m, 3).transpose(0, 2, 1, 3) / mass
        single = np.einsum("iiab->iab", joint).sum(axis=2)
        apart = single[:, None, :, None] * single[None, :, None, :]
        total += mass / n * np.where(joint > 1e-12, joint * np.log(np.maximum(joint, 1e-12) / np.maximum(apart, 1e-12)), 0).sum(axis=(2, 3))
    return total


def rooted(links: Sequence[tuple[int, int, float]], voters: int) -> list[int]:
    """Parent of each voter (-1: none) in the forest that the links make."""
    near: list[list[int]] = [[] for _ in range(voters)]
    for a, b, _ in links:
        near[a].append(b)
        near[b].append(a)
    parents, seen = [-1] * voters, set()
    for start in range(voters):
        todo = [] if start in seen else [start]
        seen.add(start)
        while todo:
            at = todo.pop()
            for other in near[at]:
                if other not in seen:
                    seen.add(other)
                    parents[other] = at
                    todo.append(other)
    return parents


def fit_label_model(votes: np.ndarray, anchors: int = 0) -> LabelModel:
    """Accuracies and links of voters by expectation maximisation; the last ``anchors`` voters are known labels.

    Known labels are right by ``TRUST`` and linked to none.
    The strongest link (from ``LINK`` nats on) between two trees of voters is added, the rest estimated anew, and so on: while one link
    is missing, others seem to be there.
    """
    m = votes.shape[1]
    toward = (votes == TOXIC).sum(axis=1) - 0.5 * (votes == CLEAN).sum(axis=1).astype(float)
    for j in range(m - anchors, m):
        toward += 4.0 * (votes[:, j] == TOXIC) - 4.0 * (votes[:, j] == CLEAN)
    start = 1 / (1 + np.exp(-np.clip(toward, -30, 30)))
    links: list[tuple[int, int, float]] = []
    tree = np.arange(m)
    known = np.full((2, 3, 3), 1 - TRUST)
    known[:, :, ABSTAIN], known[0, :, CLEAN], known[1, :, TOXIC] = 1, TRUST, TRUST
    while True:
        # From the start again, as what was learned without the link may lead elsewhere.
        parents, p = rooted(links, m), start
        for _ in range(ROUNDS):
            tables = [*_tables(votes[:, : m - anchors], p, parents[: m - anchors]), *[known] * anchors]
            model = LabelModel(float(np.clip(p.mean(), 1e-3, 1 - 1e-3)), parents, tables, links)
            p = model.posterior(votes)
        shared = np.where(tree[:, None] != tree[None, :], shared_nats(votes, p), 0)
        shared[m - anchors :] = shared[:, m - anchors :] = 0
        a, b = np.unravel_index(int(np.argmax(shared)), shared.shape)
        if shared[a, b] < LINK:
            return model
        links = [*links, (int(a), int(b), float(shared[a, b]))]
        tree[tree == tree[b]] = tree[a]


@dataclass
class Classifier:
    """Weights of terms, and the bias."""

    weights: dict[str, float]
    bias: float

    def score(self, found: set[str]) -> float:
        logit = self.bias + sum(self.weights[t] for t in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def _descend(x: np.ndarray, weight: np.ndarray, target: np.ndarray, steps: int) -> np.ndarray:
    """Weights of the columns of ``x``, the last of which is the bias."""
    # The largest curvature, by power iteration; the logistic bends a quarter of that at most.
    way, bend = np.ones(x.shape[1], np.float32), 1.0
    for _ in range(20):
        way = x.T @ (weight * (x @ way))
        bend = float(np.linalg.norm(way))
        way /= max(bend, 1e-12)
    step = np.float32(3.5 / max(bend, 1e-6))
    w = look = np.zeros(x.shape[1], np.float32)
    pace = 1.0
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ look, -30, 30)))
        after = look - step * (x.T @ (weight * (q - target)))
        # A term speaks for toxicity or not at all, so a long text does not outweigh what it says.
        after[:-1] = np.maximum(after[:-1] - step * np.float32(PENALTY), 0)
        if float((look - after) @ (after - w)) > 0:
            pace = 1.0  # the momentum leads uphill: start it anew
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        look = after + np.float32((pace - 1) / faster) * (after - w)
        w, pace = after, faster
    return w


def train_classifier(presence: Presence, soft: np.ndarray) -> Classifier:
    """Logistic regression on soft labels, with weights of at least 0 and an L1 penalty, by accelerated proximal steps.

    Both classes weigh the same, so a score is a probability for classes of equal size.
    """
    n = max(1, presence.many)
    inside, outside = presence.weigh(soft), presence.weigh(1 - soft)
    a, b = max(1e-9, soft.sum()), max(1e-9, (1 - soft).sum())
    # The terms that stand in larger shares of the toxic texts, by the statistic of two shares.
    pooled = np.clip((inside + outside) / n, 1e-9, 1 - 1e-9)
    lift = inside / a - outside / b
    apart = np.where(lift > 0, lift**2 / (pooled * (1 - pooled)), 0)
    ranked = np.argsort(-apart, kind="stable")[:TERMS]
    chosen = presence.distinct(ranked[apart[ranked] > 0])
    number = np.full(len(presence.terms), -1)
    number[chosen] = np.arange(len(chosen))
    x = np.zeros((presence.many, len(chosen) + 1), np.float32)
    kept = number[presence.columns] >= 0
    x[presence.texts[kept], number[presence.columns[kept]]] = 1
    x[:, -1] = 1
    weight = ((soft / a + (1 - soft) / b) / 2).astype(np.float32)
    target = (soft / a / 2 / np.maximum(weight, 1e-12)).astype(np.float32)
    w = _descend(x, weight, target, STEPS)
    # The few terms that are left take many more steps, as terms that part the classes cleanly grow slowly.
    left = np.flatnonzero(w[:-1] > 0)
    w = _descend(x[:, [*left, -1]], weight, target, MORE_STEPS)
    chosen = chosen[left]
    weights = {presence.terms[t]: float(v) for t, v in zip(chosen, w[:-1]) if v}
    return Classifier(weights, float(w[-1]))


def train(texts: Sequence[str], labels: Sequence[int | None]) -> Classifier:
    """From texts with a label, 0 or 1, or None: voters, label model, classifier."""
    presence = Presence.of(texts)
    known = np.array([ABSTAIN if y is None else TOXIC if y else CLEAN for y in labels], np.int8)
    votes, _ = cast_votes(texts, presence, suggested_terms(presence, known == TOXIC, known == CLEAN))
    anchors = int((known != ABSTAIN).any())
    if anchors:
        votes = np.column_stack([votes, known])
    return train_classifier(presence, fit_label_model(votes, anchors).posterior(votes))


def pieces(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` code points, cut between words."""
    at = 0
    while at < len(text):
        gap = GAPS.search(text, at + size) if at + size < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


class Finder:
    """Finds the classifier's terms in texts in one pass over each."""

    def __init__(self, classifier: Classifier):
        import ahocorasick

        self.classifier = classifier
        self.automaton = ahocorasick.Automaton()
        for term in classifier.weights:
            self.automaton.add_word(term, term)
        if classifier.weights:
            self.automaton.make_automaton()

    def score(self, text: str) -> float:
        found: set[str] = set()
        if self.classifier.weights:
            for piece in pieces(text, PIECE):
                found.update(term for _, term in self.automaton.iter(f" {GAPS.sub(' ', piece.lower())} "))
        return self.classifier.score(found)


def sample_labelled(docs: DataFrame, labels: DataFrame, learn, *, per_class: int = DOCUMENTS) -> tuple[list[str], list[int | None]]:
    """Texts of a bounded sample and their labels.

    About ``per_class`` documents of each class; an id with several labels counts as toxic if one says so. Without labels of both classes, twice as many
    documents of any kind, with the labels there are left out. A text over ``SAMPLE_CHARS`` counts with one window.
    """
    marked = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    named = docs.select("doc_id", "text").where(F.length("text") > 0)
    if len(counts) == 2:
        chance = F.when(F.col("toxic") == 0, per_class / counts[0]).otherwise(per_class / counts[1])
        # About two times per_class ids: a bounded table, so it may go to every task.
        bounded = marked.where(uniform(SEED, "doc_id") < chance).limit(4 * per_class)
        rows = named.join(F.broadcast(bounded), "doc_id")
    else:
        rows = named.withColumn("toxic", F.lit(None).cast("int"))
    total = rows.count()
    share = (4 if len(counts) == 2 else 2) * per_class / max(1, total)
    chosen = rows.where(uniform(SEED + 1, "doc_id", "text") < share)
    found = chosen.select("doc_id", "toxic", sample_window("text", SAMPLE_CHARS, SEED).alias("text")).collect()
    found = sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text))
    return [r.text for r in found], [r.toxic for r in found]


def fit(docs: DataFrame, labels: DataFrame, learn, *, per_class: int = DOCUMENTS) -> Classifier | None:
    """Train on labelled rows where ``learn`` (on the labels' columns) holds; None where there are no texts."""
    texts, known = sample_labelled(docs, labels, learn, per_class=per_class)
    return train(texts, known) if texts else None


def _scoring(classifier: Classifier, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(classifier)
        for batch in batches:
            for part in slices(batch, "text"):
                scores = [finder.score(t or "") for t in part.column("text").to_pylist()]
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                    names=[*kept.schema.names, "score", "predicted"],
                )

    return run


def score_toxicity(docs: DataFrame, classifier: Classifier | None, *, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without its text, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    One pass over whole texts, no shuffle; equal texts get equal scores, in every row that holds them. A null text
    is empty; an empty text, or one without a learned term, gets the score of the bias alone. Without a classifier every score is 0. An empty
    table gives no rows. Columns called ``score`` or ``predicted`` are replaced, all others stay.
    """
    others = [c for c in docs.columns if c not in (text_column, "score", "predicted")]
    if classifier is None:
        plain = docs.select(*[F.col(f"`{c}`") for c in others], F.lit(0.0).alias("score"))
        return plain.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text_column}`").alias("text"))
    schema = extended(inner.drop("text").schema, "score double, predicted int")
    scored = inner.mapInArrow(_scoring(classifier, threshold), schema)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "score", "predicted")


@query()
def op11_toxicity(spark, folder):
    """Every document with the score of its whole text; learned from labelled rows that are not held out."""
    docs, out = table(spark, folder, "documents"), held_out("doc_id", 3, 1)
    classifier = fit(docs, table(spark, folder, "labels"), ~out)
    return score_toxicity(docs.select("doc_id", out.alias("held_out"), "text"), classifier)
