"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network is trained here, in numpy, by backpropagation through time on a bounded sample of windows.
Each direction is a light gated unit with hard (clipped) gates:

    z = clip(Wz[byte] + Uz h, -1, 1);  n = clip(Wn[byte] + Un h, -1, 1);  h' = (h + n + z (h - n)) / 2

A softmax over both directions labels every byte, and the mean over the bytes of letters is the
probability of the document. Texts are cut into blocks, each with some bytes of context on both sides, so
that many blocks run side by side and a very long text needs no more memory than a short one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import bounded_batches, extended, held_out, query, slices, table, uniform
from visitmill.session import cut_lineage

# The sample that is learned from: documents per language, windows per document, characters per window.
DOCUMENTS, WINDOWS, WINDOW_CHARS = 500, 3, 96
# Documents of all languages together; where there are many languages, each gives fewer.
MOST_DOCUMENTS = 100_000
HIDDEN, STEPS, BATCH, RATE, SEED = 8, 350, 256, 0.02, 7
# Bytes of a block, context on each side, blocks that run together, bytes of text taken at a time.
CORE, CONTEXT, TOGETHER, SLICE_BYTES = 224, 16, 2048, 4 * 1024 * 1024
UNKNOWN = "und"

# Whether a code point below 2^16 is a letter.
LETTERS = np.array([chr(c).isalpha() for c in range(1 << 16)])


def letter_bytes(text: bytes) -> np.ndarray:
    """1 for each byte of a letter, else 0; bytes that are no UTF-8, as at the ends of a cut, are none."""
    data = np.frombuffer(text, np.uint8)
    if text.isascii():
        return LETTERS[data].astype(np.float32)
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lengths = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    if int(lengths.sum()) != len(data):
        # Broken characters are told apart byte by byte.
        broken = text.decode("utf-8", "surrogateescape")
        points = np.array([ord(c) for c in broken], np.uint32)
        escaped = (points >= 0xDC80) & (points <= 0xDCFF)
        lengths = np.where(escaped, 1, 1 + (points > 0x7F).astype(int) + (points > 0x7FF) + (points > 0xFFFF))
    known = np.where(points < 1 << 16, LETTERS[np.minimum(points, 0xFFFF)], False)
    for at in np.flatnonzero(points >= 1 << 16):
        known[at] = chr(points[at]).isalpha()
    return np.repeat(known.astype(np.float32), lengths)


@dataclass
class Network:
    """Weights: byte tables and recurrences by direction (0 onward, 1 backward) and gate (0 z, 1 n)."""

    languages: list[str]
    table: np.ndarray  # 2, 2, 256, h
    recur: np.ndarray  # 2, 2, h, h
    out: np.ndarray  # 2h, languages
    bias: np.ndarray  # languages

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
        f = np.float32
        return cls(
            languages,
            rng.normal(0, 0.3, (2, 2, 256, hidden)).astype(f),
            rng.normal(0, 0.5 / np.sqrt(hidden), (2, 2, hidden, hidden)).astype(f),
            rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(f),
            np.zeros(len(languages), f),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.recur, self.out, self.bias]

    def _direction(self, x: np.ndarray, d: int, gates: np.ndarray | None = None) -> np.ndarray:
        """States (T, B, h) after each byte of ``x`` (T, B), in the order of ``x``; keeps the gates if asked."""
        steps, blocks = x.shape
        (wz, wn), (uz, un) = self.table[d], self.recur[d]
        h = wz.shape[1]
        states = np.empty((steps, blocks, h), np.float32)
        state = np.zeros((blocks, h), np.float32)
        own = np.empty((2, blocks, h), np.float32)
        onward = np.empty((2, blocks, h), np.float32)
        diff = np.empty((blocks, h), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            a = own if gates is None else gates[t]
            wz.take(x[t], axis=0, out=a[0], mode="clip")
            wn.take(x[t], axis=0, out=a[1], mode="clip")
            np.matmul(state, uz, out=onward[0])
            np.matmul(state, un, out=onward[1])
            a += onward
            np.minimum(a, 1, out=a)
            np.maximum(a, -1, out=a)
            np.subtract(state, a[1], out=diff)
            diff *= a[0]
            diff += state
            diff += a[1]
            state = np.multiply(diff, 0.5, out=states[t])
        return states

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (T, B, languages) of every byte."""
        h = self.out.shape[0] // 2
        logits = self._direction(x, 0) @ self.out[:h]
        logits += self._direction(x, 1) @ self.out[h:]
        logits += self.bias
        np.minimum(logits, 30, out=logits)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True) + 1e-30
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and its gradients for windows ``x`` (T, B) of classes ``y``; ``weight`` (T, B) sums to 1."""
        steps, blocks = x.shape
        h = self.out.shape[0] // 2
        gates = [np.empty((steps, 2, blocks, h), np.float32) for _ in range(2)]
        states = [self._direction(x, d, gates[d]) for d in range(2)]
        both = np.concatenate(states, axis=2)
        logits = both @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        loss = float(-(np.log(p[:, np.arange(blocks), y] + 1e-9) * weight).sum())
        p[:, np.arange(blocks), y] -= 1
        p *= weight[:, :, None]
        flat = p.reshape(-1, p.shape[2])
        grads = [np.zeros_like(w) for w in self.weights()]
        grads[2][:] = both.reshape(-1, 2 * h).T @ flat
        grads[3][:] = flat.sum(axis=0)
        down = p @ self.out.T
        for d in range(2):
            order = range(steps - 1, -1, -1) if d == 0 else range(steps)
            carried = np.zeros((blocks, h), np.float32)
            into = np.empty((2, steps, blocks, h), np.float32)
            for t in order:
                before = t - 1 if d == 0 else t + 1
                last = states[d][before] if 0 <= before < steps else np.zeros((blocks, h), np.float32)
                z, n = gates[d][t]
                g = (carried + down[t, :, d * h : (d + 1) * h]) * 0.5
                dz = g * (last - n) * (np.abs(z) < 1)
                dn = g * (1 - z) * (np.abs(n) < 1)
                carried = g * (1 + z) + dz @ self.recur[d, 0].T + dn @ self.recur[d, 1].T
                grads[1][d, 0] += last.T @ dz
                grads[1][d, 1] += last.T @ dn
                into[0, t], into[1, t] = dz, dn
            for gate in range(2):
                for unit in range(h):
                    grads[0][d, gate, :, unit] = np.bincount(x.ravel(), into[gate, :, :, unit].ravel(), 256)
        return loss, grads


def train(windows: list[tuple[str, bytes]], *, hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED) -> Network:
    """A network from (language, window) pairs, by Adam on balanced batches."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in windows})
    net = Network.fresh(languages, hidden, rng)
    if len(languages) < 2:
        return net
    # Windows have one length in characters; in bytes they differ by script.
    width = max(len(window) for _, window in windows)
    x, letters = np.zeros((len(windows), width), np.uint8), np.zeros((len(windows), width), np.float32)
    for i, (_, window) in enumerate(windows):
        x[i, : len(window)] = np.frombuffer(window, np.uint8)
        letters[i, : len(window)] = letter_bytes(window)
    y = np.array([languages.index(lang) for lang, _ in windows])
    by_class = [np.flatnonzero(y == c) for c in range(len(languages))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    for step in range(1, steps + 1):
        classes = rng.integers(0, len(languages), BATCH)
        rows = np.array([by_class[c][rng.integers(len(by_class[c]))] for c in classes])
        batch = np.ascontiguousarray(x[rows].T)
        weight = np.ascontiguousarray(letters[rows].T)
        weight /= max(1.0, weight.sum())
        _, grads = net.gradients(batch, y[rows], weight)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * (1 - 0.9 * step / steps)
        for w, g, (m, v) in zip(net.weights(), grads, moments):
            g *= min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def sample_windows(docs: DataFrame, learn, *, per_language: int = DOCUMENTS) -> list[tuple[str, bytes]]:
    """At most about ``per_language`` documents of each language, cut to windows at hashed places.

    ``docs`` has ``doc_id, text, lang``. The rate of each language follows from its count, so that the
    sample is spread over all rows. Where there are so many languages that this would be more than ``MOST_DOCUMENTS``, each gives
    its share of those; what reaches the driver is bounded by the parameters.
    """
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = cut_lineage(usable.groupBy("lang").agg(F.count("*").alias("n")))
    languages = counts.count()
    if not languages:
        return []
    each = min(per_language, MOST_DOCUMENTS / languages)
    rated = skew.lookup_join(usable.select("doc_id", "text", "lang"), counts, ["lang"], row_id=["doc_id"], how="inner", keys_from=usable.select("lang"))
    chosen = rated.where(uniform(SEED, "doc_id", "text") < F.lit(float(each)) / F.col("n"))
    room = F.greatest(F.length("text") - WINDOW_CHARS, F.lit(0)) + 1
    places = [F.floor(uniform(SEED + 1 + i, "doc_id", "text") * room).cast("int") + 1 for i in range(WINDOWS)]
    cut = F.array(*[F.substr(F.col("text"), p, F.lit(WINDOW_CHARS)) for p in places])
    rows = chosen.select("lang", cut.alias("cut")).limit(2 * int(max(1, each) * languages) + 100).collect()
    return sorted((r.lang, w.encode()) for r in rows for w in r.cut)


def _blocks(pieces: list[tuple[bytes, bytes, bytes, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All blocks of the pieces as (T, B), the piece of each block, and the weight of each byte.

    A piece is what stands before it, its bytes, what stands after them, and their weights.
    """
    parts, weights, owner = [], [], []
    for i, (before, piece, after, letters) in enumerate(pieces):
        n = -(-len(piece) // CORE)
        end = after[:CONTEXT] if n * CORE == len(piece) else b""
        parts.append(before.rjust(CONTEXT, b"\0") + piece + bytes(n * CORE - len(piece)) + end.ljust(CONTEXT, b"\0"))
        weights += [letters, np.zeros(n * CORE - len(piece), np.float32)]
        owner.append(np.full(n, i))
    buffer = np.frombuffer(b"".join(parts), np.uint8)
    first, at = [], CONTEXT
    for part in parts:
        first.append(np.arange(at, at + len(part) - 2 * CONTEXT, CORE))
        at += len(part)
    starts = np.concatenate(first) if first else np.zeros(0, int)
    x = buffer[(starts[None, :] - CONTEXT) + np.arange(CORE + 2 * CONTEXT)[:, None]]
    flat = np.concatenate(weights) if weights else np.zeros(0, np.float32)
    return x, np.concatenate(owner) if owner else np.zeros(0, int), flat.reshape(-1, CORE).T


def predict(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each text, and how many of its letter bytes got each label."""
    many = len(net.languages)
    sums, votes = np.zeros((len(texts), many)), np.zeros((len(texts), many), np.int64)
    held: list[tuple] = []
    # Probabilities are held for all languages, so many languages leave room for fewer blocks at a time.
    together = max(16, TOGETHER * 16 // max(16, many))

    def run() -> None:
        x, owner, weight = _blocks([piece for _, *piece in held])
        owner = np.array([i for i, *_ in held])[owner]
        for a in range(0, x.shape[1], together):
            p = net.labels(np.ascontiguousarray(x[:, a : a + together]))[CONTEXT : CONTEXT + CORE]
            w = weight[:, a : a + together]
            best = p.argmax(axis=2)
            for c in range(many):
                np.add.at(sums[:, c], owner[a : a + together], (p[:, :, c] * w).sum(axis=0, dtype=np.float64))
                np.add.at(votes[:, c], owner[a : a + together], ((best == c) * w).sum(axis=0).astype(np.int64))
        held.clear()

    size = 0
    step = CORE * TOGETHER
    for i, text in enumerate(texts):
        letters = letter_bytes(text)
        for at in range(0, len(text), step):
            # A piece of a very long text sees its neighbours at both ends, as any block does.
            end = at + step
            held.append((i, text[max(0, at - CONTEXT) : at], text[at:end], text[end : end + CONTEXT], letters[at:end]))
            size += min(step, len(text) - at)
            if size >= step:
                run()
                size = 0
    if held:
        run()
    total = sums.sum(axis=1, keepdims=True)
    return sums / np.where(total > 0, total, 1), votes


def _labelling(net: Network) -> Callable:
    schema = pa.map_(pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                lettered = part.column("lettered").to_pylist()
                texts = [t.encode() if ok else b"" for t, ok in zip(part.column("text").to_pylist(), lettered)]
                p, votes = predict(net, texts)
                best = p.argmax(axis=1)
                langs = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                scores = [float(min(1.0, p[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered))]
                counts = [[(lang, int(n)) for lang, n in zip(net.languages, row) if n] for row in votes]
                kept = part.drop_columns(["text", "lettered"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, schema)],
                    names=[*kept.schema.names, "lang_pred", "score", "letters"],
                )

    return run


def fit(docs: DataFrame, learn, *, per_language: int = DOCUMENTS, steps: int = STEPS) -> Network | None:
    """Train on the rows of ``docs`` (``doc_id, text, lang``) where ``learn`` holds; None if there are none."""
    windows = sample_windows(docs, learn, per_language=per_language)
    return train(windows, steps=steps) if windows else None


def identify(docs: DataFrame, net: Network | None, *, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its probability) and ``letters`` (letter bytes per label).

    One pass, no shuffle, whole texts. A text that is null or without letter is ``und`` with score 0, and
    so is any text where there was nothing to learn from. Rows that repeat an id or a text get a row each, equal texts the same result; an empty
    table gives no rows. Columns of these three names are replaced; all
    others stay, clashing ones included.
    """
    added = ("lang_pred", "score", "letters")
    others = [c for c in docs.columns if c not in added]
    if net is None:
        empty = F.lit(None).cast("map<string,bigint>")
        kept = docs.select(*[F.col(f"`{c}`") for c in others])
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "letters": empty})
    bounded_batches(docs.sparkSession)
    text = F.col(f"`{text_column}`")
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others) if c != text_column],
        text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    keeps_text = text_column in others
    carried = inner.withColumn("same", F.col("text")) if keeps_text else inner
    schema = extended(carried.drop("text", "lettered").schema, "lang_pred string, score double, letters map<string,bigint>")
    found = carried.mapInArrow(_labelling(net), schema)
    named = [F.col("same" if c == text_column else f"c{i}").alias(c) for i, c in enumerate(others)]
    return found.select(*named, *added)


@query()
def op2_language_id(spark, folder):
    """Every document with the language of its whole text; learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    out = held_out("doc_id", 5, 0)
    net = fit(docs.select("doc_id", "text", "lang"), ~out & F.col("doc_id").isNotNull())
    named = docs.select("doc_id", out.alias("held_out"), "text")
    return identify(named, net).select("doc_id", "held_out", "lang_pred", "score")
