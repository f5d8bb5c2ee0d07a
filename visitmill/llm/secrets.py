"""Secrets in texts: fixed forms, and spans of high entropy.

Besides the fixed forms, runs of secret-like characters are candidates. A window slides over each; the
counts of its characters change by one in and one out, and so does the entropy. Windows at or over the
threshold of the character class make a span, unless the run is on the allow-list. The class is that of the
run; a window within one part between joints (``JOINTS``) takes that part's class where it asks for less.
A part that holds a word of a stand-in is left out; what stands before and after it are runs of their own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.llm.common import extended, query, slices, table

# The forms of the contract. The first is looked up in text with A-Z as a-z.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "entropy"]
BASE = KINDS[:3]
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
# Characters that glue names, values and path segments to one run.
JOINTS = "+/_=-"
# Characters of its part that a stand-in word takes with it, on each side.
STAND_IN_REACH = 40

SPANS = "spans array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class CharacterClass:
    """Characters of a kind of secret, and the bits per character from which a window is one."""

    characters: str
    threshold: float


@dataclass(frozen=True)
class Scan:
    """Window length, classes (a run or part belongs to the first that holds it), runs that are no secrets."""

    window: int = 20
    classes: tuple[CharacterClass, ...] = (
        CharacterClass("0-9", 9.9),
        CharacterClass("0-9a-fA-F", 2.9),
        CharacterClass("A-Z2-7", 3.7),
        CharacterClass("A-Za-z0-9+/_=-", 3.8),
    )
    allowed: tuple[str, ...] = field(
        default=(
            # words, also joined; paths and identifiers of words; lines of one sign; UUIDs. Each step takes all it can and
            # gives nothing back, so a match is one walk over the run, however many joints it has.
            r"[+/_=-]*+[A-Za-z]?+[a-z]*+(?:[+/_=-]++[A-Za-z]?+[a-z]*+)*+",
            r"[+/_=-]*+[A-Z]*+(?:[+/_=-]++[A-Z]*+)*+",
            r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
        )
    )
    # Words, in any case, of values that stand in for a secret; only their part of a run is none.
    stand_ins: tuple[str, ...] = ("example", "placeholder", "changeme", "xxxxxx")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms: leftmost matches per kind, too short ones left out."""
    lower = text.encode().lower().decode()
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, lower) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in re.finditer(ACCESS, text) if m.end() - m.start() >= MIN_ACCESS]
    # A run starts where no hex digit stands before it; so the shorter ones need no match of their own.
    runs = re.finditer(rf"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}", text)
    return found + [(m.start(), 2, m.end()) for m in runs]


def hot_windows(run: str, window: int, threshold: float | Sequence[float]) -> Iterator[tuple[int, int]]:
    """Merged windows of at least ``threshold`` bits per character, by counts that change step by step.

    A sequence has the threshold of each window.
    """
    if len(run) < window:
        return
    limits = [threshold] * (len(run) - window + 1) if isinstance(threshold, (int, float)) else threshold
    terms = [0.0, *(n * math.log2(n) for n in range(1, window + 1))]
    counts: dict[str, int] = {}
    for c in run[:window]:
        counts[c] = counts.get(c, 0) + 1
    total = sum(terms[n] for n in counts.values())
    whole = math.log2(window)
    start = end = -1
    for at in range(len(run) - window + 1):
        if at:
            gone, new = run[at - 1], run[at + window - 1]
            if gone != new:
                n = counts[gone]
                counts[gone] = n - 1
                m = counts.get(new, 0)
                counts[new] = m + 1
                total += terms[n - 1] - terms[n] + terms[m + 1] - terms[m]
        if whole - total / window >= limits[at] - 1e-9:
            if start < 0:
                start = at
            elif at > end:
                yield start, end
                start = at
            end = at + window
    if start >= 0:
        yield start, end


class Scanner:
    """A :class:`Scan` with its patterns compiled."""

    def __init__(self, scan: Scan):
        widest = scan.classes[-1].characters
        self.scan = scan
        self.runs = re.compile(rf"(?<![{widest}])[{widest}]{{{scan.window},}}")
        self.classes = [(re.compile(f"[{c.characters}]+"), c.threshold) for c in scan.classes]
        self.allowed = [re.compile(a) for a in scan.allowed]
        self.parts = re.compile(rf"[^{re.escape(JOINTS)}]{{{scan.window},}}")
        self.stand_in = re.compile("|".join(map(re.escape, scan.stand_ins)), re.IGNORECASE) if scan.stand_ins else None
        self.before = re.compile(rf"[{re.escape(JOINTS)}]*[^{re.escape(JOINTS)}]*\Z")
        self.after = re.compile(rf"[^{re.escape(JOINTS)}]*[{re.escape(JOINTS)}]*")

    def pieces(self, run: str) -> Iterator[tuple[int, str]]:
        """(start, piece): what is left of ``run`` without the parts that hold a stand-in word, and their joints."""
        at = 0
        for word in self.stand_in.finditer(run) if self.stand_in else ():
            low, high = min(word.start(), max(at, word.start() - STAND_IN_REACH)), min(len(run), word.end() + STAND_IN_REACH)
            if (start := self.before.search(run, low, word.start()).start()) > at:
                yield at, run[at:start]
            at = max(at, self.after.match(run, word.end(), high).end())
        if at < len(run):
            yield at, run[at:]

    def threshold(self, run: str) -> float | None:
        """Threshold of the first class that holds ``run``; None if it is on the allow-list."""
        if any(a.fullmatch(run) for a in self.allowed):
            return None
        return next(t for c, t in self.classes if c.fullmatch(run))

    def limits(self, run: str) -> float | list[float] | None:
        """Threshold of ``run``, or of each of its windows where parts have lower ones."""
        whole = self.threshold(run)
        if whole is None:
            return None
        found = [(m.start(), m.end(), self.threshold(m.group())) for m in self.parts.finditer(run)]
        lower = [f for f in found if f[2] is not None and f[2] < whole]
        if not lower:
            return whole
        limits = [whole] * (len(run) - self.scan.window + 1)
        for start, end, threshold in lower:
            many = end - start - self.scan.window + 1
            limits[start : start + many] = [threshold] * many
        return limits

    def entropy_spans(self, text: str) -> list[tuple[int, int, int]]:
        out = []
        for match in self.runs.finditer(text):
            for at, piece in self.pieces(match.group()):
                limits = self.limits(piece) if len(piece) >= self.scan.window else None
                if limits is not None:
                    at += match.start()
                    out += [(at + a, 3, at + b) for a, b in hot_windows(piece, self.scan.window, limits)]
        return out

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        return sorted(base_spans(text) + self.entropy_spans(text))


def find_secrets(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", scan: Scan | None = None
) -> DataFrame:
    """``id_column`` and ``spans``: kind, start and end (code points, end exclusive) by start and kind.

    One row per row of ``docs``, in one pass without shuffle; whole texts are read, in time that grows with their
    length. A null text is empty and has no spans; rows that repeat an id or a text get a row each; an empty
    table gives no rows. Spans that start together stand by kind. Other columns are not read.
    """
    chosen = scan or Scan()
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scanner.spans(t or "")]
                    for t in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["id", "spans"])

    return named.mapInArrow(run, extended(named.select("id").schema, SPANS)).withColumnRenamed("id", id_column)


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op5_secrets(spark, folder):
    """Every document with its secrets counted and listed."""
    found = find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
