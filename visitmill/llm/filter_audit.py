"""What each filter of a corpus does in any order of the filters, from one pass over the texts.

A document's failures are a mask, a bit per filter. Per part (a source), documents are counted by mask. A Gray
code then walks all subsets of filters, toggling one filter at a time: each mask cell counts how many of the
active filters it fails, and the survivors change by the cells whose counter leaves or reaches zero. The
survivors of every subset are stored; a step of an order is the difference of two subsets.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import query, slices, table
from visitmill.session import cut_lineage

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5  # words, % of the words, % of the code points
SIGNS = b"#$%&*|"
COUNTS = ("n", "good", "toxic")

CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# Texts above this are cut into words piece by piece, so that only distinct words are held.
LONG_TEXT = 8 * 1024 * 1024
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text: bytes) -> tuple[int, int]:
    """Words and distinct words."""
    if len(text) <= LONG_TEXT:
        # A byte split cuts at exactly these blanks.
        every = text.split()
        return len(every), len(set(every))
    seen, n = set(), 0
    for match in WORD.finditer(text):
        n += 1
        seen.add(match.group())
    return n, len(seen)


def text_failures(text: str) -> int:
    """Bits 0 to 3: too few words, too few distinct ones, too many capitals, a sign of markup."""
    raw = text.encode()
    n, distinct = words_of(raw)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    signs = len(raw.translate(None, SIGNS)) < len(raw)
    return (n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * n) << 1 | (100 * capitals > MAX_CAPITALS * len(text)) << 2 | signs << 3


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cut in slices(batch, "text"):
            texts = [t or "" for t in cut.column("text").to_pylist()]
            digests = [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in texts]
            masks = [text_failures(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [cut.column("id"), cut.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=["id", "part", "digest", "mask"],
            )


def mask_cells(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source"
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and failed filters, and how many of them are labelled so.

    ``labels`` has the ids, ``quality`` and ``toxic``; an id with several labels has each that one of them gives.
    A null text is empty, a null part the empty string. Every row is a document. A text is a copy (filter E) if a row with a smaller id holds the
    same one, so rows that share the smallest id are none; nor is a row without id, which is no one's original either.
    """
    named = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text_column}`").alias("text"),
    )
    found = cut_lineage(named.mapInArrow(_masks, "id long, part string, digest binary, mask int"))
    # Rows repeated whole are one row per task before the shuffle.
    rows = cut_lineage(found.where("id IS NOT NULL").groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n")))
    # Hot texts are reduced in each task; the rows then meet their text's first id, a key of few rows.
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    judged = labels.where(F.col(f"`{id_column}`").isNotNull()).groupBy(F.col(f"`{id_column}`").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
    )
    marked = skew.salted_join(rows.join(first, ["digest", "id"], "left"), judged, ["id"], row_id=["digest", "part"], keys_from=rows)
    copy = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    cells = marked.select(
        "part", (F.col("mask") + copy).alias("mask"), "n",
        F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"),
        F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic"),
    )
    zero = F.lit(0).cast("long")
    without = found.where("id IS NULL").select("part", "mask", F.lit(1).cast("long").alias("n"), zero.alias("good"), zero.alias("toxic"))
    return cells.unionByName(without).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def gray_walk(cells: dict[int, tuple[int, ...]], filters: int) -> list[tuple[int, ...]]:
    """Survivors (a sum per count) of every subset of filters, by its bits; ``cells`` maps masks to counts."""
    width = len(next(iter(cells.values()), COUNTS))
    active = dict.fromkeys(cells, 0)
    running = [sum(c[k] for c in cells.values()) for k in range(width)]
    states: list[tuple[int, ...]] = [()] * (1 << filters)
    states[0] = tuple(running)
    subset = 0
    for step in range(1, 1 << filters):
        # The lowest set bit of the step is the one filter that the Gray code toggles.
        toggled = step & -step
        subset ^= toggled
        turn = 1 if subset & toggled else -1
        for mask, counts in cells.items():
            if not mask & toggled:
                continue
            before = active[mask]
            active[mask] += turn
            if not before or not active[mask]:
                for k in range(width):
                    running[k] -= turn * counts[k]
        states[subset] = tuple(running)
    return states


def order_rows(states: Sequence[tuple[int, ...]], cells: dict[int, tuple[int, ...]], filters: str) -> Iterator[tuple]:
    """Per order and step: order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    many = len(filters)
    failing = [sum(c[0] for m, c in cells.items() if m >> f & 1) for f in range(many)]
    alone = [cells.get(1 << f, (0,))[0] for f in range(many)]
    shapley = [0] * many
    for subset in range(1 << many):
        size = subset.bit_count()
        for f in range(many):
            if not subset >> f & 1:
                # Orders in which exactly this subset comes before the filter.
                ways = math.factorial(size) * math.factorial(many - size - 1)
                shapley[f] += ways * (states[subset][0] - states[subset | 1 << f][0])
    for order in itertools.permutations(range(many)):
        name, subset = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            before, after = states[subset], states[subset | 1 << f]
            removed, good, toxic = (b - a for b, a in zip(before, after))
            yield name, step, after[0], removed, failing[f] - removed, alone[f], good, toxic, shapley[f]
            subset |= 1 << f


NUMBERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _walks(filters: str) -> Callable:
    names = ["part", "filter_order", "step", *NUMBERS]
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(NUMBERS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cells = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["cells"]}
                found = list(order_rows(gray_walk(cells, len(filters)), cells, filters))
                columns = [[row["part"]] * len(found), *zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def filter_audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of all ``filters`` and step, with the counts of ``NUMBERS``; zeros included.

    ``cells`` as from :func:`mask_cells`, bit i of ``mask`` for the i-th letter. ``removed`` and ``kept`` are what the step's filter removes
    and leaves, ``redundant`` fail it but were gone, ``unique_fails`` fail it alone, ``good_lost`` and ``toxic_lost``
    are labelled documents among the removed, ``shapley`` is what the filter removes, summed over all orders. An empty table has no parts.
    """
    # At most one cell per mask, so a list of 2 ** filters entries at most.
    listed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return listed.mapInArrow(_walks(filters), "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in NUMBERS))


@query(
    r"""
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts
    ), masks AS (
        SELECT doc_id, part,
               [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
                100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails
        FROM split
    ), judged AS (
        SELECT doc_id, max(quality) FILTER (quality = 1) = 1 AS good, max(toxic) FILTER (toxic = 1) = 1 AS toxic FROM labels GROUP BY doc_id
    ), cells AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM masks LEFT JOIN judged USING (doc_id) GROUP BY part, fails
    ), letters AS (
        SELECT unnest(range(1, 6)) AS f
    ), orders AS (
        SELECT [a.f, b.f, c.f, d.f, e.f] AS fs FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
    ), steps AS (
        SELECT array_to_string(list_transform(fs, lambda x: chr(CAST(64 + x AS INTEGER))), '') AS filter_order, fs, unnest(range(1, 6)) AS step FROM orders
    ), counted AS (
        SELECT part, filter_order, fs[step] AS f, CAST(step AS INTEGER) AS step,
               sum(CASE WHEN NOT list_bool_or(list_transform(fs[1:step], lambda x: fails[x])) THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN fails[fs[step]] AND NOT coalesce(list_bool_or(list_transform(fs[1:step - 1], lambda x: fails[x])), false) THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN fails[fs[step]] AND coalesce(list_bool_or(list_transform(fs[1:step - 1], lambda x: fails[x])), false) THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN fails[fs[step]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN fails[fs[step]] AND NOT coalesce(list_bool_or(list_transform(fs[1:step - 1], lambda x: fails[x])), false) THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN fails[fs[step]] AND NOT coalesce(list_bool_or(list_transform(fs[1:step - 1], lambda x: fails[x])), false) THEN toxic ELSE 0 END) AS toxic_lost
        FROM cells, steps GROUP BY part, filter_order, fs, step
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM counted
    """
)
def op12_filter_audit(spark, folder):
    """Five filters over all documents, in all 120 orders, per source."""
    return filter_audit(mask_cells(table(spark, folder, "documents"), table(spark, folder, "labels")))
