"""Lines that many documents repeat go, except from one document.

Normalised lines are exploded as 128-bit hashes, documents are counted per hash, and the positions of
lines over the threshold come back to their documents. Texts are not shuffled for the count; a line of a
third of all documents is reduced in each task before the shuffle and joined by salted keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import BLANKS, extended, query, slices, table
from visitmill.session import cut_lineage

MIN_CHARS = 20
MIN_DOCUMENTS = 3

LINES = "r1 long, r2 long, doc_id long, at int, h1 long, h2 long"


def line_key(line: bytes) -> bytes:
    """A line without blanks at both ends, A-Z as a-z."""
    return line.strip(BLANKS.encode()).lower()


def long_lines(text: str | None, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """Position and key of each line whose key has at least ``min_chars`` code points."""
    for at, line in enumerate((text or "").encode().split(b"\n")):
        key = line_key(line)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            yield at, key


def _signed(value: int) -> tuple[int, int]:
    return (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)


def hashed_lines(min_chars: int) -> Callable:
    """Task function: a row per long line, ``first`` on the first of its key in the document."""
    schema = pa.schema(
        [("r1", pa.int64()), ("r2", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()),
         ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out: list[list] = [[] for _ in schema]
                for r1, r2, doc_id, text in zip(*[part.column(i).to_pylist() for i in range(4)]):
                    seen = set()
                    for at, key in long_lines(text, min_chars):
                        h = xxhash.xxh3_128_intdigest(key)
                        for column, value in zip(out, (r1, r2, doc_id, at, *_signed(h), h not in seen)):
                            column.append(value)
                        seen.add(h)
                    if len(out[0]) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)
                        out = [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)

    return run


def without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: ``text`` without the lines at the positions in ``drops``; adds the counts."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts, lines, dropped = [], [], []
            for text, drops in zip(part.column("text").to_pylist(), part.column("drops").to_pylist()):
                split = (text or "").split("\n")
                gone = set(drops or ())
                texts.append("\n".join(line for at, line in enumerate(split) if at not in gone) if gone else text)
                lines.append(len(split))
                dropped.append(len(gone))
            kept = part.drop_columns(["text", "drops"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*kept.schema.names, "text", "n_lines", "n_dropped"],
            )


def line_dedup(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    by_id: bool = False,
) -> DataFrame:
    """``docs`` with shortened texts, and ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without blanks at both ends and with A-Z in lower case. Lines whose key has
    at least ``min_chars`` code points and is in at least ``min_documents`` documents go, but for all
    those in the largest id that holds it. Each row is a document, also one that repeats an id; with ``by_id``
    the rows of an id count as one, and each row without id as one of its own. Rows that share the largest id all keep the line, and a null id counts as the smallest. A null or empty text is one empty line, and stays as it is. A
    document whose lines all go is left with an empty text. Columns called ``n_lines`` or ``n_dropped``
    are replaced; all others stay as they are.
    """
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped", text_column)]
    inner = {c: f"c{i}" for i, c in enumerate(others)}
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in inner.items()],
        F.col(f"`{text_column}`").alias("text"),
        F.xxhash64(id_column, text_column).alias("r1"),
        F.xxhash64(F.lit(1), text_column, id_column).alias("r2"),
    )
    id_inner = inner[id_column]
    named = keyed.select("r1", "r2", F.coalesce(F.col(id_inner).cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")
    lines = cut_lineage(named.mapInArrow(hashed_lines(min_chars), f"{LINES}, first boolean"))
    held = lines.where("first").select("h1", "h2", "doc_id", F.lit(1).alias("n"))
    if by_id:
        # Reduced in each task before the shuffle, so a line of many documents is spread by their ids.
        many = F.when(F.col("doc_id") == -(1 << 63), F.count("*")).otherwise(1)
        held = held.groupBy("h1", "h2", "doc_id").agg(many.alias("n"))
    common = cut_lineage(
        held.groupBy("h1", "h2")
        .agg(F.sum("n").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_documents)
        .select("h1", "h2", "keeper")
    )
    hits = skew.lookup_join(lines, common, ["h1", "h2"], row_id=["r1", "r2", "at"], how="inner")
    drops = cut_lineage(
        hits.where(F.col("doc_id") != F.col("keeper")).groupBy("r1", "r2").agg(F.collect_set("at").alias("drops"))
    )
    # Texts meet their positions by shuffle at every size. Only rows repeated whole share a key here; AQE
    # splits those.
    joined = keyed.join(drops, ["r1", "r2"], "left")
    carried = joined.select(*inner.values(), "text", "drops")
    out = extended(carried.select(*inner.values()).schema, "text string, n_lines long, n_dropped long")
    cleaned = carried.mapInArrow(without_lines, out)
    back = {c: F.col(n).alias(c) for c, n in inner.items()} | {text_column: F.col("text").alias(text_column)}
    return cleaned.select(*[back[c] for c in docs.columns if c in back], "n_lines", "n_dropped")


@query(
    r"""
    WITH split AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
    ), lines AS (
        SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM split
    ), keys AS (
        SELECT doc_id, place, line,
               translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ), common AS (
        SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ), marked AS (
        SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keys k LEFT JOIN common c ON k.key = c.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op9_line_dedup(spark, folder):
    """Every document with its lines counted and the digest of what stays."""
    cleaned = line_dedup(table(spark, folder, "documents").select("doc_id", "text"), by_id=True)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))
