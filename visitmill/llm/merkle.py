"""Merkle manifest of a table: a tree per group, and one over the roots of the groups.

A leaf's place in its group comes from bitmaps, not from a sort of the leaves. Ids are bits of 64-bit words;
only words that hold ids exist, and tasks merge theirs before the shuffle. Directories of the words'
popcounts, a level per ``DIRECTORY_BITS``, give what stands before a word; the bits below an id in its word
give the rest. Leaves then fill slot arrays, keyed by group and block, at the slots their places name. A block
of ``2 ** BLOCK_BITS`` slots is reduced by as many levels at a time, and proofs come back down block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import query, remainder, table
from visitmill.session import cut_lineage

BLOCK_BITS, DIRECTORY_BITS = 8, 8

STEPS = "array<struct<before:string,after:string>>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """sha256 (hex) of the values as text: ``-`` for null, else byte count, ``:`` and value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """Root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 (hex) of all siblings in a proof, from the leaf up."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def positions(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number rows from 0 by columns that tell them apart, in sorted ranges; no window over all rows."""
    placed = cut_lineage(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    split = placed.withColumn("_part", F.shiftright("_at", 33))
    # One row per sorted range, so as many as there are partitions.
    sizes = split.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return split.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + inside).drop("_at", "_part", "_before")


def before_words(words: DataFrame, top: int) -> DataFrame:
    """``g, word, before``: how many ids of the group stand in smaller words. Words are from 0 to ``top``."""
    levels = [words.select("g", F.col("word").alias("at"), "n")]
    while top >> DIRECTORY_BITS:
        above = levels[-1].groupBy("g", F.shiftright("at", DIRECTORY_BITS).alias("at"))
        levels.append(cut_lineage(above.agg(F.sum("n").alias("n"))))
        top >>= DIRECTORY_BITS
    found = None
    for level in reversed(levels):
        # A directory holds at most 2 ** DIRECTORY_BITS entries.
        level = level.withColumn("up", F.shiftright("at", DIRECTORY_BITS))
        inside = Window.partitionBy("g", "up").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        local = level.withColumn("local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        if found is None:
            found = local.select("g", "at", F.col("local").alias("before"))
        else:
            base = found.select("g", F.col("at").alias("up"), "before")
            found = local.join(base, ["g", "up"]).select("g", "at", (F.col("before") + F.col("local")).alias("before"))
    return found.withColumnRenamed("at", "word")


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``g, id, digest, row`` and more) with ``at``: the leaf's place in its group, by id and digest.

    Null ids come first. Rows of a repeated id are sorted by digest among themselves, in ranges.
    """
    low, high = leaves.agg(F.min("id"), F.max("id")).first()
    low, high = ((low or 0) >> 6, (high or 0) >> 6)
    spread = leaves.withColumns({
        "word": F.coalesce(F.shiftright("id", 6) - F.lit(low).cast("long") + 1, F.lit(0).cast("long")),
        "bit": F.coalesce(F.col("id").bitwiseAND(F.lit(63)).cast("int"), F.lit(0)),
    })
    # Reduced in each task before the shuffle, so an id that a third of all rows share is one row per task.
    counted = spread.groupBy("g", "word", "bit").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("n")))
    words = cut_lineage(
        counted.groupBy("g", "word").agg(
            F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.sum("n").alias("n"), F.collect_list(more).alias("more")
        )
    )
    ranked = words.join(before_words(words, high - low + 1), ["g", "word"]).drop("n")
    most = words.agg(F.max(F.expr("aggregate(more, 0L, (m, x) -> greatest(m, x.n))"))).first()[0] or 0
    if most < skew.MIN_SALTS:
        met = spread.join(ranked.hint("shuffle_hash"), ["g", "word"])
    else:
        met = skew.salted_join(spread, ranked, ["g", "word"], row_id=["row"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    repeats = F.expr("aggregate(filter(more, x -> x.bit < bit), 0L, (s, x) -> s + x.n)")
    placed = met.withColumn("at", F.col("before") + below + repeats)
    if not most:
        return placed.drop("word", "bit", "bits", "more", "before")
    placed = cut_lineage(placed.withColumn("again", F.expr("exists(more, x -> x.bit = bit)")).drop("word", "bit", "bits", "more", "before"))
    single = placed.where(~F.col("again")).drop("again")
    # Copies of one leaf are alike, so any order of theirs will do; the written row number keeps it the same.
    several = cut_lineage(positions(placed.where("again").drop("again"), ["g", "id", "digest", "row"], "place"))
    starts = several.groupBy("g", "id").agg(F.min("place").alias("start")).withColumn("no_id", F.col("id").isNull())
    keyed = several.withColumn("no_id", F.col("id").isNull()).withColumn("key", F.coalesce("id", F.lit(0).cast("long")))
    starts = starts.select("g", F.coalesce("id", F.lit(0).cast("long")).alias("key"), "no_id", "start")
    joined = skew.lookup_join(keyed, starts, ["g", "key", "no_id"], row_id=["row"])
    moved = joined.withColumn("at", F.col("at") + F.col("place") - F.col("start")).drop("place", "start", "key", "no_id")
    return single.unionByName(moved)


def _hash(left: bytes, right: bytes = b"") -> bytes:
    return hashlib.sha256((left.hex() + right.hex()).encode()).digest()


def levels_of(n: int) -> int:
    """Levels between ``n`` leaves and their root."""
    return (n - 1).bit_length()


def reduced(slots: list[bytes], levels: int) -> list[list[bytes]]:
    """The slots and the ``levels`` levels above them."""
    out = [slots]
    for _ in range(levels):
        below = out[-1]
        out.append([_hash(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def _fill(round_: int) -> Callable:
    """Task function: nodes of one block into a slot array, reduced to one node."""
    bits = BLOCK_BITS

    def run(key: tuple, part: pa.Table) -> pa.Table:
        place = part.column("at").to_numpy() & ((1 << bits) - 1)
        slots = np.empty(len(place), np.int64)
        slots[place] = np.arange(len(place))
        filled = part.take(pa.array(slots))
        n = filled.column("n")[0].as_py()
        digests = filled.column("digest").to_pylist()
        levels = max(0, min(bits, levels_of(n) - bits * round_))
        node = reduced(digests, levels)[-1][0]
        carried = [c for c in filled.column_names if c not in ("g", "n", "at", "block", "digest")]
        row = {"g": key[0].as_py(), "at": key[1].as_py(), "n": n, "digests": digests, "node": node}
        types = {"g": pa.int64(), "at": pa.int64(), "n": pa.int64(), "digests": pa.list_(pa.binary()), "node": pa.binary()}
        for c in carried:
            row[f"{c}s"], types[f"{c}s"] = filled.column(c).to_pylist(), pa.list_(part.schema.field(c).type)
        return pa.table([pa.array([v], types[k]) for k, v in row.items()], names=list(row))

    return run


def _spread(round_: int, carried: Sequence[str], root: str) -> Callable:
    """Task function: a block's nodes as rows again, each with its steps up to the root."""
    bits = BLOCK_BITS
    step = pa.struct([("before", pa.string()), ("after", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                levels = max(0, min(bits, levels_of(block["n"]) - bits * round_))
                tree = [[d.hex() for d in level] for level in reduced(block["digests"], levels)][:levels]
                above = [(s["before"], s["after"]) for s in block["steps"]]
                size = len(block["digests"])
                before, after = [], []
                for i in range(size):
                    for level in tree:
                        other = i ^ 1
                        sibling = level[other] if other < len(level) else ""
                        before.append(sibling if i & 1 else "")
                        after.append("" if i & 1 else sibling)
                        i >>= 1
                    before += [b for b, _ in above]
                    after += [a for _, a in above]
                flat = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(step))
                offsets = np.arange(size + 1, dtype=np.int32) * (levels + len(above))
                first = block["at"] << bits
                columns = {
                    "g": pa.array([block["g"]] * size, pa.int64()), "at": pa.array(range(first, first + size), pa.int64()),
                    "digest": pa.array(block["digests"], pa.binary()),
                    "steps": pa.ListArray.from_arrays(pa.array(offsets), flat), "top": pa.array([block["top"]] * size, pa.binary()),
                }
                for c in carried:
                    columns[c] = pa.array(block[f"{c}s"], batch.schema.field(f"{c}s").type.value_type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _types(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    return {c: df.schema[c].dataType.simpleString() for c in names}


def climb(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Rounds of slot arrays over ``g, n, at, digest`` (and more in the first), until each group has one node.

    ``n`` is the group's number of leaves and ``most`` the largest of them.
    """
    rounds = []
    for round_ in range(max(1, -(-levels_of(most) // BLOCK_BITS))):
        carried = _types(nodes, [c for c in nodes.columns if c not in ("g", "n", "at", "block", "digest")])
        schema = "g long, at long, n long, digests array<binary>, node binary" + "".join(f", `{c}s` array<{t}>" for c, t in carried.items())
        keyed = nodes.withColumn("block", F.shiftright("at", BLOCK_BITS))
        rounds.append(cut_lineage(keyed.groupBy("g", "block").applyInArrow(_fill(round_), schema)))
        nodes = rounds[-1].select("g", "n", "at", F.col("node").alias("digest"))
    return rounds


def descend(rounds: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves of ``rounds`` with ``steps`` and ``top``; ``tops`` has ``g, steps, top`` of each group's root."""
    paths = tops.withColumn("at", F.lit(0).cast("long"))
    for round_ in reversed(range(len(rounds))):
        names = [c for c in rounds[round_].columns if c not in ("g", "at", "n", "digests", "node")]
        carried = [c[:-1] for c in names]
        element = {c: rounds[round_].schema[f"{c}s"].dataType.elementType.simpleString() for c in carried}
        schema = f"g long, at long, digest binary, steps {STEPS}, top binary" + "".join(f", `{c}` {t}" for c, t in element.items())
        met = rounds[round_].drop("node").join(paths.select("g", "at", "steps", "top"), ["g", "at"])
        paths = met.mapInArrow(_spread(round_, carried, "top"), schema)
        if round_:
            paths = cut_lineage(paths)
    return paths


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    *,
    id_column: str = "doc_id",
    group_column: str = "lang",
    other_leaf: Column | None = None,
) -> DataFrame:
    """A row per row of ``docs``: ``id, leaf, leaf_index, subroot, root, proof`` (hex text), and ``other_leaf``.

    A leaf is the digest of ``columns``; leaves of a group stand by id. While a tree has several nodes, every two
    neighbours become the digest of both, a last one without neighbour that of itself. The roots of the groups, a
    null group first, then by the bytes of their names, make a tree of the same kind. ``proof`` has a step per level up to
    ``root``, with what stands before and after the node there (empty where there is no sibling).
    ``other_leaf`` (64 hex digits) is carried along, for instance the leaf of a row as found later.

    Null ids come first in their group. Rows that repeat an id stand by their digests; rows repeated whole get a
    place each. A null text is ``-`` and an empty one ``0:``; a text is only hashed, so it may have any length.
    An empty table gives no rows. Other columns are not read, so their names do not matter.
    """
    spark = docs.sparkSession
    out = f"id long, leaf string, leaf_index long, subroot string, root string, proof {STEPS}, other_leaf string"
    other = F.lit(None).cast("string") if other_leaf is None else other_leaf
    named = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit("")).alias("name"),
        F.unhex(leaf_digest([F.col(f"`{c}`") for c in columns])).alias("digest"),
        F.unhex(other).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    hashed = cut_lineage(named)
    groups = cut_lineage(positions(hashed.groupBy("name").agg(F.count("*").alias("n")), ["name"], "g"))
    many, most = groups.agg(F.count("*"), F.max("n")).first()
    if not many:
        return spark.createDataFrame([], out)
    leaves = cut_lineage(skew.lookup_join(hashed, groups, ["name"], row_id=["row"], how="inner").drop("name"))
    rounds = climb(coordinates(leaves).select("g", "n", "at", "id", "digest", "other"), most)
    subroots = rounds[-1].select(F.lit(0).cast("long").alias("g"), F.lit(many).cast("long").alias("n"), F.col("g").alias("at"), F.col("node").alias("digest"))
    upper = climb(subroots, many)
    root = upper[-1].select("g", F.array().cast(STEPS).alias("steps"), F.col("node").alias("top"))
    # Each group's root: its steps to the root of all, and that root; what a leaf needs is both tops.
    tops = cut_lineage(descend(upper, root).select(F.col("at").alias("g"), "steps", F.concat("digest", "top").alias("top")))
    rows = descend(rounds, tops)
    hexed = lambda c: F.lower(F.hex(c))
    return rows.select(
        "id", hexed("digest").alias("leaf"), F.col("at").alias("leaf_index"),
        hexed(F.substring("top", 1, 32)).alias("subroot"), hexed(F.substring("top", 33, 32)).alias("root"),
        F.col("steps").alias("proof"), hexed("other").alias("other_leaf"),
    )


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


@query(
    """
    WITH RECURSIVE rows_ AS (
        SELECT *, row_number() OVER () AS row_ FROM documents
    ), hashed AS (
        SELECT doc_id, coalesce('=' || lang, '') AS name, row_,
               sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
                   || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-')
                   || coalesce(strlen(text) || ':' || text, '-')) AS tampered
        FROM rows_
    ), crc(k, c) AS (
        SELECT range, range FROM range(256)
    ), crc8 AS (
        SELECT k, list_reduce(list_prepend(c, range(8)), lambda a, b:
            CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM crc
    ), crctab AS (
        SELECT list(v ORDER BY k) AS tab FROM crc8
    ), crcs AS (
        SELECT id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS crc
        FROM (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL), crctab
    ), placed AS (
        SELECT h.*, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf, row_) - 1 AS pos,
               count(*) OVER (PARTITION BY name) AS n
        FROM hashed h
    ), nodes AS (
        SELECT name, 0 AS level, pos, n, leaf AS digest FROM placed
        UNION ALL
        SELECT name, level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(next, '')) FROM (
            SELECT *, lead(digest) OVER (PARTITION BY name ORDER BY pos) AS next FROM nodes WHERE n > 1
        ) WHERE pos % 2 = 0
    ), subroots AS (
        SELECT name, row_number() OVER (ORDER BY name) - 1 AS pos, count(*) OVER () AS n, level AS height, digest FROM nodes WHERE n = 1
    ), tops AS (
        SELECT 0 AS level, pos, n, digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(next, '')) FROM (
            SELECT *, lead(digest) OVER (ORDER BY pos) AS next FROM tops WHERE n > 1
        ) WHERE pos % 2 = 0
    ), steps AS (
        SELECT p.row_, x.level, (p.pos >> x.level) & 1 AS side, s.digest AS sibling
        FROM placed p JOIN subroots r ON p.name = r.name, LATERAL (SELECT unnest(range(r.height)) AS level) x
        LEFT JOIN nodes s ON s.name = p.name AND s.level = x.level AND s.pos = xor(p.pos >> x.level, 1)
        UNION ALL
        SELECT p.row_, r.height + x.level, (r.pos >> x.level) & 1, s.digest
        FROM placed p JOIN subroots r ON p.name = r.name, LATERAL (SELECT unnest(range((SELECT max(level) FROM tops))) AS level) x
        LEFT JOIN tops s ON s.level = x.level AND s.pos = xor(r.pos >> x.level, 1)
    ), proofs AS (
        SELECT row_, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY row_
    ), folded AS (
        SELECT p.row_, 0 AS level, CASE WHEN c.crc % 7 = 0 THEN p.tampered ELSE p.leaf END AS node
        FROM placed p LEFT JOIN crcs c ON p.doc_id = c.id
        UNION ALL
        SELECT f.row_, f.level + 1, sha256(CASE WHEN s.side = 1 THEN s.sibling || f.node ELSE f.node || coalesce(s.sibling, '') END)
        FROM folded f JOIN steps s ON s.row_ = f.row_ AND s.level = f.level
    ), last AS (
        SELECT row_, arg_max(node, level) AS folded_root FROM folded GROUP BY row_
    )
    SELECT p.doc_id, p.leaf, r.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
           coalesce(q.proof_sha256, sha256('')) AS proof_sha256, l.folded_root,
           l.folded_root = (SELECT digest FROM tops WHERE n = 1) AS verified
    FROM placed p JOIN subroots r ON p.name = r.name JOIN last l ON l.row_ = p.row_ LEFT JOIN proofs q ON q.row_ = p.row_
    """
)
def op13_merkle_manifest(spark, folder):
    """Every document's leaf, roots and proof, and whether the row as tampered with still leads to the root."""
    docs = table(spark, folder, "documents")
    found = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF]
    tampered = F.when((remainder("doc_id", 7) == 0) & F.col("n_chars").isNotNull(), leaf_digest(found))
    rows = manifest(docs, LEAF, other_leaf=tampered).withColumn("folded_root", fold(F.coalesce("other_leaf", "leaf"), F.col("proof")))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
