"""Keyed upsert that keeps who created a row, and the seed tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill import schema as S
from visitmill.functions import skew
from visitmill.session import cut_lineage

# Sections of a seed file and the defaults of its rows.
SEED_SECTIONS = {
    "eligibility_rule": None,
    "subject_visit_column_mapping": S.SUBJECT_VISIT,
    "subject_group_column_mapping": S.SUBJECT_GROUP,
    "misc_column_mapping": S.MISC,
}
SEED_DEFAULTS = {"ruleKind": "NON_BLOCKING", "isActive": True, "createdBy": "seed-sponsor"}
SEED_REQUIRED = {"ruleId", "columnName", "operator", "rejectionReason", "sourceColumn", "targetColumn"}
CREATED = ("createdAt", "createdBy")
# An ordinal holds, from the top: the section, the file block, the row within its task.
ROW_BITS, SECTION_BITS = 33, 60


def merge_seed(seed: DataFrame, key: Sequence[str], ordinal: str, created: Sequence[str] = CREATED) -> DataFrame:
    """One row per key: the last seed row wins, but created values come from the first."""
    rest = [c for c in seed.columns if c not in (*key, *created, ordinal)]
    kept = [c for c in created if c in seed.columns]
    merged = seed.groupBy(*key).agg(
        F.max_by(F.struct(*rest), ordinal).alias("_last"),
        F.min_by(F.struct(*kept, ordinal), ordinal).alias("_first"),
        F.min(ordinal).alias(ordinal),
    )
    return merged.select(
        *key, ordinal, *[F.col(f"_last.{c}").alias(c) for c in rest], *[F.col(f"_first.{c}").alias(c) for c in kept]
    )


def upsert(
    base: DataFrame,
    seed: DataFrame,
    key: Sequence[str],
    *,
    ordinal: str = "ordinal",
    created: Sequence[str] = CREATED,
    row_id: str | None = None,
    broadcast_rows: int = skew.BROADCAST_ROWS,
) -> DataFrame:
    """New version of ``base``: matched rows take the seed's values but keep ``created`` and the id.

    With ``row_id`` the rows of ``base`` need not be unique by key; of equal keys the lowest id is
    updated, and new rows get the next ids in seed order. A seed of checked small size is broadcast, so
    that ``base`` is not shuffled; a larger one is joined by its keys, of which each side has one row.
    """
    key = list(key)
    # The seed is reduced to one row per key and written, as it is used more than once.
    merged = cut_lineage(merge_seed(seed, key, ordinal, created))
    values = [c for c in base.columns if c not in (*key, *created, row_id)]
    unknown = sorted(set(values) - set(merged.columns))
    if unknown:
        raise ValueError(f"The seed has no value for: {', '.join(unknown)}")
    kept = [c for c in created if c in base.columns]
    incoming = merged.select(*key, ordinal, *[F.col(c).alias(f"_new_{c}") for c in [*values, *kept]])
    target = base.withColumn("_old", F.lit(True))
    small = skew.fits_broadcast(incoming, broadcast_rows)
    if row_id is None and not small:
        joined = target.join(incoming.withColumn("_new", F.lit(True)), key, "full_outer")
    else:
        joined = _update_and_insert(target, incoming, key, ordinal, row_id, small)

    def pick(name: str) -> Column:
        if name in key or name == row_id:
            return F.col(name)
        new, old = F.col(f"_new_{name}"), F.col(name)
        takes_new = F.col("_old").isNull() if name in kept else F.col("_new").isNotNull()
        return F.when(takes_new, new).otherwise(old).alias(name)

    return joined.select(*[pick(c) for c in base.columns])


def _update_and_insert(
    target: DataFrame, incoming: DataFrame, key: list[str], ordinal: str, row_id: str | None, small: bool
) -> DataFrame:
    """Rows of ``target`` with what comes for them, and the incoming rows that match none."""
    side = F.broadcast if small else (lambda df: df)
    hits = target.join(side(incoming.select(*key)), key, "left_semi").groupBy(*key)
    found = hits.agg(F.min(row_id).alias(row_id) if row_id else F.lit(True).alias("_hit"))
    mark = row_id or "_hit"
    matched = cut_lineage(incoming.join(found, key, "left"))
    updates = matched.where(F.col(mark).isNotNull()).drop(ordinal, "_hit").withColumn("_new", F.lit(True))
    updated = target.join(side(updates.drop(*key) if row_id else updates), [row_id] if row_id else key, "left")
    inserts = matched.where(F.col(mark).isNull()).drop(mark).withColumn("_new", F.lit(True))
    if row_id is not None:
        top = target.agg(F.max(row_id)).first()[0] or 0
        next_id = (F.col("_n") + top + 1).cast(target.schema[row_id].dataType)
        inserts = skew.bucketed_ordinal(inserts, [], ordinal, "_n").withColumn(row_id, next_id).drop("_n")
    return updated.unionByName(inserts.drop(ordinal), allowMissingColumns=True)


def read_seed(spark: SparkSession, path: str, *, lines: bool = False) -> dict[str, DataFrame]:
    """Rows of each section of a seed that has any, as ``seed_frame`` takes them.

    A seed is a JSON file, or a folder of them, whose sections each hold a list. With ``lines`` every line is such a
    document, so that a seed of any size is split among tasks. Rows count in the order of paths, lines and lists.
    """
    text = spark.read.text(path, wholetext=not lines)
    docs = text.select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    if lines:
        docs = docs.where(F.trim("value") != "")
    listed = F.explode(_sections(F.from_json("value", "map<string,string>"))).alias("_s")
    rows = F.explode(_section_rows(F.col("_s.text"), F.col("_s.problem"))).alias("_r")
    # The number of a row within its task keeps the order within a block; it is fixed by writing it.
    numbered = docs.select("_path", "_block", listed).select("_path", "_block", "_s.section", rows).select(
        "_path", "_block", "section", "_r.*", F.monotonically_increasing_id().alias("_row")
    )
    table = cut_lineage(numbered)
    names = list(SEED_SECTIONS)
    found = table.groupBy("section").agg(F.min("problem").alias("problem"), F.min_by("_path", "problem").alias("path")).collect()
    if not found and docs.isEmpty():
        raise ValueError("A seed file must hold sections by name.")
    for row in found:
        if row.problem is not None:
            raise ValueError(f"{row.path}: {row.problem}")
    # One row per file block, numbered in order.
    blocks = table.select("_path", "_block").distinct()
    ranked = blocks.withColumn("_rank", F.row_number().over(Window.orderBy("_path", "_block")) - 1)
    placed = skew.lookup_join(table, ranked, ["_path", "_block"])
    within = F.col("_rank") * F.lit(1 << ROW_BITS) + F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    label = F.concat_ws(" ", F.col("position"), F.lit("of"), F.element_at(F.array(*map(F.lit, names)), F.col("section") + 1), F.lit("in"), "_path")
    frame = placed.select("section", within.alias("ordinal"), label.alias("place"), "given")
    return {names[row.section]: frame.where(F.col("section") == row.section).drop("section") for row in found}


def _sections(doc: Column) -> Column:
    """Sections of a parsed document, with what is wrong if it is none."""
    def entry(section: int, text: Column, problem: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), text.alias("text"), problem.alias("problem"))

    nothing = F.lit(None).cast("string")
    held = [F.when(F.map_contains_key(doc, name), entry(i, doc[name], nothing)) for i, name in enumerate(SEED_SECTIONS)]
    none = entry(0, nothing, F.lit("A seed file must hold sections by name."))
    return F.when(doc.isNull(), F.array(none)).otherwise(F.filter(F.array(*held), lambda e: e.isNotNull()))


def _section_rows(text: Column, problem: Column) -> Column:
    """Rows of a section given as JSON text, with what is wrong if it holds no list of objects."""
    def entry(position: Column, given: Column, wrong: Column) -> Column:
        return F.struct(position.cast("long").alias("position"), given.alias("given"), wrong.alias("problem"))

    nothing, rows = F.lit(None).cast("map<string,string>"), F.from_json(text, "array<map<string,string>>")
    no_list = F.lit("A section must hold a list of objects.")
    bad = problem.isNotNull() | text.isNull() | ~F.ltrim(text).startswith("[") | rows.isNull()
    whole = F.array(entry(F.lit(-1), nothing, F.coalesce(problem, no_list)))
    return F.when(bad, whole).otherwise(F.transform(rows, lambda g, i: entry(i, g, F.when(g.isNull(), no_list))))


def given_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A few rows at hand, in the form of a section that was read."""
    texts = [(i, str(i), json.dumps(row)) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(texts, "ordinal long, place string, given string")
    return frame.withColumn("given", F.from_json("given", "map<string,string>"))


def seed_frame(rows: DataFrame, table: T.StructType, category: str | None, now: Column) -> DataFrame:
    """Seed rows as a frame of the table's columns with their ``ordinal``, defaults filled in.

    ``rows`` has ``ordinal``, ``place`` and ``given``, a map of texts. A name that is not given takes its default; one
    given as null stays null. ``isActive`` is false for false, 0, null and an empty text.
    """
    names = [c for c in table.names if c not in ("id", "createdAt", "updatedAt")]
    known = F.col("given") if category is None else F.map_concat(
        F.map_filter("given", lambda k, _: k != "type"), F.create_map(F.lit("type"), F.lit(category))
    )
    missing = F.array_compact(F.array(*[F.when(~F.map_contains_key(known, n), F.lit(n)) for n in sorted(SEED_REQUIRED & set(names))]))
    bad = rows.select("ordinal", "place", missing.alias("missing")).where(F.size("missing") > 0).orderBy("ordinal").limit(1)
    for row in bad.collect():
        raise KeyError(f"Seed row {row.place} has no {', '.join(row.missing)}")

    def cell(name: str) -> Column:
        default = SEED_DEFAULTS.get(name)
        value = F.when(F.map_contains_key(known, name), known[name]).otherwise(F.lit(default).cast("string"))
        if name == "isActive":
            return ~F.lower(F.coalesce(value, F.lit(""))).isin("false", "0", "")
        return value.cast(table[name].dataType)

    return rows.select(*[cell(n).alias(n) for n in names], "ordinal", now.alias("createdAt"), now.alias("updatedAt"))


def seed_rules(base: DataFrame, rows: DataFrame | Sequence[dict], now: Column) -> DataFrame:
    """Eligibility rules after the seed, by rule id. ``rows`` are those of a section, or a few at hand."""
    rows = rows if isinstance(rows, DataFrame) else given_rows(base.sparkSession, rows)
    return upsert(base, seed_frame(rows, S.ELIGIBILITY_RULE, None, now), ["ruleId"], row_id="id")


def seed_mappings(base: DataFrame, sections: Sequence[tuple[str, DataFrame | Sequence[dict]]], now: Column) -> DataFrame:
    """Column mappings after the seed, by category and target; the source is no part of the key.

    ``sections`` are (category, rows). As the category is in the key, all are upserted at once, in the order given.
    """
    frames = []
    for i, (category, rows) in enumerate(sections):
        rows = rows if isinstance(rows, DataFrame) else given_rows(base.sparkSession, rows)
        frame = seed_frame(rows, S.COLUMN_MAPPING, category, now)
        frames.append(frame.withColumn("ordinal", F.col("ordinal") + F.lit(i << SECTION_BITS)))
    return upsert(base, reduce(DataFrame.unionByName, frames), ["type", "targetColumn"], row_id="id")
