"""Column mapping to the fixed 23-column schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew, text
from visitmill.sources import pages as P

# Order in which a target's source columns are tried.
RULE, ALIAS, DIRECT = 1, 2, 3


class DuplicateTargetError(ValueError):
    """Two source columns map to one target."""


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().upper() for c in df.columns])


def active_rules(mappings: DataFrame) -> DataFrame:
    """Usable rules: category, upper-case source, target; the highest id wins for a source."""
    source = F.upper(text.strip(F.col("sourceColumn")))
    target = text.strip(F.col("targetColumn"))
    usable = mappings.where("isActive").select(
        F.col("type").alias("category"), source.alias("source"), target.alias("target"), "id"
    )
    usable = usable.where((F.col("source") != "") & (F.col("target") != ""))
    return usable.groupBy("category", "source").agg(F.max_by("target", "id").alias("target"))


def rule_counts(mappings: DataFrame) -> DataFrame:
    """Number of usable rules per category."""
    return active_rules(mappings).groupBy("category").agg(F.count("*").alias("rules"))


def collect_rules(mappings: DataFrame) -> dict[str, dict[str, str]]:
    """Usable rules as ``{category: {source: target}}``; they name columns of plans, as headers do."""
    rules: dict[str, dict[str, str]] = {c: {} for c in S.CATEGORIES}
    for row in active_rules(mappings).collect():
        rules.setdefault(row.category, {})[row.source] = row.target
    return rules


def resolve_name(name: str, rules: Mapping[str, str], category: str) -> tuple[str, int]:
    """Name after rule, alias and direct mapping, and the step that gave it."""
    current, step = name.strip().upper(), DIRECT
    if current in rules:
        current, step = rules[current], RULE
    if category == S.SUBJECT_GROUP and current.strip().upper() in S.GROUP_ALIASES:
        current, step = S.GROUP_ALIASES[current.strip().upper()], min(step, ALIAS)
    return S.SOURCE_TO_TARGET.get(current, current), step


def target_sources(names: Sequence[str], rules: Mapping[str, str], category: str) -> dict[str, list[int]]:
    """Per target, the positions of its source columns in the order they are tried."""
    hits: dict[str, list[tuple[int, int]]] = {}
    for position, name in enumerate(names):
        target, step = resolve_name(name, rules, category)
        if target in S.TARGETS:
            hits.setdefault(target, []).append((step, position))
    return {target: [p for _, p in sorted(found)] for target, found in hits.items()}


def checked_sources(
    names: Sequence[str], rules: Mapping[str, str], category: str, *, strict: bool
) -> dict[str, list[int]]:
    """:func:`target_sources`; with ``strict``, two sources of one target are an error."""
    sources = target_sources(names, rules, category)
    if strict and (twice := [t for t, p in sources.items() if len(p) > 1]):
        raise DuplicateTargetError(f"More than one source column for: {', '.join(twice)}")
    return sources


def normalized_columns(
    columns: Sequence[Column],
    names: Sequence[str],
    rules: Mapping[str, str],
    category: str,
    *,
    strict: bool = False,
) -> list[Column]:
    """The 23 targets as one select list; a target without source is ``""``."""
    sources = checked_sources(names, rules, category, strict=strict)
    out = []
    for target in S.TARGETS:
        found = [columns[p].cast("string") for p in sources.get(target, [])]
        value = F.coalesce(*found) if len(found) > 1 else found[0] if found else F.lit("")
        out.append(value.alias(target))
    return out


def normalize(
    df: DataFrame,
    rules: Mapping[str, str] | None = None,
    *,
    category: str = S.SUBJECT_VISIT,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Map a frame to the 23 targets; ``keep`` names columns carried along as they are."""
    names = [c for c in df.columns if c not in keep]
    columns = [F.col(f"`{c}`") for c in names]
    mapped = normalized_columns(columns, names, rules or {}, category, strict=strict)
    return df.select(*keep, *mapped)


def fill_targets(df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """For rows that carry target names already: exact names only, the rest is ``""`` or dropped."""
    have = set(df.columns)
    columns = [
        F.col(c).cast("string").alias(c) if c in have else F.lit("").alias(c) for c in S.TARGETS
    ]
    return df.select(*keep, *columns)


def present_targets(records: DataFrame, pull: Sequence[str]) -> DataFrame:
    """Per pull, the targets that any of its records has, as ``present``; at most 23 names per pull."""
    names = F.explode(P.record_columns(F.col("record"), S.TARGETS)).alias("name")
    return records.select(*pull, names).groupBy(*pull).agg(F.collect_set("name").alias("present"))


def normalize_records(records: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Map JSON records (``record``, and ``present`` of their pull) to the 23 targets.

    A target that no record of the pull has is ``""``; one that only some records lack is null there.
    The targets' texts are taken out of a record once, as a map.
    """
    named = records.select(*keep, "present", P.record_texts(F.col("record"), S.TARGETS).alias("_texts"))
    columns = [
        F.when(F.array_contains("present", t), F.try_element_at("_texts", F.lit(t))).otherwise(F.lit("")).alias(t)
        for t in S.TARGETS
    ]
    return named.select(*keep, *columns)


def resolve_headers(headers: DataFrame, rules: DataFrame) -> DataFrame:
    """Target of every header name of many files, as a join of names and usable rules.

    ``headers`` has ``category`` and ``name`` (and may have more, such as ``file``).
    """
    direct = F.create_map(*[F.lit(x) for pair in S.SOURCE_TO_TARGET.items() for x in pair])
    alias = F.create_map(*[F.lit(x) for pair in S.GROUP_ALIASES.items() for x in pair])
    named = headers.withColumn("source", F.upper(text.strip(F.col("name"))))
    joined = skew.lookup_join(named, rules, ["category", "source"])
    in_group = F.col("category") == S.SUBJECT_GROUP
    aliased = F.when(in_group, F.try_element_at(alias, F.upper(text.strip(F.col("_ruled")))))
    mapped = F.coalesce("_aliased", "_ruled")
    step = (
        F.when(F.col("target").isNotNull(), RULE)
        .when(F.col("_aliased").isNotNull(), ALIAS)
        .otherwise(DIRECT)
    )
    steps = joined.withColumn("_ruled", F.coalesce("target", "source")).withColumn("_aliased", aliased)
    final = steps.withColumn("_final", F.coalesce(F.try_element_at(direct, mapped), mapped))
    known = F.col("_final").isin(S.TARGETS)
    return final.select(
        *headers.columns, F.when(known, F.col("_final")).alias("target"), F.when(known, step).alias("step")
    )


def mapping_view(mappings: DataFrame) -> DataFrame:
    """Rules as read by clients: ``type`` is called ``category``; a rule without id is an error."""
    saved = F.when(F.col("id").isNull(), F.raise_error(F.lit("A mapping must be saved before it is read.")))
    return mappings.select(
        F.coalesce(saved.cast("int"), F.col("id")).alias("id"),
        F.col("type").alias("category"),
        F.col("sourceColumn").alias("source_column"),
        F.col("targetColumn").alias("target_column"),
        "description",
        F.col("isActive").alias("is_active"),
        F.col("createdBy").alias("created_by"),
        F.col("updatedBy").alias("updated_by"),
        F.col("createdAt").alias("created_at"),
        F.col("updatedAt").alias("updated_at"),
    )


def mapping_input(rows: DataFrame) -> DataFrame:
    """New rules as sent by clients, with the defaults filled in."""
    have = set(rows.columns)

    def given(name: str, default: Column) -> Column:
        return (F.coalesce(F.col(name), default) if name in have else default).alias(name)

    text_null = F.lit(None).cast("string")
    return rows.select(
        "category",
        "source_column",
        "target_column",
        given("description", text_null),
        given("is_active", F.lit(True)),
        given("created_by", text_null),
    )


def first_rows(df: DataFrame, per: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows per group. Spark cuts each task to ``n`` rows per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
