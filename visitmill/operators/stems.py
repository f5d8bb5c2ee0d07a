"""Unique output names for many labels at once.

Labels arrive in order. Each takes the first free name of ``base``, ``base_1``, ``base_2``, …, where a
name is free if no earlier label took it. The occurrences of a base are numbered by ranges of the order,
so a base that holds most of the rows is no single task's work. Only bases whose names can meet
(``a`` and ``a_1``) are settled against each other, one row per such pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew, text
from visitmill.session import cut_lineage

# Bases that share this many first characters are settled together if one is cut at the limit.
FAMILY_CHARS = 100
# Room for any number behind a base; a longer base may be cut.
SUFFIX_CHARS = 20
_NUMBERED = r"_([1-9][0-9]{0,17})\z"


def _meeting_bases(bases: DataFrame, scope: list[str]) -> DataFrame:
    """Pairs of a base (``parent``) and a base (``child``) that equals one of its numbered names.

    A parent that occurs once keeps its plain name, unless it is itself such a child.
    """
    number = F.regexp_extract("base", _NUMBERED, 1)
    child = bases.where(number != "").select(
        *scope,
        F.col("base").alias("child"),
        F.regexp_replace("base", _NUMBERED, "").alias("parent"),
        number.cast("long").alias("number"),
        F.col("first").alias("child_first"),
    )
    parents = bases.where((F.col("n") > 1) | F.col("base").rlike(_NUMBERED))
    known = parents.select(*scope, F.col("base").alias("parent"))
    return skew.lookup_join(child, known, [*scope, "parent"], how="inner", row_id=[*scope, "child"])


def _settle(pairs: DataFrame, scope: list[str], one_range: bool) -> DataFrame:
    """Numbers of each base that other bases hold, as rows ``(base, number)``.

    With ``lost`` smaller names taken by others, the occurrence of the parent to reach number ``n`` is
    ``n - lost``. The child holds that name if at most so many occurrences came before it; if not, it
    loses its own plain name. What one pair holds depends only on smaller numbers and on the parent's
    own plain name, so the rounds end in the one answer that agrees with itself.
    """
    state = pairs.select(*scope, "parent", "child", "number", "earlier")
    state = cut_lineage(state.withColumn("holds", F.lit(True)))
    key, cuts = [*scope, "parent"], [] if one_range else skew.range_cuts(state, "number")
    while True:
        lost_own = state.where(~F.col("holds")).select(
            *scope, F.col("child").alias("parent"), F.lit(1).alias("own")
        )
        counted = skew.bucketed_sum_before(state, key, "number", F.col("holds"), "smaller", cuts)
        lost = F.col("smaller") + F.coalesce("own", F.lit(0))
        judged = skew.lookup_join(counted, lost_own, key, row_id=[*scope, "child"])
        judged = judged.withColumn("now", F.col("earlier") <= F.col("number") - lost)
        judged = cut_lineage(judged.drop("own", "smaller"))
        if judged.where(F.col("now") != F.col("holds")).isEmpty():
            break
        state = judged.drop("holds").withColumnRenamed("now", "holds")
    held = state.where("holds").select(*scope, F.col("parent").alias("base"), "number")
    own = state.where(~F.col("holds")).select(
        *scope, F.col("child").alias("base"), F.lit(0).cast("long").alias("number")
    )
    return held.unionByName(own)


def _taken_numbers(
    items: DataFrame, pairs: DataFrame, scope: list[str], order: str, cuts: Sequence[int], one_range: bool
) -> DataFrame:
    # Occurrences of the parent that came before the child's first: markers counted among the rows.
    key = [*scope, "base"]
    parents = pairs.select(*scope, F.col("parent").alias("base")).distinct()
    occurrences = items.select(*key, F.col(order).alias("at"))
    rows = skew.lookup_join(occurrences, parents, key, how="inner", row_id=[*scope, "at"])
    markers = pairs.select(*scope, F.col("parent").alias("base"), F.col("child_first").alias("at"), "child")
    marked = rows.withColumn("child", F.lit(None).cast("string")).unionByName(markers)
    is_row = F.col("child").isNull()
    counted = skew.bucketed_sum_before(marked, key, "at", is_row, "earlier", cuts)
    earlier = counted.where(F.col("child").isNotNull()).select(*scope, "child", "earlier")
    return _settle(pairs.join(earlier, [*scope, "child"]), scope, one_range)


def _skip_taken(numbered: DataFrame, taken: DataFrame, scope: list[str], total: int, one_range: bool) -> DataFrame:
    """Add ``number``: the ordinal plus the taken numbers that come before the free one it reaches.

    The i-th taken number ``t`` is skipped from ordinal ``t - i`` on, so that counting such marks
    among the ordinals gives the skips of every row.
    """
    key = [*scope, "base"]
    marks = skew.bucketed_ordinal(taken, key, "number", "i", [] if one_range else None).select(
        *key, (2 * (F.col("number") - F.col("i"))).alias("place"), F.lit(True).alias("mark")
    )
    rows = numbered.withColumn("place", 2 * F.col("ordinal") + 1).withColumn("mark", F.lit(False))
    both = rows.unionByName(marks, allowMissingColumns=True)
    places = [] if one_range else skew.range_cuts(both, "place", total)
    counted = skew.bucketed_sum_before(both, key, "place", F.col("mark"), "skips", places)
    return (
        counted.where(~F.col("mark"))
        .withColumn("number", F.col("ordinal") + F.col("skips"))
        .drop("place", "mark", "skips")
    )


def _allot(items: DataFrame, scope: list[str], order: str, total: int) -> DataFrame:
    """Add ``number``: what each row would take if no natural name were in the way.

    Numbers of the same length leave a base the same first characters, so bases that share these draw from
    one pool, in the order of the rows. The first row of a base takes the plain name; each round gives
    out the pools of one length, so there are as many rounds as the count has digits.
    """
    done = [items.where("ordinal = 0").withColumn("number", F.lit(0).cast("long"))]
    rest, digits, room = items.where("ordinal > 0"), 1, 0
    while room < total:
        pool = 9 * 10 ** (digits - 1)
        cut = F.substring("base", 1, S.STEM_LIMIT - 1 - digits)
        placed = skew.bucketed_ordinal(rest.withColumn("_cut", cut), [*scope, "_cut"], order, "_place")
        placed = cut_lineage(placed)
        taken = placed.where(F.col("_place") < pool).withColumn("number", F.col("_place") + 10 ** (digits - 1))
        done.append(taken.drop("_cut", "_place"))
        rest = placed.where(F.col("_place") >= pool).drop("_cut", "_place")
        room, digits = room + pool, digits + 1
    return reduce(DataFrame.unionByName, done)


def _settle_cut(items: DataFrame, scope: list[str], order: str, total: int) -> DataFrame:
    """Names for bases that are cut at the limit: propose, keep the earliest, let the rest go on.

    The proposals are right unless a natural name equals a numbered one. Rows that lose a name to an
    earlier one try their next number, until no row loses.
    """
    current = _allot(items, scope, order, total)
    name = [*scope, "stem"]
    while True:
        named = cut_lineage(current.withColumn("stem", text.numbered_stem(F.col("base"), F.col("number"))))
        holders = named.groupBy(*name).agg(F.min(order).alias("_holder"))
        judged = cut_lineage(
            named.join(holders, name).withColumn("_lost", F.col(order) > F.col("_holder")).drop("_holder")
        )
        if judged.where("_lost").isEmpty():
            return judged.drop("_lost")
        step = F.when(F.col("_lost"), 1).otherwise(0)
        current = judged.withColumn("number", F.col("number") + step).drop("_lost", "stem")


def unique_stems(
    df: DataFrame,
    label: Column,
    order: str,
    *,
    scope: Sequence[str] = (),
    per_range: int | None = None,
    name: str = "stem",
) -> DataFrame:
    """Add a stem for each row, unique within ``scope``, in the order of a unique integer column.

    ``per_range`` is about how many rows are numbered together; a null scope is one of its own.
    """
    # Stand-ins of the scope that are never null, so that rows of a null scope meet in the joins below.
    told = {f"_scope_{i}": F.coalesce(F.col(c).cast("string"), F.lit("")) for i, c in enumerate(scope)}
    told |= {f"_no_scope_{i}": F.col(c).isNull() for i, c in enumerate(scope)}
    scope = list(told)
    key = [*scope, "base"]
    # Read many times from here on, and names take long to make: made once, by as many tasks as there are parts.
    items = cut_lineage(df.withColumn("base", text.safe_stem(label)).withColumns(told).repartition(order))
    totals = items.groupBy(*key).agg(F.min(order).alias("first"), F.count("*").alias("n"))
    bases = cut_lineage(totals)
    is_cut = (F.col("n") > 1) & (F.length("base") > S.STEM_LIMIT - SUFFIX_CHARS)
    found = bases.agg(
        F.sum("n").alias("n"),
        F.max("n").alias("most"),
        F.bool_or(is_cut).alias("cut"),
        F.bool_or(F.col("base").rlike(_NUMBERED)).alias("numbered"),
    ).first()
    # Ranges are for groups that are too large for one task; without such a group, all rows of one are numbered together.
    limit = per_range or skew.RANGE_ROWS
    at = [] if (found.most or 0) <= limit else skew.range_cuts(items, order, found.n or 0, per_range)
    numbered = skew.bucketed_ordinal(items, key, order, "ordinal", at)
    family = F.substring("base", 1, FAMILY_CHARS)
    plain, rest = numbered, None
    if found.cut:
        families = bases.where(is_cut).select(*scope, family.alias("family")).distinct()
        families = cut_lineage(families).withColumn("is_cut", F.lit(True))
        marked = skew.lookup_join(
            numbered.withColumn("family", family), families, [*scope, "family"], row_id=[*scope, order]
        )
        plain = marked.where(F.col("is_cut").isNull()).drop("family", "is_cut")
        rest = _settle_cut(marked.where("is_cut").drop("family", "is_cut"), scope, order, found.n)
    pairs = cut_lineage(_meeting_bases(bases, scope)) if found.numbered else None
    # Names that meet one base; a group below has at most these and its rows.
    met = pairs.groupBy(*scope, "parent").count().agg(F.max("count")).first()[0] if found.numbered else None
    if not met:
        plain = plain.withColumn("number", F.col("ordinal"))
    else:
        one_range = found.most + met + 1 <= limit
        marked_at = at if at or one_range else skew.range_cuts(items, order, found.n, per_range)
        taken = _taken_numbers(items, pairs, scope, order, marked_at, one_range)
        plain = _skip_taken(plain, taken, scope, found.n, one_range)
    named = plain.withColumn("stem", text.numbered_stem(F.col("base"), F.col("number")))
    if rest is not None:
        named = named.unionByName(rest)
    return named.withColumnRenamed("stem", name).drop("base", "ordinal", "number", *scope)
