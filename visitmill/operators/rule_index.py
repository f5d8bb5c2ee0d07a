"""Eligibility rules as an index, for studies with many of them.

What a value fails is the same for all rows that have it. So the distinct values of each column are held against the
rules, once per study, and rows join what their values fail. A value is compared only with the rules that it leads to: rules
that fail or pass on a value are found by that value, bounds are sorted and cut into blocks, of which a value meets those
that it fails. So the work follows the distinct values and the rules that they fail, not rows times rules, and neither plans nor rows
hold the rules. The lists of failed rules are made only where they are read; their number and kind need no lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmill.functions import skew, text
from visitmill.session import cut_lineage

# Rules of a block; a value takes whole blocks and looks at each bound of theirs.
BLOCK = 64

KEY = ["scope", "name"]
CELL = [*KEY, "text", "number"]
FOUND = "array<struct<id:string,number:bigint,reason:string,blocking:boolean>>"


def index_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries (``scope, name, key, rules, weight``), exceptions, and the directory (what entries there are per scope and column).

    ``rules`` has ``scope, id, name, operator, expected, reason, blocking, listed``, all of them valid. Entries are blocks of rules, of these kinds:

    - ``A`` fails for every value, but for the rules that the exceptions (``scope, name, passing, passed``) name for the block and
      the value (``EQUALS``, ``IN``, bounds that are no number);
    - ``F`` fails on the value (``NOT_EQUALS``, ``NOT_IN``); ``N`` and ``X`` fail on blank and on other values;
    - ``G`` and ``L`` fail from a bound on (``GREATER_THAN``, ``LESS_THAN``), strictest first.
    """
    bound, operator = F.col("expected").try_cast("double"), F.col("operator")
    bounded = operator.isin("GREATER_THAN", "LESS_THAN") & bound.isNotNull()
    one = F.struct("id", F.monotonically_increasing_id().alias("number"), "reason", "blocking", F.when(bounded, bound).alias("bound"))
    held = cut_lineage(rules.select(*KEY, "operator", "expected", "listed", one.alias("rule")))
    kind = (
        F.when(F.col("rule.bound").isNotNull(), F.when(operator == "GREATER_THAN", "G").otherwise("L"))
        .when(operator == "IS_NULL", "X")
        .when(operator == "IS_NOT_NULL", "N")
        .when(~operator.isin("NOT_EQUALS", "NOT_IN"), "A")
    )
    # Sorted so that the rules that more values fail come first: high lower bounds (NaN is above all), low upper bounds.
    lower = F.when(F.isnan("rule.bound"), F.lit(float("-inf"))).otherwise(-F.col("rule.bound"))
    order = F.coalesce(F.when(kind == "G", lower).otherwise(F.col("rule.bound")), F.lit(0.0))
    by = Window.partitionBy(*KEY, "kind").orderBy("sorted", "rule.number")
    block = F.floor((F.row_number().over(by) - 1) / BLOCK).cast("int")
    placed = cut_lineage(held.where(kind.isNotNull()).withColumns({"kind": kind, "sorted": order}).withColumn("block", block))
    grouped = placed.groupBy(*KEY, "kind", "block").agg(F.collect_list("rule").alias("rules"), F.min_by("rule.bound", "sorted").alias("head"))
    blocks = cut_lineage(grouped.withColumn("key", F.concat_ws(":", "kind", "block")))
    values = F.array_distinct(F.when(operator.isin("EQUALS", "NOT_EQUALS"), F.array("expected")).otherwise(F.col("listed")))
    never = (operator == "NOT_EQUALS") & text.is_blank(F.col("expected"))
    failing = held.where(operator.isin("NOT_EQUALS", "NOT_IN") & ~F.coalesce(never, F.lit(False)))
    failing = failing.select(*KEY, "rule", F.explode(values).alias("value")).where("value IS NOT NULL")
    part = Window.partitionBy(*KEY, "value").orderBy("rule.number")
    cut = failing.withColumn("block", F.floor((F.row_number().over(part) - 1) / BLOCK))
    valued = cut.groupBy(*KEY, "value", "block").agg(F.collect_list("rule").alias("rules")).withColumn("key", F.concat(F.lit("F:"), "value"))
    entries = blocks.select(*KEY, "key", "rules").unionByName(valued.select(*KEY, "key", "rules"))
    entries = cut_lineage(entries.withColumn("weight", F.length(F.to_json("rules"))))
    passing = placed.where(operator.isin("EQUALS", "IN")).select(*KEY, "block", "rule.number", F.explode(values).alias("value"))
    passing = passing.where("value IS NOT NULL").withColumn("passing", F.concat_ws(":", "block", "value"))
    exceptions = cut_lineage(passing.groupBy(*KEY, "passing").agg(F.collect_list("number").alias("passed")))

    def many(letter: str) -> Column:
        return F.count_if(F.col("kind") == letter).cast("int").alias(letter.lower())

    def heads(letter: str) -> Column:
        found = F.sort_array(F.collect_list(F.when(F.col("kind") == letter, F.struct("block", "head"))))
        return F.transform(found, lambda b: b["head"]).alias(letter.lower())

    shape = blocks.groupBy(*KEY).agg(many("A"), many("N"), many("X"), heads("G"), heads("L"))
    every = held.select(*KEY).distinct()
    # At most a bound per block and column, so a value carries little of it.
    return entries, exceptions, cut_lineage(every.join(shape, KEY, "left"))


def _numbered(letter: str, many: Column) -> Column:
    """Keys of the first ``many`` blocks of a kind."""
    none = F.array().cast("array<string>")
    places = F.transform(F.sequence(F.lit(0), F.greatest(many, F.lit(1)) - 1), lambda i: F.concat(F.lit(f"{letter}:"), i.cast("string")))
    return F.when(F.coalesce(many, F.lit(0)) > 0, places).otherwise(none)


def _failed_heads(heads: Column, number: Column, upper: bool) -> Column:
    """How many blocks begin with a bound that the number fails; all of them if there is no number."""
    size = F.coalesce(F.size(heads), F.lit(0))
    steps = F.array(*[F.lit(1 << i) for i in range(20, -1, -1)])

    def further(found: Column, step: Column) -> Column:
        head = F.get(heads, found + step - 1)
        fails = (number >= head) if upper else (head >= number)
        return F.when(F.coalesce(fails, F.lit(False)), found + step).otherwise(found)

    return F.when(number.isNull(), size).when(size == 0, 0).otherwise(F.aggregate(steps, F.lit(0), further))


def _cell_keys(column: Column, study: Column | None) -> dict[str, Column]:
    """What tells the values of a column apart, as keys that are never null but for a missing study."""
    value = column.cast("string")
    keys = {} if study is None else {"_scope": F.concat(F.lit("="), study)}
    return keys | {"_none": value.isNull(), "_text": F.coalesce(value, F.lit("")), "_number": F.coalesce(column.try_cast("double"), F.lit(0.0))}


def _probes(rows: DataFrame, directory: DataFrame, used: Sequence[tuple[bool, str]], study: str) -> DataFrame:
    """Distinct values of the rows by study and column (``CELL``), with the ``key`` of each entry that a value may fail and
    the ``passing`` of its exceptions."""
    scope = {True: F.concat(F.lit("="), F.col(study)), False: F.lit("")}
    cells = F.array(*[
        F.struct(scope[own].alias("scope"), F.lit(c).alias("name"), F.col(c).cast("string").alias("text"), F.col(c).try_cast("double").alias("number"))
        for own, c in used
    ])
    distinct = rows.select(F.explode(cells).alias("cell")).select("cell.*").where("scope IS NOT NULL").distinct()
    met = skew.lookup_join(distinct, directory, KEY, row_id=["text"], how="inner")
    blank, number = text.is_blank(F.col("text")), F.col("number")
    keys = F.concat(
        _numbered("A", F.col("a")), _numbered("N", F.when(blank, F.col("n"))), _numbered("X", F.when(~blank, F.col("x"))),
        _numbered("G", _failed_heads(F.col("g"), number, False)), _numbered("L", _failed_heads(F.col("l"), number, True)),
        F.when(F.col("text").isNotNull(), F.array(F.concat(F.lit("F:"), "text"))).otherwise(F.array().cast("array<string>")),
    )
    passing = F.when(F.col("key").startswith("A:"), F.concat(F.substring("key", 3, 20), F.lit(":"), F.col("text")))
    return met.select(*CELL, F.explode(keys).alias("key")).withColumn("passing", passing)


def attach_failed(rows: DataFrame, rules: DataFrame, columns: Sequence[str], *, study: str, row_id: Sequence[str] | None = None) -> DataFrame:
    """``rows`` with what they fail of the rules of their study and of all: ``_failed`` (sorted), ``_many`` and ``_blocking``.

    The rows are read several times. They are joined once per column and kind of rule (own, of all studies), by broadcast where what its values fail is small.
    """
    entries, exceptions, directory = index_rules(rules)
    used = sorted((r.own, r.name) for r in directory.select((F.col("scope") != "").alias("own"), "name").distinct().collect() if r.name in columns)
    probes = cut_lineage(_probes(rows, directory, used, study)) if used else None
    none = F.array().cast(FOUND)
    if probes is None:
        return rows.withColumns({"_failed": none, "_many": F.lit(0), "_blocking": F.lit(False)})
    hits = skew.lookup_join(probes, entries, [*KEY, "key"], row_id=["text", "key"], how="inner")
    # An upper bound of the characters that the lists of a column take.
    weights = hits.groupBy(*CELL).agg(F.sum("weight").alias("weight")).groupBy((F.col("scope") != "").alias("own"), "name")
    sizes = {(r.own, r.name): r for r in weights.agg(F.count("*").alias("cells"), F.sum("weight").alias("weight")).collect()}
    judged = skew.lookup_join(hits, exceptions, [*KEY, "passing"], row_id=["text", "key"])
    letter, number = F.substring("key", 1, 1), F.col("number")
    fails = F.filter(
        "rules",
        lambda r: F.coalesce(F.when(letter == "G", r["bound"] >= number).when(letter == "L", number >= r["bound"]), F.lit(True))
        & ~F.coalesce(F.array_contains("passed", r["number"]), F.lit(False)),
    )
    bare = F.transform("_fails", lambda r: F.struct(r["id"], r["number"], r["reason"], r["blocking"])).cast(FOUND)
    judged = judged.withColumn("_fails", fails)
    per_cell = judged.groupBy(*CELL).agg(
        F.flatten(F.collect_list(bare)).alias("_failed"), F.sum(F.size("_fails")).alias("_many"),
        F.bool_or(F.exists("_fails", lambda r: r["blocking"])).alias("_blocking"),
    )
    given, out = rows.columns, rows
    for i, (own, name) in enumerate(used):
        if (own, name) not in sizes:
            continue
        size = sizes[own, name]
        small = size.cells <= skew.BROADCAST_ROWS and size.weight <= skew.BROADCAST_BYTES // len(used)
        mine = per_cell.where((F.col("name") == name) & ((F.col("scope") != "") == own))
        plain = _cell_keys(F.col("text"), None) | {"_number": F.coalesce("number", F.lit(0.0))} | ({"_scope": F.col("scope")} if own else {})
        found = mine.select(*[c.alias(k) for k, c in plain.items()], *[F.col(c).alias(f"{c}_{i}") for c in ("_failed", "_many", "_blocking")])
        keys = _cell_keys(F.col(name), F.col(study) if own else None)
        keyed, cheap = out.withColumns(keys), rows.select(*[c.alias(k) for k, c in keys.items()])
        out = skew.lookup_join(keyed, found, list(keys), row_id=row_id or given, small=small, keys_from=cheap).drop(*keys)
    places = [i for i, pair in enumerate(used) if pair in sizes]
    lists = [F.coalesce(F.col(f"_failed_{i}"), none) for i in places]
    counts = [F.coalesce(F.col(f"_many_{i}"), F.lit(0)) for i in places]
    blocking = [F.coalesce(F.col(f"_blocking_{i}"), F.lit(False)) for i in places]
    return out.select(
        *given,
        F.sort_array(F.concat(none, *lists)).alias("_failed"), reduce(lambda a, b: a + b, counts, F.lit(0)).cast("int").alias("_many"),
        reduce(lambda a, b: a | b, blocking, F.lit(False)).alias("_blocking"),
    )
