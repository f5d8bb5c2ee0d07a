"""Eligibility rules, subject status lists, row status, valid / non-valid split.

The rule table and its operators are given; how a rule is evaluated is defined here:

- equality and lists compare text; ``IN`` lists are comma-separated and trimmed;
- greater and less compare numbers; a value that is no number fails;
- "null" means null or blank; ``NOT_EQUALS`` and ``NOT_IN`` pass on null;
- a rule without study applies to all studies;
- the status of a row is its first failing stage: skipped, eligibility, strata, immutability.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew, text
from visitmill.operators import rule_index
from visitmill.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    rule_id: str
    column: str
    operator: str
    expected: str | None
    reason: str
    study_id: str | None = None
    kind: str = "NON_BLOCKING"

    def __post_init__(self) -> None:
        if self.operator not in S.RULE_OPERATORS:
            raise ValueError(f"{self.rule_id}: unknown operator {self.operator}")
        if self.kind not in S.RULE_KINDS:
            raise ValueError(f"{self.rule_id}: unknown kind {self.kind}")


def _listed(texts: str | None) -> list[str]:
    return [t.strip() for t in (texts or "").split(",") if t.strip()]


def passes(rule: Rule) -> Column:
    """Whether a row passes the rule; never null."""
    value = F.col(rule.column).cast("string")
    number, bound = F.col(rule.column).try_cast("double"), F.lit(rule.expected).try_cast("double")
    null = text.is_blank(value)
    # What is listed is never blank, so only null needs a word of its own.
    differs = F.coalesce(value != F.lit(rule.expected), F.lit(True))
    test = {
        "EQUALS": lambda: value == F.lit(rule.expected),
        "NOT_EQUALS": lambda: differs if (rule.expected or "").strip() else null | differs,
        "IN": lambda: value.isin(_listed(rule.expected)),
        "NOT_IN": lambda: F.coalesce(~value.isin(_listed(rule.expected)), F.lit(True)),
        "GREATER_THAN": lambda: number > bound,
        "LESS_THAN": lambda: number < bound,
        "IS_NOT_NULL": lambda: ~null,
        "IS_NULL": lambda: null,
    }[rule.operator]()
    return F.coalesce(test, F.lit(False))


def fails(rule: Rule, study: str = "studyId") -> Column:
    failed = ~passes(rule)
    return failed if rule.study_id is None else failed & (F.col(study) == F.lit(rule.study_id))


def listed_if(condition: Column, reason: Column) -> Column:
    """The reason as an array of one, or of none."""
    return F.when(condition, F.array(reason)).otherwise(F.array().cast("array<string>"))


def _reasons(rules: Sequence[Rule], study: str) -> Column:
    """Reasons of the failed rules, joined from short arrays, which stays in generated code."""
    if not rules:
        return F.array().cast("array<string>")
    return F.concat(*[listed_if(fails(r, study), F.lit(r.reason)) for r in rules])


def evaluate(df: DataFrame, rules: Sequence[Rule], *, study: str = "studyId") -> DataFrame:
    """Add ``reasons`` (by rule id) and ``blocking`` (a blocking rule failed)."""
    unknown = sorted({r.column for r in rules} - set(df.columns))
    if unknown:
        raise ValueError(f"Rules on unknown columns: {', '.join(unknown)}")
    ordered = sorted(rules, key=lambda r: r.rule_id)
    blocking = F.lit(False)
    for rule in ordered:
        if rule.kind == "BLOCKING":
            blocking = blocking | F.coalesce(fails(rule, study), F.lit(False))
    return df.withColumn("reasons", _reasons(ordered, study)).withColumn("blocking", blocking)


# Rules of a study, with those of all studies, up to which each row is held against all of them.
FEW_RULES = 64
RULES = "array<struct<id:string,name:string,operator:string,expected:string,reason:string,blocking:boolean,listed:array<string>>>"


def active_rules(table: DataFrame, known: Sequence[str], study: str = "studyId") -> DataFrame:
    """Active rules as ``study, rule``, and ``wrong``: why a rule cannot be applied, null if it can."""
    kind = F.coalesce("ruleKind", F.lit("NON_BLOCKING"))
    told = lambda what, c: F.concat(F.lit("Rule "), F.coalesce("ruleId", F.lit("?")), F.lit(f": unknown {what} "), F.coalesce(c, F.lit("null")))
    wrong = (
        F.when(~F.coalesce(F.col("operator").isin(S.RULE_OPERATORS), F.lit(False)), told("operator", F.col("operator")))
        .when(~kind.isin(S.RULE_KINDS), told("kind", kind))
        .when(~F.coalesce(F.col("columnName").isin(list(known)), F.lit(False)), told("column", F.col("columnName")))
    )
    one = F.struct(
        F.col("ruleId").alias("id"), F.col("columnName").alias("name"), "operator", F.col("expectedValue").alias("expected"),
        F.col("rejectionReason").alias("reason"), (kind == "BLOCKING").alias("blocking"),
        F.coalesce(listed(F.col("expectedValue")), F.array().cast("array<string>")).alias("listed"),
    )
    return table.where("isActive").select(F.col("studyId").alias(study), one.alias("rule"), wrong.alias("wrong"))


def rule_sets(rules: DataFrame, study: str = "studyId") -> tuple[DataFrame, Column]:
    """Rules as one sorted array per study, those of all studies among them; and the array of the latter alone."""
    general = rules.where(F.col(study).isNull()).agg(F.to_json(F.sort_array(F.collect_list("rule")))).first()[0]
    shared = F.from_json(F.lit(general), RULES)
    own = rules.where(F.col(study).isNotNull()).groupBy(study).agg(F.collect_list("rule").alias("_rules"))
    return own.withColumn("_rules", F.sort_array(F.concat("_rules", shared))), shared


def _rule_passes(rule: Column, texts: Column, numbers: Column) -> Column:
    """:func:`passes` for a rule that is data; the values of a row are maps by column name."""
    value, number = F.try_element_at(texts, rule["name"]), F.try_element_at(numbers, rule["name"])
    expected, bound = rule["expected"], rule["expected"].try_cast("double")
    null, differs = text.is_blank(value), F.coalesce(value != expected, F.lit(True))
    within = F.coalesce(F.array_contains(rule["listed"], value), F.lit(False))
    operator = rule["operator"]
    test = (
        F.when(operator == "EQUALS", value == expected)
        .when(operator == "NOT_EQUALS", differs | (text.is_blank(expected) & null))
        .when(operator == "IN", within)
        .when(operator == "NOT_IN", ~within)
        .when(operator == "GREATER_THAN", number > bound)
        .when(operator == "LESS_THAN", number < bound)
        .when(operator == "IS_NOT_NULL", ~null)
        .when(operator == "IS_NULL", null)
    )
    return F.coalesce(test, F.lit(False))


def evaluate_table(
    df: DataFrame, table: DataFrame, *, study: str = "studyId", row_id: Sequence[str] | None = None
) -> DataFrame:
    """:func:`evaluate` with the rules of a table, however many; adds ``failedRules`` (how many) and ``wrongRule`` as well.

    The plan has the same size for any number of rules. Where no study has more than ``FEW_RULES``, each study's rules join its rows as
    an array; beyond that the distinct values of the rows look theirs up in an index (:mod:`visitmill.operators.rule_index`), with the same result. A rule that
    cannot be applied, for its operator, kind or column, raises if it is one of all studies; one of a single study fails the rows of that study,
    with what is wrong as their reason and as ``wrongRule``, and leaves the others alone. Who only counts ``failedRules`` spares the index the lists of reasons.
    """
    rules = active_rules(table, df.columns, study)
    own = rules.where("wrong IS NULL").drop("wrong")
    counts = rules.groupBy(study).agg(F.count("*").alias("n"), F.min("wrong").alias("wrong"))
    most, general, wrong, bad = counts.agg(
        F.max(F.when(F.col(study).isNotNull(), F.col("n"))), F.max(F.when(F.col(study).isNull(), F.col("n"))),
        F.max(F.when(F.col(study).isNull(), F.col("wrong"))), F.count(F.when(F.col(study).isNotNull(), F.col("wrong"))),
    ).first()
    if wrong:
        raise ValueError(wrong)
    # What reaches the driver are the names of columns, and a short list of rules of all studies.
    columns = sorted(r.name for r in own.select("rule.name").distinct().collect())
    if (most or 0) + (general or 0) <= FEW_RULES:
        found = _evaluate_arrays(df, own, columns, study, row_id)
        found = found.withColumns({"_many": F.size("_failed"), "_blocking": F.exists("_failed", lambda r: r["blocking"])})
    else:
        flat = own.select(F.coalesce(F.concat(F.lit("="), F.col(study)), F.lit("")).alias("scope"), "rule.*")
        found = rule_index.attach_failed(cut_lineage(df), flat, columns, study=study, row_id=row_id)
    told = {
        "reasons": F.transform("_failed", lambda r: r["reason"]), "blocking": F.coalesce("_blocking", F.lit(False)),
        "failedRules": F.col("_many"), "wrongRule": F.lit(None).cast("string"),
    }
    out = found.withColumns(told).drop("_failed", "_many", "_blocking")
    if not bad:
        return out
    broken = cut_lineage(counts.where(F.col(study).isNotNull() & F.col("wrong").isNotNull()).select(study, F.col("wrong").alias("_wrong")))
    joined = skew.lookup_join(out.drop("wrongRule"), broken, [study], row_id=row_id, keys_from=df.select(study))
    is_wrong = F.col("_wrong").isNotNull()
    instead = {
        "reasons": F.when(is_wrong, F.array("_wrong")).otherwise(F.col("reasons")), "blocking": F.col("blocking") | is_wrong,
        "failedRules": F.when(is_wrong, 1).otherwise(F.col("failedRules")),
    }
    return joined.withColumns(instead).withColumnRenamed("_wrong", "wrongRule")


def _evaluate_arrays(df: DataFrame, rules: DataFrame, columns: Sequence[str], study: str, row_id: Sequence[str] | None) -> DataFrame:
    """``df`` with ``_failed``; each row is held against the array of its study's rules."""
    sets, shared = rule_sets(rules, study)
    pairs = [(F.lit(c), F.col(c)) for c in columns]
    none = F.create_map().cast("map<string,string>")
    texts = F.create_map(*[x for n, c in pairs for x in (n, c.cast("string"))]) if pairs else none
    numbers = F.create_map(*[x for n, c in pairs for x in (n, c.try_cast("double"))]) if pairs else none.cast("map<string,double>")
    joined = skew.lookup_join(df, sets, [study], row_id=row_id, keys_from=df.select(study))
    held = joined.withColumns({"_rules": F.coalesce("_rules", shared), "_texts": texts, "_numbers": numbers})
    failed = F.filter("_rules", lambda r: ~_rule_passes(r, F.col("_texts"), F.col("_numbers")))
    return held.withColumn("_failed", failed).drop("_rules", "_texts", "_numbers")


def listed(col: Column) -> Column:
    """Comma-separated text as trimmed, non-blank items; null stays null."""
    return F.filter(F.transform(F.split(col, ","), text.strip), lambda t: t != "")


def status_skips(status: Column, allowed: Column, denied: Column) -> Column:
    """Whether the subject status takes the row out: listed as non-payable, or not among the payable.

    The lists are arrays, parsed once per study and not per row.
    """
    is_denied = F.coalesce(F.array_contains(denied, status), F.lit(False))
    is_allowed = F.coalesce(F.array_contains(allowed, status), F.lit(False))
    return is_denied | ((F.coalesce(F.size(allowed), F.lit(0)) > 0) & ~is_allowed)


def row_status(skipped: Column, ineligible: Column, no_arm: Column, arm_changed: Column) -> Column:
    return (
        F.when(skipped, "SKIPPED")
        .when(ineligible, "FAILED_ELIGIBILITY")
        .when(no_arm, "FAILED_STRATA")
        .when(arm_changed, "FAILED_IMMUTABILITY")
        .otherwise("VALID")
    )


def status_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: all rows, valid and skipped rows, and whether a blocking rule failed."""
    return df.groupBy(*by).agg(
        F.count("*").alias("totalRows"),
        F.count_if(F.col("status") == "VALID").alias("validRows"),
        F.count_if(F.col("status") == "SKIPPED").alias("skippedRows"),
        F.coalesce(F.bool_or("blocking"), F.lit(False)).alias("blocked"),
    )


def split_valid(df: DataFrame) -> DataFrame:
    return df.withColumn("is_valid", F.col("status") == "VALID")
