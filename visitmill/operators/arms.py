"""Arm of a subject, first-seen registry, visit schedule, pay mode, contact mode.

The modes and tables are given; how they act is defined here:

- ``FLAT_RATE``: one constant arm. ``EDC_ONLY``: the value of the column that the study names.
- ``IMPALA_GROUP_MAP_TO_ARM``: the subject's group value (the study's group column, else ``strata``),
  looked up in the study's JSON map. ``IMPALA_BUDGET_ARM_FROM_COLUMN``: that group value itself.
- ``MANUAL_MAPPING``: the group of the manual template. ``HYBRID``: the template first, then the group
  value.
- A row without arm has failed strata. The first arm of a (study, site, subject) stays; a row with
  another arm has failed immutability.
- ``LUMP_SUM`` keeps the first row per (study, subject, visit, procedure); ``IGNORE`` drops rows that
  have a time after dose; ``PER_TIMEPOINT`` keeps all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew, text
from visitmill.operators.mapping import first_rows

SUBJECT = ["studyId", "subjectId"]
REGISTRY_KEY = ["studyId", "siteId", "subjectId"]
SCHEDULE_KEY = ["studyId", "visitNumber", "formName", "procedureName"]
VISIT_KEY = ["studyId", "subjectId", "subjectVisitNumber", "procedureName"]


def arm_config(configs: DataFrame) -> DataFrame:
    """Study config with trimmed column names and the JSON map parsed; once per study, not per row."""
    have = set(configs.columns)
    cleaned = {c: text.blank_to_null(F.col(c)) for c in ("edcArmColumn", "impalaArmColumn") if c in have}
    if "strataToArmMapping" in have:
        cleaned["strataToArmMapping"] = F.from_json("strataToArmMapping", "map<string,string>")
    return configs.withColumns(cleaned) if cleaned else configs


def pick_column(name: Column, columns: Sequence[str]) -> Column:
    """Value of the column that ``name`` names; null if there is none."""
    return F.coalesce(*[F.when(name == c, F.col(c)) for c in columns])


def one_per_subject(df: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """First row per subject; rows of one subject are reduced before the shuffle."""
    first = F.min_by(F.struct(*values), F.col(order))
    return df.groupBy(*SUBJECT).agg(first.alias("_v")).select(*SUBJECT, *[F.col(f"_v.{v}").alias(v) for v in values])


def attach_groups(
    visits: DataFrame,
    groups: DataFrame,
    *,
    order: str,
    columns: Sequence[str] = ("cohort", "strata"),
    row_id: Sequence[str] | None = None,
    keys_from: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Left join of the subject-group extract; its columns get the prefix ``group_``."""
    unique = one_per_subject(groups, order, columns)
    named = unique.select(*SUBJECT, *[F.col(c).alias(f"group_{c}") for c in columns])
    return skew.lookup_join(
        visits, named, SUBJECT, row_id=row_id, sized_by=groups, small=small, keys_from=keys_from
    )


def attach_manual(
    visits: DataFrame,
    template: DataFrame,
    *,
    order: str,
    row_id: Sequence[str] | None = None,
    keys_from: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Left join of the manual template (``studyId, subjectId, subject_group``) as ``manual_arm``."""
    unique = one_per_subject(template, order, ["subject_group"])
    named = unique.withColumnRenamed("subject_group", "manual_arm")
    return skew.lookup_join(
        visits, named, SUBJECT, row_id=row_id, sized_by=template, small=small, keys_from=keys_from
    )


def resolve_arm(
    df: DataFrame,
    *,
    flat_arm: str = "FLAT",
    edc_columns: Sequence[str] = tuple(S.TARGETS),
    group_columns: Sequence[str] = ("cohort", "strata"),
) -> DataFrame:
    """Add ``arm``, null if there is none.

    The frame holds the study's config columns, as :func:`arm_config` gives them, and what the modes in
    use need.
    """
    have = set(df.columns)
    none = F.lit(None).cast("string")

    def given(name: str) -> Column:
        return F.col(name) if name in have else none

    usable = [c for c in edc_columns if c in have]
    from_edc = pick_column(given("edcArmColumn"), usable) if usable else none
    wanted = F.coalesce(given("impalaArmColumn"), F.lit("strata"))
    grouped = [c for c in group_columns if f"group_{c}" in have]
    value = F.coalesce(none, *[F.when(wanted == c, F.col(f"group_{c}")) for c in grouped])
    group, manual = text.blank_to_null(F.col("_group")), text.blank_to_null(given("manual_arm"))
    mapped = F.try_element_at("strataToArmMapping", group) if "strataToArmMapping" in have else none
    mode = F.col("armResolutionMode")
    arm = (
        F.when(mode == "FLAT_RATE", F.lit(flat_arm))
        .when(mode == "EDC_ONLY", from_edc)
        .when(mode == "IMPALA_GROUP_MAP_TO_ARM", mapped)
        .when(mode == "MANUAL_MAPPING", manual)
        .when(mode == "IMPALA_BUDGET_ARM_FROM_COLUMN", group)
        .when(mode == "HYBRID", F.coalesce(manual, group))
    )
    return df.withColumn("_group", value).withColumn("arm", text.blank_to_null(arm)).drop("_group")


def _null_safe(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame with non-null stand-ins of the keys, by which null equals null."""
    stand_ins = {f"_key_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys}
    flags = {f"_none_{k}": F.col(k).isNull() for k in keys}
    return df.withColumns(stand_ins | flags), [*stand_ins, *flags]


def first_arms(rows: DataFrame, *, order: str) -> DataFrame:
    """First arm per subject within the rows; reduced per task before the shuffle."""
    armed = rows.where(F.col("arm").isNotNull())
    return armed.groupBy(*REGISTRY_KEY).agg(F.min_by("arm", order).alias("arm"))


def registered(registry: DataFrame) -> DataFrame:
    """One active row per key: the first by ``createdAt``, then by arm; the table has no unique key."""
    active = registry.where("isActive")
    by_age = [F.coalesce("createdAt", F.lit("9999-12-31").cast("timestamp"))] if "createdAt" in registry.columns else []
    first = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by_age)], F.col("assignedBudgetArm").alias("arm")))
    named = active.where(F.col("assignedBudgetArm").isNotNull()).groupBy(*REGISTRY_KEY).agg(first.alias("first"))
    return named.select(*REGISTRY_KEY, F.col("first.arm").alias("_known"))


def known_arms(rows: DataFrame, registry: DataFrame, *, order: str) -> DataFrame:
    """Arm that stays for each subject: the registered one, else the first of this run. Null keys are equal."""
    seen, keys = _null_safe(first_arms(rows, order=order), REGISTRY_KEY)
    known, _ = _null_safe(registered(registry), REGISTRY_KEY)
    both = seen.withColumnsRenamed({k: f"_seen_{k}" for k in REGISTRY_KEY}).join(known, keys, "full_outer")
    return both.select(
        *[F.coalesce(F.col(k), F.col(f"_seen_{k}")).alias(k) for k in REGISTRY_KEY],
        F.coalesce("_known", "arm").alias("registered_arm"),
        F.col("_known").isNull().alias("is_new"),
    )


def check_registry(
    rows: DataFrame,
    arms: DataFrame,
    *,
    row_id: Sequence[str] | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``registered_arm`` and ``arm_changed``. ``arms`` is best written before, as it is counted."""
    left, keys = _null_safe(rows, REGISTRY_KEY)
    known, _ = _null_safe(arms.drop("is_new"), REGISTRY_KEY)
    cheap = None if keys_from is None else _null_safe(keys_from, REGISTRY_KEY)[0]
    joined = skew.lookup_join(left, known.drop(*REGISTRY_KEY), keys, row_id=row_id, keys_from=cheap).drop(*keys)
    changed = F.col("arm") != F.col("registered_arm")
    return joined.withColumn("arm_changed", F.coalesce(changed, F.lit(False)))


def new_subjects(arms: DataFrame, run_id: str, now: Column, created_by: str) -> DataFrame:
    """Registry rows to append for subjects not seen before."""
    return arms.where("is_new").select(
        *REGISTRY_KEY,
        F.col("registered_arm").alias("assignedBudgetArm"),
        F.lit(run_id).alias("firstSeenRunId"),
        now.alias("createdAt"),
        F.lit(created_by).alias("createdBy"),
        now.alias("updatedAt"),
        F.lit(None).cast("string").alias("updatedBy"),
        F.lit(True).alias("isActive"),
    )


def join_schedule(
    visits: DataFrame,
    schedule: DataFrame,
    *,
    key: Sequence[str] = tuple(SCHEDULE_KEY),
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``optionalVisitFlag`` and ``in_schedule``; of repeated schedule rows the lowest flag counts."""
    unique = schedule.groupBy(*key).agg(F.min("optionalVisitFlag").alias("optionalVisitFlag"))
    named = unique.withColumn("in_schedule", F.lit(True))
    joined = skew.lookup_join(visits, named, list(key), row_id=row_id, sized_by=schedule)
    return joined.withColumn("in_schedule", F.coalesce("in_schedule", F.lit(False)))


def apply_pay_mode(
    df: DataFrame,
    mode: str | Column,
    *,
    order: str,
    key: Sequence[str] = tuple(VISIT_KEY),
    timepoint: str = "timePostDose",
) -> DataFrame:
    """Rows to pay. ``mode`` is one mode, or a column with the mode of each row's study."""
    untimed = text.is_blank(F.col(timepoint).cast("string"))
    if isinstance(mode, str):
        if mode not in S.PAY_MODES:
            raise ValueError(f"Unknown pay mode: {mode}")
        if mode == "PER_TIMEPOINT":
            return df
        return df.where(untimed) if mode == "IGNORE" else first_rows(df, key, [order], 1)
    lump = first_rows(df.where(mode == "LUMP_SUM"), key, [order], 1)
    kept = F.coalesce(mode != "LUMP_SUM", F.lit(True)) & (F.coalesce(mode != "IGNORE", F.lit(True)) | untimed)
    return df.where(kept).unionByName(lump)


def skip_unpaid(df: DataFrame, mode: Column, *, order: str, row_id: Sequence[str], key: Sequence[str] = tuple(VISIT_KEY), timepoint: str = "timePostDose") -> DataFrame:
    """Valid rows that are not paid become ``SKIPPED``; ``mode`` is the pay mode of each row's study, null for per timepoint.

    Only valid rows that are paid as a lump sum are sorted and joined.
    """
    valid = F.col("status") == "VALID"
    timed = ~text.is_blank(F.col(timepoint).cast("string"))
    lump = df.where(valid & (mode == "LUMP_SUM"))
    paid = first_rows(lump, key, [order], 1).select(*[F.col(c).alias(f"_paid_{c}") for c in row_id])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_paid_{c}")) for c in row_id])
    lost = lump.select(*row_id).join(paid, same, "left_anti").distinct().withColumn("_lost", F.lit(True))
    marked = skew.lookup_join(df, lost, list(row_id), row_id=row_id)
    unpaid = F.coalesce(F.col("_lost"), F.lit(False)) | F.coalesce((mode == "IGNORE") & timed, F.lit(False))
    return marked.withColumn("status", F.when(valid & unpaid, "SKIPPED").otherwise(F.col("status"))).drop("_lost")


def contact_reason(has_contact_mode: Column, contact: Column) -> Column:
    """Reason if the study records contact modes and the row has none."""
    return F.when(has_contact_mode & text.is_blank(contact), "visitContactMode is blank.")
