"""Row status of normalized visits: skip, eligibility, arm, registry."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill import schema as S
from visitmill.functions import skew
from visitmill.operators import arms, eligibility
from visitmill.session import cut_lineage, job_folder
from visitmill.sinks import publish
from visitmill.sinks.normalized import write_split

CONFIG = [
    "armResolutionMode", "edcArmColumn", "payableSubjectStatuses", "nonPayableSubjectStatuses",
    "hasVisitContactMode", "impalaArmColumn", "strataToArmMapping",
]
STATUS_LISTS = ["payableSubjectStatuses", "nonPayableSubjectStatuses"]


def attach_config(visits: DataFrame, configs: DataFrame, *, row_id: Sequence[str] | None = None) -> DataFrame:
    """Left join of the study's config by study, with its lists and maps parsed before the join."""
    usable = [c for c in CONFIG if c in configs.columns]
    lists = {c: eligibility.listed(F.col(c)) for c in STATUS_LISTS}
    parsed = arms.arm_config(configs.select("studyId", *usable).withColumns(lists))
    return skew.lookup_join(visits, parsed, ["studyId"], row_id=row_id, keys_from=visits)


@dataclass(frozen=True)
class Validated:
    """Visits with their status, and the arm of each subject (for the registry)."""

    rows: DataFrame
    arms: DataFrame


def validate(
    visits: DataFrame,
    configs: DataFrame,
    rules: Sequence[eligibility.Rule] | DataFrame,
    registry: DataFrame,
    *,
    order: str,
    row_id: Sequence[str],
    groups: DataFrame | None = None,
    manual: DataFrame | None = None,
    group_order: str = "ordinal",
    flat_arm: str = "FLAT",
) -> Validated:
    """Add ``status``, ``reasons``, ``blocking``, ``arm`` and ``registered_arm`` to each visit.

    ``rules`` is the rule table, or a short list of rules, which become expressions.
    """
    rows = attach_config(visits, configs, row_id=row_id)
    shared = {"order": group_order, "row_id": row_id, "keys_from": visits}
    moved = False
    if groups is not None:
        small = skew.fits_broadcast(groups)
        rows, moved = arms.attach_groups(rows, groups, small=small, **shared), not small
    if manual is not None:
        small = skew.fits_broadcast(manual)
        rows, moved = arms.attach_manual(rows, manual, small=small, **shared), moved or not small
    if isinstance(rules, DataFrame):
        rows = eligibility.evaluate_table(rows, rules, row_id=row_id)
    else:
        rows = eligibility.evaluate(rows, rules)
    if "hasVisitContactMode" in rows.columns:
        contact = arms.contact_reason(F.col("hasVisitContactMode"), F.col("visitContactMode"))
        rows = rows.withColumn("reasons", F.concat("reasons", eligibility.listed_if(contact.isNotNull(), contact)))
    rows = arms.resolve_arm(rows, flat_arm=flat_arm)
    skipped = eligibility.status_skips(
        F.col("subjectStatus"), F.col("payableSubjectStatuses"), F.col("nonPayableSubjectStatuses")
    )
    # Config and group columns have done their work.
    rows = rows.select(
        *visits.columns, "reasons", "blocking", "arm", skipped.alias("_skipped"),
        F.col("studySiteNumber").alias("siteId"),
    )
    if moved:
        # The rows are read twice from here on; to write them costs less than to shuffle them again.
        rows = cut_lineage(rows)
    # Only rows that get this far can give a subject its arm.
    ready = rows.where(~F.col("_skipped") & (F.size("reasons") == 0))
    known = cut_lineage(arms.known_arms(ready, registry, order=order))
    keys = visits.select("studyId", F.col("studySiteNumber").alias("siteId"), "subjectId")
    rows = arms.check_registry(rows, known, row_id=row_id, keys_from=keys)
    status = eligibility.row_status(
        F.col("_skipped"), F.size("reasons") > 0, F.col("arm").isNull(), F.col("arm_changed")
    )
    return Validated(rows.withColumn("status", status).drop("_skipped", "arm_changed", "siteId"), known)


LOG = T.StructType(
    [
        T.StructField("runId", T.StringType()),
        T.StructField("studyId", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("totalRows", "validRows", "skippedRows")],
        T.StructField("blocked", T.BooleanType()),
        T.StructField("createdAt", T.TimestampType()),
    ]
)
ROWS, REGISTRY, LOG_TABLE = "validated", "subject_registry", "validation_log"


def validate_run(
    spark: SparkSession,
    visits: DataFrame,
    configs: DataFrame,
    rules: Sequence[eligibility.Rule] | DataFrame,
    output: str,
    run_id: str,
    *,
    order: str,
    row_id: Sequence[str],
    schedule: DataFrame | None = None,
    created_by: str = "validation-task",
    **more,
) -> None:
    """Validate the visits of a run and publish what comes of it below ``output``.

    ``validated/run_id=…`` gets the rows with their status, valid ones apart; with a ``schedule`` they carry its flag, and
    valid ones are cut down by the study's ``pkPayMode`` if the config has it: what is not paid is
    ``SKIPPED``. ``subject_registry`` gets the subjects seen for the first time, and is the registry of
    the next run. ``validation_log`` gets the counts per study.

    A run is published once, all three tables together: a run id that is published already is left as it is, and what an
    interrupted attempt wrote does not count. :func:`published` reads the tables.
    """
    tables = [ROWS, REGISTRY, LOG_TABLE]
    with job_folder(spark), publish.attempt(spark, output, run_id, tables) as attempt:
        if attempt is None:
            return
        validated, registry, log = (publish.folder_of(spark, output, t, run_id, attempt) for t in tables)
        checked = validate(visits, configs, rules, published(spark, output, REGISTRY), order=order, row_id=row_id, **more)
        rows = checked.rows
        if schedule is not None:
            rows = arms.join_schedule(rows, schedule, row_id=row_id)
        if "pkPayMode" in configs.columns:
            modes = configs.select("studyId", F.col("pkPayMode").alias("_mode"))
            rows = skew.lookup_join(rows, modes, ["studyId"], row_id=row_id, keys_from=visits)
            rows = cut_lineage(arms.skip_unpaid(rows, F.col("_mode"), order=order, row_id=row_id).drop("_mode"))
        rows = cut_lineage(eligibility.split_valid(rows))
        write_split(rows, validated)
        now = F.current_timestamp()
        new = arms.new_subjects(checked.arms, run_id, now, created_by)
        named = new.withColumns({c: F.lit(None).cast(S.SUBJECT_REGISTRY[c].dataType) for c in S.SUBJECT_REGISTRY.names if c not in new.columns})
        named.select(*S.SUBJECT_REGISTRY.names).write.parquet(registry)
        counts = eligibility.status_counts(rows, ["studyId"])
        counts.select(F.lit(run_id).alias("runId"), *LOG.names[1:-1], now.alias("createdAt")).write.parquet(log)


def published(spark: SparkSession, output: str, table: str) -> DataFrame:
    """``subject_registry`` or ``validation_log`` of all published runs."""
    schema = {REGISTRY: S.SUBJECT_REGISTRY, LOG_TABLE: LOG}[table]
    return publish.read(spark, output, table, schema).select(*schema.names)
