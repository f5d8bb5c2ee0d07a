"""Seed of a tenant's rule tables from a file."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import text
from visitmill.operators import upsert
from visitmill.session import job_folder
from visitmill.sinks import versions


def seed_tenant(spark: SparkSession, tenant: str, path: str, tables: str, *, lines: bool = False) -> None:
    """Upsert the eligibility rules and the three mapping sections; each table is written once.

    ``path`` is a JSON file or a folder of them; with ``lines`` each line is a document of its own.
    """
    with job_folder(spark):
        _seed(spark, tenant, path, tables, lines)


def _seed(spark: SparkSession, tenant: str, path: str, tables: str, lines: bool) -> None:
    root = f"{tables.rstrip('/')}/{text.check_tenant(tenant)}"
    sections = upsert.read_seed(spark, path, lines=lines)
    now = F.lit(datetime.now(UTC)).cast("timestamp")
    seeds = sections.get("eligibility_rule")
    if seeds is not None:
        versions.update(spark, f"{root}/eligibility_rule", S.ELIGIBILITY_RULE, lambda base: upsert.seed_rules(base, seeds, now))
    seeded = [(c, sections[s]) for s, c in upsert.SEED_SECTIONS.items() if c and s in sections]
    if seeded:
        versions.update(spark, f"{root}/data_column_mapping", S.COLUMN_MAPPING, lambda base: upsert.seed_mappings(base, seeded, now))
