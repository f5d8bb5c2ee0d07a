"""Totals per file and per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill import schema as S


def file_totals(rows: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """Rows per file, and ``more`` aggregates; reduced per task before the shuffle."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), *more)


def run_status(objects: Column) -> Column:
    """``INGESTED`` if any object was written, else ``COMPLETED``; a failed write is set by its caller."""
    return F.when(objects > 0, "INGESTED").otherwise("COMPLETED")


def run_totals(files: DataFrame, by: Sequence[str], *, api_visits: Column) -> DataFrame:
    """Per run: files added, visit files left out as the API gave the visits, rows, objects, status.

    ``files`` has one row per file with ``category`` and ``rows``.
    """
    skipped = api_visits & (F.col("category") == S.SUBJECT_VISIT)
    written = ~skipped & (F.col("rows") > 0)
    return (
        files.groupBy(*by)
        .agg(
            F.count_if(~skipped).alias("filesAdded"),
            F.count_if(skipped).alias("visitFilesSkipped"),
            F.sum(F.when(~skipped, F.col("rows")).otherwise(0)).alias("rowCount"),
            F.count_if(written).alias("objects"),
        )
        .withColumn("ingestionStatus", run_status(F.col("objects")))
    )
