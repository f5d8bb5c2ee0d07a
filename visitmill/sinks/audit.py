"""Audit tables: one row per run, one row per file read. Append only.

The tables have no number generator; ``runId`` (and the file name) identify a row, ``id`` stays null.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import text


def file_log(index: DataFrame, runs: DataFrame, now: datetime) -> DataFrame:
    """One row per file read, also for empty files.

    ``runs`` has ``study_id, run_id, sponsor_id``. A store reports no creation and no access time.
    """
    none = F.lit(None).cast("timestamp")
    return index.join(runs, "study_id").select(
        F.lit(None).cast("int").alias("id"),
        F.col("run_id").alias("runId"),
        F.col("study_id").alias("studyId"),
        F.col("sponsor_id").alias("sponsorId"),
        F.col("remote_path").alias("remotePath"),
        F.col("file_name").alias("fileName"),
        text.category(F.col("file_name")).alias("mappingCategory"),
        text.sha256(F.col("file_name")).alias("fileNameHash"),
        F.col("content_hash").alias("fileContentHash"),
        none.alias("sourceCreatedAt"),
        F.col("modified").alias("sourceUpdatedAt"),
        none.alias("sourceAccessedAt"),
        F.lit(now).cast("timestamp").alias("createdAt"),
    )


def run_log(spark: SparkSession, runs: list[dict], now: datetime) -> DataFrame:
    """One row per run, with its counts; the validation columns stay null until rows are validated."""
    fixed = {"createdAt": now, "updatedAt": now, "createdBy": "ingestion-task", "isActive": True}
    rows = [[{**fixed, **run}.get(name) for name in S.RUN_LOG_COUNTS.names] for run in runs]
    return spark.createDataFrame(rows, S.RUN_LOG_COUNTS)


def append(df: DataFrame, output: str, table: str) -> None:
    df.write.mode("append").parquet(f"{output.rstrip('/')}/{table}")
