"""Normalized Parquet, one folder per study, run and object."""

from __future__ import annotations

from pyspark.sql import DataFrame

from visitmill.sources.tables import ORDER, PLACE, SURPLUS, normalized_root
from visitmill import schema as S


def write_normalized(rows: DataFrame, output: str) -> None:
    """Append in one job, without a shuffle: each scan task writes into its files' folders.

    Spark commits the files of a job together, so a failed write leaves no object.
    """
    placed = rows.select(*S.TARGETS, *ORDER, SURPLUS, *PLACE)
    placed.write.mode("append").partitionBy(*PLACE).parquet(normalized_root(output))


def write_split(rows: DataFrame, path: str) -> None:
    """Valid and other rows side by side, as the folders ``is_valid=true`` and ``is_valid=false``."""
    rows.write.mode("append").partitionBy("is_valid").parquet(path)
