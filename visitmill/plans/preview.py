"""First rows and totals of the objects of a run."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import text
from visitmill.operators.mapping import first_rows
from visitmill.session import cut_lineage, job_folder
from visitmill.sources import tables


def preview_rows(
    rows: DataFrame,
    per: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    limit: int = S.PREVIEW_DEFAULT,
    *,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per object: total rows, and its first rows as JSON texts in order (at most 100)."""
    limit = text.check_limit(limit)
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    head = first_rows(rows, per, order, limit).select(*per, F.struct(*order, record.alias("_json")).alias("_r"))
    ordered = F.transform(F.sort_array(F.collect_list("_r")), lambda r: r["_json"])
    heads = head.groupBy(*per).agg(ordered.alias("rows"))
    if totals is None:
        totals = rows.groupBy(*per).agg(F.count("*").alias("totalRowsInFile"))
    return totals.join(heads, list(per)).withColumn("previewRowCount", F.size("rows"))


def preview_objects(rows: DataFrame, limit: int = S.PREVIEW_DEFAULT) -> DataFrame:
    """Preview of a run's objects without sorting them.

    Rows are counted per object and source block, for which one column is read. That gives the totals,
    and the last block that any first rows lie in; Parquet statistics skip what comes after it.
    """
    block = tables.ORDER[0]
    blocks = cut_lineage(rows.groupBy("source_stem", block).agg(F.count("*").alias("n")))
    earlier = Window.partitionBy("source_stem").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    needed = blocks.withColumn("_before", before).where(F.col("_before") < limit)
    last = needed.agg(F.max(block)).first()[0] or 0
    totals = blocks.groupBy("source_stem").agg(F.sum("n").alias("totalRowsInFile"))
    head = rows.where(F.col(block) <= last)
    return preview_rows(head, ["source_stem"], tables.ORDER, S.TARGETS, limit, totals=totals)


def preview_run(
    spark: SparkSession, output: str, study_id: str, run_id: str, *, limit: int = S.PREVIEW_DEFAULT,
    bucket: str | None = None,
) -> dict[str, Any]:
    """Preview of all objects of a run, by name. At most ``limit`` rows per object reach the driver."""
    study, run = text.check_study_id(study_id), text.check_run_id(run_id)
    limit = text.check_limit(limit)
    prefix = f"normalized/{tables.run_folder(study, run)}/"
    try:
        rows = tables.read_run(spark, output, study, run)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    else:
        with job_folder(spark):
            found = preview_objects(rows, limit).orderBy("source_stem").collect()
    objects = [
        {
            "key": f"{prefix}source_stem={r.source_stem}",
            "filename": f"{r.source_stem}.parquet",
            "totalRowsInFile": r.totalRowsInFile,
            "columns": list(S.TARGETS),
            "previewRowCount": r.previewRowCount,
            "rows": [json.loads(t) for t in r.rows],
        }
        for r in found
    ]
    return {
        "studyId": study,
        "runId": run,
        "bucket": bucket,
        "prefix": prefix,
        "parquetCount": len(objects),
        "objects": objects,
    }
