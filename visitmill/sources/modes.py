"""Which rows a study takes: files, API, or API visits with the other files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew


def takes_api(mode: Column, api_ok: Column) -> Column:
    return (mode == "API_ONLY") | ((mode == "API_FIRST") & api_ok)


def takes_file(mode: Column, api_ok: Column, category: Column) -> Column:
    """``API_FIRST`` takes all files if the API failed, else those that are no visits.

    An API that answered without rows did not fail.
    """
    first = (mode == "API_FIRST") & (~api_ok | (category != S.SUBJECT_VISIT))
    return (mode == "SFTP_ONLY") | first


def compose(api: DataFrame, files: DataFrame, status: DataFrame, study: str) -> DataFrame:
    """Stack API and file rows per study.

    ``status`` has one row per study: ``mode``, ``api_ok``. ``files`` has ``category``.
    """
    mode, api_ok = F.col("mode"), F.col("api_ok")
    chosen_api = skew.lookup_join(api, status, [study], how="inner").where(takes_api(mode, api_ok))
    chosen_files = skew.lookup_join(files, status, [study], how="inner").where(
        takes_file(mode, api_ok, F.col("category"))
    )
    origin = "dataSource"
    return chosen_api.withColumn(origin, F.lit("API")).unionByName(
        chosen_files.withColumn(origin, F.lit("SFTP")), allowMissingColumns=True
    )
