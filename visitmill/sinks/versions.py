"""Rule tables kept as versions: a write makes a folder of its own, then claims the next version for it.

A plan may read the old version while it writes the new one; a write that fails changes nothing. Of two writers of one
table, the second to claim a version reads what the first made of it and applies its change to that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from visitmill.sinks import publish


def current_version(spark: SparkSession, root: str) -> int:
    """0 if there is none yet."""
    return max((int(n) for n in publish.names(spark, f"{root}/versions")), default=0)


def _read(spark: SparkSession, root: str, version: int, schema: T.StructType) -> DataFrame:
    if not version:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/rows/{publish.read_text(spark, f'{root}/versions/{version}')}")


def read_current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return _read(spark, root, current_version(spark, root), schema)


def update(spark: SparkSession, root: str, schema: T.StructType, change: Callable[[DataFrame], DataFrame]) -> int:
    """Write what ``change`` makes of the current rows as the next version, and return its number.

    If another writer claims that number first, the change is made anew on its rows; each round lost is one that another writer won.
    """
    while True:
        version = current_version(spark, root)
        name = f"{version + 1}-{uuid.uuid4().hex}"
        try:
            change(_read(spark, root, version, schema)).write.parquet(f"{root}/rows/{name}")
            if publish.claim(spark, f"{root}/versions/{version + 1}", name):
                return version + 1
        except BaseException:
            publish.remove(spark, f"{root}/rows/{name}")
            raise
        publish.remove(spark, f"{root}/rows/{name}")
