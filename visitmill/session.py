"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON pages may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the local bench. On a cluster, use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("visitmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="visitmill-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only where the setting is missing *and* the master is local does a temporary folder stand in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach.")
    return _local_folder()


_JOB: ContextVar[str | None] = ContextVar("job_folder", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder of the job that runs, else below the shared folder."""
    return os.path.join(_JOB.get() or shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """One folder for what a job writes on its way; it goes when the job ends, however it ends.

    Only for jobs that leave nothing behind that still reads from there. A job within a job shares its folder.
    """
    if _JOB.get():
        yield _JOB.get()
        return
    folder = new_folder(spark, "job")
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; survives the loss of executors."""
    path = new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
