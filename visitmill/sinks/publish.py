"""Results of a run, published whole or not at all.

An attempt writes its tables into folders of its own. A marker, made by one atomic rename, then names the attempt that counts;
readers follow markers. So a run that is repeated, interrupted or started twice at once has one result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKERS = "published"
PLACE = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("attempt", T.StringType())])


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def claim(spark: SparkSession, path: str, content: str) -> bool:
    """Make the file ``path`` with this content; False if it is there already. As atomic as the store's rename."""
    place, system = _path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, place, keep)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder, but for hidden ones; none if there is no folder."""
    place, system = _path(spark, folder)
    if not system.exists(place):
        return []
    return sorted(n for s in system.listStatus(place) if not (n := s.getPath().getName()).startswith("."))


def remove(spark: SparkSession, folder: str) -> None:
    place, system = _path(spark, folder)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    place, system = _path(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def escaped(spark: SparkSession, run_id: str) -> str:
    """The run id as Spark writes it into a partition's folder name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)


def folder_of(spark: SparkSession, output: str, table: str, run_id: str, attempt: str) -> str:
    return f"{output.rstrip('/')}/{table}/run_id={escaped(spark, run_id)}/attempt={attempt}"


def is_published(spark: SparkSession, output: str, run_id: str) -> bool:
    place, system = _path(spark, f"{output.rstrip('/')}/{MARKERS}/{escaped(spark, run_id)}")
    return system.exists(place)


def read(spark: SparkSession, output: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of a table that published attempts wrote, with ``run_id`` and ``attempt``; none if there are no such."""
    root, whole = output.rstrip("/"), T.StructType([*schema.fields, *PLACE.fields])
    try:
        lines = F.split("value", "\n", 2)
        marks = spark.read.text(f"{root}/{MARKERS}", wholetext=True).select(lines[0].alias("_attempt"), lines[1].alias("_run"))
        rows = spark.read.schema(whole).parquet(f"{root}/{table}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)
    same = (F.col("run_id") == F.col("_run")) & (F.col("attempt") == F.col("_attempt"))
    return rows.join(marks, same, "left_semi")


@contextmanager
def attempt(spark: SparkSession, output: str, run_id: str, tables: Sequence[str]) -> Iterator[str | None]:
    """An attempt at a run: its name, or None if the run is published.

    When the block ends well, the attempt is published, unless another one was first; what does not count is removed,
    also what attempts before it left behind. When the block fails, its folders go.
    """
    if is_published(spark, output, run_id):
        yield None
        return
    own, won = uuid.uuid4().hex, False
    try:
        yield own
        won = claim(spark, f"{output.rstrip('/')}/{MARKERS}/{escaped(spark, run_id)}", f"{own}\n{run_id}")
    finally:
        for table in tables:
            folder = f"{output.rstrip('/')}/{table}/run_id={escaped(spark, run_id)}"
            left = names(spark, folder) if won else [f"attempt={own}"]
            for name in left:
                if not won or name != f"attempt={own}":
                    remove(spark, f"{folder}/{name}")
