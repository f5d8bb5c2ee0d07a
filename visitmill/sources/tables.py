"""Config lookups and scans of written runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill import schema as S
from visitmill.functions import skew, text

# Characters that Spark writes as %XX in partition folders.
_ESCAPED = "\"#%'*/:=?\\{[]^\x7f"

PLACE = ["study_id", "run_id", "source_stem"]
ORDER = ["_source_block", "_source_row"]
# First cell of a file row beyond those of its header.
SURPLUS = "_surplus"
WRITTEN = T.StructType(
    [
        *S.NORMALIZED.fields,
        *[T.StructField(c, T.LongType()) for c in ORDER],
        T.StructField(SURPLUS, T.StringType()),
        *[T.StructField(c, T.StringType()) for c in PLACE],
    ]
)


def first_by_id(table: DataFrame) -> DataFrame:
    return table.orderBy("id").limit(1)


def sponsor_row(sponsors: DataFrame) -> DataFrame:
    """First active sponsor row."""
    return first_by_id(sponsors.where("isActive"))


def study_row(configs: DataFrame, study_id: str) -> DataFrame:
    return first_by_id(configs.where(F.col("studyId") == study_id))


def config_for(studies: DataFrame, configs: DataFrame, tenant: str, *, study: str = "studyId") -> DataFrame:
    """Many studies at once: left join of their config, with the tenant where it names no sponsor."""
    named = configs.select(F.col("studyId").alias(study), "sponsorId")
    joined = skew.lookup_join(studies, named, [study])
    return joined.withColumn("sponsorId", text.sponsor(F.col("sponsorId"), F.lit(tenant)))


def normalized_root(output: str) -> str:
    return f"{output.rstrip('/')}/normalized"


def run_folder(study_id: str, run_id: str) -> str:
    """Folder of a run below the root; characters that Spark escapes in folder names are escaped."""
    study = "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in study_id)
    return f"study_id={study}/run_id={run_id}"


def read_run(spark: SparkSession, output: str, study_id: str, run_id: str) -> DataFrame:
    """Rows of one run; only the run's own folder is listed."""
    return read_some_runs(spark, output, [(study_id, run_id)])


def read_some_runs(spark: SparkSession, output: str, runs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of the given runs, as far as they have any; no other run's folder is listed."""
    root = normalized_root(output)
    folders = ",".join(run_folder(*run).replace(",", "\\,").replace("}", "\\}") for run in runs)
    return spark.read.schema(WRITTEN).option("basePath", root).parquet(f"{root}/{{{folders}}}")


def read_runs(spark: SparkSession, output: str) -> DataFrame:
    """Rows of all runs; filters on study and run prune folders."""
    return spark.read.schema(WRITTEN).parquet(normalized_root(output))


def list_objects(spark: SparkSession, output: str, study_id: str, run_id: str) -> DataFrame:
    """Parquet files of a run by path; reads no rows."""
    root = f"{normalized_root(output)}/{run_folder(study_id, run_id)}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    named = files.select("path", "length", "modificationTime")
    return named.where(F.lower("path").endswith(".parquet")).orderBy("path")


def targets(rows: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(*keep, *S.TARGETS)
