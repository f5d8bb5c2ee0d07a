"""What the operators share: registry, remainders, Arrow batches, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

# Bytes of a batch that goes to Python; each task holds about two, in the JVM and in Python.
BATCH_BYTES, BATCH_SETTING = 3 * 1024 * 1024, "spark.sql.execution.arrow.maxBytesPerBatch"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Blanks of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same result."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(id_column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % by


def held_out(id_column: str, by: int, rest: int) -> Column:
    """Whether a row is kept from training; a row without id is not, and is not learned from either."""
    return F.coalesce(remainder(id_column, by) == rest, F.lit(False))


def slices(batch: pa.RecordBatch, text: str, most: int = 8 * 1024 * 1024) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of about ``most`` bytes of text, so that Python holds little at a time."""
    sizes = pa.compute.binary_length(batch.column(text)).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + (size or 0) > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size or 0
    if start < len(sizes):
        yield batch.slice(start)


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark cut batches for Python by ``BATCH_BYTES``, unless the session names a bound of its own.

    Spark's default is 64 MB, which its buffers may hold twice as they grow. The bound is the session's, as
    plans are run after the operator has returned.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def uniform(seed: int, *columns: str) -> Column:
    """A number from 0 up to 1 that is a function of the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)).cast("double") / float(1 << 52)


def sample_window(text: str, chars: int, seed: int) -> Column:
    """The text, or of a longer one a window of ``chars`` code points at a place that its content decides."""
    length = F.length(text)
    start = F.pmod(F.xxhash64(F.lit(seed), text), F.greatest(length - chars + 1, F.lit(1)).cast("long")).cast("int") + 1
    return F.when(length <= chars, F.col(text)).otherwise(F.substring(F.col(text), start, F.lit(chars)))


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """The schema with the columns of ``ddl`` after it."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])
