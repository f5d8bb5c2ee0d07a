"""Delimited files in a landing folder: listing, index, rows."""

from __future__ import annotations

import csv
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill.functions import text

# Files up to this size are read as one value; larger ones are read in pieces.
WHOLE_FILE_BYTES = 64 * 1024 * 1024
PIECE_BYTES = 8 * 1024 * 1024
# Characters up to the blank; a line of nothing else is no line, as in Spark's own reader.
BLANKS = bytes(range(33))
# Fixed value: how names begin that Spark's file sources leave out.
HIDDEN = ("_", ".")

# What stands before the name of a staged copy, so that Spark shows it.
VISIBLE = "visible"

LISTING = T.StructType(
    [
        T.StructField("study_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("remote_path", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)
PROBE = T.StructType(
    [
        T.StructField("content_hash", T.StringType()),
        T.StructField("head", T.StringType()),
        T.StructField("header", T.StringType()),
        T.StructField("multi_line", T.BooleanType()),
        T.StructField("has_rows", T.BooleanType()),
    ]
)


def _literal(path: str) -> str:
    """The path with the characters of glob patterns taken as they are."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def _files(spark: SparkSession, landing: str, study_ids: Sequence[str]) -> DataFrame | None:
    """``*.csv`` directly in the studies' folders, by one scan; None if there is none."""
    if not study_ids:
        return None
    folders = ",".join(_literal(s) for s in study_ids)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        files = reader.load(f"{landing.rstrip('/')}/{{{folders}}}/*.csv")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    study = F.element_at(F.split("path", "/"), -2)
    named = files.select("*", F.col("_metadata.file_path").alias("source_path"), study.alias("study_id"))
    # A folder called x.csv is no file; what is in it does not belong to the study.
    return named.where(F.col("study_id").isin(list(study_ids)))


def _listing_columns() -> list[Column]:
    return [
        F.col("study_id"),
        F.col("path"),
        F.col("path").alias("remote_path"),
        # As scans report it, with special characters escaped.
        F.col("source_path"),
        F.substring_index("path", "/", -1).alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    ]


def list_files(spark: SparkSession, landing: str, study_ids: Sequence[str]) -> DataFrame:
    """One row per landed file of the studies; reads no content. Missing folders give no rows."""
    files = _files(spark, landing, study_ids)
    if files is None:
        return spark.createDataFrame([], LISTING)
    return files.select(*_listing_columns())


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


# A line of characters up to the blank, with the line ends after it.
_BLANK_LINES = r"\A(?:[\x00-\x09\x0B\x0C\x0E-\x20]*[\r\n]+)*+"


def probe_content(content: Column) -> list[Column]:
    """Hash, first line, header line and quoting of a file held in one value."""
    body = F.make_valid_utf8(content.cast("string"))
    any_odd = F.exists(F.split(body, "[\r\n]"), _odd_quotes)
    return [
        text.sha256(content).alias("content_hash"),
        F.regexp_extract(body, r"\A[^\r\n]*", 0).alias("head"),
        # The header is the first line that is not blank.
        F.regexp_extract(body, _BLANK_LINES + r"([^\r\n]*)", 1).alias("header"),
        F.when(body.contains('"'), any_odd).otherwise(False).alias("multi_line"),
        body.rlike(_BLANK_LINES + r"[^\r\n]*[\r\n][\x00-\x20]*+[^\x00-\x20]").alias("has_rows"),
    ]


def _file_system() -> Callable:
    """Function that finds pyarrow's file system of a path as Spark names it, and the path there."""

    def system_of(path: str) -> tuple:
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if scheme in ("s3a", "s3n"):
            path = f"s3:{rest}"
        if scheme == "file":
            path = "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(path)

    return system_of


def _copier(piece_bytes: int) -> Callable:
    """Task function that copies ``source`` to ``target`` in pieces; a repeated task leaves one whole copy."""
    system_of = _file_system()

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        for batch in batches:
            for source, target in zip(batch["source"], batch["target"]):
                (there, inner), (here, outer) = system_of(source), system_of(target)
                folder, _, name = outer.rpartition("/")
                here.create_dir(folder, recursive=True)
                draft = f"{folder}/.{uuid.uuid4().hex}"
                with there.open_input_stream(inner) as stream, here.open_output_stream(draft) as sink:
                    while piece := stream.read(piece_bytes):
                        sink.write(piece)
                here.move(draft, f"{folder}/{name}")
            yield batch

    return copy


def stage_hidden(spark: SparkSession, landing: str, study_ids: Sequence[str], place: str) -> list[tuple[str, str]]:
    """Copy ``*.csv`` files whose names Spark hides below ``place``, each by a task of its own, under names that it shows.

    What is copied is returned. The store must be one that pyarrow can open.
    """
    found = hidden_files(spark, landing, study_ids)
    if found:
        pairs = [(f"{landing.rstrip('/')}/{study}/{name}", f"{place}/{study}/{VISIBLE}{name}") for study, name in found]
        listed = spark.createDataFrame(pairs, "source string, target string").repartition(len(pairs), "source")
        listed.mapInPandas(_copier(PIECE_BYTES), listed.schema).write.format("noop").mode("overwrite").save()
    return found


def index_staged(
    spark: SparkSession, landing: str, study_ids: Sequence[str], place: str, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """:func:`index_files` of what :func:`stage_hidden` copied, under the names and paths that the files have where they landed."""
    index = index_files(spark, place, study_ids, whole_file_bytes)
    name = F.substr("file_name", F.lit(len(VISIBLE) + 1))
    remote = F.concat(F.lit(f"{landing.rstrip('/')}/"), "study_id", F.lit("/"), "file_name")
    named = index.withColumn("file_name", name)
    return named.withColumns({"remote_path": remote, "category": text.category(F.col("file_name"))})


def _stream_probe(names: list[str], blanks: bytes, piece_bytes: int) -> Callable:
    """Task function that adds what :func:`probe_content` finds, reading files in pieces.

    Memory does not grow with a file, but for its longest line up to the header. All it needs is inside,
    so that executors need no copy of this package.
    """
    system_of = _file_system()

    def open_stream(path: str):
        system, inner = system_of(path)
        return system.open_input_stream(inner)

    def probe_file(path: str) -> tuple:
        digest = hashlib.sha256()
        first = header = None
        pending = b""
        in_quotes = multi_line = has_rows = False
        with open_stream(path) as stream:
            while piece := stream.read(piece_bytes):
                digest.update(piece)
                piece = piece.replace(b"\r", b"\n")
                if not multi_line and (in_quotes or b'"' in piece):
                    for number, line in enumerate(piece.split(b"\n")):
                        if number:
                            multi_line |= in_quotes
                            in_quotes = False
                        in_quotes ^= line.count(b'"') % 2 == 1
                if header is None:
                    *lines, pending = (pending + piece).split(b"\n")
                    first = lines[0] if first is None and lines else first
                    at = next((i for i, line in enumerate(lines) if line.strip(blanks)), None)
                    if at is not None:
                        header, piece = lines[at], b"\n".join([*lines[at + 1 :], pending])
                if header is not None and not has_rows:
                    has_rows = bool(piece.strip(blanks))
        first, header = (pending if line is None else line for line in (first, header))
        told = [line.decode("utf-8", errors="replace") for line in (first, header)]
        return digest.hexdigest(), *told, multi_line or in_quotes, has_rows

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([probe_file(p) for p in batch["path"]], columns=names, index=batch.index)
            yield pd.concat([batch, found], axis=1)

    return probe


def hidden_files(spark: SparkSession, landing: str, study_ids: Sequence[str]) -> list[tuple[str, str]]:
    """(study, name) of ``*.csv`` files that Spark's file sources do not show, from the file system itself."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for study in study_ids:
        path = jvm.org.apache.hadoop.fs.Path(f"{_literal(landing.rstrip('/'))}/{_literal(study)}/{{{','.join(HIDDEN)}}}*.csv")
        statuses = path.getFileSystem(conf).globStatus(path) or []
        found += [(study, status.getPath().getName()) for status in statuses if status.isFile()]
    return sorted(found)


def index_files(
    spark: SparkSession, landing: str, study_ids: Sequence[str], whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """Listing plus content hash, delimiter, header line and whether a quoted cell spans lines.

    Every byte is read once, as the hash needs it. Small files are one value each and stay in the
    JVM; a larger file is streamed in pieces by one task, so that no file size is out of reach.
    """
    files = _files(spark, landing, study_ids)
    if files is None:
        empty = T.StructType([*LISTING.fields, *PROBE.fields])
        return _with_delimiter(spark.createDataFrame([], empty))
    small = files.where(F.col("length") <= whole_file_bytes).select(
        *_listing_columns(), *probe_content(F.col("content"))
    )
    large = files.where(F.col("length") > whole_file_bytes).select(*_listing_columns())
    if large.isEmpty():
        return _with_delimiter(small)
    # One file per task: large files are few and slow.
    probe = _stream_probe(PROBE.names, BLANKS, PIECE_BYTES)
    streamed = large.repartition("path").mapInPandas(probe, T.StructType([*LISTING.fields, *PROBE.fields]))
    return _with_delimiter(small.unionByName(streamed))


def _with_delimiter(probed: DataFrame) -> DataFrame:
    return probed.select(
        "*",
        text.delimiter(F.col("head")).alias("delimiter"),
        text.category(F.col("file_name")).alias("category"),
    ).drop("head")


@dataclass(frozen=True)
class FileGroup:
    """Files that can be read by one scan."""

    category: str
    delimiter: str
    header: str
    multi_line: bool
    paths: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return header_names(self.header, self.delimiter)


def header_names(header: str, delimiter: str) -> list[str]:
    """Column names of a header line; a repeated name gets ``.1``, ``.2`` and so on."""
    line = header.removeprefix("\ufeff")
    names: list[str] = []
    for cell in next(csv.reader([line], delimiter=delimiter), []):
        name, again = cell, 0
        while name in names:
            again += 1
            name = f"{cell}.{again}"
        names.append(name)
    return names


def file_groups(index: DataFrame) -> list[FileGroup]:
    """Files by category, delimiter, header and quoting.

    Only paths and headers reach the driver, as any Spark file scan lists its files there.
    """
    grouped = (
        index.where(F.col("header").rlike(r"[^\x00-\x20]"))
        .groupBy("category", "delimiter", "header", "multi_line")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
    )
    rows = grouped.orderBy("category", "delimiter", "header", "multi_line").collect()
    return [FileGroup(r.category, r.delimiter, r.header, r.multi_line, tuple(r.paths)) for r in rows]


def _read(
    spark: SparkSession, delimiter: str, multi_line: bool, paths: Sequence[str], cells: list[str]
) -> DataFrame:
    """Rows of files by one scan, with cells named ``cells`` from the left, and where each row came from."""
    fields = [T.StructField(c, T.StringType()) for c in cells]
    reader = spark.read.options(sep=delimiter, header=True, escape='"', mode="PERMISSIVE")
    if multi_line:
        # A line of blanks is no row. Without multiLine, Spark leaves such lines out itself.
        fields.append(T.StructField("_bad", T.StringType()))
        reader = reader.options(multiLine=True, columnNameOfCorruptRecord="_bad")
    rows = reader.schema(T.StructType(fields)).csv([_literal(p) for p in paths])
    located = rows.select(
        "*",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )
    if multi_line:
        # The last cell is one beyond any header, so every row is short and its raw record is there to be looked at.
        blank = (text.strip(F.col("_bad")) == "") & (text.strip(F.col(cells[0])) == "")
        located = located.where(~F.coalesce(blank, F.lit(False))).drop("_bad")
    return located


def read_group(spark: SparkSession, group: FileGroup) -> DataFrame:
    """Rows of a group: cells as text columns ``c0``, ``c1``, …, and where each row came from.

    Within a file, ``(source_block, source_row)`` ascends in file order. ``surplus`` is the first cell
    beyond the header's, null if the row has no more cells or that one is empty.
    """
    cells = [f"c{i}" for i in range(len(group.columns))]
    rows = _read(spark, group.delimiter, group.multi_line, group.paths, [*cells, "_more"])
    return rows.select(
        *[text.na_to_null(F.col(c)).alias(c) for c in cells], F.col("_more").alias("surplus"),
        "source_path", "source_block", "source_row",
    )


def read_cells(
    spark: SparkSession, delimiter: str, multi_line: bool, paths: Sequence[str], width: int
) -> DataFrame:
    """Rows of files of any headers of up to ``width`` columns, as an array ``cells`` of ``width`` + 1 raw texts."""
    names = [f"c{i}" for i in range(width + 1)]
    rows = _read(spark, delimiter, multi_line, paths, names)
    return rows.select(F.array(*names).alias("cells"), "source_path", "source_block", "source_row")


def read_files(spark: SparkSession, groups: Iterable[FileGroup]) -> DataFrame:
    """All groups stacked under their own column names; a name a file lacks is null there."""
    frames = []
    for group in groups:
        rows = read_group(spark, group)
        names = [F.col(f"c{i}").alias(n) for i, n in enumerate(group.columns)]
        frames.append(rows.select(*names, "source_path", "source_block", "source_row"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
