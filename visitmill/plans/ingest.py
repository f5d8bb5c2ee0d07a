"""Ingest of studies: landed files and API pages to normalized Parquet, audits and a summary.

All studies of a call share one plan: one scan per file shape, one write. The driver holds names only:
studies, paths, headers, mapping rules and one total per object.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew, text
from visitmill.operators import mapping, summary
from visitmill.operators.stems import unique_stems
from visitmill.session import cut_lineage, job_folder, new_folder
from visitmill.sinks import audit
from visitmill.sinks.normalized import write_normalized
from visitmill.sources import landing as L
from visitmill.sources import pages as P
from visitmill.sources import tables

RUN_TABLE = "file_ingestion_log"
FILE_TABLE = "sftp_file_read_log"
# Headers up to this many get a scan of their own, which stays in generated code; the result is the same.
SCANS = 24


@dataclass(frozen=True)
class Settings:
    """Where things are. ``landing`` holds one folder per study; ``output`` gets all tables.

    Files above ``whole_file_bytes`` are hashed by streaming them, which needs a store that pyarrow can
    open (local, s3, gs, hdfs); up to 2 GB they may be read as one value instead. Files whose names begin with ``_`` or ``.`` are hidden from
    Spark's file sources: with ``read_hidden`` copies of them under other names are read, which needs such a store too; else they are told in the run's reason.
    """

    landing: str
    output: str
    tenant: str
    source_mode: str | None = None
    page_size: int = S.PAGE_SIZE
    file_host: str | None = None
    api_base_url: str | None = None
    bucket: str | None = None
    staging_prefix: str | None = None
    whole_file_bytes: int = L.WHOLE_FILE_BYTES
    read_hidden: bool = False


@dataclass
class Run:
    study_id: str
    run_id: str
    sponsor_id: str
    mode: str
    api_rows: bool = False
    api_failed: bool = False
    status: str = "COMPLETED"
    reason: str | None = None
    objects: dict[str, int] = field(default_factory=dict)
    rows_fetched: int = 0
    files_added: int = 0
    visit_files_skipped: int = 0
    notes: list[str] = field(default_factory=list)

    @property
    def data_source(self) -> str:
        wants_api = self.mode == "API_ONLY" or (self.mode == "API_FIRST" and not self.api_failed)
        return "API" if wants_api else "SFTP"

    @property
    def rows(self) -> int:
        return sum(self.objects.values())

    @property
    def failed(self) -> bool:
        return self.status == "FAILED"

    def fail(self, reason: object) -> None:
        self.status, self.reason, self.objects = "FAILED", str(reason)[:2048], {}

    def keys(self) -> list[str]:
        place = f"normalized/{tables.run_folder(self.study_id, self.run_id)}"
        return [f"{place}/source_stem={stem}" for stem in self.objects]


def start_runs(
    spark: SparkSession,
    study_ids: Sequence[str],
    settings: Settings,
    *,
    configs: DataFrame | None,
    sponsors: DataFrame | None,
    mode: str | None,
) -> list[Run]:
    """One run per study, with its mode and sponsor by precedence."""
    tenant = text.check_tenant(settings.tenant)
    studies = [text.check_study_id(s) for s in study_ids]
    row = tables.sponsor_row(sponsors).first() if sponsors is not None else None
    wanted = spark.createDataFrame(
        [(mode, row.subjectVisitSourceMode if row else None, settings.source_mode)],
        "argument string, configured string, setting string",
    )
    chosen = wanted.select(
        text.resolve_mode(F.col("argument"), F.col("configured"), F.col("setting")).alias("m")
    ).first()["m"]
    sponsors_by_study: dict[str, str] = {}
    if configs is not None:
        named = spark.createDataFrame([(s,) for s in studies], "studyId string")
        rows = tables.config_for(named, configs, tenant).collect()
        sponsors_by_study = {r.studyId: r.sponsorId for r in rows}
    return [
        Run(s, str(uuid.uuid4()), sponsors_by_study.get(s, tenant), chosen) for s in dict.fromkeys(studies)
    ]


def _pull(pages: DataFrame | None, runs: list[Run], settings: Settings) -> DataFrame | None:
    """Pages that belong to the pulls of the studies that ask the API; marks the runs whose pull failed.

    A study that takes nothing but API rows fails without a usable pull; the others are not touched.

    Bodies are parsed once for the page index, which is written, and once more for the rows.
    """
    asking = [r for r in runs if r.mode != "SFTP_ONLY"]
    if not asking:
        return None
    problems: dict[str, str | None] = {}
    fetched: dict[str, int] = {}
    wanted = known = None
    pull = ["study_id"]
    if pages is not None:
        wanted = pages.where(F.col("study_id").isin([r.study_id for r in asking]))
        parsed = P.parse_pages(wanted)
        index = cut_lineage(
            P.index_pages(parsed, pull, page_size=max(1, settings.page_size), columns=S.TARGETS)
        )
        extent = cut_lineage(P.pull_extent(index, pull))
        known = cut_lineage(P.pull_columns(index, extent, pull))
        problems = {r.study_id: r.problem for r in extent.collect()}
        fetched = {r.study_id: r.row_count or 0 for r in known.select("study_id", "row_count").collect()}
    for run in asking:
        run.api_failed = run.study_id not in problems or problems[run.study_id] is not None
        run.rows_fetched = fetched.get(run.study_id, 0)
        run.api_rows = run.rows_fetched > 0
        if run.api_failed and run.mode == "API_ONLY":
            run.fail(f"No usable API pages: {problems.get(run.study_id, 'none landed')}")
    return None if wanted is None else P.pages_in_pull(wanted, known, pull)


def _index(spark: SparkSession, runs: list[Run], settings: Settings) -> DataFrame:
    """Index of the files the runs take; written once, as it reads every byte.

    If it fails, halves of the studies are indexed by themselves, down to those with unreadable files: files only add
    to a pull that worked, but without it they are all there is, and the run fails.
    """
    taking = [r for r in runs if r.mode != "API_ONLY"]

    def indexed(studies: list[str]) -> DataFrame:
        index = L.index_files(spark, settings.landing, studies, settings.whole_file_bytes)
        if settings.read_hidden:
            place = new_folder(spark, "hidden")
            if L.stage_hidden(spark, settings.landing, studies, place):
                index = index.unionByName(L.index_staged(spark, settings.landing, studies, place, settings.whole_file_bytes))
        return cut_lineage(index)

    def search(some: list[Run]) -> list[DataFrame]:
        try:
            return [indexed([r.study_id for r in some])]
        except Exception as error:  # which study it was shows below
            if len(some) > 1:
                return [part for half in _halves(some) for part in search(half)]
            if some and (some[0].mode == "SFTP_ONLY" or some[0].api_failed):
                some[0].fail(error)
            return []

    index = reduce(DataFrame.unionByName, search(taking) or [L.index_files(spark, settings.landing, [])])
    with_api = [r.study_id for r in taking if r.mode == "API_FIRST" and not r.api_failed]
    from_api = F.col("study_id").isin(with_api)
    files = index.select("study_id", "category", F.col("has_rows").cast("long").alias("rows"))
    by_study = {r.study_id: r for r in summary.run_totals(files, ["study_id"], api_visits=from_api).collect()}
    for run in taking:
        if (found := by_study.get(run.study_id)) is not None:
            run.files_added, run.visit_files_skipped = found.filesAdded, found.visitFilesSkipped
    return index.where(~(from_api & (F.col("category") == S.SUBJECT_VISIT)))


def _places(spark: SparkSession, index: DataFrame, runs: list[Run]) -> DataFrame:
    """Run and unique stem per source; the API comes first, then files by name. Empty ones get none.

    A file log has as many rows as Spark's own file listing, so a window per study is enough here.
    """
    ids = spark.createDataFrame([(r.study_id, r.run_id) for r in runs], "study_id string, run_id string")
    api = [(r.study_id, None, S.API_LABEL) for r in runs if r.api_rows]
    labels = spark.createDataFrame(api, "study_id string, source_path string, label string").unionByName(
        index.where("has_rows").select("study_id", "source_path", F.col("file_name").alias("label"))
    )
    order = Window.partitionBy("study_id").orderBy(F.col("source_path").isNotNull(), "label")
    numbered = labels.withColumn("arrival", F.row_number().over(order).cast("long"))
    named = unique_stems(numbered, F.col("label"), "arrival", scope=["study_id"], name="source_stem")
    return cut_lineage(named.join(ids, "study_id").drop("arrival", "label"))


def _surplus(cell: Column, strict: bool) -> Column:
    if strict:
        told = F.concat(F.lit("More cells than the header has: "), "source_path")
        cell = F.when(cell.isNotNull(), F.raise_error(told)).otherwise(cell)
    return cell.alias(tables.SURPLUS)


def _file_rows(
    spark: SparkSession, index: DataFrame, rules: Mapping[str, Mapping[str, str]], strict: bool
) -> DataFrame | None:
    """Rows of all files under the targets: a scan per header if there are few, else one per kind of file."""
    groups = L.file_groups(index.where("has_rows"))
    if len(groups) > SCANS:
        return _rows_of_many_headers(spark, index, groups, rules, strict)
    frames = []
    for group in groups:
        rows = L.read_group(spark, group)
        cells = [F.col(f"c{i}") for i in range(len(group.columns))]
        mapped = mapping.normalized_columns(
            cells, group.columns, rules.get(group.category, {}), group.category, strict=strict
        )
        frames.append(rows.select("source_path", "source_block", "source_row", _surplus(F.col("surplus"), strict), *mapped))
    return reduce(DataFrame.unionByName, frames) if frames else None


def _rows_of_many_headers(
    spark: SparkSession, index: DataFrame, groups: list[L.FileGroup], rules: Mapping[str, Mapping[str, str]], strict: bool
) -> DataFrame:
    """One scan per delimiter and quoting; where a target stands in a file is data that joins its rows.

    The plan has the same size for any number of headers.
    """
    shapes, kinds = [], {}
    for g in groups:
        sources = mapping.checked_sources(g.columns, rules.get(g.category, {}), g.category, strict=strict)
        places = [sources.get(t, []) for t in S.TARGETS]
        shapes.append((g.category, g.delimiter, g.header, g.multi_line, len(g.columns), places))
        width, paths = kinds.get((g.delimiter, g.multi_line), (0, []))
        kinds[g.delimiter, g.multi_line] = (max(width, len(g.columns)), [*paths, *g.paths])
    told = ["category", "delimiter", "header", "multi_line"]
    known = spark.createDataFrame(
        shapes, "category string, delimiter string, header string, multi_line boolean, width int, places array<array<int>>"
    )
    files = index.where("has_rows").select("source_path", *told)
    placed = cut_lineage(skew.lookup_join(files, known, told, how="inner", row_id=["source_path"]).drop(*told))
    frames = []
    for (delimiter, multi_line), (width, paths) in kinds.items():
        rows = L.read_cells(spark, delimiter, multi_line, paths, width)
        row_id = ["source_path", "source_block", "source_row"]
        joined = skew.lookup_join(rows, placed, ["source_path"], how="inner", row_id=row_id)
        targets = []
        for i, target in enumerate(S.TARGETS):
            at = F.get("places", F.lit(i))
            cells = F.transform(at, lambda p: text.na_to_null(F.get("cells", p)))
            first = F.get(F.filter(cells, lambda c: c.isNotNull()), F.lit(0))
            targets.append(F.when(F.size(at) == 0, F.lit("")).otherwise(first).alias(target))
        surplus = _surplus(F.get("cells", F.col("width")), strict)
        frames.append(joined.select(*row_id, surplus, *targets))
    return reduce(DataFrame.unionByName, frames)


def normalized_rows(
    spark: SparkSession,
    index: DataFrame,
    pulled: DataFrame | None,
    places: DataFrame,
    rules: Mapping[str, Mapping[str, str]],
    *,
    strict: bool = False,
) -> DataFrame | None:
    """Rows of all sources with the 23 targets, their place in the source and their object."""
    frames = []
    files = _file_rows(spark, index, rules, strict)
    if files is not None:
        by_path = places.where(F.col("source_path").isNotNull())
        row_id = ["source_path", "source_block", "source_row"]
        placed = skew.lookup_join(files, by_path, ["source_path"], row_id=row_id)
        frames.append(
            placed.withColumnsRenamed({"source_block": "_source_block", "source_row": "_source_row"})
        )
    if pulled is not None:
        by_study = places.where(F.col("source_path").isNull()).drop("source_path")
        records = P.explode_rows(P.parse_pages(pulled))
        flat = mapping.normalize_records(records, keep=["study_id", "page", "position"])
        placed = skew.lookup_join(
            flat, by_study, ["study_id"], how="inner", row_id=["page", "position"], keys_from=pulled.select("study_id")
        )
        frames.append(
            placed.withColumn("_source_block", F.col("page").cast("long"))
            .withColumn("_source_row", F.col("position").cast("long"))
            .withColumn(tables.SURPLUS, F.lit(None).cast("string"))
        )
    columns = tables.WRITTEN.names
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in frames]) if frames else None


def _count_objects(spark: SparkSession, runs: list[Run], settings: Settings) -> None:
    """Rows per written object, from the Parquet footers."""
    ids = {r.run_id: r for r in runs}
    try:
        rows = tables.read_some_runs(spark, settings.output, [(r.study_id, r.run_id) for r in runs])
        more = F.count_if(F.col(tables.SURPLUS).isNotNull()).alias("more")
        totals = summary.file_totals(rows, ["run_id", "source_stem"], more)
        found = totals.orderBy("run_id", "source_stem").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []  # no run wrote anything
    for total in found:
        ids[total.run_id].objects[total.source_stem] = total.rows
        if total.more:
            ids[total.run_id].notes.append(f"{total.more} rows of {total.source_stem} have more cells than the header")
    for run in runs:
        run.status = "INGESTED" if run.objects else "COMPLETED"


def _halves(runs: list[Run]) -> tuple[list[Run], list[Run]]:
    return runs[: len(runs) // 2], runs[len(runs) // 2 :]


def _write(
    spark: SparkSession,
    runs: list[Run],
    settings: Settings,
    index: DataFrame,
    pulled: DataFrame | None,
    rules: Mapping[str, Mapping[str, str]],
    strict: bool,
) -> None:
    """Write the rows of the runs by one plan; if that fails, half by half, down to the studies that fail.

    One bad study among many costs two attempts per halving, most of which write what is good.
    """

    def attempt(some: list[Run]) -> None:
        mine = F.col("study_id").isin([r.study_id for r in some])
        own, pages = index.where(mine), None if pulled is None else pulled.where(mine)
        rows = normalized_rows(spark, own, pages, _places(spark, own, some), rules, strict=strict)
        if rows is not None:
            write_normalized(rows, settings.output)

    try:
        attempt(runs)
    except Exception as error:  # the audit must show any failure
        if len(runs) == 1:
            runs[0].fail(error)
            return
        for half in _halves(runs):
            _write(spark, half, settings, index, pulled, rules, strict)


def ingest(
    spark: SparkSession,
    study_ids: Sequence[str],
    settings: Settings,
    *,
    mappings: DataFrame | None = None,
    configs: DataFrame | None = None,
    sponsors: DataFrame | None = None,
    pages: DataFrame | None = None,
    mode: str | None = None,
    strict: bool = False,
) -> list[dict[str, Any]]:
    """Ingest the studies and return one summary per study.

    ``pages`` has ``study_id, page, body``: the landed answers of the API, from page 1. A study without pages is one
    whose API did not answer. What fails for one study gives that study the status ``FAILED`` and a
    reason, not an exception, and leaves the others alone. Rows with more cells than their header keep the first of these in
    ``_surplus``; ``strict`` makes them fail the study. They, and files whose names Spark hides, are told in the reason.
    """
    with job_folder(spark):
        return _ingest(spark, study_ids, settings, mappings, configs, sponsors, pages, mode, strict)


def _ingest(
    spark: SparkSession,
    study_ids: Sequence[str],
    settings: Settings,
    mappings: DataFrame | None,
    configs: DataFrame | None,
    sponsors: DataFrame | None,
    pages: DataFrame | None,
    mode: str | None,
    strict: bool,
) -> list[dict[str, Any]]:
    runs = start_runs(spark, study_ids, settings, configs=configs, sponsors=sponsors, mode=mode)
    rules = mapping.collect_rules(mappings) if mappings is not None else {}
    pulled = _pull(pages, runs, settings)
    index = _index(spark, [r for r in runs if not r.failed], settings)
    now = datetime.now(UTC)
    going = [r for r in runs if not r.failed]
    if going:
        _write(spark, going, settings, index, pulled, rules, strict)
    written = [r for r in runs if not r.failed]
    try:
        if written:
            _count_objects(spark, written, settings)
    except Exception as error:  # what was written is there, counted or not
        for run in written:
            run.status, run.reason = "INGESTED", f"Written, but not counted: {error}"[:2048]
    untold = [] if settings.read_hidden else [r.study_id for r in runs if r.mode != "API_ONLY"]
    for study, name in L.hidden_files(spark, settings.landing, untold):
        next(r for r in runs if r.study_id == study).notes.append(f"{name} was not read, as Spark hides such names")
    for run in runs:
        if run.notes:
            run.reason = "; ".join([*([run.reason] if run.reason else []), *run.notes])[:2048]
    _write_audits(spark, index, runs, settings, now)
    return [summarize(run, settings) for run in runs]


def _write_audits(
    spark: SparkSession, index: DataFrame, runs: list[Run], settings: Settings, now: datetime
) -> None:
    ids = [(r.study_id, r.run_id, r.sponsor_id) for r in runs]
    named = spark.createDataFrame(ids, "study_id string, run_id string, sponsor_id string")
    audit.append(audit.file_log(index, named, now), settings.output, FILE_TABLE)
    log = audit.run_log(spark, [_audit_row(r, settings) for r in runs], now)
    source = text.endpoint(F.col("dataSource"), settings.file_host, settings.api_base_url)
    audit.append(log.withColumn("sourceEndpointUrl", source), settings.output, RUN_TABLE)


def _uri(settings: Settings, key: str) -> str:
    return f"{settings.output.rstrip('/')}/{key}"


def _audit_row(run: Run, settings: Settings) -> dict[str, Any]:
    first = next(iter(run.keys()), None)
    return {
        "runId": run.run_id,
        "studyId": run.study_id,
        "sponsorId": run.sponsor_id,
        "dataSource": run.data_source,
        "stagingS3Key": first,
        "s3RawBucket": settings.bucket,
        "s3PipelineStagingPrefix": settings.staging_prefix,
        "stagingS3Uri": _uri(settings, first) if first else None,
        "status": run.status,
        "totalRows": run.rows,
        "failureReason": run.reason,
        "rowsFetched": run.rows_fetched,
        "filesAdded": run.files_added,
        "visitFilesSkipped": run.visit_files_skipped,
    }


def summarize(run: Run, settings: Settings) -> dict[str, Any]:
    """Summary of a run: twelve fields, plus keys if any object was written, plus a reason if it failed."""
    keys = run.keys()
    columns = S.TARGETS if run.objects or run.status == "FAILED" else []
    out: dict[str, Any] = {
        "studyId": run.study_id,
        "sponsorSchema": settings.tenant,
        "subjectVisitSourceMode": run.mode,
        "dataSource": run.data_source,
        "runId": run.run_id,
        "rowCount": run.rows,
        "columnCount": len(columns),
        "columns": list(columns),
        "ingestionStatus": run.status,
        "rawLayerBucket": settings.bucket,
        "rawLayerKey": keys[0] if keys else None,
        "rawLayerUri": _uri(settings, keys[0]) if keys else None,
    }
    if keys:
        out["rawLayerKeys"] = keys
        out["rawLayerUris"] = [_uri(settings, k) for k in keys]
    if run.reason:
        out["failureReason"] = run.reason
    return out
