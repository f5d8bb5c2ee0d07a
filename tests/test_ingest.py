"""A landing folder of all file shapes, through ingest, audits and preview."""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill import session
from visitmill.operators import mapping
from visitmill.plans import ingest as I
from visitmill.plans import preview
from visitmill.sources import landing as L
from visitmill.sources import tables

VISIT_HEADER = [
    "STUDY_ID", "STUDY_SITE", "VISIT_NUMBER", "VISIT_NAME", "FORM_NAME", "BLANK_FORM_INDICATOR",
    "FORM_NOTDONE_INDICATOR", "VISIT_DATE", "DATA_ENTRY_DATE", "PROCEDURE_NAME", "PROCEDURE_STATUS",
    "SUBEVENT_NUMBER", "SUBJECT_ID", "SUBJECT_STATUS", "ERRONEOUS", "VISIT_CONTACT_MODE",
    "SUBJECT_GROUP_IDENTIFIER", "START_DATETIME", "TIME_POST_DOSE", "STUDY_FSFV", "COHORT", "STRATA",
    "PAYMENT_GROUP",
]
VISIT_ROW = (
    "T1|10|{n}|Screening|DATE OF VISIT|1|0|5-Mar-21|9-Mar-21|SV001|COMPLETE|1|10-0{n}|{status}|0||G1|||"
    "4/2/2020 0:00||a, b|"
)
MAPPINGS = [
    (1, "subject_visit", " study_id ", "studyId", True),
    (2, "subject_group", "SITE_ID", "studySiteNumber", True),
    (3, "misc", "SUBJ_ID", "subjectId", True),
    (4, "misc", "SITE", "studySiteNumber", False),
    (5, "misc", "  ", "formName", True),
    (6, "misc", "subject_group", "cohort", True),
    (7, "misc", "SUBJECT_GROUP", "subjectGroupIdentifier", True),
]


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    study = root / "T1"
    study.mkdir(parents=True)
    visits = ["|".join(VISIT_HEADER), VISIT_ROW.format(n=1, status="ENROLLED"), VISIT_ROW.format(n=2, status="NA")]
    (study / "Subject-Visit_T1.csv").write_text("\n".join(visits) + "\n")
    (study / "subjectgrp_T1.csv").write_text(
        "STUDY_ID,PROTOCOL_ID,STUDY_SITE_NUMBER,SITE_ID,SUBJECT_ID,SBJ_STR_STRATA_NUM,CREATION_TS\n"
        'T1,T1,10,,10-01,,03-Feb-2021\n  \nT1,T1,11,99,10-02,"x\ny",""\n'
    )
    (study / "visitschedule_T1.csv").write_text(
        'STUDY_ID,VISIT_NUMBER,VISIT_NAME,OPTIONAL_VISIT_FLAG,FORM_NAME,PROCEDURE_NAME\nT1,1,SCREENING,"",F,P\n'
    )
    (study / "T1 manual.csv").write_text("subject_id ,subject_group\n10-01,Arm A\n")
    (study / "T1+manual.csv").write_text("subject_id,subject_group\n10-02,Arm B\n")
    (study / "header_only.csv").write_text("SUBJECT_ID,COHORT\n")
    (study / "IGNORED.CSV").write_text("SUBJECT_ID\n1\n")
    (study / "below").mkdir()
    (study / "below" / "x.csv").write_text("SUBJECT_ID\n1\n")
    return root


@pytest.fixture
def settings(landing, tmp_path):
    return I.Settings(
        landing=str(landing), output=str(tmp_path / "out"), tenant="demo", page_size=2,
        file_host="files.example", api_base_url="https://api.example", bucket="raw",
    )


@pytest.fixture
def mappings(spark):
    return spark.createDataFrame(MAPPINGS, "id int, type string, sourceColumn string, targetColumn string, isActive boolean")


def rows_of(spark, settings, summary):
    rows = tables.read_run(spark, settings.output, summary["studyId"], summary["runId"])
    out: dict[str, list[dict]] = {}
    for r in rows.orderBy("source_stem", *tables.ORDER).collect():
        out.setdefault(r.source_stem, []).append(r.asDict())
    return out


def test_files_only(spark, settings, mappings):
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
    assert summary["ingestionStatus"] == "INGESTED"
    assert summary["dataSource"] == "SFTP"
    assert summary["rowCount"] == 7
    assert summary["columns"] == S.TARGETS and summary["columnCount"] == 23
    got = rows_of(spark, settings, summary)
    # Files by name: "T1 manual.csv" before "T1+manual.csv"; the empty one has no object.
    assert sorted(got) == ["Subject-Visit_T1", "T1_manual", "T1_manual_1", "subjectgrp_T1", "visitschedule_T1"]
    first, second = got["Subject-Visit_T1"]
    assert first["studyId"] == "T1" and first["strata"] == "a, b" and first["subjectStatus"] == "ENROLLED"
    assert first["cohort"] is None and first["paymentGroup"] is None
    assert second["subjectStatus"] is None and second["subjectId"] == "10-02"
    group = got["subjectgrp_T1"]
    # The rule's column is tried before the alias.
    assert [r["studySiteNumber"] for r in group] == ["10", "99"]
    assert [r["strata"] for r in group] == [None, "x\ny"]
    assert [r["dateEntryDate"] for r in group] == ["03-Feb-2021", None]
    assert group[0]["cohort"] == ""
    # The template's trailing blank is trimmed, and of two rules for one source the last counts.
    assert [r["subjectId"] for r in got["T1_manual"]] == ["10-01"]
    assert [r["subjectGroupIdentifier"] for r in got["T1_manual_1"]] == ["Arm B"]
    assert got["visitschedule_T1"][0]["formName"] == "F"


def test_a_job_leaves_no_folder_behind(spark, settings, mappings):
    shared = Path(session.shared_folder(spark))
    before = set(shared.iterdir())
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
    preview.preview_run(spark, settings.output, "T1", summary["runId"])
    assert set(shared.iterdir()) == before
    with pytest.raises(RuntimeError), session.job_folder(spark) as folder:
        session.cut_lineage(spark.range(3))
        assert list(Path(folder).iterdir())
        raise RuntimeError
    assert set(shared.iterdir()) == before


def test_audits(spark, settings, mappings, landing):
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
    log = spark.read.schema(S.RUN_LOG).parquet(f"{settings.output}/{I.RUN_TABLE}").collect()
    assert [(r.runId, r.status, r.totalRows, r.sourceEndpointUrl, r.createdBy) for r in log] == [
        (summary["runId"], "INGESTED", 7, "files.example", "ingestion-task")
    ]
    assert log[0].stagingS3Key == summary["rawLayerKey"] and log[0].validRows is None
    files = spark.read.schema(S.FILE_LOG).parquet(f"{settings.output}/{I.FILE_TABLE}").collect()
    assert len(files) == 6
    for row in files:
        raw = (landing / "T1" / row.fileName).read_bytes()
        assert row.fileContentHash == hashlib.sha256(raw).hexdigest()
        assert row.fileNameHash == hashlib.sha256(row.fileName.encode()).hexdigest()
        assert row.sourceCreatedAt is None and row.sourceUpdatedAt is not None
    assert {r.fileName: r.mappingCategory for r in files}["Subject-Visit_T1.csv"] == "subject_visit"


def test_preview(spark, settings, mappings):
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
    got = preview.preview_run(spark, settings.output, "T1", summary["runId"], limit=1)
    assert got["parquetCount"] == 5
    visits = got["objects"][0]
    assert (visits["filename"], visits["totalRowsInFile"], visits["previewRowCount"]) == ("Subject-Visit_T1.parquet", 2, 1)
    assert list(visits["rows"][0]) == S.TARGETS and visits["rows"][0]["cohort"] is None
    assert tables.list_objects(spark, settings.output, "T1", summary["runId"]).count() >= 5
    empty = preview.preview_run(spark, settings.output, "T2", summary["runId"])
    assert empty["parquetCount"] == 0
    for bad in [dict(study_id="a/b"), dict(run_id="x"), dict(limit=0), dict(limit=101)]:
        with pytest.raises(ValueError):
            preview.preview_run(spark, settings.output, **{"study_id": "T1", "run_id": summary["runId"], **bad})


def test_preview_over_several_blocks(spark):
    rows = [(s, b, r) for s, sizes in {"x": [1, 0, 2, 5], "y": [4]}.items() for b, n in enumerate(sizes) for r in range(n)]
    df = spark.createDataFrame(rows, "source_stem string, _source_block long, _source_row long")
    df = df.select("*", *[F.concat_ws("-", "_source_block", "_source_row").alias(t) for t in S.TARGETS])
    for limit in (1, 2, 4, 100):
        got = preview.preview_objects(df, limit).collect()
        for r in got:
            want = [f"{b}-{n}" for s, b, n in sorted(rows) if s == r.source_stem]
            assert r.totalRowsInFile == len(want)
            assert [json.loads(t)["cohort"] for t in r.rows] == want[:limit]
        assert len(got) == 2


def pages(spark, bodies):
    rows = [("T1", i + 1, json.dumps(b) if not isinstance(b, str) else b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "study_id string, page int, body string")


def test_api_first(spark, settings, mappings):
    bodies = [
        {"content": [{"studyId": "T1", "subjectId": "a", "cohort": None, "other": 1}, {"subjectId": 2, "strata": {"x": 1}}]},
        {"data": [{"subjectId": "c", "STUDY_SITE": "9"}]},
        {"data": [{"subjectId": "beyond"}]},
    ]
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, pages=pages(spark, bodies), mode="API_FIRST")
    assert summary["dataSource"] == "API" and summary["subjectVisitSourceMode"] == "API_FIRST"
    got = rows_of(spark, settings, summary)
    assert "Subject-Visit_T1" not in got and "subjectgrp_T1" in got
    api = got["subject_visits"]
    assert [r["subjectId"] for r in api] == ["a", "2", "c"]
    # Present somewhere: null where it is missing. Present nowhere, or only as an object: "".
    assert [r["studyId"] for r in api] == ["T1", None, None]
    assert [r["cohort"] for r in api] == [None, None, None]
    assert {r["strata"] for r in api} == {""} and {r["studySiteNumber"] for r in api} == {""}
    files = spark.read.schema(S.FILE_LOG).parquet(f"{settings.output}/{I.FILE_TABLE}")
    assert files.where(F.col("mappingCategory") == "subject_visit").isEmpty()


def test_api_without_rows_is_no_failure(spark, settings):
    [summary] = I.ingest(spark, ["T1"], settings, pages=pages(spark, [{"content": []}]), mode="API_FIRST")
    got = rows_of(spark, settings, summary)
    assert summary["dataSource"] == "API" and "subject_visits" not in got and "Subject-Visit_T1" not in got


def test_api_failure_falls_back_to_all_files(spark, settings):
    [summary] = I.ingest(spark, ["T1"], settings, pages=pages(spark, ["no json"]), mode="API_FIRST")
    assert summary["dataSource"] == "SFTP"
    assert "Subject-Visit_T1" in rows_of(spark, settings, summary)


def test_api_only(spark, settings):
    [summary] = I.ingest(spark, ["T1"], settings, mode="API_ONLY")
    assert summary["ingestionStatus"] == "FAILED" and "none landed" in summary["failureReason"]
    [summary] = I.ingest(spark, ["T1"], settings, pages=pages(spark, [[{"subjectId": "a"}], [{"subjectId": "b"}]]))
    assert summary["subjectVisitSourceMode"] == "API_ONLY" and summary["rowCount"] == 1


def test_empty_study(spark, settings):
    [summary] = I.ingest(spark, ["NONE"], settings, mode="SFTP_ONLY")
    assert summary["ingestionStatus"] == "COMPLETED" and summary["columns"] == []
    assert summary["rawLayerKey"] is None and "rawLayerKeys" not in summary


def test_failed_write_is_audited(spark, settings, mappings, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "normalized").write_text("in the way")
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
    assert summary["ingestionStatus"] == "FAILED" and summary["failureReason"]
    log = spark.read.schema(S.RUN_LOG).parquet(f"{settings.output}/{I.RUN_TABLE}").first()
    assert log.status == "FAILED" and log.failureReason and log.totalRows == 0


def test_many_studies_in_one_call(spark, settings, landing, mappings):
    other = landing / "T2"
    other.mkdir()
    (other / "subjectgrp_T1.csv").write_text("SUBJECT_ID\nz\n")
    configs = spark.createDataFrame([("T2", " other ")], "studyId string, sponsorId string")
    one, two = I.ingest(spark, ["T1", "T2"], settings, mappings=mappings, configs=configs, mode="SFTP_ONLY")
    assert (one["rowCount"], two["rowCount"]) == (7, 1)
    assert list(rows_of(spark, settings, two)) == ["subjectgrp_T1"]
    log = spark.read.schema(S.RUN_LOG).parquet(f"{settings.output}/{I.RUN_TABLE}")
    assert {(r.studyId, r.sponsorId) for r in log.collect()} == {("T1", "demo"), ("T2", "other")}


@pytest.mark.parametrize("mode", ["SFTP_ONLY", "API_FIRST", "API_ONLY"])
def test_one_bad_study_among_three(spark, settings, landing, mappings, mode, monkeypatch):
    for study in ("T2", "T3"):
        (landing / study).mkdir()
        (landing / study / "subjectgrp_x.csv").write_text("SUBJECT_ID\nz\n")
    landed = [("T1", 1, "no json"), *[(s, 1, '[{"subjectId": "a"}]') for s in ("T2", "T3")]]
    frame = spark.createDataFrame(landed, "study_id string, page int, body string")
    index_files = L.index_files

    def unreadable(spark, landing, studies, *more):
        if "T1" in studies:
            raise OSError("cannot read T1")
        return index_files(spark, landing, studies, *more)

    monkeypatch.setattr(L, "index_files", unreadable)
    got = I.ingest(spark, ["T1", "T2", "T3"], settings, mappings=mappings, pages=frame, mode=mode)
    assert [s["ingestionStatus"] for s in got] == ["FAILED", "INGESTED", "INGESTED"]
    assert got[0]["failureReason"] and got[0]["rowCount"] == 0
    log = spark.read.schema(S.RUN_LOG).parquet(f"{settings.output}/{I.RUN_TABLE}")
    assert {(r.studyId, r.status) for r in log.collect()} == {("T1", "FAILED"), ("T2", "INGESTED"), ("T3", "INGESTED")}


def test_one_failed_write_among_two(spark, settings, landing, mappings, monkeypatch):
    (landing / "T2").mkdir()
    (landing / "T2" / "subjectgrp_x.csv").write_text("SUBJECT_ID\nz\n")
    write = I.write_normalized

    def failing(rows, output):
        if not rows.where("study_id = 'T1'").isEmpty():
            raise OSError("no space for T1")
        write(rows, output)

    monkeypatch.setattr(I, "write_normalized", failing)
    one, two = I.ingest(spark, ["T1", "T2"], settings, mappings=mappings, mode="SFTP_ONLY")
    assert (one["ingestionStatus"], one["failureReason"]) == ("FAILED", "no space for T1")
    assert (two["ingestionStatus"], two["rowCount"]) == ("INGESTED", 1)


def test_rows_that_cannot_be_counted_are_still_written(spark, settings, mappings, monkeypatch):
    monkeypatch.setattr(I, "_count_objects", lambda *_: 1 / 0)
    [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
    assert summary["ingestionStatus"] == "INGESTED" and "not counted" in summary["failureReason"]
    assert tables.read_run(spark, settings.output, "T1", summary["runId"]).count() == 7


def test_large_files_are_streamed_alike(spark, landing):
    columns = ["file_name", "content_hash", "header", "delimiter", "multi_line", "has_rows", "category"]
    whole = L.index_files(spark, str(landing), ["T1"]).select(columns).orderBy("file_name").collect()
    pieces = L.index_files(spark, str(landing), ["T1"], whole_file_bytes=0).select(columns).orderBy("file_name").collect()
    assert whole == pieces and len(whole) == 6
    assert {r.file_name for r in whole if r.multi_line} == {"subjectgrp_T1.csv"}
    assert {r.file_name for r in whole if not r.has_rows} == {"header_only.csv"}


def test_read_files_stacks_by_name(spark, landing):
    groups = L.file_groups(L.index_files(spark, str(landing), ["T1"]).where("has_rows"))
    rows = L.read_files(spark, groups)
    assert rows.count() == 7 and {"PROTOCOL_ID", "OPTIONAL_VISIT_FLAG", "subject_id "} <= set(rows.columns)
    assert rows.where(F.col("PROTOCOL_ID").isNotNull()).count() == 2
    group = next(g for g in groups if g.multi_line)
    assert L.read_group(spark, group).count() == len(L.read_group(spark, group).collect()) == 2


def test_many_headers_share_a_scan(spark, settings, landing, mappings, monkeypatch):
    (landing / "T1" / "more.csv").write_text("SUBJECT_ID,COHORT\n1,x,EXTRA\n2\nNA,y\n")
    got = []
    for scans in (24, 0):
        monkeypatch.setattr(I, "SCANS", scans)
        [summary] = I.ingest(spark, ["T1"], settings, mappings=mappings, mode="SFTP_ONLY")
        rows = tables.read_run(spark, settings.output, "T1", summary["runId"])
        got.append((summary["rowCount"], summary["failureReason"], sorted(map(str, rows.drop("run_id", "_source_row").collect()))))
    assert got[0] == got[1] and got[0][0] == 10


def test_the_plan_does_not_grow_with_the_headers(spark, landing, tmp_path):
    def plan(n):
        groups = [L.FileGroup("misc", ",", f"SUBJECT_ID,X{i}", False, (str(landing / "T1" / "header_only.csv"),)) for i in range(n)]
        rows = [("p", "misc", ",", g.header, False, True) for g in groups]
        index = spark.createDataFrame(rows, "source_path string, category string, delimiter string, header string, multi_line boolean, has_rows boolean")
        return I._rows_of_many_headers(spark, index, groups, {}, False)._jdf.queryExecution().analyzed().toString()

    assert len(plan(2_000)) < 1.2 * len(plan(2))


def test_strict_mode_names_the_target(spark, settings, mappings):
    with pytest.raises(mapping.DuplicateTargetError, match="studySiteNumber"):
        df = spark.createDataFrame([("1", "2")], "STUDY_SITE string, SITE string")
        mapping.normalize(df, {"SITE": "studySiteNumber"}, strict=True)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_line_ends_and_blank_lines(spark, tmp_path, end, whole):
    folder = tmp_path / "in" / "T9"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_bytes(end.join(["", "SUBJECT_ID|COHORT", "1|x", "", "2|", ""]).encode())
    index = L.index_files(spark, str(tmp_path / "in"), ["T9"], whole_file_bytes=whole)
    [group] = L.file_groups(index.where("has_rows"))
    # The first line is blank, so the delimiter is a comma, as for any file without pipes in it.
    assert group.delimiter == "," and group.columns == ["SUBJECT_ID|COHORT"] and not group.multi_line
    assert [r.c0 for r in L.read_group(spark, group).orderBy("source_block", "source_row").collect()] == ["1|x", "2|"]


WIDE = ",".join(f"column_{i:06d}" for i in range(2_000)) + "|" * 3_000


@pytest.mark.parametrize("whole", [0, 1 << 30])
@pytest.mark.parametrize(
    ("content", "delimiter", "header", "has_rows"),
    [
        ("\x0b\nSUBJECT_ID,COHORT\n1,x\n", ",", "SUBJECT_ID,COHORT", True),
        ("SUBJECT_ID\n\x0b \x1f\n", ",", "SUBJECT_ID", False),
        (f"{WIDE}\n1\n", "|", WIDE, True),
        (" \n\t\n", ",", "", False),
        ("A|B", "|", "A|B", False),
    ],
)
def test_one_probe_for_all_sizes(spark, tmp_path, monkeypatch, whole, content, delimiter, header, has_rows):
    monkeypatch.setattr(L, "PIECE_BYTES", 100)
    (tmp_path / "in" / "T9").mkdir(parents=True)
    (tmp_path / "in" / "T9" / "a.csv").write_bytes(content.encode())
    row = L.index_files(spark, str(tmp_path / "in"), ["T9"], whole_file_bytes=whole).first()
    assert (row.delimiter, row.header, row.has_rows) == (delimiter, header, has_rows)


def test_surplus_cells_and_hidden_names_are_told(spark, settings, landing):
    (landing / "T2").mkdir()
    (landing / "T2" / "a.csv").write_text("SUBJECT_ID,COHORT\n1,x,EXTRA\n2,y\n3\n4,z,\n")
    (landing / "T2" / "q.csv").write_text('SUBJECT_ID,COHORT\n1,"x\nx",EXTRA\n \n2,y\n')
    (landing / "T2" / "_b.csv").write_text("SUBJECT_ID\n9\n")
    (landing / "T2" / ".c.csv").write_text("SUBJECT_ID\n9\n")
    [summary] = I.ingest(spark, ["T2"], settings, mode="SFTP_ONLY")
    assert (summary["ingestionStatus"], summary["rowCount"]) == ("INGESTED", 6)
    told = summary["failureReason"]
    assert "1 rows of a have more cells" in told and "1 rows of q have" in told and "_b.csv" in told and ".c.csv" in told
    rows = tables.read_run(spark, settings.output, "T2", summary["runId"])
    assert [(r.subjectId, r._surplus) for r in rows.where("_surplus IS NOT NULL").collect()] == [("1", "EXTRA")] * 2
    [summary] = I.ingest(spark, ["T2"], settings, mode="SFTP_ONLY", strict=True)
    assert summary["ingestionStatus"] == "FAILED" and "More cells than the header has" in summary["failureReason"]


def test_hidden_names_are_read_if_asked(spark, settings, landing):
    (landing / "T2").mkdir()
    (landing / "T2" / "a.csv").write_text("SUBJECT_ID,COHORT\n1,x\n")
    (landing / "T2" / "_b.csv").write_text("SUBJECT_ID\n9\n")
    (landing / "T2" / ".c.csv").write_text("SUBJECT_ID\n8\n7\n")
    (landing / "T2" / "_none.csv").write_text("SUBJECT_ID\n")
    [summary] = I.ingest(spark, ["T2"], replace(settings, read_hidden=True), mode="SFTP_ONLY")
    assert (summary["ingestionStatus"], summary["rowCount"]) == ("INGESTED", 4) and "failureReason" not in summary
    rows = tables.read_run(spark, settings.output, "T2", summary["runId"])
    assert sorted(r.subjectId for r in rows.collect()) == ["1", "7", "8", "9"]
    log = spark.read.schema(S.FILE_LOG).parquet(f"{settings.output}/{I.FILE_TABLE}").collect()
    assert sorted(r.fileName for r in log) == [".c.csv", "_b.csv", "_none.csv", "a.csv"]
    assert {r.remotePath.rsplit("/", 2)[-2:][0] for r in log} == {"T2"} and all(r.remotePath.endswith(f"/{r.fileName}") for r in log)
    run = spark.read.schema(S.RUN_LOG_COUNTS).parquet(f"{settings.output}/{I.RUN_TABLE}").first()
    assert (run.rowsFetched, run.filesAdded, run.visitFilesSkipped) == (0, 4, 0)


def test_listing(spark, landing):
    got = L.list_files(spark, str(landing), ["T1", "missing"]).orderBy("file_name").collect()
    assert [r.file_name for r in got] == sorted(p.name for p in (landing / "T1").glob("*.csv"))
    assert {r.study_id for r in got} == {"T1"} and all(r.length > 0 and r.modified for r in got)
    assert L.list_files(spark, str(landing), ["missing"]).isEmpty()
    assert L.list_files(spark, str(landing), []).isEmpty()


def test_one_bad_study_is_found_by_halving(spark, settings, landing, monkeypatch):
    studies = [f"H{i}" for i in range(8)]
    for study in studies:
        (landing / study).mkdir()
        (landing / study / "a.csv").write_text("SUBJECT_ID\n1\n" if study != "H5" else "SUBJECT_ID\n1,2\n")
    tries, write = [], I.normalized_rows
    monkeypatch.setattr(I, "normalized_rows", lambda *a, **k: tries.append(1) or write(*a, **k))
    found = {s["studyId"]: (s["ingestionStatus"], s["rowCount"]) for s in I.ingest(spark, studies, settings, mode="SFTP_ONLY", strict=True)}
    assert found == {s: ("FAILED", 0) if s == "H5" else ("INGESTED", 1) for s in studies}
    assert len(tries) == 7
