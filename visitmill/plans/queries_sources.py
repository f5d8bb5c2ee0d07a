"""Registered queries: files, hashes, JSON pages, source modes, run totals, preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import skew, text
from visitmill.operators import mapping, summary
from visitmill.plans import preview
from visitmill.plans.queries_mapping import _CATEGORY, _LABEL, document_labels
from visitmill.plans.registry import query, table
from visitmill.session import cut_lineage
from visitmill.sources import landing, modes, pages, tables


@query(f"""
    SELECT doc_id, label, {_CATEGORY} AS category, sha256(label) AS name_hash, sha256(text) AS content_hash
    FROM (SELECT doc_id, {_LABEL} AS label, text FROM documents)
""")
def file_hash_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What the file audit records: category and the hashes of name and content."""
    return document_labels(spark, folder, "text").select(
        "doc_id",
        "label",
        text.category(F.col("label")).alias("category"),
        text.sha256(F.col("label")).alias("name_hash"),
        text.sha256(F.col("text")).alias("content_hash"),
    )


_LINE = "regexp_extract(text, '^[^\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]*')"


@query(f"""
    SELECT doc_id, CASE WHEN length(line) - length(replace(line, '|', '')) > length(line) - length(replace(line, ',', ''))
           THEN '|' ELSE ',' END AS delimiter
    FROM (SELECT doc_id, {_LINE} AS line FROM documents)
""")
def delimiter_inference(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.delimiter(F.col("text")).alias("delimiter"))


@query("""
    WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)
    SELECT doc_id, sha256(text) AS content_hash, regexp_extract(text, '^(?:[ \\t]*\\r?\\n)*([^\\n]*)', 1) AS header,
           len(list_filter(l, lambda x: (length(x) - length(replace(x, '"', ''))) % 2 = 1)) > 0 AS multi_line,
           regexp_matches(text, '^(?:[ \\t]*\\r?\\n)*[^\\n]*\\n\\s*\\S') AS has_rows
    FROM lines
""")
def file_probe(spark: SparkSession, folder: str) -> DataFrame:
    """What the file index takes from a content, with each document as one file."""
    content = F.col("text").cast("binary")
    probed = table(spark, folder, "documents").select("doc_id", *landing.probe_content(content))
    return probed.drop("head")


@query("""
    SELECT event_id, to_timestamp(epoch_us(ts) / 1000000) AT TIME ZONE 'UTC' AS at, CAST(NULL AS TIMESTAMP) AS bad
    FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)
""")
def epoch_times(spark: SparkSession, folder: str) -> DataFrame:
    """File times as epoch seconds to UTC timestamps; what is no number gives null."""
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("string")
    return table(spark, folder, "events").select(
        "event_id",
        text.epoch_to_timestamp(seconds).cast("timestamp_ntz").alias("at"),
        text.epoch_to_timestamp(F.col("event_type")).cast("timestamp_ntz").alias("bad"),
    )


@query("""
    SELECT id, name, nation, segment, balance FROM (
        SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
               CAST(NULL AS double) AS balance FROM customer
        UNION ALL BY NAME
        SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, CAST(NULL AS varchar) AS segment,
               s_acctbal AS balance FROM supplier)
""")
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    two = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return one.unionByName(two, allowMissingColumns=True)


# Ways to wrap a list of rows; the last ones hold no list, or an empty one before a full one.
_ENVELOPES = [
    "[%]",
    '{"content":[%]}', '{"content":1,"data":[%]}', '{"subjectVisits":[%]}', '{"items":[%]}',
    '{"records":[%]}', '{"results":[%]}', '{"_embedded":{"subjectVisits":[%]}}',
    '{"_embedded":{"content":[%]}}', '{"_embedded":{"data":[%]}}', '{"page":{"content":[%]}}',
    '{"page":{"data":[%]}}', '{"rows":[%]}', '{"content":[],"data":[%]}', '{"data":{"content":[%]}}',
]
_FULL = 12


def event_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page per event, with the event's properties twice as rows, in changing envelopes."""
    kind = F.col("event_id") % len(_ENVELOPES)
    parts = [e.split("%") for e in _ENVELOPES]
    start = F.element_at(F.array(*[F.lit(p[0]) for p in parts]), (kind + 1).cast("int"))
    end = F.element_at(F.array(*[F.lit(p[1]) for p in parts]), (kind + 1).cast("int"))
    body = F.concat(start, F.col("props"), F.lit(","), F.col("props"), end)
    return table(spark, folder, "events").select("event_id", body.alias("body"))


@query(f"""
    SELECT event_id, unnest(CASE WHEN event_id % {len(_ENVELOPES)} < {_FULL} THEN [0, 1] ELSE [] END) AS position,
           cast(json_extract(props, '$.k') AS bigint) AS k
    FROM events
""")
def json_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a page, wherever its list is."""
    rows = pages.explode_rows(pages.parse_pages(event_pages(spark, folder)))
    k = pages.record_value(F.col("record"), "k").cast("long")
    return rows.select("event_id", "position", k.alias("k"))


@query(f"""
    SELECT event_id % {len(_ENVELOPES)} AS envelope, count(*) AS pages,
           CASE WHEN event_id % {len(_ENVELOPES)} < {_FULL} THEN 2 * count(*) ELSE 0 END AS rows
    FROM events GROUP BY 1
""")
def envelope_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and pages per kind of envelope, also for those without rows."""
    parsed = pages.parse_pages(event_pages(spark, folder))
    kind = (F.col("event_id") % len(_ENVELOPES)).alias("envelope")
    return parsed.groupBy(kind).agg(F.sum(F.size("rows")).alias("rows"), F.count("*").alias("pages"))


def conversation_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation as one pull with a page per turn, whose marks depend on its text."""
    n = F.length("text")
    row = F.to_json(F.struct("role", "text"))
    mark = (
        F.when(n % 5 == 0, ',"last":true}')
        .when(n % 5 == 1, ',"last":false,"totalPages":1}')
        .when(n % 5 == 2, ',"totalPages":4}')
        .when(n % 5 == 3, ',"page":{"totalPages":3},"last":"true"}')
        .otherwise("}")
    )
    body = F.concat(F.lit('{"content":['), row, F.lit("]"), mark)
    return table(spark, folder, "conversations").select(
        "conv_id", (F.col("turn") + 1).alias("page"), body.alias("body")
    )


_MORE = """CASE length(text) % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN turn + 1 < 4
           WHEN 3 THEN turn + 1 < 3 ELSE true END"""


# Some pulls lack their second page, others never end.
_LANDED = "NOT (conv_id % 7 = 3 AND turn = 1)"
_PULLS = f"""
    p AS (SELECT conv_id, turn + 1 AS page, role, text, {_MORE} AS more FROM conversations WHERE {_LANDED}),
    ends AS (SELECT conv_id, min(CASE WHEN NOT more THEN page END) AS last_page, max(page) AS top FROM p GROUP BY 1),
    seen AS (SELECT p.conv_id, count(DISTINCT page) AS n FROM p JOIN ends e ON p.conv_id = e.conv_id
             WHERE page <= last_page GROUP BY 1)
"""


@query(f"""
    WITH {_PULLS}
    SELECT p.conv_id, p.page, role, text FROM p JOIN ends e ON p.conv_id = e.conv_id AND page <= last_page
    JOIN seen s ON p.conv_id = s.conv_id AND s.n = last_page
""")
def page_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the pages that belong to each pull; pulls with a gap or without end have none."""
    bodies = conversation_pages(spark, folder).where(F.expr(_LANDED.replace("turn", "page - 1")))
    index = pages.index_pages(pages.parse_pages(bodies), ["conv_id"], page_size=1)
    extent = cut_lineage(pages.pull_extent(index, ["conv_id"]))
    rows = pages.explode_rows(pages.parse_pages(pages.pages_in_pull(bodies, extent, ["conv_id"])))
    values = [pages.record_value(F.col("record"), c).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "page", *values)


@query(f"""
    WITH {_PULLS}
    SELECT e.conv_id, coalesce(last_page, top) AS last_page,
           CASE WHEN last_page IS NULL THEN 'no last page' WHEN n < last_page THEN 'missing page' END AS problem
    FROM ends e LEFT JOIN seen s ON e.conv_id = s.conv_id
""")
def pull_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Where each pull ends, and why it failed if it did."""
    bodies = conversation_pages(spark, folder).where(F.expr(_LANDED.replace("turn", "page - 1")))
    index = pages.index_pages(pages.parse_pages(bodies), ["conv_id"], page_size=1)
    return pages.pull_extent(index, ["conv_id"]).select("conv_id", "last_page", "problem")


@query("""
    WITH n AS (SELECT max(event_id) AS top FROM events),
    p AS (SELECT event_id % 3 AS pull, event_id // 3 + 1 AS page, event_id > top - 3 AND event_id % 3 < 2 AS ends,
                 event_id FROM events, n)
    SELECT pull, max(page) AS last_page, count(*) AS rows FROM p GROUP BY 1 HAVING bool_or(ends)
""")
def long_pulls(spark: SparkSession, folder: str) -> DataFrame:
    """Three pulls over all events, thousands of pages each; the last one has no end and gives nothing."""
    events = table(spark, folder, "events")
    top = events.agg(F.max("event_id")).first()[0] or 0
    pull, ends = F.col("event_id") % 3, (F.col("event_id") > top - 3) & (F.col("event_id") % 3 < 2)
    body = F.concat(F.lit('{"data":['), "props", F.lit("]"), F.when(ends, ',"last":true}').otherwise("}"))
    landed = events.select(pull.alias("pull"), (F.floor(F.col("event_id") / 3) + 1).alias("page"), body.alias("body"))
    index = cut_lineage(pages.index_pages(pages.parse_pages(landed), ["pull"], page_size=1))
    extent = pages.pull_extent(index, ["pull"])
    known = cut_lineage(pages.pull_columns(index, extent, ["pull"]))
    return known.select("pull", "last_page", F.col("row_count").alias("rows"))


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON records under target names; each event type is one pull."""
    kind, value = F.col("event_type"), F.col("value")
    record = F.struct(
        F.col("event_id").alias("subjectId"),
        F.when(kind != "error", F.col("user_id")).alias("studySiteNumber"),
        F.when((kind == "click") & (value > 10), "c").alias("cohort"),
        F.when(kind == "view", F.struct(kind.alias("nested"))).alias("strata"),
        kind.alias("STUDY_ID"),
    )
    parsed = table(spark, folder, "events").select(
        "event_id", "event_type", F.try_parse_json(F.to_json(record)).alias("record")
    )
    return parsed


@query("""
    SELECT cast(event_id AS varchar) AS "subjectId", event_type,
           CASE WHEN event_type = 'error' THEN '' ELSE cast(user_id AS varchar) END AS "studySiteNumber",
           CASE WHEN event_type = 'click' THEN CASE WHEN value > 10 THEN 'c' END ELSE '' END AS cohort,
           '' AS strata, '' AS "studyId"
    FROM events
""")
def api_records(spark: SparkSession, folder: str) -> DataFrame:
    """API rows: "" for a column no record of the pull has, null where only this record lacks it."""
    records = event_records(spark, folder)
    present = cut_lineage(mapping.present_targets(records, ["event_type"]))
    events = table(spark, folder, "events")
    rows = skew.lookup_join(records, present, ["event_type"], row_id=["event_id"], keys_from=events)
    flat = mapping.normalize_records(rows, keep=["event_type"])
    return flat.select("event_type", "subjectId", "studySiteNumber", "cohort", "strata", "studyId")


@query("""
    SELECT event_id AS id, cast(json_extract(props, '$.k') AS bigint) AS "p.k", event_type AS "p.q.kind",
           user_id AS "VOIDED", CAST(NULL AS varchar) AS "AVOID", user_id AS "OBJECT<",
           '[' || user_id || ',' || event_id || ']' AS list FROM events
""")
def flatten_records(spark: SparkSession, folder: str) -> DataFrame:
    """Nested records as dotted columns, with the schema found from the data; lists stay whole."""
    body = F.concat(
        F.lit('{"id":'), "event_id", F.lit(',"VOIDED":'), "user_id", F.lit(',"AVOID":null,"OBJECT<":'), "user_id",
        F.lit(',"list":['), "user_id", F.lit(","), "event_id", F.lit('],"p":'),
        F.regexp_replace("props", r"\}\s*$", ""), F.lit(',"q":{"kind":"'), "event_type", F.lit('"}}}'),
    )
    records = table(spark, folder, "events").select(F.parse_json(body).alias("record"))
    flat = pages.typed_records(records)
    as_text = F.concat(F.lit("["), F.array_join(F.col("list").cast("array<string>"), ","), F.lit("]"))
    return flat.withColumn("list", as_text)


_MODE = "CASE user_id % 3 WHEN 0 THEN 'API_FIRST' WHEN 1 THEN 'SFTP_ONLY' ELSE 'API_ONLY' END"
_FILE_CATEGORY = "CASE event_type WHEN 'error' THEN 'subject_visit' WHEN 'signup' THEN 'subject_group' ELSE 'misc' END"


@query(f"""
    WITH e AS (SELECT event_id, event_type, {_MODE} AS mode, user_id % 2 = 0 AS ok, {_FILE_CATEGORY} AS category
               FROM events)
    SELECT event_id, 'API' AS "dataSource" FROM e WHERE event_type IN ('click', 'view')
           AND (mode = 'API_ONLY' OR (mode = 'API_FIRST' AND ok))
    UNION ALL
    SELECT event_id, 'SFTP' FROM e WHERE event_type NOT IN ('click', 'view')
           AND (mode = 'SFTP_ONLY' OR (mode = 'API_FIRST' AND (NOT ok OR category <> 'subject_visit')))
""")
def source_mode_union(spark: SparkSession, folder: str) -> DataFrame:
    """Users as studies: each takes API rows, file rows, or API rows and the files that are no visits."""
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id")
    kind = F.col("event_type")
    category = F.when(kind == "error", S.SUBJECT_VISIT).when(kind == "signup", S.SUBJECT_GROUP).otherwise(S.MISC)
    mode = F.element_at(
        F.array(F.lit("API_FIRST"), F.lit("SFTP_ONLY"), F.lit("API_ONLY")), (F.col("user_id") % 3 + 1).cast("int")
    )
    status = events.select("user_id").distinct()
    status = status.select("user_id", mode.alias("mode"), (F.col("user_id") % 2 == 0).alias("api_ok"))
    status = cut_lineage(status)
    api = events.where(kind.isin("click", "view"))
    files = events.where(~kind.isin("click", "view")).withColumn("category", category)
    return modes.compose(api, files, status, "user_id").select("event_id", "dataSource")


def lineitem_files(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as rows of files: the line status is the run, the return flag the file."""
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", "subject_visit_A.csv").when(flag == "N", "SubjectGrp-N.csv").otherwise("misc.csv")
    return table(spark, folder, "lineitem").select(F.col("l_linestatus").alias("run"), label.alias("label"))


_FILES = """(SELECT l_linestatus AS run, CASE l_returnflag WHEN 'A' THEN 'subject_visit_A.csv'
            WHEN 'N' THEN 'SubjectGrp-N.csv' ELSE 'misc.csv' END AS label, count(*) AS rows FROM lineitem GROUP BY 1, 2)"""


@query(f"SELECT run, label, rows FROM {_FILES}")
def file_totals(spark: SparkSession, folder: str) -> DataFrame:
    return summary.file_totals(lineitem_files(spark, folder), ["run", "label"])


@query(f"""
    WITH f AS (SELECT *, run = 'O' AND {_CATEGORY} = 'subject_visit' AS skipped FROM {_FILES})
    SELECT run, count(*) FILTER (WHERE NOT skipped) AS "filesAdded",
           count(*) FILTER (WHERE skipped) AS "visitFilesSkipped",
           cast(sum(CASE WHEN skipped THEN 0 ELSE rows END) AS bigint) AS "rowCount",
           count(*) FILTER (WHERE NOT skipped AND rows > 0) AS objects,
           CASE WHEN count(*) FILTER (WHERE NOT skipped AND rows > 0) > 0 THEN 'INGESTED' ELSE 'COMPLETED' END
             AS "ingestionStatus"
    FROM f GROUP BY run
""")
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Per run: files, rows, objects, status; one run has its visits from the API."""
    totals = summary.file_totals(lineitem_files(spark, folder), ["run", "label"])
    files = totals.withColumn("category", text.category(F.col("label")))
    return summary.run_totals(files, ["run"], api_visits=F.col("run") == "O")


@query("""
    SELECT l_linestatus, CASE WHEN l_returnflag = 'A' THEN 'SFTP' ELSE 'API' END AS source, count(*) AS n,
           max(CASE WHEN l_returnflag = 'A' THEN 'files.example' END) AS endpoint FROM lineitem GROUP BY 1, 2
""")
def source_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Where rows came from; an empty setting gives null."""
    source = F.when(F.col("l_returnflag") == "A", "SFTP").otherwise("API")
    rows = table(spark, folder, "lineitem").select("l_linestatus", source.alias("source"))
    endpoint = text.endpoint(F.col("source"), "files.example", "")
    return rows.groupBy("l_linestatus", "source").agg(F.count("*").alias("n"), F.max(endpoint).alias("endpoint"))


_PREVIEW_ORDER = ["event_id"]


def _joined(rows: Column) -> Column:
    return F.array_join(rows, "\n")


@query("""
    WITH r AS (SELECT event_type, event_id, user_id, CASE WHEN value > 50 THEN event_type END AS note,
                      row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events),
    t AS (SELECT event_type, count(*) AS "totalRowsInFile" FROM events GROUP BY 1)
    SELECT t.event_type, "totalRowsInFile", count(*) AS "previewRowCount",
           string_agg('{"event_id":' || event_id || ',"user_id":' || user_id || ',"note":' ||
                      coalesce('"' || note || '"', 'null') || '}', chr(10) ORDER BY event_id) AS rows
    FROM r JOIN t ON r.event_type = t.event_type WHERE k <= 10 GROUP BY 1, 2
""")
def preview_top_n(spark: SparkSession, folder: str) -> DataFrame:
    """First ten rows per event type as JSON, and the totals."""
    note = F.when(F.col("value") > 50, F.col("event_type")).alias("note")
    events = table(spark, folder, "events").select("event_type", "event_id", "user_id", note)
    found = preview.preview_rows(events, ["event_type"], _PREVIEW_ORDER, ["event_id", "user_id", "note"], 10)
    return found.withColumn("rows", _joined(F.col("rows"))).withColumn(
        "previewRowCount", F.col("previewRowCount").cast("long")
    )


@query("""
    SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_acctbal > 5000 ORDER BY s_suppkey LIMIT 1
""")
def first_active(spark: SparkSession, folder: str) -> DataFrame:
    """The first active row by id."""
    rows = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.col("s_acctbal") > 5000).alias("isActive")
    )
    return tables.sponsor_row(rows).drop("isActive")
