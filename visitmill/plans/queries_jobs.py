"""Queries over whole jobs: ingest in every mode, its audits, preview, seed. No ids and times in the results."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.operators import eligibility
from visitmill.plans import ingest, preview, seed
from visitmill.plans.registry import query, table
from visitmill.session import cut_lineage, new_folder
from visitmill.sinks import versions
from visitmill.sources import tables

MODES = ["SFTP_ONLY", "API_FIRST", "API_ONLY"]
STUDIES = ["full", "unended", "none"]
# Files per landed table; events per page.
FILES, PER_PAGE = 2, 100
LANDED_AT_ONCE = 6


def land(df: DataFrame, folder: str, name: str, files: int = FILES) -> None:
    """Write ``df`` as ``files`` delimited files ``name_0.csv``, … of a study's folder."""
    spark = df.sparkSession
    place = f"{folder}/{name}.parts"
    df.repartition(files).write.csv(place, header=True, escape='"')
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(str(s.getPath()) for s in system.globStatus(path(f"{place}/part-*")))
    for i, part in enumerate(parts):
        system.rename(path(part), path(f"{folder}/{name}_{i}.csv"))


def land_all(tables_to_land: Iterable[tuple[DataFrame, str, str, int]]) -> None:
    """:func:`land` several tables side by side, as few files give few tasks each."""
    with ThreadPoolExecutor(LANDED_AT_ONCE) as pool:
        list(pool.map(lambda one: land(*one), tables_to_land))


def landing(spark: SparkSession, folder: str) -> str:
    """Two studies with visits and other files, one file of each with a header only; the third has none."""
    place = new_folder(spark, "landing")
    visits = table(spark, folder, "orders").select(F.col("o_orderkey").alias("SUBJECT_ID"), F.col("o_orderstatus").alias("SUBJECT_STATUS"))
    others = table(spark, folder, "customer").select(F.col("c_custkey").alias("SUBJECT_ID"), F.col("c_mktsegment").alias("COHORT"))
    empty = others.limit(1).where("SUBJECT_ID IS NULL")
    kinds = [(visits, "Subject-Visit", FILES), (others, "others", FILES), (empty, "header_only", 1)]
    land_all((df, f"{place}/{study}", name, files) for df, name, files in kinds for study in STUDIES[:2])
    return place


def event_pages(spark: SparkSession, folder: str) -> DataFrame:
    """All events as numbered pages of two studies; the pull of the second has no last page."""
    events = table(spark, folder, "events")
    top = events.agg(F.max("event_id")).first()[0] or 0
    record = F.to_json(F.struct(F.col("event_id").alias("subjectId"), F.col("event_type").alias("cohort")))
    number = (F.floor(F.col("event_id") / PER_PAGE) + 1).alias("page")
    paged = events.groupBy(number).agg(F.array_join(F.array_sort(F.collect_list(record)), ",").alias("rows"))
    last = F.col("page") == top // PER_PAGE + 1
    studies = F.explode(F.array(*[F.lit(s) for s in STUDIES[:2]])).alias("study_id")
    mark = F.when(last & (F.col("study_id") == STUDIES[0]), ',"last":true}').otherwise(',"last":false}')
    body = F.concat(F.lit('{"content":['), "rows", F.lit("]"), mark)
    return paged.select("page", "rows", studies).select("study_id", F.col("page").cast("int").alias("page"), body.alias("body"))


def run_job(spark: SparkSession, pages: DataFrame, mode: str, place: str, **more) -> ingest.Settings:
    settings = ingest.Settings(landing=place, output=new_folder(spark, "out"), tenant="demo", page_size=1, file_host="files", **more)
    ingest.ingest(spark, STUDIES, settings, pages=pages, mode=mode)
    return settings


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`event_pages`, written once for all jobs of a query."""
    return cut_lineage(event_pages(spark, folder))


def _label(stem: Column) -> Column:
    return F.regexp_replace(stem, r"_\d+$", "")


# What each study takes by mode; a study without last page has a pull that failed.
_TAKES = """
    takes(mode, study, label) AS (VALUES
        ('SFTP_ONLY', 'full', 'Subject-Visit'), ('SFTP_ONLY', 'full', 'others'),
        ('SFTP_ONLY', 'unended', 'Subject-Visit'), ('SFTP_ONLY', 'unended', 'others'),
        ('API_FIRST', 'full', 'subject_visits'), ('API_FIRST', 'full', 'others'),
        ('API_FIRST', 'unended', 'Subject-Visit'), ('API_FIRST', 'unended', 'others'),
        ('API_ONLY', 'full', 'subject_visits')),
    sizes(label, n) AS (
        SELECT 'Subject-Visit', count(*) FROM orders UNION ALL SELECT 'others', count(*) FROM customer
        UNION ALL SELECT 'subject_visits', count(*) FROM events)
"""


@query(f"""
    WITH {_TAKES},
    ids(label, total) AS (
        SELECT 'Subject-Visit', sum(o_orderkey) FROM orders UNION ALL SELECT 'others', sum(c_custkey) FROM customer
        UNION ALL SELECT 'subject_visits', sum(event_id) FROM events)
    SELECT mode, study, label, n AS rows, total::BIGINT AS ids FROM takes JOIN sizes USING (label) JOIN ids USING (label)
""")
def ingest_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per study and kind of object after ingests in all three modes, with a failed pull among them."""
    place, pages, parts = landing(spark, folder), landed_pages(spark, folder), []
    for mode in MODES:
        rows = tables.read_runs(spark, run_job(spark, pages, mode, place).output)
        parts.append(rows.select(F.lit(mode).alias("mode"), F.col("study_id").alias("study"), _label(F.col("source_stem")).alias("label"), "subjectId"))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("mode", "study", "label").agg(F.count("*").alias("rows"), F.sum(F.col("subjectId").cast("long")).alias("ids"))


@query(f"""
    WITH {_TAKES},
    runs(mode, study, source, status, note) AS (VALUES
        ('SFTP_ONLY', 'full', 'SFTP', 'INGESTED', NULL), ('SFTP_ONLY', 'unended', 'SFTP', 'INGESTED', NULL),
        ('SFTP_ONLY', 'none', 'SFTP', 'COMPLETED', NULL),
        ('API_FIRST', 'full', 'API', 'INGESTED', NULL), ('API_FIRST', 'unended', 'SFTP', 'INGESTED', NULL),
        ('API_FIRST', 'none', 'SFTP', 'COMPLETED', NULL),
        ('API_ONLY', 'full', 'API', 'INGESTED', NULL),
        ('API_ONLY', 'unended', 'API', 'FAILED', 'No usable API pages: no last page'),
        ('API_ONLY', 'none', 'API', 'FAILED', 'No usable API pages: none landed'))
    SELECT r.mode, r.study, source, status, note, coalesce(sum(n), 0)::BIGINT AS rows,
           CASE WHEN source = 'SFTP' THEN 'files' END AS endpoint
    FROM runs r LEFT JOIN takes t ON r.mode = t.mode AND r.study = t.study LEFT JOIN sizes s ON s.label = t.label
    GROUP BY ALL
""")
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of runs in all modes: one row per run, failed ones with their reason."""
    place, pages, parts = landing(spark, folder), landed_pages(spark, folder), []
    for mode in MODES:
        output = run_job(spark, pages, mode, place).output
        parts.append(spark.read.schema(S.RUN_LOG).parquet(f"{output}/{ingest.RUN_TABLE}").withColumn("mode", F.lit(mode)))
    return reduce(DataFrame.unionByName, parts).select(
        "mode", F.col("studyId").alias("study"), F.col("dataSource").alias("source"), "status",
        F.col("failureReason").alias("note"), F.col("totalRows").alias("rows"), F.col("sourceEndpointUrl").alias("endpoint"),
    )


@query(f"""
    SELECT study, category, files, files AS hashes, true AS named FROM (VALUES
        ('full', 'subject_visit', {FILES}), ('full', 'misc', {FILES} + 1),
        ('unended', 'subject_visit', {FILES}), ('unended', 'misc', {FILES} + 1)) f(study, category, files)
    WHERE (SELECT count(*) FROM orders) >= {FILES} AND (SELECT count(*) FROM customer) >= {FILES}
""")
def file_log(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of files: every landed file with its category and hashes, the one without rows too."""
    settings = run_job(spark, landed_pages(spark, folder), "SFTP_ONLY", landing(spark, folder))
    log = spark.read.schema(S.FILE_LOG).parquet(f"{settings.output}/{ingest.FILE_TABLE}")
    named = F.bool_and(F.col("fileNameHash") == F.sha2("fileName", 256))
    return log.groupBy(F.col("studyId").alias("study"), F.col("mappingCategory").alias("category")).agg(
        F.count("*").cast("int").alias("files"), F.count_distinct("fileContentHash").cast("int").alias("hashes"), named.alias("named"),
    )


@query(f"""
    SELECT label, n AS rows, least(n, 10 * files) AS previewed, true AS in_order FROM (
        SELECT 'Subject-Visit' AS label, count(*) AS n, {FILES} AS files FROM orders
        UNION ALL SELECT 'others', count(*), {FILES} FROM customer)
""")
def run_preview(spark: SparkSession, folder: str) -> DataFrame:
    """First rows of every object of a run."""
    settings = run_job(spark, landed_pages(spark, folder), "SFTP_ONLY", landing(spark, folder))
    rows = tables.read_runs(spark, settings.output).where(F.col("study_id") == STUDIES[0])
    found = preview.preview_objects(rows, 10)
    whole = F.size(F.filter("rows", lambda r: F.get_json_object(r, "$.subjectId").isNotNull())) == F.col("previewRowCount")
    return found.groupBy(_label(F.col("source_stem")).alias("label")).agg(
        F.sum("totalRowsInFile").alias("rows"), F.sum("previewRowCount").cast("long").alias("previewed"), F.bool_and(whole).alias("in_order")
    )


@query(f"""
    WITH studies(study) AS (VALUES ('full'), ('unended'), ('none')), modes(mode) AS (VALUES ('SFTP_ONLY'), ('API_FIRST'), ('API_ONLY')),
    pulled AS (SELECT mode, study, mode <> 'SFTP_ONLY' AND study = 'full' AS api, study <> 'none' AND mode <> 'API_ONLY' AS files FROM studies, modes)
    SELECT mode, study, CASE WHEN api THEN (SELECT count(*) FROM events) ELSE 0 END AS fetched,
           CASE WHEN NOT files THEN 0 WHEN api THEN {FILES + 2} ELSE {2 * FILES + 2} END::BIGINT AS added,
           CASE WHEN files AND api THEN {FILES} ELSE 0 END::BIGINT AS skipped,
           CASE WHEN files THEN (SELECT count(*) FROM supplier) ELSE 0 END AS hidden
    FROM pulled
""")
def run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What runs in all modes fetched, added and skipped, and the rows of a file whose name Spark hides."""
    place, pages, parts = landing(spark, folder), landed_pages(spark, folder), []
    hidden = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("SUBJECT_ID"), F.lit("x").alias("COHORT"))
    for study in STUDIES[:2]:
        land(hidden, f"{place}/{study}", "_more", 1)
    for mode in MODES:
        output = run_job(spark, pages, mode, place, read_hidden=True).output
        log = spark.read.schema(S.RUN_LOG_COUNTS).parquet(f"{output}/{ingest.RUN_TABLE}")
        rows = tables.read_runs(spark, output).where(F.col("source_stem").contains("more"))
        found = rows.groupBy(F.col("run_id").alias("runId")).agg(F.count("*").alias("hidden"))
        parts.append(log.join(found, "runId", "left").withColumn("mode", F.lit(mode)))
    return reduce(DataFrame.unionByName, parts).select(
        "mode", F.col("studyId").alias("study"), F.col("rowsFetched").alias("fetched"), F.col("filesAdded").alias("added"),
        F.col("visitFilesSkipped").alias("skipped"), F.coalesce("hidden", F.lit(0)).alias("hidden"),
    )


def seed_lines(rows: DataFrame, section: str, row: Column, key: str, place: str) -> None:
    """Add rows as documents of one line each to a seed, in the order of ``key``."""
    line = F.to_json(F.struct(F.array(row).alias(section)))
    ordered = rows.select(line.alias("value"), key).repartitionByRange(FILES, key).sortWithinPartitions(key)
    ordered.select("value").write.mode("append").text(place)


@query("""
    SELECT 'R' || n_nationkey AS "ruleId", cast(n_regionkey + 1 AS varchar) AS "expectedValue", 'EQUALS' AS operator,
           true AS "isActive" FROM nation
""")
def seeded_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules after the same seed file was applied with one value and then with another."""
    place = new_folder(spark, "seed")
    for step in (0, 1):
        rule = F.struct(
            F.concat(F.lit("R"), "n_nationkey").alias("ruleId"), F.lit("cohort").alias("columnName"), F.lit("EQUALS").alias("operator"),
            (F.col("n_regionkey") + step).cast("string").alias("expectedValue"), F.col("n_name").alias("rejectionReason"),
        )
        seed_lines(table(spark, folder, "nation"), "eligibility_rule", rule, "n_nationkey", f"{place}/seed{step}")
        seed.seed_tenant(spark, "demo", f"{place}/seed{step}", f"{place}/tables", lines=True)
    rules = versions.read_current(spark, f"{place}/tables/demo/eligibility_rule", S.ELIGIBILITY_RULE)
    return rules.select("ruleId", "expectedValue", "operator", "isActive")


@query("""
    WITH rows AS (SELECT 'rule' AS kind, 0 AS step, 0 AS section, p_partkey AS k, 'R' || (p_partkey // 4) AS key, p_name AS value, p_brand AS maker FROM part WHERE p_partkey % 2 = 0
                  UNION ALL SELECT 'rule', 1, 0, p_partkey, 'R' || (p_partkey // 4), p_type, p_name FROM part WHERE p_partkey % 3 = 0
                  UNION ALL SELECT 'subject_group', 0, 1, s_suppkey, 'T' || (s_suppkey // 5), s_name, 'S' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 0
                  UNION ALL SELECT 'misc', 0, 2, s_suppkey, 'T' || (s_suppkey // 3), s_name, 'S' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 1
                  UNION ALL SELECT 'misc', 1, 2, s_suppkey, 'T' || (s_suppkey // 3), s_name || '!', 'again' FROM supplier),
    placed AS (SELECT *, row_number() OVER (ORDER BY step, section, k) AS n FROM rows),
    settled AS (SELECT kind, key, max_by(value, n) AS value, min_by(maker, n) AS maker, min(n) AS n FROM placed GROUP BY kind, key)
    SELECT kind, row_number() OVER (PARTITION BY kind = 'rule' ORDER BY n)::INTEGER AS id, key, value, maker FROM settled
""")
def seeded_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Rules from every part and mappings from every supplier by two seeds of JSON lines, in which keys repeat."""
    place = new_folder(spark, "seed")
    parts, suppliers = table(spark, folder, "part"), table(spark, folder, "supplier")

    def rule(value: str, maker: str) -> Column:
        return F.struct(
            F.concat(F.lit("R"), F.expr("p_partkey div 4")).alias("ruleId"), F.lit("cohort").alias("columnName"), F.lit("EQUALS").alias("operator"),
            F.col(value).alias("rejectionReason"), F.col(maker).alias("createdBy"),
        )

    def mapping(per: int, source: Column, maker: Column) -> Column:
        target = F.concat(F.lit("T"), F.expr(f"s_suppkey div {per}"))
        return F.struct(source.alias("sourceColumn"), target.alias("targetColumn"), maker.alias("createdBy"))

    name, maker = F.col("s_name"), F.concat(F.lit("S"), "s_suppkey")
    first, second = f"{place}/seed0", f"{place}/seed1"
    seed_lines(parts.where("p_partkey % 2 = 0"), "eligibility_rule", rule("p_name", "p_brand"), "p_partkey", first)
    seed_lines(suppliers.where("s_suppkey % 2 = 0"), "subject_group_column_mapping", mapping(5, name, maker), "s_suppkey", first)
    seed_lines(suppliers.where("s_suppkey % 2 = 1"), "misc_column_mapping", mapping(3, name, maker), "s_suppkey", first)
    seed_lines(parts.where("p_partkey % 3 = 0"), "eligibility_rule", rule("p_type", "p_name"), "p_partkey", second)
    seed_lines(suppliers, "misc_column_mapping", mapping(3, F.concat(name, F.lit("!")), F.lit("again")), "s_suppkey", second)
    for path in (first, second):
        seed.seed_tenant(spark, "demo", path, f"{place}/tables", lines=True)
    rules = versions.read_current(spark, f"{place}/tables/demo/eligibility_rule", S.ELIGIBILITY_RULE)
    mappings = versions.read_current(spark, f"{place}/tables/demo/data_column_mapping", S.COLUMN_MAPPING)
    ruled = rules.select(F.lit("rule").alias("kind"), "id", F.col("ruleId").alias("key"), F.col("rejectionReason").alias("value"), F.col("createdBy").alias("maker"))
    mapped = mappings.select(F.col("type").alias("kind"), "id", F.col("targetColumn").alias("key"), F.col("sourceColumn").alias("value"), F.col("createdBy").alias("maker"))
    return ruled.unionByName(mapped)


@query("""
    WITH items AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_partkey % 500 AS study FROM lineitem),
    rules AS (SELECT p_partkey, p_partkey % 500 AS study, p_size FROM part),
    judged AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
                      count(*) FILTER (WHERE NOT l_quantity > p_size) AS failed,
                      coalesce(bool_or(p_size % 2 = 0) FILTER (WHERE NOT l_quantity > p_size), false) AS blocking
               FROM items i LEFT JOIN rules r ON i.study = r.study GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, failed::INTEGER AS failed, blocking FROM judged
""")
def study_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a rule of one of 500 studies: line items against all rules of their study."""
    study = F.concat(F.lit("S"), F.col("p_partkey") % 500)
    rules = table(spark, folder, "part").select(
        F.concat(F.lit("R"), "p_partkey").alias("ruleId"), study.alias("studyId"), F.lit("l_quantity").alias("columnName"),
        F.lit("GREATER_THAN").alias("operator"), F.col("p_size").cast("string").alias("expectedValue"),
        F.col("p_name").alias("rejectionReason"), F.when(F.col("p_size") % 2 == 0, "BLOCKING").alias("ruleKind"), F.lit(True).alias("isActive"),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    items = table(spark, folder, "lineitem").select(*keys, F.concat(F.lit("S"), F.col("l_partkey") % 500).alias("studyId"))
    judged = eligibility.evaluate_table(items, rules, row_id=keys)
    return judged.select(*keys, F.col("failedRules").alias("failed"), "blocking")


@query("""
    WITH items AS (SELECT *, l_partkey % 4 AS study FROM lineitem),
    rules AS (SELECT p_partkey % 4 AS study, p_partkey // 4 % 4 AS kind, p_size FROM part WHERE p_partkey % 4 <> 3),
    own AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
                   count(*) AS failed, bool_or(kind = 0) AS blocking
            FROM items i JOIN rules r ON i.study = r.study AND (
                (kind = 0 AND l_quantity >= p_size + 40) OR (kind = 1 AND l_quantity <= p_size // 10)
                OR (kind = 2 AND l_linenumber = p_size) OR (kind = 3 AND l_returnflag = 'R' AND p_size % 50 = 0))
            GROUP BY ALL),
    shared AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, count(*) AS failed FROM items JOIN supplier ON l_suppkey = s_suppkey AND s_suppkey % 7 = 0 GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
           CASE WHEN study = 3 THEN 1 ELSE coalesce(o.failed, 0) + coalesce(s.failed, 0) END::INTEGER AS failed,
           study = 3 OR coalesce(o.blocking, false) AS blocking,
           CASE WHEN study = 3 THEN 'Rule BAD: unknown operator LIKE' END AS wrong
    FROM items LEFT JOIN own o USING (l_orderkey, l_linenumber, l_partkey, l_quantity) LEFT JOIN shared s USING (l_orderkey, l_linenumber, l_partkey, l_quantity)
""")
def rule_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a rule of one of three studies, suppliers as rules of all; a fourth study has a rule that cannot be applied."""
    kind, size = F.expr("p_partkey div 4 % 4"), F.col("p_size")
    study = F.concat(F.lit("S"), F.col("p_partkey") % 4)
    expected = (
        F.when(kind == 0, (size + 40).cast("string")).when(kind == 1, F.expr("p_size div 10").cast("string"))
        .when(kind == 2, F.concat_ws(",", size, F.lit("99"))).otherwise(F.when(size % 50 == 0, "A,N").otherwise("A,N,R"))
    )
    named = F.when(kind < 2, "l_quantity").when(kind == 2, "l_linenumber").otherwise("l_returnflag")
    operator = F.when(kind == 0, "LESS_THAN").when(kind == 1, "GREATER_THAN").when(kind == 2, "NOT_IN").otherwise("IN")
    own = table(spark, folder, "part").where("p_partkey % 4 <> 3").select(
        F.concat(F.lit("R"), "p_partkey").alias("ruleId"), study.alias("studyId"), named.alias("columnName"), operator.alias("operator"),
        expected.alias("expectedValue"), F.col("p_name").alias("rejectionReason"), F.when(kind == 0, "BLOCKING").alias("ruleKind"), F.lit(True).alias("isActive"),
    )
    shared = table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("ruleId"), F.lit(None).cast("string").alias("studyId"), F.lit("l_suppkey").alias("columnName"),
        F.lit("NOT_EQUALS").alias("operator"), F.when(F.col("s_suppkey") % 7 == 0, F.col("s_suppkey").cast("string")).alias("expectedValue"),
        F.col("s_name").alias("rejectionReason"), F.lit("NON_BLOCKING").alias("ruleKind"), F.lit(True).alias("isActive"),
    )
    bad = spark.createDataFrame([("BAD", "S3", "l_quantity", "LIKE", None, None, None, True)], own.schema)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    items = table(spark, folder, "lineitem").select(*keys, "l_suppkey", "l_returnflag", F.concat(F.lit("S"), F.col("l_partkey") % 4).alias("studyId"))
    judged = eligibility.evaluate_table(items, own.unionByName(shared).unionByName(bad), row_id=keys)
    return judged.select(*keys, F.col("failedRules").alias("failed"), "blocking", F.col("wrongRule").alias("wrong"))
