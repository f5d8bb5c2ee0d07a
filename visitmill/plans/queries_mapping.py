"""Registered queries: column mapping, names, labels, settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import text
from visitmill.operators import mapping
from visitmill.operators.stems import unique_stems
from visitmill.plans.registry import query, table
from visitmill.sources import tables

_ORDER_SOURCES = {
    "studySiteNumber": "cast(o_custkey AS varchar)",
    "subjectId": "cast(o_orderkey AS varchar)",
    "subjectStatus": "o_orderstatus",
    "subjectVisitDate": "strftime(o_orderdate, '%Y-%m-%d')",
    "cohort": "o_orderpriority",
}


def orders_as_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Orders under the column names of a visit extract, as text."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias(" Subject_Id"),
        F.col("o_custkey").cast("string").alias("STUDY_SITE"),
        F.col("o_orderstatus").alias("subject_status "),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("VISIT_DT"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.col("o_totalprice").cast("string").alias("TOTAL"),
    )


ORDER_RULES = {"VISIT_DT": "subjectVisitDate", "PRIORITY": "cohort", "TOTAL": "price"}


@query("SELECT " + ", ".join(f"{_ORDER_SOURCES.get(t, chr(39) * 2)} AS {t}" for t in S.TARGETS) + " FROM orders")
def normalize_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Rename by rule and dictionary, add what is missing, drop the rest."""
    return mapping.normalize(mapping.upper_names(orders_as_extract(spark, folder)), ORDER_RULES)


@query("""
    SELECT subjectStatus, count(*) AS n FROM (SELECT o_orderstatus AS subjectStatus FROM orders) GROUP BY 1
""")
def normalized_by_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = normalize_orders(spark, folder)
    return rows.groupBy("subjectStatus").agg(F.count("*").alias("n"))


@query("""
    SELECT cast(c_custkey AS varchar) AS "subjectId",
           coalesce(CASE WHEN c_acctbal >= 0 THEN 'site ' || c_nationkey END, cast(c_nationkey AS varchar))
             AS "studySiteNumber",
           c_mktsegment AS cohort, '' AS strata
    FROM customer
""")
def duplicate_target_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns for one target: the rule's column first, then the alias."""
    raw = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("SUBJECT_ID"),
        F.col("c_nationkey").alias("STUDY_SITE_NUMBER"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("site "), "c_nationkey")).alias("SITE_ID"),
        F.col("c_mktsegment").alias("SBJ_COH_COHORT_NUM"),
    )
    rows = mapping.normalize(raw, {"SITE_ID": "studySiteNumber"}, category=S.SUBJECT_GROUP)
    return rows.select("subjectId", "studySiteNumber", "cohort", "strata")


@query("""
    SELECT cast(s_suppkey AS varchar) AS "subjectId", cast(s_nationkey AS varchar) AS "studySiteNumber",
           s_name AS strata, cast(cast(floor(s_acctbal) AS bigint) AS varchar) AS cohort, 'S' AS "studyId",
           '2020-01-01' AS "dateEntryDate", '' AS "formName"
    FROM supplier
""")
def subject_group_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """The four built-in names of subject-group files, without any rule."""
    raw = table(spark, folder, "supplier").select(
        F.lit("S").alias("study_id"),
        F.col("s_suppkey").alias("subject_id"),
        F.col("s_nationkey").alias("study_site_number"),
        F.col("s_name").alias("sbj_str_strata_num"),
        F.floor("s_acctbal").alias("sbj_coh_cohort_num"),
        F.lit("2020-01-01").alias("creation_ts"),
    )
    rows = mapping.normalize(raw, category=S.SUBJECT_GROUP)
    return rows.select("studyId", "subjectId", "studySiteNumber", "strata", "cohort", "dateEntryDate", "formName")


@query("""
    SELECT cast(l_orderkey AS varchar) AS "subjectId", l_returnflag AS "procedureStatus", '' AS cohort,
           '' AS "studySiteNumber" FROM lineitem
""")
def fill_api_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that carry target names already: exact names only."""
    raw = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("subjectId"),
        F.col("l_returnflag").alias("procedureStatus"),
        F.col("l_suppkey").alias("STUDY_SITE"),
        F.col("l_linestatus").alias("COHORT_"),
    )
    return mapping.fill_targets(raw).select("subjectId", "procedureStatus", "cohort", "studySiteNumber")


_LABEL = """source || CASE lang WHEN 'en' THEN '_Subject-Visit_' WHEN 'de' THEN '-SUBJECT_GRP-'
            WHEN 'fr' THEN '_subjectvisit_subjectgrp' ELSE '_visit' END || '.csv'"""


def document_labels(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    kind = (
        F.when(F.col("lang") == "en", "_Subject-Visit_")
        .when(F.col("lang") == "de", "-SUBJECT_GRP-")
        .when(F.col("lang") == "fr", "_subjectvisit_subjectgrp")
        .otherwise("_visit")
    )
    label = F.concat("source", kind, F.lit(".csv")).alias("label")
    return table(spark, folder, "documents").select("doc_id", label, *columns)


_CATEGORY = """CASE WHEN contains(replace(replace(lower(label), '_', ''), '-', ''), 'subjectgrp')
            THEN 'subject_group'
            WHEN contains(replace(replace(lower(label), '_', ''), '-', ''), 'subjectvisit')
            THEN 'subject_visit' ELSE 'misc' END"""


@query(f"SELECT doc_id, label, {_CATEGORY} AS category FROM (SELECT doc_id, {_LABEL} AS label FROM documents)")
def classify_labels(spark: SparkSession, folder: str) -> DataFrame:
    return document_labels(spark, folder).withColumn("category", text.category(F.col("label")))


_STEM = """substr(coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(
            regexp_extract(regexp_replace(url, '(/\\.?)+$', ''), '[^/]*$'),
            '(.)\\.[^.]+$', '\\1'), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'part'), 1, 200)"""


@query(f"SELECT page_id, {_STEM} AS stem FROM pages")
def safe_stem(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.safe_stem(F.col("url")).alias("stem"))


@query(f"""
    WITH b AS (SELECT page_id, {_STEM} AS base FROM pages),
    n AS (SELECT page_id, base, row_number() OVER (PARTITION BY base ORDER BY page_id) - 1 AS k FROM b)
    SELECT page_id, CASE WHEN k = 0 THEN base
        ELSE substr(base, 1, 199 - length(cast(k AS varchar))) || '_' || k END AS stem
    FROM n
""")
def unique_stem(spark: SparkSession, folder: str) -> DataFrame:
    """Unique names for all pages, in the order of their ids."""
    labels = table(spark, folder, "pages").select("page_id", "url")
    return unique_stems(labels, F.col("url"), "page_id").select("page_id", "stem")


@query("""
    SELECT c_custkey, i, CASE c_custkey % 4 WHEN 0 THEN ['a', 'a_1', 'a_1_1'][i] WHEN 1 THEN ['a_1', 'a', 'a_2'][i]
           WHEN 2 THEN ['a', 'a_2', 'a_1'][i] ELSE ['b_2', 'b', 'b_1'][i] END AS stem
    FROM customer, (VALUES (1), (2), (3)) v(i)
""")
def unique_stem_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Natural names that equal numbered ones, in different orders; each customer is a scope, every fifth with a null part."""
    kinds = [["a", "a", "a_1"], ["a_1", "a", "a"], ["a", "a_2", "a"], ["b_2", "b", "b"]]
    listed = F.get(F.array(*[F.array(*[F.lit(x) for x in k]) for k in kinds]), (F.col("c_custkey") % 4).cast("int"))
    labels = table(spark, folder, "customer").select("c_custkey", F.posexplode(listed).alias("at", "label"))
    ordered = labels.withColumns(
        {"arrival": F.col("c_custkey") * 3 + F.col("at"), "part": F.when(F.col("c_custkey") % 5 != 0, "p")}
    )
    named = unique_stems(ordered, F.col("label"), "arrival", scope=["c_custkey", "part"])
    return named.select("c_custkey", (F.col("at") + 1).alias("i"), "stem")


@query(f"""
    SELECT page_id, 'landing/in/S' || (page_id % 7) || '/normalized/run/' || {_STEM} || '.parquet' AS key
    FROM pages
""")
def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    study = F.concat(F.lit("S"), (F.col("page_id") % 7).cast("string"))
    key = text.object_key(F.lit(" /landing/in// "), study, F.lit("run"), F.col("url"))
    return table(spark, folder, "pages").select("page_id", key.alias("key"))


_NAMES = [" study_id ", "Site_Id", "STUDY_SITE_NUMBER", "visit_dt", "studyId", "Unknown"]
_RULES = [
    (1, "subject_visit", "visit_dt ", "subjectVisitDate", True),
    (2, "subject_group", " SITE_ID", "studySiteNumber", True),
    (3, "subject_group", "site_id", "STUDY_SITE_NUMBER", True),
    (4, "misc", "unknown", " VISIT_NAME ", True),
    (5, "misc", "Unknown", "formName", False),
    (6, "misc", "visit_dt", " ", True),
    (7, "subject_visit", "economy", "cohort", True),
]
_RULE_VALUES = ", ".join(f"({i}, '{t}', '{s}', '{g}', {str(a).lower()})" for i, t, s, g, a in _RULES)
_DIRECT = ", ".join(f"('{s}', '{t}')" for s, t in S.SOURCE_TO_TARGET.items())
_ALIAS = ", ".join(f"('{s}', '{t}')" for s, t in S.GROUP_ALIASES.items())


@query(f"""
    WITH rules(id, category, s, t, active) AS (VALUES {_RULE_VALUES}),
    usable AS (SELECT category, upper(trim(s)) AS source, arg_max(trim(t), id) AS target FROM rules
               WHERE active AND trim(s) <> '' AND trim(t) <> '' GROUP BY 1, 2),
    direct(source, target) AS (VALUES {_DIRECT}),
    alias(source, target) AS (VALUES {_ALIAS}),
    headers AS (SELECT p_partkey AS file, unnest([{", ".join(f"'{n}'" for n in _NAMES)}, p_type]) AS name,
                CASE p_size % 3 WHEN 0 THEN 'subject_visit' WHEN 1 THEN 'subject_group' ELSE 'misc' END AS category
                FROM part),
    ruled AS (SELECT h.*, u.target AS rule_target, coalesce(u.target, upper(trim(h.name))) AS n1
              FROM headers h LEFT JOIN usable u ON h.category = u.category AND upper(trim(h.name)) = u.source),
    aliased AS (SELECT r.*, a.target AS alias_target, coalesce(a.target, r.n1) AS n2 FROM ruled r
                LEFT JOIN alias a ON r.category = 'subject_group' AND upper(trim(r.n1)) = a.source),
    final AS (SELECT a.*, coalesce(d.target, a.n2) AS n3 FROM aliased a LEFT JOIN direct d ON a.n2 = d.source)
    SELECT file, category, name,
           CASE WHEN n3 IN (SELECT target FROM direct) THEN n3 END AS target,
           CASE WHEN n3 NOT IN (SELECT target FROM direct) THEN NULL WHEN rule_target IS NOT NULL THEN 1
                WHEN alias_target IS NOT NULL THEN 2 ELSE 3 END AS step
    FROM final
""")
def mapping_rule_join(spark: SparkSession, folder: str) -> DataFrame:
    """Header names of many files against the rules of their category."""
    rules = spark.createDataFrame(
        _RULES, "id int, type string, sourceColumn string, targetColumn string, isActive boolean"
    )
    size = F.col("p_size") % 3
    category = F.when(size == 0, S.SUBJECT_VISIT).when(size == 1, S.SUBJECT_GROUP).otherwise(S.MISC)
    names = F.array(*[F.lit(n) for n in _NAMES], F.col("p_type"))
    headers = table(spark, folder, "part").select(
        F.col("p_partkey").alias("file"), category.alias("category"), F.explode(names).alias("name")
    )
    return mapping.resolve_headers(headers, mapping.active_rules(rules))


def part_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as a mapping table with blank, inactive and repeated rules."""
    size = F.col("p_size")
    kind = F.when(size % 3 == 0, S.SUBJECT_VISIT).when(size % 3 == 1, S.SUBJECT_GROUP).otherwise(S.MISC)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        kind.alias("type"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("\t")).alias("sourceColumn"),
        F.when(size % 10 == 1, "  ").otherwise(F.col("p_brand")).alias("targetColumn"),
        F.col("p_type").alias("description"),
        (size % 5 != 0).alias("isActive"),
        F.lit("seed").alias("createdBy"),
        F.lit(None).cast("string").alias("updatedBy"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("createdAt"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("updatedAt"),
    )


_PART_RULES = """(SELECT p_partkey AS id,
        CASE p_size % 3 WHEN 0 THEN 'subject_visit' WHEN 1 THEN 'subject_group' ELSE 'misc' END AS type,
        upper(p_name) AS source, CASE WHEN p_size % 10 = 1 THEN '' ELSE p_brand END AS target,
        p_size % 5 <> 0 AS active FROM part)"""


@query(f"""
    SELECT type AS category, source, arg_max(target, id) AS target FROM {_PART_RULES}
    WHERE active AND source <> '' AND target <> '' GROUP BY 1, 2
""")
def active_rules(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.active_rules(part_rules(spark, folder))


@query(f"""
    SELECT type AS category, count(DISTINCT source) AS rules FROM {_PART_RULES}
    WHERE active AND source <> '' AND target <> '' GROUP BY 1
""")
def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.rule_counts(part_rules(spark, folder))


@query("""
    SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'subject_visit' WHEN 1 THEN 'subject_group' ELSE 'misc' END
             AS category,
           ' ' || p_name || chr(9) AS source_column, CASE WHEN p_size % 10 = 1 THEN '  ' ELSE p_brand END
             AS target_column, p_type AS description, p_size % 5 <> 0 AS is_active, 'seed' AS created_by,
           CAST(NULL AS varchar) AS updated_by, TIMESTAMP '2024-01-01' AS created_at,
           TIMESTAMP '2024-01-02' AS updated_at
    FROM part
""")
def mapping_view(spark: SparkSession, folder: str) -> DataFrame:
    return mapping.mapping_view(part_rules(spark, folder))


@query("""
    SELECT 'misc' AS category, p_name AS source_column, p_brand AS target_column,
           CAST(NULL AS varchar) AS description, coalesce(CASE WHEN p_size % 2 = 0 THEN false END, true) AS is_active,
           p_type AS created_by
    FROM part
""")
def mapping_input(spark: SparkSession, folder: str) -> DataFrame:
    sent = table(spark, folder, "part").select(
        F.lit("misc").alias("category"),
        F.col("p_name").alias("source_column"),
        F.col("p_brand").alias("target_column"),
        F.when(F.col("p_size") % 2 == 0, F.lit(False)).alias("is_active"),
        F.col("p_type").alias("created_by"),
    )
    return mapping.mapping_input(sent)


@query("""
    SELECT c_custkey, 'N' || c_nationkey AS "studyId",
           coalesce(nullif(trim(s), ''), 'tenant') AS "sponsorId"
    FROM customer LEFT JOIN (SELECT n_nationkey + 5 AS k,
           CASE WHEN n_regionkey = 1 THEN ' ' ELSE ' ' || n_name || ' ' END AS s FROM nation) ON c_nationkey = k
""")
def config_default_join(spark: SparkSession, folder: str) -> DataFrame:
    """Config of each study, with the tenant where there is none or its sponsor is blank."""
    studies = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("N"), "c_nationkey").alias("studyId")
    )
    named = F.concat(F.lit(" "), "n_name", F.lit(" "))
    configs = table(spark, folder, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey") + 5).alias("studyId"),
        F.when(F.col("n_regionkey") == 1, " ").otherwise(named).alias("sponsorId"),
    )
    return tables.config_for(studies, configs, "tenant")


_MODES = """CASE o_orderpriority WHEN '1-URGENT' THEN ' api_first ' WHEN '2-HIGH' THEN 'SFTP_ONLY'
            WHEN '3-MEDIUM' THEN 'Api_Only' WHEN '5-LOW' THEN '' ELSE o_orderpriority END"""


@query(f"""
    WITH m AS (SELECT o_orderkey, {_MODES} AS raw, o_orderstatus AS st FROM orders),
    r AS (SELECT o_orderkey, raw, upper(trim(coalesce(CASE WHEN st = 'F' THEN 'api_only' END, nullif(raw, ''),
            nullif(trim(CASE WHEN st = 'O' THEN ' api_first' ELSE ' ' END), ''), 'API_ONLY'))) AS c FROM m)
    SELECT o_orderkey,
           CASE WHEN upper(trim(raw)) IN ('API_FIRST', 'SFTP_ONLY', 'API_ONLY') THEN upper(trim(raw))
                ELSE 'SFTP_ONLY' END AS coerced,
           CASE WHEN c IN ('API_FIRST', 'SFTP_ONLY', 'API_ONLY') THEN c ELSE 'SFTP_ONLY' END AS resolved
    FROM r
""")
def mode_coerce(spark: SparkSession, folder: str) -> DataFrame:
    """Source mode folded to an allowed one, and by precedence of argument, config and setting."""
    priority = F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", " api_first ")
        .when(priority == "2-HIGH", "SFTP_ONLY")
        .when(priority == "3-MEDIUM", "Api_Only")
        .when(priority == "5-LOW", "")
        .otherwise(priority)
    )
    status = F.col("o_orderstatus")
    argument = F.when(status == "F", "api_only")
    setting = F.when(status == "O", " api_first").otherwise(" ")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.source_mode(raw).alias("coerced"),
        text.resolve_mode(argument, raw, setting).alias("resolved"),
    )


@query("""
    WITH s AS (SELECT event_id, CASE event_type WHEN 'click' THEN ' Local_LocalStack' WHEN 'view' THEN 'UAT'
                 WHEN 'error' THEN '' ELSE event_type END AS env,
               CASE event_type WHEN 'click' THEN 'raw' WHEN 'view' THEN ' Stage ' ELSE event_type END AS depth,
               CASE event_type WHEN 'click' THEN 'LocalStack-Full' WHEN 'view' THEN 'full' ELSE event_type END AS mode
               FROM events)
    SELECT event_id,
           CASE WHEN replace(lower(trim(env)), '_', '-') IN ('local-compose', 'local-localstack', 'dev', 'uat', 'prod')
                THEN replace(lower(trim(env)), '_', '-') ELSE 'local-compose' END AS environment,
           CASE WHEN upper(trim(depth)) IN ('RAW', 'STAGE', 'PUBLISH') THEN upper(trim(depth)) ELSE 'PUBLISH' END
             AS depth,
           CASE WHEN replace(lower(trim(mode)), '-', '_') IN ('localstack_full', 'full') THEN 'localstack_full'
                ELSE 'compose' END AS runtime_mode
    FROM s
""")
def setting_coerce(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    env = F.when(kind == "click", " Local_LocalStack").when(kind == "view", "UAT").when(kind == "error", "").otherwise(kind)
    depth = F.when(kind == "click", "raw").when(kind == "view", " Stage ").otherwise(kind)
    mode = F.when(kind == "click", "LocalStack-Full").when(kind == "view", "full").otherwise(kind)
    return table(spark, folder, "events").select(
        "event_id",
        text.environment(env).alias("environment"),
        text.depth(depth).alias("depth"),
        text.runtime_mode(mode).alias("runtime_mode"),
    )


@query("""
    SELECT c_custkey, lower(c_mktsegment) || '_' || c_nationkey AS tenant,
           true AS lower_ok, regexp_matches(c_name, '^[a-z][a-z0-9_]{0,62}$') AS name_ok
    FROM customer
""")
def tenant_names(spark: SparkSession, folder: str) -> DataFrame:
    tenant = F.concat(F.lower("c_mktsegment"), F.lit("_"), "c_nationkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        tenant.alias("tenant"),
        text.valid_tenant(tenant).alias("lower_ok"),
        text.valid_tenant(F.col("c_name")).alias("name_ok"),
    )
