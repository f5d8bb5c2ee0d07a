"""Registered queries: upserts, dates, eligibility, arms, registry, schedule, pay mode, whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill import schema as S
from visitmill.functions import dates, skew
from visitmill.operators import arms, eligibility, upsert
from visitmill.operators.eligibility import Rule
from visitmill.plans import ingest, validate
from visitmill.plans.registry import ORACLES, query, table
from visitmill.session import cut_lineage, new_folder
from visitmill.sources import landing, tables


def _seed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers twice, as seed rows in order; the second round changes the name."""
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"),
        F.posexplode(F.array(F.lit("first "), F.lit("second "))).alias("turn", "prefix"),
        "c_name",
        "c_acctbal",
    )
    return rows.select(
        "key",
        F.concat("prefix", "c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.concat(F.lit("by "), "prefix", "key").alias("createdBy"),
        F.concat(F.lit("seed "), F.col("turn")).alias("updatedBy"),
        (2 * F.col("key") + F.col("turn")).alias("ordinal"),
    )


@query("""
    SELECT coalesce(s_suppkey, c_custkey) AS key,
           CASE WHEN c_custkey IS NULL THEN s_name ELSE 'second ' || c_name END AS name,
           CASE WHEN c_custkey IS NULL THEN s_acctbal ELSE c_acctbal END AS balance,
           CASE WHEN s_suppkey IS NULL THEN 'by first ' || c_custkey ELSE 'base' END AS "createdBy",
           CASE WHEN c_custkey IS NOT NULL THEN 'seed 1' END AS "updatedBy"
    FROM (SELECT 2 * s_suppkey AS s_suppkey, s_name, s_acctbal FROM supplier)
    FULL OUTER JOIN customer ON s_suppkey = c_custkey
""")
def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Upsert on a unique key: the last seed row wins, created values stay or come from the first."""
    base = table(spark, folder, "supplier").select(
        (2 * F.col("s_suppkey")).alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
        F.lit("base").alias("createdBy"),
        F.lit(None).cast("string").alias("updatedBy"),
    )
    return upsert.upsert(base, _seed_customers(spark, folder), ["key"], created=["createdBy"])


@query("""
    WITH base AS (SELECT p_partkey AS id, p_type AS type, p_brand AS target, p_name AS source FROM part),
    seed AS (SELECT * FROM (SELECT n_nationkey AS ordinal, 'SMALL' AS type, 'Brand#' || (n_nationkey * 2) AS target,
                    lower(n_name) AS source FROM nation)),
    low AS (SELECT type, target, min(id) AS id FROM base GROUP BY 1, 2),
    fresh AS (SELECT s.*, row_number() OVER (ORDER BY ordinal) AS k FROM seed s
              WHERE NOT EXISTS (SELECT 1 FROM low l WHERE l.type = s.type AND l.target = s.target))
    SELECT b.id, b.type, b.target, coalesce(s.source, b.source) AS source,
           'base' AS "createdBy" FROM base b
    LEFT JOIN low l ON l.id = b.id LEFT JOIN seed s ON s.type = l.type AND s.target = l.target
    UNION ALL SELECT (SELECT max(id) FROM base) + k, type, target, source, 'seed' FROM fresh
""")
def upsert_with_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Upsert where the base may repeat a key: its lowest id is updated, new rows get the next ids."""
    base = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("target"),
        F.col("p_name").alias("source"),
        F.lit("base").alias("createdBy"),
    )
    seed = table(spark, folder, "nation").select(
        F.lit("SMALL").alias("type"),
        F.concat(F.lit("Brand#"), F.col("n_nationkey") * 2).alias("target"),
        F.lower("n_name").alias("source"),
        F.lit("seed").alias("createdBy"),
        F.col("n_nationkey").alias("ordinal"),
    )
    return upsert.upsert(base, seed, ["type", "target"], created=["createdBy"], row_id="id")


_FORMS = [
    dates.DAY_MONTH_NAME_TIME, dates.DAY_FIRST_TIME, dates.DAY_MONTH_NAME_SHORT, dates.DAY_MONTH_NAME,
    dates.MONTH_FIRST_TIME, dates.MONTH_FIRST_TIME_12,
]
_CUTS = ["second", "minute", "day", "day", "minute", "second"]


@query(
    "SELECT event_id, CASE event_id % 6 "
    + " ".join(f"WHEN {i} THEN date_trunc('{cut}', ts)" for i, cut in enumerate(_CUTS))
    + " END AS at FROM events"
)
def typed_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Event times written in six forms and read back; each source has its own form."""
    form = F.col("event_id") % len(_FORMS)
    ts = F.col("ts").cast("timestamp")
    shown = F.coalesce(*[F.when(form == i, F.date_format(ts, f)) for i, f in enumerate(_FORMS)])
    day_first, month_first = dates.DAY_FIRST_FORMS, dates.MONTH_FIRST_FORMS
    read = F.when(form < 4, dates.typed(F.upper(shown), day_first)).otherwise(dates.typed(shown, month_first))
    return table(spark, folder, "events").select("event_id", read.cast("timestamp_ntz").alias("at"))


RULES = [
    Rule("R1", "l_returnflag", "EQUALS", "N", "flag is not N"),
    Rule("R2", "l_linestatus", "NOT_EQUALS", "F", "status is F"),
    Rule("R3", "l_linenumber", "IN", " 1, 2 ,3,4 ", "line above 4"),
    Rule("R4", "l_suppkey", "NOT_IN", "3,5,8", "supplier is barred", kind="BLOCKING"),
    Rule("R5", "l_quantity", "GREATER_THAN", "10", "too few"),
    Rule("R6", "l_discount", "LESS_THAN", "0.08", "discount too high"),
    Rule("R7", "note", "IS_NOT_NULL", None, "note is blank"),
    Rule("R8", "memo", "IS_NULL", None, "memo is set", study_id="S1"),
]
_ITEMS = """(SELECT *, 'S' || (l_partkey % 3) AS "studyId",
             CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '  ' ELSE 'n' END AS note,
             CASE WHEN l_quantity > 40 THEN 'm' END AS memo FROM lineitem)"""
_FAILS = {
    "R1": "l_returnflag <> 'N'",
    "R2": "l_linestatus = 'F'",
    "R3": "l_linenumber NOT IN (1, 2, 3, 4)",
    "R4": "l_suppkey IN (3, 5, 8)",
    "R5": "NOT l_quantity > 10",
    "R6": "NOT l_discount < 0.08",
    "R7": "trim(coalesce(note, '')) = ''",
    "R8": "\"studyId\" = 'S1' AND trim(coalesce(memo, '')) <> ''",
}
_REASONS = (
    "concat_ws('; ', "
    + ", ".join(f"CASE WHEN {_FAILS[r.rule_id]} THEN '{r.reason}' END" for r in RULES)
    + ")"
)


def items_to_check(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
        "l_linestatus",
        F.concat(F.lit("S"), F.col("l_partkey") % 3).alias("studyId"),
        F.when(line == 2, "  ").when(line > 2, "n").alias("note"),
        F.when(F.col("l_quantity") > 40, "m").alias("memo"),
    )


@query(f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, reasons, blocking,
           CASE WHEN reasons <> '' THEN 'FAILED_ELIGIBILITY' ELSE 'VALID' END AS status
    FROM (SELECT *, {_REASONS} AS reasons, {_FAILS["R4"]} AS blocking FROM {_ITEMS})
""")
def eligibility_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Eight rules, one per operator: reasons by rule id, blocking flag, status."""
    rows = eligibility.evaluate(items_to_check(spark, folder), RULES)
    no = F.lit(False)
    status = eligibility.row_status(no, F.size("reasons") > 0, no, no)
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.array_join("reasons", "; ").alias("reasons"), "blocking", status.alias("status"),
    )


@query(f"""
    SELECT "studyId", count(*) AS "totalRows", count(*) FILTER (WHERE reasons = '' AND l_linestatus <> 'O')
             AS "validRows",
           count(*) FILTER (WHERE l_linestatus = 'O') AS "skippedRows", bool_or(blocking) AS blocked
    FROM (SELECT *, {_REASONS.replace(_FAILS["R2"], "false")} AS reasons, {_FAILS["R4"]} AS blocking FROM {_ITEMS})
    GROUP BY 1
""")
def eligibility_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per study of all, valid and skipped rows, and whether a blocking rule failed."""
    rules = [r for r in RULES if r.rule_id != "R2"]
    rows = eligibility.evaluate(items_to_check(spark, folder), rules)
    no, skipped = F.lit(False), F.col("l_linestatus") == "O"
    status = eligibility.row_status(skipped, F.size("reasons") > 0, no, no)
    return eligibility.status_counts(rows.withColumn("status", status), ["studyId"])


@query("""
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderstatus = 'F' WHEN '2-HIGH' THEN
             o_orderstatus NOT IN ('O', 'P') WHEN '3-MEDIUM' THEN o_orderstatus NOT IN ('O') ELSE false END AS skipped
    FROM orders
""")
def status_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Status lists of each study: denied, allowed, both, none or blank."""
    kind = F.col("o_orderpriority")
    payable = F.when(kind == "2-HIGH", "O , P").when(kind == "3-MEDIUM", "O,P").when(kind == "5-LOW", " , ")
    denied = F.when(kind == "1-URGENT", " F").when(kind == "3-MEDIUM", "P")
    allowed, barred = eligibility.listed(payable), eligibility.listed(denied)
    skipped = eligibility.status_skips(F.col("o_orderstatus"), allowed, barred)
    return table(spark, folder, "orders").select("o_orderkey", skipped.alias("skipped"))


_VISIT = ["o_orderkey"]


def order_visits(spark: SparkSession, folder: str, mode: str, **config: str) -> DataFrame:
    """Orders as visits of a study: the customer is the subject."""
    fixed = {"armResolutionMode": mode, **config}
    visits = table(spark, folder, "orders").select(
        "o_orderkey",
        F.lit("S").alias("studyId"),
        F.col("o_custkey").cast("string").alias("subjectId"),
        F.col("o_orderpriority").alias("cohort"),
        *[F.lit(v).alias(c) for c, v in fixed.items()],
    )
    return arms.arm_config(visits)


def customer_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as the subject-group extract, twice; the first row counts."""
    rows = table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", F.posexplode(F.array(F.lit(0), F.lit(1))).alias("turn", "_t")
    )
    later = F.col("turn") == 1
    return rows.select(
        F.lit("S").alias("studyId"),
        F.col("c_custkey").cast("string").alias("subjectId"),
        F.when(later, "later").otherwise(F.col("c_mktsegment")).alias("cohort"),
        F.when(later, "later").otherwise(F.concat(F.lit("N"), "c_nationkey")).alias("strata"),
        (2 * F.col("c_custkey") + F.col("turn")).alias("ordinal"),
    )


def supplier_template(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as the manual template: every fifth customer has a row, some without a group."""
    return table(spark, folder, "supplier").select(
        F.lit("S").alias("studyId"),
        (5 * F.col("s_suppkey")).cast("string").alias("subjectId"),
        F.when(F.col("s_nationkey") % 4 != 0, F.concat(F.lit("M"), "s_nationkey")).alias("subject_group"),
        F.col("s_suppkey").alias("ordinal"),
    )


def _arms(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", "arm")


@query("SELECT o_orderkey, 'A' AS arm FROM orders")
def arm_flat_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _arms(arms.resolve_arm(order_visits(spark, folder, "FLAT_RATE"), flat_arm="A"))


@query("SELECT o_orderkey, o_orderpriority AS arm FROM orders")
def arm_edc_only(spark: SparkSession, folder: str) -> DataFrame:
    return _arms(arms.resolve_arm(order_visits(spark, folder, "EDC_ONLY", edcArmColumn="cohort")))


_ARM_MAP = '{"BUILDING":"arm B","MACHINERY":"arm M"}'


@query("""
    SELECT o_orderkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'arm B' WHEN 'MACHINERY' THEN 'arm M' END AS arm,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'VALID' ELSE 'FAILED_STRATA' END AS status
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def arm_group_map(spark: SparkSession, folder: str) -> DataFrame:
    visits = order_visits(
        spark, folder, "IMPALA_GROUP_MAP_TO_ARM", impalaArmColumn="cohort", strataToArmMapping=_ARM_MAP
    )
    rows = arms.attach_groups(visits, customer_groups(spark, folder), order="ordinal", row_id=_VISIT)
    no = F.lit(False)
    status = eligibility.row_status(no, no, F.col("arm").isNull(), no).alias("status")
    return arms.resolve_arm(rows).select("o_orderkey", "arm", status)


@query("""
    SELECT o_orderkey, CASE WHEN s_nationkey % 4 <> 0 THEN 'M' || s_nationkey END AS arm
    FROM orders LEFT JOIN supplier ON o_custkey = 5 * s_suppkey
""")
def arm_manual_mapping(spark: SparkSession, folder: str) -> DataFrame:
    visits = order_visits(spark, folder, "MANUAL_MAPPING")
    template = supplier_template(spark, folder)
    return _arms(arms.resolve_arm(arms.attach_manual(visits, template, order="ordinal", row_id=_VISIT)))


@query("SELECT o_orderkey, 'N' || c_nationkey AS arm FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def arm_from_group_column(spark: SparkSession, folder: str) -> DataFrame:
    visits = order_visits(spark, folder, "IMPALA_BUDGET_ARM_FROM_COLUMN")
    groups = customer_groups(spark, folder)
    return _arms(arms.resolve_arm(arms.attach_groups(visits, groups, order="ordinal", row_id=_VISIT)))


@query("""
    SELECT o_orderkey, coalesce(CASE WHEN s_nationkey % 4 <> 0 THEN 'M' || s_nationkey END, 'N' || c_nationkey) AS arm
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON o_custkey = 5 * s_suppkey
""")
def arm_hybrid(spark: SparkSession, folder: str) -> DataFrame:
    visits = order_visits(spark, folder, "HYBRID")
    rows = arms.attach_groups(visits, customer_groups(spark, folder), order="ordinal", row_id=_VISIT)
    rows = arms.attach_manual(rows, supplier_template(spark, folder), order="ordinal", row_id=_VISIT)
    return _arms(arms.resolve_arm(rows))


def _site(subject: str) -> Column:
    """Subjects of every third number have no site."""
    return F.when(F.col(subject) % 3 != 0, "1")


def armed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.lit("S").alias("studyId"),
        _site("o_custkey").alias("siteId"),
        F.col("o_custkey").cast("string").alias("subjectId"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("arm"),
    )


def supplier_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Two active rows per registered subject; the older one counts."""
    twice = F.explode(F.array(F.struct(F.lit("1-URGENT").alias("arm"), F.lit(2021).alias("year")), F.struct(F.lit("2-HIGH").alias("arm"), F.lit(2020).alias("year"))))
    return table(spark, folder, "supplier").withColumn("row", twice).select(
        F.lit("S").alias("studyId"),
        _site("s_suppkey").alias("siteId"),
        F.col("s_suppkey").cast("string").alias("subjectId"),
        F.col("row.arm").alias("assignedBudgetArm"),
        F.make_timestamp(F.col("row.year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("createdAt"),
        (F.col("s_nationkey") % 3 != 0).alias("isActive"),
    )


_KNOWN = """
    rows AS (SELECT o_orderkey, o_custkey AS subject, CASE WHEN o_custkey % 3 <> 0 THEN '1' END AS site,
                    CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS arm FROM orders),
    first AS (SELECT subject, site, arg_min(arm, o_orderkey) AS arm FROM rows WHERE arm IS NOT NULL GROUP BY ALL),
    registry AS (SELECT s_suppkey AS subject, CASE WHEN s_suppkey % 3 <> 0 THEN '1' END AS site, arm, year
                 FROM supplier, (VALUES ('1-URGENT', 2021), ('2-HIGH', 2020)) v(arm, year) WHERE s_nationkey % 3 <> 0),
    kept AS (SELECT subject, site, arg_min(arm, year) AS kept FROM registry GROUP BY ALL),
    known AS (SELECT coalesce(k.subject, f.subject) AS subject, coalesce(k.site, f.site) AS site,
                     coalesce(kept, arm) AS registered, kept IS NULL AS is_new
              FROM first f FULL OUTER JOIN kept k ON f.subject = k.subject AND f.site IS NOT DISTINCT FROM k.site)"""


@query(f"""
    WITH {_KNOWN}
    SELECT o_orderkey, registered AS registered_arm, coalesce(arm <> registered, false) AS arm_changed
    FROM rows r LEFT JOIN known k ON r.subject = k.subject AND r.site IS NOT DISTINCT FROM k.site
""")
def registry_immutability(spark: SparkSession, folder: str) -> DataFrame:
    """The first arm of a subject stays; orders with another arm have changed it."""
    rows = armed_orders(spark, folder)
    known = cut_lineage(arms.known_arms(rows, supplier_registry(spark, folder), order="o_orderkey"))
    checked = arms.check_registry(rows, known, row_id=_VISIT)
    return checked.select("o_orderkey", "registered_arm", "arm_changed")


@query(f"""
    WITH {_KNOWN}
    SELECT 'S' AS "studyId", site AS "siteId", cast(subject AS varchar) AS "subjectId",
           registered AS "assignedBudgetArm", 'run' AS "firstSeenRunId" FROM known WHERE is_new
""")
def registry_new_subjects(spark: SparkSession, folder: str) -> DataFrame:
    rows = armed_orders(spark, folder)
    known = arms.known_arms(rows, supplier_registry(spark, folder), order="o_orderkey")
    new = arms.new_subjects(known, "run", F.current_timestamp(), "test")
    return new.select(*arms.REGISTRY_KEY, "assignedBudgetArm", "firstSeenRunId")


@query("""
    WITH s AS (SELECT p_partkey, 'F' || (p_size % 7 + 1) AS form, substr(p_type, 1, 1) AS proc, p_size % 2 AS flag
               FROM part)
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, flag AS "optionalVisitFlag",
           p_partkey IS NOT NULL AS in_schedule
    FROM lineitem LEFT JOIN s ON l_partkey = p_partkey AND form = 'F' || l_linenumber
         AND proc = CASE l_returnflag WHEN 'A' THEN 'E' ELSE 'S' END
""")
def schedule_join(spark: SparkSession, folder: str) -> DataFrame:
    """Visits against the schedule; repeated schedule rows do not repeat visits."""
    visits = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        F.lit("S").alias("studyId"),
        F.col("l_partkey").alias("visitNumber"),
        F.concat(F.lit("F"), "l_linenumber").alias("formName"),
        F.when(F.col("l_returnflag") == "A", "E").otherwise("S").alias("procedureName"),
    )
    twice = F.explode(F.array(F.col("p_size") % 2, F.col("p_size") % 2 + 1))
    schedule = table(spark, folder, "part").select(
        F.lit("S").alias("studyId"),
        F.col("p_partkey").alias("visitNumber"),
        F.concat(F.lit("F"), F.col("p_size") % 7 + 1).alias("formName"),
        F.substring("p_type", 1, 1).alias("procedureName"),
        twice.alias("optionalVisitFlag"),
    )
    joined = arms.join_schedule(visits, schedule, row_id=["l_orderkey", "l_linenumber", "l_quantity"])
    return joined.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "optionalVisitFlag", "in_schedule")


_TIMED = ["l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_TIMED_SQL = ", ".join(_TIMED)


def timed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as measurements of an order's procedures; some have a time after dose."""
    rest = [c for c in _TIMED if c not in ("l_orderkey", "l_returnflag")]
    time = F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("timePostDose")
    rows = table(spark, folder, "lineitem").select(*_TIMED, "l_shipdate", time)
    return rows.withColumn("ordinal", F.struct(*rest))


_PROCEDURE = ["l_orderkey", "l_returnflag"]


@query(f"SELECT {_TIMED_SQL} FROM lineitem")
def pay_per_timepoint(spark: SparkSession, folder: str) -> DataFrame:
    rows = arms.apply_pay_mode(timed_items(spark, folder), "PER_TIMEPOINT", order="ordinal", key=_PROCEDURE)
    return rows.select(*_TIMED)


@query(f"SELECT {_TIMED_SQL} FROM lineitem WHERE l_linestatus <> 'O'")
def pay_ignore(spark: SparkSession, folder: str) -> DataFrame:
    rows = arms.apply_pay_mode(timed_items(spark, folder), "IGNORE", order="ordinal", key=_PROCEDURE)
    return rows.select(*_TIMED)


_FIRST = """row_number() OVER (PARTITION BY l_orderkey, l_returnflag
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1"""


@query(f"SELECT {_TIMED_SQL} FROM lineitem QUALIFY {_FIRST}")
def pay_lump_sum(spark: SparkSession, folder: str) -> DataFrame:
    rows = arms.apply_pay_mode(timed_items(spark, folder), "LUMP_SUM", order="ordinal", key=_PROCEDURE)
    return rows.select(*_TIMED)


@query(f"""
    SELECT {_TIMED_SQL} FROM lineitem WHERE l_orderkey % 3 = 0 OR l_orderkey % 3 = 1 AND l_linestatus <> 'O'
    UNION ALL (SELECT {_TIMED_SQL} FROM lineitem WHERE l_orderkey % 3 = 2 QUALIFY {_FIRST})
""")
def pay_mode_by_study(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as studies, each with its own pay mode."""
    study = F.col("l_orderkey") % 3
    mode = F.when(study == 0, "PER_TIMEPOINT").when(study == 1, "IGNORE").otherwise("LUMP_SUM")
    rows = timed_items(spark, folder).withColumn("mode", mode)
    return arms.apply_pay_mode(rows, F.col("mode"), order="ordinal", key=_PROCEDURE).select(*_TIMED)


@query("""
    SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 AND role = 'user' THEN 'visitContactMode is blank.' END AS reason
    FROM conversations
""")
def contact_mode(spark: SparkSession, folder: str) -> DataFrame:
    contact = F.when(F.col("role") == "user", " ").otherwise(F.col("role"))
    reason = arms.contact_reason(F.col("conv_id") % 2 == 0, contact)
    return table(spark, folder, "conversations").select("conv_id", "turn", reason.alias("reason"))


ORDER_CHECKS = [
    Rule("E1", "cohort", "NOT_EQUALS", "5-LOW", "priority is low"),
    Rule("E2", "price", "GREATER_THAN", "50000", "price too low", kind="BLOCKING"),
]


@query("""
    WITH v AS (SELECT o_orderkey, o_custkey, o_orderstatus AS st, o_orderpriority AS pr, c_mktsegment AS seg,
                      CASE c_mktsegment WHEN 'BUILDING' THEN 'arm B' WHEN 'MACHINERY' THEN 'arm M' END AS mapped,
                      c_nationkey % 3 AS study,
                      concat_ws('; ', CASE WHEN o_orderpriority = '5-LOW' THEN 'priority is low' END,
                                CASE WHEN NOT o_totalprice > 50000 THEN 'price too low' END,
                                CASE WHEN c_nationkey % 3 = 2 AND o_orderstatus = 'O'
                                     THEN 'visitContactMode is blank.' END) AS reasons
               FROM orders JOIN customer ON o_custkey = c_custkey),
    a AS (SELECT *, CASE study WHEN 0 THEN 'FLAT' WHEN 1 THEN mapped ELSE pr END AS arm,
                 study = 1 AND st = 'P' AS skipped FROM v),
    f AS (SELECT o_custkey, arg_min(arm, o_orderkey) AS registered FROM a
          WHERE NOT skipped AND reasons = '' AND arm IS NOT NULL GROUP BY 1)
    SELECT o_orderkey, arm, reasons,
           CASE WHEN skipped THEN 'SKIPPED' WHEN reasons <> '' THEN 'FAILED_ELIGIBILITY'
                WHEN arm IS NULL THEN 'FAILED_STRATA' WHEN arm <> registered THEN 'FAILED_IMMUTABILITY'
                ELSE 'VALID' END AS status
    FROM a LEFT JOIN f USING (o_custkey)
""")
def row_status(spark: SparkSession, folder: str) -> DataFrame:
    """All stages for orders as visits of three studies with different settings."""
    visits, configs, groups = visits_to_check(spark, folder)
    registry = spark.createDataFrame([], S.SUBJECT_REGISTRY)
    checked = validate.validate(
        visits, configs, ORDER_CHECKS, registry, order="o_orderkey", row_id=_VISIT, groups=groups
    )
    reasons = F.array_join("reasons", "; ").alias("reasons")
    return checked.rows.select("o_orderkey", "arm", reasons, "status")


@query(f"""
    WITH v AS ({ORACLES["row_status"]})
    SELECT status, status = 'VALID' AS is_valid, arm, count(*) AS rows, sum(o_orderkey)::BIGINT AS ids FROM v GROUP BY ALL
""")
def validation_job(spark: SparkSession, folder: str) -> DataFrame:
    """The written split of a validation that ran twice: the registry of the first run changes nothing."""
    visits, configs, groups = visits_to_check(spark, folder)
    # Both runs read these several times.
    visits, groups = cut_lineage(visits), cut_lineage(groups)
    output = new_folder(spark, "validation")
    for run in ("first", "second"):
        validate.validate_run(
            spark, visits, configs, ORDER_CHECKS, output, run, order="o_orderkey", row_id=_VISIT, groups=groups
        )
    rows = spark.read.parquet(f"{output}/{validate.ROWS}").where("run_id = 'second'")
    is_valid = F.col("is_valid").cast("boolean").alias("is_valid")
    return rows.groupBy("status", is_valid, "arm").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("ids"))


@query(f"""
    WITH v AS ({ORACLES["row_status"]}),
    s AS (SELECT o_orderkey, 'S' || (c_nationkey % 3) AS study FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT study AS "studyId", count(*) AS "totalRows", count(*) FILTER (status = 'VALID') AS "validRows",
           count(*) FILTER (status = 'SKIPPED') AS "skippedRows" FROM v JOIN s USING (o_orderkey) GROUP BY 1
""")
def validation_log(spark: SparkSession, folder: str) -> DataFrame:
    """The counts that a validation writes per study."""
    visits, configs, groups = visits_to_check(spark, folder)
    output = new_folder(spark, "validation")
    validate.validate_run(
        spark, visits, configs, ORDER_CHECKS, output, "run", order="o_orderkey", row_id=_VISIT, groups=groups
    )
    log = validate.published(spark, output, validate.LOG_TABLE)
    return log.select("studyId", "totalRows", "validRows", "skippedRows")


@query(f"""
    WITH v AS ({ORACLES["row_status"]}),
    s AS (SELECT o_orderkey, o_custkey, 'S' || (c_nationkey % 3) AS study FROM orders JOIN customer ON o_custkey = c_custkey),
    subjects AS (SELECT study, count(DISTINCT o_custkey) AS subjects FROM v JOIN s USING (o_orderkey)
                 WHERE status IN ('VALID', 'FAILED_IMMUTABILITY') GROUP BY 1)
    SELECT study AS "studyId", count(*) AS rows, count(*) AS logged, any_value(subjects) AS subjects
    FROM v JOIN s USING (o_orderkey) JOIN subjects USING (study) GROUP BY 1
""")
def repeated_run(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, logged rows and registered subjects per study after one run id was validated three times, the first time in vain."""
    visits, configs, groups = visits_to_check(spark, folder)
    output = new_folder(spark, "validation")
    checks = {"order": "o_orderkey", "row_id": _VISIT, "groups": groups}
    try:
        # The registry is the second table to be written: without this name its rows cannot be told whose they are.
        validate.validate_run(spark, visits, configs, ORDER_CHECKS, output, "run", created_by=F.raise_error(F.lit("interrupted")), **checks)
    except Exception as error:
        if "interrupted" not in str(error):
            raise
    for _ in range(2):
        validate.validate_run(spark, visits, configs, ORDER_CHECKS, output, "run", **checks)
    rows = spark.read.parquet(f"{output}/{validate.ROWS}").groupBy("studyId").agg(F.count("*").alias("rows"))
    log = validate.published(spark, output, validate.LOG_TABLE).groupBy("studyId").agg(F.sum("totalRows").alias("logged"))
    seen = validate.published(spark, output, validate.REGISTRY).groupBy("studyId").agg(F.count("*").alias("subjects"))
    return rows.join(log, "studyId").join(seen, "studyId")


def visits_to_check(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as visits, the configs of their three studies, and the groups of their subjects."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("S"), F.col("c_nationkey") % 3).alias("studyId")
    )
    orders = table(spark, folder, "orders")
    visits = skew.lookup_join(orders, customers, ["o_custkey"], how="inner", row_id=_VISIT).select(
        "o_orderkey",
        "studyId",
        F.col("o_custkey").cast("string").alias("subjectId"),
        F.lit("1").alias("studySiteNumber"),
        F.col("o_orderstatus").alias("subjectStatus"),
        F.col("o_orderpriority").alias("cohort"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "O", "phone").alias("visitContactMode"),
    )
    configs = spark.createDataFrame(
        [
            ("S0", "FLAT_RATE", None, None, None, None, None, False),
            ("S1", "IMPALA_GROUP_MAP_TO_ARM", None, "F, O", None, "cohort", _ARM_MAP, False),
            ("S2", "EDC_ONLY", "cohort", None, "X", None, None, True),
        ],
        "studyId string, armResolutionMode string, edcArmColumn string, payableSubjectStatuses string, "
        "nonPayableSubjectStatuses string, impalaArmColumn string, strataToArmMapping string, "
        "hasVisitContactMode boolean",
    )
    groups = customer_groups(spark, folder).drop("studyId").join(
        customers.select(F.col("o_custkey").cast("string").alias("subjectId"), "studyId"), "subjectId"
    )
    return visits, configs, groups


@query("""
    SELECT 'one' AS "studyId", cast(o_orderkey AS varchar) AS "subjectId", o_orderstatus AS "subjectStatus",
           o_orderpriority AS cohort, '' AS strata, '' AS "formName" FROM orders
    UNION ALL
    SELECT 'two', cast(c_custkey AS varchar), '', c_mktsegment, '', replace(c_name, '#', ', "') FROM customer
""")
def landing_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers written as delimited files of two studies, ingested and read back."""
    place = new_folder(spark, "landing")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Subject_Id "),
        F.col("o_orderstatus").alias("subj_status"),
        F.col("o_orderpriority").alias("COHORT"),
        F.lit("one").alias("STUDY_ID"),
    )
    customers = table(spark, folder, "customer").select(
        F.lit("two").alias("STUDY_ID"),
        F.col("c_mktsegment").alias("cohort"),
        F.col("c_custkey").alias("SUBJECT_ID"),
        F.replace("c_name", F.lit("#"), F.lit(', "')).alias("FORM"),
        F.lit(1).alias("UNKNOWN"),
    )
    orders.write.csv(f"{place}/in/one", sep="|", header=True, escape='"')
    customers.write.csv(f"{place}/in/two", sep=",", header=True, escape='"')
    mappings = spark.createDataFrame(
        [(1, S.MISC, "SUBJ_STATUS", "subjectStatus", True), (2, S.MISC, "FORM", "formName", True)],
        "id int, type string, sourceColumn string, targetColumn string, isActive boolean",
    )
    settings = ingest.Settings(landing=f"{place}/in", output=f"{place}/out", tenant="demo")
    runs = ingest.ingest(spark, ["one", "two"], settings, mappings=mappings, mode="SFTP_ONLY")
    failed = [r["failureReason"] for r in runs if r["ingestionStatus"] != "INGESTED"]
    if failed:
        raise RuntimeError(f"Ingest failed: {failed}")
    rows = tables.read_runs(spark, settings.output)
    return rows.select("studyId", "subjectId", "subjectStatus", "cohort", "strata", "formName")


@query("""
    SELECT o_orderstatus AS status, count(*) AS rows FROM orders GROUP BY 1
""")
def landed_by_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed in one folder per status; listing, index and rows come from the files alone."""
    place = new_folder(spark, "landing")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").csv(place, header=True)
    landed = orders.select(F.concat(F.lit("o_orderstatus="), "o_orderstatus").alias("name")).distinct().collect()
    index = cut_lineage(landing.index_files(spark, place, [*sorted(r.name for r in landed), "missing"]))
    rows = landing.read_files(spark, landing.file_groups(index.where("has_rows")))
    files = index.select("source_path", F.substring_index("study_id", "=", -1).alias("status"))
    row_id = ["source_path", "source_block", "source_row"]
    found = skew.lookup_join(rows, files, ["source_path"], how="inner", row_id=row_id)
    return found.groupBy("status").agg(F.count("*").alias("rows"))
