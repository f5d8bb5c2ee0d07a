"""Landed JSON pages: row arrays, page cut-off, flattening, presence of columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmill import schema as S
from visitmill.functions import skew

# Places of the row array in a page, in the order they are tried.
ROW_PATHS = [
    "$",
    "$.content", "$.data", "$.subjectVisits", "$.items", "$.records", "$.results",
    "$._embedded.subjectVisits", "$._embedded.content", "$._embedded.data",
    "$.page.content", "$.page.data",
]


def page_rows(payload: Column) -> Column:
    """Row array of a parsed page; empty if there is none. A place counts only if it holds a list."""
    found = [F.try_variant_get(payload, path, "array<variant>") for path in ROW_PATHS]
    return F.coalesce(*found, F.array().cast("array<variant>"))


def _kind(payload: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(payload, path, "variant"))


def _whole_number(payload: Column, path: str) -> Column:
    """The value if it is a JSON integer; true and false count as 1 and 0."""
    kind = _kind(payload, path)
    flag = F.try_variant_get(payload, path, "boolean").cast("long")
    number = F.try_variant_get(payload, path, "bigint")
    return F.when(kind == "BOOLEAN", flag).when(kind == "BIGINT", number)


def has_more(payload: Column, page: Column, row_count: Column, page_size: Column | int) -> Column:
    """Whether another page follows."""
    last = F.when(_kind(payload, "$.last") == "BOOLEAN", F.try_variant_get(payload, "$.last", "boolean"))
    total = F.coalesce(_whole_number(payload, "$.totalPages"), _whole_number(payload, "$.page.totalPages"))
    # Only a list has a first element; an empty list has no rows and ends the pull anyway.
    is_list = F.try_variant_get(payload, "$[0]", "variant").isNotNull()
    return (
        F.when(is_list, False)
        .when((row_count == 0) | (row_count < page_size), False)
        .when(last.isNotNull(), ~last)
        .when(total.isNotNull(), page < total)
        .otherwise(True)
    )


def parse_pages(pages: DataFrame, *, body: str = "body") -> DataFrame:
    """Add ``payload`` and ``rows``. A body that is no JSON has a null ``payload`` and no rows."""
    parsed = pages.withColumn("payload", F.try_parse_json(F.col(body)))
    return parsed.withColumn("rows", page_rows(F.col("payload"))).drop(body)


def index_pages(
    parsed: DataFrame,
    pull: Sequence[str],
    *,
    page: str = "page",
    page_size: int = S.PAGE_SIZE,
    columns: Sequence[str] = (),
) -> DataFrame:
    """One small row per page: number, whether it is unusable or the last, its rows and their columns.

    Bodies are read once for it; what is asked about pulls afterwards needs no bodies.
    """
    more = has_more(F.col("payload"), F.col(page), F.size("rows"), F.lit(page_size))
    found = F.array().cast("array<string>")
    if columns:
        found = F.array_distinct(F.flatten(F.transform("rows", lambda record: record_columns(record, columns))))
    return parsed.select(
        *pull,
        F.col(page).alias("page"),
        F.col("payload").isNull().alias("bad"),
        (F.col("payload").isNotNull() & ~more).alias("ends"),
        F.size("rows").alias("row_count"),
        found.alias("columns"),
    )


def pull_extent(index: DataFrame, pull: Sequence[str]) -> DataFrame:
    """Per pull: its last page, whether it failed, and its ``problem``, null if it did not fail.

    A pull ends with the first page that says so. It fails if a page up to there cannot be parsed
    (``unreadable page``), if no page ends it (``no last page``), or if the pages from 1 to its end have
    a gap (``missing page``): then the next request is not known to have succeeded.
    """
    ends = index.groupBy(*pull).agg(
        F.min(F.when(F.col("ends"), F.col("page"))).alias("_end"),
        F.min(F.when(F.col("bad"), F.col("page"))).alias("_bad"),
        F.max("page").alias("_top"),
    )
    numbers = index.select(*pull, "page").where(F.col("page") >= 1)
    placed = skew.lookup_join(numbers, ends.select(*pull, "_end"), pull, how="inner", row_id=[*pull, "page"])
    seen = placed.where(F.col("page") <= F.col("_end")).groupBy(*pull, "page").agg(F.lit(1).alias("_one"))
    counted = ends.join(seen.groupBy(*pull).agg(F.count("*").alias("_seen")), list(pull), "left")
    last = F.coalesce("_end", "_top")
    problem = (
        F.when(F.col("_bad") <= last, "unreadable page")
        .when(F.col("_end").isNull(), "no last page")
        .when(F.coalesce("_seen", F.lit(0)) < F.col("_end"), "missing page")
    )
    return counted.select(*pull, last.alias("last_page"), problem.isNotNull().alias("failed"), problem.alias("problem"))


def pull_columns(index: DataFrame, extent: DataFrame, pull: Sequence[str]) -> DataFrame:
    """Per pull that did not fail: its extent, its rows, and the columns any of its records has."""
    ended = extent.where(~F.col("failed")).select(*pull, "last_page")
    used = skew.lookup_join(index, ended, pull, how="inner", row_id=[*pull, "page"], keys_from=index.select(*pull))
    used = used.where(F.col("page") <= F.col("last_page"))
    sums = used.groupBy(*pull, "last_page").agg(F.sum("row_count").alias("row_count"))
    # Single names, so that what meets per pull is bounded by their number.
    names = used.select(*pull, F.explode("columns").alias("name")).groupBy(*pull).agg(F.collect_set("name").alias("present"))
    none = F.array().cast("array<string>")
    return sums.join(names, list(pull), "left").withColumn("present", F.coalesce("present", none))


def pages_in_pull(pages: DataFrame, extent: DataFrame, pull: Sequence[str], *, page: str = "page") -> DataFrame:
    """Pages up to the end of each pull that did not fail, with what ``extent`` knows about the pull.

    ``pages`` are best not parsed yet: then only those that stay are. A small ``extent`` is broadcast;
    otherwise the pages of hot pulls are spread.
    """
    ended = extent.where(~F.col("failed")).drop("failed", "problem") if "failed" in extent.columns else extent
    joined = skew.lookup_join(pages, ended, pull, how="inner", row_id=[*pull, page], keys_from=pages.select(*pull))
    return joined.where(F.col(page) <= F.col("last_page")).drop("last_page")


def explode_rows(pages: DataFrame, *, page: str = "page") -> DataFrame:
    """One row per record, with its position in the page.

    The outer form keeps Spark from testing the list first, for which it would parse each body again.
    """
    keep = [c for c in pages.columns if c not in ("payload", "rows")]
    rows = pages.select(*keep, F.posexplode_outer("rows").alias("position", "record"))
    return rows.where(F.col("position").isNotNull())


def record_value(record: Column, name: str) -> Column:
    """Top-level value as text; arrays as JSON text; null for nested objects, which are flattened."""
    path = f"$.{name}"
    value = F.try_variant_get(record, path, "string")
    return F.when(~_kind(record, path).startswith("OBJECT"), value)


def record_texts(record: Column, names: Sequence[str]) -> Column:
    """Values of the top-level columns ``names`` as :func:`record_value` gives them, by name."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    wanted = F.map_filter(fields, lambda name, _: name.isin(list(names)))
    text = lambda value: F.try_variant_get(value, "$", "string")
    return F.transform_values(
        wanted, lambda _, value: F.when(~F.schema_of_variant(value).startswith("OBJECT"), text(value))
    )


def record_columns(record: Column, names: Sequence[str] | None = None) -> Column:
    """Top-level columns that the record has after flattening, of ``names`` if given; an explicit null counts."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    if names is not None:
        fields = F.map_filter(fields, lambda name, _: name.isin(list(names)))
    flat = F.map_filter(fields, lambda _, value: ~F.schema_of_variant(value).startswith("OBJECT"))
    return F.coalesce(F.map_keys(flat), F.array().cast("array<string>"))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns as dotted top-level columns; arrays stay whole."""

    def leaves(fields: list[T.StructField], column: Column | None, prefix: str) -> list[Column]:
        out: list[Column] = []
        for field in fields:
            here = F.col("`" + field.name.replace("`", "``") + "`") if column is None else column.getField(field.name)
            name = f"{prefix}{sep}{field.name}" if prefix else field.name
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType.fields, here, name)
            else:
                out.append(here.alias(name))
        return out

    return df.select(*leaves(df.schema.fields, None, ""))


# A field name with its colon, or a type that has another name in a schema. Names are looked at first,
# so that they stay as they are.
_SCHEMA_PART = re.compile(r"((?:`(?:[^`]|``)*`|\w+)\s*:)|\b(OBJECT(?=<)|VOID)\b")


def struct_schema(variant_schema: str) -> str:
    """The schema of a variant as DDL; a field that is null everywhere is text."""
    types = {"OBJECT": "STRUCT", "VOID": "STRING"}
    return _SCHEMA_PART.sub(lambda m: m[1] or types[m[2]], variant_schema)


def typed_records(records: DataFrame, *, record: str = "record") -> DataFrame:
    """Records as flat typed columns. One pass finds the merged schema, one reads the values."""
    merged = records.agg(F.schema_of_variant_agg(F.col(record))).first()[0]
    typed = records.select(F.try_variant_get(record, "$", struct_schema(merged)).alias("r"))
    return flatten(typed.select("r.*"))
