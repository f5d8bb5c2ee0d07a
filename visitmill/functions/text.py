"""Column functions on names, labels and settings."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitmill import schema as S

TENANT_PATTERN = "[a-z][a-z0-9_]{0,62}"
# Characters that count as whitespace, and as line ends.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same whitespace, negated, in a form that regular expressions match fast.
_VISIBLE = r"[^\s\x1c-\x1f\x85\p{Z}]"
# Further characters that end a line, beside those that "." leaves out.
_MORE_LINE_ENDS = "\x0b\x0c\x1c\x1d\x1e"


def strip(col: Column) -> Column:
    """Cut all whitespace at both ends, not only blanks."""
    return F.btrim(col, F.lit(_SPACES))


def blank_to_null(col: Column) -> Column:
    """The stripped text, or null if nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def is_blank(col: Column) -> Column:
    """Whether the text is null or has no visible character; stops at the first one."""
    return ~F.coalesce(col.rlike(_VISIBLE), F.lit(False))


def na_to_null(col: Column) -> Column:
    """Null for the cell texts that mean "no value"."""
    return F.when(~col.isin(S.NA_TOKENS), col)


def category(label: Column) -> Column:
    """File category by name."""
    compact = F.regexp_replace(F.lower(label), "[_-]", "")
    return (
        F.when(compact.contains("subjectgrp"), S.SUBJECT_GROUP)
        .when(compact.contains("subjectvisit"), S.SUBJECT_VISIT)
        .otherwise(S.MISC)
    )


def base_name(path: Column) -> Column:
    """Last path segment; slashes and single dots at the end do not count."""
    bare = strip(path)
    ends = bare.endswith("/") | bare.endswith("/.")
    return F.substring_index(F.when(ends, F.regexp_replace(bare, r"(?:/\.?)+\z", "")).otherwise(bare), "/", -1)


def without_suffix(name: Column) -> Column:
    """Name up to its last dot, if there is something before and after that dot."""
    suffix = F.substring_index(name, ".", -1)
    before = F.length(name) - F.length(suffix) - 1
    return F.when((before > 0) & (suffix != ""), F.substring(name, F.lit(1), before)).otherwise(name)


def safe_stem(label: Column) -> Column:
    """File name without its last suffix, safe as one path segment, at most 200 characters."""
    safe = F.regexp_replace(without_suffix(base_name(label)), r"[^\w.-]+", "_")
    bare = F.btrim(safe, F.lit("._-"))
    return F.substring(F.coalesce(F.nullif(bare, F.lit("")), F.lit("part")), 1, S.STEM_LIMIT)


def numbered_stem(base: Column, number: Column) -> Column:
    """``base`` for 0, else ``base_number``, with ``base`` cut so that the whole is at most 200."""
    suffix = F.concat(F.lit("_"), number.cast("string"))
    room = F.greatest(F.lit(1), F.lit(S.STEM_LIMIT) - F.length(suffix))
    return F.when(number == 0, base).otherwise(F.concat(F.substring(base, F.lit(1), room), suffix))


def trim_slashes(col: Column) -> Column:
    return F.regexp_replace(strip(col), r"^/+|/+\z", "")


def join_path(prefix: Column, *parts: Column) -> Column:
    """Prefix and parts with single slashes; a blank prefix is left out."""
    return F.concat_ws("/", F.nullif(trim_slashes(prefix), F.lit("")), *parts)


def object_key(prefix: Column, study: Column, run: Column, label: Column) -> Column:
    """Key of one normalized object."""
    name = F.concat(safe_stem(label), F.lit(".parquet"))
    return join_path(prefix, study, F.lit("normalized"), run, name)


def delimiter(head: Column) -> Column:
    """``|`` if the first line has more pipes than commas, else ``,``."""
    line = F.regexp_extract(head, "^.*", 0)
    for end in _MORE_LINE_ENDS:
        line = F.substring_index(line, end, 1)
    pipes = F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))
    commas = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))
    return F.when(pipes > commas, "|").otherwise(",")


def sha256(col: Column) -> Column:
    return F.sha2(col, 256)


def epoch_to_timestamp(seconds: Column) -> Column:
    """UTC timestamp of epoch seconds; null if it is no number or outside years 1 to 9999."""
    value = seconds.try_cast("double")
    usable = value.between(-62135596800.0, 253402300799.999999) & ~F.isnan(value)
    return F.when(usable, F.timestamp_micros(F.round(value * 1_000_000).cast("long")))


def coerce(col: Column, allowed: list[str], default: str, *, upper: bool, swap: tuple[str, str] | None) -> Column:
    """``col`` folded to one of ``allowed``, or ``default``."""
    folded = F.upper(strip(col)) if upper else F.lower(strip(col))
    if swap:
        folded = F.replace(folded, F.lit(swap[0]), F.lit(swap[1]))
    return F.when(folded.isin(allowed), folded).otherwise(default)


def source_mode(col: Column) -> Column:
    return coerce(col, S.SOURCE_MODES, "SFTP_ONLY", upper=True, swap=None)


def environment(col: Column) -> Column:
    return coerce(col, S.ENVIRONMENTS, "local-compose", upper=False, swap=("_", "-"))


def depth(col: Column) -> Column:
    return coerce(col, S.DEPTHS, "PUBLISH", upper=True, swap=("-", "_"))


def runtime_mode(col: Column) -> Column:
    folded = F.replace(F.lower(strip(col)), F.lit("-"), F.lit("_"))
    return F.when(folded.isin("localstack_full", "full"), "localstack_full").otherwise("compose")


def resolve_mode(argument: Column, configured: Column, setting: Column) -> Column:
    """Source mode by precedence: argument, active sponsor row, setting, then ``API_ONLY``."""
    empty = F.lit("")
    return source_mode(
        F.coalesce(argument, F.nullif(configured, empty), blank_to_null(setting), F.lit("API_ONLY"))
    )


def sponsor(configured: Column, tenant: Column) -> Column:
    """Sponsor of the study row if it is not blank, else the tenant."""
    return F.coalesce(blank_to_null(configured), tenant)


def endpoint(data_source: Column, host: str | None, base_url: str | None) -> Column:
    """Where the rows came from; null if the setting is empty."""
    return F.when(data_source == "SFTP", F.lit(host or None)).otherwise(F.lit(base_url or None))


def check_study_id(study_id: str) -> str:
    text = study_id.strip()
    if not text or "/" in text or "\\" in text or ".." in text:
        raise ValueError(f"Not usable as a study id: {study_id!r}")
    return text


def check_run_id(run_id: str) -> str:
    try:
        return str(uuid.UUID(run_id.strip()))
    except ValueError as error:
        raise ValueError(f"Not a run id: {run_id!r}") from error


def check_limit(limit: int) -> int:
    if not 1 <= limit <= S.PREVIEW_MAX:
        raise ValueError(f"A preview has 1 to {S.PREVIEW_MAX} rows, not {limit}.")
    return limit


def check_tenant(name: str) -> str:
    text = name.strip()
    if not re.fullmatch(TENANT_PATTERN, text):
        raise ValueError(f"Not usable as a tenant name: {name!r}")
    return text


def valid_tenant(col: Column) -> Column:
    return col.rlike(rf"^{TENANT_PATTERN}\z")
