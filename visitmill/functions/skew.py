"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup up to this many rows and characters may be sent to every executor.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with at least this share of the rows is hot; so there are at most 1 / share hot keys.
HOT_SHARE = 0.005
# Parts that the rows of hot keys are spread over, if the session has fewer shuffle partitions.
MIN_SALTS = 64
# Rows per range when a group is numbered by ranges.
RANGE_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and ``size`` characters as JSON.

    Reads on only until one row more is found; only the lengths of the rows reach the driver.
    """
    length = F.length(F.to_json(F.struct(*df.columns)))
    found = df.select(F.coalesce(length, F.lit(0)).alias("n")).take(rows + 1)
    return len(found) <= rows and sum(r.n for r in found) <= size


def hot_key_hashes(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows.

    One pass over the key columns with a sketch of fixed size. The sketch may name a key too many or
    count a little off; that only changes which rows get salted, never the result.
    """
    bound = int(1 / share)
    hashed = df.select(F.xxhash64(*keys).alias("_h"))
    row = hashed.agg(
        F.expr(f"approx_top_k(_h, {bound}, {bound * 20})").alias("top"), F.count("*").alias("n")
    ).first()
    return [item["item"] for item in row["top"] or [] if item["count"] >= row["n"] * share]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    *,
    row_id: Sequence[str] | None = None,
    sized_by: DataFrame | None = None,
    small: bool | None = None,
    keys_from: DataFrame | None = None,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Join (left or inner) to a lookup with one row per key.

    A lookup of checked small size is broadcast. A larger one is joined by shuffle, where the rows of
    hot keys are spread over ``salts`` parts (by default, as many as there are shuffle partitions) and
    only the lookup rows of those keys are repeated.

    ``sized_by`` has at least the rows and values of the lookup and is cheaper to read, such as the scan
    it is made from; ``small`` is the answer where it is known already. ``row_id`` and ``keys_from`` are as for :func:`salted_join`.
    """
    if small is None:
        small = fits_broadcast(lookup if sized_by is None else sized_by, broadcast_rows)
    if small:
        return rows.join(F.broadcast(lookup), list(on), how)
    return salted_join(rows, lookup, on, row_id=row_id, keys_from=keys_from, how=how, salts=salts)


def _has_no_hash(field: T.StructField) -> bool:
    """Spark hashes neither variants nor maps."""
    return any(kind in field.dataType.simpleString() for kind in ("variant", "map<"))


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    *,
    row_id: Sequence[str] | None = None,
    keys_from: DataFrame | None = None,
    how: str = "left",
    salts: int | None = None,
) -> DataFrame:
    """Join by shuffle; rows of hot keys are spread, their lookup rows repeated.

    ``row_id`` names columns that tell rows apart, so that a row gets the same salt in every attempt; by
    default all that can be hashed.
    ``keys_from`` holds the same keys as ``rows`` but is cheaper to read, such as the scan below it.
    """
    on = list(on)
    hot = hot_key_hashes(rows if keys_from is None else keys_from, on)
    if not hot:
        return rows.join(lookup, on, how)
    key_is_hot = F.xxhash64(*on).isin(hot)
    if salts is None:
        salts = max(MIN_SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    told_apart_by = row_id or [f.name for f in rows.schema if not _has_no_hash(f)]
    spread = F.pmod(F.xxhash64(*told_apart_by), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    left = rows.withColumn("_salt", F.when(key_is_hot, spread).otherwise(0))
    right = lookup.withColumn(
        "_salt", F.explode(F.when(key_is_hot, every).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def range_cuts(df: DataFrame, order: str, rows: int | None = None, per_range: int | None = None) -> list[int]:
    """Values of an integer column that cut the rows into ranges of about ``per_range`` rows.

    Quantiles from a sketch, so outliers do not move rows together; none if one range is enough.
    """
    rows = df.agg(F.count(order)).first()[0] if rows is None else rows
    parts = -(-rows // (per_range or RANGE_ROWS))
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(order, shares, max(10_000, 20 * parts))).first()[0] or []
    return sorted(set(found))


def range_number(order: Column, cuts: Sequence[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``order``, by a search that halves the list."""
    if not cuts:
        return F.lit(0)
    listed = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]

    def further(found: Column, step: Column) -> Column:
        return F.when(F.get(listed, found + step - 1) <= order, found + step).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def bucketed_sum_before(
    df: DataFrame, group: Sequence[str], order: str, flag: Column, name: str, cuts: Sequence[int] | None = None
) -> DataFrame:
    """Add how many flagged rows of the group come before each row, by a non-null integer ``order``.

    A plain window would sort a hot group in one task. Here each group is cut into ranges of ``order``;
    windows run within a range, and the totals of earlier ranges are added. There is one range per
    million rows, so both the windows and the list of ranges stay small; one shuffle moves the rows. A
    null in ``group`` is a group of its own.
    """
    group = list(group)
    cuts = range_cuts(df, order) if cuts is None else cuts
    cut = df.withColumn("_range", range_number(F.col(order), cuts)).withColumn("_flag", flag.cast("long"))
    within = Window.partitionBy(*group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum("_flag").over(within), F.lit(0)))
    if not cuts:
        return local.withColumn(name, F.col("_local")).drop("_range", "_flag", "_local")
    ranges = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(ranges), F.lit(0))
    offsets = (
        cut.groupBy(*group, "_range")
        .agg(F.sum("_flag").alias("_n"))
        .select(*[F.col(g).alias(f"_group_{i}") for i, g in enumerate(group)], F.col("_range").alias("_at"), before.alias("_offset"))
    )
    same = F.col("_range") == F.col("_at")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_group_{i}"))
    return (
        local.join(offsets, same)
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_range", "_flag", "_local", "_offset", "_at", *[f"_group_{i}" for i in range(len(group))])
    )


def bucketed_ordinal(
    df: DataFrame, group: Sequence[str], order: str, name: str, cuts: Sequence[int] | None = None
) -> DataFrame:
    """Number the rows of each group from 0 by a unique integer ``order``."""
    return bucketed_sum_before(df, group, order, F.lit(1), name, cuts)
