"""Mixing of sources to target weights, with DataFrame functions only.

Tokens are counted per cell of source, language and topic. Iterative proportional fitting weighs the
cells, margin by margin, until they have the target share of every source, language and topic at once, up to a
stated tolerance. Documents are then sampled with the probability of their cell.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import query, table
from visitmill.session import cut_lineage

MARGINS = ("source", "lang", "topic")
# Without targets of its own, a margin's target shares are its token shares to this power, made to add up to 1.
TEMPERATURE = 0.95
# Sweeps at most, and the error of a margin, as a share of all tokens, from which on the fitting is done.
SWEEPS, TOLERANCE, SEED = 100, 1e-6, 17
# The mixture of the query: half of the tokens of sources evened out by the root, and these shares of languages and topics.
QUERY_SHARE, QUERY_TEMPERATURE = 0.5, 0.5
QUERY_TARGETS = {
    "lang": {"en": 0.50, "de": 0.20, "fr": 0.18, "es": 0.12},
    "topic": {"prose": 0.90, "symbols": 0.08, "numbers": 0.015, "capitals": 0.005},
}
# Fixed value: digits of the digest that make the number of a document, and the power of two they reach.
DIGITS, REACH = 12, float(1 << 48)


# Forms that the counts look for.
BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
DIGIT, SIGN, CAPITAL = "[0-9]", r"[#$%&*+/<=>@\[\]^_{|}~!?]", "[A-Z]"


def counted(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``n`` (runs of characters that are no blanks) and ``topic``, each count made once.

    The topic is a coarse one by the kinds of characters: numbers, signs, capitals or prose; shares are of
    all characters but blanks, and the first that holds counts. Text without any is ``none``.
    """
    whole = F.coalesce(text, F.lit(""))
    counts = {"_blank": BLANK, "n": WORD, "_digits": DIGIT, "_signs": SIGN, "_capitals": CAPITAL}
    found = docs.select("*", F.length(whole).alias("_chars"), *[F.regexp_count(whole, F.lit(f)).alias(c) for c, f in counts.items()])
    size = F.col("_chars") - F.col("_blank")
    topic = (
        F.when(size == 0, "none")
        .when(F.col("_digits") * 20 >= size, "numbers")
        .when(F.col("_signs") * 20 >= size, "symbols")
        .when(F.col("_capitals") * 4 >= size, "capitals")
        .otherwise("prose")
    )
    own = found.withColumns({"topic": topic, "n": F.col("n").cast("long")})
    return own.drop("_chars", "_blank", "_digits", "_signs", "_capitals")


def tempered(cells: DataFrame, margin: str, temperature: float) -> DataFrame:
    """(margin, target): shares of the tokens to the power of ``temperature``."""
    sums = cells.groupBy(margin).agg(F.sum("n").alias("n")).withColumn("power", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    total = sums.agg(F.sum("power")).first()[0]
    return sums.select(margin, (F.col("power") / F.lit(total)).alias("target"))


def _given(cells: DataFrame, margin: str, wanted: Mapping[str, float]) -> DataFrame:
    """(margin, target) from a table of shares; values that no document has are left out, others get 0."""
    pairs = [F.lit(x) for value, share in wanted.items() for x in (value, float(share))]
    share = F.coalesce(F.create_map(*pairs)[F.col(margin)], F.lit(0.0)) if pairs else F.lit(0.0)
    found = cells.select(margin).distinct().withColumn("power", share)
    total = found.agg(F.sum("power")).first()[0]
    return found.select(margin, F.try_divide("power", F.lit(total)).alias("target"))


def reachable(cells: DataFrame, margin: str, targets: DataFrame, budget: float) -> DataFrame:
    """(margin, goal, whole): tokens of each value that make up ``budget`` in the shares of ``targets``.

    A value that has no more tokens than its share asks for is kept whole, and the others share what it lacks.
    """
    sums = cells.groupBy(margin).agg(F.sum("n").cast("double").alias("has"))
    values, scale = cut_lineage(targets.join(sums, margin)), budget
    while True:
        full = F.col("has") <= F.lit(scale) * F.col("target")
        taken, rest = values.agg(F.sum(F.when(full, F.col("has"))), F.sum(F.when(~full, F.col("target")))).first()
        after = (budget - (taken or 0.0)) / rest if rest else 1e300
        if after <= scale * (1 + 1e-12):
            return cut_lineage(values.select(margin, F.least("has", F.lit(scale) * F.col("target")).alias("goal"), full.alias("whole")))
        scale = after


def rake(
    cells: DataFrame, margins: Sequence[str], goals: Mapping[str, DataFrame], *, start: float, capped: bool, sweeps: int, tolerance: float
) -> tuple[DataFrame, float]:
    """``cells`` with weight ``x``, and the largest margin error left, as a share of all tokens.

    Iterative proportional fitting: each step multiplies the cells of a margin value so that its weighted tokens
    meet its goal; sweeps go on until all margins are met up to ``tolerance``. If ``capped``, no cell
    weighs more than 1, steps fit what the cells below 1 have to give, and cells of a ``whole`` value weigh 1. Sums are reduced per
    task before the shuffle; each sweep is written once, so that plans do not grow with the sweeps.
    """
    small = {m: skew.fits_broadcast(goals[m]) for m in margins}
    state = cells.withColumn("whole", F.lit(False))
    for m in margins:
        named = goals[m].select(m, F.col("goal").alias(f"goal_{m}"), F.col("whole").alias("_whole"))
        state = skew.lookup_join(state, named, [m], row_id=list(margins), small=small[m], how="inner")
        state = state.withColumn("whole", F.col("whole") | F.col("_whole")).drop("_whole")
    whole = F.col("whole") if capped else F.lit(False)
    state = cut_lineage(state.withColumn("x", F.when(whole, 1.0).otherwise(F.lit(start))))
    total, error = state.agg(F.sum("n").cast("double")).first()[0], 0.0
    for _ in range(sweeps if total else 0):
        now = state.withColumn("off", F.lit(0.0))
        for m in margins:
            weight = F.least(F.lit(1.0), F.col("x")) if capped else F.col("x")
            over = F.when(F.col("x") >= 1, F.col("n")).otherwise(0) if capped else F.lit(0)
            sums = now.groupBy(m).agg(F.sum(F.col("n") * weight).alias("_now"), F.sum(over).cast("double").alias("_over"))
            now = skew.lookup_join(now, sums, [m], row_id=list(margins), small=small[m], how="inner")
            goal, free = F.col(f"goal_{m}"), F.col("_now") - F.col("_over")
            ratio = F.when((goal > F.col("_over")) & (free > 0), (goal - F.col("_over")) / free).otherwise(F.coalesce(F.try_divide(goal, "_now"), F.lit(0.0)))
            off = F.greatest("off", F.abs(F.col("_now") - goal) / F.lit(total))
            now = now.withColumns({"x": F.when(whole, 1.0).otherwise(F.col("x") * ratio), "off": off}).drop("_now", "_over")
        state = cut_lineage(now)
        error = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        if error < tolerance:
            break
    return state, error


def mix(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    language_column: str = "lang",
    topic_column: str | None = None,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    temperature: float = TEMPERATURE,
    sweeps: int = SWEEPS,
    tolerance: float = TOLERANCE,
    seed: int = SEED,
    kept_share: float | None = None,
) -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_topic``, ``mix_probability`` and ``mix_kept``.

    ``targets`` maps ``source``, ``lang`` or ``topic`` to shares by value; a margin without any gets its
    token shares to the power of ``temperature``. Without ``topic_column`` the topic is
    :func:`counted`'s topic. The fitting sweeps until every margin is met up to ``tolerance`` of all tokens; if that takes more than
    ``sweeps``, as where targets exclude each other, a warning tells the error left. A null margin value counts as the empty string. The probability of a document is the
    product of the factors of its three values, divided by the largest such product of all cells: the
    cell with the greatest need is kept whole, and the kept tokens have the target shares in
    expectation. With ``kept_share`` (up to 1) the products are scaled so that this share of the tokens is
    kept instead, and values or cells that need more than they have are kept whole (:func:`reachable`, :func:`rake`). Documents without tokens weigh nothing in the margins and get their cell's probability,
    or 0 where the cell has no tokens at all. The draw is a digest of seed, id and text, so it is the
    same in every run, and the same for rows repeated whole. Other columns stay; columns called like
    those added are replaced. An empty table gives no rows.
    """
    added = {"mix_tokens", "mix_topic", "mix_probability", "mix_kept"}
    kept = [c for c in docs.columns if c not in added]
    text = F.col(f"`{text_column}`")
    told = F.concat_ws(":", F.lit(str(seed)), F.col(f"`{id_column}`").cast("string"), text)
    drawn = F.conv(F.substring(F.md5(told.cast("binary")), 1, DIGITS), 16, 10).cast("double") / REACH
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(f"`{language_column}`").cast("string"), F.lit("")).alias("lang"),
        text.alias("text"), drawn.alias("drawn"),
        *([] if topic_column is None else [F.coalesce(F.col(f"`{topic_column}`").cast("string"), F.lit("")).alias("given")]),
    )
    marked = counted(row, F.col("text")).drop("text")
    if topic_column is not None:
        marked = marked.withColumn("topic", F.col("given")).drop("given")
    # Texts are read and counted once; what follows reads the few columns it needs.
    inner = cut_lineage(marked)
    cells = cut_lineage(inner.groupBy(*MARGINS).agg(F.sum("n").alias("n")).where("n > 0"))
    wanted = targets or {}
    shares = {
        m: cut_lineage(_given(cells, m, wanted[m]) if m in wanted else tempered(cells, m, temperature)) for m in MARGINS
    }
    size = cells.agg(F.sum("n").cast("double")).first()[0] or 0.0
    capped = kept_share is not None
    if wanted:
        # A cell with a target of 0 is out, so the other targets are sought without it.
        for m in MARGINS:
            cells = skew.lookup_join(cells, shares[m].where("target > 0").select(m), [m], row_id=list(MARGINS), how="inner")
        cells = cut_lineage(cells)
    if capped:
        goals = {m: reachable(cells, m, shares[m], kept_share * size) for m in MARGINS}
    else:
        whole = F.lit(False).alias("whole")
        goals = {m: shares[m].select(m, (F.col("target") * F.lit(size)).alias("goal"), whole) for m in MARGINS}
    raked, error = rake(
        cells, MARGINS, goals, start=kept_share if capped else 1.0, capped=capped, sweeps=sweeps, tolerance=tolerance
    )
    if error >= tolerance:
        warnings.warn(f"Mixture targets are met up to {error:.2g} of all tokens after {sweeps} sweeps.", stacklevel=2)
    # What the fitting leaves is read several times, and the plan of the rows should not hold it.
    most = 1.0 if capped else raked.agg(F.max("x")).first()[0]
    chance = F.least(F.lit(1.0), F.col("x")) if capped else F.coalesce(F.try_divide("x", F.lit(most)), F.lit(0.0))
    named = raked.select(*MARGINS, chance.alias("chance"))
    joined = skew.lookup_join(
        inner, named, list(MARGINS), keys_from=inner.select(*MARGINS), row_id=["drawn", "n"]
    )
    chance = F.coalesce("chance", F.lit(0.0))
    return joined.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        F.col("n").alias("mix_tokens"),
        F.col("topic").alias("mix_topic"),
        chance.alias("mix_probability"),
        (F.col("drawn") < chance).alias("mix_kept"),
    )


def _oracle() -> str:
    """The same fitting; a recursion makes a sweep per step."""
    given = {m: ", ".join(f"('{v}', {x})" for v, x in QUERY_TARGETS[m].items()) for m in QUERY_TARGETS}
    shares = [
        f"shares_{m} AS (SELECT {m}, sum(n) AS has, "
        + (f"coalesce(any_value(x.share), 0) AS power FROM cells LEFT JOIN (VALUES {given[m]}) x(v, share) ON v = {m}" if m in given else f"pow(sum(n), {QUERY_TEMPERATURE}) AS power FROM cells")
        + f" GROUP BY {m}), targets_{m} AS (SELECT {m}, has, power / sum(power) OVER () AS target FROM shares_{m}), "
        f"filled_{m} AS (SELECT *, sum(has) OVER w AS has_before, sum(target) OVER w AS target_before FROM targets_{m} "
        f"WINDOW w AS (ORDER BY coalesce(has / nullif(target, 0), 'Infinity'::DOUBLE), {m} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
        f"flags_{m} AS (SELECT *, has <= (budget - coalesce(has_before, 0)) / nullif(1 - coalesce(target_before, 0), 0) * target AS whole FROM filled_{m}, size), "
        f"goals_{m} AS MATERIALIZED (SELECT {m}, whole, CASE WHEN whole THEN has ELSE least(has, target * (budget - coalesce(sum(has) FILTER (whole) OVER (), 0)) "
        f"/ nullif(sum(target) FILTER (NOT whole) OVER (), 0)) END AS goal FROM flags_{m})"
        for m in MARGINS
    ]
    sweep = "SELECT *, 0::DOUBLE AS off_now FROM fit WHERE step < " + str(SWEEPS) + f" AND (step = 0 OR off >= {TOLERANCE})"
    for m in MARGINS:
        sums = f"SELECT *, sum(n * least(1, x)) OVER (PARTITION BY {m}) AS now, sum(CASE WHEN x >= 1 THEN n ELSE 0 END) OVER (PARTITION BY {m}) AS over_ FROM ({sweep})"
        sweep = (
            f"SELECT step, source, lang, topic, n, goal_source, goal_lang, goal_topic, whole, total, off, greatest(off_now, abs(now - goal_{m}) / total) AS off_now, "
            f"CASE WHEN whole THEN 1 WHEN goal_{m} > over_ AND now - over_ > 0 THEN x * (goal_{m} - over_) / (now - over_) "
            f"ELSE x * coalesce(goal_{m} / nullif(now, 0), 0) END AS x FROM ({sums})"
        )
    return rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, text, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents
    ), k AS (
        SELECT doc_id, text, source, lang, n, length(bare) AS size,
               length(bare) - length(regexp_replace(bare, '[0-9]', '', 'g')) AS digits,
               length(bare) - length(regexp_replace(bare, '[#$%&*+/<=>@\[\]^_{{|}}~!?]', '', 'g')) AS signs,
               length(bare) - length(regexp_replace(bare, '[A-Z]', '', 'g')) AS capitals FROM d
    ), t AS MATERIALIZED (
        SELECT doc_id, text, source, lang, n,
               CASE WHEN size = 0 THEN 'none' WHEN digits * 20 >= size THEN 'numbers' WHEN signs * 20 >= size THEN 'symbols'
                    WHEN capitals * 4 >= size THEN 'capitals' ELSE 'prose' END AS topic FROM k
    ), cells AS MATERIALIZED (
        SELECT source, lang, topic, sum(n)::DOUBLE AS n FROM t GROUP BY ALL HAVING sum(n) > 0
    ), size AS MATERIALIZED (SELECT sum(n) AS total, {QUERY_SHARE} * sum(n) AS budget FROM cells),
    {", ".join(shares)},
    fit AS (
        SELECT 0 AS step, source, lang, topic, n, s.goal AS goal_source, l.goal AS goal_lang, p.goal AS goal_topic,
               s.whole OR l.whole OR p.whole AS whole, total, 1::DOUBLE AS off,
               CASE WHEN s.whole OR l.whole OR p.whole THEN 1::DOUBLE ELSE {QUERY_SHARE} END AS x
        FROM cells JOIN goals_source s USING (source) JOIN goals_lang l USING (lang) JOIN goals_topic p USING (topic), size
        UNION ALL
        SELECT step + 1, source, lang, topic, n, goal_source, goal_lang, goal_topic, whole, total, max(off_now) OVER () AS off, x FROM ({sweep})
    ), named AS MATERIALIZED (
        SELECT source, lang, topic, least(1, x) AS chance FROM fit WHERE step = (SELECT max(step) FROM fit)
    )
    SELECT doc_id, source, lang, topic, n AS n_tokens, round(coalesce(chance, 0), 6) AS probability,
           ('0x' || substr(md5(concat_ws(':', '{SEED}', doc_id::VARCHAR, text)), 1, {DIGITS}))::UBIGINT / {REACH} < coalesce(chance, 0) AS kept
    FROM t LEFT JOIN named USING (source, lang, topic)
    """


@query(_oracle())
def op3_mixing(spark, folder):
    """Every document with its margins, tokens and probability, and whether the mixture keeps it."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    mixed = mix(docs, targets=QUERY_TARGETS, temperature=QUERY_TEMPERATURE, kept_share=QUERY_SHARE)
    return mixed.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
        F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_probability", 6).alias("probability"), F.col("mix_kept").alias("kept"),
    )
