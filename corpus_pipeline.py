"""Corpus pipeline: language, repeated lines, near duplicates, mixture, tokens.

Each stage takes the documents that the one before it left, writes Parquet, and the next one reads that.
All stages but the last return the columns of the documents table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm import bpe, language, line_dedup, mixing, near_dup
from visitmill.llm.common import held_out, table
from visitmill.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# How far the best language of a document must be above chance, of the way from there to 1; else it is in none of the
# learned languages. With four languages that is a probability of 0.3.
MIN_LANGUAGE_LEAD = 1 / 15
# Share of the tokens that the mixture keeps.
KEPT_SHARE = 0.95


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without letters go, and texts that fit no learned language.

    The network learns from the labelled rows of ``docs`` that are not held out. ``lang`` stays as it is.
    Where there is nothing to learn from, only texts without letters go.
    """
    rows = docs.select(*COLUMNS)
    learn = ~held_out("doc_id", 5, 0) & F.col("doc_id").isNotNull()
    net = language.fit(rows.select("doc_id", "text", "lang"), learn)
    if net is None:
        return rows.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language.identify(rows, net)
    chance = 1 / len(net.languages)
    least = chance + (1 - chance) * MIN_LANGUAGE_LEAD if chance < 1 else 0.0
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least - 1e-9)
    return found.where(known).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents repeat; ``n_chars`` follows the text.

    A document that loses all its lines goes, as all it said is in others; one that was empty stays.
    """
    cleaned = line_dedup.line_dedup(docs.select(*COLUMNS), by_id=True)
    shorter = F.col("n_dropped") > 0
    left = cleaned.where(~(shorter & (F.length(F.coalesce("text", F.lit(""))) == 0)))
    chars = F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id.

    Rows that repeat an id and a text stay or go together; if their texts differ, each goes by its own. Rows
    without id stay.
    """
    found = near_dup.near_duplicates(docs.select("doc_id", "text"), told_column="told")
    gone = cut_lineage(found.where(F.col("doc_id") > F.col("class_id")).select("doc_id", "told").distinct())
    told = docs.select(*COLUMNS, near_dup.text_hash("text").alias("told"))
    marked = skew.lookup_join(told, gone.withColumn("gone", F.lit(True)), ["doc_id", "told"], row_id=["doc_id"])
    return marked.where(F.col("gone").isNull()).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by the probabilities of the raked mixture, ``KEPT_SHARE`` of the tokens in expectation."""
    return mixing.mix(docs.select(*COLUMNS), kept_share=KEPT_SHARE).where("mix_kept").select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids per document, and digests of its ids and of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.bpe_digests(docs, path, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

# The trained network and the MinHash forest are no SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
