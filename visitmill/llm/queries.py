"""All queries of the subpackage, with their SQL."""

from visitmill.llm import bpe, chat, exact_dedup, filter_audit, language, line_dedup, merkle, mixing, near_dup, quality, secrets, top_k, toxicity  # noqa: F401
from visitmill.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
