"""All queries of this subpackage; importing the modules registers them."""

from fieldpanel.llm.registry import ORACLES, QUERIES
from fieldpanel.llm import (  # noqa: F401 - importing registers the queries
    query_chat,
    query_clustering,
    query_dedup,
    query_fingerprint,
    query_lines,
    query_mixture,
    query_pii,
    query_quality,
    query_repair,
    query_tokens,
)

__all__ = ["ORACLES", "QUERIES"]
