"""Registered queries: each operator run on the star-schema tables, with its SQL twin."""

from driver_queries.registry import ORACLES, QUERIES
from driver_queries import (  # noqa: F401 - importing registers the queries
    correlating,
    encoding,
    jobs,
    joining,
    keying,
    modelling,
    plans,
    profiling,
    properties,
    shaping,
    stumps,
)

__all__ = ["ORACLES", "QUERIES"]
