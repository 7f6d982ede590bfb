"""Registered queries: each module holds ``QUERIES`` (key -> function) and ``ORACLES`` (key -> SQL)."""

from __future__ import annotations

from connlens.plans import (
    aggregation,
    ingest,
    modelling,
    relational,
    sampling_graph,
    statistics,
    streams,
)

_MODULES = (ingest, relational, aggregation, sampling_graph, statistics, modelling, streams)

QUERIES = {key: query for module in _MODULES for key, query in module.QUERIES.items()}
ORACLES = {key: sql for module in _MODULES for key, sql in module.ORACLES.items()}
