"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles."""

from __future__ import annotations

from critiq.plans import (consolidate_queries, extract_queries, keyword_queries, metrics_queries,
                          predict_queries, stream_queries, textrank_queries)

_MODULES = [metrics_queries, consolidate_queries, extract_queries, keyword_queries, textrank_queries,
            predict_queries, stream_queries]


def all_queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
