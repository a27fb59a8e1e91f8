"""All registered queries of the archive engine."""

from __future__ import annotations

from . import io_queries, log_queries, merge_queries, record_queries, sample_queries, stats_queries


def _all() -> dict:
    out = {}
    for module in (io_queries, sample_queries, stats_queries, record_queries, merge_queries, log_queries):
        out |= module.build()
    return dict(sorted(out.items()))


def queries() -> dict:
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in _all().items() if sql}
