"""All registered queries over the given tables and their SQL counterparts."""

from __future__ import annotations

from chronotally.plans import live_queries, metric_queries, queue_queries, registry, report_queries, state_queries, time_queries, value_queries  # noqa: F401  importing registers


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
