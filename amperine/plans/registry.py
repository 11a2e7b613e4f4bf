"""All registered queries."""

from __future__ import annotations

from functools import wraps

from amperine.plans import aggregates, alerts, reports, scoring, streams
from amperine.session import tune

_MODULES = [aggregates, scoring, alerts, reports, streams]


def _tuned(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(tune(spark), sf_dir)

    return run


def queries() -> dict:
    return {name: _tuned(query) for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in module.SQL.items()}
