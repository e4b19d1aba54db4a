"""Registered queries and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from contextlib import nullcontext

from .views import variant, with_views

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "g1_denovo_posterior"


def _varied(f: Callable, kind: str) -> Callable:
    @functools.wraps(f)
    def run(spark, sf_dir):
        with variant(kind):
            return f(spark, sf_dir)

    return run


def query(sql: str | None = None, *views: str, variants: tuple[str, ...] = (), within: str | None = None) -> Callable:
    """Register a query under its function's name; sql: the same result from the views, for another engine. variants: the same query over
    other texts of the views, as <name>_<variant>; within: the query itself over those of one variant."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = _varied(f, within) if within else f
        if sql is not None:
            with variant(within) if within else nullcontext():
                ORACLE_SQL[f.__name__] = with_views(sql, *views) if views else sql
        for kind in variants:
            QUERIES[f"{f.__name__}_{kind}"] = _varied(f, kind)
            with variant(kind):
                ORACLE_SQL[f"{f.__name__}_{kind}"] = with_views(sql, *views)
        return f

    return add
