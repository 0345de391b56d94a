"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

import functools
import importlib

from rasterloom.plans.oracle_views import with_views
from rasterloom.session import tune

QUERIES: dict = {}
ORACLES: dict = {}
MODULES = (
    "queries_pixels", "queries_names", "queries_geometry", "queries_catalog", "queries_cube",
    "queries_quality", "queries_chains",
)


def query(name, sql=None, views=()):
    """Register ``fn(spark, sf_dir)``; ``sql`` may use the named views and everything they need."""

    def register(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return register


def load():
    for module in MODULES:
        importlib.import_module(f"rasterloom.plans.{module}")
    return QUERIES, ORACLES
