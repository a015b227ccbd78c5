"""All registered queries of the engine, by name, with their SQL."""

from __future__ import annotations

import importlib

MODULES = ("cell_queries", "scalar_queries", "join_queries", "plane_queries", "product_queries", "select_queries", "area_queries", "country_queries", "report_queries", "vector_queries", "tile_queries", "graph_queries")


def _all() -> dict:
    out: dict = {}
    for name in MODULES:
        for query, pair in importlib.import_module(f"cellplane.plans.{name}").QUERIES.items():
            if query in out:
                raise ValueError(f"two queries named {query}")
            out[query] = pair
    return out


def queries() -> dict:
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
