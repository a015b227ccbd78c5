"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

import importlib

#: Query name, module, and whether the module's SQL is its oracle.
QUERIES = {
    "op1_sharding": ("sharding", True),
    "op2_fingerprints": ("fingerprints", False),
    "op3_ngram_join": ("ngram_join", False),
    "op4_packing": ("packing", False),
    "op5_language_id": ("language_id", False),
    "op6_quality_rules": ("quality_rules", False),
    "op7_suffix_dedup": ("suffix_dedup", False),
    "op8_url_filters": ("url_filters", False),
    "op9_mixing": ("mixing", False),
    "op10_quality_knn": ("quality_knn", False),
    "op11_token_alignment": ("token_alignment", False),
    "op12_license_scan": ("license_scan", True),
    "op13_fill_middle": ("fill_middle", False),
}


def queries() -> dict:
    def of(name: str, module: str):
        return lambda spark, sf_dir: getattr(importlib.import_module(f"{__package__}.{module}"), name)(spark, sf_dir)

    return {name: of(name, module) for name, (module, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: importlib.import_module(f"{__package__}.{module}").SQL for name, (module, sql) in QUERIES.items() if sql}
