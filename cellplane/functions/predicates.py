"""Declarative predicates: registries of selections over one dataset, compiled to one pass.

A predicate is a dict with "col" and one of "values" (membership of the raw column), "startswith" (one prefix or several; null is empty) or
"contains" (a regular expression). A selection has "match", a list of predicates that must all hold, and tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("values", "startswith", "contains")


def predicate(spec: dict, columns: list[str]) -> Column:
    if spec["col"] not in columns:
        raise KeyError(f"column {spec['col']!r} missing; available: {sorted(columns)}")
    kind = next((k for k in KINDS if k in spec), None)
    if kind is None:
        raise ValueError(f"unsupported predicate: {spec!r}")
    col = F.col(spec["col"])
    if kind == "values":
        return F.coalesce(col.isin(*spec["values"]), F.lit(False))
    col = F.coalesce(col.cast("string"), F.lit(""))
    if kind == "contains":
        return col.rlike(spec["contains"])
    prefixes = spec["startswith"] if isinstance(spec["startswith"], (tuple, list)) else (spec["startswith"],)
    out = F.lit(False)
    for p in prefixes:
        out = out | col.startswith(p)
    return out


def matches(selection: dict, columns: list[str]) -> Column:
    out = F.lit(True)
    for spec in selection["match"]:
        out = out & predicate(spec, columns)
    return out


def select_buckets(df: DataFrame, selections: list[dict], tags: list[str]) -> DataFrame:
    """df once for each selection that a row matches, with the selection's tags; one scan whatever their number."""
    found = F.array(*[F.struct(matches(s, df.columns).alias("hit"), *[F.lit(s[t]).alias(t) for t in tags]) for s in selections])
    out = df.withColumn("__s", F.explode(F.filter(found, lambda s: s["hit"])))
    return out.select(*df.columns, *[F.col(f"__s.{t}").alias(t) for t in tags])


def columns_of(selections: list[dict]) -> list[str]:
    """The columns that a registry reads."""
    return sorted({p["col"] for s in selections for p in s["match"]})


# Classes of infrastructure.
ROAD_TRUNK = ("motorway", "motorway_link", "trunk", "trunk_link")
ROAD_FEDERAL = ("primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link")
RAIL_MAIN = ("rail", "narrow_gauge")
PEOPLE_AERIALWAYS = ("gondola", "cable_car", "chair_lift", "mixed_lift")


def col_or(df: DataFrame, name: str, default: str = "") -> Column:
    """The column in lower case, or a default where the table lacks it."""
    return F.lower(F.coalesce(F.col(name).cast("string"), F.lit(default))) if name in df.columns else F.lit(default)
