"""Queries that compose a product, and those over outlines, which SQL cannot express."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cellplane.operators import outlines, runs
from cellplane.plans import compose
from cellplane.plans.cell_queries import _RAW, nature, settlement_buffer
from cellplane.plans.join_queries import spots
from cellplane.plans.placed import GRID, VALID_SQL, components_sql, mask, valid


def compose_bands(s, d):
    """Set cells of each aggregate band of a product with four conditions."""
    conditions = {"settlement_buffer": settlement_buffer(s, d), "general_buildings_buffer": runs.dilate(mask("single")(s, d), 100, GRID), "military_restricted_area": mask("special")(s, d), "nature_protection_areas": nature(s, d)}
    out = None
    for name, m in compose.composed(conditions, valid(s), GRID).items():
        one = m.agg(F.coalesce(runs.n_cells(m), F.lit(0).cast("long")).alias("cells")).select(F.lit(name).alias("band"), "cells")
        out = one if out is None else out.unionByName(one)
    return out


def grouped(s, d):
    """The candidates of each square of 1600 m as one set of points."""
    p = spots(s, d, "candidates")
    key = (F.floor(F.col("x") / 1600) * 4 + F.floor(F.col("y") / 1600)).cast("long")
    return p.groupBy(key.alias("id")).agg(F.array(F.sort_array(F.collect_list(F.struct("x", "y")))).alias("rings"))


def hulls(s, d):
    return outlines.mapped(grouped(s, d), lambda rings: [outlines.convex_hull(r) for r in rings]).select("id", F.size(F.get("rings", 0)).alias("corners"))


def axes(s, d):
    def kernel(rings):
        found = [outlines.long_axis(r) for r in rings if len(r)]
        return [np.asarray(a) for a in found if a is not None]

    return outlines.mapped(grouped(s, d), kernel).filter(F.size("rings") > 0).select("id", F.round(F.hypot(F.get(F.get("rings", 0), 0)["x"] - F.get(F.get("rings", 0), 1)["x"], F.get(F.get("rings", 0), 0)["y"] - F.get(F.get("rings", 0), 1)["y"]), 3).alias("length"))


QUERIES = {
    "compose_bands": (compose_bands, f"""WITH RECURSIVE {_RAW}, {components_sql('raw', 'lab', 4)}, h AS (SELECT * FROM human WHERE {VALID_SQL}), n AS (SELECT * FROM nature WHERE {VALID_SQL})
        SELECT 'exclusion_human' AS band, count(*) AS cells FROM h UNION ALL SELECT 'exclusion_nature', count(*) FROM n UNION ALL SELECT 'exclusion_geography', 0 UNION ALL SELECT 'all_exclusions', count(*) FROM (SELECT * FROM h UNION SELECT * FROM n)
        UNION ALL SELECT 'available_after_all_exclusions_raw', count(*) FROM raw UNION ALL SELECT 'available_cleaned_min_10ha', count(*) FROM lab WHERE label IN (SELECT label FROM lab GROUP BY label HAVING count(*) >= 160)"""),
    "convex_hulls": (hulls, None),
    "runway_axis": (axes, None),
}
