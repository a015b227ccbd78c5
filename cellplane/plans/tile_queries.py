"""Queries over planes as tiles, and over files written along a curve. Heights are sums of quantities of the order lines at a cell."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cellplane import scratch
from cellplane.functions.grid import GridSpec
from cellplane.operators import raster, runs, tiles
from cellplane.plans.join_queries import boxes_sql
from cellplane.plans.placed import GRID, GRID_SQL, mask, points_sql, read
from cellplane.plans.vector_queries import branded
from cellplane.sources import geoparquet

PLACE = ("(l_orderkey * 97 + l_linenumber * 13) % 256", "(l_partkey * 31 + l_suppkey * 7) % 256")
SIDE, BLOCK = 64, 4
WARPED = GridSpec(100, 110, 40.0, 130.0, 6250.0)
WINDOW = (1500.0, 1000.0, 3200.0, 2600.0)


def heights(s, d):
    """(row, col, v) of cells with order lines."""
    return read(s, d, "lineitem").groupBy(F.expr(PLACE[0]).cast("int").alias("row"), F.expr(PLACE[1]).cast("int").alias("col")).agg(F.sum("l_quantity").cast("double").alias("v"))


_HEIGHTS = f"h AS (SELECT ({PLACE[0]})::INTEGER AS row, ({PLACE[1]})::INTEGER AS col, sum(l_quantity)::DOUBLE AS v FROM lineitem GROUP BY 1, 2)"


def slopes(s, d):
    """Slope of blocks of 4 x 4 cells; cells without order lines are level at 0."""
    found, grid, side = tiles.slope_percent(tiles.from_cells(heights(s, d), GRID, 0.0, SIDE), GRID, BLOCK, SIDE, 0.0)
    return tiles.to_cells(found, grid, side=side).select("row", "col", F.round("v", 6).alias("slope"))


_NEAR = ", ".join(f"max(s.v) FILTER (a.i = {i} AND b.j = {j}) AS n{i + 1}{j + 1}" for i in (-1, 0, 1) for j in (-1, 0, 1))
_GX = " ".join(f"{'+' if w > 0 else '-'} {abs(w)} * n{i}{j}" for i, r in enumerate((1, 2, 1)) for j, w in ((0, -r), (2, r)))
_GY = " ".join(f"{'+' if w > 0 else '-'} {abs(w)} * n{i}{j}" for j, r in enumerate((1, 2, 1)) for i, w in ((0, -r), (2, r)))
_SLOPES = f"""WITH {_HEIGHTS}, {GRID_SQL}, blocks AS (SELECT (g.row // 4)::INTEGER AS row, (g.col // 4)::INTEGER AS col, sum(coalesce(v, 0)) / 16 AS v FROM grid g LEFT JOIN h USING (row, col) GROUP BY 1, 2),
 near AS (SELECT t.row, t.col, {_NEAR} FROM blocks t, range(-1, 2) a(i), range(-1, 2) b(j), blocks s WHERE s.row = least(63, greatest(0, t.row + a.i)) AND s.col = least(63, greatest(0, t.col + b.j)) GROUP BY t.row, t.col)
 SELECT row, col, round(sqrt(pow({_GX}, 2) + pow({_GY}, 2)) / 800 * 100, 6) AS slope FROM near"""


def blurred(s, d):
    """Buildings blurred by 100 m, in tiles of 64 cells."""
    cells = runs.to_cells(mask("buildings")(s, d)).withColumn("v", F.lit(1.0))
    found = tiles.blur_percent(tiles.from_cells(cells, GRID, 0.0, SIDE), 100, GRID, SIDE)
    return tiles.to_cells(found, GRID, lambda v: v > 0, SIDE).select("row", "col", F.col("v").cast("int").alias("percent"))


_K = ", ".join(f"({o}, {w[0]!r}::DOUBLE)" for o, w in raster.kernel(4.0).items())
_BLURRED = f"""WITH m AS ({points_sql('buildings')}), k(o, w) AS (VALUES {_K}),
 gr AS (SELECT row AS p, row, col FROM m UNION ALL SELECT -1 - row, row, col FROM m WHERE row < 16 UNION ALL SELECT 511 - row, row, col FROM m WHERE row >= 240),
 down AS (SELECT p + o AS row, col, sum(w) AS v FROM gr, k WHERE p + o BETWEEN 0 AND 255 GROUP BY 1, 2),
 gc AS (SELECT col AS p, row, v FROM down UNION ALL SELECT -1 - col, row, v FROM down WHERE col < 16 UNION ALL SELECT 511 - col, row, v FROM down WHERE col >= 240),
 b AS (SELECT row, p + o AS col, sum(w * v) AS v FROM gc, k WHERE p + o BETWEEN 0 AND 255 GROUP BY 1, 2)
 SELECT row::INTEGER AS row, col::INTEGER AS col, least(100, greatest(0, round_even(round(v * 100, 9), 0)))::INTEGER AS percent FROM b WHERE round_even(round(v * 100, 9), 0) > 0"""


def warps(s, d):
    """Heights on a grid of 40 m, off the first: average by covered shares, and greatest; cells without order lines are missing."""
    own = scratch.materialise(tiles.from_cells(heights(s, d), GRID, side=SIDE), "tiles")
    one = lambda how: tiles.to_cells(tiles.warped(own, GRID, WARPED, how, SIDE), WARPED, side=SIDE)
    both = one("average").withColumnRenamed("v", "average").join(one("greatest").withColumnRenamed("v", "greatest"), ["row", "col"])
    return both.select("row", "col", F.round("average", 6).alias("average"), "greatest")


_WARPS = f"""WITH {_HEIGHTS}, t AS (SELECT a.r::INTEGER AS row, b.c::INTEGER AS col, (150 + a.r * 40) / 25.0::DOUBLE AS r0, (190 + a.r * 40) / 25.0::DOUBLE AS r1, (130 + b.c * 40) / 25.0::DOUBLE AS c0, (170 + b.c * 40) / 25.0::DOUBLE AS c1 FROM range(0, 110) a(r), range(0, 100) b(c)),
 m AS (SELECT t.row, t.col, h.v, (least(r1, h.row + 1) - greatest(r0, h.row)) * (least(c1, h.col + 1) - greatest(c0, h.col)) AS w FROM t, range(0, 3) i(i), range(0, 3) j(j), h WHERE h.row = floor(r0) + i.i AND h.col = floor(c0) + j.j AND least(r1, h.row + 1) - greatest(r0, h.row) > 1e-9 AND least(c1, h.col + 1) - greatest(c0, h.col) > 1e-9)
 SELECT row, col, round(sum(w * v) / sum(w), 6) AS average, max(v) AS greatest FROM m GROUP BY row, col"""


def pruned_boxes(s, d):
    """Boxes written along a curve with covering boxes, and those read again that meet a window: the scan skips row groups."""
    path = f"{scratch.shared_folder(s)}/cellplane/geoparquet-{uuid.uuid4().hex}"
    geoparquet.write_geoparquet(branded(s, d), path, row_group=512)
    scratch.register(s, path)
    found = geoparquet.read_covered(s, path, WINDOW, ["id", "brand"])
    return found.select("id", "brand", F.size(F.get("rings", 0)).alias("corners"))


#: The country's grid, and the order lines' cells on it.
COUNTRY = GridSpec(24_001, 14_001)
FAR = ("(l_orderkey * 7919 + l_linenumber * 104729) % 14001", "(l_partkey * 3571 + l_suppkey * 613) % 24001")


def country_slopes(s, d):
    """Slope of blocks of 4 x 4 cells over the country's grid of 336,038,001 cells, in tiles of 256: blocks by whole percent, the level ones left out."""
    cells = read(s, d, "lineitem").groupBy(F.expr(FAR[0]).cast("int").alias("row"), F.expr(FAR[1]).cast("int").alias("col")).agg((F.sum("l_quantity") * 16).cast("double").alias("v"))
    found, grid, side = tiles.slope_percent(tiles.from_cells(cells, COUNTRY, 0.0), COUNTRY, BLOCK, fill=0.0)
    steep = tiles.to_cells(found, grid, lambda v: v > 0, side)
    return steep.groupBy(F.floor(F.round("v", 6)).alias("percent")).agg(F.count("*").alias("blocks"))


_COUNTRY = f"""WITH h AS (SELECT (({FAR[0]}) // 4)::INTEGER AS row, (({FAR[1]}) // 4)::INTEGER AS col, sum(l_quantity)::DOUBLE * 16 AS v, any_value(({FAR[0]})) AS r, any_value(({FAR[1]})) AS c FROM lineitem GROUP BY ({FAR[0]}), ({FAR[1]})),
 b AS (SELECT row, col, sum(v * (CASE WHEN r = 14000 THEN 4 ELSE 1 END) * (CASE WHEN c = 24000 THEN 4 ELSE 1 END)) / 16 AS v FROM h GROUP BY row, col),
 gr AS (SELECT row AS p, col, v FROM b UNION ALL SELECT -1, col, v FROM b WHERE row = 0 UNION ALL SELECT 3501, col, v FROM b WHERE row = 3500),
 g AS (SELECT p, col AS q, v FROM gr UNION ALL SELECT p, -1, v FROM gr WHERE col = 0 UNION ALL SELECT p, 6001, v FROM gr WHERE col = 6000),
 k(i, j, x, y) AS (VALUES (-1, -1, -1, -1), (-1, 0, 0, -2), (-1, 1, 1, -1), (0, -1, -2, 0), (0, 1, 2, 0), (1, -1, -1, 1), (1, 0, 0, 2), (1, 1, 1, 1)),
 t AS (SELECT p - i AS row, q - j AS col, sum(v * x) AS gx, sum(v * y) AS gy FROM g, k WHERE p - i BETWEEN 0 AND 3500 AND q - j BETWEEN 0 AND 6000 GROUP BY 1, 2),
 u AS (SELECT sqrt(gx * gx + gy * gy) / 800 * 100 AS v FROM t)
 SELECT floor(round(v, 6))::BIGINT AS percent, count(*) AS blocks FROM u WHERE v > 0 GROUP BY 1"""

QUERIES = {
    "country_slopes": (country_slopes, _COUNTRY),
    "tile_slopes": (slopes, _SLOPES),
    "tile_blur": (blurred, _BLURRED),
    "tile_warps": (warps, _WARPS),
    "pruned_boxes": (pruned_boxes, f"WITH {boxes_sql('b')} SELECT poly AS id, p_brand AS brand, 4 AS corners FROM b JOIN part ON p_partkey = poly WHERE x <= {WINDOW[2]} AND x + w >= {WINDOW[0]} AND y <= {WINDOW[3]} AND y + h >= {WINDOW[1]}"),
}
