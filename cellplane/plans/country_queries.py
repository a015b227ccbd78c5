"""The product on a grid of the size of a country: 14001 rows of 24001 cells of 25 m, points of whole tables strewn over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec, disc
from cellplane.operators import labels, runs
from cellplane.plans.placed import read
from cellplane.scratch import materialise

COUNTRY = GridSpec(24001, 14001, 25.0, 0.0, 14001 * 25.0)
#: Layers: table, row and column (before the remainder by the grid), buffer in metres.
LAYERS = {
    "settlement_buffer": ("customer", "c_custkey * 7919 + c_nationkey * 104729", "c_custkey * 15485863 + c_nationkey * 32452843", 750.0),
    "general_buildings_buffer": ("part", "p_partkey * 6007 + p_size * 4999", "p_partkey * 86028121 + p_size * 2097593", 250.0),
    "nature_protection_areas": ("supplier", "s_suppkey * 99991 + s_nationkey * 7907", "s_suppkey * 611953 + s_nationkey * 1299709", 1000.0),
}


def layer(s, d, name: str, grid: GridSpec = COUNTRY) -> DataFrame:
    table, row, col, metres = LAYERS[name]
    cells = read(s, d, table).selectExpr(f"cast(({row}) % {grid.height} as int) AS row", f"cast(({col}) % {grid.width} as int) AS c0").withColumn("c1", F.col("c0"))
    return runs.clip(runs.widened(cells, grid.radius(metres)), grid)


def exclusions(s, d, grid: GridSpec = COUNTRY) -> DataFrame:
    return runs.or_(*[layer(s, d, name, grid) for name in LAYERS])


def totals(s, d, grid: GridSpec = COUNTRY) -> DataFrame:
    """Set cells of each buffered layer, of all of them, and what is left: one sweep along the rows, each layer buffered once."""
    names = list(LAYERS)
    events = runs.coincident({name: layer(s, d, name, grid) for name in names})
    some = F.greatest(*[F.col(n).cast("int") for n in names]) > 0
    n = lambda on, name: F.sum(F.when(on, F.col("width")).otherwise(0)).cast("long").alias(name)
    sums = events.agg(*[n(F.col(name), name) for name in names], n(some, "all_exclusions"))  # one row
    rows = sums.selectExpr(f"stack({len(names) + 2}, {', '.join(f"'{x}', {x}" for x in [*names, 'all_exclusions'])}, 'available_after_all_exclusions_raw', {grid.width * grid.height} - all_exclusions) AS (band, cells)")
    return rows.select("band", F.coalesce("cells", F.lit(0).cast("long")).alias("cells"))


def finalize(s, d, grid: GridSpec = COUNTRY, hectares: float = 10.0) -> DataFrame:
    """Availability on the whole grid: raw cells, and the components of at least 10 ha with their number, cells and the largest of them."""
    raw = materialise(runs.complement(exclusions(s, d, grid), grid), "country-raw")
    sizes = labels.sizes(labels.components(raw, grid, 4))
    large = F.col("cells") >= grid.min_cells(hectares)
    out = sizes.agg(F.sum("cells").alias("raw_cells"), F.count_if(large).alias("areas"), F.sum(F.when(large, F.col("cells"))).alias("cleaned_cells"), F.max("cells").alias("largest"))
    return out.select(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in out.columns])


def _cells_sql(name: str) -> str:
    table, row, col, metres = LAYERS[name]
    k = ", ".join(f"({dr}, {w})" for dr, w in disc(metres / COUNTRY.cell_m))
    return (
        f"{name} AS (SELECT DISTINCT p.row + k.dr AS row, unnest(range(greatest(p.col - k.w, 0), least(p.col + k.w, {COUNTRY.width - 1}) + 1)) AS col "
        f"FROM (SELECT DISTINCT ({row}) % {COUNTRY.height} AS row, ({col}) % {COUNTRY.width} AS col FROM {table}) p, (VALUES {k}) k(dr, w) WHERE p.row + k.dr BETWEEN 0 AND {COUNTRY.height - 1})"
    )


_TOTALS = (
    f"WITH {', '.join(map(_cells_sql, LAYERS))}, every AS ({' UNION '.join(f'SELECT * FROM {n}' for n in LAYERS)}), n AS (SELECT count(*) AS n FROM every) "
    + " UNION ALL ".join(f"SELECT '{n}' AS band, count(*) AS cells FROM {n}" for n in LAYERS)
    + f" UNION ALL SELECT 'all_exclusions', n FROM n UNION ALL SELECT 'available_after_all_exclusions_raw', {COUNTRY.width * COUNTRY.height} - n FROM n"
)

QUERIES = {"country_totals": (totals, _TOTALS), "country_finalize": (finalize, None)}
