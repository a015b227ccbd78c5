"""Masks, points and planes placed on a small grid from the tables, by whole-number rules that SQL can repeat.

Each placement is a pair: a function of (spark, sf_dir) and the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import runs

SIZE = 256
GRID = GridSpec(SIZE, SIZE, 25.0, 0.0, SIZE * 25.0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Point sets: table, row and column expression. Each set takes all rows of its table.
POINTS = {
    "settlement": ("supplier", "(s_suppkey * 97 + s_nationkey * 5) % 256", "(s_suppkey * 31 + s_nationkey * 11) % 256"),
    "single": ("supplier", "(s_suppkey * 59 + s_nationkey * 7) % 256", "(s_suppkey * 83 + s_nationkey) % 256"),
    "special": ("nation", "(n_nationkey * 41 + n_regionkey * 3) % 256", "(n_nationkey * 19 + n_regionkey * 29) % 256"),
    "buildings": ("customer", "(c_custkey * 97 + c_nationkey * 13) % 256", "(c_custkey * 31 + c_nationkey * 7) % 256"),
    "addresses": ("customer", "(c_custkey * 53 + c_nationkey) % 256", "(c_custkey * 29 + c_nationkey * 17) % 256"),
    "gardens": ("part", "(p_partkey * 61 + p_size) % 256", "(p_partkey * 23 + p_size * 7) % 256"),
}


def points(name: str):
    table, row, col = POINTS[name]
    return lambda spark, sf_dir: read(spark, sf_dir, table).selectExpr(f"cast({row} as int) as row", f"cast({col} as int) as col").distinct()


def points_sql(name: str) -> str:
    table, row, col = POINTS[name]
    return f"SELECT DISTINCT ({row})::INTEGER AS row, ({col})::INTEGER AS col FROM {table}"


def mask(name: str):
    return lambda spark, sf_dir: runs.from_cells(points(name)(spark, sf_dir))


#: Zones are column stripes by region; a stripe's last column also belongs to the next zone, as border cells do.
ZONE = "floor(col * 5 / 256)"
ZONES_SQL = "zones AS (SELECT DISTINCT r_regionkey AS zone, c0, c1 FROM (SELECT r_regionkey, greatest(r_regionkey * 51 - 1, 0)::INTEGER AS c0, (CASE WHEN r_regionkey = 4 THEN 255 ELSE r_regionkey * 51 + 51 END)::INTEGER AS c1 FROM region))"


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripes = read(spark, sf_dir, "region").selectExpr("r_regionkey as zone", "cast(greatest(r_regionkey * 51 - 1, 0) as int) as c0", "cast(case when r_regionkey = 4 then 255 else r_regionkey * 51 + 51 end as int) as c1")
    return stripes.crossJoin(spark.range(SIZE).select(F.col("id").cast("int").alias("row"))).select("zone", "row", "c0", "c1")


#: The valid area: all but a frame of 6 cells.
FRAME = 6
VALID_SQL = "row BETWEEN 6 AND 249 AND col BETWEEN 6 AND 249"


def valid(spark: SparkSession, sf_dir: str = "") -> DataFrame:
    return spark.range(FRAME, SIZE - FRAME).select(F.col("id").cast("int").alias("row"), F.lit(FRAME).alias("c0"), F.lit(SIZE - FRAME - 1).alias("c1"))


def disc_sql(source: str, metres: float, name: str) -> str:
    """CTE of a mask (row, col) dilated by metres on the grid."""
    r = metres / GRID.cell_m
    k = int(r) + 1
    return (
        f"{name} AS (SELECT DISTINCT (m.row + a.dr)::INTEGER AS row, (m.col + b.dc)::INTEGER AS col FROM {source} m, range(-{k}, {k + 1}) a(dr), range(-{k}, {k + 1}) b(dc) "
        f"WHERE a.dr * a.dr + b.dc * b.dc <= {r * r + 1e-9} AND m.row + a.dr BETWEEN 0 AND 255 AND m.col + b.dc BETWEEN 0 AND 255)"
    )


GRID_SQL = "grid AS (SELECT a.r::INTEGER AS row, b.c::INTEGER AS col FROM range(0, 256) a(r), range(0, 256) b(c))"


def components_sql(cells: str, name: str, neighbours: int) -> str:
    """CTEs that label cells (row, col) with the least cell number of their component: least labels spread over runs of cells."""
    reach = {4: 0, 8: 1}[neighbours]
    return (
        f"{name}_r AS (SELECT row * 256 + min(col) AS id, row, min(col) AS c0, max(col) AS c1 FROM (SELECT row, col, col - row_number() OVER (PARTITION BY row ORDER BY col) AS g FROM {cells}) GROUP BY row, g), "
        f"{name}_d AS (SELECT a.id AS s, b.id AS t FROM {name}_r a JOIN {name}_r b ON b.row = a.row + 1 AND a.c0 - {reach} <= b.c1 AND b.c0 <= a.c1 + {reach}), "
        f"{name}_e AS (SELECT s, t FROM {name}_d UNION ALL SELECT t, s FROM {name}_d), "
        f"{name}_w(id, label) USING KEY (id) AS (SELECT id, id FROM {name}_r UNION SELECT e.t, min(w.label) FROM {name}_w w JOIN {name}_e e ON e.s = w.id "
        f"JOIN recurring.{name}_w cur ON cur.id = e.t WHERE w.label < cur.label GROUP BY e.t), "
        f"{name} AS (SELECT r.row, unnest(range(r.c0, r.c1 + 1))::INTEGER AS col, w.label::BIGINT AS label FROM {name}_w w JOIN {name}_r r ON r.id = w.id)"
    )
