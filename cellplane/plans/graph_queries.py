"""Queries over a directed graph with cycles, chains of lines, and shapes whose rings overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellplane.operators import chains, overlay, spatial
from cellplane.plans import graph
from cellplane.plans.placed import read
from cellplane.plans.vector_queries import _BRANDED, branded
from cellplane.scratch import materialise

#: A user at a kind of event; the next kind, of the same or the next user among ten; some users begin again.
KIND = "(length(event_type) + ascii(event_type)) % 5"
SRC = f"user_id * 5 + {KIND}"
STEP = f"CASE WHEN {KIND} = 4 AND user_id % 4 = 0 THEN user_id * 5 WHEN {KIND} = 4 THEN user_id * 5 + 4 ELSE (user_id - user_id % 10 + (user_id % 10 + event_id % 2) % 10) * 5 + {KIND} + 1 END"
ROOT = "node % 50 = 10"


def flow(s, d):
    """Components, stages, reach and dead ends of the flow of events."""
    edges = materialise(read(s, d, "events").selectExpr(f"cast({SRC} as long) as src", f"cast({STEP} as long) as dst").distinct(), "flow")
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst"))
    return graph.normalised(edges, nodes.filter(ROOT), lambda df: materialise(df, "flow")).withColumn("stage", F.col("stage").cast("long"))


_FLOW = f"""WITH RECURSIVE e AS (SELECT DISTINCT ({SRC})::BIGINT AS src, ({STEP})::BIGINT AS dst FROM events), n AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
 reach(a, b) AS (SELECT src, dst FROM e UNION SELECT r.a, e.dst FROM reach r JOIN e ON e.src = r.b),
 comp AS (SELECT n.node, least(n.node, coalesce(min(r.b), n.node)) AS c FROM n LEFT JOIN (SELECT x.a, x.b FROM reach x JOIN reach y ON y.a = x.b AND y.b = x.a) r ON r.a = n.node GROUP BY n.node),
 dag AS (SELECT DISTINCT p.c AS src, q.c AS dst FROM e JOIN comp p ON p.node = e.src JOIN comp q ON q.node = e.dst WHERE p.c <> q.c),
 way(c, d) AS (SELECT DISTINCT c, 0 FROM comp UNION SELECT dag.dst, way.d + 1 FROM way JOIN dag ON dag.src = way.c),
 root AS (SELECT node FROM n WHERE {ROOT})
 SELECT node, c AS component, (SELECT max(d) FROM way WHERE way.c = comp.c)::BIGINT AS stage, node IN (SELECT node FROM root) OR node IN (SELECT b FROM reach WHERE a IN (SELECT node FROM root)) AS reached, c NOT IN (SELECT src FROM dag) AS dead_end FROM comp"""


def repaired(s, d):
    """Boxes that overlap a copy of themselves, moved by half their sides, as one invalid shape of two rings: area by the even-odd rule, by brand."""
    moved = lambda r: F.transform(r, lambda p: F.struct((p["x"] + F.col("dx")).alias("x"), (p["y"] + F.col("dy")).alias("y")))
    ring = F.get("rings", 0)
    own = branded(s, d).withColumns({"dx": (F.get(ring, 2)["x"] - F.get(ring, 0)["x"]) / 2, "dy": (F.get(ring, 2)["y"] - F.get(ring, 0)["y"]) / 2})
    own = own.select("id", "brand", F.array(ring, moved(ring)).alias("rings"))
    found = overlay.each_measured(own, ["id", "brand"], ["rings"], overlay.odd)
    return found.groupBy("brand").agg(F.round(F.sum("area"), 3).alias("area_m2"), F.round(F.sum("perimeter"), 3).alias("perimeter_m"))


SPAN = 40


def joined_lines(s, d):
    """A step from each customer's point to the next one's, in chains of 40 customers: the chains' customers and lengths. Every other step runs backwards."""
    at = read(s, d, "customer").select(F.col("c_custkey").cast("long").alias("id"), F.struct((F.col("c_custkey") * 10.0).cast("double").alias("x"), ((F.col("c_custkey") * 577) % 6400).cast("double").alias("y")).alias("p"))
    last = (F.col("id") - 1) % SPAN == SPAN - 1
    to = at.select((F.col("id") - 1).alias("id"), F.col("p").alias("q"))
    steps = at.join(to.hint("merge"), "id", "left").filter(~last & F.col("q").isNotNull())
    ways = steps.select("id", F.when(F.col("id") % 2 == 0, F.array("p", "q")).otherwise(F.array("q", "p")).alias("points"))
    return chains.merged(ways).select("chain", F.size("points").cast("long").alias("n_points"), F.round(spatial.length(F.col("points")), 3).alias("metres"))


_JOINED = f"""WITH p AS (SELECT c_custkey::BIGINT AS id, c_custkey * 10.0::DOUBLE AS x, ((c_custkey * 577) % 6400)::DOUBLE AS y FROM customer),
 s AS (SELECT a.id, (a.id - 1) // {SPAN} AS g, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM p a JOIN p b ON b.id = a.id + 1 WHERE (a.id - 1) % {SPAN} <> {SPAN - 1})
 SELECT min(id) AS chain, count(*) + 1 AS n_points, round(sum(d), 3) AS metres FROM s GROUP BY g"""

QUERIES = {
    "joined_lines": (joined_lines, _JOINED),
    "graph_flow": (flow, _FLOW),
    "repaired_shapes": (repaired, f"WITH {_BRANDED} SELECT g AS brand, round(sum(1.5 * w * h)::DOUBLE, 3) AS area_m2, round(sum(4 * (w + h))::DOUBLE, 3) AS perimeter_m FROM b GROUP BY g"),
}
