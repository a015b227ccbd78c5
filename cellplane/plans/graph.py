"""The graph of scripts and files: endpoints to nodes, directions, stages and reach."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefixes of names that are canonical as written.
CANONICAL = ("cfg:", "make:", "bin:", "layer:")


def bare(path: Column) -> Column:
    """A path without any "./" in front."""
    return F.regexp_replace(path, r"^(\./)+", "")


def resolved(edges: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """edges (…, fragment, endpoint) with node and stub.

    In this order: an alias (alias, id), a name that the own fragment gives (nodes: original, id, fragment), one that another fragment
    gives (of several the least id), a canonical name as it is, a path. A path that is no node's id is a stub.
    """
    own = nodes.groupBy(F.col("fragment").alias("__f"), F.col("original").alias("__o")).agg(F.min("id").alias("__own"))
    other = nodes.groupBy(F.col("original").alias("__p")).agg(F.min("id").alias("__other"))
    known = nodes.select(F.col("id").alias("__id")).distinct()
    out = edges.join(aliases.select(F.col("alias").alias("__a"), F.col("id").alias("__alias")), F.col("endpoint") == F.col("__a"), "left")
    out = out.join(own, (F.col("fragment") == F.col("__f")) & (F.col("endpoint") == F.col("__o")), "left").join(other, F.col("endpoint") == F.col("__p"), "left")
    canonical = F.lit(False)
    for p in CANONICAL:
        canonical = canonical | F.col("endpoint").startswith(p)
    named = F.coalesce("__alias", "__own", "__other", F.when(canonical, F.col("endpoint")))
    out = out.withColumns({"__named": named, "node": F.coalesce(named, bare(F.col("endpoint")))}).join(known, F.col("node") == F.col("__id"), "left")
    return out.select(*edges.columns, "node", (F.col("__named").isNull() & F.col("__id").isNull()).alias("stub"))


def directed(edges: DataFrame) -> DataFrame:
    """edges (src, dst, src_kind, dst_kind, verb; kinds actor or artifact) as (producer, consumer, verb): writing goes from the actor to the artifact, reading back; ends of one kind stay out."""
    forward = (F.col("src_kind") == "actor") == (F.col("verb") == "writes")
    rows = edges.filter(F.col("src_kind") != F.col("dst_kind"))
    return rows.select(F.when(forward, F.col("src")).otherwise(F.col("dst")).alias("producer"), F.when(forward, F.col("dst")).otherwise(F.col("src")).alias("consumer"), "verb")


def stages(edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, stage) of an acyclic graph (src, dst): 0 for what nothing feeds, else one more than the greatest stage of its sources. Nodes on cycles are left out."""
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    open_ = cut(nodes)
    done, stage = None, 0
    while True:
        rest = edges.join(open_.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        ready = cut(open_.join(rest, "node", "left_anti").withColumn("stage", F.lit(stage)))
        if not ready.head(1):
            return done if done is not None else ready
        done = ready if done is None else done.unionByName(ready)
        open_, stage = cut(open_.join(ready, "node", "left_anti")), stage + 1


def strong_components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of a directed graph (src, dst): the least node of those that reach each other. cut: writes a table and reads it again.

    Forward and backward: nodes without a way in or out are components of their own; every other takes the least node that reaches it as its colour, and what leads
    back to a colour's own node within the colour is that node's component. What is left goes again, without the edges between colours. Rounds grow with
    the longest shortest path, not with the number of nodes.
    """
    ends = lambda e: e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct()
    live, done = cut(edges.select("src", "dst").filter("src is not null and dst is not null").distinct()), None
    nodes, live = cut(ends(live)), cut(live.filter("src <> dst"))
    while nodes.head(1):
        while True:  # trim
            kept = cut(live.join(live.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(live.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi"))
            if kept.count() == live.count():
                break
            live = kept
        rest = cut(ends(live))
        alone = nodes.join(rest, "node", "left_anti").select("node", F.col("node").alias("component"))
        if not rest.head(1):
            return alone if done is None else done.unionByName(alone)
        colour = cut(rest.select("node", F.col("node").alias("colour")))
        while True:
            near = live.join(colour.select(F.col("node").alias("src"), "colour"), "src").groupBy(F.col("dst").alias("node")).agg(F.min("colour").alias("near"))
            after = cut(colour.join(near, "node", "left").select("node", F.least("colour", "near").alias("colour"), (F.col("near") < F.col("colour")).alias("fell")))
            colour = after.select("node", "colour")
            if not after.filter("fell").head(1):
                break
        of = lambda end: colour.select(F.col("node").alias(end), F.col("colour").alias(f"{end}_colour"))  # noqa: E731, B023
        live = cut(live.join(of("src"), "src").join(of("dst"), "dst").filter("src_colour = dst_colour").select("src", "dst"))
        found = cut(colour.filter("node = colour"))
        front = found
        while front.head(1):
            back = live.join(front.select(F.col("node").alias("dst"), "colour"), "dst").select(F.col("src").alias("node"), "colour").distinct()
            front = cut(back.join(found, "node", "left_anti"))
            found = cut(found.unionByName(front))
        part = alone.unionByName(found.select("node", F.col("colour").alias("component")))
        done = part if done is None else done.unionByName(part)
        nodes = cut(rest.join(found.select("node"), "node", "left_anti"))
        gone = found.select("node")
        live = cut(live.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti"))
    return done if done is not None else nodes.select("node", F.col("node").alias("component"))


def normalised(edges: DataFrame, roots: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component, stage, reached, dead_end) of any directed graph (src, dst). Nodes that reach each other share a stage; reached: whether a way leads
    there from a root (node), roots included; dead_end: nothing beyond the own component reads it."""
    of = cut(strong_components(edges, cut))
    at = lambda end: of.select(F.col("node").alias(end), F.col("component").alias(f"{end}_c"))
    between = cut(edges.select("src", "dst").distinct().join(at("src"), "src").join(at("dst"), "dst").filter("src_c <> dst_c").select(F.col("src_c").alias("src"), F.col("dst_c").alias("dst")).distinct())
    level = stages(between, cut).withColumnRenamed("node", "component")
    front = found = cut(of.join(roots.select("node").distinct(), "node", "left_semi").select("component").distinct())
    while front.head(1):
        ahead = between.join(front.select(F.col("component").alias("src")), "src", "left_semi").select(F.col("dst").alias("component")).distinct()
        front = cut(ahead.join(found, "component", "left_anti"))
        found = cut(found.unionByName(front))
    open_ = between.select(F.col("src").alias("component")).distinct().withColumn("read", F.lit(True))
    out = of.join(level, "component", "left").join(found.withColumn("hit", F.lit(True)), "component", "left").join(open_, "component", "left")
    return out.select("node", "component", F.coalesce("stage", F.lit(0)).alias("stage"), F.coalesce("hit", F.lit(False)).alias("reached"), F.col("read").isNull().alias("dead_end"))
