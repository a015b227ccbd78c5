"""Operator 1: shards by extendible hashing.

A directory indexed by the leading bits of a key's hash. One bucket at first; only a bucket over the byte limit splits on its
next bit, until each fits. A bucket's bytes shrink with its depth, so a row's depth is the number of its oversized ancestors,
and the whole directory follows from byte sums by prefix: no bucket is ever gathered anywhere.

Defined results: null sizes count as 0 bytes; null keys hash as the empty string. A bucket of one row never splits, so a row
above the limit is a shard of its own. Rows whose keys agree in all hash bits cannot be told apart by bits: such a bucket has
overflow pages, numbered from 1 (0 elsewhere), each within the limit or of one row. Repeated rows are rows of their own. A key
column named like a result column comes back as key_<name>; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, numbered, own_name

BITS = 60


def key_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def extendible_shards(df: DataFrame, key: str, size: Column, limit_bytes: int) -> DataFrame:
    """One row for each row of df: the key column, n_bytes, shard (the bucket's bits as text), depth, page, shard_bytes, shard_rows."""
    rows = df.select(F.col(key).alias("k"), F.coalesce(size.cast("long"), F.lit(0)).alias("b"), key_hash(F.col(key)).alias("h"))
    rows = materialise(rows, "shard-rows")
    total = rows.agg(F.sum("b")).first()[0] or 0
    placed, base = [], 0
    step = min(24, max(1, math.ceil(math.log2(max(1, total / limit_bytes))) + 6))
    while True:
        top = min(BITS, base + step)
        leaf = rows.withColumn("leaf", F.shiftright("h", BITS - top)) if top else rows.withColumn("leaf", F.lit(0).cast("long"))
        leaves = leaf.groupBy("leaf").agg(F.sum("b").alias("b"), F.count("*").alias("n"))
        paths = leaves.select("leaf", "b", "n", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("d"))
        paths = paths.withColumn("node", F.expr(f"shiftright(leaf, {top} - d)"))
        over = paths.groupBy("d", "node").agg(F.sum("b").alias("nb"), F.sum("n").alias("nn"))
        over = materialise(over.filter((F.col("nb") > limit_bytes) & (F.col("nn") > 1)).select("d", "node", F.lit(1).alias("o")), "shard-over")
        over = F.broadcast(over) if over.count() <= 1_000_000 else over  # all paths meet at the first bits: no shuffle by them
        depth = paths.join(over, ["d", "node"], "left").groupBy("leaf").agg((F.count("o") + base).cast("int").alias("depth"))
        depth = materialise(depth, "shard-depth")
        full = depth.filter(F.col("depth") > top)
        with_depth = leaf.join(depth, "leaf")
        placed.append(with_depth.filter(F.col("depth") <= top).select("k", "b", "h", "depth", F.lit(0).cast("long").alias("page")))
        if not full.head(1):
            break
        rows = materialise(leaf.join(full.select("leaf"), "leaf", "left_semi").select("k", "b", "h"), "shard-open")
        if top == BITS:
            most = rows.groupBy("h").agg(F.greatest(F.lit(1), F.floor(limit_bytes / F.greatest(F.max("b"), F.lit(1)))).alias("fit"))
            # One key may have most rows: they are numbered in ranges of the order, which a random number ends.
            placed_ = numbered(rows.withColumn("any", F.rand(1)), [F.col(c) for c in ("h", "b", "k", "any")], "nth")
            first = placed_.groupBy("h").agg(F.min("nth").alias("first"))
            nth = F.col("nth") - F.col("first")
            placed.append(placed_.join(first.join(most, "h"), "h").select("k", "b", "h", F.lit(BITS).alias("depth"), (F.floor(nth / F.col("fit")) + 1).alias("page")))
            break
        base, step = top, 8
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    out = out.withColumn("shard", F.expr(f"substring(lpad(bin(h), {BITS}, '0'), 1, depth)"))
    sums = out.groupBy("shard", "page").agg(F.sum("b").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return out.join(sums, ["shard", "page"]).select(F.col("k").alias(own_name(key, ["n_bytes", "shard", "depth", "page", "shard_bytes", "shard_rows"])), F.col("b").alias("n_bytes"), "shard", "depth", "page", "shard_bytes", "shard_rows")


def op1_sharding(spark, sf_dir):
    from .common import table

    return extendible_shards(table(spark, sf_dir, "documents"), "doc_id", F.octet_length("text"), 1 << 20)


SQL = """
WITH rows AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS b, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
paths AS (SELECT doc_id, b, h, d, h >> (60 - d) AS node FROM rows, range(0, 61) t(d)),
nodes AS (SELECT d, node, sum(b) AS nb, count(*) AS nn FROM paths GROUP BY d, node),
depths AS (SELECT p.doc_id, any_value(p.b) AS b, any_value(p.h) AS h, sum(CASE WHEN nb > 1048576 AND nn > 1 THEN 1 ELSE 0 END)::INTEGER AS depth
  FROM paths p JOIN nodes USING (d, node) GROUP BY p.doc_id),
named AS (SELECT *, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard FROM depths)
SELECT doc_id, b AS n_bytes, shard, depth, 0::BIGINT AS page, (sum(b) OVER (PARTITION BY shard))::BIGINT AS shard_bytes, count(*) OVER (PARTITION BY shard) AS shard_rows FROM named
"""
