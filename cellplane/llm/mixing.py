"""Operator 9: mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every document gets a rate between 0 and `most` copies. Of all rates that meet a source's token target, those of least relative
entropy (against one copy of two allowed) are exponentially tilted: rate = most / (1 + exp(-lambda * size / mean size)). The
convex dual has one multiplier for each source; Newton steps, kept inside a bracket, solve it by grouped sums over the histogram
of sizes, until every source's tokens are within `NEAR` of its target. Sums are decimals, so the order of addition cannot matter.

Rates become whole copies by systematic rounding: documents of one source and size have one rate, and running sums of rates along
the sizes of a source say how many of them get the extra copy; those are spread evenly over their order by key. What rounding leaves off
a target, at most about one document's size, is made up by at most `FLIPS` documents of a source that get one copy more or less; a source of
few documents is met as near as that allows.

Defined results: null texts have size 0 and are taken 0 times; null is a source of its own, last in order. Repeated rows may differ in
copies. Texts of any length count whole. Of other columns, whatever their names, nothing is read; a key
column named like a result column comes back as key_<name>. An empty table gives an empty
result. The outcome depends on the rows alone, not on their partitions, so reruns agree.

Work is split by rows, never by source: documents are numbered in ranges of (source, size, key), so neither a hot source nor a hot size meets
in one task. A source's histogram (one row for each length that occurs) is the largest thing that is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialise, n_words, numbered, own_name, table

#: Weights of the sources in order, repeating; the share of all sizes that the mix has; the most copies of a document.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: How near the dual comes to each target, as a share of it; Newton steps between two looks at that; documents that make up for rounding.
NEAR, STEPS, FLIPS = 1e-10, 3, 3


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target): shares by weight; above most * source_size the excess is shared anew until none is."""
    rows = numbered(sizes, [F.col("source").asc_nulls_last()], "nth")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = materialise(rows.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap")), "mix-weights")
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, full = None, -1
    while True:  # the sources that are full only become more, so this ends
        is_full = F.lit(False) if level is None else F.col("cap") < level * F.col("weight")
        r = rows.agg(F.count_if(is_full).alias("full"), F.sum(F.when(is_full, F.col("cap"))).alias("caps"), F.sum(F.when(~is_full, F.col("weight"))).alias("rest")).first()
        if r["full"] == full or not r["rest"]:
            break
        level, full = (total - (r["caps"] or 0)) / r["rest"], r["full"]
    target = F.col("cap").cast("double") if level is None else F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def rate(size: Column, scale: Column, lam: Column, most: int = MOST) -> Column:
    return F.lit(float(most)) / (1.0 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), lam * size / scale))))


def _step(hist: DataFrame, state: DataFrame, most: int, bisect: bool) -> DataFrame:
    """The next multipliers. A source that is near enough keeps its own and is done."""
    h = hist.alias("h").join(state.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")))
    r = rate(F.col("h.size"), F.col("s.scale"), F.col("s.lam"), most)
    tokens = (F.col("h.size") * F.col("h.n")).cast("decimal(20,0)")
    exact = lambda x, kind: F.sum(tokens * x.cast(kind)).cast("double")
    sums = h.groupBy(*[F.col(f"s.{c}").alias(c) for c in ("source", "target", "scale", "lam", "lo", "hi", "done")]).agg(
        exact(r, "decimal(16,14)").alias("got"), exact(r * (1 - r / most) * F.col("h.size") / F.col("s.scale"), "decimal(17,9)").alias("slope")
    )
    lam, got, target = F.col("lam"), F.col("got"), F.col("target")
    low, high = F.when(got < target, lam).otherwise(F.col("lo")), F.when(got < target, F.col("hi")).otherwise(lam)
    room = 4 + 3 * F.abs(lam)
    newton = lam + F.greatest(-room, F.least(room, (target - got) / F.greatest("slope", F.lit(1e-300))))
    middle = (low + high) / 2
    bounded = F.abs(middle) < float("inf")
    new = F.when(bounded & (F.lit(bisect) | (newton < low) | (newton > high)), middle).otherwise(newton)
    done = F.col("done") | (F.abs(got - target) <= NEAR * target) | (high - low <= 1e-15 * F.abs(lam))
    return sums.select("source", "target", "scale", F.when(done, lam).otherwise(new).alias("lam"), low.alias("lo"), high.alias("hi"), done.alias("done"))


def multipliers(hist: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """(source, scale, lam) that solve the dual, for all sources at once. hist: (source, size, n). Sources taken whole `most` times have null as lam."""
    size = F.sum((F.col("size") * F.col("n")).cast("decimal(38,0)")).cast("double")
    state = hist.groupBy("source").agg((size / F.sum("n")).alias("scale")).alias("m")
    state = state.join(goal.alias("g"), F.col("m.source").eqNullSafe(F.col("g.source"))).select(F.col("m.source").alias("source"), "source_size", "target", "scale")
    full = F.col("target") >= most * F.col("source_size")
    whole = state.filter(full).select("source", "scale", F.lit(None).cast("double").alias("lam"))
    state = state.filter(~full).select("source", "target", "scale", F.lit(0.0).alias("lam"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(False).alias("done"))
    n, old = 0, None
    while True:  # Newton takes about six steps; after twelve, every third halves the bracket
        for _ in range(STEPS):
            n += 1
            state = _step(hist, state, most, n > 12 and n % 3 == 0)
        state = materialise(state, "mix-newton")
        if old is not None:
            drop(old)
        old = state
        if not state.filter(~F.col("done")).head(1):
            return state.select("source", "scale", "lam").unionByName(whole)


def rounded(hist: DataFrame, found: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """(source, size, n, whole, extra): of n documents each is copied whole times, extra of them once more."""
    cells = hist.alias("h").join(found.alias("f"), F.col("h.source").eqNullSafe(F.col("f.source")))
    r = F.when(F.col("lam").isNull(), F.lit(float(most))).otherwise(rate(F.col("size"), F.col("scale"), F.col("lam"), most))
    cells = cells.select(F.col("h.source").alias("source"), "size", "n", F.least(F.floor(r), F.lit(most)).alias("whole"), r.alias("r"))
    part = F.col("n").cast("decimal(20,0)") * (F.col("r") - F.col("whole")).cast("decimal(12,9)")
    run = Window.partitionBy("source").orderBy("size")
    upto = F.sum(part.cast("decimal(32,9)")).over(run.rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.withColumn("upto", F.floor(upto + F.lit("0.5").cast("decimal(2,1)")).cast("long"))
    extra = F.col("upto") - F.coalesce(F.lag("upto").over(run), F.lit(0).cast("long"))
    cells = materialise(cells.select("source", "size", "n", "whole", F.greatest(F.lit(0), F.least("n", extra)).cast("long").alias("extra")), "mix-cells")
    for _ in range(FLIPS):
        got = cells.groupBy("source").agg(F.sum(((F.col("n") * F.col("whole") + F.col("extra")) * F.col("size")).cast("decimal(38,0)")).cast("double").alias("got"))
        off = got.alias("a").join(goal.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(F.col("a.source").alias("os"), (F.col("target") - F.col("got")).alias("off"))
        one = cells.join(off, F.col("source").eqNullSafe(F.col("os")))
        # A document of size z brings the source nearer if z < 2 * |off|.
        open_ = F.when(F.col("off") > 0, (F.col("extra") < F.col("n")) & (F.col("whole") < most)).otherwise(F.col("extra") > 0)
        one = one.filter((F.col("size") < 2 * F.abs("off")) & open_)
        best = one.groupBy(F.col("source").alias("os")).agg(F.min(F.struct(F.abs(F.abs("off") - F.col("size")).alias("by"), "size", F.signum("off").cast("long").alias("change"))).alias("b"))
        best = best.select("os", F.col("b.size").alias("oz"), F.col("b.change").alias("change"))
        cells = cells.join(best, F.col("source").eqNullSafe(F.col("os")) & (F.col("size") == F.col("oz")), "left")
        cells = materialise(cells.select("source", "size", "n", "whole", (F.col("extra") + F.coalesce("change", F.lit(0).cast("long"))).alias("extra")), "mix-cells")
    return cells


def balance(docs: DataFrame, key: str, size: Column, source: str, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row for each document: the key, size, source_size, target (of its source), copies, taken (words)."""
    rows = docs.select(F.col(key).alias("k"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"), F.col(source).alias("source"))
    # Repeated rows are alike, so any order among them will do; the random number only deals them out.
    rows = materialise(rows.withColumn("any", F.rand(1)), "mix-rows")
    placed = numbered(rows, [F.col(c).asc_nulls_last() for c in ("source", "size", "k", "any")], "nth")
    hist = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-hist")
    sums = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = materialise(targets(sums, weights, share, most), "mix-goal")
    worded = hist.filter("size > 0")
    cells = rounded(worded, multipliers(worded, goal, most), goal, most)
    # Where in the order the documents of one source and size begin.
    first = placed.groupBy("source", "size").agg(F.min("nth").alias("first")).alias("p")
    join = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    known = first.join(goal.alias("g"), join("p", "g")).join(cells.alias("c"), join("p", "c") & (F.col("p.size") == F.col("c.size")), "left")
    known = materialise(known.select(F.col("p.source").alias("cs"), F.col("p.size").alias("cz"), "first", "source_size", "target", "n", "whole", "extra"), "mix-known")
    known = F.broadcast(known) if known.count() <= 200_000 else known
    full = placed.join(known, F.col("source").eqNullSafe(F.col("cs")) & (F.col("size") == F.col("cz")))
    # extra of n documents, evenly.
    upto = lambda i: F.expr(f"cast(nth - first + {i} as decimal(19,0)) * cast(extra as decimal(18,0)) div n")
    copies = F.coalesce(F.col("whole") + upto(1) - upto(0), F.lit(0)).cast("long")
    return full.select(F.col("k").alias(own_name(key, ["size", "source_size", "target", "copies", "taken"])), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op9_mixing(spark, sf_dir):
    return balance(table(spark, sf_dir, "documents"), "doc_id", n_words("text"), "source").select("doc_id", "size", "source_size", "target", "taken")
