"""Operator 8: URL filters by association rules, in DataFrame and Spark ML operations only.

Tokens of a url: scheme, host labels and host suffixes, path segments without numbers, file suffix, query keys, fragment. FP-growth over
the tokens of labelled pages, with a class token for bad ones, finds the combinations that go with them; rules below the
support or the confidence go. A page is blocked if all tokens of some rule occur in its url: rules stand in an inverted index
under their rarest token, so a page meets only rules of which it has that one. Stated rules come before mined ones, the longest
that fits first.

The least confidence of 0.4 is meant against a share of bad pages of about a quarter among the labelled ones: a rule must make a
page 1.6 times as likely to be bad. Where it is more, raise it: it is a parameter.

Defined results: a null url, or one without "://", has an empty host and path and the verdict "allow". Repeated rows are judged
once and returned as often as they occur. Of rules of equal confidence the one of the greatest rule_id is named. Urls of any length are taken
whole. Without labels there are no mined rules. A key column named like a result column comes back as key_<name>; other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, own_name, partitions, table

#: Stated rules: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BAD = "class=bad"
#: Repeats of a row that come back at once.
LOT = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first "://", else an empty text."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def stated(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    tagged = lambda tag, xs: F.transform(xs, lambda x: F.concat(F.lit(tag), x))
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.concat(F.lit("suffix="), F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), n), ".")))
    segments = F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike(r"^\d+(\.\w+)?$"))
    keys = F.filter(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)"), 1), lambda x: x != "")
    flags = F.array(
        F.concat(F.lit("scheme="), F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(\w*)://", 1))),
        F.concat(F.lit("file="), F.regexp_extract(path, r"\.(\w+)$", 1)),
        F.concat(F.lit("fragment="), (F.instr(F.coalesce(url, F.lit("")), "#") > 0).cast("string")),
    )
    return F.array_distinct(F.concat(tagged("label=", labels), suffixes, tagged("path=", segments), tagged("key=", keys), flags))


def mine(labelled: DataFrame, support: float = 0.005, confidence: float = 0.4) -> DataFrame:
    """Rules (rule_id, items, confidence, support) whose consequent is BAD. labelled: items (array), without repeats."""
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=partitions(labelled.sparkSession)).fit(labelled)
    # Only rules for the one class are wanted: a set with it and the same set without it meet in one group.
    sets = model.freqItemsets.select(F.array_sort(F.array_remove("items", BAD)).alias("items"), F.array_contains("items", BAD).alias("bad"), "freq").filter(F.size("items") > 0)
    counts = sets.groupBy("items").agg(F.max(F.when(F.col("bad"), F.col("freq"))).alias("hits"), F.max(F.when(~F.col("bad"), F.col("freq"))).alias("n"))
    rules = counts.filter(F.col("hits") / F.col("n") >= confidence)
    share = F.col("hits") / F.lit(float(max(1, labelled.count())))
    return materialise(rules.select(F.xxhash64("items").alias("rule_id"), "items", (F.col("hits") / F.col("n")).alias("confidence"), share.alias("support")), "url-rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (page, items) whose items contain a rule's: (page, confidence, rule_id), the surest rule of each."""
    freq = urls.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    rare = rules.select("rule_id", "items", "confidence", F.explode("items").alias("item")).join(freq, "item", "left")
    first = Window.partitionBy("rule_id").orderBy(F.coalesce("n", F.lit(0)), "item")
    index = materialise(rare.withColumn("r", F.row_number().over(first)).filter("r = 1").select("item", F.col("items").alias("need"), "rule_id", "confidence"), "url-index")
    index = F.broadcast(index) if index.limit(50_001).count() <= 50_000 else index
    met = urls.select("page", "items", F.explode("items").alias("item")).join(index, "item").filter(F.size(F.array_except("need", "items")) == 0)
    return met.groupBy("page").agg(F.max(F.struct("confidence", "rule_id")).alias("best")).select("page", "best.confidence", "best.rule_id")


def judge(pages: DataFrame, key: str, url: str, labelled: DataFrame, rules=RULES, support: float = 0.005, confidence: float = 0.4) -> DataFrame:
    """The key, host, path, rule, verdict, mined_rule and its confidence for each page. labelled: (url, bad boolean)."""
    seen = labelled.select(tokens(F.col("url")).alias("items"), "bad")
    mined = mine(seen.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items")), support, confidence)
    once = pages.groupBy(F.col(key).alias("k"), F.col(url).alias("u")).agg(F.count("*").alias("times"))
    once = materialise(once.withColumn("id", F.xxhash64("k", "u")), "url-pages")
    hits = matched(once.filter(F.instr(F.coalesce("u", F.lit("")), "://") > 0).select(F.struct("id", "k", "u").alias("page"), tokens(F.col("u")).alias("items")), mined)
    hits = hits.select(F.col("page.id").alias("id"), F.col("page.k").alias("hk"), F.col("page.u").alias("hu"), "confidence", F.col("rule_id").alias("mined_rule"))
    out = once.join(hits, (once["id"] == hits["id"]) & F.col("k").eqNullSafe(F.col("hk")) & F.col("u").eqNullSafe(F.col("hu")), "left")
    rule, verdict = stated(host_of(F.col("u")), path_of(F.col("u")), rules)
    final = F.coalesce(verdict, F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    out = out.select(F.col("k").alias(own_name(key, ["host", "path", "rule", "verdict", "mined_rule", "confidence"])), host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"), rule.alias("rule"), final.alias("verdict"), "mined_rule", "confidence", "times")
    # A row that repeats often comes back in lots, so that no array grows with its repeats.
    lots = out.withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / LOT))))
    size = F.least(F.lit(LOT).cast("long"), F.col("times") - F.col("__lot") * LOT)
    return lots.withColumn("__t", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("__t", "__lot", "times")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of pages whose path ends in the id of a labelled document; bad: low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), r"(\d{1,18})(?:\.\w+)?/?$", 1)
    numbered = pages.select("url", number.alias("n")).select("url", F.expr("try_cast(n as long)").alias("doc_id"))
    marks = labels.groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return numbered.filter("doc_id is not null").join(marks, "doc_id").select("url", (F.col("bad") == 1).alias("bad"))


def op8_url_filters(spark, sf_dir):
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    return judge(pages, "page_id", "url", labelled_pages(pages, labels)).select("page_id", "host", "path", "rule", "verdict")
