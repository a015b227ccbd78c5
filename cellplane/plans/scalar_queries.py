"""Queries over attributes: predicates, parsers, summaries, votes, rankings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cellplane.functions import scalars as S
from cellplane.functions.predicates import matches, select_buckets
from cellplane.plans.placed import read

CODE = "CASE l_linenumber % 7 WHEN 0 THEN 'FIG0' || cast(40 + l_linenumber AS VARCHAR(9)) WHEN 1 THEN '41' WHEN 2 THEN ' 52.0' WHEN 3 THEN 'fig071' WHEN 4 THEN 'abc' WHEN 5 THEN '' ELSE '66' END"
CATEGORY = "CASE l_returnflag WHEN 'A' THEN 'Bauflaeche begruent' WHEN 'R' THEN 'Garten (historisch)' ELSE 'Wald' END"
SELECTIONS = [
    {"bucket": "wohn", "category": "gross", "match": [{"col": "p_type", "startswith": ("LARGE", "ECONOMY")}, {"col": "p_size", "values": list(range(10, 40))}]},
    {"bucket": "gruen", "category": "messing", "match": [{"col": "p_type", "contains": "(?i)brass$"}]},
    {"bucket": "gruen", "category": "marke", "match": [{"col": "p_brand", "values": ["Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#34"]}]},
    {"bucket": "industrie", "category": "blech", "match": [{"col": "p_type", "contains": "^(?:STANDARD|PROMO) (?!.*TIN)"}, {"col": "p_size", "values": list(range(1, 50, 3))}]},
]


def ns_kind(s, d):
    rows = read(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{CODE} AS code", f"{CATEGORY} AS cat")
    return rows.select("l_orderkey", "l_linenumber", S.normal_code(F.col("code")).alias("code"), S.category_base(F.col("cat")).alias("category"), S.land_use_kind(F.col("code"), F.when(F.col("l_linenumber") % 2 == 0, F.col("cat"))).alias("kind"))


_NS = f"""SELECT l_orderkey, l_linenumber, CASE WHEN trim(code) = '' THEN NULL WHEN try_cast(bare AS DOUBLE) IS NOT NULL THEN cast(cast(trunc(try_cast(bare AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE bare END AS code,
  trim(regexp_replace(cat, '\\s*\\(historisch\\)\\s*', ' ')) AS category,
  CASE WHEN num IN ('41', '66') OR (l_linenumber % 2 = 0 AND lower(cat) LIKE 'bauflaeche%') THEN 'building' WHEN num IN ('52', '71') OR (l_linenumber % 2 = 0 AND lower(cat) LIKE 'garten%') THEN 'garden' END AS kind
 FROM (SELECT *, CASE WHEN try_cast(up AS DOUBLE) IS NOT NULL THEN cast(cast(trunc(try_cast(up AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE up END AS num FROM (
  SELECT *, regexp_replace(upper(trim(code)), '^FIG', '') AS up, CASE WHEN upper(trim(code)) LIKE 'FIG%' THEN substr(trim(code), 4) ELSE trim(code) END AS bare
  FROM (SELECT l_orderkey, l_linenumber, {CODE} AS code, {CATEGORY} AS cat FROM lineitem)))"""

VOLTS = "CASE l_linenumber % 5 WHEN 0 THEN '110000;20000' WHEN 1 THEN '380000,110000' WHEN 2 THEN '400' WHEN 3 THEN 'medium; 30500' ELSE NULL END"
POWER = "CASE l_linenumber % 6 WHEN 0 THEN '2 MW' WHEN 1 THEN '1500 kW' WHEN 2 THEN '0,5 gw' WHEN 3 THEN '800' WHEN 4 THEN 'yes' ELSE '3 hp' END"
TUNNEL = "CASE l_linenumber % 5 WHEN 0 THEN ' No' WHEN 1 THEN 'yes' WHEN 2 THEN NULL WHEN 3 THEN 'FALSE ' ELSE 'building_passage' END"


def lines(s, d, text, name):
    return read(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{text} AS {name}")


def voltage_tokens(s, d):
    rows = lines(s, d, VOLTS, "v").select("l_orderkey", "l_linenumber", S.voltages_kv(F.col("v")).alias("kv"))
    return rows.select("l_orderkey", "l_linenumber", F.array_join(F.transform("kv", lambda x: x.cast("string")), ";").alias("kv"), F.arrays_overlap("kv", F.array(F.lit(110), F.lit(380))).alias("high"))


def bucket_selection(s, d):
    return select_buckets(read(s, d, "part").select("p_partkey", "p_type", "p_size", "p_brand"), SELECTIONS, ["bucket", "category"]).select("p_partkey", "bucket", "category")


_PICKS = ["(p_type LIKE 'LARGE%' OR p_type LIKE 'ECONOMY%') AND p_size BETWEEN 10 AND 39", "regexp_matches(p_type, '(?i)brass$')", "p_brand IN ('Brand#11','Brand#12','Brand#13','Brand#21','Brand#34')", "(p_type LIKE 'STANDARD %' OR p_type LIKE 'PROMO %') AND NOT contains(substr(p_type, instr(p_type, ' ') + 1), 'TIN') AND p_size % 3 = 1 AND p_size < 50"]
_BUCKETS = " UNION ALL ".join(f"SELECT p_partkey, '{x['bucket']}' AS bucket, '{x['category']}' AS category FROM part WHERE {w}" for x, w in zip(SELECTIONS, _PICKS, strict=True))


def summary(s, d):
    """Counts and sums by several sets of keys in one pass."""
    rows = read(s, d, "lineitem").selectExpr("l_returnflag", "l_linestatus", "year(l_shipdate) AS year", "l_quantity")
    return s.sql("""SELECT l_returnflag, l_linestatus, year, count(*) AS n, cast(sum(l_quantity) AS DOUBLE) AS quantity, cast(grouping(l_returnflag) * 4 + grouping(l_linestatus) * 2 + grouping(year) AS INT) AS grain
      FROM {rows} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag, year), (year), ())""", rows=rows)


_SUMMARY = """SELECT l_returnflag, l_linestatus, year::INTEGER AS year, count(*) AS n, sum(l_quantity)::DOUBLE AS quantity, (grouping(l_returnflag) * 4 + grouping(l_linestatus) * 2 + grouping(year))::INTEGER AS grain
  FROM (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, l_quantity FROM lineitem) GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag, year), (year), ())"""


def majority(s, d):
    """The commonest event type of each user, the first by name on ties, and whether there were several."""
    votes = read(s, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("m"), "event_type")).alias("w")
    return votes.groupBy("user_id").agg(first, F.count("*").alias("kinds")).select("user_id", F.col("w.event_type").alias("winner"), (-F.col("w.m")).alias("votes"), (F.col("kinds") > 1).alias("ambiguous"))


def hotspot(s, d):
    """Where most of a part brand's lines go; ties to the lowest supplier nation."""
    rows = read(s, d, "lineitem").join(read(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_returnflag", "s_nationkey").agg(F.count("*").alias("n"))
    return rows.groupBy("l_returnflag").agg(F.max_by("s_nationkey", F.struct("n", -F.col("s_nationkey"))).alias("nation"), F.max("n").alias("n"))


def bounds(s, d):
    rows = read(s, d, "customer").selectExpr("c_nationkey", "(c_custkey * 37) % 1000 AS x", "(c_custkey * 91) % 1000 AS y")
    return rows.groupBy("c_nationkey").agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"))


def part_index(s, d):
    """Ids with a part suffix where a feature has several parts."""
    one = Window.partitionBy("conv_id")
    rows = read(s, d, "conversations").withColumn("i", F.row_number().over(one.orderBy("turn"))).withColumn("k", F.count("*").over(one))
    return rows.select("conv_id", "turn", F.when(F.col("k") > 1, F.concat(F.col("conv_id").cast("string"), F.lit(":part"), F.col("i").cast("string"))).otherwise(F.col("conv_id").cast("string")).alias("id"))


def combo_summary(s, d):
    rows = read(s, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"), F.median("o_totalprice").alias("mid"), F.avg("o_totalprice").alias("mean"), F.countDistinct("o_custkey").alias("customers"), F.expr("bool_or(o_totalprice > 300000)").alias("some"), F.expr("bool_and(o_totalprice > 1000)").alias("every"))
    return rows.select("o_orderstatus", "n", F.round("total", 2).alias("total"), F.round("mid", 2).alias("mid"), F.round("mean", 4).alias("mean"), "customers", "some", "every")


def notes(s, d):
    """Distinct notes of each user, in order of their first event."""
    first = read(s, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("at"))
    return first.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "event_type"))), lambda x: x["event_type"]), " | ").alias("notes"))


def colours(s, d):
    """Percent values as red, green, blue, alpha; 0 is transparent."""
    rows = read(s, d, "part").select("p_partkey", (F.col("p_size") * 2).alias("v"))
    alpha = F.when(F.col("v") > 0, F.rint(F.col("v") * 2.55).cast("int")).otherwise(0)
    return rows.select("p_partkey", F.when(F.col("v") > 0, 200).otherwise(0).alias("red"), F.when(F.col("v") > 0, 30).otherwise(0).alias("green"), alpha.alias("alpha"))


_TR = "p_name"
for _a, _b in S.UMLAUTS.items():
    _TR = f"replace({_TR}, '{_a}', '{_b}')"

QUERIES = {
    "ns_kind": (ns_kind, _NS),
    "voltage_tokens": (voltage_tokens, f"""SELECT l_orderkey, l_linenumber, array_to_string(kv, ';') AS kv, list_has_any(kv, [110, 380]) AS high FROM (SELECT l_orderkey, l_linenumber,
        list_sort(list_distinct([round_even(x / 1000, 0)::INTEGER FOR x IN [try_cast(trim(t) AS DOUBLE) FOR t IN string_split(replace(coalesce({VOLTS}, ''), ',', ';'), ';')] IF x >= 1000])) AS kv FROM lineitem)"""),
    "power_parse": (lambda s, d: lines(s, d, POWER, "p").select("l_orderkey", "l_linenumber", S.power_kw(F.col("p")).alias("kw")),
        f"SELECT l_orderkey, l_linenumber, (CASE l_linenumber % 6 WHEN 0 THEN 2000.0 WHEN 1 THEN 1500.0 WHEN 2 THEN 500000.0 WHEN 3 THEN 0.8 END)::DOUBLE AS kw FROM lineitem"),
    "tunnel_filter": (lambda s, d: lines(s, d, TUNNEL, "t").filter(S.not_tunnel(F.col("t"))).groupBy("l_linenumber").agg(F.count("*").alias("n")),
        f"SELECT l_linenumber, count(*) AS n FROM (SELECT l_linenumber, {TUNNEL} AS t FROM lineitem) WHERE trim(lower(coalesce(t, ''))) IN ('', 'no', 'false', '0') GROUP BY l_linenumber"),
    "transliterate": (lambda s, d: read(s, d, "documents").select("doc_id", S.transliterated(F.col("text")).alias("plain")), "SELECT doc_id, " + _TR.replace("p_name", "text") + " AS plain FROM documents"),
    "display_names": (lambda s, d: s.createDataFrame([(S.PROVINCES[i],) for i in range(9)], "name string").select(S.transliterated(F.col("name")).alias("plain")).withColumn("name", S.display_province(F.col("plain"))),
        "SELECT * FROM (VALUES ('Burgenland', 'Burgenland'), ('Kaernten', 'Kärnten'), ('Niederoesterreich', 'Niederösterreich'), ('Oberoesterreich', 'Oberösterreich'), ('Salzburg', 'Salzburg'), ('Steiermark', 'Steiermark'), ('Tirol', 'Tirol'), ('Vorarlberg', 'Vorarlberg'), ('Wien', 'Wien')) t(plain, name)"),
    "predicate_startswith": (lambda s, d: (p := read(s, d, "part")).filter(matches({"match": [{"col": "p_type", "startswith": ("SMALL", "MEDIUM")}]}, p.columns)).select("p_partkey", "p_type"), "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'SMALL%' OR p_type LIKE 'MEDIUM%'"),
    "predicate_regex": (lambda s, d: (p := read(s, d, "documents")).filter(matches({"match": [{"col": "text", "contains": r"(?i)\blicense\b"}, {"col": "lang", "values": ["en", "de"]}]}, p.columns)).select("doc_id", "lang"), r"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(?i)\blicense\b') AND lang IN ('en', 'de')"),
    "bucket_selection": (bucket_selection, _BUCKETS),
    "summary_grouping_sets": (summary, _SUMMARY),
    "majority_vote_ambiguity": (majority, "SELECT user_id, event_type AS winner, n AS votes, kinds > 1 AS ambiguous FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r, count(*) OVER (PARTITION BY user_id) AS kinds FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)) WHERE r = 1"),
    "dominant_group_mode": (lambda s, d: read(s, d, "orders").groupBy("o_custkey").agg(F.mode("o_orderpriority", True).alias("priority")), "SELECT o_custkey, o_orderpriority AS priority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)) WHERE r = 1"),
    "hotspot_argmax": (hotspot, "SELECT l_returnflag, s_nationkey AS nation, n FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, s_nationkey) AS r FROM (SELECT l_returnflag, s_nationkey, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)) WHERE r = 1"),
    "bounds_by_group": (bounds, "SELECT c_nationkey, min((c_custkey * 37) % 1000) AS minx, min((c_custkey * 91) % 1000) AS miny, max((c_custkey * 37) % 1000) AS maxx, max((c_custkey * 91) % 1000) AS maxy FROM customer GROUP BY c_nationkey"),
    "topk_area": (lambda s, d: read(s, d, "supplier").orderBy(F.col("s_acctbal").desc(), "s_suppkey").limit(6).select("s_suppkey", "s_acctbal"), "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 6"),
    "part_index": (part_index, "SELECT conv_id, turn, CASE WHEN count(*) OVER (PARTITION BY conv_id) > 1 THEN conv_id::VARCHAR || ':part' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) ELSE conv_id::VARCHAR END AS id FROM conversations"),
    "combo_summary": (combo_summary, "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(median(o_totalprice), 2) AS mid, round(avg(o_totalprice), 4) AS mean, count(DISTINCT o_custkey) AS customers, bool_or(o_totalprice > 300000) AS some, bool_and(o_totalprice > 1000) AS every FROM orders GROUP BY o_orderstatus"),
    "ordered_notes": (notes, "SELECT user_id, string_agg(event_type, ' | ' ORDER BY first_id) AS notes FROM (SELECT user_id, event_type, min(event_id) AS first_id FROM events GROUP BY ALL) GROUP BY user_id"),
    "colourise": (colours, "SELECT p_partkey, CASE WHEN p_size > 0 THEN 200 ELSE 0 END AS red, CASE WHEN p_size > 0 THEN 30 ELSE 0 END AS green, CASE WHEN p_size > 0 THEN round_even(p_size * 2 * 2.55::DOUBLE, 0)::INTEGER ELSE 0 END AS alpha FROM part"),
    "json_props": (lambda s, d: read(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k")), "SELECT event_id, (props ->> '$.k')::INTEGER AS k FROM events"),
    "field_coercion": (lambda s, d: read(s, d, "lineitem").selectExpr("l_returnflag", "CASE WHEN l_linenumber = 3 THEN '#' ELSE cast(l_partkey AS STRING) END AS x").groupBy("l_returnflag").agg(F.count_if(S.number_or_null(F.col("x")).isNull()).alias("dropped"), F.sum(S.number_or_null(F.col("x"))).alias("kept")),
        "SELECT l_returnflag, count(*) FILTER (l_linenumber = 3) AS dropped, sum(CASE WHEN l_linenumber <> 3 THEN l_partkey END)::DOUBLE AS kept FROM lineitem GROUP BY l_returnflag"),
}
