"""Operator 12: licence wording by an exact set-similarity join, in DataFrame operations only.

Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. Base labels come from fixed phrases. The method finds text blocks that contain
a template: both are sets of tokens (pairs of words that follow each other), and a block meets a template if at least `percent` % of the template's tokens are
in it. Templates are put into classes by length, S words at most (S a power of 2, 8 at least); the blocks of a class are all windows of 2 S words that begin at multiples
of S, over the whole text, so wherever a template stands, a block holds all of it.

1. One pass over the texts keeps, for each document, the places of tokens that any template has; no other token can count.
2. Tokens are ordered by the number of documents that hold them, over all documents, rarest first.
3. Prefix filter: a block that meets a template of r tokens, o of them needed, holds one of its first r - o + 1. Documents and blocks without such a token leave.
4. Length filter: a block needs o tokens of any template. Positional filter: where the first common token is number i of the template and number j of the block,
   at most 1 + min(r - i - 1, b - j - 1) can be common. What passes is verified by counting the intersection.

The templates are a parameter of the program; their index, a row for each token of each template, is all that goes to every executor (`MOST` rows at most, else it is
joined by shuffle). A document's tokens are dealt out block by block, so no group is larger than a block.

Defined results: null texts count as empty and have no label and score 0. Rows are told apart by their number, so repeated rows and null keys each get their
own result. Only the key column and the results are returned, other columns do not matter; a key named like a result is returned as key_<name>. An
empty table gives an empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, own_name, table
from .license_templates import TEMPLATES

#: Phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PERCENT, MOST = 90, 50_000
RESULT = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), GAP), lambda w: w != "")


def pairs_of(text: str) -> list[str]:
    """Distinct tokens of a template, in order of their first place."""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:], strict=False)))


def class_of(text: str) -> int:
    """The class of a template: the least power of 2, from 8 on, that is not below its number of words."""
    n = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text))
    return max(8, 1 << (n - 1).bit_length())


def _places(found: Column, phrases: list[tuple[str, str]]) -> Column:
    """Where phrases stand: (at, label) for each place."""

    def of(phrase: str, label: str) -> Column:
        first, *rest = phrase.split()

        def place(w: Column, i: Column) -> Column:
            whole = reduce(and_, [F.get(found, i + k) == x for k, x in enumerate(rest, 1)], w == first)
            return F.when(whole, F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

        return F.filter(F.transform(found, place), lambda x: x.isNotNull())

    return F.concat(*[of(p, label) for p, label in phrases])


def marked(docs: DataFrame, key: str, text: str, tokens: list[str], phrases: list[tuple[str, str]]) -> DataFrame:
    """A written table of __row, key, n_words, base (at, label) and hits (at, token): the one pass over the texts."""
    firsts = sorted({t.split()[0] for t in tokens})
    found = docs.select(F.col(f"`{key}`").alias("key"), words(F.col(f"`{text}`")).alias("words"))
    starts = {p.split()[0] for p, _ in phrases}
    some = F.exists("words", lambda w: w.isin(sorted(starts)))
    pair = F.transform("words", lambda w, i: F.when(w.isin(firsts), F.struct(i.cast("long").alias("at"), F.concat(w, F.lit(" "), F.get(F.col("words"), i + 1)).alias("token"))))
    base = F.when(some, _places(F.col("words"), phrases)).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))
    out = found.select("key", F.size("words").cast("long").alias("n_words"), base.alias("base"), F.filter(pair, lambda x: x["token"].isin(tokens)).alias("hits"))
    return materialise(out.withColumn("__row", F.monotonically_increasing_id()), "license-hits")


def index(spark, templates: list[tuple[str, str]], percent: int, seen: DataFrame) -> DataFrame:
    """A row for each token of each template: template, label, class, token, rank (global, rarest first), place, size, need, prefix."""
    rows = [(n, label, class_of(text), t, len(pairs_of(text)), -(-percent * len(pairs_of(text)) // 100)) for n, (label, text) in enumerate(templates) for t in pairs_of(text)]
    kind = "array<struct<template int, label string, class int, token string, size int, need int>>"
    names = ("template", "label", "class", "token", "size", "need")
    listed = F.from_json(F.lit(json.dumps([dict(zip(names, r, strict=True)) for r in rows])), kind.replace(" int", ":int").replace(" string", ":string"))
    out = spark.range(1).select(F.inline(listed)).join(seen, "token", "left")
    order = Window.orderBy(F.coalesce("n_docs", F.lit(0)), "token")  # as many rows as the templates have tokens
    out = out.withColumn("rank", F.dense_rank().over(order)).withColumn("place", F.row_number().over(Window.partitionBy("template").orderBy("rank")) - 1)
    return materialise(out.withColumn("prefix", F.col("place") <= F.col("size") - F.col("need")).drop("n_docs"), "license-index")


def blocks_met(hits: DataFrame, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """(__row, class, block, template, label, common, size) of every block and template of its class that meet. hits: __row, hits."""
    spark = hits.sparkSession
    n_tokens = sum(len(pairs_of(text)) for _, text in templates)
    sent = F.broadcast if n_tokens <= MOST else (lambda df: df)
    seen = hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["token"]))).alias("token")).groupBy("token").agg(F.count("*").alias("n_docs"))
    idx = index(spark, templates, percent, seen)
    classes = idx.groupBy("token", "class", "rank").agg(F.max("prefix").alias("prefix"))
    least = idx.groupBy("class").agg(F.min("need").alias("least"))
    each = hits.select("__row", F.explode("hits").alias("h")).select("__row", "h.at", "h.token").join(sent(classes), "token")
    # The pair at place p lies in windows p // S and p // S - 1, but for the last word of the earlier one.
    b = F.floor(F.col("at") / F.col("class"))
    before = F.when((b > 0) & (F.col("at") - (b - 1) * F.col("class") <= 2 * F.col("class") - 2), b - 1)
    each = each.select("__row", "class", "rank", "prefix", F.explode(F.filter(F.array(b, before), lambda x: x.isNotNull())).alias("block"))
    block = each.groupBy("__row", "class", "block").agg(F.array_sort(F.collect_set("rank")).alias("ranks"), F.max("prefix").alias("any"))
    block = block.filter("any").join(F.broadcast(least), "class").filter(F.size("ranks") >= F.col("least"))
    lists = idx.groupBy("template", "label", "class", "size", "need").agg(F.array_sort(F.collect_list("rank")).alias("of"))
    probe = idx.filter("prefix").select("template", "rank", "place", F.col("class").alias("of_class"))
    met = block.select("__row", "class", "block", "ranks", F.explode("ranks").alias("rank")).join(sent(probe), ["rank"]).filter("class = of_class")
    first = met.groupBy("__row", "class", "block", "ranks", "template").agg(F.min(F.struct("place", "rank")).alias("first"))
    met = first.join(sent(lists), ["template", "class"])
    bound = 1 + F.least(F.col("size") - F.col("first.place") - 1, F.size("ranks") - F.array_position("ranks", F.col("first.rank")).cast("int"))
    met = met.filter((F.size("ranks") >= F.col("need")) & (bound >= F.col("need"))).withColumn("common", F.size(F.array_intersect("ranks", "of")))
    return met.filter("common >= need").select("__row", "class", "block", "template", "label", "common", "size")


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """A row for each document (key and results), and the blocks found: key, template (number), label, first_word, last_word, share."""
    tokens = sorted({t for _, text_ in templates for t in pairs_of(text_)})
    marks = marked(docs, key, text, tokens, phrases)
    found = materialise(blocks_met(marks.filter(F.size("hits") > 0).select("__row", "hits"), templates, percent), "license-blocks")
    labels = found.groupBy("__row").agg(F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("size")).alias("best"))
    out = marks.drop("hits").join(labels, "__row", "left")
    at, base = F.transform("base", lambda x: x["at"]), F.array_distinct(F.transform("base", lambda x: x["label"]))
    joined = lambda xs: F.concat_ws(",", F.array_sort(xs))
    name = own_name(key, RESULT)
    docs = out.select(
        F.col("key").alias(name), "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"), F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
    last = F.least((F.col("block") + 2) * F.col("class"), F.col("n_words")) - 1
    spans = found.join(marks.select("__row", F.col("key").alias(name), "n_words"), "__row").select(name, "template", "label", (F.col("block") * F.col("class")).alias("first_word"), last.alias("last_word"), (F.col("common") / F.col("size")).alias("share"))
    return docs, spans


def op12_license_scan(spark, sf_dir):
    """All documents: words, places of the phrases, labels of phrases and templates."""
    return license_scan(table(spark, sf_dir, "documents"))[0]


def _sql() -> str:
    """The same by comparing every block of every document with every template of its class."""
    quoted = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    rows = ",\n    ".join(f"({n}, '{label}', {class_of(text)}, {quoted(pairs_of(text))}, {-(-PERCENT * len(pairs_of(text)) // 100)})" for n, (label, text) in enumerate(TEMPLATES))
    places = " + ".join(
        f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f'''w[i + {k}] = '{x}' ''' for k, x in enumerate(p.split()))}), lambda i: {{'at': i - 1, 'label': '{label}'}})" for p, label in PHRASES
    ).replace(" + list_transform", " || list_transform")
    return rf"""
WITH templates(template, label, class, tokens, need) AS (VALUES
    {rows}),
split AS (SELECT doc_id, row_number() OVER () AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
based AS (SELECT doc_id, id, w, {places} AS base FROM split),
blocks AS (
    SELECT id, class, block, list_distinct(list_transform(range(block * class + 1, least((block + 2) * class, len(w))), lambda i: w[i] || ' ' || w[i + 1])) AS tokens
    FROM (SELECT id, w, class, unnest(range(0, len(w) // class + 1)) AS block FROM split, (SELECT DISTINCT class FROM templates))),
met AS (
    SELECT id, label, len(list_intersect(b.tokens, t.tokens)) AS common, len(t.tokens) AS size
    FROM blocks b JOIN templates t ON b.class = t.class WHERE len(list_intersect(b.tokens, t.tokens)) >= need),
found AS (SELECT id, list(DISTINCT label) AS more, max(common / size) AS best FROM met GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(base) AS BIGINT) AS n_base, list_min(list_transform(base, lambda x: x.at)) AS first_word, list_max(list_transform(base, lambda x: x.at)) AS last_word,
    array_to_string(list_sort(list_distinct(list_transform(base, lambda x: x.label))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_transform(base, lambda x: x.label) || coalesce(more, []))), ',') AS labels,
    CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM based LEFT JOIN found USING (id)
"""


SQL = _sql()
