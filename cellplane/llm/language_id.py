"""Operator 5: language identification by Bayesian fusion of evidence.

The posterior of a language is the product of
- the text's likelihood: naive Bayes over hashed byte trigrams, learned by grouped counts over all documents of a declared language.
  Trigrams overlap, so a text counts as at most `most` independent ones;
- the likelihood of the declared markup language, from how often texts of a language declare it;
- the likelihood of the address suffix, likewise;
- the host's prior: its language counts, smoothed towards its suffix's, those towards the whole table's.
Counts of suffixes, hosts and declarations go by the language that the text alone suggests.

A document is rejected if its text has no letters to judge by, or if no language reaches `sure`.

Defined results: null texts are empty; missing evidence is evidence of its own ("none"), null hosts share one prior. Without any
declared language nothing can be learned, and all are rejected. Of languages with equal posteriors the first by name is taken. Repeated rows
are judged alike; texts of any length are taken whole. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, bounded_batches, table
from .features import trigrams
from .words import blocks

BITS, MOST, SURE, KAPPA = 12, 60.0, 0.5, 20.0
#: Scores of a batch, and of a table that is sent to all executors.
SCORES, SENT = 1 << 20, 6_400_000
COUNTS = pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("n", pa.int64())])


def tag(code: Column) -> Column:
    """The first part of a language tag, in lower case; "none" if there is none."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(F.coalesce(code, F.lit("")), r"^\s*([A-Za-z]{2,8})", 1)), F.lit("")), F.lit("none"))


def count(batches):
    """Trigram counts of each declared language, one row a feature, for all rows of the task."""
    total: dict[str, np.ndarray] = {}
    rows = ((t.as_py() or b"", lang) for b in batches for t, lang in zip(b.column("text"), b.column("declared").to_pylist(), strict=True))
    for block in blocks(rows):
        grams = trigrams([t for t, _ in block], BITS, fold=True)
        langs = np.array([lang for _, lang in block])
        for lang in set(langs) - {"none"}:
            total[lang] = total.get(lang, 0) + grams[langs == lang].sum(axis=0)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], schema=COUNTS)


def score(logs: np.ndarray, most: float):
    def run(batches):
        for b in batches:
            keys = b.column("row").to_pylist()
            rows = ((t.as_py() or b"", k) for t, k in zip(b.column("text"), keys, strict=True))
            for block in blocks(rows):
                grams = trigrams([t for t, _ in block], BITS, fold=True)
                counts, some = grams.sum(axis=1), max(1, SCORES // logs.shape[0])
                for i in range(0, len(block), some):
                    n = counts[i : i + some]
                    lls = (grams[i : i + some].astype(np.float32) @ logs.T).astype(np.float64) * (np.minimum(n, most) / np.maximum(n, 1))[:, None]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * logs.shape[0]), pa.array(lls.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([k for _, k in block[i : i + some]], b.schema.field("row").type), pa.array(n.astype(np.int64)), lists], names=["row", "n", "lls"])

    return run


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities of features, from (text, declared). Every declared language is known."""
    counts = docs.select("text", "declared").mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "lang-counts")
    known = sorted(r.lang for r in counts.select("lang").distinct().collect())
    table_, place = np.zeros((len(known), 1 << BITS)), {lang: i for i, lang in enumerate(known)}
    for r in counts.toLocalIterator():
        table_[place[r.lang], r.feature] = r.n
    # Tokens a language was hardly seen with are smoothed towards all languages' share.
    whole = table_.sum(axis=0) + 0.5
    smooth = table_ + 200.0 * whole / whole.sum()
    return known, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def smoothed(rows: DataFrame, by: str, langs: int) -> DataFrame:
    """Counts (by, c: array by language) of the languages that texts suggest."""
    found = rows.groupBy(by, "guess").agg(F.count("*").cast("double").alias("c")).groupBy(by)
    found = found.agg(F.map_from_entries(F.collect_list(F.when(F.col("guess").isNotNull(), F.struct(F.col("guess").cast("int"), "c")))).alias("of"))
    return found.select(by, F.transform(F.sequence(F.lit(0), F.lit(langs - 1)), lambda i: F.coalesce(F.try_element_at("of", i), F.lit(0.0))).alias("c"))


def shares(c: Column, prior: Column, kappa: float = KAPPA) -> Column:
    total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(c, prior, lambda x, p: (x + kappa * p) / (total + kappa))


def fused(rows: DataFrame, langs: list[str], sure: float) -> DataFrame:
    """rows (…, n, lls, declared, suffix, host) with lang_id, confidence and kept."""
    m = len(langs)
    lit = lambda xs: F.split(F.lit(" ".join(repr(float(x)) for x in xs)), " ").cast("array<double>")
    rows = rows.withColumn("guess", F.when(F.col("n") > 0, F.array_position("lls", F.array_max("lls")) - 1))
    base = np.ones(m)
    for r in rows.filter("guess is not null").groupBy("guess").count().collect():
        base[int(r.guess)] += r["count"]
    whole = lit(base / base.sum())
    most = min(100_000, SENT // m)
    small = lambda df: F.broadcast(df) if df.limit(most + 1).count() <= most else df
    by_suffix = materialise(smoothed(rows, "suffix", m), "lang-suffix")
    by_host = smoothed(rows, "host", m)
    host_suffix = rows.groupBy("host").agg(F.min("suffix").alias("hs"))
    by_host = by_host.join(host_suffix, "host").join(small(by_suffix.select(F.col("suffix").alias("hs"), F.col("c").alias("sc"))), "hs")
    by_host = materialise(by_host.select("host", shares(F.col("c"), shares(F.col("sc"), whole)).alias("prior")), "lang-host")
    declared = smoothed(rows, "declared", m).withColumnRenamed("c", "dc")
    # P(declared | language) and P(suffix | language), smoothed by one count for each value seen.
    declared = materialise(declared, "lang-declared")
    n_declared, n_suffix = max(1, declared.count()), max(1, by_suffix.count())
    given = lambda c, k: F.zip_with(c, lit(base), lambda x, b: F.log((x + 1.0) / (b + float(k))))
    rows = rows.join(small(declared.select("declared", given(F.col("dc"), n_declared).alias("ld"))), "declared")
    rows = rows.join(small(by_suffix.select("suffix", given(F.col("c"), n_suffix).alias("ls"))), "suffix")
    rows = rows.join(small(by_host), "host")
    logs = F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.get("lls", i) + F.get("ld", i) + F.get("ls", i) + F.log(F.get("prior", i)))
    rows = rows.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    total = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    best = F.get(F.split(F.lit(" ".join(langs)), " "), F.array_position("logs", F.col("top")).cast("int") - 1)
    rows = rows.withColumn("confidence", 1 / total)
    return rows.withColumn("lang_id", F.when(F.col("n") > 0, best)).withColumn("kept", (F.col("n") > 0) & (F.col("confidence") >= sure))


def identify(docs: DataFrame, row: str, text: str, declared: str, evidence: DataFrame | None = None, host: str | None = None, on: str = "row", most: float = MOST, sure: float = SURE) -> DataFrame:
    """(row, declared, suffix, host, n, lang_id, confidence, kept) for each row of docs.

    row: the column that comes back. evidence: (id, page_lang, page_host), at most one row for an id; on: where in row the id is.
    """
    docs = docs.select(F.col(row).alias("row"), F.col(text).cast("binary").alias("text"), tag(F.col(declared)).alias("declared"), (F.col(host) if host else F.lit(None).cast("string")).alias("host"))
    bounded_batches(docs.sparkSession)
    langs, logs = learn(docs)
    if not langs:
        return docs.select("row", "declared", F.lit("none").alias("suffix"), F.coalesce("host", F.lit("none")).alias("host"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("lang_id"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    side = docs.withColumn("row", F.struct("row", "declared", "host")).select("row", "text")
    rows = side.mapInArrow(score(logs, most), f"row {side.schema['row'].dataType.simpleString()}, n long, lls array<double>").select("row.*", "n", "lls")
    if evidence is not None:
        rows = rows.join(evidence, F.col(on) == F.col("id"), "left").withColumns({"declared": F.when(tag(F.col("page_lang")) != "none", tag(F.col("page_lang"))).otherwise(F.col("declared")), "host": F.coalesce("page_host", "host")})
    known = F.coalesce(F.nullif("host", F.lit("")), F.lit("none"))
    suffix = F.coalesce(F.nullif(F.regexp_extract(known, r"\.([^.]+)$", 1), F.lit("")), F.lit("none"))
    rows = materialise(rows.select("row", "declared", suffix.alias("suffix"), known.alias("host"), "n", "lls"), "lang-scored")
    return fused(rows, langs, sure).select("row", "declared", "suffix", "host", "n", "lang_id", "confidence", "kept")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(id, page_lang, page_host) of the documents that pages show: a page's path ends in the document's id; the first page counts."""
    url = F.coalesce("url", F.lit(""))
    number = F.regexp_extract(url, r"://[^/?#]*[^?#]*?(\d{1,18})(?:\.\w+)?/?(?:[?#].*)?$", 1)
    lang = F.regexp_extract(F.coalesce("html", F.lit("")), r'(?i)<html[^>]*?\blang\s*=\s*["\']?([A-Za-z-]+)', 1)
    host = F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1))
    seen = pages.select(F.expr("page_id"), number.alias("number"), lang.alias("page_lang"), host.alias("page_host")).select(F.expr("try_cast(number as long)").alias("id"), "page_id", "page_lang", "page_host")
    one = seen.filter("id is not null").groupBy("id").agg(F.min(F.struct("page_id", "page_lang", "page_host")).alias("p"))
    return one.select("id", "p.page_lang", "p.page_host")


def op5_language_id(spark, sf_dir):
    out = identify(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", page_evidence(table(spark, sf_dir, "pages")), "source")
    return out.select(F.col("row").alias("doc_id"), "declared", "suffix", "host", F.col("n").alias("n_grams"), "lang_id", F.round("confidence", 6).alias("confidence"), "kept")
