"""Operator 2: canonical exact fingerprints, in DataFrame operations only.

A text is brought to Unicode form NFKC and folded in case (both by the ICU library that Spark ships, called inside the JVM), each run of
white space becomes one blank, and the ends are trimmed. The fingerprint is a 128-bit xxhash of the outcome as 32 hex digits.
Hashes that occur twice or more are checked byte by byte: where the canonical texts of one differ, theirs get the
SHA-256 of the canonical text appended, so equal fingerprints mean equal canonical texts. As a digest is equal or not, the
likeness of two fingerprints is 1 or 0.

Defined results: null texts count as empty. Texts of any length are taken whole. Rows with equal keys are ordered by the hash of their text,
highest first. The next document of the last one is the first; of a single document it is itself. Null keys come last. Columns of any
names pass through; one that is named like the result is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialise, numbered, partitions, table

#: White space after NFKC: ASCII's, the separators U+001C to U+001F, next line, and the Unicode classes Zs, Zl, Zp.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
#: Bounds of ranges that are looked through at once.
FINE = 64


def canonical(text: Column) -> Column:
    text = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(text, F.lit("")), F.lit(True))
    text = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), text, F.lit(True))
    return F.trim(F.regexp_replace(text, SPACE, " "))


def wide(canon: Column, bits: int = 64) -> Column:
    """128 bits of xxhash as hex; fewer bits a half only to provoke collisions in tests."""
    half = lambda h: F.lpad(F.lower(F.hex(h if bits == 64 else F.pmod(h, F.lit(1 << bits)))), 16, "0")
    return F.concat(half(F.xxhash64(canon)), half(F.xxhash64(F.lit(1), canon)))


def conflicts(hashes: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Hashes (column w) that different canonical texts share, or None. texts: (w, c) of the texts whose hashes are in a table (w)."""
    twice = materialise(hashes.groupBy("w").count().filter("count > 1").select("w"), "fp-twice")
    few = F.broadcast(twice) if twice.count() <= 500_000 else twice
    # Partial least and greatest texts: a task sends one of each for a hash, however many copies it has.
    ends = texts(few).groupBy("w").agg(F.min("c").alias("least"), F.max("c").alias("most"))
    out = materialise(ends.filter("least <> most").select("w"), "fp-conflicts")
    drop(twice)
    return out if out.head(1) else None


def settled(df: DataFrame, w: str, digest: Column, name: str, clash: DataFrame | None) -> DataFrame:
    """df with the fingerprint as a column: the hash w, and the digest behind it where texts clash."""
    if clash is None:
        return df.withColumn(name, F.col(w))
    df = df.join(clash.select(F.col("w").alias("clashing")), F.col(w) == F.col("clashing"), "left")
    return df.withColumn(name, F.when(F.col("clashing").isNotNull(), F.concat(w, F.lit("-"), digest)).otherwise(F.col(w))).drop("clashing")


def fingerprint(df: DataFrame, text: str, name: str = "fingerprint", bits: int = 64) -> DataFrame:
    """df with the fingerprint of its text column; equal fingerprints mean equal canonical texts."""
    hashed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != name]).alias("row"), canonical(F.col(text)).alias("c")).select("row", "c", wide(F.col("c"), bits).alias("w"))
    clash = conflicts(hashed.select("w"), lambda few: hashed.select("c", "w").join(few, "w"))
    return settled(hashed, "w", F.sha2("c", 256), "found", clash).select("row.*", F.col("found").alias(name))


def with_next(docs: DataFrame, key: str, carried: list[str], tie: str) -> DataFrame:
    """docs with next_<column> of the document next in descending order of key and tie (whole numbers), the first after the last.

    Ranges of as many documents each are cut at places of the order, so it does not matter how the keys lie. A range's first
    document also goes to the range before it, as a guest behind its last.
    """
    spark = docs.sparkSession
    lowest = F.lit(-(1 << 63)).cast("long")
    own = F.struct(F.coalesce(F.col(key).cast("long"), lowest).alias("k"), F.col(tie).cast("long").alias("t"))
    places = numbered(docs.select(own.alias("own")), [F.col("own").desc()], "nth")
    n = places.count()
    if not n:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    step = max(16, -(-n // (16 * partitions(spark))))
    bounds = sorted({(r.own.k, r.own.t) for r in places.filter(F.col("nth") % step == 0).collect()}, reverse=True)
    array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    listed = lambda xs: F.arrays_zip(array([k for k, _ in xs]).alias("k"), array([t for _, t in xs]).alias("t"))
    # The number of bounds at or above a document, found in two steps.
    above = lambda xs: F.size(F.filter(xs, lambda b: b >= F.col("own")))
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("own"))
    docs = docs.withColumn("coarse", (above(listed(bounds[::FINE])) - 1) * FINE)
    docs = docs.withColumn("range", F.col("coarse") + above(F.slice(listed(bounds), F.col("coarse") + 1, F.lit(FINE))) - 1)
    first = F.get(listed(bounds), F.col("range")) == F.col("own")
    guest = F.when(first, F.pmod(F.col("range") - 1, F.lit(len(bounds))))
    places_ = F.array(F.struct(F.col("range").alias("r"), F.lit(0).alias("g")), F.struct(guest.alias("r"), F.lit(1).alias("g")))
    docs = docs.select("row", "own", F.explode(F.filter(places_, lambda p: p["r"].isNotNull())).alias("at"))
    order = Window.partitionBy("at.r").orderBy("at.g", F.col("own").desc())
    out = docs.select("row", "at", *[F.lead(F.col(f"row.`{c}`")).over(order).alias(f"next_{c}") for c in carried])
    return out.filter("at.g = 0").select("row.*", *[f"next_{c}" for c in carried])


def op2_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))

    def edited(df):
        """Edited texts of (text, next_text)."""
        third = F.floor(F.length("text") / 3).cast("int")
        return F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third))

    # Each text is moved once: what follows works on hashes, and goes back to texts only where hashes meet.
    # The likeness to an edited or a next text compares the canonical bytes themselves.
    pairs = with_next(docs, "doc_id", ["text", "doc_id", "tie"], "tie")
    pairs = pairs.withColumns({"edited": edited(pairs), "c": canonical(F.col("text"))}).withColumn("ce", canonical(F.col("edited")))
    pairs = pairs.select(
        "doc_id", "tie", "next_doc_id", "next_tie", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        wide(F.col("c")).alias("w"), wide(F.col("ce")).alias("we"), (F.col("c") == F.col("ce")).cast("double").alias("near_edited"),
        F.sha2("c", 256).alias("digest"), F.sha2("ce", 256).alias("edited_digest"),
    )
    pairs = materialise(pairs, "fp-pairs")
    # The next document's hash, by key and text hash: rows alike in both are alike in all.
    nexts = pairs.select(F.col("doc_id").alias("next_doc_id"), F.col("tie").alias("next_tie"), F.col("w").alias("wn"), F.col("digest").alias("dn")).dropDuplicates(["next_doc_id", "next_tie"])

    def fetched(hits, by, name):
        """hits with the text of the document that its columns by name."""
        small = hits.count() <= 500_000
        wanted = hits.select(F.struct(*[F.col(x).alias(y) for x, y in zip(by, ("doc_id", "tie"), strict=True)]).alias("asked")).distinct()
        one = docs.select(F.struct("doc_id", "tie").alias("of"), F.col("text").alias(name))
        one = one.join(F.broadcast(wanted) if small else wanted, F.col("of").eqNullSafe(F.col("asked")), "left_semi").dropDuplicates(["of"])
        sent = small and "text" not in hits.columns  # numbers only: 500,000 rows of them are some MB; texts never go to all executors
        return one.join(F.broadcast(hits) if sent else hits, F.col("of").eqNullSafe(F.struct(*[F.col(x).alias(y) for x, y in zip(by, ("doc_id", "tie"), strict=True)]))).drop("of")

    def texts(few):
        own = materialise(pairs.join(few, "w").select("w", "doc_id", "tie"), "fp-hits")
        own = fetched(own, ("doc_id", "tie"), "text").select("w", canonical(F.col("text")).alias("c"))
        hits = materialise(pairs.filter("we <> w").join(few.withColumnRenamed("w", "we"), "we").select(F.col("we").alias("w"), "doc_id", "tie", "next_doc_id", "next_tie"), "fp-hits")
        if not hits.head(1):
            return own
        both = materialise(fetched(hits, ("doc_id", "tie"), "text"), "fp-hits")
        both = fetched(both, ("next_doc_id", "next_tie"), "next_text")
        return own.unionByName(both.select("w", canonical(edited(both)).alias("c")))

    clash = conflicts(pairs.select("w").unionByName(pairs.filter("we <> w").select(F.col("we").alias("w"))), texts)
    out = settled(settled(pairs, "w", F.col("digest"), "fingerprint", clash), "we", F.col("edited_digest"), "edited_fingerprint", clash)
    out = out.join(nexts, out["next_doc_id"].eqNullSafe(nexts["next_doc_id"]) & (out["next_tie"] == nexts["next_tie"]))
    same = (F.col("w") == F.col("wn")) & (F.col("digest") == F.col("dn"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", same.cast("double").alias("near_next"))
