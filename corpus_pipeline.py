"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.llm.common import WORD, drop, materialise, n_words, numbered, without
from cellplane.llm.language_id import identify, page_evidence
from cellplane.llm.mixing import balance
from cellplane.llm.ngram_join import jaccard_components
from cellplane.llm.packing import length_buckets
from cellplane.llm.suffix_dedup import without_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay: rejected are those without letters and those of no sure language.

    Null and empty texts are rejected. Repeated rows are judged alike and stay as often as they occur; rows of one id are judged each by its
    own text. An empty table stays empty.
    """
    docs = docs.select(*COLUMNS).withColumn("__hash", F.xxhash64("text"))
    marked = docs.withColumn("__row", F.struct("doc_id", "__hash"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    judged = identify(marked, "__row", "text", "lang", page_evidence(pages), "source", on="row.doc_id")
    return without(docs, judged.filter(~F.col("kept")).select("row.*"), ["doc_id", "__hash"]).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least id stays, once.

    Rows that share an id are documents of their own: linked ones (repeated rows among them) leave one, others all stay. Of linked rows of one
    id the first by hash of the text stays. Documents without words, and rows without an id, are in no link and stay. An empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    often = materialise(ids.filter("n > 1").select("doc_id"), "stage-often")
    if often.head(1):
        # Rows of one id get keys beyond all ids.
        ends = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).first()
        free = ends.hi + 1 if ends.hi < 1 << 62 else ends.lo - ends.n
        some = docs.join(F.broadcast(often) if often.count() <= 1_000_000 else often, "doc_id", "left_semi").withColumn("__any", F.rand(1))
        some = numbered(some, [F.col("doc_id"), F.xxhash64("text"), F.col("__any")], "__key").drop("__any").withColumn("__key", F.col("__key") + free)
        some = materialise(some, "stage-often")
        docs = without(docs, often, ["doc_id"]).withColumn("__key", F.col("doc_id")).unionByName(some)
        own = some.select(F.col("__key").alias("__k"), F.col("doc_id").alias("__id"))
    else:
        docs = docs.withColumn("__key", F.col("doc_id"))
        own = often.select(F.col("doc_id").alias("__k"), F.col("doc_id").alias("__id"))
    linked = jaccard_components(docs.withColumnRenamed("__key", "key"), "key", "text").filter("key is not null and n_shingles > 0").select("key", "component_id")
    linked = linked.join(own, F.col("key") == F.col("__k"), "left").select("key", "component_id", F.coalesce("__id", "key").alias("id"))
    linked = materialise(linked, "stage-links")
    first = linked.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("least"))
    gone = linked.join(first, "component_id").filter("key <> least.key").select(F.col("key").alias("__key"))
    return without(docs, gone, ["__key"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that occur earlier go, in whole characters; documents of which no word is left go too.

    Documents come in the order of their ids, rows of one id in that of a hash of the text; rows that agree in both have equal results. Null
    and empty texts have no words and go. An empty table stays empty.
    """
    out = without_repeats(docs.select(*COLUMNS), "doc_id", "text", characters=True)
    out = out.withColumn("text", F.col("kept").cast("string")).filter(F.col("text").rlike(WORD))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    Null texts have no words and are never taken; null is a source of its own. Rows that agree in id and size are taken equally often. An
    empty table stays empty.
    """
    docs = docs.select(*COLUMNS).withColumn("__size", n_words("text"))
    copies = balance(docs, "doc_id", F.col("__size"), "source").filter("copies > 0")
    copies = copies.groupBy(F.col("doc_id").alias("__id"), F.col("size").alias("__words")).agg(F.min("copies").alias("__copies"))
    copies = materialise(copies, "stage-copies")
    copies = F.broadcast(copies) if copies.count() <= 500_000 else copies
    out = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__size") == F.col("__words")))
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every copy in the batches: doc_id, n_tokens, bucket_len, batch, slot.

    Null texts have length 0; a text longer than the budget is a batch of its own; copies and repeated rows have places of their own. An empty
    table gives an empty result.
    """
    return length_buckets(docs, "doc_id", n_words("text"))


STAGES = [("language", language), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("mixture", mixture), ("packed", packed)]

#: The first three stages are beyond SQL; tests compare the pipeline with a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialise(docs, f"stage{n + 1}")
            drop(before)
    return docs
