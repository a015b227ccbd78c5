"""What the operators of this subpackage share: partition counts, word patterns, small helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellplane.scratch import drop, materialise

#: A word: a run of characters outside space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "bounded_batches", "drop", "materialise", "n_words", "numbered", "own_name", "partitions", "table", "without"]


def bounded_batches(spark: SparkSession) -> None:
    """Holds Arrow batches to 8 MB from here on, unless the session says otherwise: whole texts go to Python in them."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def own_name(key: str, taken: list[str]) -> str:
    """What a key column is called beside the result columns taken: its own name, or key_<name> where that is one of theirs."""
    return f"key_{key}" if key in taken else key


def n_words(text: Column | str) -> Column:
    """Number of words; null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, gone: DataFrame, on: list[str], most: int = 1_000_000) -> DataFrame:
    """Rows of df that do not occur in gone; a small gone is sent to the rows, else both are shuffled. Nulls equal nulls."""
    gone = materialise(gone.select(*[F.col(c).alias(f"__{c}") for c in on]).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= most else gone
    hit = F.lit(True)
    for c in on:
        hit = hit & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(gone, hit, "left_anti")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """A written table of df's rows with their place in the whole order (long, from 0), by one shuffle into ranges of the order.

    Rows that the order does not tell apart get places as they come. To keep many of them from meeting in one task, let order end in
    something that differs, such as a random number.
    """
    spark = df.sparkSession
    id_ = F.monotonically_increasing_id()  # partition number above bit 33, place in the partition below
    placed = materialise(df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("__id", id_), "numbered")
    part = F.shiftright("__id", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("__part", before.alias("__before"))  # a row for each partition: small
    out = placed.join(F.broadcast(counts), part == F.col("__part"))
    return out.withColumn(name, F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id", "__part", "__before")
