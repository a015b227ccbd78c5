"""Tables that cut a plan: written to the folder that driver and executors share, and read again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session (as in tests) gets a folder of its own; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cellplane-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """df as a written Parquet table: what follows neither runs df anew nor depends on executors that held it. It goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cellplane/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def register(spark: SparkSession, path: str) -> None:
    """Has a path that was written by other means go when the driver ends."""
    _written.append((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Deletes materialised tables of which no reader is left; other frames are let be."""
    gone = {path for t in tables if (path := getattr(t, "scratch_path", None))}
    for spark, path in [w for w in _written if w[1] in gone]:
        _written.remove((spark, path))
        _delete(spark, path)


def forget() -> None:
    """Deletes the tables written so far."""
    while _written:
        _delete(*_written.pop())


atexit.register(forget)
