"""Feature files that arrive one by one: what is new goes into the layer store once, however often the stream is started again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellplane.functions import selectors
from cellplane.sources.files import features_of, with_class

#: Tags that become columns, for the selectors.
TAGS = ("tunnel", "landuse", "military", "boundary", "leisure", "protect_class", "protection_title", "name")


def arriving(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """A stream of the features (attrs, shape) of a folder of GeoJSON sequences; every file is read once."""
    return features_of(spark.readStream.option("maxFilesPerTrigger", files_at_once).text(folder))


def tagged(features: DataFrame) -> DataFrame:
    """Features with their class and tags as columns, once for each layer they belong to."""
    kind = F.col("shape.kind").alias("kind")
    wide = with_class(features).select("attrs", "shape", "fclass", "type", kind, *[F.col("attrs")[t].alias(t) for t in TAGS])
    return selectors.layers(wide).select("layer", "attrs", "shape", "fclass", "type")


def appended(features: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Writes all that has arrived to a store partitioned by layer, then stops. The checkpoint remembers what is in."""
    return tagged(features).writeStream.format("parquet").partitionBy("layer").option("checkpointLocation", checkpoint).option("path", store).trigger(availableNow=True).start()
