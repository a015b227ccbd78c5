"""Registries of vector sources: where a dataset lies, how it is read, which of its features count, and the pass that reads them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellplane.functions.predicates import columns_of, select_buckets
from cellplane.operators.spatial import bounds

# Fixed value: the country's box in the working projection; features that reach beyond it are shifted artefacts.
COUNTRY = (100_000.0, 250_000.0, 700_000.0, 600_000.0)


@dataclass(frozen=True)
class Dataset:
    """One delivered dataset: its key, province, the columns it must be read with, and a reader of (attributes, rings)."""

    key: str
    province: str
    columns: tuple[str, ...]
    read: Callable[[], DataFrame] | None = None


@dataclass(frozen=True)
class ZoneSource:
    """Official zones of one authority: features count whose field starts with one of the prefixes."""

    key: str
    province: str
    read: Callable[[], DataFrame]
    field: str | None = None
    prefixes: tuple[str, ...] = ()


def sources_for(sources: Iterable[dict], datasets: dict[str, Dataset], dataset: str, bucket: str | None = None, provinces: set[str] | None = None) -> list[dict]:
    """The selections of a dataset, of a bucket and of some provinces if asked."""
    if provinces is not None and datasets[dataset].province not in provinces:
        return []
    return [s for s in sources if s["dataset"] == dataset and bucket in (None, s["bucket"])]


def dataset_columns(sources: Iterable[dict], datasets: dict[str, Dataset], dataset: str) -> list[str]:
    """All columns that a dataset must be read with: its own, then those that only selections name."""
    own = list(datasets[dataset].columns)
    return own + [c for c in columns_of([s for s in sources if s["dataset"] == dataset]) if c not in own]


def present(rings: Column) -> Column:
    """Whether there is a geometry at all."""
    return rings.isNotNull() & (F.size(rings) > 0) & (F.size(F.get(rings, 0)) > 0)


def within(rings: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether all of a geometry lies in a box, its edges included."""
    b = bounds(rings)
    return (b["minx"] >= box[0]) & (b["miny"] >= box[1]) & (b["maxx"] <= box[2]) & (b["maxy"] <= box[3])


def meets(rings: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a geometry's bounds meet a box."""
    b = bounds(rings)
    return (b["minx"] <= box[2]) & (b["maxx"] >= box[0]) & (b["miny"] <= box[3]) & (b["maxy"] >= box[1])


def cleaned(df: DataFrame, columns: list[str], box: tuple[float, float, float, float] = COUNTRY, projected: Callable[[Column], Column] | None = None) -> DataFrame:
    """What a registry reads of a dataset: the asked columns and rings, without empty geometries, projected, inside the box only."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns {missing} missing; available: {sorted(df.columns)}")
    rings = F.col("rings") if projected is None else projected(F.col("rings"))
    return df.filter(present(F.col("rings"))).select(*columns, rings.alias("rings")).filter(within(F.col("rings"), box))


def layer(df: DataFrame, where: Column | None = None, columns: list[str] | None = None, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A vector layer cut to a condition, to some columns (rings stay) and to the features whose bounds meet a box."""
    out = df if where is None else df.filter(where)
    out = out if box is None else out.filter(meets(F.col("rings"), box))
    return out if columns is None else out.select(*columns, "rings")


def bucketed(df: DataFrame, sources: Iterable[dict], datasets: dict[str, Dataset], dataset: str) -> DataFrame:
    """The features of a dataset with bucket, category and source of every selection they match, in one pass."""
    own = sources_for(sources, datasets, dataset)
    rows = cleaned(df, dataset_columns(own, datasets, dataset))
    return select_buckets(rows, own, ["key", "bucket", "category"]).withColumn("province", F.lit(datasets[dataset].province))


def zone_features(df: DataFrame, source: ZoneSource) -> DataFrame:
    """The features of a source that are zones. A filter whose column is missing is an error: without it other zones would mix in."""
    if source.field is None:
        return df
    if not source.prefixes:
        raise ValueError(f"{source.key} names a field but no prefixes")
    if source.field not in df.columns:
        raise KeyError(f"{source.key} expects {source.field}; available: {sorted(df.columns)}")
    value, keep = F.coalesce(F.col(source.field).cast("string"), F.lit("")), F.lit(False)
    for p in source.prefixes:
        keep = keep | value.startswith(p)
    return df.filter(keep)


def zones(sources: Iterable[ZoneSource], enabled: bool = True) -> DataFrame | None:
    """(key, province, rings) of all sources that can be read. A missing file leaves its source out; nothing at all is None."""
    out = None
    for source in sources if enabled else ():
        try:
            df = source.read()
        except FileNotFoundError:
            continue
        except AnalysisException as missing:  # what Spark's own readers raise
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        one = zone_features(df, source).filter(present(F.col("rings"))).select(F.lit(source.key).alias("key"), F.lit(source.province).alias("province"), "rings")
        out = one if out is None else out.unionByName(one)
    return out
