"""GeoParquet with a covering box: written along a space-filling curve, so that filters by place skip files and row groups.

The writer is a data source of its own, because the footer of each file must carry the `geo` entry (encoding, bounds, which columns cover the geometry). Tasks write
whole row groups from Arrow batches into a folder beside the target, and the files are moved when all tasks are done; a task that is run again writes another file,
and only files of tasks that were committed count. Paths may be anything that Arrow's file systems open.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cellplane.operators import spatial
from cellplane.sources.shapes import decoded, encoded

FORMAT, BOX = "covered_geoparquet", "bbox"
SIDES = ("xmin", "ymin", "xmax", "ymax")
BITS = 16
#: Masks that spread the bits of a number of 16 bits to every other place.
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def curve(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> Column:
    """Place along the Z curve (32 bits) of points within bounds."""

    def spread(c: Column, lo: float, hi: float) -> Column:
        step = max(hi - lo, 1e-9) / ((1 << BITS) - 1)
        v = F.least(F.greatest(F.floor((c - lo) / step), F.lit(0)), F.lit((1 << BITS) - 1)).cast("long")
        for shift, mask in SPREAD:
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return v

    return spread(x, bounds[0], bounds[2]).bitwiseOR(F.shiftleft(spread(y, bounds[1], bounds[3]), 1))


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.geo, self.rows, self.overwrite = options["path"].rstrip("/"), options["geo"], int(options["rows"]), overwrite
        self.run = uuid.uuid4().hex

    def _at(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path.replace("file:///", "file:/").replace("file:/", "file:///", 1))
        return fs.LocalFileSystem(), self.path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = self._at()
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{self.run}.parquet"
        system.create_dir(f"{path}/_{self.run}", recursive=True)
        out, held, n, total = None, [], 0, 0

        def group() -> None:
            nonlocal out, held, n
            t = pa.Table.from_batches(held)
            if out is None:
                out = pq.ParquetWriter(f"{path}/_{self.run}/{name}", t.schema.with_metadata({b"geo": self.geo.encode()}), filesystem=system, compression="zstd")
            out.write_table(t, row_group_size=max(n, 1))
            held, n = [], 0

        for batch in iterator:
            while len(batch):
                part = batch.slice(0, self.rows - n)
                held.append(part)
                n, total, batch = n + len(part), total + len(part), batch.slice(len(part))
                if n == self.rows:
                    group()
        if n:
            group()
        if out is None:
            return Written("", 0)
        out.close()
        return Written(name, total)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = self._at()
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(path)):
                if f.type == fs.FileType.File:
                    system.delete_file(f.path)
        for m in messages:
            if m and m.file:
                system.move(f"{path}/_{self.run}/{m.file}", f"{path}/{m.file}")
        self._clear(system, path)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*self._at())

    def _clear(self, system: fs.FileSystem, path: str) -> None:
        if system.get_file_info(f"{path}/_{self.run}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/_{self.run}")


class CoveredGeoParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)


def write_geoparquet(shapes: DataFrame, path: str, geometry: str = "geometry", crs: str | None = None, row_group: int = 20_000, files: int | None = None) -> None:
    """Shapes (…, kind, rings) as GeoParquet at path, which must hold nothing else. Null shapes go too, with a null box."""
    spark = shapes.sparkSession
    spark.dataSource.register(CoveredGeoParquet)
    box = spatial.bounds(F.col("rings"))
    boxed = shapes.withColumn("__b", F.when(F.size("rings") > 0, box))
    boxed = boxed.withColumn(BOX, F.struct(*[F.col(f"__b.{c}").alias(n) for c, n in zip(("minx", "miny", "maxx", "maxy"), SIDES, strict=True)])).drop("__b")
    whole = boxed.agg(*[(F.min if n.endswith("min") else F.max)(f"{BOX}.{n}").alias(n) for n in SIDES], F.collect_set("kind").alias("kinds"), F.count("*").alias("n")).first()
    bounds = [float(whole[n]) if whole[n] is not None else 0.0 for n in SIDES]
    names = {"point": ["Point", "MultiPoint"], "line": ["LineString", "MultiLineString"], "polygon": ["Polygon", "MultiPolygon"]}
    column = {"encoding": "WKB", "geometry_types": sorted(t for k in whole["kinds"] for t in names[k]), "bbox": bounds, "covering": {"bbox": {n: [BOX, n] for n in SIDES}}}
    geo = {"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column | ({"crs": crs} if crs else {})}}
    key = curve((F.col(f"{BOX}.xmin") + F.col(f"{BOX}.xmax")) / 2, (F.col(f"{BOX}.ymin") + F.col(f"{BOX}.ymax")) / 2, tuple(bounds))
    files = files or max(1, -(-whole["n"] // (row_group * 8)))
    ordered = boxed.withColumn("__z", key).repartitionByRange(files, "__z").sortWithinPartitions("__z").drop("__z")
    encoded(ordered, geometry).write.format(FORMAT).option("geo", json.dumps(geo)).option("rows", row_group).mode("append").save(path)


def read_covered(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, columns: list[str] | None = None, geometry: str = "geometry") -> DataFrame:
    """Shapes whose box meets a box (minx, miny, maxx, maxy): the test goes to the scan, which skips row groups and reads only the columns asked for."""
    df = spark.read.parquet(path)
    if box is not None:
        b = lambda n: F.col(f"{BOX}.{n}")
        df = df.filter((b("xmin") <= box[2]) & (b("xmax") >= box[0]) & (b("ymin") <= box[3]) & (b("ymax") >= box[1]))
    keep = [c for c in (columns if columns is not None else df.columns) if c not in (geometry, BOX)]
    return decoded(df.select(*keep, geometry), geometry)
