"""Files that arrive between two runs of the same stream."""

import json

from cellplane.streaming.ingest import appended, arriving


def feature(i, **tags):
    return json.dumps({"type": "Feature", "properties": {"id": str(i), **tags}, "geometry": {"type": "LineString", "coordinates": [[i, 0], [i, 5]]}})


def test_files_are_read_once(spark, tmp_path):
    folder, store, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.geojsonseq").write_text("\x1e" + feature(1, highway="motorway") + "\n\n" + feature(2, highway="motorway", tunnel="yes") + "\n")
    appended(arriving(spark, folder), store, checkpoint).awaitTermination(120)
    assert [(r.layer, r.attrs["id"]) for r in spark.read.parquet(store).collect()] == [("road_motorway_trunk", "1")]
    (tmp_path / "in" / "b.geojsonseq").write_text(feature(3, railway="rail") + "\n")
    for _ in range(2):
        appended(arriving(spark, folder), store, checkpoint).awaitTermination(120)
    assert sorted((r.layer, r.attrs["id"]) for r in spark.read.parquet(store).collect()) == [("rail_main", "3"), ("road_motorway_trunk", "1")]
