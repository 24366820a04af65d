"""GeoParquet: footers, other readers, no file of a failed write, fewer row groups for a smaller box."""

import json
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.sources import readers, sinks

RING = "array<struct<lat:double,lon:double>>"


def table(spark, n=4000):
    point = "array(named_struct('lat', CAST(id % 60 AS DOUBLE), 'lon', CAST(id % 170 AS DOUBLE)))"
    return spark.range(n).selectExpr("id", f"{point} AS geometry", f"CAST(null AS array<array<{RING}>>) AS parts", "map('k', CAST(id AS STRING)) AS tags").repartition(3)


def files(path):
    return sorted(path.glob("*.parquet"))


def test_footer_and_other_readers(spark, tmp_path):
    out = tmp_path / "t"
    sinks.geoparquet(table(spark), str(out))
    assert (out / "_SUCCESS").exists() and not list(out.glob("_staging*"))
    seen, total = [1e9, 1e9, -1e9, -1e9], 0
    for f in files(out):
        data = pq.read_table(f)
        meta = json.loads(pq.read_schema(f).metadata[b"geo"] if b"geo" in (pq.read_schema(f).metadata or {}) else pq.ParquetFile(f).metadata.metadata[b"geo"])
        assert meta["version"] == "1.1.0" and meta["primary_column"] == "geometry"
        column = meta["columns"]["geometry"]
        assert column["encoding"] == "WKB" and column["geometry_types"] == ["Point"] and column["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
        at = [struct.unpack(">dd", g[5:]) for g in data.column("geometry").to_pylist()]
        assert column["bbox"] == [min(x for x, _ in at), min(y for _, y in at), max(x for x, _ in at), max(y for _, y in at)]
        seen = [min(seen[0], column["bbox"][0]), min(seen[1], column["bbox"][1]), max(seen[2], column["bbox"][2]), max(seen[3], column["bbox"][3])]
        total += data.num_rows
    assert total == 4000 and seen == [0, 0, 169, 59]
    back = readers.geoparquet(spark, str(out))
    assert back.count() == 4000 and back.filter("geometry[0].lat = id % 60 AND geometry[0].lon = id % 170 AND tags = concat('{\"k\":\"', id, '\"}')").count() == 4000
    decoded = readers.geoparquet(spark, str(out)).select("id", geo.vertices_of_wkb(F.col("wkb")).alias("v"), "geometry")
    assert decoded.filter("v = geometry").count() == 4000


def test_overwrite_append_and_no_rows(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.geoparquet(table(spark, 50), out)
    sinks.geoparquet(table(spark, 20), out)
    assert readers.geoparquet(spark, out).count() == 20
    sinks.geoparquet(table(spark, 5), out, mode="append")
    assert readers.geoparquet(spark, out).count() == 25
    sinks.geoparquet(table(spark, 0), out)
    assert readers.geoparquet(spark, out).count() == 0 and "bbox" in readers.geoparquet(spark, out).columns


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    out = tmp_path / "t"
    sinks.geoparquet(table(spark, 30), str(out))
    bad = table(spark, 2000).withColumn("x", F.expr("IF(id = 1999, raise_error('lost'), 1)"))
    with pytest.raises(Exception, match="lost"):
        sinks.geoparquet(bad, str(out))
    assert readers.geoparquet(spark, str(out)).count() == 30 and not list(out.glob("_staging*"))


def test_polygons_with_holes(spark, tmp_path):
    ring = "array(named_struct('lat', {0}D, 'lon', {0}D), named_struct('lat', {0}D, 'lon', {1}D), named_struct('lat', {1}D, 'lon', {1}D), named_struct('lat', {0}D, 'lon', {0}D))"
    a, b = ring.format("0.0", "9.0"), ring.format("1.0", "2.0")
    df = spark.sql(f"SELECT 1 id, {a} geometry, array(array({a}, {b})) parts UNION ALL SELECT 2, {a}, array(array({a}), array({b}))")
    sinks.geoparquet(df, str(tmp_path / "p"))
    got = {r["id"]: bytes(r["wkb"]) for r in readers.geoparquet(spark, str(tmp_path / "p")).collect()}
    assert struct.unpack(">BIII", got[1][:13]) == (0, 3, 2, 4) and len(got[1]) == 9 + 2 * (4 + 64)
    assert struct.unpack(">BIIBII", got[2][:18]) == (0, 6, 2, 0, 3, 1) and len(got[2]) == 9 + 2 * (9 + 4 + 64)


def test_box_and_order(spark, tmp_path):
    line = "array(named_struct('lat', 0D, 'lon', 0D), named_struct('lat', 10D, 'lon', 10D))"
    ring = "array(named_struct('lat', -9D, 'lon', -9D), named_struct('lat', -9D, 'lon', 9D), named_struct('lat', 9D, 'lon', 9D), named_struct('lat', 9D, 'lon', -9D), named_struct('lat', -9D, 'lon', -9D))"
    df = spark.sql(f"SELECT {line} line, {ring} ring")
    ask = lambda c, *box: df.select(geo.meets_box(F.col(c), *box)).first()[0]
    assert ask("line", 4, 4, 5, 5) and not ask("line", 6, 1, 9, 4) and ask("line", 0, 0, 0, 0) and not ask("line", 11, 11, 12, 12)
    assert ask("ring", 1, 1, 2, 2) and ask("ring", -20, -20, 20, 20) and not ask("ring", 9.5, 9.5, 10, 10)
    grid = spark.range(64).selectExpr("CAST(id DIV 8 AS DOUBLE) * 22.5 - 90 + 1 AS lat", "CAST(id % 8 AS DOUBLE) * 45 - 180 + 1 AS lon").select("lat", "lon", geo.hilbert(F.col("lat"), F.col("lon"), 3).alias("h")).orderBy("h").collect()
    assert [r["h"] for r in grid] == list(range(64))
    assert all(abs(a["lat"] - b["lat"]) / 22.5 + abs(a["lon"] - b["lon"]) / 45 == 1 for a, b in zip(grid, grid[1:], strict=False))
