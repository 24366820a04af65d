"""Jobs over awkward inputs: a tag named osm_id, regions whose types differ, raw elements to layers."""

from pyspark.sql import functions as F

from pistespark.operators import features
from pistespark.plans import jobs
from pistespark.sources import readers

from test_assembly import ELEMENT, square

NAMES = "ordinal long, {0} string, parts array<array<array<struct<lat:double,lon:double>>>>"


def raw(spark):
    line = square(10, 45, 2, 100)
    rows = [("node", i, lat, lon, None, None, None, None) for i, lat, lon in line[:-1]]
    rows += [("way", 1, None, None, [v[0] for v in line[:3]], None, None, None), ("way", 2, None, None, [v[0] for v in line[2:]], None, None, None), ("way", 3, None, None, [100, 101], None, None, {"aerialway": "gondola", "osm_id": "77"})]
    rows += [("relation", 9, None, None, None, [("way", 2, "outer"), ("way", 1, "outer")], None, {"landuse": "winter_sports", "name": "A", "osm_id": "no"}), ("relation", 8, None, None, None, [("way", 1, "outer")], None, {"landuse": "winter_sports"})]
    df = spark.createDataFrame(rows, ELEMENT + ", tags map<string,string>")
    return df.withColumns({"ordinal": F.col("osm_id"), "tags": F.coalesce("tags", F.create_map().cast("map<string,string>"))})


def test_raw_elements_to_a_region(spark, tmp_path):
    elements = jobs.resolved(raw(spark))
    layers = {(r["osm_type"], r["osm_id"]): r["layer"] for r in features.layered(elements).collect()}
    assert layers["relation", 9] == "multipolygons" and layers["relation", 8] is None and layers["way", 3] == "lines" and layers["node", 100] == "points"
    none = [spark.createDataFrame([], NAMES.format(c)) for c in ("country", "state")]
    done = jobs.region(spark, elements, *none, str(tmp_path / "r"), 300_000.0)
    assert {k: v for k, v in done.items() if v not in (None, "skipped")} == {}
    (row,) = readers.analyzed_csv(spark, str(tmp_path / "r" / "ski_areas_analyzed.csv")).collect()
    assert (row["winter_sports_id"], row["winter_sports_type"], row["name"], row["total_lifts"]) == (9, "relation", "A", 1)


def test_regions_with_other_types(spark, tmp_path):
    spark.sql("SELECT 1 AS winter_sports_id, 'a' AS name, 3 AS total_lifts").write.parquet(str(tmp_path / "x" / "ski_areas_analyzed.parquet"))
    spark.sql("SELECT '2' AS winter_sports_id, 'b' AS name, 4.5D AS total_area_ha").write.parquet(str(tmp_path / "y y" / "ski_areas_analyzed.parquet"))
    spark.sql("SELECT 9 AS winter_sports_id").write.parquet(str(tmp_path / "combined" / "ski_areas_analyzed.parquet"))
    df = readers.regional(spark, str(tmp_path), "ski_areas_analyzed")
    assert dict(df.dtypes)["winter_sports_id"] == "bigint"
    assert sorted((r["region"], r["winter_sports_id"], r["total_lifts"], r["total_area_ha"]) for r in df.collect()) == [("x", 1, 3, None), ("y y", 2, None, 4.5)]
    spark.sql("SELECT 1 AS n, 'a' AS s").write.parquet(str(tmp_path / "x" / "lifts.parquet"))
    spark.sql("SELECT 2.5D AS n, 7 AS s").write.parquet(str(tmp_path / "y y" / "lifts.parquet"))
    assert sorted(tuple(r) for r in readers.regional(spark, str(tmp_path), "lifts").select("region", "n", "s").collect()) == [("x", 1.0, "a"), ("y y", 2.5, "7")]
