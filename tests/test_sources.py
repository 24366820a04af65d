import json

from pyspark.sql import functions as F

from pistespark.functions import tags as tg
from pistespark.plans import jobs
from pistespark.sources import readers, sinks

SQUARE = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]


def feature(kind, coords, **props):
    return {"type": "Feature", "geometry": kind and {"type": kind, "coordinates": coords}, "properties": props}


FEATURES = [
    feature("Point", [0.5, 0.5], osm_id="7", other_tags='"aerialway"=>"gondola"'),
    feature("LineString", [[0, 0], [0.5, 0.5], [1]], osm_way_id="8", aerialway="t-bar"),
    feature("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3]]], name=" "),
    feature("Polygon", [SQUARE, [[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]], osm_relation_id="9", name="Area", country="C"),
    feature("MultiPolygon", [[SQUARE], [[[5, 5], [6, 5], [6, 6], [5, 5]]]], osm_way_id="10", name="Multi"),
    feature("Polygon", [SQUARE], osm_relation_id="9", name="Again"),
    feature(None, None, name="none"),
    feature("Polygon", [], name="empty"),
    {"type": "Other"},
]


def put(path, value):
    path.write_text(json.dumps(value))
    return str(path)


def test_geojson(spark, tmp_path):
    doc = readers.geojson(spark, put(tmp_path / "a.geojson", {"type": "FeatureCollection", "features": FEATURES}))
    rows = sorted(doc.collect(), key=lambda r: r["ordinal"])
    assert [(r["kind"], len(r["geometry"]), None if r["parts"] is None else [len(p) for p in r["parts"]]) for r in rows] == [("Point", 1, None), ("LineString", 2, None), ("MultiLineString", 4, None), ("Polygon", 5, [2]), ("MultiPolygon", 5, [1, 1]), ("Polygon", 5, [1])]
    keyed = readers.geojson(spark, put(tmp_path / "b.geojson", {"lines": {"features": FEATURES[1:3]}, "points": {"features": FEATURES[:1]}}))
    assert keyed.count() == 3
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.json").write_text("\n".join(map(json.dumps, FEATURES)))
    assert readers.geojson(spark, str(tmp_path / "lines"), lines=True).count() == 6
    areas = {(r["area_type"], r["area_id"]): r["name"] for r in readers.areas_for_rollup(doc).collect()}
    assert areas == {("relation", 9): "Again", ("way", 10): "Multi"}
    near = {r["ordinal"]: (r["area_id"], r["name"]) for r in readers.areas_for_nearby(doc).collect()}
    assert near[0] == (7, "Unknown") and near[2] == (2, " ") and near[3] == (9, "Area")


def test_nearby_job_and_round_trips(spark, tmp_path):
    doc = readers.geojson(spark, put(tmp_path / "a.geojson", {"features": FEATURES}))
    near = jobs.extract_nearby(doc.filter("kind IN ('Point', 'LineString')"), readers.areas_for_nearby(doc.filter("kind = 'Polygon'")), 60_000.0)
    got = {(r["osm_type"], r["osm_id"], r["winter_sports_id"], r["tags"].get("aerialway")) for r in near.collect()}
    assert got == {("node", 7, 9, "gondola"), ("way", 8, 9, "t-bar")}
    out = str(tmp_path / "near.parquet")
    sinks.nearby_parquet(near, out)
    back = readers.nearby_parquet(spark, out)
    assert sorted(r["tags"]["aerialway"] for r in back.collect()) == sorted(r["tags"]["aerialway"] for r in near.collect())
    sinks.nearby_parquet(near, out + "1", limit=1)
    assert spark.read.parquet(out + "1").count() == 1
    sinks.geojson_lines(doc.withColumn("name", F.col("props")["name"]), str(tmp_path / "out"), ["name"])
    again = readers.geojson(spark, str(tmp_path / "out"), lines=True)
    assert sorted((r["kind"], len(r["geometry"])) for r in again.collect()) == sorted(("LineString" if r["kind"] == "MultiLineString" else r["kind"], len(r["geometry"])) for r in doc.collect())
    empty = near.filter("osm_id < 0")
    sinks.nearby_parquet(empty, str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).columns == [*near.columns, "wkb"]


def test_elements_and_analysis(spark, tmp_path):
    g = [{"lat": 0.5, "lon": 0.5}, {"lat": 0.51, "lon": 0.5}]
    rows = [{"type": "way", "id": i, "geometry": g, "tags": {"piste:type": "downhill"}, "winter_sports_id": w, "winter_sports_type": "relation"} for i, w in ((1, 9), (2, "9.0"), (3, "bad"))]
    e = readers.osm_json(spark, put(tmp_path / "e.json", {"version": 0.6, "elements": [*rows, {"type": "node", "id": 4, "lat": 1.0, "lon": 2.0}]}))
    assert e.count() == 4 and e.filter("winter_sports_id = 9").count() == 2
    doc = readers.geojson(spark, put(tmp_path / "a.geojson", {"features": FEATURES}))
    land = readers.boundaries(spark, put(tmp_path / "land.geojson", {"features": [feature("Polygon", [[[-9, -9], [9, -9], [9, 9], [-9, 9], [-9, -9]]], ADMIN="nan", NAME="Land")]}), tg.COUNTRY_NAMES, "country")
    out = jobs.analyze(readers.areas_for_rollup(doc), e, land, readers.boundaries(spark, None, tg.STATE_NAMES, "state"))
    got = {r["name"]: (r["country"], r["state"], r["downhill_trails"], r["total_area_ha"] > 0) for r in out.collect()}
    assert got == {"Again": ("Land", None, 2, False), "Multi": ("Land", None, 0, True)}
    sinks.analyzed_csv(out, str(tmp_path / "csv"))
    assert readers.analyzed_csv(spark, str(tmp_path / "csv")).count() == 2
    sinks.analyzed_csv(out.filter("name = 'x'"), str(tmp_path / "csv0"))
    assert readers.analyzed_csv(spark, str(tmp_path / "csv0")).columns == out.columns
    found = jobs.enrich_features(doc, land, readers.boundaries(spark, None, tg.STATE_NAMES, "state"), doc.filter("kind = 'Polygon'").select("ordinal", F.col("props")["name"].alias("name"), "parts"))
    assert {r["ordinal"]: r["ski_area"] for r in found.collect()}[0] == "Area"


def test_regions_and_publishing(spark, tmp_path):
    for region, cols in (("asia", "id int, a string"), ("europe", "id int, b double"), ("combined", "id int, a string")):
        spark.createDataFrame([(1, None)], cols).write.parquet(str(tmp_path / region / "lifts.parquet"))
    df = readers.regional(spark, str(tmp_path), "lifts")
    assert {r["region"] for r in df.collect()} == {"asia", "europe"} and set(df.columns) == {"id", "a", "b", "region"}
    out = str(tmp_path / "pub")
    sinks.published(df, out, "2025-01")
    sinks.published(df.filter("region = 'asia'"), out, "2025-01")
    assert spark.read.parquet(out).count() == 2
    assert sinks.export_all({"good": lambda: None, "bad": lambda: 1 / 0}) == {"good": None, "bad": "ZeroDivisionError: division by zero"}


def test_centroids_cover_all_parts(spark, tmp_path):
    """A multipolygon's centre weighs all its polygons less their holes; a multi-line's has no segments between its parts."""
    big, hole = [[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]], [[10, 0], [11, 0], [11, 1], [10, 1], [10, 0]]
    found = [
        feature("MultiPolygon", [[SQUARE], [big, hole]]),
        feature("MultiLineString", [[[0, 0], [2, 0]], [[10, 4], [10, 8]]]),
        feature("MultiPoint", [[0, 0], [0, 1], [6, 2]]),
        feature("MultiPolygon", [[[[0, 0], [2, 0], [0, 0]]], [[[10, 4], [10, 8], [10, 4]]]]),
    ]
    doc = readers.geojson(spark, put(tmp_path / "m.geojson", {"features": found}))
    got = [tuple(round(x, 9) for x in r["c"]) for r in doc.withColumn("c", jobs.planar_centroid()).orderBy("ordinal").collect()]
    # areas 1 at (0.5, 0.5) and 4 - 1 at ((4 * 1 - 0.5) / 3, (4 * 11 - 10.5) / 3); lengths 2 at (0, 1) and 4 at (6, 10)
    assert got == [((0.5 + 3.5) / 4, (0.5 + 33.5) / 4), (4, 7), (1, 2), (4, 7)]
    areas = readers.areas_for_nearby(doc)
    assert areas.withColumn("c", jobs.planar_centroid()).filter("c IS NULL").count() == 0
