"""Areas, points and polygons that share a place or a shape are met once, and each of them gets its result."""

from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.operators import cells, cluster, enrich, rollup, spatial_join
from pistespark.plans import jobs, queries

AREAS = "area_type string, area_id long, area_lat double, area_lon double"


def test_representatives(spark):
    rows = [("way", i, 45.0, 7.0) for i in range(40)] + [("way", 99, -0.0, 8.0), ("way", 98, 0.0, 8.0), ("way", 97, None, 8.0), ("relation", 5, 45.0, 7.0), ("relation", 5, 46.0, 7.0)]
    reps, members = spatial_join.representatives(spark.createDataFrame(rows, AREAS), rollup.KEY, "area_lat", "area_lon")
    # a key at two points stands for itself, with both of its rows
    assert sorted((r["area_type"], r["area_id"]) for r in reps.collect()) == [("relation", 5), ("relation", 5), ("way", 0), ("way", 98)]
    at = spark.createDataFrame([(1, 45.001, 7.0), (2, 0.001, 8.0), (3, 46.001, 7.0)], "osm_id long, lat double, lon double")
    near = spatial_join.radius_join(at, reps, 2000.0)
    assert near.count() == 4
    got = spatial_join.expanded(near.select("area_type", "area_id", "osm_id"), members, rollup.KEY)
    want = [("way", i, 1) for i in range(40)] + [("way", 98, 2), ("way", 99, 2), ("relation", 5, 1), ("relation", 5, 3)]
    assert sorted((r["area_type"], r["area_id"], r["osm_id"]) for r in got.collect()) == sorted(want)


def test_nearby_areas_at_one_point_are_met_once(spark):
    ring = F.array(*[geo.vertex(F.lit(45.0 + y), F.lit(7.0 + x)) for y, x in ((0, 0), (0, 0.01), (0.01, 0.01), (0.01, 0), (0, 0))])
    none = lambda kind: F.lit(None).cast(kind)
    shaped = lambda df, kind: df.withColumns({"kind": F.lit(kind), "geometry": ring, "parts": F.array(F.array(ring)), "lines": none("array<array<struct<lat:double,lon:double>>>")})
    areas = shaped(spark.range(30).select(F.lit("way").alias("area_type"), F.col("id").alias("area_id"), F.concat(F.lit("N"), F.col("id").cast("string")).alias("name"), none("string").alias("country"), none("string").alias("state")), "Polygon")
    found = shaped(spark.range(3).select(F.col("id").alias("ordinal"), F.create_map(F.lit("osm_id"), F.col("id").cast("string")).alias("props")), "Polygon")
    assert jobs.nearby_places(found, areas)[0].count() == 3
    got = jobs.extract_nearby(found, areas).collect()
    assert sorted((r["osm_id"], r["winter_sports_id"], r["ski_area"]) for r in got) == sorted((i, j, f"N{j}") for i in range(3) for j in range(30))


def test_equal_polygons_are_one_in_a_cell(spark):
    box = lambda d: [[[(40 + d, 5 + d), (40 + d, 5.2 - d), (40.2 - d, 5.2 - d), (40.2 - d, 5 + d), (40 + d, 5 + d)]]]
    rows = [(i, None if i < 3 else f"P{i}", box(0.0)) for i in range(60)] + [(60, "last", box(0.01))]
    polygons = spark.createDataFrame(rows, "ordinal long, name string, parts array<array<array<struct<lat:double,lon:double>>>>")
    index = spatial_join.cell_rows(polygons, ["name"])
    assert [len(r["_polygons"]) for r in index.collect()] == [2]
    points = spark.createDataFrame([(1, 40.1, 5.1), (2, 40.005, 5.1), (3, 41.0, 5.1)], "id long, lat double, lon double")
    assert {r["id"]: r["name"] for r in spatial_join.first_match(points, polygons, ["name"]).collect()} == {1: "P3", 2: "P3", 3: None}
    both = cells.cut({"country": polygons.withColumnRenamed("name", "country"), "state": polygons.filter("ordinal > 50").withColumnRenamed("name", "state")})
    assert {(r["country"], r["state"]) for r in enrich.with_admin(points.filter("id = 1"), both).collect()} == {("P3", "P51")}


def test_points_at_one_place(spark):
    rows = [(i, 45.0, 7.0) for i in range(20)] + [(100 + i, 45.001, 7.0) for i in range(3)] + [(200, 50.0, 7.0)]
    points = spark.createDataFrame(rows, "ordinal long, lat double, lon double")
    got = sorted((r["a"], r["b"]) for r in spatial_join.close_pairs(points, 2000.0).collect())
    near = [k for k, lat, _ in rows if lat < 46]
    assert got == sorted((a, b) for a in near for b in near if a < b)
    assert {r["ordinal"]: r["cluster"] for r in cluster.single_linkage(points, 2000.0).collect()} == {k: 200 if k == 200 else 0 for k, *_ in rows}


def test_areas_of_a_point_follow_the_join(spark, monkeypatch):
    """A feature meets a point once, whatever areas are there, and then gets every one of them."""
    monkeypatch.setattr(spatial_join, "CHUNK", 2)
    areas = spark.createDataFrame([(i, None if i == 3 else "n", *([47.0, 11.0] if i < 7 else [47.001, 11.0] if i < 9 else [None, 11.0])) for i in range(10)], "area_id long, name string, area_lat double, area_lon double")
    ways = spark.createDataFrame([(1, 47.0, 11.0), (2, 47.0, 11.001), (3, 49.0, 11.0)], "way_id long, lat double, lon double")
    points, by_point = spatial_join.places(areas)
    near = spatial_join.radius_join(ways, points, 2000.0)
    assert points.count() == 2 and near.count() == 4 and by_point.count() >= 2 and sum(len(r["_areas"]) for r in by_point.collect()) == 9
    assert spark.sql("SELECT xxhash64(-0.0D) = xxhash64(0.0D)").first()[0]  # what puts areas of equal points together
    got = spatial_join.with_areas(near, by_point).select("way_id", "area_id", "name", "distance_m").collect()
    want = spatial_join.radius_join(ways, areas, 2000.0).select("way_id", "area_id", "name", "distance_m").collect()
    assert len(got) == 18 and sorted(got, key=str) == sorted(want, key=str)


def test_distances_are_worked_out_before_areas_follow(spark):
    plan = queries.nearby_radius_join(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan and plan.index("Generate inline") < plan.index("round(") and plan.count("ATAN2") <= 2
