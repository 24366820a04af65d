import math
import random

from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.operators import cluster, combine, components, enrich, features, rollup, spatial_join, ways

V = "struct<lat:double,lon:double>"


def hav(y1, x1, y2, x2):
    p, q = math.radians(y1), math.radians(y2)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(x2 - x1) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(a), math.sqrt(max(0, 1 - a)))


def test_radius_join_is_the_cross_join(spark):
    rnd = random.Random(2)
    for lat0, lon0, spread, r in ((45, 10, 0.2, 2000.0), (89.5, 0, 0.4, 30000.0), (0, 179.95, 0.2, 5000.0), (-70, -180, 0.3, 9000.0)):
        pts = [(i, max(-90, min(90, lat0 + rnd.uniform(-spread, spread))), (lon0 + rnd.uniform(-spread, spread) * (400 if lat0 > 80 else 1) + 180) % 360 - 180) for i in range(120)]
        f = spark.createDataFrame([*pts, (500, None, 1.0)], "id int, lat double, lon double")
        a = spark.createDataFrame([*pts[:40], (501, None, None)], "area_id int, area_lat double, area_lon double")
        got = {(r_["id"], r_["area_id"]) for r_ in spatial_join.radius_join(f, a, r).collect()}
        assert got == {(p[0], q[0]) for p in pts for q in pts[:40] if hav(*p[1:], *q[1:]) <= r}


def test_joins_plan_without_nested_loops(spark):
    f = spark.range(1000).selectExpr("id", "double(id % 50) lat", "double(id % 70) lon")
    a = spark.range(50).selectExpr("id area_id", "double(id) area_lat", "double(id) area_lon")
    plan = spatial_join.radius_join(f, a, 2000.0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(80)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in root}
    got = {(r["node"], r["root"]) for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_single_linkage_does_not_depend_on_row_order(spark):
    pts = [(i, 45 + 0.5 * (i // 4) + 0.01 * (i % 4), 7.0) for i in range(20)] + [(99, None, None)]
    out = []
    for rows in (pts, pts[::-1]):
        df = spark.createDataFrame(rows, "ordinal long, lat double, lon double")
        out.append({(r["ordinal"], r["cluster"]) for r in cluster.single_linkage(df, 3000.0).collect()})
    assert out[0] == out[1] == {(i, i // 4 * 4) for i in range(20)} | {(99, 99)}


def square(x, y, h):
    return [[[{"lat": float(y + b * h), "lon": float(x + a * h)} for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]]]


def test_first_match_takes_the_first_value_per_column(spark):
    polys = spark.createDataFrame([(1, None, "S1", square(0, 0, 1)), (2, "C2", "S2", square(0.5, 0, 1)), (3, "C3", None, square(0, 0, 5))], f"ordinal long, country string, state string, parts array<array<array<{V}>>>")
    pts = spark.createDataFrame([(1, 0.0, 0.2), (2, 0.0, -3.0), (3, 40.0, 40.0), (4, 1.0, 0.0), (5, None, None)], "id int, lat double, lon double")
    got = {r["id"]: (r["country"], r["state"]) for r in spatial_join.first_match(pts, polys, ["country", "state"]).collect()}
    assert got == {1: ("C2", "S1"), 2: ("C3", None), 3: (None, None), 4: ("C3", None), 5: (None, None)}


def test_by_name_asks_the_boundaries_only_where_something_is_missing(spark):
    names = spark.createDataFrame([(1, "A", "old", "old"), (2, "A", "CA", "SA"), (3, "B", "CB", None)], "ordinal long, name string, country string, state string")
    land = spark.createDataFrame([(1, "Land", square(0, 0, 1))], f"ordinal long, country string, parts array<array<array<{V}>>>")
    none = spark.createDataFrame([], f"ordinal long, state string, parts array<array<array<{V}>>>")
    rows = spark.createDataFrame([(1, "A", 0.0, 0.0), (2, "B", 0.0, 0.0), (3, "B", None, None), (4, None, 0.0, 0.0), (5, "B", 9.0, 9.0)], "id int, area_name string, lat double, lon double")
    got = {r["id"]: (r["country"], r["state"]) for r in enrich.by_name(rows, names, land, none).collect()}
    assert got == {1: ("CA", "SA"), 2: ("Land", None), 3: ("CB", None), 4: ("Land", None), 5: (None, None)}
    assert enrich.filled(rows, {"area_name": "Unknown"}).filter("area_name = 'Unknown'").count() == 1


def test_ways_need_all_their_nodes(spark):
    nodes = spark.createDataFrame([(1, 0, 1.0, 1.0), (2, 1, 2.0, 2.0), (2, 2, 9.0, 9.0)], "node_id long, ordinal long, lat double, lon double")
    rows = spark.createDataFrame([(10, [1, 2, 1]), (11, [1, 3]), (12, [1]), (13, [2, 1])], "way_id long, nodes array<bigint>")
    got = {r["way_id"]: [v["lat"] for v in r["geometry"]] for r in ways.resolved(rows, nodes).collect()}
    assert got == {10: [1, 9, 1], 13: [9, 1]}
    e = rows.selectExpr("'way' osm_type", "way_id osm_id", "nodes", f"cast(null as array<{V}>) geometry")
    assert ways.with_geometry(e, nodes).filter("geometry IS NULL").count() == 2


def test_rollup_counts(spark):
    pt = lambda x, y: {"lat": float(y), "lon": float(x)}
    flat, tri, closed = [pt(0, 0), pt(0.01, 0)], [pt(0, 0), pt(0.01, 0), pt(0.01, 0.01)], [pt(0, 0), pt(0.01, 0), pt(0.01, 0.01), pt(0, 0)]
    d = {"piste:type": "downhill"}
    near = [
        ("way", 1, 1, {**d, "piste:difficulty": " Novice ", "piste:width": "30 m"}, flat), ("way", 2, 2, {**d, "piste:difficulty": "weird"}, tri), ("way", 3, 3, {**d, "piste:grooming": "no"}, closed),
        ("node", 4, 4, d, [pt(0, 0)]), ("way", 5, 5, {"piste:grooming": "no"}, flat), ("way", 6, 6, {"aerialway": "gondola"}, flat), ("way", 6, 7, {"aerialway": "t-bar"}, tri),
        ("way", 8, 8, {"aerialway": "station"}, flat), ("way", 9, 9, {"aerialway": "t-bar"}, None), ("way", 1, 10, {**d, "piste:type": "tubing"}, None), ("way", 11, 11, d, None),
    ]
    ddl = f"osm_type string, osm_id long, ordinal long, tags map<string,string>, geometry array<{V}>"
    n = spark.createDataFrame(near, ddl).selectExpr("'way' area_type", "1L area_id", "*")
    areas = spark.createDataFrame([("way", 1, "A", "C", "S", 1.0, 2.0, closed), ("way", 2, "B", None, None, 1.0, 2.0, None)], f"area_type string, area_id long, name string, country string, state string, lat double, lon double, geometry array<{V}>")
    out = {r["name"]: r for r in rollup.area_rollup(areas, n).collect()}
    a, b = out["A"], out["B"]
    assert (a["downhill_trails"], a["trails_novice"], a["trails_expert"], a["total_lifts"]) == (5, 1, 0, 2)
    assert (a["gladed_terrain"], a["snow_park"], a["sledding_tubing"], a["lift_types"]) == ("Yes", "No", "Yes", "gondola: 1, t-bar: 1")
    length = hav(0, 0, 0, 0.01)
    assert a["longest_trail_mi"] == round(length / 1609.344, 2) and a["avg_trail_mi"] == round(length / 2 / 1609.344, 2)
    assert a["longest_lift_mi"] == round(length / 1609.344, 2)
    only_closed = rollup.area_rollup(areas, n, "closed_only").filter("name = 'A'").first()
    assert only_closed["longest_trail_mi"] > a["longest_trail_mi"]  # the open three-vertex way is a line now
    assert (b["total_lifts"], b["skiable_terrain_ha"], b["lift_types"], b["resort_type"], b["gladed_terrain"]) == (0, 0.0, "", "not a downhill ski resort", "No")
    assert len(rollup.area_rollup(areas, n).columns) == 28


def test_features(spark):
    rows = spark.createDataFrame([("way", 1, 1, {"landuse": "winter_sports"}), ("node", 2, 2, {"landuse": "winter_sports"}), ("way", 3, 3, {"aerialway": ""}), ("way", 4, 4, None)], "osm_type string, osm_id long, ordinal long, tags map<string,string>")
    ids = lambda df: sorted(r["osm_id"] for r in df.collect())
    assert ids(features.ski_areas(rows)) == [1] and ids(features.tag_filter(rows, "aerialway")) == [3]
    assert ids(features.first_n(rows, 2)) == [1, 2] and ids(features.first_n(rows, 0)) == [1, 2, 3, 4]
    assert rows.filter(features.is_lift(F.col("tags"))).count() == 0
    boxes = spark.createDataFrame([(1, 45.0, 10.0), (2, 45.5, 10.5)], "id int, lat double, lon double")
    r = features.merged_box(boxes, 2000.0).first()
    assert r["minlat"] < 45 < 45.5 < r["maxlat"] and r["minlon"] < 10 < 10.5 < r["maxlon"]
    assert geo.boxes_meet(F.struct(F.lit(1).alias("minlat")), F.struct(F.lit(1).alias("minlat"))) is not None


def test_combine(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, only_a string"), spark.createDataFrame([(2, 0.5)], "id int, only_b double")
    got = {(r["id"], r["only_a"], r["only_b"], r["region"]) for r in combine.combined({"r2": b, "r1": a}).collect()}
    assert got == {(1, "x", None, "r1"), (2, None, 0.5, "r2")}
    assert combine.combined({}) is None
    assert {(r["dataset"], r["rows"]) for r in combine.row_counts({"a": a, "b": b.limit(0)}).collect()} == {("a", 1), ("b", 0)}


def test_clipped_containment_equals_every_edge(spark):
    """Cells of any size give what all edges of the whole polygons give."""
    rnd = random.Random(11)
    wheel = lambda x, y, r, n: [{"lat": y + r * (1 + 0.3 * (i % 2)) * math.sin(6.283185 * i / n), "lon": x + r * (1 + 0.3 * (i % 2)) * math.cos(6.283185 * i / n)} for i in range(n)]
    polys = [(k, [[wheel(k * 0.7, 0.3 * k, 1.0, 60), wheel(k * 0.7, 0.3 * k, 0.4, 9)], [wheel(k * 0.7 + 4, -2.0, 0.5, 12)]]) for k in range(4)] + [(9, square(0.0, 0.0, 1.0)), (10, [])]
    polygons = spark.createDataFrame(polys, f"poly int, parts array<array<array<{V}>>>")
    pts = [(i, rnd.uniform(-3, 3), rnd.uniform(-2, 7)) for i in range(300)] + [(900, 1.0, 0.0), (901, 0.0, 1.0), (902, -1.0, -1.0)]
    points = spark.createDataFrame(pts, "id int, lat double, lon double")
    pairs = lambda df: {(r["id"], r["poly"]) for r in df.collect()}
    want = pairs(points.join(polygons).filter(geo.inside_any(F.col("lat"), F.col("lon"), F.col("parts"))))
    assert len(want) > 50 and not {p for p in want if p[0] >= 900 and p[1] == 9}
    for cell in (0.5, 0.13, 3.0, 50.0):
        assert pairs(spatial_join.containment_join(points, polygons, cell)) == want
    most = spatial_join.clipped(polygons.filter("poly < 4"), 0.1).agg(F.max(F.size("_edges"))).first()[0]
    assert most < 40  # of 81 edges, no cell has more than those that meet it


def test_clusters_equal_all_pairs(spark):
    """Dense points, whose cells hold many, against a search over all pairs; also near a pole and over the antimeridian."""
    rnd = random.Random(4)
    at = [(rnd.gauss(46, 0.05), rnd.gauss(8, 0.08)) for _ in range(120)] + [(rnd.uniform(89.9, 90), rnd.uniform(-180, 180)) for _ in range(20)] + [(rnd.uniform(0, 0.1), rnd.choice([179.99, -179.99])) for _ in range(20)]
    far = lambda p, q: 2 * 6371000 * math.asin(math.sqrt(math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2))
    low = list(range(len(at)))
    for _ in range(len(at)):
        new = [min([low[i], *(low[j] for j in range(len(at)) if far(at[i], at[j]) <= 1500)]) for i in range(len(at))]
        if new == low:
            break
        low = new
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "ordinal long, lat double, lon double").repartition(3)
    assert sorted((r["ordinal"], r["cluster"]) for r in cluster.single_linkage(df, 1500.0).collect()) == list(enumerate(low))
