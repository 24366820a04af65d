import math
import struct

import pytest
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.functions import tags as tg

V = "struct<lat:double,lon:double>"


def one(spark, expr, **cols):
    """The value of an expression over one row of columns: name -> (value, type)."""
    ddl = ", ".join(f"{k} {t}" for k, (_, t) in cols.items()) or "x int"
    row = tuple(v for v, _ in cols.values()) or (1,)
    return spark.createDataFrame([row], ddl).select(expr.alias("r")).first()["r"]


def ring(*points):
    return [{"lat": float(y), "lon": float(x)} for x, y in points]


def line(spark, f, points):
    return one(spark, f(F.col("g")), g=(points, f"array<{V}>"))


def hav(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    x = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


def test_line_length(spark):
    pts = [(10, 45), (10.01, 45.02), (10.05, 45.01)]
    want = hav(pts[0], pts[1]) + hav(pts[1], pts[2])
    assert line(spark, geo.line_length, ring(*pts)) == pytest.approx(want)
    assert line(spark, geo.line_length, ring(*pts[::-1])) == pytest.approx(want)
    for short in ([], ring((1, 2)), None):
        assert line(spark, geo.line_length, short) == 0


def test_polygon_area(spark):
    box = [(0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01)]
    want = 0.01 * 111320 * 0.01 * 111320 * math.cos(math.radians(0.005))
    assert line(spark, geo.polygon_area, ring(*box)) == pytest.approx(want)
    closed = line(spark, geo.polygon_area, ring(*box, box[0]))
    assert closed == pytest.approx(want, rel=1e-6)  # the mean latitude counts the first vertex twice
    assert line(spark, geo.polygon_area, ring((0, 0), (1, 1))) == 0


def test_centroids(spark):
    assert line(spark, geo.vertex_mean, ring((0, 0), (2, 4))).asDict() == {"lat": 2, "lon": 1}
    assert line(spark, geo.vertex_mean, []) is None
    got = line(spark, geo.centroid_of_line, ring((0, 0), (3, 0), (3, 1)))
    assert (got["lat"], got["lon"]) == pytest.approx((0.125, (3 * 1.5 + 3) / 4))
    assert line(spark, geo.centroid_of_line, ring((1, 2), (1, 2)))["lat"] == 2
    outer, hole = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((2, 0), (4, 0), (4, 4), (2, 4), (2, 0))
    both = one(spark, geo.centroid_of_polygon(F.col("p")), p=([outer, hole], f"array<array<{V}>>"))
    assert (both["lon"], both["lat"]) == pytest.approx((1, 2))
    turned = one(spark, geo.centroid_of_polygon(F.col("p")), p=([outer[::-1], hole], f"array<array<{V}>>"))
    assert (turned["lon"], turned["lat"]) == pytest.approx((1, 2))
    flat = one(spark, geo.centroid_of_polygon(F.col("p")), p=([ring((0, 0), (2, 0), (0, 0))], f"array<array<{V}>>"))
    assert (flat["lon"], flat["lat"]) == pytest.approx((1, 0))


@pytest.mark.parametrize(("x", "y", "want"), [(1, 1, True), (5, 5, False), (2.5, 2.5, False), (0, 1, False), (4, 4, False), (2, 2.5, False), (2, 4, False), (9, 2, False), (3.5, 0.5, True)])
def test_inside(spark, x, y, want):
    outer, hole = ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((2, 2), (3, 2), (3, 3), (2, 3), (2, 2))
    assert one(spark, geo.inside(F.lit(float(y)), F.lit(float(x)), F.col("p")), p=([outer, hole], f"array<array<{V}>>")) is want
    start = outer[2:] + outer[:2]
    assert one(spark, geo.inside(F.lit(float(y)), F.lit(float(x)), F.col("p")), p=([start, hole], f"array<array<{V}>>")) is want


def test_kinds_and_wkb(spark):
    pts = [(1.5, -2.25), (1e-7, 45.123456789), (-179.99999, 0.1), (1.5, -2.25)]
    head = {1: b"\0\0\0\0\1", 2: b"\0\0\0\0\2" + struct.pack(">i", 2), 3: b"\0\0\0\0\2" + struct.pack(">i", 3), 4: b"\0\0\0\0\3" + struct.pack(">ii", 1, 4)}
    for n, kind in ((1, "Point"), (2, "LineString"), (3, "LineString"), (4, "Polygon")):
        assert line(spark, geo.geometry_kind, ring(*pts[:n])) == kind
        assert bytes(line(spark, geo.wkb, ring(*pts[:n]))) == head[n] + b"".join(struct.pack(">dd", *p) for p in pts[:n])
    assert line(spark, geo.geometry_kind, ring((0, 0), (1, 1), (0, 0))) == "LineString"
    assert line(spark, geo.wkb, []) is None
    assert bytes(line(spark, geo.wkb, ring((8.0, 1024.0)))) == head[1] + struct.pack(">dd", 8, 1024)


def test_element_geometry(spark):
    cols = dict(t=("relation", "string"), lat=(None, "double"), lon=(None, "double"), g=(None, f"array<{V}>"), b=(None, "struct<minlat:double,minlon:double,maxlat:double,maxlon:double>"), m=([{"role": "outer", "geometry": ring((0, 0))}, {"role": "inner", "geometry": ring((5, 5))}, {"role": "outer", "geometry": ring((1, 1))}], f"array<struct<role:string,geometry:array<{V}>>>"))
    expr = geo.element_geometry(*[F.col(c) for c in ("t", "lat", "lon", "g", "b", "m")])
    assert len(one(spark, expr, **cols)) == 2
    cols["b"] = ({"minlat": 0.0, "minlon": 0.0, "maxlat": 2.0, "maxlon": 4.0}, cols["b"][1])
    assert [x.asDict() for x in one(spark, expr, **cols)] == [{"lat": 1, "lon": 2}]


@pytest.mark.parametrize(("text", "want"), [('"a"=>"1","b"=>"x, y"', {"a": "1", "b": "x, y"}), ('"a"=>"1","a"=>"2"', {"a": "2"}), ("", {}), (None, {}), ("no pairs", {}), ('{"a": "1", "b": 2}', {"a": "1", "b": "2"}), ("{broken", {})])
def test_other_tags(spark, text, want):
    assert one(spark, tg.other_tags(F.col("t")), t=(text, "string")) == want


def test_tags_of(spark):
    props = {"osm_id": "5", "name": "N", "blank": " ", "aerialway": "gondola", "other_tags": '"aerialway"=>"t-bar","x"=>"y"'}
    assert one(spark, tg.tags_of(F.col("p")), p=(props, "map<string,string>")) == {"name": "N", "aerialway": "gondola", "x": "y"}


@pytest.mark.parametrize(("text", "id_", "key"), [("12", 12, 12), (" 7 ", 7, 7), ("x", 0, None), (None, 0, None), ("12.9", 0, 12), ("nan", 0, None), ("1e3", 0, 1000), ("99999999999999999999", 0, None)])
def test_ids(spark, text, id_, key):
    assert one(spark, tg.text_id(F.col("t")), t=(text, "string")) == id_
    assert one(spark, tg.numeric_key(F.col("t")), t=(text, "string")) == key


@pytest.mark.parametrize(("text", "want"), [("30 m", 30.0), ("12.5", 12.5), (" 5 ", 5.0), ("nan", 30.0), (None, 30.0), ("", 30.0)])
def test_width(spark, text, want):
    assert one(spark, tg.width(F.col("t")), t=(text, "string")) == want


def test_names(spark):
    props = {"NAME": "nan", "ADMIN": " ", "NAME_LONG": " Land "}
    assert one(spark, tg.pick_name(F.col("p"), tg.COUNTRY_NAMES), p=(props, "map<string,string>")) == "Land"
    assert one(spark, tg.difficulty(F.lit(" Novice "))) == "novice"
    assert one(spark, tg.display_name(F.col("p"), F.lit("way"), F.lit(5)), p=({"name": ""}, "map<string,string>")) == "way/5"
    assert one(spark, tg.label(F.lit("chair_lift"))) == "chair lift"
    assert one(spark, tg.first_id(F.lit(0), F.lit(None).cast("bigint"), F.lit(4))) == 4


def test_moments_and_binary_are_worked_out_once(spark):
    g = [ring((0, 0), (4, 0), (4, 4), (0, 0)), ring((-1.5, 2)), ring((1, 2), (3, -4e-310)), [], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(g)], f"i int, g array<{V}>").withColumn("wkb", geo.wkb(F.col("g")))
    back = {r["i"]: r["v"] for r in df.select("i", geo.vertices_of_wkb(F.col("wkb")).alias("v")).collect()}
    assert [back[i] and [v.asDict() for v in back[i]] for i in range(5)] == [*g[:3], None, None]
    short = df.select(geo.vertices_of_wkb(F.expr("substring(wkb, 1, length(wkb) - 1)")).alias("v"))
    assert all(r["v"] is None for r in short.collect())
    # one trip of Arrow for the binary, and no expression that is written out over and over
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 2000
    assert len(df.select(geo.centroid_of_polygon(F.array("g")))._jdf.queryExecution().analyzed().toString()) < 20_000
