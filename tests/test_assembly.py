"""Rings from pieces, holes in their polygons, and what an extract takes along."""

import random

from pyspark.sql import functions as F

from pistespark.operators import assembly, closure

ELEMENT = "osm_type string, osm_id long, lat double, lon double, nodes array<long>, members array<struct<type:string,ref:long,role:string>>, geometry array<struct<lat:double,lon:double>>"


def square(x, y, side, node):
    """(node, lat, lon) around a square, closed."""
    at = [(x, y), (x + side / 2, y), (x + side, y), (x + side, y + side), (x, y + side)]
    return [(node + i, float(b), float(a)) for i, (a, b) in enumerate(at)] + [(node, float(y), float(x))]


def made(spark, relations):
    """relations: id to (role, line) pairs; ways get numbers and directions by chance."""
    rng = random.Random(1)
    members, ways, n = [], [], 0
    for rel, lines in relations.items():
        for role, line in lines:
            n += 1
            if rng.random() < 0.5:
                line = line[::-1]
            members.append((rel, role, n))
            ways.append((n, [v[0] for v in line], [(v[1], v[2]) for v in line]))
    rng.shuffle(members)
    rng.shuffle(ways)
    return spark.createDataFrame(members, "relation_id long, role string, way_id long"), spark.createDataFrame(ways, "way_id long, nodes array<long>, geometry array<struct<lat:double,lon:double>>")


def cut(line, *at):
    ends = [0, *at, len(line) - 1]
    return [line[a : b + 1] for a, b in zip(ends, ends[1:], strict=False)]


def shape(parts):
    corner = lambda r: (min(v["lon"] for v in r), min(v["lat"] for v in r), max(v["lon"] for v in r), len(r), (r[0]["lat"], r[0]["lon"]) == (r[-1]["lat"], r[-1]["lon"]))
    return sorted([corner(p[0]), sorted(corner(r) for r in p[1:])] for p in parts)


def test_multipolygons(spark):
    big, hole, island, far = square(0, 0, 10, 100), square(2, 2, 2, 200), square(2.5, 2.5, 1, 300), square(20, 0, 4, 400)
    pond = square(2.7, 2.7, 0.2, 500)
    relations = {
        1: [("outer", x) for x in cut(big, 1, 2, 4)] + [("inner", x) for x in cut(hole, 3)] + [("", island), ("inner", pond), ("outer", far)],
        2: [(None, x) for x in cut(big, 2)][:1],  # does not close
        3: [("outer", big), ("inner", far)],  # nothing is around the inner ring
        4: [("inner", hole)],
        5: [("outer", x) for x in cut(big, 2, 3)] * 2,  # members twice
        6: [("outer", [(1, 0.0, 0.0), (2, 0.0, 1.0)]), ("outer", [(2, 0.0, 1.0), (1, 0.0, 0.0)])],  # no area
        7: [("outer", [(1, 0.0, 0.0), (2, 0.0, 4.0), (3, 4.0, 4.0)]), ("outer", [(3, 4.0, 4.0), (1, 0.0, 0.0)]), ("outer", [(1, 0.0, 0.0), (5, 0.0, -4.0), (6, -4.0, -4.0), (1, 0.0, 0.0)])],  # two that touch in a node
    }
    members, ways = made(spark, relations)
    got = {r["relation_id"]: shape(r["parts"]) for r in assembly.multipolygons(members.unionByName(members.limit(3)), ways.repartition(5)).collect()}
    ring = lambda x, y, side: (x, y, x + side, 6, True)
    assert got[1] == sorted([[ring(0, 0, 10), [ring(2, 2, 2)]], [ring(2.5, 2.5, 1), [ring(2.7, 2.7, 0.2)]], [ring(20, 0, 4), []]])
    assert got[3] == [[ring(0, 0, 10), []]]
    assert sorted(x[0][3] for x in got[7]) == [4, 4]
    assert set(got) == {1, 3, 5, 7}


def test_a_ring_of_many_ways(spark):
    n = 300
    import math

    line = [(i, math.sin(2 * math.pi * i / n), math.cos(2 * math.pi * i / n)) for i in range(n)]
    members, ways = made(spark, {1: [("outer", [line[i], line[(i + 1) % n]]) for i in range(n)]})
    (row,) = assembly.multipolygons(members, ways).collect()
    ((ring,),) = row["parts"]
    got = [round(math.atan2(v["lat"], v["lon"]) * n / 2 / math.pi) % n for v in ring]
    step = (got[1] - got[0]) % n
    assert step in (1, n - 1) and got == [(got[0] + step * i) % n for i in range(n + 1)]


def test_elements_get_their_polygons(spark):
    line = square(0, 0, 2, 10)
    rows = [("node", i, lat, lon, None, None, None) for i, lat, lon in line[:-1]]
    rows += [("way", 1, None, None, [v[0] for v in line[:3]], None, None), ("way", 2, None, None, [v[0] for v in line[2:]], None, None), ("way", 3, None, None, [v[0] for v in line], None, None)]
    rows += [("relation", 9, None, None, None, [("way", 2, "outer"), ("way", 1, "outer"), ("node", 10, "label"), ("way", 77, "outer")], None), ("relation", 8, None, None, None, None, None)]
    elements = spark.createDataFrame(rows, ELEMENT)
    nodes = elements.filter("osm_type = 'node'").selectExpr("osm_id AS node_id", "lat", "lon", "osm_id AS ordinal")
    got = {(r["osm_type"], r["osm_id"]): (r["parts"], r["geometry"]) for r in assembly.with_multipolygons(elements, nodes).collect()}
    assert shape(got["relation", 9][0]) == shape(got["way", 3][0]) and len(got["relation", 9][1]) == 6
    assert got["way", 1][0] is None and got["relation", 8] == (None, None) and len(got) == len(rows)


def test_no_rows(spark):
    members, ways = made(spark, {1: [("outer", square(0, 0, 1, 1))]})
    assert assembly.multipolygons(members.limit(0), ways).count() == 0 and assembly.multipolygons(members, ways.limit(0)).count() == 0


def network(spark):
    rows = [("node", i, i / 10, 0.0, None, None, None) for i in range(10)]
    rows += [("way", 1, None, None, [0, 1, 2, 0], None, None), ("way", 2, None, None, [2, 3, 99], None, None), ("way", 3, None, None, [7, 8], None, None), ("way", 4, None, None, None, None, None)]
    m = lambda *x: [(k, i, "") for k, i in x]
    rows += [("relation", 1, None, None, None, m(("relation", 2), ("node", 9)), None), ("relation", 2, None, None, None, m(("relation", 3), ("relation", 1)), None), ("relation", 3, None, None, None, m(("way", 2), ("relation", 3), ("relation", 50)), None), ("relation", 4, None, None, None, m(("way", 3)), None), ("relation", 5, None, None, None, None, None)]
    return spark.createDataFrame(rows, ELEMENT)


def test_referenced_objects(spark):
    every = network(spark)
    got = {(r["osm_type"], r["osm_id"]): r["referenced"] for r in closure.with_referenced(every.filter("(osm_type = 'relation' AND osm_id IN (1, 5)) OR (osm_type = 'node' AND osm_id = 3)"), every).collect()}
    assert got == {("relation", 1): False, ("relation", 5): False, ("node", 3): False, ("relation", 2): True, ("relation", 3): True, ("way", 2): True, ("node", 2): True, ("node", 9): True}
    assert closure.with_referenced(every.limit(0), every).count() == 0


def test_complete_ways(spark):
    every = network(spark)
    got = sorted((r["osm_type"], r["osm_id"]) for r in closure.complete_ways(every, -1, 0.15, 1, 0.25).collect())
    assert got == [("node", 0), ("node", 1), ("node", 2), ("node", 3), ("relation", 3), ("way", 1), ("way", 2)]
    assert closure.complete_ways(every, 5, 5, 6, 6).count() == 0


def test_no_join_of_the_assembly_is_a_broadcast(spark):
    line = [F.struct(F.lit(float(i)).alias("lat"), F.lit(float(i * i)).alias("lon")) for i in range(4)]
    ways = spark.range(3).select(F.col("id").alias("way_id"), F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3, 1)]).alias("nodes"), F.array(*line).alias("geometry"))
    members = ways.select(F.lit(1).cast("bigint").alias("relation_id"), F.lit("outer").alias("role"), "way_id")
    found = assembly.rings(members, ways)
    for df in (found, assembly.nested(found)):  # tables this small would be broadcast, and so would large ones whose size is guessed as small
        plan = df._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_elements_are_taken_apart_once(spark):
    rows = spark.createDataFrame([("way", i, None, None, [i, i + 1], None, None) for i in range(1, 9)] + [("node", i, 0.5, 0.5, None, None, None) for i in range(1, 10)], ELEMENT)
    rows = rows.mapInArrow(lambda batches: batches, ELEMENT)
    for found in (closure.complete_ways(rows, 0, 0, 1, 1), closure.with_referenced(rows.filter("osm_type = 'way'"), rows)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 0 and plan.count("MapInArrow") <= 2


def test_small_relations_take_no_rounds(spark, monkeypatch):
    """Ways of one task are stitched there: no table of darts is written, and the rings are those of the rounds."""
    rng, names = random.Random(4), []
    settled = assembly.settled
    monkeypatch.setattr(assembly, "settled", lambda df, name="part": (names.append(name), settled(df, name))[1])
    lines = {r: [(rng.choice(["outer", "inner"]), [(v, float(v), float(v * v % 7)) for v in (a, a + 100 * rng.randint(1, 9), b)]) for a, b in ((rng.randrange(5), rng.randrange(5)) for _ in range(rng.randint(1, 24)))] for r in range(60)}
    members, ways = made(spark, lines)
    ring = lambda df: sorted((r["relation_id"], r["inner"], r["ring_id"], [tuple(v) for v in r["ring"]]) for r in df.collect())
    here = ring(assembly.rings(members, ways))
    assert "darts" not in names and len({r[0] for r in here}) > 20 and max(len(r[3]) for r in here) > 6
    for local in (0, 6):
        monkeypatch.setattr(assembly, "LOCAL", local)
        assert ring(assembly.rings(members, ways)) == here
    assert "darts" in names
