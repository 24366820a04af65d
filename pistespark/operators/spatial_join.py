"""Distance and containment joins, as equi-joins on grid cells with the exact test behind them.

A point is in one cell; an area or polygon is dealt to all cells that it can reach. So a pair meets once, the
plan has a hash or sort-merge join on the cell and never a nested loop, Spark broadcasts the area side only
where it finds it small, and AQE splits a cell with very many points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.shared import settled, spread_join

#: Metres in a degree on the sphere that distances are taken on, and a margin for rounding.
_SPHERE_DEGREE, _MARGIN = geo.RADIUS_M * math.pi / 180, 1.01
#: Degrees of a cell for boundaries.
CELL = 0.5
#: Areas of a point that are one row.
CHUNK = 4096


def _row(lat: Column, size: float) -> Column:
    return F.floor((lat + 90) / size).cast("int")


def _column(lon: Column, size: float) -> Column:
    return F.floor((lon + 180) / size).cast("int")


def _columns(low: Column, high: Column, n: int) -> Column:
    """Of n cell columns, those from one longitude to another, around the antimeridian; all of them for a full turn."""
    a, b = _column(low, 360 / n), _column(high, 360 / n)
    some = F.sequence(a, F.least(b, a + n - 1))
    return F.array_distinct(F.transform(some, lambda c: F.pmod(c, F.lit(n))))


def radius_join(features: DataFrame, areas: DataFrame, radius_m: float, lat: str = "lat", lon: str = "lon", area_lat: str = "area_lat", area_lon: str = "area_lon", out: str = "distance_m") -> DataFrame:
    """Pairs of a feature and an area whose points are at most ``radius_m`` apart, with the distance.

    Columns of the two sides must differ in name. Rows without a point have no pair.
    """
    up = radius_m * _MARGIN / _SPHERE_DEGREE
    size = max(2 * up, 1e-4)
    n = max(1, math.floor(360 / size))
    wide = 360 / n  # columns that end at the antimeridian, so that counting goes around
    # the longitude span of a cap at the latitude nearest to the pole that it reaches
    reach = F.cos(F.radians(F.least(F.abs(F.col(area_lat)) + up, F.lit(90.0))))
    along = F.when(reach > 1e-3, F.least(F.lit(180.0), up / reach)).otherwise(F.lit(180.0))
    dealt = areas.filter(F.col(area_lat).isNotNull() & F.col(area_lon).isNotNull())
    dealt = dealt.withColumn("_cy", F.explode(F.sequence(_row(F.col(area_lat) - up, size), _row(F.col(area_lat) + up, size))))
    dealt = dealt.withColumn("_cx", F.explode(_columns(F.col(area_lon) - along, F.col(area_lon) + along, n)))
    placed = features.withColumn("_cy", _row(F.col(lat), size)).withColumn("_cx", F.pmod(_column(F.col(lon), wide), F.lit(n)))
    pairs = placed.join(dealt, ["_cy", "_cx"]).drop("_cy", "_cx")
    return pairs.withColumn(out, geo.haversine(F.col(lat), F.col(lon), F.col(area_lat), F.col(area_lon))).filter(F.col(out) <= radius_m)


def places(areas: DataFrame, lat: str = "area_lat", lon: str = "area_lon") -> tuple[DataFrame, DataFrame]:
    """(the points of areas, each once; the areas by point), for ``radius_join`` with the points and ``with_areas`` after it.

    However many areas are at a point, a feature meets it once, and all that is worked out for the pair is worked out once. Both
    are tables, so Spark knows how large they are before it plans: while the points are few, features are not shuffled to meet them."""
    rest = [c for c in areas.columns if c not in (lat, lon)]
    there = areas.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    points = settled(there.groupBy(lat, lon).agg(F.ceil(F.count("*") / CHUNK).alias("_n")), "places")
    part = F.pmod(F.xxhash64(*rest), F.col("_n")).alias("_part")
    by_point = spread_join(there, points, [lat, lon]).groupBy(lat, lon, part).agg(F.collect_list(F.struct(*rest)).alias("_areas")).drop("_part")
    return points.drop("_n"), settled(by_point, "areas")


def with_areas(near: DataFrame, by_point: DataFrame, lat: str = "area_lat", lon: str = "area_lon") -> DataFrame:
    """Rows with the point of an area as rows of each area there, with its columns in place of the point. by_point: as ``places`` gives it."""
    return near.join(by_point, [lat, lon]).select(*[c for c in near.columns if c not in (lat, lon)], F.inline("_areas"))


def representatives(areas: DataFrame, key: list[str], lat: str = "lat", lon: str = "lon") -> tuple[DataFrame, DataFrame]:
    """(areas that stand for all at their point, members): of areas at one point the least by ``key`` stands for them.

    members: the key of every area that has a point, and that of its representative as ``_rep_`` columns. What is near an area
    is near all at its point, so a join or a rollup needs the representatives only; ``expanded`` gives the others theirs. A key
    that comes several times, which may be at several points, stands for itself."""
    there = areas.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(*key).agg(F.count("*").alias("_n"), F.min(lat).alias("_y"), F.min(lon).alias("_x"))
    single, own = there.filter("_n = 1"), there.filter("_n > 1").select(*key, *[F.col(k).alias(f"_rep_{k}") for k in key])
    first = single.groupBy("_y", "_x").agg(F.min(F.struct(*key)).alias("_rep")).select("_y", "_x", *[F.col(f"_rep.{k}").alias(f"_rep_{k}") for k in key])
    members = single.join(first, ["_y", "_x"]).select(*key, *[f"_rep_{k}" for k in key]).unionByName(own)
    return areas.join(members.select(*[F.col(f"_rep_{k}").alias(k) for k in key]).distinct(), key, "left_semi"), members


def expanded(rows: DataFrame, members: DataFrame, key: list[str]) -> DataFrame:
    """Rows of representatives as rows of each area that they stand for. members: as ``representatives`` gives them, more columns may follow."""
    return rows.withColumnsRenamed({k: f"_rep_{k}" for k in key}).join(members, [f"_rep_{k}" for k in key]).drop(*[f"_rep_{k}" for k in key])


def close_pairs(points: DataFrame, distance_m: float, key: str = "ordinal") -> DataFrame:
    """Pairs (a, b), a < b by key, of points at most ``distance_m`` apart, with the distance.

    Places are joined, not points: those at one place share their distances. Pairs of a point and a place are then dealt
    evenly over tasks by the point, so that no task has the pairs of a whole cell."""
    spark = points.sparkSession
    at = points.select(F.col(key).alias("b"), "lat", "lon")
    place = at.groupBy("lat", "lon").agg(F.min("b").alias("_p"))
    here = at.join(place, ["lat", "lon"]).select("b", "_p")
    near = radius_join(place.select(F.col("_p").alias("_q"), "lat", "lon"), place.select("_p", F.col("lat").alias("area_lat"), F.col("lon").alias("area_lon")), distance_m)
    own = near.select("_p", "_q", "distance_m").join(here.withColumnRenamed("b", "a"), "_p").select("a", "_q", "distance_m")
    dealt = own.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), "a", "_q")
    return dealt.join(here.withColumnRenamed("_p", "_q"), "_q").filter("a < b").select("a", "b", "distance_m")


def _edges(parts: Column) -> Column:
    """All edges (a, b) of all rings of all polygons."""
    ring = lambda r: F.zip_with(r, F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.flatten(F.flatten(F.transform(parts, lambda p: F.transform(p, ring))))


def _meets(e: Column, field: str, low: Column, high: Column) -> Column:
    return (F.greatest(e["a"][field], e["b"][field]) >= low - 1e-9) & (F.least(e["a"][field], e["b"][field]) <= high + 1e-9)


def _crossing(e: Column, at: Column, across: str, along: str) -> Column:
    """Where an edge that passes ``at`` in one coordinate is in the other."""
    a, b = e["a"], e["b"]
    return a[along] + (at - a[across]) * (b[along] - a[along]) / (b[across] - a[across])


def _passes(e: Column, at: Column, across: str) -> Column:
    return (e["a"][across] > at) != (e["b"][across] > at)


def clipped(polygons: DataFrame, cell: float = 0.5, parts: str = "parts") -> DataFrame:
    """Polygons dealt to grid cells: _cy, _cx, _edges (those that meet the cell), _ry, _rx (a point of the cell) and
    _in (whether the polygon holds it), in place of ``parts``. Cells that a polygon does not touch have no row.

    No row has more of a polygon than its cell needs. It takes no shuffle: a polygon's edges are first narrowed to a
    row of cells and then to a cell. What the point's place says decides for the whole cell: the way from it to any
    other point of the cell meets no edges but the cell's."""
    kept = [c for c in polygons.columns if c != parts]
    ends = lambda f: F.flatten(F.transform("_e", lambda e: F.array(e["a"][f], e["b"][f])))
    out = polygons.withColumn("_e", _edges(F.col(parts))).filter(F.size("_e") > 0).select(*kept, "_e", F.array_min(ends("lat")).alias("_y0"), F.array_max(ends("lat")).alias("_y1"), F.array_min(ends("lon")).alias("_x0"), F.array_max(ends("lon")).alias("_x1"))
    out = out.select(*kept, "_e", "_x0", "_x1", F.explode(F.sequence(_row(F.col("_y0"), cell), _row(F.col("_y1"), cell))).alias("_cy"))
    low = F.col("_cy") * cell - 90
    out = out.select(*kept, "_cy", "_x0", "_x1", (low + cell * 0.45678913).alias("_ry"), F.filter("_e", lambda e: _meets(e, "lat", low, low + cell)).alias("_r"))
    out = out.withColumn("_xs", F.transform(F.filter("_r", lambda e: _passes(e, F.col("_ry"), "lat")), lambda e: _crossing(e, F.col("_ry"), "lat", "lon")))
    out = out.withColumn("_cx", F.explode(F.sequence(_column(F.col("_x0"), cell), _column(F.col("_x1"), cell)))).drop("_x0", "_x1")
    left = F.col("_cx") * cell - 180
    out = out.select(*kept, "_cy", "_cx", "_ry", (left + cell * 0.54321987).alias("_rx"), "_xs", F.filter("_r", lambda e: _meets(e, "lon", left, left + cell)).alias("_edges"))
    out = out.select(*kept, "_cy", "_cx", "_ry", "_rx", "_edges", (F.size(F.filter("_xs", lambda x: x > F.col("_rx"))) % 2 == 1).alias("_in"))
    return out.filter(F.col("_in") | (F.size("_edges") > 0))


def _inside(lat: Column, lon: Column, c: Column) -> Column:
    """Whether a point of a cell is strictly inside the polygon of a row ``c`` of ``clipped``."""
    along = lambda e: _passes(e, lat, "lat") & ((_crossing(e, lat, "lat", "lon") > lon) != (_crossing(e, lat, "lat", "lon") > c["_rx"]))
    up = lambda e: _passes(e, c["_rx"], "lon") & ((_crossing(e, c["_rx"], "lon", "lat") > lat) != (_crossing(e, c["_rx"], "lon", "lat") > c["_ry"]))
    turns = F.aggregate(c["_edges"], F.lit(0), lambda n, e: n + along(e).cast("int") + up(e).cast("int"))
    cross = lambda e: (e["b"]["lon"] - e["a"]["lon"]) * (lat - e["a"]["lat"]) - (lon - e["a"]["lon"]) * (e["b"]["lat"] - e["a"]["lat"])
    within = lambda e, f, x: x.between(F.least(e["a"][f], e["b"][f]), F.greatest(e["a"][f], e["b"][f]))
    on = F.exists(c["_edges"], lambda e: (cross(e) == 0) & within(e, "lon", lon) & within(e, "lat", lat))
    return (c["_in"] != (turns % 2 == 1)) & ~on


def containment_join(points: DataFrame, polygons: DataFrame, cell: float = 0.5, parts: str = "parts") -> DataFrame:
    """Pairs of a point (lat, lon) and a polygon that it is strictly inside of.

    polygons: ``parts``, an array of polygons, each an array of rings, outer first. Columns must differ in name.
    """
    placed = points.withColumn("_cy", _row(F.col("lat"), cell)).withColumn("_cx", _column(F.col("lon"), cell))
    c = F.struct("_edges", "_in", "_rx", "_ry")
    return placed.join(clipped(polygons, cell, parts), ["_cy", "_cx"]).filter(_inside(F.col("lat"), F.col("lon"), c)).drop("_cy", "_cx", "_edges", "_in", "_rx", "_ry")


def cell_rows(polygons: DataFrame, take: list[str], ordinal: str = "ordinal", size: float = CELL) -> DataFrame:
    """(_cy, _cx, _polygons): a row for each cell, with its polygons' ``take`` values, each with its ordinal, and what decides there.

    Equal polygons are one, which has the first non-null value of each column: a cell has no more than its different shapes."""
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(ordinal).alias("o"), F.col(c).alias("v")))).alias(f"_t_{c}") for c in take]
    own = polygons.groupBy("parts").agg(*first).filter(F.coalesce(*[F.col(f"_t_{c}.o") for c in take]).isNotNull())
    return clipped(own, size).groupBy("_cy", "_cx").agg(F.collect_list(F.struct(*[f"_t_{c}" for c in take], "_edges", "_in", "_rx", "_ry")).alias("_polygons"))


def in_cells(points: DataFrame, cells: DataFrame, take: list[str], size: float = CELL, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """All points, each with the first non-null value of every ``take`` column over the polygons of ``cell_rows`` that hold it."""
    met = points.withColumn("_cy", _row(F.col(lat), size)).withColumn("_cx", _column(F.col(lon), size)).join(cells, ["_cy", "_cx"], "left")
    met = met.withColumn("_polygons", F.transform(F.filter("_polygons", lambda c: _inside(F.col(lat), F.col(lon), c)), lambda c: F.struct(*[c[f"_t_{t}"].alias(t) for t in take])))
    first = lambda t: F.array_min(F.transform("_polygons", lambda c: c[t]))["v"]
    return met.withColumns({t: first(t) for t in take}).drop("_cy", "_cx", "_polygons")


def first_match(points: DataFrame, polygons: DataFrame, take: list[str], ordinal: str = "ordinal", cell: float = CELL, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """All points, each with the first non-null value of every ``take`` column over the polygons that it is inside of, by ordinal.

    The first is taken per column, so values may come from two polygons. The polygons of a cell are one row, as many as
    overlap there, so every point meets one row: it is read once, stays one row, and moves only if the cells are too
    many to broadcast. A point without a place gets nulls."""
    return in_cells(points, cell_rows(polygons, take, ordinal, cell), take, cell, lat, lon)
