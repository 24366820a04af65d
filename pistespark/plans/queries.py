"""The registered queries of the map operators, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.functions import tags as tg
from pistespark.operators import assembly, cells, closure, cluster, combine, enrich, features, rollup, spatial_join, ways
from pistespark.plans import jobs, views
from pistespark.shared import shared_dir, table, written
from pistespark.sources import publish, readers, rejects, sinks

RADIUS_M, LINK_M = 2000.0, 120_000.0
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _hav(y1: str, x1: str, y2: str, x2: str) -> str:
    a = f"(pow(sin(radians({y2}-{y1})/2),2)+cos(radians({y1}))*cos(radians({y2}))*pow(sin(radians({x2}-{x1})/2),2))"
    return f"(2*CAST(6371000 AS DOUBLE)*atan2(sqrt({a}),sqrt(1-{a})))"


_LINES = f""", seg AS (SELECT *, lead(lat) OVER w nlat, lead(lon) OVER w nlon, first_value(lat) OVER w flat, first_value(lon) OVER w flon,
  avg(lat) OVER (PARTITION BY way_id) mlat, count(*) OVER (PARTITION BY way_id) n FROM way_vertex WINDOW w AS (PARTITION BY way_id ORDER BY pos)),
wl AS (SELECT way_id, count(*) n, avg(lat) lat, avg(lon) lon, coalesce(sum({_hav('lat', 'lon', 'nlat', 'nlon')}), 0) m FROM seg GROUP BY way_id),
wa AS (SELECT way_id, abs(sum(x*y2-x2*y))/2 m2 FROM (SELECT way_id, lon*111320*cos(radians(mlat)) x, lat*111320 y,
  coalesce(nlon,flon)*111320*cos(radians(mlat)) x2, coalesce(nlat,flat)*111320 y2 FROM seg WHERE n>=3) GROUP BY way_id)"""
_PAIRS = f""", pair AS (SELECT way_id, n, m, area_type, area_id, {_hav('lat', 'lon', 'lat0', 'lon0')} d FROM wl, area
  WHERE abs(lat-lat0)<0.02 AND abs(lon-lon0)<0.04 AND {_hav('lat', 'lon', 'lat0', 'lon0')}<=2000)"""
_ADMIN = """, pa AS (SELECT area_type, area_id, name, lat0, lon0, h, (SELECT coalesce(nullif(trim(admin),''), nullif(trim(name_long),'')) FROM admin0 WHERE lon0>x0 AND lon0<x1 AND lat0>y0 AND lat0<y1) country,
  (SELECT coalesce(nullif(trim(b.name),''), nullif(trim(b.admin),'')) FROM admin1 b WHERE lon0>x0 AND lon0<x1 AND lat0>y0 AND lat0<y1) state FROM area)"""


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas, ways and nodes as elements."""
    area = views.areas(spark, sf_dir)
    area = area.select(F.col("area_type").alias("osm_type"), F.col("area_id").alias("osm_id"), F.col("area_id").alias("ordinal"), F.create_map(F.lit("landuse"), F.when(F.col("area_id") % 3 == 0, "meadow").otherwise("winter_sports"), F.lit("name"), F.col("name")).alias("tags"), "geometry")
    way = views.way_tags(spark, sf_dir).join(views.way_lines(spark, sf_dir), "way_id", "left").select(F.lit("way").alias("osm_type"), F.col("way_id").alias("osm_id"), F.col("way_id").alias("ordinal"), "tags", "geometry")
    node = views.view(spark, sf_dir, "node").select(F.lit("node").alias("osm_type"), F.col("node_id").alias("osm_id"), F.col("node_id").alias("ordinal"), F.create_map().cast("map<string,string>").alias("tags"), F.array(geo.vertex(F.col("lat"), F.col("lon"))).alias("geometry"))
    return area.unionByName(way).unionByName(node)


@_query(views.with_views("area") + "SELECT area_type osm_type, area_id osm_id, name FROM area WHERE area_id%3<>0")
def tag_filter_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.ski_areas(_elements(spark, sf_dir)).select("osm_type", "osm_id", F.col("tags")["name"].alias("name"))


@_query(views.with_views("way") + "SELECT way_id osm_id, aerialway, CASE WHEN aerialway IN ('station','pylon') THEN false ELSE true END is_lift FROM way WHERE aerialway IS NOT NULL")
def tag_filter_lifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.way_tags(spark, sf_dir).select(F.lit("way").alias("osm_type"), F.col("way_id").alias("osm_id"), "tags")
    return features.lifts_and_pistes(rows)[0].select("osm_id", F.col("tags")["aerialway"].alias("aerialway"), features.is_lift(F.col("tags")).alias("is_lift"))


@_query(views.with_views("way") + "SELECT way_id osm_id, piste_type, piste_difficulty FROM way WHERE piste_type IS NOT NULL")
def tag_filter_pistes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.way_tags(spark, sf_dir).select(F.lit("way").alias("osm_type"), F.col("way_id").alias("osm_id"), "tags")
    return features.lifts_and_pistes(rows)[1].select("osm_id", F.col("tags")["piste:type"].alias("piste_type"), F.col("tags")["piste:difficulty"].alias("piste_difficulty"))


@_query(
    views.with_views("area", "way", "node", "way_vertex")
    + """, v AS (SELECT *, count(*) OVER (PARTITION BY way_id) n, first_value(lat) OVER w flat, first_value(lon) OVER w flon, last_value(lat) OVER w llat, last_value(lon) OVER w llon
  FROM way_vertex WINDOW w AS (PARTITION BY way_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
closed AS (SELECT DISTINCT way_id FROM v WHERE n>=4 AND flat=llat AND flon=llon)
SELECT 'multipolygons' layer, area_type osm_type, area_id osm_id, 1 place FROM area
UNION ALL SELECT CASE WHEN c.way_id IS NULL THEN 'lines' ELSE 'multipolygons' END, 'way', w.way_id, CASE WHEN c.way_id IS NULL THEN 2 ELSE 1 END FROM way w LEFT JOIN closed c USING (way_id)
UNION ALL SELECT 'points', 'node', node_id, 3 FROM node"""
)
def layer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.merged_layers(features.layered(_elements(spark, sf_dir))).select("layer", "osm_type", "osm_id", F.col("place.layer").alias("place"))


@_query(views.with_views("way_vertex") + _LINES + "SELECT way_id, n vertices, round(m, 1) length_m FROM wl")
def way_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.way_lines(spark, sf_dir).select("way_id", F.size("geometry").cast("bigint").alias("vertices"), F.round(geo.line_length(F.col("geometry")), 1).alias("length_m"))


@_query(views.with_views("way_vertex") + _LINES + "SELECT way_id, round(m2/10000, 2) area_ha FROM wa")
def polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.way_lines(spark, sf_dir).filter(F.size("geometry") >= 3).select("way_id", F.round(geo.hectares(geo.polygon_area(F.col("geometry"))), 2).alias("area_ha"))


@_query(views.with_views("way_vertex") + "SELECT way_id, min(lat) minlat, min(lon) minlon, max(lat) maxlat, max(lon) maxlon FROM way_vertex GROUP BY way_id")
def ring_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.way_lines(spark, sf_dir).select("way_id", geo.ring_bounds(F.col("geometry")).alias("b")).select("way_id", "b.*")


@_query(views.with_views("way_vertex") + "SELECT way_id, round(avg(lat), 10) lat, round(avg(lon), 10) lon FROM way_vertex GROUP BY way_id")
def centroid_vertex_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.way_points(spark, sf_dir).select("way_id", F.round("lat", 10).alias("lat"), F.round("lon", 10).alias("lon"))


@_query(
    views.with_views("way_vertex")
    + _LINES
    + """, p AS (SELECT way_id, sqrt(pow(nlat-lat,2)+pow(nlon-lon,2)) m, (lat+nlat)/2 a, (lon+nlon)/2 o FROM seg),
c AS (SELECT way_id, sum(m) m, sum(m*a) a, sum(m*o) o FROM p GROUP BY way_id)
SELECT way_id, round(CASE WHEN c.m>0 THEN a/c.m ELSE lat END, 8) lat, round(CASE WHEN c.m>0 THEN o/c.m ELSE lon END, 8) lon FROM c JOIN wl USING (way_id)"""
)
def centroid_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.way_lines(spark, sf_dir).withColumn("c", geo.centroid_of_line(F.col("geometry")))
    return found.select("way_id", F.round("c.lat", 8).alias("lat"), F.round("c.lon", 8).alias("lon"))


@_query(
    views.with_views("way_vertex")
    + _LINES
    + """, r AS (SELECT way_id, flat, flon, lon-flon x, lat-flat y, coalesce(nlon,flon)-flon x2, coalesce(nlat,flat)-flat y2 FROM seg WHERE n>=3),
c AS (SELECT way_id, any_value(flat) flat, any_value(flon) flon, sum(x*y2-x2*y) s, sum((x*y2-x2*y)*(x+x2)) cx, sum((x*y2-x2*y)*(y+y2)) cy FROM r GROUP BY way_id)
SELECT way_id, round(CASE WHEN abs(s)>0.0000001 THEN flat+cy/(3*s) END+0.0000123, 4) lat, round(CASE WHEN abs(s)>0.0000001 THEN flon+cx/(3*s) END+0.0000123, 4) lon FROM c"""
)
def centroid_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.way_lines(spark, sf_dir).filter(F.size("geometry") >= 3).withColumn("m", geo._moments(F.col("geometry")))
    shift = 0.0000123  # no value then lies where rounding turns
    # a ring without area has no centroid of its own in either engine's sums: its is the line's, which centroid_line compares
    found = found.withColumn("c", F.when(F.abs("m.c") > 0.0000001, geo.centroid_of_polygon(F.array("geometry"))))
    return found.select("way_id", F.round(F.col("c.lat") + shift, 4).alias("lat"), F.round(F.col("c.lon") + shift, 4).alias("lon"))


_KIND = """, g AS (SELECT way_id, count(*) n, arg_min(lat, pos) flat, arg_min(lon, pos) flon, arg_max(lat, pos) llat, arg_max(lon, pos) llon FROM way_vertex GROUP BY way_id),
k AS (SELECT way_id, n, CASE WHEN n=1 THEN 'Point' WHEN n>=4 AND flat=llat AND flon=llon THEN 'Polygon' ELSE 'LineString' END kind FROM g)"""


@_query(views.with_views("way_vertex") + _KIND + "SELECT way_id, kind, n>=2 is_usable FROM k")
def geometry_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.way_lines(spark, sf_dir).select("way_id", geo.geometry_kind(F.col("geometry")).alias("kind"), (F.size("geometry") >= 2).alias("is_usable"))


@_query(
    views.with_views("node", "way_ref")
    + """SELECT way_id, count(*) refs, round(sum(lat), 4) lat_sum, round(sum(lon), 4) lon_sum, round(arg_min(lat, pos), 4) first_lat, round(arg_max(lon, pos), 4) last_lon
FROM way_ref LEFT JOIN node USING (node_id) GROUP BY way_id HAVING count(*)=count(lat) AND count(*)>=2"""
)
def way_from_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = views.view(spark, sf_dir, "node").withColumn("ordinal", F.col("node_id"))
    made = ways.assembled(views.view(spark, sf_dir, "way_ref"), nodes)
    total = lambda f: F.aggregate("geometry", F.lit(0.0), lambda a, v: a + v[f])
    g = F.col("geometry")
    return made.select("way_id", F.size(g).cast("bigint").alias("refs"), F.round(total("lat"), 4).alias("lat_sum"), F.round(total("lon"), 4).alias("lon_sum"), F.round(F.element_at(g, 1)["lat"], 4).alias("first_lat"), F.round(F.element_at(g, -1)["lon"], 4).alias("last_lon"))


@_query(views.with_views("area", "way_vertex") + _LINES + _PAIRS + "SELECT way_id, area_type, area_id, round(d, 1) distance_m FROM pair")
def nearby_radius_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, centers = spatial_join.places(views.areas(spark, sf_dir).select("area_type", "area_id", F.col("lat").alias("area_lat"), F.col("lon").alias("area_lon")))
    near = spatial_join.radius_join(views.way_points(spark, sf_dir).select("way_id", "lat", "lon"), points, RADIUS_M)
    near = near.select("way_id", "area_lat", "area_lon", F.round("distance_m", 1).alias("distance_m"))
    return spatial_join.with_areas(near, centers).select("way_id", "area_type", "area_id", "distance_m")


def _nearby(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(nearby ways as elements with the area that stands for those at its point, which areas those are)."""
    centers, members = spatial_join.representatives(views.areas(spark, sf_dir).select("area_type", "area_id", F.col("lat").alias("area_lat"), F.col("lon").alias("area_lon")), rollup.KEY, "area_lat", "area_lon")
    near = spatial_join.radius_join(views.way_points(spark, sf_dir), centers, RADIUS_M).join(views.way_tags(spark, sf_dir), "way_id")
    return near.select("area_type", "area_id", F.lit("way").alias("osm_type"), F.col("way_id").alias("osm_id"), F.col("way_id").alias("ordinal"), "tags", "geometry"), members


_MEASURED = _LINES + _PAIRS + """, f AS (SELECT pair.*, piste_type='downhill' down, lower(trim(piste_difficulty)) diff, grooming, piste_type, aerialway,
  aerialway IS NOT NULL AND aerialway NOT IN ('station','pylon') lift, coalesce(try_cast(piste_width AS DOUBLE), 30) width, m2 FROM pair JOIN way USING (way_id) LEFT JOIN wa USING (way_id)),
t AS (SELECT area_type, area_id, count(*) FILTER (down) downhill_trails, {diffs}, bool_or(down AND coalesce(grooming,'')='no') gladed,
  bool_or(coalesce(piste_type,'')='freestyle') park, bool_or(coalesce(piste_type,'') IN ('sled','tubing')) sled,
  coalesce(sum(CASE WHEN n>=3 THEN m2 ELSE m*width END) FILTER (down), 0) m2, max(m) FILTER (down AND n<3) longest, avg(m) FILTER (down AND n<3) mean FROM f GROUP BY ALL),
lt AS (SELECT area_type, area_id, aerialway, count(*) c, max(m) m FROM f WHERE lift GROUP BY ALL),
l AS (SELECT area_type, area_id, sum(c) total_lifts, max(m) longest_lift, string_agg(replace(aerialway,'_',' ')||': '||c, ', ' ORDER BY aerialway) lift_types FROM lt GROUP BY ALL)""".replace(
    "{diffs}", ", ".join(f"count(*) FILTER (down AND diff='{d}') trails_{d}" for d in rollup.DIFFICULTIES)
)
_TOTAL = "round_even(CASE WHEN area_type='relation' THEN 0 ELSE (2*h*111320)*(2*h*111320*cos(radians(lat0-h/5)))/10000 END, 2)"
_ROLLUP = (
    views.with_views("area", "way_vertex", "way", "admin0", "admin1")
    + _MEASURED
    + _ADMIN
    + f"""SELECT area_id winter_sports_id, area_type winter_sports_type, name, country, state, round_even(lat0, 6) centroid_lat, round_even(lon0, 6) centroid_lon,
  {_TOTAL} total_area_ha, round_even({_TOTAL}*2.47105, 0) total_area_acres, round_even(coalesce(m2,0)/10000, 2) skiable_terrain_ha, round_even(round_even(coalesce(m2,0)/10000, 2)*2.47105, 0) skiable_terrain_acres,
  CAST(coalesce(total_lifts,0) AS BIGINT) total_lifts, coalesce(round_even(longest_lift/1609.344, 2), 0) longest_lift_mi, coalesce(downhill_trails,0) downhill_trails,
  coalesce(round_even(longest/1609.344, 2), 0) longest_trail_mi, coalesce(round_even(mean/1609.344, 2), 0) avg_trail_mi, {', '.join(f'coalesce(trails_{d},0) trails_{d}' for d in rollup.DIFFICULTIES)},
  CASE WHEN gladed THEN 'Yes' ELSE 'No' END gladed_terrain, CASE WHEN park THEN 'Yes' ELSE 'No' END snow_park, CASE WHEN sled THEN 'Yes' ELSE 'No' END sledding_tubing, coalesce(lift_types,'') lift_types,
  CASE WHEN coalesce(m2,0)>0 OR coalesce(total_lifts,0)>0 OR coalesce(downhill_trails,0)>0 THEN 'downhill ski resort' ELSE 'not a downhill ski resort' END resort_type
FROM pa LEFT JOIN t USING (area_type, area_id) LEFT JOIN l USING (area_type, area_id)"""
)


@_query(_ROLLUP)
def area_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _nearby(spark, sf_dir)
    near = near.withColumnsRenamed({"area_id": "winter_sports_id", "area_type": "winter_sports_type"})
    return jobs.analyze(views.areas(spark, sf_dir).drop("lat", "lon"), near, views.countries(spark, sf_dir), views.states(spark, sf_dir), members=members)


@_query(
    views.with_views("area", "way_vertex", "way")
    + _LINES
    + _PAIRS
    + """, f AS (SELECT area_type, area_id, CAST(floor(way_id/2) AS BIGINT) osm_id, way_id, aerialway, m, row_number() OVER (PARTITION BY area_type, area_id, floor(way_id/2) ORDER BY way_id) r
  FROM pair JOIN way USING (way_id) WHERE aerialway NOT IN ('station','pylon'))
SELECT area_type, area_id, osm_id, aerialway lift, round(m, 1) lift_m FROM f WHERE r=1"""
)
def lift_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _nearby(spark, sf_dir)
    made = rollup.lifts(rollup.measures(near.withColumn("osm_id", F.expr("osm_id div 2")))).select("area_type", "area_id", "osm_id", "lift", F.round("lift_m", 1).alias("lift_m"))
    return spatial_join.expanded(made, members, rollup.KEY).select("area_type", "area_id", "osm_id", "lift", "lift_m")


@_query(views.with_views("area", "way_vertex", "way") + _MEASURED + "SELECT area_type, area_id, CAST(total_lifts AS BIGINT) total_lifts, round(longest_lift, 1) longest_lift_m, lift_types FROM l")
def lift_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _nearby(spark, sf_dir)
    made = spatial_join.expanded(rollup.lift_types(rollup.lifts(rollup.measures(near))), members, rollup.KEY)
    return made.select("area_type", "area_id", "total_lifts", F.round("longest_lift_m", 1).alias("longest_lift_m"), "lift_types")


@_query(views.with_views("area", "way_vertex", "way") + _MEASURED + f"SELECT area_type, area_id, downhill_trails, {', '.join(f'trails_{d}' for d in rollup.DIFFICULTIES)} FROM t")
def difficulty_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _nearby(spark, sf_dir)
    return spatial_join.expanded(rollup.trails(rollup.measures(near)), members, rollup.KEY).select("area_type", "area_id", "downhill_trails", *[f"trails_{d}" for d in rollup.DIFFICULTIES])


@_query(views.with_views("area", "way_vertex", "way") + _MEASURED + "SELECT area_type, area_id, " + ", ".join(f"CASE WHEN {c} THEN 'Yes' ELSE 'No' END {c}" for c in ("gladed", "park", "sled")) + " FROM t")
def terrain_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _nearby(spark, sf_dir)
    made = spatial_join.expanded(rollup.trails(rollup.measures(near)), members, rollup.KEY)
    return made.select("area_type", "area_id", *[rollup.yes_no(F.col(c)).alias(c) for c in ("gladed", "park", "sled")])


@_query(
    views.with_views("area", "way_vertex", "way")
    + _MEASURED
    + """SELECT area_type, area_id, CASE WHEN coalesce(m2,0)>0 OR coalesce(total_lifts,0)>0 OR coalesce(downhill_trails,0)>0 THEN 'downhill ski resort' ELSE 'not a downhill ski resort' END resort_type
FROM area LEFT JOIN t USING (area_type, area_id) LEFT JOIN l USING (area_type, area_id)"""
)
def resort_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _nearby(spark, sf_dir)
    made = views.areas(spark, sf_dir).select("area_type", "area_id").join(spatial_join.expanded(rollup.trails(rollup.measures(near)), members, rollup.KEY), rollup.KEY, "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    return made.select("area_type", "area_id", rollup.resort_type(n("terrain_m2"), n("total_lifts"), n("downhill_trails")).alias("resort_type"))


@_query(views.with_views("area", "admin0", "admin1") + _ADMIN + "SELECT area_type, area_id, country, state FROM pa")
def admin_pip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enrich.with_admin(views.areas(spark, sf_dir), views.countries(spark, sf_dir), views.states(spark, sf_dir))
    return out.select("area_type", "area_id", "country", "state")


@_query(views.with_views("area", "way_vertex", "admin0", "admin1") + _LINES + _ADMIN.replace("area_type, area_id, name, lat0, lon0, h,", "way_id,").replace("FROM area)", "FROM (SELECT way_id, lat lat0, lon lon0 FROM wl))") + "SELECT way_id, country, state FROM pa")
def admin_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways against an index of boundaries that is stored as a table bucketed by cell."""
    path = _out(spark, "cells")
    index = cells.kept(enrich.admin_cells(views.countries(spark, sf_dir), views.states(spark, sf_dir)), f"cells_{path.rsplit('-', 1)[1]}", 8, path)
    return enrich.with_admin(views.way_points(spark, sf_dir, stored=True), index).select("way_id", "country", "state")


@_query(
    views.with_views("area", "way_vertex")
    + """, c AS (SELECT way_id, avg(lat)+0.0000123 lat, avg(lon)+0.0000123 lon FROM way_vertex GROUP BY way_id)
SELECT way_id, (SELECT arg_min(name, area_id) FROM area WHERE lon>lon0-h AND lon<lon0+h AND lat>lat0-h AND lat<lat0+h) ski_area FROM c"""
)
def area_pip_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = 0.0000123  # no point then lies on an edge
    at = views.way_points(spark, sf_dir).select("way_id", (F.col("lat") + shift).alias("lat"), (F.col("lon") + shift).alias("lon"))
    return enrich.with_area(at, views.areas(spark, sf_dir)).select("way_id", "ski_area")


@_query(
    views.with_views("way_vertex", "admin0", "admin1")
    + """, f AS (SELECT way_id, 'A'||(way_id%70) area_name, CASE WHEN way_id%11<>0 THEN avg(lat) END lat, CASE WHEN way_id%11<>0 THEN avg(lon) END lon FROM way_vertex GROUP BY way_id),
d AS (SELECT 'A'||(s_suppkey%50) name, arg_max(struct_pack(c := CASE WHEN s_suppkey%4<>1 THEN n_name END, s := CASE WHEN s_suppkey%5<>2 THEN 'S'||s_nationkey END), s_suppkey) v
  FROM supplier JOIN nation ON s_nationkey=n_nationkey GROUP BY 1),
m AS (SELECT way_id, area_name, v.c c, v.s s, (v.c IS NULL OR v.s IS NULL) AND lat IS NOT NULL ask, lat, lon FROM f LEFT JOIN d ON area_name=name)
SELECT way_id, area_name, CASE WHEN ask THEN (SELECT coalesce(nullif(trim(admin),''), nullif(trim(name_long),'')) FROM admin0 WHERE lon>x0 AND lon<x1 AND lat>y0 AND lat<y1) ELSE c END country,
  CASE WHEN ask THEN (SELECT coalesce(nullif(trim(b.name),''), nullif(trim(b.admin),'')) FROM admin1 b WHERE lon>x0 AND lon<x1 AND lat>y0 AND lat<y1) ELSE s END state FROM m"""
)
def name_lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = views.way_points(spark, sf_dir, stored=True)
    there = F.col("way_id") % 11 != 0
    found = at.select("way_id", F.concat(F.lit("A"), (F.col("way_id") % 70).cast("string")).alias("area_name"), F.when(there, F.col("lat")).alias("lat"), F.when(there, F.col("lon")).alias("lon"))
    named = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    named = named.select(F.col("s_suppkey").alias("ordinal"), F.concat(F.lit("A"), (F.col("s_suppkey") % 50).cast("string")).alias("name"), F.when(F.col("s_suppkey") % 4 != 1, F.col("n_name")).alias("country"), F.when(F.col("s_suppkey") % 5 != 2, F.concat(F.lit("S"), F.col("s_nationkey").cast("string"))).alias("state"))
    return enrich.by_name(found, named, views.countries(spark, sf_dir), views.states(spark, sf_dir)).select("way_id", "area_name", "country", "state")


_BOX = "CAST(2000 AS DOUBLE)/111320 dy, CAST(2000 AS DOUBLE)/(111320*cos(radians(lat0))) dx"


@_query(views.with_views("area") + f", b AS (SELECT *, {_BOX} FROM area) SELECT area_id, round(lat0-dy, 6) minlat, round(lon0-dx, 6) minlon, round(lat0+dy, 6) maxlat, round(lon0+dx, 6) maxlon FROM b")
def area_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = views.areas(spark, sf_dir).select("area_id", geo.box_around(F.col("lat"), F.col("lon"), RADIUS_M).alias("b")).select("area_id", "b.*")
    return box.select("area_id", *[F.round(c, 6).alias(c) for c in ("minlat", "minlon", "maxlat", "maxlon")])


@_query(views.with_views("area") + f", b AS (SELECT *, {_BOX} FROM area) SELECT round(min(lon0-dx), 6) minlon, round(min(lat0-dy), 6) minlat, round(max(lon0+dx), 6) maxlon, round(max(lat0+dy), 6) maxlat FROM b")
def merged_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = features.merged_box(views.areas(spark, sf_dir), RADIUS_M)
    return box.select(*[F.round(c, 6).alias(c) for c in box.columns])


@_query(views.with_views("area") + "SELECT area_id, name FROM area WHERE lon0+h>=2 AND lon0-h<=5 AND lat0+h>=42 AND lat0-h<=47")
def viewport(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.view(spark, sf_dir, "area").select("area_id", "name", F.expr("lon0-h").alias("min_lon"), F.expr("lat0-h").alias("min_lat"), F.expr("lon0+h").alias("max_lon"), F.expr("lat0+h").alias("max_lat"))
    return features.viewport(rows, 2, 42, 5, 47).select("area_id", "name")


@_query(views.with_views("way_vertex") + "SELECT way_id, pos, lat, lon FROM way_vertex WHERE lon>=1 AND lon<=3 AND lat>=41 AND lat<=46")
def bbox_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.in_box(views.view(spark, sf_dir, "way_vertex"), 1, 41, 3, 46).select("way_id", F.col("pos").cast("bigint").alias("pos"), "lat", "lon")


_LINKS = f", e AS (SELECT x.area_id a, y.area_id b, {_hav('x.lat0', 'x.lon0', 'y.lat0', 'y.lon0')} d FROM area x, area y WHERE x.area_id<y.area_id AND {_hav('x.lat0', 'x.lon0', 'y.lat0', 'y.lon0')}<=120000)"


@_query(views.with_views("area") + _LINKS + "SELECT a, b, round(d, 0) distance_m FROM e")
def distance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial_join.close_pairs(views.areas(spark, sf_dir), LINK_M).select("a", "b", F.round("distance_m", 0).alias("distance_m"))


@_query(
    views.with_views("area")
    + _LINKS
    + """, s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), reach AS (SELECT area_id a, area_id b FROM area UNION SELECT reach.a, s.b FROM reach JOIN s ON reach.b=s.a)
SELECT a area_id, min(b) AS "cluster" FROM reach GROUP BY a"""
)
def single_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.single_linkage(views.areas(spark, sf_dir), LINK_M).select("area_id", "cluster")


@_query("SELECT event_id, CAST(event_id%7 AS VARCHAR)||' ' || 'b' AS k, event_type||', x' AS kind, NULL::VARCHAR AS none FROM events")
def hstore_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit('"k"=>"first","kind"=>"'), F.col("event_type"), F.lit(', x","k"=>"'), (F.col("event_id") % 7).cast("string"), F.lit(' b"'))
    m = tg.hstore(text)
    return e.select("event_id", m.alias("m")).select("event_id", F.col("m")["k"].alias("k"), F.col("m")["kind"].alias("kind"), F.col("m")["none"].alias("none"))


@_query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", tg.other_tags(F.col("props"))["k"].alias("k"))


@_query(views.with_views("way") + "SELECT way_id, aerialway, piste_type, grooming FROM way")
def tags_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = views.way_tags(spark, sf_dir).select("way_id", tg.json_tags(tg.tags_text(F.col("tags"))).alias("t"))
    return back.select("way_id", F.col("t")["aerialway"].alias("aerialway"), F.col("t")["piste:type"].alias("piste_type"), F.col("t")["piste:grooming"].alias("grooming"))


@_query("SELECT c_custkey, CASE WHEN c_custkey%4<2 THEN c_custkey ELSE 0 END AS id, CASE WHEN c_custkey%4<>2 THEN c_custkey END AS num FROM customer")
def id_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.when(key % 4 == 0, key.cast("string")).when(key % 4 == 1, F.concat(F.lit(" "), key.cast("string"), F.lit(" "))).when(key % 4 == 2, "n/a").otherwise(F.concat(key.cast("string"), F.lit(".7")))
    return table(spark, sf_dir, "customer").select("c_custkey", tg.text_id(text).alias("id"), tg.numeric_key(text).alias("num"))


@_query(
    """SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey%3=0 THEN '' WHEN c_custkey%3=1 THEN NULL ELSE c_name END, ''), c_mktsegment) AS label,
  coalesce(nullif(c_nationkey, 0), nullif(c_custkey, 0)) AS id FROM customer"""
)
def falsy_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 3 == 0, "").when(key % 3 == 2, F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", tg.first_of(name, F.col("c_mktsegment")).alias("label"), tg.first_id(F.col("c_nationkey"), key).alias("id"))


def _regions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers by region; the first region's table has a column that the others lack."""
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    names = {r["r_regionkey"]: r["r_name"] for r in table(spark, sf_dir, "region").collect()}
    return {name: rows.filter(F.col("n_regionkey") == k).select("s_suppkey", "s_name", *(["s_acctbal"] if k == 0 else [])) for k, name in names.items()}


@_query("SELECT s_suppkey, s_name, CASE WHEN n_regionkey=0 THEN s_acctbal END AS s_acctbal, r_name AS region FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey")
def combine_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.combined(_regions(spark, sf_dir)).select("s_suppkey", "s_name", "s_acctbal", "region")


@_query('SELECT r_name AS dataset, count(n_nationkey) AS "rows" FROM region LEFT JOIN (supplier JOIN nation ON s_nationkey=n_nationkey) ON n_regionkey=r_regionkey GROUP BY r_name')
def region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.row_counts(_regions(spark, sf_dir))


@_query("SELECT o_orderkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 500) WHERE o_orderstatus='O'")
def limit_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("ordinal", F.col("o_orderkey"))
    return features.first_n(rows, 500).filter("o_orderstatus = 'O'").select("o_orderkey")


def _out(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@_query(
    views.with_views("area", "way_vertex", "way")
    + _KIND
    + _LINES
    + _PAIRS
    + """SELECT pair.way_id osm_id, pair.area_id, CASE kind WHEN 'Point' THEN 21 WHEN 'LineString' THEN 9+16*k.n ELSE 13+16*k.n END wkb_bytes, aerialway, piste_type
FROM pair JOIN k USING (way_id) JOIN way USING (way_id)"""
)
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _out(spark, "nearby")
    near, members = _nearby(spark, sf_dir)
    sinks.nearby_parquet(near, path)
    back = readers.nearby_parquet(spark, path)
    back = back.select("osm_id", "area_type", "area_id", F.octet_length("wkb").cast("bigint").alias("wkb_bytes"), F.col("tags")["aerialway"].alias("aerialway"), F.col("tags")["piste:type"].alias("piste_type"))
    return spatial_join.expanded(back, members, rollup.KEY).select("osm_id", "area_id", "wkb_bytes", "aerialway", "piste_type")


@_query(_ROLLUP.replace("coalesce(lift_types,'') lift_types", "nullif(coalesce(lift_types,''),'') lift_types"))
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _out(spark, "analyzed")
    sinks.analyzed_csv(written(area_rollup(spark, sf_dir), "analyzed"), path)  # the sink reads its table twice
    return readers.analyzed_csv(spark, path)


@_query(views.with_views("area") + "SELECT area_id, name, 'Polygon' AS kind, CAST(5 AS BIGINT) AS vertices, round(lat0-h, 6) AS first_lat FROM area")
def geojson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _out(spark, "areas")
    sinks.geojson_lines(views.areas(spark, sf_dir), path, ["area_id", "name"])
    back = readers.geojson(spark, path, lines=True)
    return back.select(F.col("props")["area_id"].cast("bigint").alias("area_id"), F.col("props")["name"].alias("name"), "kind", F.size("geometry").cast("bigint").alias("vertices"), F.round(F.element_at("geometry", 1)["lat"], 6).alias("first_lat"))


@_query(f"SELECT count(*) AS \"rows\", CAST({len(readers.ANALYZED_DDL.split(','))} AS BIGINT) AS n_columns FROM supplier WHERE s_suppkey<0")
def empty_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _out(spark, "empty")
    area_rollup(spark, sf_dir).filter("winter_sports_id < 0").write.parquet(path)
    back = spark.read.parquet(path)
    return back.agg(F.count("*").alias("rows"), F.lit(len(back.columns)).cast("bigint").alias("n_columns"))


_NO_RING = f"array<array<{readers.RING}>>"


def _ways(spark: SparkSession, sf_dir: str, shift: float = 0.0) -> DataFrame:
    """Ways as features: ordinal, kind, props, geometry, parts, lines; vertices moved by ``shift``, so that none lies on an edge."""
    rows = views.way_lines(spark, sf_dir).join(views.way_tags(spark, sf_dir), "way_id")
    props = F.map_concat("tags", F.create_map(F.lit("osm_way_id"), F.col("way_id").cast("string"), F.lit("old_geometry"), F.lit("x"), F.lit("blank"), F.lit(" ")))
    moved = F.transform("geometry", lambda v: geo.vertex(v["lat"] + shift, v["lon"] + shift))
    none = lambda kind: F.lit(None).cast(kind)
    return rows.select(F.col("way_id").alias("ordinal"), F.lit("LineString").alias("kind"), props.alias("props"), moved.alias("geometry"), none(_NO_RING).alias("parts"), none(f"array<{readers.RING}>").alias("lines"))


_WITH_LINE = "(SELECT DISTINCT way_id FROM way_vertex)"


@_query(
    views.with_views("area", "way", "way_vertex")
    + f"""SELECT 'ski_areas' dataset, count(*) AS "rows" FROM area WHERE area_id%3<>0 UNION ALL SELECT 'lifts', count(*) FROM way JOIN {_WITH_LINE} USING (way_id) WHERE aerialway IS NOT NULL
UNION ALL SELECT 'pistes', count(*) FROM way JOIN {_WITH_LINE} USING (way_id) WHERE piste_type IS NOT NULL"""
)
def extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _out(spark, "extract")
    jobs.extract(_elements(spark, sf_dir), path)
    return jobs.counts({name: readers.geojson(spark, f"{path}/{name}.geojson", lines=True) for name in ("ski_areas", "lifts", "pistes")})


@_query(views.with_views("area") + "SELECT area_type, area_id, name, CAST(5 AS BIGINT) AS vertices, round(lat0-h, 6) AS first_lat FROM area WHERE area_id<>0")
def areas_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every area comes twice under its id; the last one counts, and 0 is no id."""
    path, rows = _out(spark, "areas"), views.areas(spark, sf_dir)
    both = rows.withColumn("name", F.lit("old")).unionByName(rows.withColumn("ordinal", F.col("ordinal") + 10_000_000_000))
    key = F.when(F.col("area_type") == "relation", "osm_relation_id").otherwise("osm_way_id")
    sinks.geojson_lines(both, path, F.create_map(key, F.col("area_id").cast("string"), F.lit("name"), F.col("name")))
    back = readers.areas_for_rollup(readers.geojson(spark, path, lines=True))
    return back.select("area_type", "area_id", "name", F.size("geometry").cast("bigint").alias("vertices"), F.round(F.get("geometry", F.lit(0))["lat"], 6).alias("first_lat"))


@_query(
    views.with_views("area")
    + """SELECT CASE WHEN area_id%5=0 THEN 'way' ELSE area_type END area_type, CASE WHEN area_id%5=0 THEN area_id+1000000 ELSE area_id END area_id,
  CASE WHEN area_id%7=0 THEN 'Unknown' ELSE name END name, CASE WHEN area_id%2=0 THEN 'Polygon' ELSE 'Point' END kind FROM area"""
)
def nearby_areas_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of any geometry; those without an id are numbered by their ordinal, those without a name are Unknown."""
    path, k = _out(spark, "areas"), F.col("area_id")
    rows = views.areas(spark, sf_dir).withColumn("ordinal", k + 1_000_000)
    point = F.array(geo.vertex(F.col("lat"), F.col("lon")))
    rows = rows.withColumn("geometry", F.when(k % 2 == 0, F.col("geometry")).otherwise(point)).withColumn("parts", F.when(k % 2 == 0, F.col("parts")))
    key = F.when(k % 5 == 0, "none").when(F.col("area_type") == "relation", "osm_relation_id").otherwise("osm_way_id")
    sinks.geojson_lines(rows, path, F.create_map(key, k.cast("string"), F.lit("name"), F.when(k % 7 == 0, "").otherwise(F.col("name"))))
    return readers.areas_for_nearby(readers.geojson(spark, path, lines=True)).select("area_type", "area_id", "name", "kind")


@_query(
    views.with_views("area", "way", "way_vertex", "node")
    + """SELECT area_type osm_type, area_id osm_id, area_id AS ordinal, CAST(5 AS BIGINT) vertices, name FROM area
UNION ALL SELECT 'way', w.way_id, w.way_id, v.n, NULL FROM way w LEFT JOIN (SELECT way_id, count(*) n FROM way_vertex GROUP BY 1) v USING (way_id)
UNION ALL SELECT 'node', node_id, node_id, 1, NULL FROM node"""
)
def elements_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _out(spark, "elements")
    sinks.element_lines(_elements(spark, sf_dir), path)
    back = readers.osm_json(spark, path, lines=True)
    return back.select("osm_type", "osm_id", F.col("ordinal"), F.size("geometry").cast("bigint").alias("vertices"), F.col("tags")["name"].alias("name")).withColumn("vertices", F.nullif("vertices", F.lit(-1).cast("bigint")))


@_query(views.with_views("area") + "SELECT area_id, name, 'Polygon' AS kind FROM area WHERE area_id%6<>0")
def layers_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are keyed by layer, 16 of them; features without a geometry are dropped."""
    path, rows = _out(spark, "layers"), views.areas(spark, sf_dir)
    gone = F.col("area_id") % 6 == 0
    rows = rows.withColumn("geometry", F.when(~gone, F.col("geometry"))).withColumn("parts", F.when(~gone, F.col("parts")))
    text = sinks.feature_text(rows.drop("ordinal"), F.create_map(F.lit("id"), F.col("area_id").cast("string"), F.lit("name"), F.col("name")))
    docs = text.groupBy((F.xxhash64("value") % 16).alias("doc")).agg(F.array_join(F.collect_list("value"), ",").alias("f"))
    docs.select("doc", F.concat(F.lit('{"points":{"features":[]},"multipolygons":{"features":['), "f", F.lit("]}}")).alias("value")).write.partitionBy("doc").text(path)
    return readers.geojson(spark, path).select(F.col("props")["id"].cast("bigint").alias("area_id"), F.col("props")["name"].alias("name"), "kind")


@_query(views.with_views("admin0") + "SELECT ordinal, coalesce(nullif(trim(admin),''), nullif(trim(name_long),'')) country, round(y1-y0, 6) height FROM admin0")
def boundaries_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, v = _out(spark, "admin"), views.view(spark, sf_dir, "admin0")
    rows = v.withColumn("geometry", views.box("x0", "x1", "y0", "y1")).withColumn("parts", F.array(F.array("geometry")))
    sinks.geojson_lines(rows, path, F.create_map(F.lit("ADMIN"), F.coalesce("admin", F.lit(" nan ")), F.lit("NAME_LONG"), F.concat(F.lit(" "), "name_long")))
    b = geo.ring_bounds(F.get(F.get("parts", F.lit(0)), F.lit(0)))
    return readers.boundaries(spark, path, tg.COUNTRY_NAMES, "country", lines=True).select(F.col("ordinal").cast("int").alias("ordinal"), "country", F.round(b["maxlat"] - b["minlat"], 6).alias("height"))


@_query(
    views.with_views("way_vertex")
    + """SELECT way_id, count(*) vertices, round(arg_min(lat, pos), 9) first_lat, round(arg_max(lon, pos), 9) last_lon, CASE WHEN count(*)=1 THEN round(any_value(lat), 9) END lat
FROM way_vertex GROUP BY way_id"""
)
def nearby_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that holds well-known binary only."""
    path = _out(spark, "wkb")
    views.way_lines(spark, sf_dir).select(F.col("way_id"), geo.wkb(F.col("geometry")).alias("geometry"), F.lit("{broken").alias("tags")).write.parquet(path)
    g = F.col("geometry")
    return readers.nearby_parquet(spark, path).select("way_id", F.size(g).cast("bigint").alias("vertices"), F.round(F.element_at(g, 1)["lat"], 9).alias("first_lat"), F.round(F.element_at(g, -1)["lon"], 9).alias("last_lon"), F.round("lat", 9).alias("lat"))


@_query(views.with_views("area") + "SELECT area_id winter_sports_id, name, CAST(21 AS BIGINT) wkb_bytes, round(lat0, 9) lat, round(lon0, 9) lon FROM area WHERE area_id%4<>1")
def area_points_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-area table with its areas' points; areas without one are left out."""
    path, rows = _out(spark, "points"), views.areas(spark, sf_dir)
    table = rows.select(F.col("area_type").alias("winter_sports_type"), F.col("area_id").alias("winter_sports_id"), "name")
    sinks.areas_parquet(table, rows.withColumn("lat", F.when(F.col("area_id") % 4 != 1, F.col("lat"))), path)
    at = F.get(geo.vertices_of_wkb(F.col("wkb")), F.lit(0))
    return spark.read.parquet(path).select("winter_sports_id", "name", F.octet_length("wkb").cast("bigint").alias("wkb_bytes"), F.round(at["lat"], 9).alias("lat"), F.round(at["lon"], 9).alias("lon"))


@_query(views.with_views("way", "way_vertex") + _KIND + "SELECT way_id, n>=2 OR kind='Point' is_usable, coalesce(aerialway, 'way/'||way_id) AS label FROM way JOIN k USING (way_id)")
def usable_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements whose geometry counts, and the names they are shown by. One vertex makes a point of a node, so those stay."""
    rows = views.way_lines(spark, sf_dir).join(views.way_tags(spark, sf_dir), "way_id")
    kind = F.when(F.size("geometry") == 1, "node").otherwise("way")
    rows = rows.select("way_id", kind.alias("osm_type"), "geometry", F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.map_filter(F.create_map(F.lit("name:en"), F.lit(""), F.lit("name"), F.col("tags")["aerialway"]), lambda k, v: v.isNotNull()).alias("tags"))
    return features.usable(rows).select("way_id", F.lit(True).alias("is_usable"), tg.display_name(F.col("tags"), F.lit("way"), F.col("way_id")).alias("label"))


@_query(views.with_views("way_vertex", "node") + _KIND + "SELECT 'way' osm_type, way_id osm_id, n vertices FROM k WHERE n>=2 UNION ALL SELECT 'node', node_id, 1 FROM node")
def usable_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways of one vertex, and those of none, are dropped; a node's one vertex counts."""
    none = F.lit(None).cast("double")
    way = views.way_lines(spark, sf_dir).select(F.lit("way").alias("osm_type"), F.col("way_id").alias("osm_id"), "geometry", none.alias("lat"), none.alias("lon"))
    empty = way.select("osm_type", (-F.col("osm_id")).alias("osm_id"), F.slice("geometry", 1, 0).alias("geometry"), "lat", "lon")
    node = views.view(spark, sf_dir, "node").select(F.lit("node").alias("osm_type"), F.col("node_id").alias("osm_id"), F.array(geo.vertex(F.col("lat"), F.col("lon"))).alias("geometry"), none.alias("lat"), none.alias("lon"))
    return features.usable(way.unionByName(empty).unionByName(node)).select("osm_type", "osm_id", F.size("geometry").cast("bigint").alias("vertices"))


@_query(
    views.with_views("way_vertex")
    + _KIND
    + """SELECT way_id, CASE way_id%3 WHEN 0 THEN 'MultiLineString' WHEN 1 THEN 'MultiPolygon' ELSE 'Polygon' END kind, g.n vertices,
  CASE way_id%3 WHEN 1 THEN 2 WHEN 2 THEN 1 END n_parts, CASE way_id%3 WHEN 0 THEN 2 END n_lines, round(flat, 6) first_lat, round(llon, 6) last_lon FROM g"""
)
def nested_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and polygons of several parts as one row of vertices: all parts of a line, the first outer ring of polygons."""
    path, g, n = _out(spark, "nested"), F.col("geometry"), F.size("geometry")
    place = lambda v: F.array(v["lon"], v["lat"])
    line, inner = F.transform(g, place), F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))
    half = F.floor(n / 2).cast("int")
    coords = (
        F.when(F.col("way_id") % 3 == 0, F.to_json(F.array(F.slice(line, 1, half), F.slice(line, half + 1, n))))
        .when(F.col("way_id") % 3 == 1, F.to_json(F.array(F.array(line, inner), F.array(inner))))
        .otherwise(F.to_json(F.array(line, inner)))
    )
    kind = F.get(F.array(F.lit("MultiLineString"), F.lit("MultiPolygon"), F.lit("Polygon")), (F.col("way_id") % 3).cast("int"))
    text = F.concat(F.lit('{"type":"Feature","properties":{"id":'), F.col("way_id").cast("string"), F.lit('},"geometry":{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}}"))
    views.way_lines(spark, sf_dir).select(text.alias("value")).write.text(path)
    back, size = readers.geojson(spark, path, lines=True), lambda c: F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint")
    return back.select(F.col("props")["id"].cast("bigint").alias("way_id"), "kind", F.size("geometry").cast("bigint").alias("vertices"), size("parts").alias("n_parts"), size("lines").alias("n_lines"), F.round(F.element_at("geometry", 1)["lat"], 6).alias("first_lat"), F.round(F.element_at("geometry", -1)["lon"], 6).alias("last_lon"))


@_query(
    views.with_views("area", "way_vertex", "node")
    + """, o AS (SELECT area_id, count(*) n, min(lat) lat FROM area JOIN way_vertex ON way_id=area_id WHERE area_id%3=2 GROUP BY area_id)
SELECT area_type osm_type, area_id osm_id, CASE WHEN area_id%3=0 THEN 1 WHEN area_id%3=2 THEN 2*coalesce(n,0) ELSE 5 END vertices, round(CASE WHEN area_id%3=0 THEN lat0 WHEN area_id%3=2 THEN o.lat ELSE lat0-h END, 6) low
FROM area LEFT JOIN o USING (area_id) UNION ALL SELECT 'node', node_id, 1, round(lat, 6) FROM node"""
)
def element_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What elements are measured by: a node's point, a way's line, a relation's middle, or its outer members twice over here."""
    k, none = F.col("area_id"), lambda kind: F.lit(None).cast(kind)
    line = views.way_lines(spark, sf_dir).select(F.col("way_id").alias("area_id"), F.col("geometry").alias("line"))
    rows = views.areas(spark, sf_dir).join(line, "area_id", "left")
    one = lambda role, g: F.struct(F.lit("way").alias("type"), k.alias("ref"), F.lit(role).alias("role"), g.alias("geometry"))
    members = F.array(one("outer", F.col("line")), one("inner", F.col("geometry")), one("outer", F.col("line")))
    made = rows.select(F.when(k % 3 == 1, "way").otherwise("relation").alias("osm_type"), "area_type", k.alias("osm_id"), none("double").alias("lat"), none("double").alias("lon"), F.when(k % 3 == 1, F.col("geometry")).alias("geometry"), F.when(k % 3 == 0, geo.ring_bounds(F.col("geometry"))).alias("bounds"), F.when(k % 3 == 2, members).alias("members"))
    node = views.view(spark, sf_dir, "node").select(F.lit("node").alias("osm_type"), F.lit("node").alias("area_type"), F.col("node_id").alias("osm_id"), "lat", "lon", none(readers.RING).alias("geometry"), none(readers.BOUNDS).alias("bounds"), none(readers.MEMBERS).alias("members"))
    g = F.col("geometry")
    out = readers.measured_elements(made.unionByName(node))
    return out.select(F.col("area_type").alias("osm_type"), "osm_id", geo.n_vertices(g).cast("int").alias("vertices"), F.round(F.array_min(F.transform(g, lambda v: v["lat"])), 6).alias("low"))


_LINE_CENTER = """, p AS (SELECT way_id, sqrt(pow(nlat-lat,2)+pow(nlon-lon,2)) m, (lat+nlat)/2 a, (lon+nlon)/2 o FROM seg),
c0 AS (SELECT way_id, sum(m) m, sum(m*a) a, sum(m*o) o FROM p GROUP BY way_id),
cl AS (SELECT way_id, n, CASE WHEN c0.m>0 THEN a/c0.m ELSE lat END lat, CASE WHEN c0.m>0 THEN o/c0.m ELSE lon END lon FROM c0 JOIN wl USING (way_id))"""


@_query(
    views.with_views("area", "way", "way_vertex")
    + _LINES
    + _LINE_CENTER
    + f"""SELECT way_id osm_id, area_id winter_sports_id, area_type winter_sports_type, name winter_sports_name, aerialway, CAST((aerialway IS NOT NULL)::int + (piste_type IS NOT NULL)::int + 1 + (grooming IS NOT NULL)::int + (piste_width IS NOT NULL)::int AS BIGINT) n_tags
FROM cl JOIN way USING (way_id), area WHERE n>=2 AND abs(lat-lat0)<0.02 AND abs(lon-lon0)<0.04 AND {_hav('lat', 'lon', 'lat0', 'lon0')}<=2000"""
)
def nearby_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = views.areas(spark, sf_dir).withColumn("kind", F.lit("Polygon")).withColumn("lines", F.lit(None).cast(f"array<{readers.RING}>"))
    out, members = jobs.nearby_places(_ways(spark, sf_dir), areas, RADIUS_M)
    out = out.select("area_lat", "area_lon", "osm_id", F.col("tags")["aerialway"].alias("aerialway"), (F.size("tags") - F.when(F.map_contains_key("tags", F.lit("blank")), 1).otherwise(0)).cast("bigint").alias("n_tags"))
    return spatial_join.with_areas(out, members).select("osm_id", F.col("area_id").alias("winter_sports_id"), F.col("area_type").alias("winter_sports_type"), F.col("area_name").alias("winter_sports_name"), "aerialway", "n_tags")


_IN_ADMIN = """(SELECT coalesce(nullif(trim(admin),''), nullif(trim(name_long),'')) FROM admin0 WHERE lon>x0 AND lon<x1 AND lat>y0 AND lat<y1) country,
  (SELECT coalesce(nullif(trim(b.name),''), nullif(trim(b.admin),'')) FROM admin1 b WHERE lon>x0 AND lon<x1 AND lat>y0 AND lat<y1) state"""


@_query(
    views.with_views("area", "way", "way_vertex", "admin0", "admin1")
    + _LINES
    + _LINE_CENTER
    + f""", s AS (SELECT way_id, lat+0.0000123 lat, lon+0.0000123 lon FROM cl JOIN way USING (way_id))
SELECT way_id, {_IN_ADMIN}, (SELECT arg_min(name, area_id) FROM area WHERE lon>lon0-h AND lon<lon0+h AND lat>lat0-h AND lat<lat0+h) ski_area FROM s"""
)
def enrich_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.enrich_features(_ways(spark, sf_dir, 0.0000123), views.countries(spark, sf_dir), views.states(spark, sf_dir), views.areas(spark, sf_dir))
    return out.select(F.col("ordinal").alias("way_id"), "country", "state", "ski_area")


@_query(SQL["name_lookup_fallback"].replace("SELECT way_id, area_name, CASE", "SELECT way_id, CASE WHEN way_id%3=0 THEN 'own' ELSE area_name END ski_area, CASE"))
def enrich_nearby_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with neither point nor line keep what their area's name says."""
    k, none = F.col("way_id"), F.lit(None).cast("double")
    rows = views.way_lines(spark, sf_dir, stored=True).select("way_id", F.concat(F.lit("A"), (k % 70).cast("string")).alias("winter_sports_name"), F.when(k % 3 == 0, "own").otherwise("").alias("ski_area"), F.when(k % 11 != 0, F.col("geometry")).alias("geometry"), none.alias("lat"), none.alias("lon"))
    named = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    n = F.col("s_suppkey")
    named = named.select(n.alias("ordinal"), F.concat(F.lit("A"), (n % 50).cast("string")).alias("name"), F.when(n % 4 != 1, F.col("n_name")).alias("country"), F.when(n % 5 != 2, F.concat(F.lit("S"), F.col("s_nationkey").cast("string"))).alias("state"))
    return jobs.enrich_nearby(rows, named, views.countries(spark, sf_dir), views.states(spark, sf_dir)).select("way_id", "ski_area", "country", "state")


@_query("SELECT way_id, area_name, coalesce(country,'Unknown') country, coalesce(state,'Unknown') state FROM (" + SQL["name_lookup_fallback"] + ")")
def filled_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What neither the name nor a boundary gives has a default."""
    return enrich.filled(QUERIES["name_lookup_fallback"](spark, sf_dir), {"country": "Unknown", "state": "Unknown"})


@_query(
    views.with_views("node", "admin0", "admin1")
    + """SELECT node_id osm_id, (SELECT coalesce(nullif(trim(admin),''), nullif(trim(name_long),'')) FROM admin0 WHERE lon>x0 AND lon<x1 AND lat>y0 AND lat<y1) country,
  (SELECT coalesce(nullif(trim(b.name),''), nullif(trim(b.admin),'')) FROM admin1 b WHERE lon>x0 AND lon<x1 AND lat>y0 AND lat<y1) state,
  CASE WHEN node_id%3=0 THEN 'own' END ski_area FROM node"""
)
def enrich_own_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An element's own point goes before the middle of its vertices, which here is in another country."""
    node, none = views.view(spark, sf_dir, "node"), F.lit(None).cast("string")
    away = F.array(geo.vertex(F.col("lat"), F.col("lon") + 4.0), geo.vertex(F.col("lat") - 6.0, F.col("lon") + 2.0))
    rows = node.select(F.col("node_id").alias("osm_id"), none.alias("winter_sports_name"), F.when(F.col("node_id") % 3 == 0, "own").otherwise("").alias("ski_area"), away.alias("geometry"), "lat", "lon")
    names = views.areas(spark, sf_dir).select("ordinal", "name", "country", "state")
    return jobs.enrich_nearby(rows, names, views.countries(spark, sf_dir), views.states(spark, sf_dir)).select("osm_id", "country", "state", "ski_area")


@_query(
    """SELECT 'ski_areas' dataset, r_name AS region, count(*) AS "rows" FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey WHERE r_regionkey<>1 GROUP BY r_name
UNION ALL SELECT 'ski_areas_analyzed', r_name, count(*) FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey GROUP BY r_name"""
)
def regions_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's folder is exported and all are combined; one region has no areas' file, and a folder named combined is none."""
    root = _out(spark, "regions")
    home = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").cast("bigint").alias("area_id"), "n_regionkey")
    areas = views.areas(spark, sf_dir).join(home, "area_id")
    nearby = spark.createDataFrame([], f"area_type string, area_id bigint, osm_type string, osm_id bigint, ordinal bigint, tags map<string,string>, geometry {readers.RING}")
    for r in table(spark, sf_dir, "region").collect():
        own, at = areas.filter(F.col("n_regionkey") == r["r_regionkey"]).drop("n_regionkey"), f"{root}/{r['r_name']}"
        if r["r_regionkey"] != 1:
            sinks.geojson_lines(own, f"{at}/ski_areas.geojson", ["area_id", "name"])
        sinks.analyzed_csv(rollup.area_rollup(own, nearby), f"{at}/ski_areas_analyzed.csv")
        jobs.export(spark, at)
    sinks.analyzed_csv(rollup.area_rollup(areas, nearby), f"{root}/combined/ski_areas_analyzed.csv")
    jobs.export(spark, f"{root}/combined")
    found = jobs.combine_all(spark, root, f"{root}-out")
    each = [spark.read.parquet(f"{root}-out/{name}.parquet").groupBy("region").agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "region", "rows") for name in found]
    return each[0].unionByName(each[1])


@_query("SELECT r_name AS region, '2024-02' AS month, count(*) AS \"rows\" FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey WHERE r_regionkey<>0 OR s_suppkey%2=0 GROUP BY r_name")
def publish_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over one region replaces that region's month and nothing else."""
    path = _out(spark, "published")
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("s_suppkey", "r_regionkey", F.col("r_name").alias("region"))
    sinks.published(rows, path, "2024-02")
    sinks.published(rows.filter("r_regionkey = 0 AND s_suppkey % 2 = 0"), path, "2024-02")
    return spark.read.schema("s_suppkey bigint, region string, month string").parquet(path).groupBy("region", "month").agg(F.count("*").alias("rows"))


@_query(
    views.with_views("area", "way", "way_vertex", "admin0", "admin1")
    + _LINES
    + _LINE_CENTER
    + _KIND
    + """, pr AS (SELECT way_id, flat, flon, lon-flon x, lat-flat y, coalesce(nlon,flon)-flon x2, coalesce(nlat,flat)-flat y2 FROM seg JOIN k USING (way_id) WHERE kind='Polygon'),
pp AS (SELECT way_id, any_value(flat) flat, any_value(flon) flon, sum(x*y2-x2*y) s, sum((x*y2-x2*y)*(x+x2)) cx, sum((x*y2-x2*y)*(y+y2)) cy FROM pr GROUP BY way_id),
cc AS (SELECT way_id, n, CASE WHEN abs(s)>1e-14 THEN flat+cy/(3*s) ELSE lat END lat, CASE WHEN abs(s)>1e-14 THEN flon+cx/(3*s) ELSE lon END lon FROM cl LEFT JOIN pp USING (way_id))"""
    + _ADMIN
    + f""", f AS (SELECT area_type, area_id, count(*) FILTER (piste_type='downhill') t, count(*) FILTER (aerialway NOT IN ('station','pylon')) l FROM cc JOIN way USING (way_id), area
  WHERE n>=2 AND abs(lat-lat0)<0.02 AND abs(lon-lon0)<0.04 AND {_hav('lat', 'lon', 'lat0', 'lon0')}<=2000 GROUP BY ALL)
SELECT area_type winter_sports_type, area_id winter_sports_id, name, country, state, coalesce(t, 0) downhill_trails, coalesce(l, 0) total_lifts, round_even(lat0, 6) centroid_lat FROM pa LEFT JOIN f USING (area_type, area_id) WHERE area_id%3<>0"""
)
def region_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region's whole run over the elements, from extraction to the exported table."""
    path = _out(spark, "region")
    jobs.region(spark, _elements(spark, sf_dir), views.countries(spark, sf_dir), views.states(spark, sf_dir), path)
    return spark.read.parquet(f"{path}/ski_areas_analyzed.parquet").select("winter_sports_type", "winter_sports_id", "name", "country", "state", "downhill_trails", "total_lifts", "centroid_lat")


#: A ring of n vertices with a node in the middle of each side, around (x, y), for relation o: 0 outer, 1 inner, 2 a second outer one.
_RADII = {0: 0.01, 1: 0.004, 2: 0.006}


def _rings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(members, ways) of a relation for each order: rings of as many sides as it has lines and four, every side a way of three nodes
    that may run backwards; every 11th lacks one, every third has a hole, every fifth a second polygon, which is one closed way."""
    o = F.col("relation_id")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("relation_id")).agg((F.count("*") + 4).alias("n"))
    rows = rows.withColumn("r", F.explode(F.expr("filter(array(0, 1, 2), r -> r = 0 OR r = 1 AND relation_id % 3 = 0 OR r = 2 AND relation_id % 5 = 0)")))
    radius = F.expr("CASE r WHEN 0 THEN 0.01D WHEN 1 THEN 0.004D ELSE 0.006D END")
    x, y = (o % 1000) / F.lit(100.0) + F.when(F.col("r") == 2, 0.05).otherwise(0.0), (o * 7 % 1000) / F.lit(100.0) + 40
    base = (o * 4 + F.col("r")) * 64
    at = lambda k: F.struct((base + 2 * k).alias("node"), (y + radius * F.sin(2 * F.pi() * k / F.col("n"))).alias("lat"), (x + radius * F.cos(2 * F.pi() * k / F.col("n"))).alias("lon"))
    middle = lambda k, a, b: F.struct((base + 2 * k + 1).alias("node"), ((a["lat"] + b["lat"]) / 2).alias("lat"), ((a["lon"] + b["lon"]) / 2).alias("lon"))
    sides = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda k: F.array(at(k), middle(k, at(k), at((k + 1) % F.col("n"))), at((k + 1) % F.col("n"))))
    each = rows.select(o, "r", base.alias("base"), F.posexplode(F.when(F.col("r") == 2, F.array(F.concat(F.flatten(F.transform(sides, lambda s: F.slice(s, 1, 2))), F.slice(F.element_at(sides, 1), 1, 1)))).otherwise(sides)).alias("k", "line"))
    each = each.filter("NOT (r = 0 AND k = 1 AND relation_id % 11 = 0)").withColumn("line", F.when((o + F.col("k")) % 3 == 0, F.reverse("line")).otherwise(F.col("line")))
    made = each.select(o, "r", (F.col("base") + (F.col("k") * 37) % 64).alias("way_id"), F.transform("line", lambda v: v["node"]).alias("nodes"), F.transform("line", lambda v: geo.vertex(v["lat"], v["lon"])).alias("geometry"))
    return made.select("relation_id", F.when(F.col("r") == 1, "inner").when(o % 2 == 0, "outer").otherwise("").alias("role"), "way_id"), made.select("way_id", "nodes", "geometry")


@_query(
    """WITH o AS (SELECT l_orderkey relation_id, count(*)+4 n FROM lineitem GROUP BY 1),
p AS (SELECT *, (relation_id%11<>0)::int a, (relation_id%11<>0 AND relation_id%3=0)::int b, (relation_id%5=0)::int c, n*sin(2*pi()/n)/2 unit FROM o)
SELECT relation_id, CAST(a+c AS BIGINT) polygons, CAST(b AS BIGINT) holes, CAST((a+b+c)*(2*n+1) AS BIGINT) vertices, round(unit*(a*100-b*16+c*36), 3) area FROM p WHERE a+c>0"""
)
def multipolygon_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = assembly.multipolygons(*_rings(spark, sf_dir))
    size = lambda r: F.abs(geo._moments(r)["c"]) / 2
    total = lambda x, f: F.aggregate(x, F.lit(0.0), lambda a, v: a + f(v))
    area = total(F.col("parts"), lambda p: 2 * size(F.get(p, F.lit(0))) - total(p, size))
    n = F.aggregate(F.flatten("parts"), F.lit(0).cast("bigint"), lambda a, r: a + F.size(r))
    return made.select("relation_id", F.size("parts").cast("bigint").alias("polygons"), (F.size(F.flatten("parts")) - F.size("parts")).cast("bigint").alias("holes"), n.alias("vertices"), F.round(area * 1e6, 3).alias("area"))


def _network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions name their nations, nations their suppliers and, in a circle, their region; suppliers name the ways (orders) with a line
    of theirs, and ways the nodes (parts) of their lines."""
    none = lambda kind: F.lit(None).cast(kind)
    one = lambda kind, ref: F.struct(F.lit(kind).alias("type"), ref.cast("bigint").alias("ref"))
    lines, suppliers, nations = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    relation = lambda df, key, m: df.groupBy(key.cast("bigint").alias("osm_id")).agg(F.collect_list(m).alias("members"))
    up = nations.select((F.col("n_nationkey") + 2_000_000).alias("k"), one("relation", F.col("n_regionkey") + 1_000_000).alias("m"))
    down = suppliers.select((F.col("s_nationkey") + 2_000_000).alias("k"), one("relation", F.col("s_suppkey") + 3_000_000).alias("m"))
    top = nations.select((F.col("n_regionkey") + 1_000_000).alias("k"), one("relation", F.col("n_nationkey") + 2_000_000).alias("m"))
    low = lines.select((F.col("l_suppkey") + 3_000_000).alias("k"), one("way", F.col("l_orderkey")).alias("m")).distinct()
    relations = relation(up.unionByName(down).unionByName(top).unionByName(low), F.col("k"), "m").select(F.lit("relation").alias("osm_type"), "osm_id", none("double").alias("lat"), none("double").alias("lon"), none("array<bigint>").alias("nodes"), "members")
    way = lines.groupBy(F.col("l_orderkey").cast("bigint").alias("osm_id")).agg(F.collect_list(F.col("l_partkey").cast("bigint")).alias("nodes"))
    way = way.select(F.lit("way").alias("osm_type"), "osm_id", none("double").alias("lat"), none("double").alias("lon"), "nodes", none("array<struct<type:string,ref:bigint>>").alias("members"))
    node = views.view(spark, sf_dir, "node").select(F.lit("node").alias("osm_type"), F.col("node_id").cast("bigint").alias("osm_id"), "lat", "lon", none("array<bigint>").alias("nodes"), none("array<struct<type:string,ref:bigint>>").alias("members"))
    return written(relations.unionByName(way).unionByName(node), "network")  # the closure reads its elements twice


_REFS = """ refs AS (SELECT 'relation' bt, n_nationkey+2000000 b, 'relation' t, n_regionkey+1000000 i FROM nation UNION ALL SELECT 'relation', s_nationkey+2000000, 'relation', s_suppkey+3000000 FROM supplier
  UNION ALL SELECT 'relation', n_regionkey+1000000, 'relation', n_nationkey+2000000 FROM nation UNION ALL SELECT DISTINCT 'relation', l_suppkey+3000000, 'way', l_orderkey FROM lineitem
  UNION ALL SELECT DISTINCT 'way', l_orderkey, 'node', l_partkey FROM lineitem)"""


@_query(
    views.with_views("node")
    + ","
    + _REFS
    + """, kept AS (SELECT 'relation' t, r_regionkey+1000000 i FROM region WHERE r_regionkey%2=0 UNION ALL SELECT 'way', o_orderkey FROM orders WHERE o_orderkey%40=0),
found AS (SELECT t, i FROM kept UNION SELECT refs.t, refs.i FROM found JOIN refs ON refs.bt=found.t AND refs.b=found.i),
there AS (SELECT DISTINCT bt t, b i FROM refs UNION SELECT 'node', node_id FROM node)
SELECT t osm_type, CAST(i AS BIGINT) osm_id, NOT EXISTS (SELECT 1 FROM kept WHERE kept.t=found.t AND kept.i=found.i) referenced FROM found JOIN there USING (t, i)"""
)
def referenced_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tag keeps (some regions, and ways of their own), with all that it names: three levels of relations, in circles."""
    every = _network(spark, sf_dir)
    kept = every.filter("(osm_type = 'relation' AND osm_id BETWEEN 1000000 AND 1999999 AND osm_id % 2 = 0) OR (osm_type = 'way' AND osm_id % 40 = 0)")
    return closure.with_referenced(kept, every).select("osm_type", "osm_id", "referenced")


@_query(
    views.with_views("node")
    + ","
    + _REFS
    + """, here AS (SELECT 'node' t, node_id i FROM node WHERE lon BETWEEN 1 AND 2.5 AND lat BETWEEN 41 AND 43),
w AS (SELECT DISTINCT bt t, b i FROM refs JOIN here USING (t, i) WHERE bt='way'),
a AS (SELECT t, i FROM here UNION SELECT t, i FROM w UNION SELECT refs.t, refs.i FROM refs JOIN w ON bt=w.t AND b=w.i JOIN node ON node_id=refs.i)
SELECT t osm_type, CAST(i AS BIGINT) osm_id FROM a UNION SELECT DISTINCT bt, CAST(b AS BIGINT) FROM refs JOIN a USING (t, i) WHERE bt='relation'"""
)
def complete_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closure.complete_ways(_network(spark, sf_dir), 1, 41, 2.5, 43).select("osm_type", "osm_id")


@_query(
    views.with_views("area", "way", "way_vertex", "node")
    + """, e AS (SELECT 0 k, area_type osm_type, area_id osm_id, CAST(5 AS BIGINT) vertices, name FROM area
UNION ALL SELECT 1, 'way', w.way_id, v.n, NULL FROM way w LEFT JOIN (SELECT way_id, count(*) n FROM way_vertex GROUP BY 1) v USING (way_id)
UNION ALL SELECT 2, 'node', node_id, 1, NULL FROM node)
SELECT row_number() OVER (ORDER BY k, osm_id)-1 AS ordinal, osm_type, osm_id, vertices, name FROM e"""
)
def element_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas, then ways, then nodes in one document that many tasks write, and read in splits; ordinals are places in it."""
    path, rows = _out(spark, "document"), _elements(spark, sf_dir)
    kind = F.when(F.col("tags")["landuse"].isNotNull(), 0).when(F.col("osm_type") == "way", 1).otherwise(2)
    sinks.element_document(rows.withColumn("ordinal", F.struct(kind.alias("kind"), "osm_id")), path)
    back = readers.osm_json(spark, path).withColumn("vertices", F.nullif(F.size("geometry").cast("bigint"), F.lit(-1).cast("bigint")))
    return back.select("ordinal", "osm_type", "osm_id", "vertices", F.col("tags")["name"].alias("name"))


@_query(views.with_views("area") + "SELECT row_number() OVER (ORDER BY area_id)-1 AS ordinal, area_id, name, 'Polygon' AS kind, round(lat0-h, 6) AS first_lat FROM area")
def document_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document, read in splits; ordinals are places in it."""
    path = _out(spark, "document")
    sinks.geojson_document(views.areas(spark, sf_dir), path, ["area_id", "name"])
    back = readers.geojson(spark, path)
    return back.select("ordinal", F.col("props")["area_id"].cast("bigint").alias("area_id"), F.col("props")["name"].alias("name"), "kind", F.round(F.element_at("geometry", 1)["lat"], 6).alias("first_lat"))


@_query(
    views.with_views("way_vertex")
    + _LINES
    + _KIND
    + """, hit AS (SELECT way_id, lat BETWEEN 41 AND 46 AND lon BETWEEN 1 AND 3 OR coalesce(greatest(lon,nlon)>=1 AND least(lon,nlon)<=3 AND greatest(lat,nlat)>=41 AND least(lat,nlat)<=46
  AND NOT (least(s00,s01,s10,s11)>0 OR greatest(s00,s01,s10,s11)<0), false) meets FROM (SELECT *, sign((nlon-lon)*(41-lat)-(nlat-lat)*(1-lon)) s00, sign((nlon-lon)*(46-lat)-(nlat-lat)*(1-lon)) s01,
  sign((nlon-lon)*(41-lat)-(nlat-lat)*(3-lon)) s10, sign((nlon-lon)*(46-lat)-(nlat-lat)*(3-lon)) s11 FROM seg)),
closed AS (SELECT way_id, count(*) FILTER ((lat>41)<>(nlat>41) AND 1<(nlon-lon)*(41-lat)/(nlat-lat)+lon)%2=1 around FROM seg JOIN k USING (way_id) WHERE kind='Polygon' GROUP BY way_id)
SELECT way_id, kind, round(min(lon), 8) xmin, round(max(lat), 8) ymax FROM seg JOIN k USING (way_id) WHERE way_id IN (SELECT way_id FROM hit WHERE meets UNION SELECT way_id FROM closed WHERE around) GROUP BY way_id, kind"""
)
def geoparquet_viewport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as GeoParquet along a Hilbert curve, and those that meet a box."""
    path = _out(spark, "geoparquet")
    sinks.geoparquet(views.way_lines(spark, sf_dir), path)
    back = readers.geoparquet(spark, path, (1, 41, 3, 46))
    return back.select("way_id", geo.geometry_kind(F.col("geometry")).alias("kind"), F.round("bbox.xmin", 8).alias("xmin"), F.round("bbox.ymax", 8).alias("ymax"))


@_query("""SELECT o_orderkey, CASE o_orderkey%6 WHEN 0 THEN 'broken' WHEN 1 THEN 'kind' WHEN 2 THEN 'no geometry' WHEN 3 THEN 'empty geometry' ELSE 'good' END reason,
CASE WHEN o_orderkey%6>3 THEN round_even(o_totalprice, 2) END price FROM orders""")
def feature_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features a third of which are fit for use: the others come back with the reason why not."""
    path = _out(spark, "mixed")
    text = """CASE o_orderkey % 6 WHEN 0 THEN concat('{"type":"Feature","id":"', o_orderkey, '","geometry":{') WHEN 1 THEN concat('{"type":"Thing","id":"', o_orderkey, '","geometry":{"type":"Point","coordinates":[1,2]}}')
        WHEN 2 THEN concat('{"type":"Feature","id":"', o_orderkey, '","geometry":null}') WHEN 3 THEN concat('{"type":"Feature","id":"', o_orderkey, '","geometry":{"type":"LineString","coordinates":[]}}')
        ELSE concat('{"type":"Feature","id":"', o_orderkey, '","properties":{"price":"', o_totalprice, '"},"geometry":{"type":"Point","coordinates":[1,2]}}') END"""
    table(spark, sf_dir, "orders").select(F.expr(text).alias("value")).write.text(f"{path}/in")
    good, bad = rejects.routed(rejects.features(spark, f"{path}/in", lines=True), f"{path}/out")
    good = good.select(F.col("feature_id").cast("bigint").alias("o_orderkey"), F.lit("good").alias("reason"), F.bround(F.col("props")["price"].cast("double"), 2).alias("price"))
    return good.unionByName(bad.select(F.regexp_extract("value", r'"id":"(\d+)"', 1).cast("bigint").alias("o_orderkey"), "reason"), allowMissingColumns=True)


@_query(
    """WITH s AS (SELECT s_suppkey, s_name, r_regionkey, r_name region FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey)
SELECT s_suppkey, s_name, region, '2024-02' AS month FROM s WHERE r_regionkey<>0 OR s_suppkey%2=0 UNION ALL SELECT s_suppkey, NULL, region, '2024-03' FROM s WHERE r_regionkey=1"""
)
def publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months, of which the first has a region replaced; what the manifests name is what is read."""
    path = _out(spark, "manifest")
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("s_suppkey", "s_name", "r_regionkey", F.col("r_name").alias("region"))
    publish.publish(rows, path, "2024-02")
    publish.publish(rows.filter("r_regionkey = 0 AND s_suppkey % 2 = 0"), path, "2024-02")
    publish.publish(rows.filter("r_regionkey = 1").drop("s_name"), path, "2024-03")
    publish.swept(spark, path)
    return publish.published(spark, path).select("s_suppkey", "s_name", "region", "month")
