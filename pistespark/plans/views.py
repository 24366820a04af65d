"""Map tables derived from the order tables: suppliers are areas, orders ways, line items vertices or references, parts nodes,
nations and regions boundaries. The texts run in Spark (tables given by name) and, with ``ansi``, in other engines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pistespark.functions import geo, tags
from pistespark.shared import table

VIEWS = {
    "area": """SELECT CAST(s_suppkey AS BIGINT) area_id, CASE WHEN s_suppkey%4=0 THEN 'relation' ELSE 'way' END area_type, s_name name,
  CAST((s_suppkey-s_suppkey%2)*37%1000 AS DOUBLE)/100.0D + CAST(s_suppkey%2 AS DOUBLE)*0.01D lon0,
  40.0D+CAST((s_suppkey-s_suppkey%2)*91%1000 AS DOUBLE)/100.0D lat0, 0.01D+CAST(s_suppkey%5 AS DOUBLE)*0.005D h FROM {supplier}""",
    "way_vertex": """SELECT l_orderkey way_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey)-1 pos,
  CAST((l_orderkey%80-l_orderkey%2)*37%1000 AS DOUBLE)/100.0D + CAST(l_partkey%100-50 AS DOUBLE)/800.0D lon,
  40.0D+CAST((l_orderkey%80-l_orderkey%2)*91%1000 AS DOUBLE)/100.0D + CAST(l_partkey%61-30 AS DOUBLE)/800.0D lat FROM {lineitem}""",
    "way": """SELECT o_orderkey way_id,
  CASE WHEN o_orderstatus='F' THEN CASE o_orderkey%12 WHEN 0 THEN 'chair_lift' WHEN 1 THEN 'gondola' WHEN 2 THEN 'cable_car' WHEN 3 THEN 'drag_lift'
    WHEN 4 THEN 't-bar' WHEN 5 THEN 'j-bar' WHEN 6 THEN 'platter' WHEN 7 THEN 'magic_carpet' WHEN 8 THEN 'rope_tow' WHEN 9 THEN 'mixed_lift'
    WHEN 10 THEN 'station' WHEN 11 THEN 'pylon' END END aerialway,
  CASE o_orderstatus WHEN 'O' THEN 'downhill' WHEN 'P' THEN CASE o_orderkey%3 WHEN 0 THEN 'freestyle' WHEN 1 THEN 'sled' ELSE 'nordic' END END piste_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'expert' WHEN '2-HIGH' THEN 'advanced' WHEN '3-MEDIUM' THEN 'intermediate'
    WHEN '4-NOT SPECIFIED' THEN 'easy' ELSE ' Novice ' END piste_difficulty,
  CASE WHEN o_orderkey%7=0 THEN 'no' END grooming, CASE WHEN o_orderkey%5=0 THEN '30 m' WHEN o_orderkey%5=1 THEN '12.5' END piste_width FROM {orders}""",
    "node": "SELECT p_partkey node_id, CAST(p_partkey*7919%1000 AS DOUBLE)/100.0D lon, 40.0D+CAST(p_partkey*104729%1000 AS DOUBLE)/100.0D lat FROM {part} WHERE p_partkey%50<>0",
    "way_ref": "SELECT l_orderkey way_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey)-1 pos, l_partkey node_id FROM {lineitem}",
    "admin1": """SELECT n_nationkey ordinal, 2.0D*(n_nationkey%5)+0.005D x0, 2.0D*(n_nationkey%5)+2.005D x1, 40.0D+2.0D*floor(n_nationkey/5)+0.005D y0,
  40.0D+2.0D*floor(n_nationkey/5)+2.005D y1, CASE WHEN n_nationkey%3=0 THEN ' ' ELSE n_name END name, n_name admin FROM {nation}""",
    "admin0": """SELECT r_regionkey ordinal, 2.0D*r_regionkey+0.005D x0, 2.0D*r_regionkey+2.005D x1, 40.005D y0, 50.005D y1,
  CASE WHEN r_regionkey=2 THEN NULL ELSE r_name END admin, CONCAT(r_name,' long') name_long FROM {region}""",
}


def ansi(text: str) -> str:
    """The text with plain table names and cast literals."""
    return re.sub(r"(\d+\.\d+)D\b", r"CAST(\1 AS DOUBLE)", re.sub(r"\{(\w+)\}", r"\1", text))


def with_views(*names: str) -> str:
    """``WITH`` clause (open: more may follow) of some views."""
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({ansi(VIEWS[n])})" for n in names)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = re.search(r"\{(\w+)\}", VIEWS[name]).group(1)
    return spark.sql(VIEWS[name], **{base: table(spark, sf_dir, base)})


def box(x0: str, x1: str, y0: str, y1: str) -> Column:
    """The closed ring of a box given by column names or expressions."""
    at = lambda y, x: geo.vertex(F.expr(y), F.expr(x))
    return F.array(at(y0, x0), at(y0, x1), at(y1, x1), at(y1, x0), at(y0, x0))


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas with their ring, as readers.areas_for_rollup gives them, and lat, lon of the middle."""
    ring = box("lon0-h", "lon0+h", "lat0-h", "lat0+h")
    none = F.lit(None).cast("string")
    rows = view(spark, sf_dir, "area").withColumn("geometry", ring)
    return rows.select("area_type", "area_id", F.col("area_id").alias("ordinal"), "name", none.alias("country"), none.alias("state"), "geometry", F.array(F.array("geometry")).alias("parts"), F.col("lat0").alias("lat"), F.col("lon0").alias("lon"))


def way_lines(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """way_id, geometry.

    stored: vertices as the table has them, not along the line. An SQL ``avg`` adds in that order where one thread runs it, and
    where a mean lies on an edge up to rounding, the order decides."""
    if stored:
        base = table(spark, sf_dir, "lineitem").select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        rows, at = spark.sql(VIEWS["way_vertex"].replace(" FROM {", ", _file, _row FROM {"), lineitem=base), ["_file", "_row"]
    else:
        rows, at = view(spark, sf_dir, "way_vertex"), ["pos"]
    rows = rows.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct(*at, "lat", "lon"))).alias("g"))
    return rows.select("way_id", F.transform("g", lambda v: geo.vertex(v["lat"], v["lon"])).alias("geometry"))


def way_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """way_id, tags."""
    keys = {"aerialway": "aerialway", "piste:type": "piste_type", "piste:difficulty": "piste_difficulty", "piste:grooming": "grooming", "piste:width": "piste_width"}
    made = F.map_filter(F.create_map(*[x for k, c in keys.items() for x in (F.lit(k), F.col(c))]), lambda k, v: v.isNotNull())
    return view(spark, sf_dir, "way").select("way_id", made.alias("tags"))


def way_points(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """way_id, geometry and the mean of its vertices as lat, lon."""
    return way_lines(spark, sf_dir, stored).withColumn("c", geo.vertex_mean(F.col("geometry"))).select("way_id", "geometry", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "admin0").select("ordinal", F.coalesce(tags.clean_name(F.col("admin")), tags.clean_name(F.col("name_long"))).alias("country"), F.array(F.array(box("x0", "x1", "y0", "y1"))).alias("parts"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "admin1").select("ordinal", F.coalesce(tags.clean_name(F.col("name")), tags.clean_name(F.col("admin"))).alias("state"), F.array(F.array(box("x0", "x1", "y0", "y1"))).alias("parts"))
