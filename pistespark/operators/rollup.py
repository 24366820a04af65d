"""The per-area rollup: one wide row per area from the features near it.

Features are reduced to numbers before any shuffle, so no geometry moves. One pass: a grouping by area and element
adds up its trails and takes its first lift, and a grouping by area adds up those; both with map-side partial sums,
so an area with very many features is a few partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.functions import geo, tags
from pistespark.operators.features import is_lift
from pistespark.operators.spatial_join import expanded
from pistespark.schema import ANALYZED_COLUMNS, DIFFICULTIES

KEY = ["area_type", "area_id"]


def measures(nearby: DataFrame, line_rule: str = "reference") -> DataFrame:
    """What counts of each feature. nearby: KEY, osm_type, osm_id, ordinal, tags, geometry (vertices of the element).

    line_rule: ``reference`` takes any way of three vertices or more for a polygon, ``closed_only`` only closed ones.
    """
    t, g = F.col("tags"), F.col("geometry")
    n = geo.n_vertices(g)
    polygon = (F.col("osm_type") == "way") & ((n >= 3) if line_rule == "reference" else (geo.geometry_kind(g) == "Polygon"))
    down = F.coalesce(t["piste:type"] == "downhill", F.lit(False))
    length = geo.line_length(g)
    line = down & (n > 0) & ~polygon
    return nearby.select(
        *KEY,
        "osm_type",
        "osm_id",
        "ordinal",
        down.alias("down"),
        F.when(down, tags.difficulty(t["piste:difficulty"])).alias("difficulty"),
        F.coalesce(down & (t["piste:grooming"] == "no"), F.lit(False)).alias("gladed"),
        F.coalesce(t["piste:type"] == "freestyle", F.lit(False)).alias("park"),
        F.coalesce(t["piste:type"].isin("sled", "tubing"), F.lit(False)).alias("sled"),
        F.when(down & (n > 0), F.when(polygon, geo.polygon_area(g)).otherwise(length * tags.width(t["piste:width"]))).alias("terrain_m2"),
        F.when(line, length).alias("trail_m"),
        F.when(is_lift(t), t["aerialway"]).alias("lift"),
        F.when(is_lift(t), F.when(n >= 2, length).otherwise(F.lit(0.0))).alias("lift_m"),
    )


def lifts(measured: DataFrame) -> DataFrame:
    """One row per area and lift: the first seen by ordinal."""
    return measured.filter("lift IS NOT NULL").groupBy(*KEY, "osm_type", "osm_id").agg(F.min_by(F.struct("lift", "lift_m"), "ordinal").alias("l")).select(*KEY, "osm_type", "osm_id", "l.*")


def lift_types(one_per_lift: DataFrame) -> DataFrame:
    """Per area: number of lifts, the longest in metres, and ``chair lift: 3, t-bar: 1``."""
    made = one_per_lift.groupBy(*KEY).agg(F.count("lift").alias("total_lifts"), F.max("lift_m").alias("longest_lift_m"), *_counts())
    return made.select(*KEY, "total_lifts", "longest_lift_m", _types().alias("lift_types"))


def _counts() -> list[Column]:
    return [F.count_if(F.col("lift") == t).alias(f"_n_{t}") for t in sorted(tags.LIFT_TYPES)]


def _types() -> Column:
    """The text of the types that come, from their counts."""
    each = [F.when(F.col(f"`_n_{t}`") > 0, F.concat(F.lit(t.replace("_", " ") + ": "), F.col(f"`_n_{t}`").cast("string"))) for t in sorted(tags.LIFT_TYPES)]
    return F.concat_ws(", ", *each)


def yes_no(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), "Yes").otherwise("No")


_FLAGS = ["gladed", "park", "sled"]


def elements(measured: DataFrame) -> DataFrame:
    """Per area and element: its first lift by ordinal, and the sums of its trails."""
    first = F.min_by(F.struct("lift", "lift_m"), F.when(F.col("lift").isNotNull(), F.col("ordinal")))
    made = measured.groupBy(*KEY, "osm_type", "osm_id").agg(
        first.alias("_l"),
        F.count_if("down").alias("down"),
        *[F.count_if(F.col("difficulty") == d).alias(f"n_{d}") for d in DIFFICULTIES],
        *[F.bool_or(c).alias(c) for c in _FLAGS],
        F.sum("terrain_m2").alias("terrain_m2"),
        F.max("trail_m").alias("longest_m"),
        F.sum("trail_m").alias("sum_m"),
        F.count("trail_m").alias("lines"),
    )
    return made.withColumn("lift", F.col("_l.lift")).withColumn("lift_m", F.when(F.col("lift").isNotNull(), F.col("_l.lift_m"))).drop("_l")


def per_area(each: DataFrame) -> DataFrame:
    """Per area: counts, terrain, lengths and flags of trails and lifts."""
    made = each.groupBy(*KEY).agg(
        F.sum("down").alias("downhill_trails"),
        *[F.sum(f"n_{d}").alias(f"trails_{d}") for d in DIFFICULTIES],
        *[F.bool_or(c).alias(c) for c in _FLAGS],
        F.coalesce(F.sum("terrain_m2"), F.lit(0.0)).alias("terrain_m2"),
        F.max("longest_m").alias("longest_m"),
        (F.sum("sum_m") / F.nullif(F.sum("lines"), F.lit(0))).alias("mean_m"),
        F.count("lift").alias("total_lifts"),
        F.max("lift_m").alias("longest_lift_m"),
        *_counts(),
    )
    return made.withColumn("lift_types", _types()).drop(*[f"_n_{t}" for t in tags.LIFT_TYPES])


def trails(measured: DataFrame) -> DataFrame:
    """``per_area`` of measured features."""
    return per_area(elements(measured))


def resort_type(terrain: Column, n_lifts: Column, n_trails: Column) -> Column:
    return F.when((terrain > 0) | (n_lifts > 0) | (n_trails > 0), "downhill ski resort").otherwise("not a downhill ski resort")


def area_rollup(areas: DataFrame, nearby: DataFrame, line_rule: str = "reference", members: DataFrame | None = None) -> DataFrame:
    """All areas, the 28 columns of the per-area table. areas: KEY, name, country, state, lat, lon, geometry.

    members: where ``nearby`` has the representatives of areas only (``spatial_join.representatives``), which they stand for."""
    zero = F.lit(0).cast("bigint")
    found = per_area(elements(measures(nearby, line_rule)))
    all_ = areas.join(found if members is None else expanded(found, members, KEY), KEY, "left")
    ha = lambda m2: F.bround(geo.hectares(m2), 2)
    mi = lambda m: F.coalesce(F.bround(geo.miles(m), 2), F.lit(0.0))
    total, terrain = ha(geo.polygon_area(F.col("geometry"))), F.coalesce(F.col("terrain_m2"), F.lit(0.0))
    out = all_.select(
        F.col("area_id").alias("winter_sports_id"),
        F.col("area_type").alias("winter_sports_type"),
        "name",
        "country",
        "state",
        F.bround("lat", 6).alias("centroid_lat"),
        F.bround("lon", 6).alias("centroid_lon"),
        total.alias("total_area_ha"),
        F.bround(geo.acres(total), 0).alias("total_area_acres"),
        ha(terrain).alias("skiable_terrain_ha"),
        F.bround(geo.acres(ha(terrain)), 0).alias("skiable_terrain_acres"),
        F.coalesce("total_lifts", zero).alias("total_lifts"),
        mi(F.col("longest_lift_m")).alias("longest_lift_mi"),
        F.coalesce("downhill_trails", zero).alias("downhill_trails"),
        mi(F.col("longest_m")).alias("longest_trail_mi"),
        mi(F.col("mean_m")).alias("avg_trail_mi"),
        *[F.coalesce(f"trails_{d}", zero).alias(f"trails_{d}") for d in DIFFICULTIES],
        yes_no(F.col("gladed")).alias("gladed_terrain"),
        yes_no(F.col("park")).alias("snow_park"),
        yes_no(F.col("sled")).alias("sledding_tubing"),
        F.coalesce("lift_types", F.lit("")).alias("lift_types"),
        resort_type(terrain, F.coalesce("total_lifts", zero), F.coalesce("downhill_trails", zero)).alias("resort_type"),
    )
    return out.select(*ANALYZED_COLUMNS)
