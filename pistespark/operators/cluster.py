"""Single-linkage clusters of points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.operators.components import connected_components
from pistespark.operators.spatial_join import radius_join


def _cell(lat: Column, lon: Column, distance_m: float) -> Column:
    """A cell that no two points of which are more than ``distance_m`` apart: its sides, at its widest, are 0.7 of that."""
    side = max(0.7 * distance_m * 180 / (math.pi * geo.RADIUS_M), 1e-6)
    row = F.floor((lat + 90) / side)
    low = row * side - 90  # the side nearer to the equator is the wider one
    near = F.when((low < 0) & (low + side > 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(low + side)))
    columns = F.greatest(F.lit(1.0), F.ceil(360 * F.cos(F.radians(F.least(near, F.lit(90.0)))) / side))
    return F.struct(row.cast("long").alias("row"), F.floor((lon + 180) / 360 * columns).cast("long").alias("column"))


def single_linkage(points: DataFrame, distance_m: float, key: str = "ordinal") -> DataFrame:
    """points with ``cluster``: the least key that a chain of steps of at most ``distance_m`` reaches.

    All points of a cell are one cluster, so they share a node, their least key. Of the pairs between two cells one is
    enough: they are brought down to pairs of nodes before anything is written or shuffled, so dense points make no
    more edges than cells have neighbours."""
    placed = points.filter("lat IS NOT NULL AND lon IS NOT NULL").select(F.col(key).alias("_k"), "lat", "lon", _cell(F.col("lat"), F.col("lon"), distance_m).alias("_cell"))
    nodes = placed.groupBy("_cell").agg(F.min("_k").alias("_node"))
    placed = placed.join(nodes, "_cell")
    place = placed.select("_node", "lat", "lon").distinct()  # points at one place have the same links
    near = radius_join(place.select(F.col("_node").alias("b"), "lat", "lon"), place.select(F.col("_node").alias("a"), F.col("lat").alias("area_lat"), F.col("lon").alias("area_lon")), distance_m)
    roots = connected_components(near.filter("a < b").select("a", "b").distinct()).withColumnRenamed("node", "_node")
    label = placed.select("_k", "_node").join(roots, "_node", "left").select(F.col("_k").alias(key), F.coalesce("root", "_node").alias("cluster"))
    return points.join(label, key, "left").withColumn("cluster", F.coalesce("cluster", key))
