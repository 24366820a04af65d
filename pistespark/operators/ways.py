"""Ways from their nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolved(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways (way_id, nodes array<bigint>) with their vertices, for ways of two references or more that are all known.

    A node id that comes twice has the point of its last ordinal. The references shuffle once by node id and once,
    aggregated, by way; a node that very many ways use is split by AQE in the join.
    """
    return assembled(ways.filter(F.size("nodes") >= 2).select("way_id", F.posexplode("nodes").alias("pos", "node_id")), nodes)


def assembled(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """As ``resolved``, from rows (way_id, pos, node_id)."""
    known = nodes.groupBy("node_id").agg(F.max_by(F.struct("lat", "lon"), "ordinal").alias("at"))
    met = refs.join(known, "node_id", "left").groupBy("way_id").agg(F.count("*").alias("refs"), F.count("at").alias("known"), F.array_sort(F.collect_list(F.struct("pos", "at"))).alias("found"))
    return met.filter("refs = known AND refs >= 2").select("way_id", F.transform("found", lambda x: x["at"]).alias("geometry"))


def with_geometry(elements: DataFrame, nodes: DataFrame) -> DataFrame:
    """Elements, ways without a geometry getting that of their nodes."""
    found = resolved(elements.filter("osm_type = 'way' AND geometry IS NULL").select(F.col("osm_id").alias("way_id"), "nodes"), nodes)
    found = found.select(F.col("way_id").alias("osm_id"), F.lit("way").alias("osm_type"), F.col("geometry").alias("_g"))
    return elements.join(found, ["osm_type", "osm_id"], "left").withColumn("geometry", F.coalesce("geometry", "_g")).drop("_g")
