"""What an extract has to take along: the nodes of its ways and the members of its relations.

Elements are (osm_type, osm_id, nodes, members). References are two narrow tables, and every step is a semi-join or
anti-join of ids, so no element moves before it is known to be wanted. The side with the box or the tag is selective,
and Spark filters the references' scan with a Bloom filter of its ids at run time where that pays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.shared import settled

_ID = ["osm_type", "osm_id"]


def references(elements: DataFrame) -> DataFrame:
    """by_type, by_id, osm_type, osm_id: each element that another one names. A node named twice by a way is one."""
    of_ways = elements.filter("osm_type = 'way'").select("osm_type", "osm_id", F.explode(F.array_distinct("nodes")).alias("ref")).select(F.col("osm_type").alias("by_type"), F.col("osm_id").alias("by_id"), F.lit("node").alias("osm_type"), F.col("ref").alias("osm_id"))
    of_relations = elements.filter("osm_type = 'relation'").select("osm_type", "osm_id", F.explode(F.array_distinct(F.transform("members", lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"))))).alias("m"))
    return of_ways.unionByName(of_relations.select(F.col("osm_type").alias("by_type"), F.col("osm_id").alias("by_id"), F.col("m.type").alias("osm_type"), F.col("m.ref").alias("osm_id")))


def _named(ids: DataFrame, refs: DataFrame) -> DataFrame:
    """Ids of what some elements name."""
    return refs.join(ids.select(F.col("osm_type").alias("by_type"), F.col("osm_id").alias("by_id")), ["by_type", "by_id"], "left_semi").select(*_ID).distinct()


def with_referenced(kept: DataFrame, elements: DataFrame) -> DataFrame:
    """The elements that ``kept`` names (osm_type, osm_id), and all that these need: members of relations, members of those, and
    nodes of ways. ``referenced`` tells what came along from what was kept.

    Relations that name relations are followed round by round, each with what is new only, so a circle ends; ways and nodes
    take one step each. Names of elements that are not there are passed over."""
    refs = settled(references(elements), "references")  # every step asks them, and elements are taken apart once
    among = settled(refs.filter("by_type = 'relation' AND osm_type = 'relation'"), "nesting")
    kept = kept.select(*_ID).distinct()
    seen = new = settled(kept.filter("osm_type = 'relation'"), "relations")
    while not new.isEmpty():
        new = settled(_named(new, among).join(seen, _ID, "left_anti"), "relations")
        seen = seen.unionByName(new)
    first = seen.unionByName(kept.filter("osm_type <> 'relation'"))
    members = _named(seen, refs.filter("by_type = 'relation' AND osm_type <> 'relation'"))
    some = settled(first.unionByName(members).distinct(), "named")
    every = some.unionByName(_named(some.filter("osm_type = 'way'"), refs.filter("by_type = 'way'"))).distinct()
    told = every.join(kept.withColumn("_kept", F.lit(True)), _ID, "left").withColumn("referenced", F.col("_kept").isNull()).drop("_kept")
    return elements.join(told, _ID)


def complete_ways(elements: DataFrame, minlon: float, minlat: float, maxlon: float, maxlat: float) -> DataFrame:
    """The elements of a box, with no way cut at its edge: nodes inside (edges count), ways with a node inside and all nodes
    of these, and relations with a member among them, whose other members do not come along.

    elements: osm_type, osm_id, lat, lon, nodes, members."""
    refs = settled(references(elements), "references")
    here = elements.filter("osm_type = 'node'").filter(F.col("lon").between(minlon, maxlon) & F.col("lat").between(minlat, maxlat)).select(*_ID)
    of_ways = refs.filter("by_type = 'way'")
    touched = of_ways.join(here, _ID, "left_semi").select(F.col("by_type").alias("osm_type"), F.col("by_id").alias("osm_id")).distinct()
    touched = settled(touched, "ways")
    some = settled(here.unionByName(touched).unionByName(_named(touched, of_ways)).distinct(), "inside")
    around = refs.filter("by_type = 'relation'").join(some, _ID, "left_semi").select(F.col("by_type").alias("osm_type"), F.col("by_id").alias("osm_id")).distinct()
    return elements.join(some.unionByName(around), _ID, "left_semi")
