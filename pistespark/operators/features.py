"""Selecting and routing map elements: all of it filters and projections, no shuffle but for a sort where order is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.functions.tags import LIFT_TYPES

#: Layers in the order in which they are read.
LAYERS = ["multipolygons", "lines", "points"]
NEARBY_LAYERS = ["multipolygons", "lines", "multilinestrings", "points"]


def tag_filter(elements: DataFrame, key: str, value: str | None = None, kinds: tuple[str, ...] = ("node", "way", "relation")) -> DataFrame:
    """Elements of some kinds that have a tag: any value of the key, or one."""
    has = F.col("tags")[key].isNotNull() if value is None else F.col("tags")[key] == value
    return elements.filter(F.col("osm_type").isin(*kinds) & has)


def ski_areas(elements: DataFrame) -> DataFrame:
    return tag_filter(elements, "landuse", "winter_sports", ("way", "relation"))


def lifts_and_pistes(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tag_filter(elements, "aerialway"), tag_filter(elements, "piste:type")


def is_lift(tags: Column) -> Column:
    return F.coalesce(tags["aerialway"].isin(*LIFT_TYPES), F.lit(False))


def layered(elements: DataFrame) -> DataFrame:
    """Add the layer that an element is read from: polygons, lines, or points."""
    closed = geo.geometry_kind(F.col("geometry")) == "Polygon"
    layer = F.when(F.col("osm_type") == "relation", "multipolygons").when(F.col("osm_type") == "node", "points").otherwise(F.when(closed, "multipolygons").otherwise("lines"))
    if "parts" in elements.columns:  # a relation whose ways make no polygon is of no layer
        layer = F.when((F.col("osm_type") == "relation") & F.coalesce(F.size("parts") <= 0, F.lit(True)), F.lit(None)).otherwise(layer)
    if "lines" in elements.columns:  # a line of several parts has a layer of its own
        layer = F.when(F.size("lines") > 0, "multilinestrings").otherwise(layer)
    return elements.withColumn("layer", layer)


def merged_layers(elements: DataFrame, layers: list[str] = LAYERS) -> DataFrame:
    """Elements of the layers one after another: ``place`` orders by layer, then by ordinal. A sort key, not a sort."""
    at = F.array_position(F.array(*[F.lit(x) for x in layers]), F.col("layer"))
    return elements.filter(F.col("layer").isin(*layers)).withColumn("place", F.struct(at.cast("int").alias("layer"), F.col("ordinal").alias("ordinal")))


def usable(elements: DataFrame) -> DataFrame:
    """Elements with a geometry that counts: a node's point, or two vertices or more for a way."""
    n = geo.n_vertices(F.col("geometry"))
    return elements.filter((n >= 2) | ((F.col("osm_type") != "way") & (n >= 1)) | (F.col("lat").isNotNull() & F.col("lon").isNotNull()))


def first_n(elements: DataFrame, n: int | None) -> DataFrame:
    """The first n by ordinal, before anything is filtered; all of them for 0 or None."""
    return elements.orderBy("ordinal").limit(n) if n else elements


def in_box(df: DataFrame, minlon: float, minlat: float, maxlon: float, maxlat: float) -> DataFrame:
    """Points in a box. Plain column bounds, so Parquet's row-group statistics prune."""
    return df.filter(F.col("lon").between(minlon, maxlon) & F.col("lat").between(minlat, maxlat))


def viewport(df: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Rows whose bounds (min_lon, min_lat, max_lon, max_lat) meet a viewport."""
    return df.filter((F.col("max_lon") >= x0) & (F.col("min_lon") <= x1) & (F.col("max_lat") >= y0) & (F.col("min_lat") <= y1))


def merged_box(areas: DataFrame, radius_m: float) -> DataFrame:
    """The box that holds the radius boxes of all areas (lat, lon): one row."""
    box = areas.select(geo.box_around(F.col("lat"), F.col("lon"), radius_m).alias("b")).select("b.*")
    return box.agg(F.min("minlon").alias("minlon"), F.min("minlat").alias("minlat"), F.max("maxlon").alias("maxlon"), F.max("maxlat").alias("maxlat"))
