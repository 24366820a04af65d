"""Country, state and area names for features, from boundary polygons and from a table of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.operators import cells
from pistespark.operators.cells import Cells
from pistespark.operators.spatial_join import CELL, first_match


def admin_cells(countries: DataFrame, states: DataFrame, cell: float = CELL) -> Cells:
    """One index of both kinds of boundaries, which are cut once. countries: ordinal, country, parts; states alike."""
    return cells.cut({"country": countries, "state": states}, cell)


def with_admin(points: DataFrame, countries: DataFrame | Cells, states: DataFrame | None = None, cell: float = CELL, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """points with country and state of the boundaries that they are in, in one join. countries: ordinal, country, parts; states
    alike; or, in place of both, the index that ``admin_cells`` made of them."""
    index = countries if isinstance(countries, Cells) else admin_cells(countries, states, cell)
    return index.first_of(points.drop("country", "state"), lat, lon)


def with_area(points: DataFrame, areas: DataFrame, cell: float = 0.05) -> DataFrame:
    """points with ``ski_area``: the name of the first area, by ordinal, that they are in. areas: ordinal, name, parts."""
    named = areas.select("ordinal", F.coalesce("name", F.lit("Unknown")).alias("ski_area"), "parts")
    return first_match(points.drop("ski_area"), named, ["ski_area"], cell=cell)


def names_of(areas: DataFrame) -> DataFrame:
    """Area name to (country, state); the last of equal names by ordinal."""
    return areas.filter("name IS NOT NULL").groupBy("name").agg(F.max_by(F.struct("country", "state"), "ordinal").alias("_n"))


def by_name(features: DataFrame, areas: DataFrame, countries: DataFrame | Cells, states: DataFrame | None = None, cell: float = CELL) -> DataFrame:
    """features (area_name, lat, lon, any more) with country and state by their area's name; where one of the two is missing
    and there is a point, both come from the boundaries, nulls too. Features are read once and never grouped."""
    met = features.drop("country", "state").join(names_of(areas).withColumnRenamed("name", "area_name"), "area_name", "left")
    met = met.withColumn("_ask", (F.col("_n.country").isNull() | F.col("_n.state").isNull()) & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    met = met.withColumn("_lat", F.when(F.col("_ask"), F.col("lat"))).withColumn("_lon", F.when(F.col("_ask"), F.col("lon")))
    out = with_admin(met, countries, states, cell, "_lat", "_lon")
    pick = lambda name: F.when(F.col("_ask"), F.col(name)).otherwise(F.col(f"_n.{name}")).alias(name)
    return out.select(*[c for c in features.columns if c not in ("country", "state")], pick("country"), pick("state"))


def filled(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Defaults where a column is null or blank."""
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)) for c, v in defaults.items()})
