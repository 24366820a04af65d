"""Reading map files. Every reader has a fixed schema, so a scan is one pass and files need not agree.

GeoJSON and element JSON are read in splits also where a file is one document (``documents``); a folder with a feature a line
(``lines=True``) takes no shuffle, which is what large inputs should be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pistespark.functions import geo
from pistespark.functions import tags as tg
from pistespark.schema import ANALYZED_DDL, BOUNDS, MEMBERS, RING
from pistespark.shared import listed
from pistespark.sources import documents

FEATURE = "struct<type:string,id:string,ordinal:bigint,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"
_POSITION, _LINE, _RINGS, _PARTS = "array<double>", "array<array<double>>", "array<array<array<double>>>", "array<array<array<array<double>>>>"
ELEMENT_JSON = f"struct<type:string,id:bigint,lat:double,lon:double,nodes:array<bigint>,geometry:{RING},bounds:{BOUNDS},members:{MEMBERS},tags:map<string,string>,winter_sports_id:string,winter_sports_type:string,winter_sports_name:string,country:string,state:string>"


def vertices(coords: Column) -> Column:
    """[[lon, lat], ...] as vertices; positions of fewer than two numbers are dropped."""
    return F.transform(F.filter(coords, lambda c: F.size(c) >= 2), lambda c: F.struct(F.get(c, F.lit(1)).alias("lat"), F.get(c, F.lit(0)).alias("lon")))


def _rings(coords: Column) -> Column:
    return F.transform(coords, vertices)


def shaped(features: DataFrame) -> DataFrame:
    """Features with ``geometry`` as a vertex list, ``parts`` as polygons of rings, and ``lines`` as a multi-line's parts.

    In ``geometry``, a multi-line's parts are put in a row; a multipolygon's vertex list is its first outer ring; other types have none."""
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    point, line, rings, parts = (F.from_json(text, s) for s in (_POSITION, _LINE, _RINGS, _PARTS))
    polygon = _rings(rings)
    multi = F.transform(parts, _rings)
    geometry = (
        F.when(kind == "Point", vertices(F.array(point)))
        .when(kind.isin("LineString", "MultiPoint"), vertices(line))
        .when(kind == "MultiLineString", F.flatten(_rings(rings)))
        .when(kind == "Polygon", F.get(polygon, F.lit(0)))
        .when(kind == "MultiPolygon", F.get(F.get(multi, F.lit(0)), F.lit(0)))
    )
    return features.withColumn("kind", kind).withColumn("geometry", geometry).withColumn("parts", F.when(kind == "Polygon", F.array(polygon)).when(kind == "MultiPolygon", multi)).withColumn("lines", F.when(kind == "MultiLineString", polygon))


def geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """ordinal, kind, props, geometry, parts, lines of a feature collection, also one that is keyed by layer. Null and empty geometries are dropped.

    lines: the path holds one feature per line; the ordinal is that of the line where it has one (as the sink writes it),
    so that it does not depend on how files are split, and else its place among the splits."""
    if lines:
        schema = T.StructType.fromDDL(f"f {FEATURE}")["f"].dataType
        found = spark.read.schema(schema).json(path).select(F.struct("type", "id", "geometry", "properties").alias("f"), "ordinal")
        found = found.withColumn("ordinal", F.coalesce("ordinal", F.monotonically_increasing_id()))
    else:
        found = documents.objects(spark, path, "features").select("ordinal", F.from_json("value", FEATURE).alias("f"))
    out = shaped(found.filter("f.type = 'Feature' AND f.geometry IS NOT NULL"))
    return out.filter(F.coalesce(F.size("geometry"), F.lit(0)) > 0).select("ordinal", "kind", F.coalesce("f.properties", F.create_map().cast("map<string,string>")).alias("props"), F.col("f.id").alias("feature_id"), "geometry", "parts", "lines")


def areas_for_rollup(features: DataFrame) -> DataFrame:
    """Areas with an id, polygons only, one row per (type, id): the last one."""
    p = F.col("props")
    relation, way = p["osm_relation_id"], p["osm_way_id"]
    id_ = tg.first_id(tg.text_id(relation), tg.text_id(way), tg.text_id(p["osm_id"]), tg.text_id(p["id"]))
    kind = F.when(relation.isNotNull(), "relation").otherwise("way")
    rows = features.filter(F.col("kind").isin("Polygon", "MultiPolygon")).select("ordinal", kind.alias("area_type"), id_.alias("area_id"), tg.first_of(p["name"], p["Name"]).alias("name"), tg.first_of(p["country"], p["Country"]).alias("country"), tg.first_of(p["state"], p["State"]).alias("state"), "geometry", "parts").filter("area_id IS NOT NULL")
    fields = ["ordinal", "name", "country", "state", "geometry", "parts"]
    return rows.groupBy("area_type", "area_id").agg(F.max_by(F.struct(*fields), "ordinal").alias("r")).select("area_type", "area_id", "r.*")


def areas_for_nearby(features: DataFrame) -> DataFrame:
    """Areas of any geometry; one without an id has its place in the file."""
    p = F.col("props")
    id_ = F.coalesce(tg.first_id(tg.text_id(p["osm_relation_id"]), tg.text_id(p["osm_way_id"]), tg.text_id(p["osm_id"]), tg.text_id(p["id"])), F.col("ordinal"))
    kind = F.when(p["osm_relation_id"].isNotNull(), "relation").otherwise("way")
    return features.select("ordinal", kind.alias("area_type"), id_.alias("area_id"), F.coalesce(tg.first_of(p["name"], p["Name"]), F.lit("Unknown")).alias("name"), tg.first_of(p["State"], p["state"]).alias("state"), tg.first_of(p["Country"], p["country"]).alias("country"), "kind", "geometry", "parts", "lines")


def osm_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Elements of a JSON document ``{"elements": [...]}``, or of a folder with one element per line, as ``sinks.element_lines`` writes it."""
    if lines:
        kind = T.StructType.fromDDL(f"e {ELEMENT_JSON}")["e"].dataType
        e = spark.read.schema(T.StructType([*kind.fields, T.StructField("ordinal", T.LongType())])).json(path)
        e = e.withColumn("ordinal", F.coalesce("ordinal", F.monotonically_increasing_id()))
    else:
        e = documents.objects(spark, path, "elements").select("ordinal", F.from_json("value", ELEMENT_JSON).alias("e")).filter("e.type IS NOT NULL").select("ordinal", "e.*")
    return e.withColumnsRenamed({"type": "osm_type", "id": "osm_id"}).withColumn("winter_sports_id", tg.numeric_key(F.col("winter_sports_id"))).withColumn("tags", F.coalesce("tags", F.create_map().cast("map<string,string>")))


def measured_elements(elements: DataFrame) -> DataFrame:
    """Elements of ``osm_json`` with ``geometry`` as they are measured: a node's point, a way's line, a relation's middle or outer members."""
    return elements.withColumn("geometry", geo.element_geometry(F.col("osm_type"), F.col("lat"), F.col("lon"), F.col("geometry"), F.col("bounds"), F.col("members")))


def areas_from_elements(elements: DataFrame) -> DataFrame:
    """Areas among the elements of ``osm_json``: ways and relations, the last of each id. ``measured`` is the geometry that their size goes by."""
    rows = elements.filter(F.col("osm_type").isin("way", "relation") & F.col("osm_id").isNotNull())
    shape = geo.element_geometry(F.col("osm_type"), F.col("lat"), F.col("lon"), F.col("geometry"), F.col("bounds"), F.col("members"))
    name = tg.display_name(F.col("tags"), F.col("osm_type"), F.col("osm_id"))
    made = rows.select("ordinal", F.col("osm_type").alias("area_type"), F.col("osm_id").alias("area_id"), name.alias("name"), tg.blank_to_null(F.col("country")).alias("country"), tg.blank_to_null(F.col("state")).alias("state"), F.coalesce(F.when(F.size("geometry") > 0, F.col("geometry")), shape).alias("geometry"), "bounds", shape.alias("measured"))
    fields = ["ordinal", "name", "country", "state", "geometry", "bounds", "measured"]
    return made.groupBy("area_type", "area_id").agg(F.max_by(F.struct(*fields), "ordinal").alias("r")).select("area_type", "area_id", "r.*")


def nearby_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Nearby features as ``sinks.nearby_parquet`` writes them, or with their geometry as well-known binary only; tags from
    their JSON text, broken text gives none."""
    rows = spark.read.parquet(path)
    if dict(rows.dtypes).get("geometry") == "binary":
        rows = rows.withColumn("geometry", geo.vertices_of_wkb(F.col("geometry")))
    if "lat" not in rows.columns:
        one = geo.n_vertices(F.col("geometry")) == 1
        rows = rows.withColumns({c: F.when(one, F.get("geometry", F.lit(0))[c]) for c in ("lat", "lon")})
    return rows.withColumn("tags", tg.json_tags(F.col("tags")))


def geoparquet(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Rows of GeoParquet with their geometry as vertices (of polygons the first outer ring's) and ``wkb``. Files of other writers, which
    have no ``vertices``, are decoded; with a box they must have a ``bbox`` column.

    box (x0, y0, x1, y1): only rows that meet it. Their bounds are asked first, so row groups that cannot matter are not read; then
    the vertices decide, and of multipolygons the bounds alone."""
    rows = spark.read.parquet(path)
    if box is not None:
        x0, y0, x1, y1 = (float(v) for v in box)
        rows = rows.filter((F.col("bbox.xmax") >= x0) & (F.col("bbox.xmin") <= x1) & (F.col("bbox.ymax") >= y0) & (F.col("bbox.ymin") <= y1))
    rows = rows.withColumnRenamed("geometry", "wkb")
    rows = rows.withColumnRenamed("vertices", "geometry") if "vertices" in rows.columns else rows.withColumn("geometry", geo.vertices_of_wkb(F.col("wkb")))
    return rows if box is None else rows.filter(F.col("geometry").isNull() | geo.meets_box(F.col("geometry"), x0, y0, x1, y1))


def boundaries(spark: SparkSession, path: str | None, names: list[str], out: str, lines: bool = False) -> DataFrame:
    """(ordinal, ``out``, parts) of a boundary file; no rows if there is none."""
    if path is None:
        return spark.createDataFrame([], f"ordinal bigint, {out} string, parts array<array<{RING}>>")
    f = geojson(spark, path, lines)
    return f.filter("parts IS NOT NULL").select("ordinal", tg.pick_name(F.col("props"), names).alias(out), "parts")


def analyzed_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(ANALYZED_DDL).csv(path)


#: The tables of a region.
TABLES = ["ski_areas", "lifts", "pistes", "osm_near_winter_sports", "osm_near_winter_sports_areas", "ski_areas_analyzed"]


def regions(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Table name to the sorted regions that have it: folders under root with a known table in them; ``combined`` is no region."""
    found: dict[str, list[str]] = {}
    for name in TABLES:
        have = sorted({p.rstrip("/").rsplit("/", 2)[-2] for p in listed(spark, f"{root.rstrip('/')}/*/{name}.parquet")} - {"combined"})
        if have:
            found[name] = have
    return found


def _agreed(name: str, kinds: dict[str, set[str]]) -> dict[str, str]:
    """The one type of each column whose types differ between regions: the table's own, else double for numbers, else string."""
    own = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(ANALYZED_DDL)} if name == "ski_areas_analyzed" else {}
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    whole = numbers - {"float", "double"}
    return {c: own.get(c) or ("bigint" if k <= whole else "double" if k <= numbers else "string") for c, k in kinds.items() if len(k) > 1}


def regional(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table ``name`` of all regions under root (root/region/name.parquet), with the region from its path; ``combined`` is no region.

    Columns that a region lacks are null there. Where regions differ in a column's type, each is read by itself and cast."""
    at = lambda r: f"{root.rstrip('/')}/{r}/{name}.parquet"
    region = F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]+)/{name}\.parquet", 1)
    region = F.url_decode(F.replace(region, F.lit("+"), F.lit("%2B")))  # the path is that of a URL
    names = regions(spark, root).get(name, [])
    kinds: dict[str, set[str]] = {}
    for r in names:  # footers only
        for c, k in spark.read.parquet(at(r)).dtypes:
            kinds.setdefault(c, set()).add(k)
    to = _agreed(name, kinds)
    if to:
        each = [spark.read.parquet(at(r)) for r in names]
        each = [df.withColumns({c: F.expr(f"try_cast(`{c}` AS {k})") for c, k in to.items() if c in df.columns}).withColumn("region", F.lit(r)) for r, df in zip(names, each, strict=True)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
    df = spark.read.option("mergeSchema", True).option("pathGlobFilter", "*.parquet").parquet(at("*"))
    return df.withColumn("region", region).filter("region <> 'combined'")
