"""Readers that route what they cannot use to a table of rejects, with its reason and place, instead of losing it.

``features``, ``elements`` and ``analyzed`` tag every row of the input; ``routed`` writes good and rejected rows in one pass
and gives back both. Each input row that is not blank is in exactly one of the two, so their counts add up to the input's.

reason: one of REASONS, the first that fits. file and block are the row's file and where the split that it was read in
begins; ordinal is the row's own number, or its place in a document, null where it has none; value is the row's whole text.
An input without rows gives two typed tables without rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pistespark.functions import geo
from pistespark.functions import tags as tg
from pistespark.schema import ANALYZED_DDL
from pistespark.sources import documents, readers

#: What may be wrong with a row, in the order that it is asked.
REASONS = ["broken", "kind", "id", "no geometry", "empty geometry"]
PLACE = ["file", "block", "ordinal", "value"]
_BAD = "_broken"


def _texts(spark: SparkSession, path: str, key: str, lines: bool) -> DataFrame:
    """file, block, ordinal, value of every row; of lines the ordinal is null here."""
    if not lines:
        return documents.objects(spark, path, key).select("file", F.lit(None).cast("bigint").alias("block"), "ordinal", "value")
    rows = spark.read.text(path).filter(F.trim("value") != "")
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.lit(None).cast("bigint").alias("ordinal"), "value")


def _parsed(rows: DataFrame, kind: str) -> DataFrame:
    """rows with ``e``, the text as a struct that also has ``ordinal`` and what could not be read."""
    fields = [f for f in T.StructType.fromDDL(f"e {kind}")["e"].dataType.fields if f.name != "ordinal"]
    whole = T.StructType([*fields, T.StructField("ordinal", T.LongType()), T.StructField(_BAD, T.StringType())])
    out = rows.withColumn("e", F.from_json("value", whole, {"columnNameOfCorruptRecord": _BAD}))
    return out.withColumn("ordinal", F.coalesce("ordinal", "e.ordinal"))


def _reason(*tests: tuple[str, Column]) -> Column:
    """The first reason whose test holds; null for none. A test that is null holds not."""
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests])


def features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """GeoJSON features as ``readers.geojson`` gives them, and those that it drops, with ``reason`` and place."""
    rows = _parsed(_texts(spark, path, "features", lines), readers.FEATURE)
    rows = readers.shaped(rows.withColumn("f", F.col("e")))
    known = F.col("kind").isin("Point", "LineString", "MultiPoint", "MultiLineString", "Polygon", "MultiPolygon")
    broken = F.col("e").isNull() | F.col(f"e.{_BAD}").isNotNull()
    reason = _reason(("broken", broken), ("kind", ~F.col("e.type").eqNullSafe("Feature")), ("no geometry", F.col("e.geometry").isNull()), ("kind", ~F.coalesce(known, F.lit(False))), ("empty geometry", F.coalesce(F.size("geometry"), F.lit(0)) <= 0))
    return rows.select(*PLACE, reason.alias("reason"), "kind", F.coalesce("e.properties", F.create_map().cast("map<string,string>")).alias("props"), F.col("e.id").alias("feature_id"), "geometry", "parts", "lines")


def elements(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Map elements as ``readers.osm_json`` gives them, and those that are no element: broken, of another kind, without an id or a place."""
    rows = _parsed(_texts(spark, path, "elements", lines), readers.ELEMENT_JSON)
    e = lambda c: F.col(f"e.{c}")
    broken = F.col("e").isNull() | e(_BAD).isNotNull()
    shape = geo.element_geometry(e("type"), e("lat"), e("lon"), e("geometry"), e("bounds"), e("members"))
    named = (F.coalesce(F.size(e("nodes")), F.lit(0)) > 0) | (F.coalesce(F.size(e("members")), F.lit(0)) > 0)  # a shape may come from these
    reason = _reason(("broken", broken), ("kind", ~F.coalesce(e("type").isin("node", "way", "relation"), F.lit(False))), ("id", e("id").isNull()), ("no geometry", (F.coalesce(F.size(shape), F.lit(0)) <= 0) & ~named))
    own = [c for c in rows.schema["e"].dataType.names if c not in ("ordinal", _BAD)]
    out = rows.select(*PLACE, reason.alias("reason"), *[e(c).alias(c) for c in own]).withColumnsRenamed({"type": "osm_type", "id": "osm_id"})
    return out.withColumn("winter_sports_id", tg.numeric_key(F.col("winter_sports_id"))).withColumn("tags", F.coalesce("tags", F.create_map().cast("map<string,string>")))


def analyzed(spark: SparkSession, path: str) -> DataFrame:
    """The per-area CSV as ``readers.analyzed_csv`` gives it, and rows with a field too few or too many or of the wrong type, or without an id."""
    schema = T.StructType([*T.StructType.fromDDL(ANALYZED_DDL).fields, T.StructField(_BAD, T.StringType())])
    rows = spark.read.option("header", True).option("columnNameOfCorruptRecord", _BAD).option("enforceSchema", True).schema(schema).csv(path)
    reason = _reason(("broken", F.col(_BAD).isNotNull()), ("id", F.col("winter_sports_id").isNull()))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.lit(None).cast("bigint").alias("ordinal"), F.col(_BAD).alias("value")]
    return rows.select(*place, reason.alias("reason"), *schema.names[:-1])


def routed(tagged: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of a tagged table, written under ``folder`` in one pass. Good rows lose reason, text and place but keep
    their ordinal; rejects keep only these."""
    data = tagged.columns[len(PLACE) + 1 :]
    bad = F.col("reason").isNotNull()
    # a good row's text and a rejected row's values are not stored
    rows = tagged.select(*[F.when(bad, F.col(c)).alias(c) if c == "value" else F.col(c) for c in PLACE], "reason", *[F.when(~bad, F.col(c)).alias(c) for c in data], F.when(bad, "rejects").otherwise("good").alias("_to"))
    rows.write.mode("overwrite").partitionBy("_to").parquet(folder)
    back = tagged.sparkSession.read.schema(rows.schema).parquet(folder)
    return back.filter("_to = 'good'").select("ordinal", *data), back.filter("_to = 'rejects'").select(*PLACE, "reason")


def summary(rejects: DataFrame) -> DataFrame:
    """(file, reason, rows) of a table of rejects."""
    return rejects.groupBy("file", "reason").agg(F.count("*").alias("rows"))
