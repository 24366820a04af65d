"""Writing tables. Every sink writes in parallel and leaves a readable, typed output also for no rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pistespark.functions import geo
from pistespark.functions import tags as tg
from pistespark.schema import ANALYZED_COLUMNS, RING
from pistespark.sources import one_document, readers
from pistespark.sources.geoparquet import GeoParquet
from pistespark.sources.publish import counted, rows_of


def feature_text(df: DataFrame, props: list[str] | Column, *keep: str) -> DataFrame:
    """One GeoJSON feature per row as ``value``. df: geometry (vertices), parts (or null), the property columns (or a map), and ordinal,
    if the features have an order to keep."""
    pair = lambda v: F.concat(F.lit("["), v["lon"].cast("string"), F.lit(","), v["lat"].cast("string"), F.lit("]"))
    row = lambda g: F.concat(F.lit("["), F.array_join(F.transform(g, pair), ","), F.lit("]"))
    nest = lambda x, f: F.concat(F.lit("["), F.array_join(F.transform(x, f), ","), F.lit("]"))
    kind = F.when(F.size("parts") == 1, "Polygon").when(F.size("parts") > 1, "MultiPolygon").otherwise(geo.geometry_kind(F.col("geometry")))
    coords = (
        F.when(F.size("parts") == 1, nest(F.get("parts", F.lit(0)), row))
        .when(F.size("parts") > 1, nest(F.col("parts"), lambda p: nest(p, row)))
        .when(kind == "Point", pair(F.get("geometry", F.lit(0))))
        .when(kind == "Polygon", F.concat(F.lit("["), row(F.col("geometry")), F.lit("]")))
        .otherwise(row(F.col("geometry")))
    )
    shape = F.coalesce(F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}")), F.lit("null"))
    return df.select(F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), F.coalesce(F.to_json(F.struct(*props) if isinstance(props, list) else props), F.lit("null")), *([F.lit(',"ordinal":'), F.col("ordinal").cast("string")] if "ordinal" in df.columns else []), F.lit("}")).alias("value"), *keep)


def geojson_lines(df: DataFrame, path: str, props: list[str] | Column) -> int:
    """A folder of line-delimited features: splittable, and written in parallel. The rows written."""
    rows, seen = counted(feature_text(df, props))
    rows.write.mode("overwrite").text(path)
    return rows_of(seen)


def in_order(df: DataFrame) -> DataFrame:
    """Rows in the order of ``ordinal`` over all partitions, if there is one."""
    return df.repartitionByRange("ordinal").sortWithinPartitions("ordinal") if "ordinal" in df.columns else df


def geojson_document(df: DataFrame, path: str, props: list[str] | Column) -> int:
    """One feature collection as one file in a folder, in the order of ``ordinal``, which many tasks write. The rows written."""
    return one_document.written(feature_text(in_order(df), props), path, '{"type":"FeatureCollection","features":[\n', "\n]}\n")


def element_document(df: DataFrame, path: str, generator: str = "pistespark") -> int:
    """Elements as one JSON document with its header, in the order of ``ordinal``, which is their place in it. The rows written."""
    rows = in_order(df).withColumnsRenamed({"osm_type": "type", "osm_id": "id"}).drop("ordinal")
    head = json.dumps({"version": 0.6, "generator": generator, "elements": []}).removesuffix("]}") + "\n"
    return one_document.written(rows.select(F.to_json(F.struct("*")).alias("value")), path, head, "\n]}\n")


def element_lines(df: DataFrame, path: str) -> None:
    """A folder of element JSON, one element per line."""
    df.withColumnsRenamed({"osm_type": "type", "osm_id": "id"}).write.mode("overwrite").json(path)


def analyzed_csv(df: DataFrame, path: str) -> None:
    """The per-area table as CSV with its fixed columns; the header stands also in an output without rows."""
    out = df.select(*ANALYZED_COLUMNS)
    if out.isEmpty():
        out = out.repartition(1)
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def nearby_parquet(df: DataFrame, path: str, limit: int | None = None) -> None:
    """Nearby features with their geometry as well-known binary and as vertices, and tags as JSON text.

    limit: the first rows by ordinal, before those without a geometry are dropped."""
    rows = df.orderBy("ordinal").limit(limit) if limit else df
    rows = rows.filter(geo.geometry_kind(F.col("geometry")).isNotNull())
    rows.withColumn("wkb", geo.wkb(F.col("geometry"))).withColumn("tags", tg.tags_text(F.col("tags"))).write.mode("overwrite").parquet(path)


def areas_parquet(analyzed: DataFrame, areas: DataFrame, path: str) -> None:
    """The per-area table joined with its areas' points; areas without one are left out."""
    at = areas.filter("lat IS NOT NULL AND lon IS NOT NULL").select(F.col("area_type").alias("winter_sports_type"), F.col("area_id").alias("winter_sports_id"), geo.wkb(F.array(geo.vertex(F.col("lat"), F.col("lon")))).alias("wkb"))
    analyzed.join(at, ["winter_sports_type", "winter_sports_id"]).write.mode("overwrite").parquet(path)


def features_parquet(features: DataFrame, path: str) -> None:
    features.withColumn("wkb", geo.wkb(F.col("geometry"))).write.mode("overwrite").parquet(path)


def geoparquet(df: DataFrame, path: str, mode: str = "overwrite", ordered: bool = True) -> None:
    """GeoParquet of features or elements: ``geometry`` (vertices) and, if there, ``parts`` become well-known binary; rows get a
    ``bbox``, and tags become JSON text. The vertices stay as a column beside it, which Spark reads without decoding.

    ordered: rows go along a Hilbert curve of the middles of their bounds, so that files and row groups are compact areas."""
    df.sparkSession.dataSource.register(GeoParquet)
    g = F.flatten(F.flatten("parts")) if "parts" in df.columns else F.lit(None).cast(RING)
    b = geo.ring_bounds(F.coalesce(F.when(F.size(g) > 0, g), F.col("geometry")))
    shape = geo.wkb(F.col("geometry"))
    if "parts" in df.columns:
        shape = F.coalesce(geo.wkb_of_parts(F.col("parts")), shape)
    box = F.when(b.isNotNull(), F.struct(b["minlon"].alias("xmin"), b["minlat"].alias("ymin"), b["maxlon"].alias("xmax"), b["maxlat"].alias("ymax")))
    rows = df.withColumns({"bbox": box, "vertices": F.col("geometry"), "geometry": shape}).drop("parts", "lines")
    if "tags" in df.columns:
        rows = rows.withColumn("tags", tg.tags_text(F.col("tags")))
    if ordered:
        at = geo.hilbert((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2, (F.col("bbox.xmin") + F.col("bbox.xmax")) / 2)
        rows = rows.withColumn("_at", at).repartitionByRange("_at").sortWithinPartitions("_at").drop("_at")  # the binary is made after the sort
    rows.write.format("geoparquet").mode(mode).save(path)


def csv_to_parquet(spark: SparkSession, source: str, path: str) -> None:
    """The per-area table from CSV to Parquet, with its fixed types."""
    readers.analyzed_csv(spark, source).write.mode("overwrite").parquet(path)


def combined(df: DataFrame, path: str) -> int:
    """All regions of a table, a folder for each. The rows written."""
    rows, seen = counted(df)
    rows.write.mode("overwrite").partitionBy("region").parquet(path)
    return rows_of(seen)


def export_all(jobs: dict[str, Callable[[], None]]) -> dict[str, str | None]:
    """Run each export; one that fails is reported by its error and does not stop the others."""
    out: dict[str, str | None] = {}
    for name, job in jobs.items():
        try:
            job()
            out[name] = None
        except Exception as e:  # the caller gets every error by name
            out[name] = f"{type(e).__name__}: {e}"
    return out


def published(df: DataFrame, path: str, month: str) -> None:
    """Publish under region and month; a rerun replaces only the partitions that it writes."""
    df.withColumn("month", F.lit(month)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region", "month").parquet(path)
