"""The nearby extract over a stream of map changes: a stream-static join, with no state that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pistespark.operators.spatial_join import radius_join


def feature_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    """New Parquet files of features under a path, ``files`` at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def nearby_stream(features: DataFrame, areas: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of new features and known areas within the radius."""
    return radius_join(features, areas, radius_m)


def counts_by_area(pairs: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """New features per area and window of event time; windows close ``late`` after the latest time seen."""
    return pairs.withWatermark(time, late).groupBy(F.window(time, window), "area_id").agg(F.count("*").alias("features"))


def to_parquet(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet folder, exactly once, until what is there is done."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
