"""Union of regions with unlike columns, and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combined(regions: dict[str, DataFrame]) -> DataFrame | None:
    """All rows of all regions with a ``region`` column; a column that a region lacks is null there. None for no region."""
    if not regions:
        return None
    parts = [df.withColumn("region", F.lit(name)) for name, df in sorted(regions.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset, rows) for all datasets, in one job."""
    each = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows") for name, df in sorted(datasets.items())]
    return reduce(DataFrame.unionByName, each)
