"""Polygons cut to grid cells once and kept: the index behind every "which polygon is this point in".

The row of a cell holds what its polygons need to decide there and the values that they give. Several sets of polygons
may share an index, each with columns of its own: countries and states are asked in one join, not in two. ``kept``
stores an index as a table bucketed by cell, for all jobs of a catalog, so later jobs neither read boundaries nor cut
them, and a join that is too large to broadcast moves the points alone. The size of its cells is stored with the table.

A polygon without an edge is in no cell, an index of no polygons has no rows and gives nulls, and equal polygons go by
their ordinal, as in ``first_match``. The most that a row holds is what overlaps in one cell: choose cells accordingly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pistespark.operators.spatial_join import CELL, cell_rows, in_cells
from pistespark.shared import settled

#: The table properties that tell an index.
_SIZE, _TAKE = "cells.size", "cells.take"


@dataclass(frozen=True)
class Cells:
    """rows: _cy, _cx, _polygons; take: the columns that a point gets; size: of a cell, in degrees."""

    rows: DataFrame
    take: tuple[str, ...]
    size: float = CELL

    def first_of(self, points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """All points with the ``take`` columns, each the first non-null value by ordinal of the polygons that hold the point."""
        return in_cells(points, self.rows, list(self.take), self.size, lat, lon)


def cut(sets: dict[str, DataFrame], size: float = CELL, ordinal: str = "ordinal") -> Cells:
    """The index of sets of polygons (ordinal, parts, and the column that the set is named by)."""
    take = list(sets)
    each = [df.select(F.col(ordinal).alias("ordinal"), *[(F.col(t) if t == name else F.lit(None)).cast("string").alias(t) for t in take], "parts") for name, df in sets.items()]
    return Cells(cell_rows(reduce(DataFrame.unionByName, each), take, size=size), tuple(take), size)


def once(cells: Cells) -> Cells:
    """The index as an intermediate table of this application: it is cut once, whatever asks it."""
    return Cells(settled(cells.rows, "cells"), cells.take, cells.size)


def kept(cells: Cells, name: str, buckets: int = 64, path: str | None = None) -> Cells:
    """Store the index as the catalog table ``name``, replacing one of that name; path: where its files go."""
    spark = cells.rows.sparkSession
    out = cells.rows.write.mode("overwrite").bucketBy(buckets, "_cy", "_cx").sortBy("_cy", "_cx")
    (out.option("path", path) if path else out).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_SIZE}' = '{cells.size!r}', '{_TAKE}' = '{','.join(cells.take)}')")
    return found(spark, name)


def found(spark: SparkSession, name: str) -> Cells:
    """The index stored as ``name``."""
    own = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _SIZE not in own:
        raise ValueError(f"{name} is no index of cells")
    return Cells(spark.table(name), tuple(own[_TAKE].split(",")), float(own[_SIZE]))
