"""GeoParquet: Parquet with well-known binary, whose footers say what and where the geometries are.

Each task streams its rows to a file of its own beside the others and adds the ``geo`` entry at the end, when it knows the
kinds and the bounds of what it wrote. Files appear in the folder only when the whole write commits; what a failed or
repeated task leaves stays in a staging folder that the commit, or the abort, deletes. Rows carry their own bounds as
columns too, so a reader with a box skips row groups by their statistics.

The writer uses Arrow's file systems, for paths as well as for s3://, gs:// and hdfs:// addresses.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: The version of the footer, the names of kinds by their code in well-known binary, the columns of bounds.
VERSION = "1.1.0"
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
SIDES = ["xmin", "ymin", "xmax", "ymax"]
ROWS = 1 << 16  # of a row group


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def footer(kinds: set[int], bounds: list[float] | None) -> str:
    column = {"encoding": "WKB", "geometry_types": sorted(KINDS[k] for k in kinds if k in KINDS), "covering": {"bbox": {s: ["bbox", s] for s in SIDES}}}
    return json.dumps({"version": VERSION, "primary_column": "geometry", "columns": {"geometry": column | ({"bbox": bounds} if bounds else {})}})


def kinds_of(geometry: pa.Array) -> set[int]:
    """Codes of the kinds in an array of well-known binary of either byte order."""
    some = geometry.drop_null().cast(pa.binary())
    if not len(some):
        return set()
    heads = np.frombuffer(b"".join(pc.binary_slice(some, 0, 5).to_pylist()), np.uint8).reshape(-1, 5)
    return set(np.where(heads[:, 0] == 1, heads[:, 1], heads[:, 4]).tolist())


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex
        self.schema = schema
        self.staging = f"{self.path}/_staging-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        out, name = None, f"part-{uuid.uuid4().hex}.parquet"
        kinds: set[int] = set()
        low, high = np.full(2, np.inf), np.full(2, -np.inf)
        fs, at = file_system(self.staging)
        for batch in batches:
            if out is None:
                fs.create_dir(at, recursive=True)
                out = pq.ParquetWriter(f"{at}/{name}", batch.schema, filesystem=fs, compression="zstd")
            geometry = batch.column(batch.schema.get_field_index("geometry"))
            sides = batch.column(batch.schema.get_field_index("bbox"))
            kinds |= kinds_of(geometry)
            x0, y0, x1, y1 = (pc.struct_field(sides, s) for s in SIDES)
            if pc.count(x0).as_py():
                low = np.minimum(low, [pc.min(x0).as_py(), pc.min(y0).as_py()])
                high = np.maximum(high, [pc.max(x1).as_py(), pc.max(y1).as_py()])
            out.write_batch(batch, row_group_size=ROWS)
        if out is None:
            return Written(None)
        out.add_key_value_metadata({"geo": footer(kinds, [*low.tolist(), *high.tolist()] if np.isfinite(low).all() else None)})
        out.close()
        return Written(name)

    def commit(self, messages: list[Written]) -> None:
        fs, to = file_system(self.path)
        _, staged = file_system(self.staging)
        fs.create_dir(to, recursive=True)
        old = [f.path for f in fs.get_file_info(pafs.FileSelector(to)) if f.type == pafs.FileType.File]
        names = [m.name for m in messages if m is not None and m.name]
        for name in names:
            fs.move(f"{staged}/{name}", f"{to}/{name}")
        if not names and (self.overwrite or not old):  # a readable, typed table also for no rows
            from pyspark.sql.pandas.types import to_arrow_schema

            with pq.ParquetWriter(f"{to}/part-{uuid.uuid4().hex}.parquet", to_arrow_schema(self.schema), filesystem=fs) as out:
                out.add_key_value_metadata({"geo": footer(set(), None)})
        if self.overwrite:
            for f in old:
                fs.delete_file(f)
        with fs.open_output_stream(f"{to}/_SUCCESS"):
            pass
        self._cleared(fs, staged)

    def abort(self, messages: list[Written | None]) -> None:
        fs, staged = file_system(self.staging)
        self._cleared(fs, staged)

    @staticmethod
    def _cleared(fs: pafs.FileSystem, folder: str) -> None:
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class GeoParquet(DataSource):
    """``df.write.format("geoparquet")``; df has geometry (well-known binary) and bbox (a struct of SIDES). Reading is Spark's own Parquet."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], schema, overwrite)
