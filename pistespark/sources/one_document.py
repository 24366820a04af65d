"""One JSON document that many tasks write: a header, the texts of all rows parted by commas, and an end.

1. Each task writes its rows as a part of its own into a staging folder and reports the part's place, name and length:
   a row per task, which is all that the driver gets.
2. With all lengths known, so is the place of every byte of the document, which is cut into stretches of equal length.
   How rows are dealt over the parts makes no difference to them.
3. Tasks copy a stretch each from the parts to its place in one file of the final length. Stretches begin at whole blocks, so no
   two tasks write to one block; copying again writes the same bytes, so a lost or repeated task does no harm.
4. One rename puts the file in its place: a reader sees the old document or the new one, and never a part of either.

What tasks that failed or ran twice have left is in the staging folder, which is deleted at the end, also after an error.
Step 3 needs a file system that can be written to at any place, as a mounted folder can. Elsewhere the file has one writer,
which streams the rows and holds none.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.sources.publish import counted, rows_of

BETWEEN = b",\n"
STRETCH, BLOCK, BUFFER = 64 << 20, 4096, 4 << 20
NAME = "part-00000.json"


def mounted(path: str) -> str | None:
    """The plain path, where it is one of a mounted file system."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return path.rstrip("/") if path.startswith("/") else None


def _parts(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        name, rows = f"{place:08d}-{uuid.uuid4().hex}", 0
        out = None
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                out = open(f"{folder}/{name}", "wb")
            else:
                out.write(BETWEEN)
            out.write(BETWEEN.join(v.encode() for v in batch.column(0).to_pylist()))
            rows += len(batch)
        if out is not None:
            size = out.tell()
            _closed(out)
            yield pa.RecordBatch.from_pylist([{"place": place, "name": name, "bytes": size, "rows": rows}])

    return write


def _closed(out) -> None:
    out.flush()
    os.fsync(out.fileno())
    out.close()


def stretches(parts: list[tuple[str, int]], head: bytes, end: bytes, length: int) -> tuple[list[tuple], int]:
    """(start, pieces) for each stretch of ``length`` bytes, and the document's length. A piece is (name of a part or null,
    first byte in it, bytes, text if there is no name)."""
    laid: list[tuple[str | None, int, bytes]] = [(None, len(head), head)]
    for i, (name, size) in enumerate(parts):
        laid += [(None, len(BETWEEN), BETWEEN)] * (i > 0) + [(name, size, b"")]
    laid.append((None, len(end), end))
    out: list[tuple] = []
    at = 0
    for name, size, text in laid:
        skip = 0
        while skip < size:
            if at % length == 0:
                out.append((at, []))
            n = min(size - skip, length - at % length)
            out[-1][1].append((name, skip, n, text[skip : skip + n]))
            skip, at = skip + n, at + n
    return out, at


def _copied(folder: str, to: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for row in batch.to_pylist():
                with open(to, "r+b") as out:
                    out.seek(row["start"])
                    for p in row["pieces"]:
                        if p["name"] is None:
                            out.write(p["text"])
                            continue
                        with open(f"{folder}/{p['name']}", "rb") as part:
                            part.seek(p["skip"])
                            left = p["n"]
                            while left:
                                some = part.read(min(left, BUFFER))
                                if not some:
                                    raise OSError(f"part {p['name']} is shorter than when it was written")
                                out.write(some)
                                left -= len(some)
                    done += out.tell() - row["start"]
                    out.flush()
                    os.fsync(out.fileno())
        yield pa.RecordBatch.from_pylist([{"bytes": done}])

    return copy


def written(rows: DataFrame, path: str, head: str, end: str, stretch: int = STRETCH) -> int:
    """Write ``value`` of all rows, in their order over partitions and rows, between head and end, as one file in a folder.
    Null values are left out, and no rows give head and end alone. Returns the number of rows written."""
    rows = rows.select("value").filter("value IS NOT NULL")
    folder = mounted(path)
    if folder is None:
        return _streamed(rows, path, head, end)
    staging = f"{folder}/_staging-{uuid.uuid4().hex}"
    os.makedirs(staging)
    try:
        parts = sorted(map(tuple, rows.mapInArrow(_parts(staging), "place long, name string, bytes long, rows long").collect()))
        cut, length = stretches([p[1:3] for p in parts], head.encode(), end.encode(), max(BLOCK, stretch // BLOCK * BLOCK))
        with open(f"{staging}/document", "wb") as out:
            out.truncate(length)
        plan = rows.sparkSession.createDataFrame(cut, "start long, pieces array<struct<name: string, skip: long, n: long, text: binary>>")
        copied = plan.repartition(len(cut), "start").mapInArrow(_copied(staging, f"{staging}/document"), "bytes long").agg(F.sum("bytes")).first()[0]
        if copied != length:
            raise OSError(f"{copied} of {length} bytes of {path} were copied")
        old = [f.path for f in os.scandir(folder) if f.is_file() and f.name not in (NAME, "_SUCCESS")]
        os.replace(f"{staging}/document", f"{folder}/{NAME}")
        for f in old:  # of an earlier output by other names
            os.remove(f)
        with open(f"{folder}/_SUCCESS", "wb"):
            pass
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    return sum(p[3] for p in parts)


def _streamed(rows: DataFrame, path: str, head: str, end: str) -> int:
    """The same by one writer, for file systems that only append."""
    text, seen = counted(rows)
    text = text.select(F.lit(1).alias("k"), F.monotonically_increasing_id().alias("at"), "value")
    ends = rows.sparkSession.createDataFrame([(0, 0, head), (2, 0, end)], "k int, at long, value string")
    one = ends.unionByName(text).repartition(1).sortWithinPartitions("k", "at").withColumn("n", F.monotonically_increasing_id())
    # after sorting, every row but the first has a comma before it
    comma = F.when((F.col("k") == 1) & (F.col("n") > 1), F.lit(",")).otherwise("")
    one.select(F.concat(comma, "value").alias("value")).write.mode("overwrite").text(path)
    return rows_of(seen)
