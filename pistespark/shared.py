"""Small helpers that every part of the library uses: table paths, and writing an intermediate result."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, a fresh local folder
    if all runs in this one process (tests), and an error on a cluster, whose executors would not see such a folder."""
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known:
        if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(known)
    return known.rstrip("/")


#: Whether shuffle files go when the query that made them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables that ``written`` has made, by application.
_TABLES: dict[str, list[str]] = {}


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The lineage ends at that table, so a lost executor costs a reread and never the work before it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str = "part") -> DataFrame:
    """As ``written``; the shuffle files that the write needed are deleted with its end, whatever the collector does.

    For a ``df`` that is run once: running it again makes its shuffles anew.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        _delete(df.sparkSession, f)


def cleared(spark: SparkSession) -> None:
    """Delete all tables that ``written`` has made in this application: for a long session, once the results are stored."""
    for f in _TABLES.pop(spark.sparkContext.applicationId, []):
        _delete(spark, f)


def _delete(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches in the file system that it names; none if there is nothing."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores added as keep it apart from the taken ones, in any case."""
    held, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in held:
            n += "_"
        held.add(n.lower())
        out.append(n)
    return out


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join of rows whose keys may be very uneven with a table that has a key once.

    A hash of the keys joins along. It is made after whatever grouped ``small``, so both sides get their own
    exchange, which is what AQE needs to split the partitions of a hot key.
    """
    name = fresh([*big.columns, *small.columns], "_k")[0]
    k = F.xxhash64(*keys)
    return big.withColumn(name, k).join(small.withColumn(name, k), [name, *keys], how).drop(name)


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs whose results are tables by now.

    Twice, as what the first collection lets go may itself hold on to something."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
