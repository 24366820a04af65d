"""Publishing by region and month so that a reader never sees half a month.

A run writes its files under a version of its own, which no manifest names yet. Then it replaces the month's manifest, a small
JSON file that says for each region where its files are, by one rename: before it readers see the old month, after it the
new one. A run that dies in between leaves files that nothing names; ``swept`` deletes these.

    path/data/version=V/region=R/month=M/*.parquet      path/manifests/M.json

A run replaces the regions that it has rows of and keeps the month's other regions; without rows it changes nothing but makes the
manifest. A month has one publisher at a time: of two that end together, the later one's manifest stands. A null region is
one of its own. Object stores have no rename: there the manifest's move is a copy of one small object, which is as atomic as its PUT.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pistespark.shared import listed


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df that counts its rows (``rows``) while it is written, so no one reads the table again for that."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_of(seen: Observation) -> int:
    """What ``counted`` counted, once its write is done; a plan that Spark found to be empty counted nothing."""
    return int(seen.get.get("rows", 0))


class _Files:
    """The few file system calls that publishing needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        at = self.path(path)
        self.fs = at.getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Put a small file in place of an old one in one step."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        mode = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.jvm.java.lang.reflect.Array.newInstance(mode.OVERWRITE.getClass(), 1)
        how[0] = mode.OVERWRITE
        self.context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.path(name)), how)


def manifests(spark: SparkSession, path: str) -> dict[str, dict]:
    """Month to its manifest: regions (folder name to place below path), and rows of the last run."""
    at, out = path.rstrip("/"), {}
    for f in listed(spark, f"{at}/manifests/*.json"):
        m = json.loads(_Files(spark, f).read(f))
        out[m["month"]] = m
    return out


def publish(df: DataFrame, path: str, month: str) -> dict:
    """Publish ``df``, which has a ``region``, as that month's rows of its regions; the month's new manifest."""
    if not re.fullmatch(r"[\w.-]+", month):
        raise ValueError(f"{month!r} is no name of a month")
    spark, at, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    rows, seen = counted(df)
    root = f"data/version={version}"
    rows.withColumn("month", F.lit(month)).write.partitionBy("region", "month").parquet(f"{at}/{root}")
    held = _Files(spark, at)
    old = manifests(spark, at).get(month, {})
    new = {name: f"{root}/{name}/month={month}" for name in (p.rstrip("/").rsplit("/", 1)[1] for p in listed(spark, f"{at}/{root}/region=*"))}
    # what files hold, so that also a month without rows has its columns
    kind = T.StructType([f for f in df.schema if f.name != "region"]).json() if new or not old else json.dumps(old["schema"])
    manifest = {"month": month, "regions": old.get("regions", {}) | new, "rows": rows_of(seen), "schema": json.loads(kind)}
    held.fs.mkdirs(held.path(f"{at}/manifests"))
    held.replace(f"{at}/manifests/{month}.json", json.dumps(manifest, sort_keys=True))
    return manifest


def published(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """All rows that the manifests name, of some months or all, with region and month. A column that a month lacks is null there.

    It reads the manifests once, when called: the plan keeps to these files, whatever is published later."""
    at = path.rstrip("/")
    found = {m: v for m, v in manifests(spark, at).items() if months is None or m in months}
    if not found:
        raise ValueError(f"nothing is published under {path}")
    fields: dict[str, T.StructField] = {}
    for _, v in sorted(found.items()):  # of types that differ, the last month's
        fields |= {f.name: f for f in T.StructType.fromJson(v["schema"]) if f.name != "month"}
    schema = T.StructType([*fields.values(), T.StructField("region", T.StringType()), T.StructField("month", T.StringType())])
    places = [f"{at}/{place}" for v in found.values() for place in v["regions"].values()]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", f"{at}/data").schema(schema).parquet(*places).select(*schema.names)


def swept(spark: SparkSession, path: str) -> list[str]:
    """Delete regions' files that no manifest names; the places deleted. For when no one publishes or reads an old month."""
    at = path.rstrip("/")
    held = _Files(spark, at)
    named = {place for m in manifests(spark, at).values() for place in m["regions"].values()}
    gone = []
    for p in listed(spark, f"{at}/data/version=*/region=*/month=*"):
        place = "/".join(["data", *p.rstrip("/").rsplit("/", 3)[1:]])
        if place not in named:
            held.fs.delete(held.path(p), True)
            gone.append(place)
    return gone
