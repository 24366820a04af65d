"""One-document files in splits: the same objects with the same numbers, however they are cut."""

import json

import pytest
from pyspark.sql import functions as F

from pistespark.sources import documents, readers, sinks

TRICKY = [
    {"type": "Feature", "properties": {"name": 'a } "b" { [ \\'}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    {"type": "Feature", "properties": {"name": "}}]],\\\\", "deep": {"x": [{"y": [{}]}]}}, "geometry": {"type": "Point", "coordinates": [3, 4]}},
    {"type": "Feature", "properties": {"{": "é 馬   \U0001f600"}, "geometry": None},
    {},
    {"type": "Feature", "properties": {"name": "line\nbreak\ttab"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}},
] + [{"type": "Feature", "properties": {"name": f"n{i}", "text": "x" * (i % 40)}, "geometry": {"type": "Point", "coordinates": [i, i]}} for i in range(200)]

DOCS = {
    "plain": {"type": "FeatureCollection", "features": TRICKY},
    "header": {"type": "FeatureCollection", "name": 'the "features": [ of }', "bbox": [0, 1, 2, 3], "crs": {"type": "name", "properties": {"name": "urn"}}, "features": TRICKY, "more": {"a": [1, {"b": 2}]}},
    "keyed": {"multipolygons": {"type": "FeatureCollection", "features": TRICKY[:2]}, "lines": {"features": []}, "points": {"features": TRICKY[2:]}},
    "other": {"notes": [{"type": "Feature"}, {"a": {}}], "features": TRICKY},
    "none": {"type": "FeatureCollection", "features": []},
}


def of(spark, path, size, key="features"):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, (size, 1), strict=True):
        spark.conf.set(n, v)
    try:
        got = {}
        for r in documents.objects(spark, path, key).collect():
            got.setdefault(r["file"].rsplit("/", 1)[1].split(".")[0], []).append((r["ordinal"], json.loads(r["value"])))
        return {k: sorted(v, key=lambda x: x[0]) for k, v in got.items()}
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)


@pytest.mark.parametrize("size", [1 << 27, 5000])
def test_objects(spark, tmp_path, size):
    for i, (name, doc) in enumerate(DOCS.items()):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=[None, 2][i % 2], ensure_ascii=i > 2), encoding="utf-8")
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "bare.json").write_text("{}")
    assert of(spark, str(tmp_path), size) == {name: list(enumerate(TRICKY)) for name in DOCS if name != "none"}


def test_elements_of_several_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"version": 0.6, "elements": [{"type": "node", "id": i * 10 + k} for k in range(3)]}))
    assert sorted((r["ordinal"], r["osm_id"]) for r in readers.osm_json(spark, str(tmp_path)).collect()) == [(k, i * 10 + k) for k in range(3) for i in range(3)]


def test_many_tasks(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(DOCS["plain"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_document_written_and_read(spark, tmp_path):
    rows = spark.range(30).selectExpr("id AS ordinal", "concat('n', id) AS name", "array(named_struct('lat', CAST(id AS DOUBLE), 'lon', 1D)) AS geometry", "CAST(null AS array<array<array<struct<lat:double,lon:double>>>>) AS parts").repartition(4)
    for df, n in ((rows, 30), (rows.limit(0), 0)):
        sinks.geojson_document(df, str(tmp_path / f"d{n}"), ["name"])
        (file,) = (tmp_path / f"d{n}").glob("part-*")
        assert len(json.loads(file.read_text())["features"]) == n
        assert sorted((r["ordinal"], r["props"]["name"]) for r in readers.geojson(spark, str(tmp_path / f"d{n}")).collect()) == [(i, f"n{i}") for i in range(n)]


@pytest.mark.parametrize("size", [40, 150])
def test_objects_that_are_cut(spark, tmp_path, size):
    """Splits of a few bytes: objects over several of them, cut at braces in strings and behind escaped quotes, in arrays of both kinds."""
    rows = TRICKY[:12]
    docs = {"plain": {"features": rows}, "other": {"notes": rows[:3], "features": rows}, "keyed": {"a": {"features": rows[:5]}, "b": {"notes": rows}, "c": {"features": rows[5:]}}}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    assert of(spark, str(tmp_path), size) == {name: list(enumerate(rows)) for name in docs}


def test_objects_of_one_file_stay_in_many_tasks(spark, tmp_path):
    """Numbering the objects of a file must not bring them all to one task."""
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(DOCS["plain"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        found = documents.objects(spark, str(path), "features").withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(r["count"] for r in found) == len(TRICKY) and max(r["count"] for r in found) < len(TRICKY) / 2


def test_other_splits_than_were_counted_are_an_error(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(DOCS["plain"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        df = documents.objects(spark, str(path), "features")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="splits have changed"):
        df.collect()
