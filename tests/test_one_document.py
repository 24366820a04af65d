"""One document written by many tasks: the same bytes however rows are dealt and however it is cut."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pistespark.sources import one_document, readers, sinks

HEAD, END = '{"version":1,"rows":[\n', "\n]}\n"


def rows_in(spark, n, parts):
    """n values of very uneven length in ``parts`` partitions, in order, some of them without rows."""
    text = F.to_json(F.struct(F.col("id"), F.repeat(F.lit("é\n\"x"), F.when(F.col("id") % 7 == 0, 3000).otherwise((F.col("id") % 5).cast("int"))).alias("t")))
    df = spark.range(0, n * 2, 1, parts).filter(f"id < {n}").select("id", text.alias("value"))
    return df


def the_file(path):
    files = [f for f in os.listdir(path) if not f.startswith((".", "_"))]
    assert files == [one_document.NAME]
    with open(f"{path}/{files[0]}", encoding="utf-8") as f:
        return f.read()


@pytest.mark.parametrize("n", [0, 1, 90])
@pytest.mark.parametrize("stretch", [1, 10_000, 64 << 20])
def test_the_same_bytes_for_any_dealing_and_cut(spark, tmp_path, n, stretch):
    want = [r["value"] for r in rows_in(spark, n, 1).orderBy("id").collect()]
    for parts in (1, 7):
        path = f"{tmp_path}/d{parts}"
        assert one_document.written(rows_in(spark, n, parts), path, HEAD, END, stretch) == n
        text = the_file(path)
        assert text == HEAD + ",\n".join(want) + END and len(json.loads(text)["rows"]) == n
        assert not [f for f in os.listdir(path) if f.startswith("_staging")]


@pytest.mark.parametrize("length", [1, 2, 3, 5, 8, 100])
def test_stretches_cover_the_document_once(length):
    parts = [("a", 1), ("b", 17), ("c", 2), ("d", 40)]
    texts = {name: bytes(range(i * 50, i * 50 + n)) for i, (name, n) in enumerate(parts)}
    cut, size = one_document.stretches(parts, b"<<<", b">>", length)
    got = bytearray(size)
    for i, (start, pieces) in enumerate(cut):
        assert start == i * length
        piece = b"".join(text if name is None else texts[name][skip : skip + n] for name, skip, n, text in pieces)
        assert len(piece) == min(length, size - start)
        got[start : start + len(piece)] = piece
    assert bytes(got) == b"<<<" + b",\n".join(texts[name] for name, _ in parts) + b">>"


def test_a_task_that_runs_again_changes_nothing(spark, tmp_path):
    """Every part and every stretch is written twice, as by speculation or after a lost executor; the lists name one of each."""
    staging = tmp_path / "staging"
    staging.mkdir()
    rows = rows_in(spark, 40, 4).select("value")
    kept = None
    for _ in range(2):
        kept = sorted(map(tuple, rows.mapInArrow(one_document._parts(str(staging)), "place long, name string, bytes long, rows long").collect()))
    assert len(os.listdir(staging)) == 2 * len(kept)
    cut, size = one_document.stretches([p[1:3] for p in kept], HEAD.encode(), END.encode(), 4096)
    out = staging / "document"
    out.write_bytes(b"\0" * size)
    plan = spark.createDataFrame(cut, "start long, pieces array<struct<name: string, skip: long, n: long, text: binary>>")
    for _ in range(2):
        plan.unionByName(plan.limit(2)).repartition(3).mapInArrow(one_document._copied(str(staging), str(out)), "bytes long").collect()
    assert [r["id"] for r in json.loads(out.read_text())["rows"]] == list(range(40))


def test_an_error_leaves_the_old_document(spark, tmp_path):
    path = str(tmp_path / "d")
    one_document.written(rows_in(spark, 5, 2), path, HEAD, END)
    before = the_file(path)
    broken = rows_in(spark, 50, 4).select(F.when(F.col("id") == 30, F.raise_error(F.lit("no"))).otherwise(F.col("value")).alias("value"))
    with pytest.raises(Exception, match="no"):
        one_document.written(broken, path, HEAD, END)
    assert the_file(path) == before and not [f for f in os.listdir(path) if f.startswith("_staging")]
    one_document.written(rows_in(spark, 2, 2), f"file://{path}", HEAD, END)
    assert len(json.loads(the_file(path))["rows"]) == 2


def test_null_values_and_the_single_writer(spark, tmp_path):
    rows = rows_in(spark, 30, 3).select(F.when(F.col("id") % 3 > 0, F.col("value")).alias("value"))
    for name, write in (("many", one_document.written), ("one", lambda df, *a: one_document._streamed(df.filter("value IS NOT NULL"), *a))):
        path = str(tmp_path / name)
        assert write(rows, path, HEAD, END) == 20
        (file,) = (tmp_path / name).glob("part-*")
        assert [r["id"] for r in json.loads(file.read_text())["rows"]] == [i for i in range(30) if i % 3]


def test_elements_in_order_with_their_header(spark, tmp_path):
    path = str(tmp_path / "e")
    rows = spark.range(200).selectExpr("199 - id AS ordinal", "'node' AS osm_type", "id AS osm_id", "CAST(id AS DOUBLE) AS lat", "1D AS lon", "map('name', concat('n', id)) AS tags").repartition(5)
    assert sinks.element_document(rows, path, 'a "b"') == 200
    doc = json.loads(the_file(path))
    assert (doc["version"], doc["generator"]) == (0.6, 'a "b"') and [e["id"] for e in doc["elements"]] == list(range(199, -1, -1))
    assert sorted((r["ordinal"], r["osm_id"], r["tags"]["name"]) for r in readers.osm_json(spark, path).collect()) == [(i, 199 - i, f"n{199 - i}") for i in range(200)]
