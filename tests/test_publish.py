"""A month is switched by its manifest alone; rows are counted while they are written."""

import pytest
from pyspark.sql import functions as F

from pistespark.plans import jobs
from pistespark.sources import publish, sinks


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "region string, n int")


def seen(df):
    return sorted(((r["month"], r["region"], r["n"]) for r in df.collect()), key=str)


def test_publish(spark, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(ValueError):
        publish.published(spark, path)
    first = publish.publish(rows(spark, ("a", 1), ("a", 2), ("b / c=d é", 3), (None, 4)), path, "2024-01")
    assert first["rows"] == 4 and len(first["regions"]) == 3
    before = publish.published(spark, path)
    want = [("2024-01", "a", 1), ("2024-01", "a", 2), ("2024-01", "b / c=d é", 3), ("2024-01", None, 4)]
    assert seen(before) == sorted(want, key=str)
    assert publish.publish(rows(spark, ("a", 9)), path, "2024-01")["rows"] == 1
    after = [("2024-01", "a", 9), *want[2:]]
    assert seen(publish.published(spark, path)) == sorted(after, key=str)
    assert seen(before) == sorted(want, key=str)  # a plan keeps to what it was made over
    publish.publish(rows(spark, ("a", 5)).withColumn("more", F.lit("x")), path, "2024-02")
    both = publish.published(spark, path)
    assert both.columns == ["n", "more", "region", "month"] and seen(both) == sorted([*after, ("2024-02", "a", 5)], key=str)
    assert seen(publish.published(spark, path, ["2024-02"])) == [("2024-02", "a", 5)]
    gone = publish.swept(spark, path)
    assert len(gone) == 1 and gone[0].endswith("region=a/month=2024-01")
    assert seen(publish.published(spark, path)) == sorted([*after, ("2024-02", "a", 5)], key=str)
    with pytest.raises(ValueError):
        publish.publish(rows(spark, ("a", 1)), path, "../x")


def test_a_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    publish.publish(rows(spark, ("a", 1)), path, "m")
    with monkeypatch.context() as m:
        m.setattr(publish._Files, "replace", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            publish.publish(rows(spark, ("a", 2), ("b", 3)), path, "m")
    assert seen(publish.published(spark, path)) == [("m", "a", 1)]
    assert len(publish.swept(spark, path)) == 2 and seen(publish.published(spark, path)) == [("m", "a", 1)]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    assert publish.publish(rows(spark, ("a", 1)).limit(0), path, "m")["rows"] == 0
    out = publish.published(spark, path)
    assert out.columns == ["n", "region", "month"] and out.count() == 0
    publish.publish(rows(spark, ("a", 1)), path, "m")
    publish.publish(rows(spark, ("a", 1)).filter("n > 5"), path, "m")
    assert seen(publish.published(spark, path)) == [("m", "a", 1)]


def test_counts_of_a_write(spark, tmp_path):
    df = spark.range(1000).selectExpr("id AS ordinal", "concat('r', id % 3) AS region", "array(named_struct('lat', 1D, 'lon', 2D)) AS geometry", "CAST(null AS array<array<array<struct<lat:double,lon:double>>>>) AS parts").repartition(7)
    for some, n in ((df, 1000), (df.filter("ordinal < 10"), 10), (df.filter("ordinal < 0"), 0), (df.limit(0), 0)):
        assert sinks.geojson_lines(some, str(tmp_path / "g"), ["region"]) == n == spark.read.text(str(tmp_path / "g")).count()
        assert sinks.combined(some, str(tmp_path / "c")) == n
    for r in ("x", "y"):
        df.drop("region").write.parquet(str(tmp_path / "in" / r / "lifts.parquet"))
    assert jobs.combine_all(spark, str(tmp_path / "in"), str(tmp_path / "all")) == {"lifts": 2000}
