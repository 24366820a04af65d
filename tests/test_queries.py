import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from pistespark.plans import queries, views

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the test tables")


def normal(df, cols):
    text = lambda v: None if pd.isna(v) else str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(zip(*[[str(text(v)) for v in df[c].tolist()] for c in cols], strict=True))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, DIR).toPandas(), duck.sql(queries.SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert normal(got, cols) == normal(want, cols)


def test_stored_points_are_the_means_of_one_thread(spark):
    c = duckdb.connect(config={"threads": 1})
    c.sql(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{DIR}/lineitem.parquet')")
    want = {i: (y, x) for i, y, x in c.sql(views.with_views("way_vertex") + "SELECT way_id, avg(lat), avg(lon) FROM way_vertex GROUP BY way_id").fetchall()}
    assert {r["way_id"]: (r["lat"], r["lon"]) for r in views.way_points(spark, DIR, stored=True).collect()} == want
    assert {r["way_id"]: (r["lat"], r["lon"]) for r in views.way_points(spark, DIR).collect()} != want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["nearby_radius_join", "admin_pip", "area_pip_first", "distance_pairs"])
def test_spatial_queries_have_no_nested_loop(spark, name):
    plan = queries.QUERIES[name](spark, DIR)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
