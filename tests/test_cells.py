"""The index of boundaries: one cut, one join, stored by cell, and the same answers as cutting afresh."""

import random

import pytest

from pistespark.operators import cells, enrich
from pistespark.operators.spatial_join import first_match
from pistespark.plans import jobs

from test_jobs import NAMES


def shape(rng, n):
    """A star around a random middle, and its hole now and then."""
    import math

    x, y, r = rng.uniform(-3, 3), rng.uniform(-3, 3), rng.uniform(0.1, 2)
    ring = lambda s: [(y + s * r * math.sin(2 * math.pi * i / n) * (1 + i % 2), x + s * r * math.cos(2 * math.pi * i / n) * (1 + i % 2)) for i in range(n)]
    return [[ring(1.0), ring(0.4)]] if rng.random() < 0.3 else [[ring(1.0)]]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    name = lambda i, c: None if i % 7 == 0 else f"{c}{i}"
    countries, states = ([(i, name(i, c), shape(rng, 9)) for i in range(n)] for c, n in (("c", 8), ("s", 25)))
    points = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(400)] + [(400, None, None), (401, 0.0, None), (402, 89.0, 179.0)]
    return spark.createDataFrame(countries, NAMES.format("country")), spark.createDataFrame(states, NAMES.format("state")), spark.createDataFrame(points, "id long, lat double, lon double")


def answers(df):
    return sorted((r["id"], r["country"], r["state"]) for r in df.collect())


def test_one_index_for_both(spark, data):
    countries, states, points = data
    want = answers(first_match(first_match(points, countries, ["country"]), states, ["state"]))
    assert answers(enrich.with_admin(points, countries, states)) == want
    assert sum(c is not None for _, c, _ in want) > 50 and sum(s is not None for _, _, s in want) > 50
    for size in (0.2, 3.0):
        assert answers(enrich.with_admin(points, enrich.admin_cells(countries, states, size))) == want
    assert answers(enrich.with_admin(points, countries.limit(0), states.limit(0))) == [(i, None, None) for i, _, _ in want]


def test_stored_by_cell(spark, data):
    countries, states, points = data
    want = answers(enrich.with_admin(points, countries, states))
    made = cells.kept(enrich.admin_cells(countries, states, 0.7), "cells_test", 4)
    again = cells.found(spark, "cells_test")
    assert (again.take, again.size) == (made.take, made.size) == (("country", "state"), 0.7)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = enrich.with_admin(points, again)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # the points' own
        assert "Generate" not in plan  # nothing is cut again
        assert answers(out) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    cells.kept(enrich.admin_cells(countries.limit(0), states.limit(0)), "cells_test", 4)
    assert {(c, s) for _, c, s in answers(enrich.with_admin(points, cells.found(spark, "cells_test")))} == {(None, None)}
    spark.sql("DROP TABLE cells_test")
    spark.sql("CREATE TABLE no_cells (a int) USING parquet")
    with pytest.raises(ValueError):
        cells.found(spark, "no_cells")
    spark.sql("DROP TABLE no_cells")


def test_a_run_cuts_once(spark, data, monkeypatch):
    made = []
    monkeypatch.setattr(enrich, "admin_cells", lambda *a, real=enrich.admin_cells: made.append(1) or real(*a))
    index = jobs.boundaries_once(*data[:2])
    assert jobs.boundaries_once(index) is index and made == [1]
    assert "Generate" not in enrich.with_admin(data[2], index)._jdf.queryExecution().executedPlan().toString()
