"""Every input row is good or rejected, with its reason, and the good ones are what the plain reader gives."""

import json

import pytest

from pistespark.schema import ANALYZED_COLUMNS
from pistespark.sources import readers, rejects

POINT = {"type": "Point", "coordinates": [1, 2]}
FEATURES = [
    ({"type": "Feature", "ordinal": 7, "properties": {"name": "a"}, "geometry": POINT}, None),
    ({"type": "Feature", "properties": None, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}, None),
    ({"type": "Thing", "geometry": POINT}, "kind"),
    ({"geometry": POINT}, "kind"),
    ({"type": "Feature", "geometry": None}, "no geometry"),
    ({"type": "Feature", "geometry": {"type": "Circle", "coordinates": [1, 2]}}, "kind"),
    ({"type": "Feature", "geometry": {"type": "LineString", "coordinates": []}}, "empty geometry"),
    ({"type": "Feature", "geometry": {"type": "Point", "coordinates": "x"}}, "empty geometry"),
    ({}, "kind"),
]
BROKEN = ['{"type": "Feature", "geometry"', "no json", "[1, 2]", "null"]


def found(df):
    return sorted((r["kind"], len(r["geometry"]), dict(r["props"])) for r in df.collect()).__repr__()


@pytest.mark.parametrize("lines", [True, False])
def test_features(spark, tmp_path, lines):
    path, want = tmp_path / "f", sorted(r for _, r in FEATURES if r)
    path.mkdir()
    if lines:
        (path / "a.json").write_text("\n".join([json.dumps(f) for f, _ in FEATURES[:4]] + ["", "  ", *BROKEN]))
        (path / "b.json").write_text("\n".join(json.dumps(f) for f, _ in FEATURES[4:]))
        want = sorted([*want, *["broken"] * len(BROKEN)])
    else:
        (path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": [f for f, _ in FEATURES]}))
    good, bad = rejects.routed(rejects.features(spark, str(path), lines), str(tmp_path / "out"))
    rows = bad.collect()
    assert sorted(r["reason"] for r in rows) == want and {r["reason"] for r in rows} <= set(rejects.REASONS)
    assert all(r["value"] and r["file"].endswith(".json") for r in rows)
    assert found(good) == found(readers.geojson(spark, str(path), lines)) and good.count() == 2
    if lines:
        assert sorted(r["value"] for r in rows if r["reason"] == "broken") == sorted(BROKEN)
        assert {r["ordinal"] for r in good.collect()} == {7, None}
    else:
        assert sorted(r["ordinal"] for r in rows) == list(range(2, len(FEATURES)))
    assert sum(r["rows"] for r in rejects.summary(bad).collect()) == len(rows)


def test_elements(spark, tmp_path):
    rows = [{"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"a": "b"}}, {"type": "way", "id": 2, "nodes": [1]}, {"type": "way", "id": 3}, {"type": "node", "lat": 1.0, "lon": 2.0}, {"type": "changeset", "id": 4}, {"type": "node", "id": "x", "lat": 1.0, "lon": 2.0}]
    (tmp_path / "e.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n{")
    good, bad = rejects.routed(rejects.elements(spark, str(tmp_path / "e.json"), True), str(tmp_path / "out"))
    assert sorted((r["osm_type"], r["osm_id"], r["tags"]) for r in good.collect()) == [("node", 1, {"a": "b"}), ("way", 2, {})]
    assert sorted(r["reason"] for r in bad.collect()) == ["broken", "broken", "id", "kind", "no geometry"]


def test_analyzed(spark, tmp_path):
    n = len(ANALYZED_COLUMNS)
    row = lambda i: ",".join([i, *[""] * (n - 1)])
    bad_number = ["3"] + [""] * (n - 1)
    bad_number[ANALYZED_COLUMNS.index("total_lifts")] = "many"
    (tmp_path / "t.csv").write_text("\n".join([",".join(ANALYZED_COLUMNS), row("1"), row(""), ",".join(bad_number), "4,way"]))
    good, bad = rejects.routed(rejects.analyzed(spark, str(tmp_path / "t.csv")), str(tmp_path / "out"))
    assert [r["winter_sports_id"] for r in good.collect()] == [1]
    got = sorted((r["reason"], r["value"]) for r in bad.collect())
    assert [g[0] for g in got] == ["broken", "broken", "id"] and {g[1] for g in got[:2]} == {",".join(bad_number), "4,way"}


def test_no_rows(spark, tmp_path):
    (tmp_path / "n.json").write_text("")
    for tagged in (rejects.features(spark, str(tmp_path / "n.json"), True), rejects.elements(spark, str(tmp_path / "n.json"), True)):
        good, bad = rejects.routed(tagged, str(tmp_path / "none"))
        assert good.count() == bad.count() == 0 and bad.columns == [*rejects.PLACE, "reason"]
