from tripflow.operators.region import region_of, tag_points
from tripflow.sources.regions import regions_from_geojson, regions_from_records, regions_from_rows

SQUARE_WITH_HOLE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]
SECOND_PART = [[[10, 10], [12, 10], [11, 12], [10, 10]]]
REGIONS = [("A", [SQUARE_WITH_HOLE, SECOND_PART]), ("B", [[[[3, 3], [6, 3], [6, 6], [3, 6], [3, 3]]]])]

POINTS = {
    "interior": (0.5, 3.0), "exterior": (5.0, -1.0), "vertex": (4.0, 0.0), "edge": (0.0, 2.5),
    "hole": (1.5, 1.5), "hole_edge": (1.0, 1.5), "part2": (11.0, 11.0), "overlap": (3.5, 3.5), "b_only": (5.0, 5.0),
}


def tags(spark, boundary):
    regions = regions_from_rows(spark, REGIONS)
    pts = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in POINTS.items()], "k string, x double, y double")
    out = region_of(pts, "x", "y", regions, "region", boundary=boundary, default=None, band=0.5)
    return {r["k"]: r["region"] for r in out.collect()}


def test_strict_interior(spark):
    got = tags(spark, False)
    assert got == {"interior": "A", "exterior": None, "vertex": None, "edge": None, "hole": None, "hole_edge": None,
                   "part2": "A", "overlap": "A", "b_only": "B"}


def test_boundary_counts_inside(spark):
    got = tags(spark, True)
    assert got["vertex"] == "A" and got["edge"] == "A" and got["hole_edge"] == "A" and got["hole"] is None


def test_band_size_does_not_change_result(spark):
    regions = regions_from_rows(spark, REGIONS)
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in POINTS.values()], "x double, y double")
    a = sorted(tuple(r) for r in tag_points(pts, regions, band=0.01).collect())
    b = sorted(tuple(r) for r in tag_points(pts, regions, band=7.0).collect())
    assert a == b


def test_region_documents(spark, tmp_dir):
    import json
    p1 = f"{tmp_dir}/fc.json"
    with open(p1, "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"name": "Los Angeles"},
             "geometry": {"type": "MultiPolygon", "coordinates": [SQUARE_WITH_HOLE]}},
            {"type": "Feature", "properties": {"name": "Orange"},
             "geometry": {"type": "Polygon", "coordinates": SECOND_PART}}]}, f)
    r = regions_from_geojson(spark, p1, names=["Los Angeles"]).collect()
    assert [x["name"] for x in r] == ["Los Angeles"] and len(r[0]["coordinates"][0]) == 2
    r = regions_from_geojson(spark, p1).collect()
    assert len(r) == 2
    p2 = f"{tmp_dir}/records.json"
    with open(p2, "w") as f:
        json.dump({"records": [{"fields": {"geo_shape": {"type": "MultiPolygon", "coordinates": [SECOND_PART]}}}]}, f)
    r = regions_from_records(spark, p2, default_name="LA", first_only=True).collect()
    assert r[0]["name"] == "LA" and r[0]["coordinates"][0][0][2] == [11.0, 12.0]
