import math

from pyspark.sql import functions as F

from tripflow.functions import geo

NEWPORT = (41.49008, -71.312796)
CLEVELAND = (41.499498, -81.695391)


def test_geodesic_published_value(spark):
    df = spark.createDataFrame([(*NEWPORT, *CLEVELAND)], "a double, b double, c double, d double")
    row = df.select(geo.geodesic("a", "b", "c", "d", "miles").alias("col"),
                    geo.geodesic("a", "b", "c", "d", "m").alias("m")).first()
    assert abs(row["col"] - 538.390445) < 1e-5
    assert abs(row["m"] - 866455.43) < 0.01


def test_geodesic_coincident_and_null(spark):
    df = spark.createDataFrame([(34.0, -118.0, 34.0, -118.0), (None, -118.0, 34.0, -118.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.geodesic("a", "b", "c", "d")).collect()]
    assert got == [0.0, None]


def test_geodesic_has_a_value_for_every_pair(spark):
    """Near-antipodal pairs, whose published distances are given where there are some."""
    import numpy as np
    rows = [(0, 0, 0.5, 179.4, 19931041.777), (0, 0, 0, 180, 20003931.4586), (0, 0, 0.5, 179.5, 19936288.579),
            (0, 0, 0.5, 179.7, 19944127.421), (90, 0, -90, 77, 20003931.4586), (-30, 0, 30, 180, 20003931.4586)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double, d double, want double")
    for r in df.withColumn("g", geo.geodesic("a", "b", "c", "d")).collect():
        assert abs(r["g"] - r["want"]) < 0.001
    one = geo.with_geodesic(df, "a", "b", "c", "d", "g").collect()
    assert all(abs(r["g"] - r["want"]) < 0.001 for r in one)
    # Both ways of solving agree wherever both do, and all are symmetric.
    rng = np.random.default_rng(1)
    la1, la2, lo2 = rng.uniform(-90, 90, 500), rng.uniform(-90, 90, 500), rng.uniform(-180, 180, 500)
    d = geo.geodesic_np(la1, np.zeros(500), la2, lo2)
    u = [np.arctan((1 - geo.WGS84_F) * np.tan(np.radians(x))) for x in (la1, la2)]
    assert np.abs(d - geo._bisected(geo.WGS84_A, geo.WGS84_B, geo.WGS84_F, *u, np.abs(np.radians(lo2)))).max() < 1e-3
    la2 = np.clip(-la1 + rng.normal(0, 0.3, 500), -90, 90)
    lo2 = 180 + rng.normal(0, 0.5, 500)
    d = geo.geodesic_np(la1, np.zeros(500), la2, lo2)
    assert not np.isnan(d).any() and np.abs(d - geo.geodesic_np(la2, lo2, la1, np.zeros(500))).max() < 1e-3


def test_with_geodesic_pairs(spark):
    df = spark.createDataFrame([(1, *NEWPORT, *CLEVELAND), (2, *NEWPORT, *CLEVELAND), (3, None, 1.0, 2.0, 3.0)],
                               "id int, a double, b double, c double, d double")
    got = {r["id"]: r["g"] for r in geo.with_geodesic(df, "a", "b", "c", "d", "g", "miles").collect()}
    assert abs(got[1] - 538.390445) < 1e-5 and got[1] == got[2] and got[3] is None


def test_haversine(spark):
    lat1, lon1, lat2, lon2 = 30.28708, 120.12803, 28.7427, 115.86572
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    expect = round(2 * math.asin(math.sqrt(a)) * 6371, 3)
    df = spark.createDataFrame([(lat1, lon1, lat2, lon2)], "a double, b double, c double, d double")
    assert df.select(geo.haversine_km("a", "b", "c", "d")).first()[0] == expect


def test_null_safe(spark):
    df = spark.createDataFrame([(None, 1.0), (0.0, 1.0)], "a double, b double")
    got = [tuple(r) for r in df.select(geo.null_safe(F.lit(5.0), "a", "b"),
                                         geo.null_safe(F.lit(5.0), "a", "b", zero_is_missing=True)).collect()]
    assert got == [(0.0, 0.0), (5.0, 0.0)]


def test_haversine_of_opposite_points_and_nulls(spark):
    """Half the circumference, also where the root of the sum rounds above 1; NULL for a missing coordinate."""
    df = spark.createDataFrame([(a / 7, b / 3, -a / 7, b / 3 + 180) for a in range(0, 600, 7) for b in (0, 1, 50)] + [(None, 0.0, 1.0, 1.0)],
                               "a double, b double, c double, d double")
    got = [r["km"] for r in df.select(geo.haversine_km("a", "b", "c", "d").alias("km")).collect()]
    assert got.pop() is None
    assert all(abs(km - 20015.087) < 0.001 for km in got)
