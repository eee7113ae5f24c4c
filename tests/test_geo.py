import numpy as np
import pytest
from pyspark.sql import functions as F

from tramaspark.operators import geo


@pytest.mark.parametrize(
    "typed, want",
    [
        ("-34,5", -34.5), ("-34.5°", -34.5), (" -34.5 ", -34.5), ("34.5 S", -34.5), ("O 58.4", -58.4), ("48°20'00.75\"S", -(48 + 20 / 60 + 0.75 / 3600)), ("59°24'21\"O", -(59 + 24 / 60 + 21 / 3600)),
        ("34 36 12 S", -(34 + 36 / 60 + 12 / 3600)), ("-346.486E-1", -34.6486), ("-4,5E+15", -4.5e15), ("34°75'00\"S", None), ("#N/D", None), ("s/d", None), ("", None), (None, None), ("12.5 Norte", 12.5),
    ],
)
def test_degrees(spark, typed, want):
    got = spark.createDataFrame([(typed,)], "t string").select(geo.degrees(F.col("t"))).collect()[0][0]
    assert got == want or got == pytest.approx(want)


def test_near_pairs_are_complete(spark):
    r = np.random.default_rng(3)
    lat = np.concatenate([r.uniform(-35, -34.9, 300), np.full(90, -34.95), r.uniform(-35, -34.9, 3)])
    lon = np.concatenate([r.uniform(179.95, 180.0, 150), r.uniform(-180.0, -179.95, 150), np.full(90, 10.0), r.uniform(-58.1, -58, 3)])
    keys = [f"k{i:04}" for i in range(len(lat))]
    df = spark.createDataFrame(list(zip(keys, lat.tolist(), lon.tolist(), strict=True)), "key string, lat double, lon double")
    got = {(x.key_a, x.key_b) for x in geo.near_pairs(df, 500.0, per_cell=20, block=25).collect()}
    a, b = np.radians(lat), np.radians(lon)
    want = set()
    for i in range(len(keys)):
        d = geo._great_circle(a[i], b[i], a[i + 1 :], b[i + 1 :])
        want |= {(keys[i], keys[i + 1 + j]) for j in np.nonzero(d <= 500)[0]}
    assert got == want and len(got) > 4000


def test_no_points(spark):
    empty = spark.createDataFrame([], "key string, lat double, lon double")
    assert geo.near_pairs(empty, 10).count() == 0
    odd = spark.createDataFrame([("a", None, 1.0), ("b", 0.0, 0.0), ("c", 91.0, 0.0), ("d", float("nan"), 1.0), (None, 1.0, 1.0), ("e", 1.0, -180.0)], "key string, lat double, lon double")
    assert [x.key for x in geo.located(odd, F.col("key"), F.col("lat"), F.col("lon")).collect()] == ["e"]


def test_inside_with_hole(spark):
    areas = spark.createDataFrame(
        [("h", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"), ("m", "MULTIPOLYGON (((20 0, 21 0, 21 1, 20 0)), ((30 0, 31 0, 31 1, 30 0)))"), ("x", None), ("y", "nonsense")], "a string, w string"
    )
    points = spark.createDataFrame([("in", 1.0, 1.0), ("hole", 5.0, 5.0), ("m", 0.2, 30.9), ("out", 50.0, 50.0)], "key string, lat double, lon double")
    got = geo.inside(points, geo.regions(areas, F.col("a"), F.col("w"))).collect()
    assert sorted(map(tuple, got)) == [("in", "h"), ("m", "m")]


def test_many_regions_are_joined_by_salted_tiles(spark, monkeypatch):
    areas = spark.createDataFrame([("h", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), ("i", "POLYGON ((5 5, 6 5, 6 6, 5 6, 5 5))")], "a string, w string")
    points = spark.createDataFrame([(f"p{k}", 0.5 + k % 2, 0.5) for k in range(200)] + [("q", 5.5, 5.5), ("r", 3.0, 3.0)], "key string, lat double, lon double")
    got = lambda: sorted(map(tuple, geo.inside(points, geo.regions(areas, F.col("a"), F.col("w"))).collect()))
    whole = got()
    monkeypatch.setattr(geo, "FEW_EDGES", 0)
    assert got() == whole and len(whole) == 201


def test_pivots_in_two_levels_are_exact():
    r = np.random.default_rng(5)
    unit = geo._unit(np.radians(r.uniform(-40, -30, 3000)), np.radians(r.uniform(-70, -55, 3000)))
    points = geo._unit(np.radians(r.uniform(-40, -30, 500)), np.radians(r.uniform(-70, -55, 500)))
    i, j, nearest = geo.Pivots(unit).near(points, 1002.0)
    d = geo._angle(points, unit)
    assert {*zip(i.tolist(), j.tolist(), strict=True)} == {*zip(*(x.tolist() for x in np.nonzero(d <= d.min(axis=1)[:, None] + 1002.0)), strict=True)}
    assert j[nearest].tolist() == d.argmin(axis=1).tolist() and i[nearest].tolist() == list(range(500))


def test_a_crowded_spot_is_copied_once_a_block(spark):
    n, block = 400, 50
    df = spark.createDataFrame([(f"k{i:04}", -34.5, -58.5) for i in range(n)] + [("far", 10.0, 10.0)], "key string, lat double, lon double")
    pairs = geo.near_pairs(df, 500.0, per_cell=20, block=block)
    assert pairs.count() == n * (n - 1) // 2 == pairs.distinct().count()
