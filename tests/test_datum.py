"""The datum shift: published figures of its parts, there and back, and points of both datums."""

import numpy as np
from pyspark.sql import functions as F

from cumload.functions import datum
from cumload.operators import shapes


def grid(low, high, step):
    return (v.ravel().astype(float) for v in np.meshgrid(np.arange(low, high, step), np.arange(3_950_000, 4_320_001, 37_000)))


def test_published_figures():
    # the arc of the meridian to 45 degrees, and a quarter of a meridian, of the new ellipsoid
    lon, lat = np.radians([-3.0, -3.0]), np.radians([45.0, 89.9999999])
    low, high = datum.to_metres(lon, lat, 30, "ETRS89")[1] / 0.9996
    assert abs(low - 4_984_944.378) < 0.01 and abs(high - 10_001_965.729) < 0.03
    # the worked example of the position vector method, from WGS 72 to WGS 84
    out = datum.turned(np.array([[3657660.66], [255768.55], [5201382.11]]), (0, 0, 4.5, 0, 0, 0.554, 0.219))
    assert (np.abs(out[:, 0] - [3657660.78, 255778.43, 5201387.75]) < 0.01).all()


def test_there_and_back():
    for zone in (29, 30):
        x, y = grid(160_000, 840_000, 40_000)
        there = datum.moved(x, y, zone)
        back = datum.moved(*there, zone, to="ED50")
        assert max(np.abs(back[0] - x).max(), np.abs(back[1] - y).max()) < 3e-3  # heights are dropped on the way
    region = (x >= 200_000) & (x <= 640_000)  # about 110 m east and 207 m north
    assert np.abs(x - there[0] - 110)[region].max() < 6 and np.abs(y - there[1] - 207)[region].max() < 6


def test_one_place_in_two_zones():
    x, y = grid(180_000, 640_000, 46_000)
    own = datum.moved(x, y, 30)
    other = datum.moved(*datum.to_metres(*datum.to_degrees(x, y, 30, "ED50"), 29, "ED50"), 29)
    again = datum.to_metres(*datum.to_degrees(*other, 29, "ETRS89"), 30, "ETRS89")
    assert max(np.abs(a - b).max() for a, b in zip(own, again, strict=True)) < 1e-3


def test_points_of_both_datums(spark):
    rows = [(1, 300_000.0, 4_100_000.0, "ETRS89"), (2, 300_110.0, 4_100_207.0, "ED50"), (3, None, 4_100_000.0, "ED50"), (4, 300_000.0, 4_100_000.0, None)]
    df = spark.createDataFrame([(*r, 30) for r in rows], "id int, x double, y double, datum string, zone int")
    out = {r.id: r.p for r in df.select("id", datum.to_etrs89(*map(F.col, ("x", "y", "zone", "datum"))).alias("p")).collect()}
    assert tuple(out[1]) == tuple(out[4]) == (300_000.0, 4_100_000.0) and out[3].x is None
    assert abs(out[2].x - 300_000) < 6 and abs(out[2].y - 4_100_000) < 6
    boxes = spark.createDataFrame([(1, -6.0, 36.0, -4.0, 38.0)], "group int, xmin double, ymin double, xmax double, ymax double")
    placed = shapes.placed_points(df.where("x IS NOT NULL").select(F.lit(1).alias("group"), "x", "y", F.lit(None).cast("int").alias("zone"), "datum"), boxes).collect()
    assert {r.zone for r in placed} == {30} and max(r.lon for r in placed) - min(r.lon for r in placed) < 1e-4
