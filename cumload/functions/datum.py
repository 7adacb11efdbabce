"""From the old datum to the new one: UTM metres through geocentric coordinates and seven parameters (T34). Arrow-batched: as columns the steps are used so often that Catalyst, which puts them into the filters above, runs out of memory."""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

# Fixed values: (semi-major axis, flattening) of the datums' ellipsoids, and the published seven parameters from ED50 to
# ETRS89 of the mainland but for its north-west: metres, seconds of arc (position vector), parts per million.
ELLIPSOIDS = {"ED50": (6378388.0, 1 / 297), "ETRS89": (6378137.0, 1 / 298.257222101)}
ED50_TO_ETRS89 = (-131.0, -100.3, -163.4, -1.244, -0.020, -1.144, 9.39)
SCALE, FALSE_EAST = 0.9996, 500_000.0
POINT = StructType().add("x", DoubleType()).add("y", DoubleType())


def series(f: float) -> dict[str, tuple[float, ...] | float]:
    """The transverse Mercator's series in the third flattening, to its fourth power: relative radius, forth, back, and from conformal latitude."""
    n = f / (2 - f)
    return {
        "radius": (1 + n**2 / 4 + n**4 / 64) / (1 + n),
        "forth": (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280),
        "back": (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280),
        "latitude": (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630),
    }


def _sum(terms: tuple[float, ...], u, v, f, g):
    return sum(t * f(2 * j * u) * g(2 * j * v) for j, t in enumerate(terms, 1))


def to_degrees(x, y, zone, datum: str) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude (radians) of northern UTM metres on a datum's own ellipsoid."""
    a, f = ELLIPSOIDS[datum]
    s = series(f)
    xi, eta = y / (SCALE * a * s["radius"]), (x - FALSE_EAST) / (SCALE * a * s["radius"])
    u, v = xi - _sum(s["back"], xi, eta, np.sin, np.cosh), eta - _sum(s["back"], xi, eta, np.cos, np.sinh)
    chi = np.arcsin(np.sin(u) / np.cosh(v))
    lat = chi + sum(t * np.sin(2 * j * chi) for j, t in enumerate(s["latitude"], 1))
    return np.radians(zone * 6.0 - 183.0) + np.arctan2(np.sinh(v), np.cos(u)), lat


def to_metres(lon, lat, zone, datum: str) -> tuple[np.ndarray, np.ndarray]:
    """UTM metres of a zone."""
    a, f = ELLIPSOIDS[datum]
    s, e, turn = series(f), sqrt(f * (2 - f)), lon - np.radians(zone * 6.0 - 183.0)
    t = np.sinh(np.arctanh(np.sin(lat)) - e * np.arctanh(e * np.sin(lat)))
    u, v, r = np.arctan2(t, np.cos(turn)), np.arctanh(np.sin(turn) / np.sqrt(1 + t * t)), SCALE * a * s["radius"]
    return FALSE_EAST + r * (v + _sum(s["forth"], u, v, np.cos, np.sinh)), r * (u + _sum(s["forth"], u, v, np.sin, np.cosh))


def to_geocentric(lon, lat, datum: str) -> np.ndarray:
    """(3, n) metres of points on the ellipsoid."""
    a, f = ELLIPSOIDS[datum]
    e2 = f * (2 - f)
    n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return np.stack([n * np.cos(lat) * np.cos(lon), n * np.cos(lat) * np.sin(lon), n * (1 - e2) * np.sin(lat)])


def from_geocentric(xyz: np.ndarray, datum: str) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude (radians); what lies above the ellipsoid is dropped."""
    a, f = ELLIPSOIDS[datum]
    e2, b = f * (2 - f), a * (1 - f)
    x, y, z = xyz
    p = np.hypot(x, y)
    theta = np.arctan2(z * a, p * b)
    return np.arctan2(y, x), np.arctan2(z + e2 / (1 - e2) * b * np.sin(theta) ** 3, p - e2 * a * np.cos(theta) ** 3)


def turned(xyz: np.ndarray, parameters: tuple[float, ...], back: bool = False) -> np.ndarray:
    """Shifted, turned and scaled by seven parameters; ``back`` is the exact inverse."""
    t = np.array(parameters[:3])[:, None]
    rx, ry, rz = np.radians(np.array(parameters[3:6]) / 3600)
    m = (1 + parameters[6] / 1e6) * np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])
    return np.linalg.solve(m, xyz - t) if back else t + m @ xyz


def moved(x, y, zone, to: str = "ETRS89") -> tuple[np.ndarray, np.ndarray]:
    """UTM metres of the other datum as those of ``to``, in the same zone."""
    old = "ED50" if to == "ETRS89" else "ETRS89"
    there = turned(to_geocentric(*to_degrees(x, y, zone, old), old), ED50_TO_ETRS89, back=to == "ED50")
    return to_metres(*from_geocentric(there, to), zone, to)


def shifted(x: Column, y: Column, zone: Column, to: str = "ETRS89") -> Column:
    """struct<x, y>: UTM metres moved from ED50 to ETRS89, or back; the zone stays. A null among the three gives nulls."""

    @F.pandas_udf(POINT)
    def run(x: pd.Series, y: pd.Series, zone: pd.Series) -> pd.DataFrame:
        own = [c.to_numpy(dtype=float, na_value=np.nan) for c in (x, y, zone)]
        out = pd.DataFrame(dict(zip("xy", moved(*own, to), strict=True)))
        return out.astype(object).where(out.notna(), None)

    return run(x.cast("double"), y.cast("double"), zone.cast("double"))


def to_etrs89(x: Column, y: Column, zone: Column, datum: Column) -> Column:
    """struct<x, y>: points that ``datum`` calls ED50 moved to ETRS89; others stay, also those without a datum."""
    return F.when(datum == "ED50", shifted(x, y, zone)).otherwise(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
