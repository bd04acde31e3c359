"""Transverse Mercator and datum shifts as column expressions (Krueger series)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRS80 = (6378137.0, 1 / 298.257222101)
BESSEL = (6377397.155, 1 / 299.1528128)

# Fixed values, public definitions: shift from RT 90 in metres and arc seconds.
RT90_SHIFT = (414.1, 41.3, 603.1, -0.855, 2.141, -7.023, 0.0)
NO_SHIFT = (0.0,) * 7


def _zone(ellipsoid, lon0, scale, east, shift=NO_SHIFT):
    return {"ellipsoid": ellipsoid, "lon0": lon0, "scale": scale, "east": east, "shift": shift}


def _dms(d, m, s):
    return d + m / 60 + s / 3600


# Fixed values, public definitions: SWEREF 99 TM and its local zones, RT 90, RT 38.
SYSTEMS: dict[int, dict] = {
    3006: _zone(GRS80, 15.0, 0.9996, 500000.0),
    3007: _zone(GRS80, 12.0, 1.0, 150000.0),
    3008: _zone(GRS80, 13.5, 1.0, 150000.0),
    3009: _zone(GRS80, 15.0, 1.0, 150000.0),
    3010: _zone(GRS80, 16.5, 1.0, 150000.0),
    3011: _zone(GRS80, 18.0, 1.0, 150000.0),
    3012: _zone(GRS80, 14.25, 1.0, 150000.0),
    3013: _zone(GRS80, 15.75, 1.0, 150000.0),
    3014: _zone(GRS80, 17.25, 1.0, 150000.0),
    3015: _zone(GRS80, 18.75, 1.0, 150000.0),
    3016: _zone(GRS80, 20.25, 1.0, 150000.0),
    3017: _zone(GRS80, 21.75, 1.0, 150000.0),
    3018: _zone(GRS80, 23.25, 1.0, 150000.0),
    3019: _zone(BESSEL, _dms(11, 18, 29.8), 1.0, 1500000.0, RT90_SHIFT),
    3020: _zone(BESSEL, _dms(13, 33, 29.8), 1.0, 1500000.0, RT90_SHIFT),
    3021: _zone(BESSEL, _dms(15, 48, 29.8), 1.0, 1500000.0, RT90_SHIFT),
    3022: _zone(BESSEL, _dms(18, 3, 29.8), 1.0, 1500000.0, RT90_SHIFT),
    3023: _zone(BESSEL, _dms(20, 18, 29.8), 1.0, 1500000.0, RT90_SHIFT),
    3024: _zone(BESSEL, _dms(22, 33, 29.8), 1.0, 1500000.0, RT90_SHIFT),
    3025: _zone(BESSEL, _dms(11, 18, 29.8), 1.0, 1500000.0),
    3026: _zone(BESSEL, _dms(13, 33, 29.8), 1.0, 1500000.0),
    3027: _zone(BESSEL, _dms(15, 48, 29.8), 1.0, 1500000.0),
    4124: _zone(BESSEL, None, 1.0, 0.0, RT90_SHIFT),  # degrees
    4326: _zone(GRS80, None, 1.0, 0.0),  # degrees
    4619: _zone(GRS80, None, 1.0, 0.0),  # degrees
}


def _series(flattening: float):
    """Coefficients in the third flattening, to the fourth power."""
    n = flattening / (2 - flattening)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
             13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
             61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
             7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
             56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]
    rectifying = (1 + n**2 / 4 + n**4 / 64) / (1 + n)
    return alpha, beta, delta, rectifying


def constants(srid: int) -> dict[str, float | bool]:
    """Everything the formulas need about one system, as plain numbers."""
    system = SYSTEMS[srid]
    a, f = system["ellipsoid"]
    alpha, beta, delta, rectifying = _series(f)
    tx, ty, tz, rx, ry, rz, ppm = system["shift"]
    out = {
        "srid": srid, "degrees": system["lon0"] is None, "shifted": system["shift"] != NO_SHIFT,
        "lon0": math.radians(system["lon0"] or 0.0), "east": system["east"],
        "unit": system["scale"] * a * rectifying, "a": a, "e2": f * (2 - f),
        "tx": tx, "ty": ty, "tz": tz, "rx": math.radians(rx / 3600),
        "ry": math.radians(ry / 3600), "rz": math.radians(rz / 3600), "m": 1 + ppm * 1e-6,
    }
    for name, series in (("alpha", alpha), ("beta", beta), ("delta", delta)):
        out.update({f"{name}{j}": c for j, c in enumerate(series, 1)})
    return out


def systems_table(spark: SparkSession) -> DataFrame:
    """The known systems, one row each (about two dozen)."""
    rows = [constants(srid) for srid in SYSTEMS]
    return spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))


def _series_sum(p, name, first, second):
    """Sum of coefficient * first(2j) * second(2j)."""
    total = F.lit(0.0)
    for j in range(1, 5):
        total = total + p(f"{name}{j}") * first(2 * j) * second(2 * j)
    return total


def _point(**fields):
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def transform_points(points: Column, source, target) -> Column:
    """An array of points x, y, z in one system, moved to another.

    ``source`` and ``target`` look a constant up by name; they give numbers or columns.
    Every step is one pass over the array, so no term is computed twice.
    """
    s, d = source, target

    def known(value):
        return value if isinstance(value, Column) else F.lit(value)

    degrees_in, degrees_out = known(s("degrees")), known(d("degrees"))
    points = F.transform(points, lambda q: _point(
        xi=q["y"] / s("unit"), eta=(q["x"] - s("east")) / s("unit"),
        lon=F.radians(q["x"]), lat=F.radians(q["y"]), z=q["z"]))
    points = F.transform(points, lambda q: _point(
        xi=q["xi"] - _series_sum(s, "beta", lambda j: F.sin(j * q["xi"]),
                                 lambda j: F.cosh(j * q["eta"])),
        eta=q["eta"] - _series_sum(s, "beta", lambda j: F.cos(j * q["xi"]),
                                   lambda j: F.sinh(j * q["eta"])),
        lon=q["lon"], lat=q["lat"], z=q["z"]))
    points = F.transform(points, lambda q: _point(
        chi=F.asin(F.sin(q["xi"]) / F.cosh(q["eta"])),
        lon=F.when(degrees_in, q["lon"]).otherwise(
            s("lon0") + F.atan2(F.sinh(q["eta"]), F.cos(q["xi"]))),
        lat=q["lat"], z=q["z"]))
    points = F.transform(points, lambda q: _point(
        lat=F.when(degrees_in, q["lat"]).otherwise(q["chi"] + _series_sum(
            s, "delta", lambda j: F.sin(j * q["chi"]), lambda j: F.lit(1.0))),
        lon=q["lon"], z=q["z"]))
    moved = _shift_points(points, s, d)
    points = F.when(known(s("shifted")) == known(d("shifted")), points).otherwise(moved)
    e = F.sqrt(known(d("e2")))
    points = F.transform(points, lambda q: _point(
        t=F.sinh(F.atanh(F.sin(q["lat"])) - e * F.atanh(e * F.sin(q["lat"]))),
        away=q["lon"] - d("lon0"), lat=q["lat"], lon=q["lon"], z=q["z"]))
    points = F.transform(points, lambda q: _point(
        xi=F.atan2(q["t"], F.cos(q["away"])),
        eta=F.atanh(F.sin(q["away"]) / F.sqrt(1 + q["t"] * q["t"])),
        lat=q["lat"], lon=q["lon"], z=q["z"]))
    return F.transform(points, lambda q: _point(
        x=F.when(degrees_out, F.degrees(q["lon"])).otherwise(d("east") + d("unit") * (
            q["eta"] + _series_sum(d, "alpha", lambda j: F.cos(j * q["xi"]),
                                   lambda j: F.sinh(j * q["eta"])))),
        y=F.when(degrees_out, F.degrees(q["lat"])).otherwise(d("unit") * (
            q["xi"] + _series_sum(d, "alpha", lambda j: F.sin(j * q["xi"]),
                                  lambda j: F.cosh(j * q["eta"])))),
        z=q["z"]))


def _shift_points(points: Column, s, d) -> Column:
    """Seven-parameter shift between ellipsoids, by way of geocentric coordinates."""
    points = F.transform(points, lambda q: _point(
        r=s("a") / F.sqrt(1 - s("e2") * F.sin(q["lat"]) * F.sin(q["lat"])),
        lat=q["lat"], lon=q["lon"], z=q["z"]))
    points = F.transform(points, lambda q: _point(
        u=q["r"] * F.cos(q["lat"]) * F.cos(q["lon"]),
        v=q["r"] * F.cos(q["lat"]) * F.sin(q["lon"]),
        w=q["r"] * (1 - s("e2")) * F.sin(q["lat"]), z=q["z"]))
    points = F.transform(points, lambda q: _point(
        u=s("tx") + s("m") * (q["u"] - s("rz") * q["v"] + s("ry") * q["w"]),
        v=s("ty") + s("m") * (s("rz") * q["u"] + q["v"] - s("rx") * q["w"]),
        w=s("tz") + s("m") * (-1 * s("ry") * q["u"] + s("rx") * q["v"] + q["w"]), z=q["z"]))
    points = F.transform(points, lambda q: _point(
        u=(q["u"] - d("tx")) / d("m"), v=(q["v"] - d("ty")) / d("m"),
        w=(q["w"] - d("tz")) / d("m"), z=q["z"]))
    # the exact inverse of the small rotation
    points = F.transform(points, lambda q: _point(
        u=q["u"], v=q["v"], w=q["w"], z=q["z"],
        along=d("rx") * q["u"] + d("ry") * q["v"] + d("rz") * q["w"]))
    size = 1 + d("rx") * d("rx") + d("ry") * d("ry") + d("rz") * d("rz")
    points = F.transform(points, lambda q: _point(
        u=(q["u"] + d("rz") * q["v"] - d("ry") * q["w"] + d("rx") * q["along"]) / size,
        v=(q["v"] - d("rz") * q["u"] + d("rx") * q["w"] + d("ry") * q["along"]) / size,
        w=(q["w"] + d("ry") * q["u"] - d("rx") * q["v"] + d("rz") * q["along"]) / size,
        z=q["z"]))
    flat = 1 - F.sqrt(1 - (d("e2") if isinstance(d("e2"), Column) else F.lit(d("e2"))))
    b = d("a") * (1 - flat)
    points = F.transform(points, lambda q: _point(
        p=F.hypot(q["u"], q["v"]), lon=F.atan2(q["v"], q["u"]), w=q["w"],
        theta=F.atan2(q["w"] * d("a"), F.hypot(q["u"], q["v"]) * b), z=q["z"]))
    return F.transform(points, lambda q: _point(
        lat=F.atan2(q["w"] + d("e2") / (1 - d("e2")) * b * F.pow(F.sin(q["theta"]), F.lit(3.0)),
                    q["p"] - d("e2") * d("a") * F.pow(F.cos(q["theta"]), F.lit(3.0))),
        lon=q["lon"], z=q["z"]))


def fixed(srid: int):
    """Constants of one system, as numbers."""
    return constants(srid).__getitem__


def by_column(params: Column):
    """Constants taken from a row of `systems_table`."""
    return lambda name: params[name]
