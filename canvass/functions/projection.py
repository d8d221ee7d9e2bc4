"""Coordinates between degrees (EPSG:4326) and the metres of a national grid (EPSG:2039), as built-in column expressions.

A transverse Mercator projection by its series in the third flattening (to the fourth power: well under a
millimetre within some degrees of the central meridian), and a seven-parameter shift between the datums by way of
earth-centred coordinates.  Heights count as 0 on either side.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# EPSG:2039 and its shift to EPSG:4326 as published (metres, degrees, seconds of arc, parts per million).
GRID_AXIS, GRID_FLATTENING = 6378137.0, 1 / 298.257222101
WGS_AXIS, WGS_FLATTENING = 6378137.0, 1 / 298.257223563
ORIGIN_LAT, ORIGIN_LON, SCALE = 31.7343936111111, 35.2045169444444, 1.0000067
FALSE_EASTING, FALSE_NORTHING = 219529.584, 626907.39
SHIFT, TURN_SECONDS, PPM = (-24.0024, -17.1032, -17.8444), (-0.33077, -1.85269, 1.66969), 5.4248
# End of fixed values.

_RX, _RY, _RZ = (math.radians(s / 3600) for s in TURN_SECONDS)
TURN = (1 + PPM * 1e-6) * np.array([[1, -_RZ, _RY], [_RZ, 1, -_RX], [-_RY, _RX, 1]])
BACK = np.linalg.inv(TURN)

_N = GRID_FLATTENING / (2 - GRID_FLATTENING)
_E = math.sqrt(GRID_FLATTENING * (2 - GRID_FLATTENING))
#: Radius of the rectifying circle, times the scale of the central meridian.
RADIUS = SCALE * GRID_AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
#: Krueger's series, by multiples 2, 4, 6, 8 of the angle: to the grid and back.
ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)


def _then(df: DataFrame, steps: list[dict[str, str]], keep: list[str]) -> DataFrame:
    """Add columns step by step, each step from the ones before, so that no expression is written out twice."""
    own = df.columns
    for step in steps:
        df = df.withColumns({name: F.expr(text) for name, text in step.items()})
    return df.select(*own, *keep)


def _centred(lat: str, lon: str, axis: float, flattening: float) -> list[dict[str, str]]:
    """Earth-centred _x, _y, _z of a point on the ellipsoid, in radians."""
    e2 = flattening * (2 - flattening)
    return [
        {"_r": f"{axis!r}D / sqrt(1 - {e2!r}D * sin({lat}) * sin({lat}))"},
        {"_x": f"_r * cos({lat}) * cos({lon})", "_y": f"_r * cos({lat}) * sin({lon})", "_z": f"_r * {1 - e2!r}D * sin({lat})"},
    ]


def _on_ellipsoid(axis: float, flattening: float) -> list[dict[str, str]]:
    """_lat and _lon in radians of _x, _y, _z by Bowring's formula, exact to nanometres near the surface."""
    e2, minor = flattening * (2 - flattening), axis * (1 - flattening)
    return [
        {"_p": "sqrt(_x * _x + _y * _y)"},
        {"_t": f"atan(_z * {axis!r}D / (_p * {minor!r}D))"},
        {"_lat": f"atan((_z + {e2 / (1 - e2) * minor!r}D * pow(sin(_t), 3)) / (_p - {e2 * axis!r}D * pow(cos(_t), 3)))", "_lon": "atan2(_y, _x)"},
    ]


def _moved(turn: np.ndarray, before: tuple[float, ...], after: tuple[float, ...]) -> list[dict[str, str]]:
    rows = [" + ".join(f"{float(a)!r}D * ({c} + {b!r}D)" for a, c, b in zip(row, ("_x", "_y", "_z"), before, strict=True)) + f" + {s!r}D" for row, s in zip(turn, after, strict=True)]
    return [dict(zip(("_u", "_v", "_w"), rows, strict=True)), {"_x": "_u", "_y": "_v", "_z": "_w"}]


def _series(terms: tuple[float, ...], sign: int) -> dict[str, str]:
    """_north and _east: the angles _xi and _eta with the series' terms added or taken away."""
    return {
        "_north": "_xi" + "".join(f" + {sign * t!r}D * sin({2 * j} * _xi) * cosh({2 * j} * _eta)" for j, t in enumerate(terms, 1)),
        "_east": "_eta" + "".join(f" + {sign * t!r}D * cos({2 * j} * _xi) * sinh({2 * j} * _eta)" for j, t in enumerate(terms, 1)),
    }


def to_grid(df: DataFrame, lon: str, lat: str, x: str = "x", y: str = "y") -> DataFrame:
    """``df`` with x and y in metres of its points in degrees; null where either is.

    Names that begin with an underscore and a letter are used on the way; ``df`` should have none of them.
    """
    steps = [{"_lat": f"radians(cast({lat} as double))", "_lon": f"radians(cast({lon} as double))"}]
    steps += _centred("_lat", "_lon", WGS_AXIS, WGS_FLATTENING) + _moved(BACK, tuple(-s for s in SHIFT), (0.0, 0.0, 0.0)) + _on_ellipsoid(GRID_AXIS, GRID_FLATTENING)
    steps += [
        {"_s": "sin(_lat)", "_l": f"_lon - {math.radians(ORIGIN_LON)!r}D"},
        {"_t": f"sinh((ln((1 + _s) / (1 - _s)) - {_E!r}D * ln((1 + {_E!r}D * _s) / (1 - {_E!r}D * _s))) / 2)"},  # tangent of the conformal latitude
        {"_xi": "atan2(_t, cos(_l))", "_eta": "asinh(sin(_l) / sqrt(_t * _t + cos(_l) * cos(_l)))"},
        _series(ALPHA, 1),
        {x: f"{FALSE_EASTING!r}D + {RADIUS!r}D * _east", y: f"{FALSE_NORTHING!r}D + {RADIUS!r}D * (_north - {_ORIGIN!r}D)"},
    ]
    return _then(df, steps, [x, y])


def to_degrees(df: DataFrame, x: str, y: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` with lon and lat in degrees of its points of the grid; null where either is."""
    steps = [
        {"_xi": f"({y} - {FALSE_NORTHING!r}D) / {RADIUS!r}D + {_ORIGIN!r}D", "_eta": f"({x} - {FALSE_EASTING!r}D) / {RADIUS!r}D"},
        _series(BETA, -1),
        {"_t": "sin(_north) / cosh(_east)", "_lon": f"atan2(sinh(_east), cos(_north)) + {math.radians(ORIGIN_LON)!r}D"},
        {"_lat": "asin(_t)", "_q": "ln((1 + _t) / (1 - _t)) / 2"},
    ]
    # Back from the conformal latitude: each step of the fixed point gains a factor of e squared, some 150.
    steps += [{"_lat": f"2 * atan(exp(_q + {_E / 2!r}D * ln((1 + {_E!r}D * sin(_lat)) / (1 - {_E!r}D * sin(_lat))))) - {math.pi / 2!r}D"} for _ in range(7)]
    steps += _centred("_lat", "_lon", GRID_AXIS, GRID_FLATTENING) + _moved(TURN, (0.0, 0.0, 0.0), SHIFT) + _on_ellipsoid(WGS_AXIS, WGS_FLATTENING)
    return _then(df, [*steps, {lon: "degrees(_lon)", lat: "degrees(_lat)"}], [lon, lat])


def buffered(df: DataFrame, uid: str, lon: str, lat: str, radius: str, quarter: int = 48, keep: tuple[str, ...] = ()) -> DataFrame:
    """uid, keep, place, lon, lat: the ring, ``quarter`` edges a quarter, ``radius`` metres of the grid around each point, counter-clockwise."""
    corner = F.explode(F.sequence(F.lit(0), F.lit(4 * quarter - 1))).alias("place")
    around = to_grid(df.select(uid, *keep, F.col(lon).alias("_lon0"), F.col(lat).alias("_lat0"), F.col(radius).alias("_m")), "_lon0", "_lat0", "_x0", "_y0").select(uid, *keep, "_m", "_x0", "_y0", corner)
    angle = F.col("place") * (math.pi / (2 * quarter))
    at = around.select(uid, *keep, "place", (F.col("_x0") + F.col("_m") * F.cos(angle)).alias("_gx"), (F.col("_y0") + F.col("_m") * F.sin(angle)).alias("_gy"))
    return to_degrees(at, "_gx", "_gy").select(uid, *keep, "place", "lon", "lat")


def _meridian(lat: float) -> float:
    """Rectifying latitude of the origin, in radians."""
    s = math.sin(lat)
    chi = math.atan(math.sinh(math.atanh(s) - _E * math.atanh(_E * s)))
    return chi + sum(a * math.sin(2 * j * chi) for j, a in enumerate(ALPHA, 1))


_ORIGIN = _meridian(math.radians(ORIGIN_LAT))
