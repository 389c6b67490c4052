"""Distance on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    d_lat, d_lon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    chord = F.pow(F.sin(d_lat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(d_lon / 2), 2)
    # Rounding can push the chord past 1 for opposite points; an unknown position has no distance.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))


def _vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    return F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))


def _cross(a: tuple, b: tuple) -> tuple[Column, Column, Column]:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def _dot(a: tuple, b: tuple) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def place(lat: Column, lon: Column) -> Column:
    """A point with its vector."""
    x, y, z = _vector(lat, lon)
    return F.struct(lat.alias("lat"), lon.alias("lon"), x.alias("x"), y.alias("y"), z.alias("z"))


def leg(a: Column, b: Column) -> Column:
    """Two places with the pole of the circle through them and its length, which do not depend on a point beside them."""
    x, y, z = _cross(_of(a), _of(b))
    pole = F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    return F.transform(F.array(pole), lambda p: F.struct(a.alias("a"), b.alias("b"), p.alias("pole"), F.sqrt(_dot(_of(p), _of(p))).alias("length")))[0]


def _of(point: Column) -> tuple[Column, Column, Column]:
    return point["x"], point["y"], point["z"]


def to_leg_km(point: Column, way: Column) -> Column:
    """Distance of a ``place`` from a ``leg``: from its great circle beside the leg, else from the nearer end."""
    p, a, b, pole, length = _of(point), _of(way["a"]), _of(way["b"]), _of(way["pole"]), way["length"]
    beside = (length > 0) & (_dot(_cross(a, p), pole) >= 0) & (_dot(_cross(p, b), pole) >= 0)
    across = EARTH_RADIUS_KM * F.asin(F.abs(_dot(p, pole)) / F.greatest(length, F.abs(_dot(p, pole))))
    end = lambda s: haversine_km(point["lat"], point["lon"], way[s]["lat"], way[s]["lon"])
    return F.when(beside, across).otherwise(F.least(end("a"), end("b")))
