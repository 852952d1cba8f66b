"""Column expressions on coordinates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371.0 * 1000


def distance_m(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres, by the spherical law of cosines.

    Rounding can push the cosine just past 1 for places that coincide, so it is
    held to [-1, 1]; acos would return NaN otherwise.
    """
    a, b = F.radians(lat1), F.radians(lat2)
    turn = F.cos(F.radians(lng1) - F.radians(lng2))
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * turn
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) * EARTH_RADIUS_M


def unit_vector(lng: Column, lat: Column) -> tuple[Column, Column, Column]:
    """The place as x, y, z on a sphere of radius 1."""
    la, lo = F.radians(lat), F.radians(lng)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)
