"""Point expressions; longitude and latitude doubles are the stored truth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def wkt_point(lat: Column, lng: Column) -> Column:
    return F.concat(
        F.lit("SRID=4326;POINT("), lng.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")
    )


def wkt_from_text(latlng: Column) -> Column:
    """``"lat lng"`` text to a point; null unless there are exactly two parts."""
    parts = F.split(latlng, " ")
    return F.when(F.size(parts) == 2, wkt_point(F.get(parts, 0), F.get(parts, 1)))


def kml_point(lon: Column, lat: Column) -> Column:
    return F.concat(
        F.lit("<Point><coordinates>"),
        lon.cast("string"),
        F.lit(","),
        lat.cast("string"),
        F.lit("</coordinates></Point>"),
    )


def distance_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.asin(F.sqrt(a)) * (2 * EARTH_RADIUS_KM)
