"""Great-circle distances as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sphere radius per unit, and airport positions as (longitude, latitude).
EARTH_RADIUS = {"m": 6371010.0, "mi": 3958.756}
AIRPORTS = {
    "jfk": (-73.778889, 40.639722),
    "ewr": (-74.168611, 40.6925),
    "lga": (-73.872611, 40.77725),
}


def distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column, unit: str = "m") -> Column:
    """Haversine distance between two points given in degrees."""
    radius = EARTH_RADIUS[unit]
    rise = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    run = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = rise * rise + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * run * run
    # Not least(): it skips NULL, and a missing point would come out half the earth away.
    chord = F.when(chord > 1, F.lit(1.0)).otherwise(chord)
    return F.asin(F.sqrt(chord)) * (2 * radius)


def airport_distance(code: str, lon: Column, lat: Column, unit: str = "m") -> Column:
    airport_lon, airport_lat = AIRPORTS[code]
    return distance(F.lit(airport_lon), F.lit(airport_lat), lon, lat, unit)


def airport_distances(ends: dict[str, tuple[Column, Column]], unit: str = "m") -> dict[str, Column]:
    """``{end}_{airport}_distance`` for each end of a trip, given as name -> (lon, lat)."""
    return {
        f"{end}_{code}_distance": airport_distance(code, lon, lat, unit)
        for code in AIRPORTS
        for end, (lon, lat) in ends.items()
    }


def with_airport_distances(
    dim: DataFrame, lon: str = "longitude", lat: str = "latitude", unit: str = "m"
) -> DataFrame:
    """Add ``{airport}_distance`` to a place dimension.

    A distance to an airport depends on the place only, so it is worked out once per place instead
    of once per trip; the join then carries it over.
    """
    return dim.withColumns(
        {f"{code}_distance": airport_distance(code, F.col(lon), F.col(lat), unit) for code in AIRPORTS}
    )
