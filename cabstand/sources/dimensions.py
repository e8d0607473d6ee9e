"""The place dimension: typed CSV load, and its build from polygon points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabstand.operators.joins import unique_dimension
from cabstand.specs import ZONE_COLUMNS, struct_of


def read_csv(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """CSV with a header under a declared schema; nothing is inferred, a bad value fails the load."""
    return spark.read.schema(struct_of(columns)).option("header", True).option("mode", "FAILFAST").csv(path)


def read_zones(spark: SparkSession, path: str, policy: str = "mean") -> DataFrame:
    """The place dimension, one row per LocationID (see ``unique_dimension``)."""
    return unique_dimension(read_csv(spark, path, ZONE_COLUMNS), "LocationID", policy)


def box_centres(points: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Middle of each polygon's bounding box. Minima and maxima pre-aggregate on the map side."""
    return points.groupBy(*keys).agg(
        ((F.min(x) + F.max(x)) / 2).alias("longitude"),
        ((F.min(y) + F.max(y)) / 2).alias("latitude"),
    )


def zone_dimension(points: DataFrame, attributes: DataFrame, policy: str = "mean") -> DataFrame:
    """Place attributes with the centre of each place.

    ``points``: LocationID, polygon, x, y. ``attributes``: LocationID, borough, zone. A place of
    several polygons gets the mean of their centres, one row per place; ``as_is`` keeps one row per
    polygon and attribute row.
    """
    centres = box_centres(points, ["LocationID", "polygon"]).drop("polygon")
    if policy != "as_is":
        centres = unique_dimension(centres, "LocationID", "mean")
        attributes = unique_dimension(attributes, "LocationID", policy)
    joined = attributes.join(centres, "LocationID", "left")
    return joined.select(*ZONE_COLUMNS)
