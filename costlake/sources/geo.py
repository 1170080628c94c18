"""Point export and polygon import as plain columnar / JSON-lines data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.functions import features as fx

_FEATURE = ("geometry struct<type:string, coordinates:string>, properties map<string,string>")


def export_points(df: DataFrame, path: str, x: str, y: str, label: str) -> DataFrame:
    """Write label, x, y and the ``POINT (x y)`` text; returns what was written."""
    points = df.select(F.col(label).alias("address"), F.col(x).alias("x"), F.col(y).alias("y"),
                       fx.point_text(F.col(x), F.col(y)).alias("point"))
    points.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.parquet(path)


def simple_polygons(features: DataFrame, id_property: str) -> DataFrame:
    """Rows ``polygon_id, rings`` of the features whose geometry type is Polygon.

    ``features`` has the columns of :func:`read_feature_lines`. Coordinates stay text
    until here because their nesting depends on the geometry type.
    """
    xy = F.from_json(F.col("geometry.coordinates"), "array<array<array<double>>>")
    rings = F.transform(xy, lambda ring: F.transform(
        ring, lambda v: F.struct(F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y"))))
    return (features.filter(F.col("geometry.type") == "Polygon")
            .select(F.col("properties")[id_property].alias("polygon_id"), rings.alias("rings")))


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features, one per line (splittable)."""
    return spark.read.schema(_FEATURE).json(path)
