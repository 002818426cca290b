"""The geography list: one JSON document with a ``countries`` array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas


def read_geography(spark: SparkSession, path: str) -> DataFrame:
    """``pos, name, alpha3, continent, subregion``: one row per country of the world."""
    raw = spark.read.schema(schemas.GEOGRAPHY).json(path, multiLine=True)
    return raw.select(F.posexplode("countries").alias("pos", "c")).select("pos", "c.*")
