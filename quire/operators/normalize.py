"""Clean-up of stored classifications: names, derived regions, over-long country lists.

Each operator adds a ``changed`` flag next to the new values; ``changes`` counts them.
All are row-local: the look-ups are bounded maps, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import vocab
from quire.functions import names


def normalized_countries(classes: DataFrame, lookup: Column) -> DataFrame:
    """Country names brought to catalogue spelling."""
    new = names.country_names(F.col("countries"), F.col("_lookup"))
    return (
        classes.withColumn("_lookup", lookup).withColumn("_new", new)
        .withColumn("changed", F.coalesce(F.col("_new") != F.col("countries"), F.lit(False)))
        .withColumn("countries", F.col("_new")).drop("_new", "_lookup")
    )


def regions_from_countries(
    classes: DataFrame, maps: Column, valid: list[str] = vocab.REGIONS
) -> DataFrame:
    """Regions replaced by the sorted sub-regions of the countries.

    Rows whose countries give no region, and rows that already hold the same set, keep
    their list. ``maps`` comes from ``dims.geography_maps``.
    """
    home = F.transform("countries", lambda c: F.try_element_at(F.col("_geo")["home"], c))
    derived = F.array_sort(F.array_distinct(F.filter(home, lambda r: r.isin(valid))))
    none = F.array().cast("array<string>")
    current = F.array_sort(F.array_distinct(F.coalesce("regions", none)))
    changed = (F.size("_derived") > 0) & (F.col("_derived") != current)
    return (
        classes.withColumn("_geo", maps).withColumn("_derived", derived)
        .withColumn("changed", F.coalesce(changed, F.lit(False)))
        .withColumn(
            "regions", F.when(F.col("changed"), F.col("_derived")).otherwise(F.col("regions"))
        )
        .drop("_derived", "_geo")
    )


def collapsed_many_countries(
    classes: DataFrame, threshold: int = vocab.COUNTRY_THRESHOLD
) -> DataFrame:
    """More than ``threshold`` countries means comparative work: no countries, global region."""
    changed = F.coalesce(F.size("countries") > threshold, F.lit(False))
    none = F.array().cast("array<string>")
    return (
        classes.withColumn("changed", changed)
        .withColumn("regions", F.when(F.col("changed"), F.array(F.lit(vocab.GLOBAL)))
                    .otherwise(F.col("regions")))
        .withColumn("countries", F.when(F.col("changed"), none).otherwise(F.col("countries")))
    )


def changes(df: DataFrame) -> DataFrame:
    """One row ``updated, total``."""
    return df.agg(F.count_if("changed").alias("updated"), F.count("*").alias("total"))
