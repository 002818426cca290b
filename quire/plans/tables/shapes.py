"""The driver tables seen as catalogue tables.

Orders are entries: their suppliers' nations are the countries, ship years the period.
A supplier in debt stands for a polity that the geography does not list. Nations are the
geography, with a middle level made from the nation key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import vocab

CONTINENTS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
SUBREGIONS = [f"{c}-{i}" for c in CONTINENTS for i in range(3)]

# Period buckets over the ship years of the tables.
BUCKETS = [
    ("-1994", None, 1994), ("1995", 1995, 1995), ("1996", 1996, 1996), ("1997", 1997, 1997),
    ("1998", 1998, 1998), ("1999", 1999, 1999), ("2000", 2000, 2000), ("2001", 2001, 2001),
    ("2002-", 2002, None),
]

ENTRY_ORDER = ["-year", "title", "doi"]
TEXTS = "array<string>"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def joined(column: str | Column) -> Column:
    """Array as one comparable string."""
    return F.array_join(column, "|")


def geography(spark: SparkSession, folder: str) -> DataFrame:
    region = load(spark, folder, "region")
    nation = load(spark, folder, "nation")
    middle = F.concat(
        "r_name", F.lit("-"), text(F.floor(F.col("n_nationkey") / 10))
    )
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("pos"), F.col("n_name").alias("name"),
        F.concat(F.lit("X"), text("n_nationkey")).alias("alpha3"),
        F.col("r_name").alias("continent"), middle.alias("subregion"),
    )


def order_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Per order: distinct countries and sub-regions, first and last ship year.

    Sets are gathered on the map side first, so an order or a supplier with very many lines
    costs one small row per task, whatever the number of nations.
    """
    geo = geography(spark, folder)
    old = F.when(F.col("s_acctbal") < 0, F.concat(F.lit("Old "), "name")).otherwise(F.col("name"))
    supplier = load(spark, folder, "supplier").join(
        geo, F.col("s_nationkey") == F.col("pos")
    ).select("s_suppkey", old.alias("country"), "subregion")
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", F.year("l_shipdate").alias("y")
    )
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
        "l_orderkey"
    ).agg(
        F.array_sort(F.collect_set("country")).alias("countries"),
        F.array_sort(F.collect_set("subregion")).alias("regions"),
        F.min("y").alias("first"), F.max("y").alias("last"),
    )


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as catalogue entries; urgent ones also carry the global region."""
    none = F.array().cast(TEXTS)
    regions = F.coalesce("regions", none)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    dated = F.col("o_orderpriority") != "5-LOW"
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year")
    )
    tags = order_tags(spark, folder)
    return orders.join(tags, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        text("o_orderkey").alias("doi"), F.col("o_orderpriority").alias("title"), "year",
        F.when(urgent, F.array_append(regions, F.lit(vocab.GLOBAL))).otherwise(regions)
        .alias("regions"),
        F.coalesce("countries", none).alias("countries"),
        F.when(dated & (F.col("o_orderstatus") != "P"), F.col("first")).alias("period_start"),
        F.when(dated & (F.col("o_orderstatus") != "F"), F.col("last")).alias("period_end"),
    )


# The same shapes for the SQL side.
GEO_SQL = """
geo AS (
  SELECT n_nationkey AS pos, n_name AS name, r_name AS continent,
         r_name || '-' || CAST(n_nationkey // 10 AS VARCHAR) AS subregion
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
subs AS (SELECT subregion, max(continent) AS continent, min(pos) AS first_pos
         FROM geo GROUP BY subregion)
"""

PAIRS_SQL = GEO_SQL + """,
pairs AS (
  SELECT l_orderkey AS k, year(l_shipdate) AS y, subregion, continent,
         CASE WHEN s_acctbal < 0 THEN 'Old ' || name ELSE name END AS country
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = pos
)
"""

ENTRIES_SQL = PAIRS_SQL + """,
entry AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS doi, o_orderpriority AS title,
         year(o_orderdate) AS year, o_orderpriority = '1-URGENT' AS world,
         CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' THEN lo END AS ps,
         CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F' THEN hi END AS pe
  FROM orders LEFT JOIN (SELECT k, min(y) AS lo, max(y) AS hi FROM pairs GROUP BY k) t
    ON o_orderkey = t.k
),
entry_region AS (
  SELECT DISTINCT k, subregion AS region FROM pairs WHERE k IN (SELECT k FROM entry)
  UNION SELECT k, 'Global/Comparative' FROM entry WHERE world
),
entry_country AS (SELECT DISTINCT k, country FROM pairs WHERE k IN (SELECT k FROM entry)),
entry_key AS (
  SELECT k, region AS row_key FROM entry_region
  UNION SELECT k, continent FROM entry_region JOIN subs ON region = subregion
  UNION SELECT k, country FROM entry_country
)
"""
