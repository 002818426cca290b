"""Small dimensions: journals, link sources, aliases, period buckets and geography.

All are fixed tables or the geography list. Look-ups of names are folded into one map, whose
size follows the geography and alias tables, never the catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import vocab

def fixed_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table of constants. Arrow input gives Catalyst a local relation of known size."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(
        pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema
    )


def journals(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, list(vocab.JOURNALS.items()), "journal STRING, issn STRING")


def link_sources(spark: SparkSession) -> DataFrame:
    """One row per journal with a configured link source: which sources, and their scope."""
    repository = [(j, True, s) for j, s in vocab.DATAVERSE_SUBTREE.items()]
    community = [(j, True, c) for j, c in vocab.ZENODO_COMMUNITY.items()]
    dataverse = fixed_table(spark, repository, "journal STRING, d BOOLEAN, dv_subtree STRING")
    zenodo = fixed_table(spark, community, "journal STRING, z BOOLEAN, zen_community STRING")
    pages = fixed_table(
        spark, [(j, True) for j in vocab.PAGE_JOURNALS], "journal STRING, p BOOLEAN"
    )
    others = fixed_table(
        spark, [(j,) for j in vocab.REFERENCE_ONLY_JOURNALS], "journal STRING"
    )
    configured = (
        dataverse.select("journal").unionByName(zenodo.select("journal"))
        .unionByName(others).distinct()
    )
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return (
        configured.join(dataverse, "journal", "left").join(zenodo, "journal", "left")
        .join(pages, "journal", "left")
        .select(
            "journal", flag("d").alias("dv_enabled"), "dv_subtree",
            flag("z").alias("zen_enabled"), "zen_community", flag("p").alias("page_enabled"),
        )
    )


def period_buckets(spark: SparkSession) -> DataFrame:
    rows = [(i, *b) for i, b in enumerate(vocab.BUCKETS)]
    return fixed_table(spark, rows, "bucket INT, label STRING, lo INT, hi INT")


def golden_cases(spark: SparkSession) -> DataFrame:
    return fixed_table(
        spark, vocab.GOLDEN_CASES, "doi STRING, label STRING, expected BOOLEAN"
    )


def name_map(key: Column, value: Column) -> Column:
    """Aggregate expression: all pairs of a dimension as a map."""
    return F.map_from_entries(F.collect_set(F.struct(key.alias("key"), value.alias("value"))))


SPELLING = "name STRING, target STRING"


def spellings(geo: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``name, target``: every alias and official name with the one name a country has here.

    The geography's name is that name. An official name that the geography lists under another
    spelling (one of its aliases, or the name shown to readers) leads there, and so do all its
    aliases. Names outside the geography share their official name. ``aliases`` adds to the
    built-in table and wins over it.
    """
    spark = geo.sparkSession
    official = {*vocab.COUNTRY_ALIASES.values(), *vocab.DISPLAY_NAMES}
    known_as = [(t, t, 0) for t in official]
    known_as += [(n, t, 1) for n, t in vocab.COUNTRY_ALIASES.items() if n in vocab.DISPLAY_NAMES.values()]
    known_as += [(n, t, 1) for t, n in vocab.DISPLAY_NAMES.items()]
    known_as += [(n, t, 2) for n, t in vocab.COUNTRY_ALIASES.items()
                 if n not in vocab.PARTS and n not in vocab.DISPLAY_NAMES.values()]
    candidates = fixed_table(spark, known_as, f"{SPELLING}, rank INT")
    listed = geo.select(F.col("name").alias("listed")).distinct()
    home = candidates.join(listed, F.col("name") == F.col("listed")).groupBy("target").agg(
        F.min_by("listed", F.struct("rank", "listed")).alias("home")
    )
    rows = [(n, t, 1) for n, t in vocab.COUNTRY_ALIASES.items()]
    rows += [(t, t, 1) for t in official] + [(n, t, 2) for t, n in vocab.DISPLAY_NAMES.items()]
    pairs = fixed_table(spark, rows, f"{SPELLING}, rank INT")
    if aliases is not None:
        pairs = pairs.unionByName(aliases.select("name", "target", F.lit(0).alias("rank")))
    led = pairs.join(home.withColumnRenamed("target", "to"), F.col("target") == F.col("to"), "left")
    return led.groupBy("name").agg(
        F.min_by(F.coalesce("home", "target"), F.struct("rank", "target")).alias("target")
    )


def country_lookup(geo: DataFrame, aliases: DataFrame | None = None) -> Column:
    """Scalar ``struct<exact, folded>`` for :func:`quire.functions.names.country_name`.

    Names of the geography stay as they are and win over :func:`spellings`; then case-folded
    names and three-letter codes are tried.
    """
    spark = geo.sparkSession
    exact = geo.select("name", F.col("name").alias("target"), F.lit(0).alias("rank")).unionByName(
        spellings(geo, aliases).withColumn("rank", F.lit(1))
    )
    extra_rows = [(n, t, 4) for n, t in vocab.OFFICIAL_NAMES.items()]
    folded = (
        exact.where((F.col("rank") == 0) | (F.col("name").isin(sorted(vocab.COUNTRY_ALIASES.values()))))
        .unionByName(geo.select(F.col("alpha3").alias("name"), F.col("name").alias("target"),
                                F.lit(3).alias("rank")))
        .unionByName(fixed_table(spark, extra_rows, f"{SPELLING}, rank INT"))
        .withColumn("name", F.lower("name"))
    )
    both = exact.withColumn("tier", F.lit("exact")).unionByName(
        folded.withColumn("tier", F.lit("folded"))
    )
    best = (
        both.where(F.col("name").isNotNull()).groupBy("tier", "name")
        .agg(F.min_by("target", F.struct("rank", "target")).alias("target"))
    )
    maps = best.groupBy("tier").agg(name_map(F.col("name"), F.col("target")).alias("m"))
    one = maps.agg(F.struct(
        F.max_by("m", F.when(F.col("tier") == "exact", 1)).alias("exact"),
        F.max_by("m", F.when(F.col("tier") == "folded", 1)).alias("folded"),
    ))
    return one.scalar()


def known_countries(geo: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``known``: every lower-cased spelling of a country that a look-up finds."""
    codes = geo.select(F.lower("alpha3").alias("known"))
    official = [(n.lower(),) for n in vocab.OFFICIAL_NAMES]
    return geo.select(F.lower("name").alias("known")).union(codes).union(
        spellings(geo, aliases).select(F.lower("name"))
    ).union(fixed_table(geo.sparkSession, official, "known STRING")).distinct()


def unrecognised(classes: DataFrame, geo: DataFrame, aliases: DataFrame | None = None,
                 valid: list[str] = vocab.REGIONS) -> DataFrame:
    """``kind, name, n``: region and country names that no table knows, with their rows.

    Names are exploded and joined, so there is no bound on any of the tables.
    """
    def used(column: str) -> DataFrame:
        return classes.select(F.explode(F.array_distinct(column)).alias("name"))

    regions = used("regions").where(~F.col("name").isin([*valid, *vocab.REGION_ALIASES]))
    countries = used("countries").join(
        known_countries(geo, aliases), F.lower("name") == F.col("known"), "left_anti"
    )
    return regions.select(F.lit("region").alias("kind"), "name").unionByName(
        countries.select(F.lit("country").alias("kind"), "name")
    ).groupBy("kind", "name").agg(F.count("*").alias("n"))


def geography_maps(geo: DataFrame) -> Column:
    """Scalar ``struct<home, continent>``: country -> sub-region, sub-region -> continent."""
    usable = geo.where(F.col("subregion").isNotNull() & F.col("continent").isNotNull())
    home = usable.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("key")).agg(
        F.max_by("subregion", "pos").alias("value")
    ).withColumn("tier", F.lit("home"))
    continent = usable.groupBy(F.col("subregion").alias("key")).agg(
        F.max_by("continent", "pos").alias("value")
    ).withColumn("tier", F.lit("continent"))
    maps = home.unionByName(continent).groupBy("tier").agg(
        name_map(F.col("key"), F.col("value")).alias("m")
    )
    return maps.agg(F.struct(
        F.max_by("m", F.when(F.col("tier") == "home", 1)).alias("home"),
        F.max_by("m", F.when(F.col("tier") == "continent", 1)).alias("continent"),
    )).scalar()


def subregions(geo: DataFrame) -> DataFrame:
    """Sub-region, its continent, its countries in list order, and its first position."""
    usable = geo.where(F.col("subregion").isNotNull() & F.col("continent").isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return usable.groupBy("subregion").agg(
        F.max_by("continent", "pos").alias("continent"),
        F.transform(ordered, lambda s: s["name"]).alias("countries"),
        F.min("pos").alias("first_pos"),
    )


def continents(geo: DataFrame, order: list[str] = vocab.CONTINENT_ORDER) -> DataFrame:
    """Continents present, in display order, with sorted sub-regions; the global row is last."""
    rank = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("continent"))
    present = (
        subregions(geo).groupBy("continent")
        .agg(F.array_sort(F.collect_set("subregion")).alias("subregions"))
        .select(rank.cast("int").alias("ord"), "continent", "subregions").where("ord > 0")
    )
    last = fixed_table(
        geo.sparkSession, [(len(order) + 1, vocab.GLOBAL, [])],
        "ord INT, continent STRING, subregions ARRAY<STRING>",
    )
    return present.unionByName(last)
