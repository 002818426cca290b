"""Fill missing abstracts from landed batch responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import keyed


def abstract_rows(responses: DataFrame, order: str = "attempt") -> DataFrame:
    """``dois`` and ``items`` aligned by position to ``doi, abstract``.

    Items that are null or carry no text are not found. The last response per DOI wins.
    """
    pairs = F.arrays_zip("dois", "items")
    rows = responses.select(order, F.explode(pairs).alias("p")).select(
        F.col("p.dois").alias("doi"), F.col("p.items.abstract").alias("abstract"), order
    )
    found = rows.where((F.col("abstract") != "") & F.col("doi").isNotNull())
    return keyed.latest(found, ["doi"], [F.col(order), F.col("abstract")]).drop(order)


def fill_abstracts(articles: DataFrame, found: DataFrame) -> DataFrame:
    """Articles with null abstracts filled where one was found."""
    return keyed.set_column(articles, found, "doi", "abstract", only_missing=True)


def abstract_stats(articles: DataFrame, found: DataFrame) -> DataFrame:
    """One row ``found, total`` over the articles that lacked an abstract."""
    todo = articles.where(F.col("abstract").isNull()).select("doi")
    hit = found.select("doi", F.lit(True).alias("_hit"))
    return todo.join(hit, "doi", "left").agg(
        F.count("_hit").alias("found"), F.count("*").alias("total")
    )
