"""Scorecards and coverage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def golden_results(cases: DataFrame, predictions: DataFrame) -> DataFrame:
    """Golden cases with ``got`` and a PASS / FAIL / SKIP result (no prediction = SKIP)."""
    got = predictions.select("doi", F.col("is_hpe").alias("got"))
    wanted, seen = F.col("expected"), F.col("got")
    result = F.when(seen.isNull(), "SKIP").when(seen == wanted, "PASS").otherwise("FAIL")
    return cases.join(got, "doi", "left").withColumn("result", result)


def scorecard(results: DataFrame) -> DataFrame:
    """One row ``passed, failed, skipped, cases``."""
    return results.agg(
        *[F.count_if(F.col("result") == r).alias(n)
          for r, n in (("PASS", "passed"), ("FAIL", "failed"), ("SKIP", "skipped"))],
        F.count("*").alias("cases"),
    )


def coverage(articles: DataFrame, authors: DataFrame) -> DataFrame:
    """Per journal: articles, articles with an abstract, author rows."""
    people = authors.groupBy("doi").agg(F.count("*").alias("_people"))
    return articles.select("doi", "journal", "abstract").join(people, "doi", "left").groupBy(
        "journal"
    ).agg(
        F.count("*").alias("articles"), F.count("abstract").alias("with_abstract"),
        F.coalesce(F.sum("_people"), F.lit(0)).cast("bigint").alias("authors"),
    )
