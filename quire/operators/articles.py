"""Landed metadata items to article and author rows, and their upsert."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import blank_to_null
from quire.operators import keyed


class Catalogue(NamedTuple):
    """The three core tables."""

    articles: DataFrame
    authors: DataFrame
    classifications: DataFrame


def empty(spark: SparkSession) -> Catalogue:
    """A wiped catalogue: three empty tables with their schemas."""
    return Catalogue(*[
        spark.createDataFrame([], s)
        for s in (schemas.ARTICLE, schemas.AUTHOR, schemas.CLASSIFICATION)
    ])


def accepted(item: Column) -> Column:
    """Keep items with a DOI and an author that are not book reviews (title in ``<i>``)."""
    review = F.coalesce(F.get(item["title"], 0).startswith("<i>"), F.lit(False))
    return (
        F.coalesce(item["DOI"] != "", F.lit(False))
        & (F.coalesce(F.size(item["author"]), F.lit(0)) > 0)
        & ~review
    )


def in_scope(
    item: Column, first_year: int = 2010, last_year: int | None = None,
    record_type: str = "journal-article",
) -> Column:
    """Record type and publication year selection, up to this year unless told otherwise.

    Items without a type are taken as articles.
    """
    kind = F.coalesce(item["type"], F.lit(record_type)) == record_type
    last = F.year(F.current_date()) if last_year is None else F.lit(last_year)
    return kind & date_part(item, 0).between(F.lit(first_year), last)


def date_part(item: Column, index: int) -> Column:
    return F.get(F.get(item["published"]["date-parts"], 0), index)


def article_rows(items: DataFrame) -> DataFrame:
    """Flatten ``item`` rows to article columns with a nested ``authors`` array.

    Other columns, such as the ingest order, are carried along.
    """
    item = F.col("item")
    carried = [c for c in items.columns if c not in ("item", "journal")]
    authors = F.transform(
        F.coalesce(item["author"], F.array().cast("array<struct<given:string,family:string>>")),
        lambda a, i: F.struct(
            i.cast("int").alias("sequence"), a["given"].alias("given"),
            a["family"].alias("family"),
        ),
    )
    return items.where(accepted(item)).select(
        F.lower(item["DOI"]).alias("doi"),
        "journal",
        F.get(item["title"], 0).alias("title"),
        date_part(item, 0).alias("year"),
        date_part(item, 1).alias("month"),
        item["volume"].alias("volume"),
        item["issue"].alias("issue"),
        item["page"].alias("pages"),
        blank_to_null(item["abstract"]).alias("abstract"),
        authors.alias("authors"),
        *carried,
    )


def author_rows(articles: DataFrame) -> DataFrame:
    """Nested authors to one row each."""
    return articles.select("doi", F.inline("authors")).select(*schemas.names(schemas.AUTHOR))


def put_articles(
    cat: Catalogue, rows: DataFrame, order: list[Column], cascade: bool = False
) -> Catalogue:
    """Upsert flattened articles and replace their authors.

    The last row per DOI in ``order`` wins as a whole, nulls included. With ``cascade``
    the classification of a replaced article is deleted; by default it is kept.
    """
    new = keyed.latest(rows, ["doi"], order)
    touched = new.select("doi")
    articles = keyed.upsert(cat.articles, new.select(*cat.articles.columns), ["doi"])
    authors = keyed.replace_children(cat.authors, author_rows(new), touched, "doi")
    classes = cat.classifications
    if cascade:
        classes = keyed.drop_keys(classes, touched, ["doi"])
    return Catalogue(articles, authors, classes)


def landed_rows(rows: DataFrame) -> DataFrame:
    """What the table ``landed`` remembers of flattened articles; rows that no stream appended have
    no run."""
    blank = {"run": F.lit(None).cast("string"), "batch": F.lit(None).cast("int")}
    rows = rows.withColumns({c: v for c, v in blank.items() if c not in rows.columns})
    return keyed.with_columns_from(rows, schemas.LANDED, {})


def newer(rows: DataFrame, landed: DataFrame) -> DataFrame:
    """Flattened articles that landed after what ``landed`` holds of the same DOI, or that it
    doesn't hold."""
    order = [c for c in schemas.names(schemas.LANDED) if c != "doi"]
    old = landed.select(F.col("doi").alias("_doi"), F.struct(*order).alias("_old"))
    now = landed_rows(rows).select(F.col("doi").alias("_of"), F.struct(*order).alias("_now"))
    won = now.join(old, F.col("_of") == F.col("_doi"), "left").where(
        F.col("_old").isNull() | (F.col("_now") > F.col("_old"))
    )
    return keyed.keep_keys(rows, won.select(F.col("_of").alias("doi")), ["doi"])


def put_classifications(
    cat: Catalogue, new: DataFrame, order: list[Column] | None = None
) -> Catalogue:
    """Replace classifications by DOI; the link starts over as null.

    Of several rows for a DOI the last in ``order`` wins, by default the latest stamp.
    """
    columns = cat.classifications.columns
    rest = [c for c in columns if c not in ("doi", "classified_at", "replication_url")]
    order = order or [F.col(c) for c in ("classified_at", *rest)]
    last = keyed.latest(new, ["doi"], order)
    rows = last.withColumn("replication_url", F.lit(None).cast("string")).select(*columns)
    return cat._replace(classifications=keyed.upsert(cat.classifications, rows, ["doi"]))


def current_classifications(old: DataFrame) -> DataFrame:
    """Classification data written before a column existed, brought to today's schema."""
    return keyed.with_columns_from(
        old, schemas.CLASSIFICATION, {"countries": F.array().cast("array<string>")}
    )
