"""Worklists: which records still need work. They shrink as results land."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import vocab
from quire.operators import keyed
from quire.operators.articles import Catalogue
from quire.operators.dims import link_sources


def unclassified(cat: Catalogue) -> DataFrame:
    """DOIs without a classification."""
    return keyed.drop_keys(cat.articles.select("doi"), cat.classifications, ["doi"])


def to_classify(cat: Catalogue, fresh: bool = False) -> DataFrame:
    """``doi, title, abstract`` of the unclassified articles, or of all when ``fresh``."""
    texts = cat.articles.select("doi", "title", "abstract")
    return texts if fresh else keyed.drop_keys(texts, cat.classifications, ["doi"])


def selected(articles: DataFrame, dois: DataFrame) -> DataFrame:
    """Rows of a DOI list."""
    return keyed.keep_keys(articles, dois, ["doi"])


def missing_abstracts(articles: DataFrame, size: int = vocab.CHUNK_SIZE) -> DataFrame:
    """DOIs without an abstract, with the request batch each belongs to."""
    todo = articles.where(F.col("abstract").isNull()).select("doi")
    return keyed.chunked(todo, "doi", size)


def missing_links(cat: Catalogue, fresh: bool = False) -> DataFrame:
    """Flagged articles without a link (all flagged when ``fresh``) and their sources.

    Journals without any source stay in the list with ``configured`` false: they count
    towards the total but are never looked up.
    """
    todo = cat.classifications.where("is_hpe")
    if not fresh:
        todo = todo.where(F.col("replication_url").isNull())
    rows = cat.articles.select("doi", "journal", "title").join(todo.select("doi"), "doi")
    sources = link_sources(cat.articles.sparkSession).withColumn("configured", F.lit(True))
    return rows.join(F.broadcast(sources), "journal", "left").fillna(
        False, ["dv_enabled", "zen_enabled", "page_enabled", "configured"]
    )
