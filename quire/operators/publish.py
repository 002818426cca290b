"""The published catalogue: flagged articles with a link, and their author line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import excluded_title
from quire.operators import keyed
from quire.operators.articles import Catalogue


def ordered_text(
    rows: DataFrame, key: str, order: str, label: str, separator: str, block: int = 1024
) -> DataFrame:
    """``label`` values of each key joined in ``order``; null labels are skipped.

    Built in two levels so that no task sorts one key's rows as a whole: first blocks of
    ``block`` consecutive positions, then the blocks. The explicit repartition keeps a
    partitioning by ``key`` alone, left over from a join, from serving the first level.
    """
    def joined(position: str, text: str):
        items = F.array_sort(F.collect_list(F.struct(position, text)))
        return F.array_join(F.transform(items, lambda s: s[text]), separator)

    return (
        rows.where(F.col(label).isNotNull())
        .withColumn("_block", F.floor(F.col(order) / block))
        .repartition(key, "_block")
        .groupBy(key, "_block").agg(joined(order, label).alias(label))
        .groupBy(key).agg(joined("_block", label).alias(label))
    )


def author_lines(authors: DataFrame) -> DataFrame:
    """``doi, authors``: ``Family, G.; Family`` in sequence; authors without a family skipped."""
    family, given = F.col("family"), F.col("given")
    short = F.concat(family, F.lit(", "), F.substring(given, 1, 1), F.lit("."))
    label = F.when(family != "", F.when(given != "", short).otherwise(family))
    rows = authors.select("doi", "sequence", label.alias("authors"))
    return ordered_text(rows, "doi", "sequence", "authors", "; ")


def published(cat: Catalogue) -> DataFrame:
    """Published entries, unordered. Titles of notices are out, and so are null titles."""
    shown = cat.classifications.where(
        F.col("is_hpe") & F.col("replication_url").isNotNull()
    ).select("doi", "period_start", "period_end", "regions", "countries", "replication_url")
    entries = cat.articles.where(~excluded_title(F.col("title"))).select(
        "doi", "title", "journal", "year", "abstract"
    ).join(shown, "doi")
    lines = author_lines(keyed.keep_keys(cat.authors, shown, ["doi"]))
    return entries.join(lines, "doi", "left").withColumn(
        "authors", F.coalesce("authors", F.lit(""))
    ).select(*schemas.ENTRY_FIELDS)


def in_catalogue_order(entries: DataFrame) -> DataFrame:
    """Newest first, years unknown last, then by title and DOI."""
    return entries.orderBy(F.desc_nulls_last("year"), F.asc("title"), F.asc("doi"))
