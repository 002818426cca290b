"""Dataset links: cascading evidence from landed search responses and reference lists.

All response tables together are reduced to one row per DOI with a single grouped aggregation that
combines on the map side, so the cascade itself is plain column logic over one wide row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import vocab
from quire.functions import text
from quire.operators import keyed
from quire.operators.articles import Catalogue


def one_hit(candidates: DataFrame, keys: list[str], url: str = "url") -> DataFrame:
    """Hit count per key and the hit itself when it is the only one."""
    return candidates.groupBy(*keys).agg(
        F.count("*").alias("n_hits"), F.min(url).alias("_url")
    ).select(*keys, "n_hits", F.when(F.col("n_hits") == 1, F.col("_url")).alias(url))


def hits(step: Column) -> Column:
    """Hits of a later search step: an error, or a step not run, counts as none."""
    return F.when(step["ok"], step["n"]).otherwise(F.lit(0))


def single(step: Column) -> Column:
    return F.when(step["ok"] & (step["n"] == 1), step["url"])


def dataverse_link(field: Column, full: Column, title: Column, subtree: Column,
                   has_title: Column) -> Column:
    """First repository: identifier query, then full text in a collection, then title.

    Each later step runs only after an empty one. An error on the first query ends the
    search, as do two hits or more, or one hit without a URL.
    """
    none_yet = field["n"] == 0
    use_full = none_yet & subtree.isNotNull()
    use_title = none_yet & (~subtree.isNotNull() | (hits(full) == 0)) & has_title
    return F.when(field["ok"], F.coalesce(
        single(field), F.when(use_full, single(full)), F.when(use_title, single(title))
    ))


def zenodo_link(field: Column, full: Column) -> Column:
    """Second repository: related-identifier query, then full text if that was empty."""
    return F.when(field["ok"], F.coalesce(
        single(field), F.when(field["n"] == 0, single(full))
    ))


def page_link(status: Column, url: Column, html: Column, site: str = vocab.PAGE_SITE,
              pattern: str = vocab.ARCHIVE_LINK) -> Column:
    """Final URL of a publisher page on ``site`` that links to an archive."""
    good = (status == 200) & url.contains(site) & text.has_archive_link(html, pattern)
    return F.when(good, url)


def reference_candidates(references: Column) -> Column:
    """Reference strings to ``array<struct<repo, ref>>``, those with a repository DOI."""
    found = F.transform(references, lambda r: F.struct(
        text.repository_doi(r).alias("repo"), r.alias("ref")
    ))
    # Only what is kept is lower-cased.
    return F.transform(F.filter(found, lambda c: c["repo"].isNotNull()), lambda c: F.struct(
        c["repo"].alias("repo"), F.lower(c["ref"]).alias("ref")
    ))


def reference_link(candidates: Column, tokens: Column) -> Column:
    """The only candidate, else the first whose reference shares a long title word.

    Words are looked at only where they decide, each different one once.
    """
    none = F.array().cast("array<string>")
    words = F.array_distinct(F.transform(F.coalesce(tokens, none), lambda t: F.lower(t)))
    first = text.let(words, lambda known: F.get(F.filter(
        candidates, lambda c: F.exists(known, lambda t: c["ref"].contains(t))
    ), 0))
    chosen = F.when(F.size(candidates) == 1, F.get(candidates, 0)).otherwise(
        F.when(F.size(candidates) > 1, first)
    )
    repo = chosen["repo"]
    return F.when(repo.isNotNull(), text.doi_link(repo))


#: Search steps of the two repositories.
DATAVERSE_STEPS = ("field", "full_text", "title")
ZENODO_STEPS = ("field", "full_text")


def evidence(
    dataverse: DataFrame, zenodo: DataFrame, pages: DataFrame, references: DataFrame
) -> DataFrame:
    """One row per DOI with all that was found: ``dataverse`` and ``zenodo`` (a struct of steps each),
    ``page_url`` and ``candidates``.

    The responses of all sources are one tagged union, and one aggregation with map-side combine
    takes each step's last attempt; of equal attempts the one with the greatest values counts,
    so reruns agree.
    """
    def tagged(rows: DataFrame, kind: Column, *columns: str) -> DataFrame:
        return rows.select("doi", kind.alias("kind"), "attempt", *columns)

    def step(rows: DataFrame, source: str) -> DataFrame:
        kind = F.concat(F.lit(f"{source} "), F.col("step"))
        rows = rows.withColumn("n", F.col("n_hits").cast("bigint"))
        return tagged(rows, kind, "ok", "n", "url")

    def last(kind: str, *columns: str) -> Column:
        mine = F.when(F.col("kind") == kind, F.struct("attempt", *columns))
        return F.max_by(F.struct(*columns), mine)

    def outcome(source: str, name: str) -> Column:
        mine = F.when(F.col("kind") == f"{source} {name}", F.struct("attempt", "n", "url"))
        return F.max_by(F.struct("ok", "n", "url"), mine).alias(name)

    every = step(dataverse, "dataverse")
    for rows in (
        step(zenodo, "zenodo"), tagged(pages, F.lit("page"), "page_url"),
        tagged(references, F.lit("references"), "candidates"),
    ):
        every = every.unionByName(rows, allowMissingColumns=True)
    return every.groupBy("doi").agg(
        F.struct(*[outcome("dataverse", s) for s in DATAVERSE_STEPS]).alias("dataverse"),
        F.struct(*[outcome("zenodo", s) for s in ZENODO_STEPS]).alias("zenodo"),
        last("page", "page_url")["page_url"].alias("page_url"),
        last("references", "candidates")["candidates"].alias("candidates"),
    )


def propose_links(
    worklist: DataFrame, dataverse: DataFrame, zenodo: DataFrame, pages: DataFrame,
    references: DataFrame,
) -> DataFrame:
    """``doi, replication_url`` proposals for a worklist; null where nothing was found.

    The four inputs come from :mod:`quire.sources.responses`. A dry run is this DataFrame;
    applying it is :func:`apply_links`. The worklist meets :func:`evidence` in one join.
    """
    todo = worklist.where("configured").withColumn("title", text.blank_to_null(F.col("title")))
    found = evidence(dataverse, zenodo, pages, references)
    wide = todo.join(found, "doi", "left").withColumn("_tokens", text.long_tokens(F.col("title")))
    col = F.col
    url = F.coalesce(
        F.when(col("dv_enabled"), dataverse_link(
            col("dataverse.field"), col("dataverse.full_text"), col("dataverse.title"),
            col("dv_subtree"), col("title").isNotNull(),
        )),
        F.when(col("zen_enabled"), zenodo_link(col("zenodo.field"), col("zenodo.full_text"))),
        F.when(col("page_enabled"), col("page_url")),
        reference_link(col("candidates"), col("_tokens")),
    )
    return wide.select("doi", url.alias("replication_url"))


def apply_links(cat: Catalogue, proposals: DataFrame) -> Catalogue:
    """Write the links found; classifications without a proposal keep theirs."""
    found = proposals.where(F.col("replication_url").isNotNull())
    return cat._replace(classifications=keyed.set_column(
        cat.classifications, found, "doi", "replication_url"
    ))


def link_stats(worklist: DataFrame, proposals: DataFrame) -> DataFrame:
    """One row ``found, total``; the total includes journals without a source."""
    return worklist.select("doi").join(proposals, "doi", "left").agg(
        F.count("replication_url").alias("found"), F.count("*").alias("total")
    )
