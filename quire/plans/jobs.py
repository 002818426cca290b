"""End-to-end jobs over stored tables: the steps a catalogue owner runs.

Each job stores what it has parsed, finds the buckets that its DOIs fall into, and reads, changes
and writes those buckets alone; one manifest then switches all its tables. Statistics of the
clean-ups are observed while their changes are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire import vocab
from quire.operators import (
    abstracts, articles, browse, classify, dims, keyed, links, normalize, overrides, publish,
    quality, worklists,
)
from quire.sources import geography, pages, responses, tables
from quire.sources import overrides as override_files
from quire.streaming import jobs as streams


def ingest(
    spark: SparkSession, root: str, landed: str, first_year: int = 2010,
    last_year: int | None = None, fresh: bool = False, cascade: bool = False,
) -> None:
    """Landed metadata pages to the article and author tables.

    The parsed pages and the flattened rows are stored first, so a page is parsed once. Lines that
    are no pages go to ``<root>/rejected_pages``.
    """
    store = tables.catalogue_store(spark, root)
    landed_pages = tables.staged(pages.read_pages(spark, landed), "pages")
    tables.write_table(pages.page_rejects(landed_pages), f"{root}/rejected_pages")
    items = pages.page_items(pages.good_pages(landed_pages))
    items = items.where(articles.in_scope(F.col("item"), first_year, last_year))
    order = [F.col(c) for c in pages.INGEST_ORDER]
    rows = keyed.latest(articles.article_rows(items), ["doi"], order)
    staged = tables.write_table(rows, f"{root}/staged")
    rows = spark.read.parquet(f"{root}/staged/v={staged}")
    only = None if fresh else store.buckets_of(rows, "articles")
    cat = articles.empty(spark) if fresh else tables.load_catalogue(spark, root, store, only)
    cat = articles.put_articles(cat, rows, order, cascade)
    seen = articles.landed_rows(rows)
    if not fresh:
        seen = keyed.upsert(store.read("landed", only), seen, ["doi"])
    changed = ("authors", "articles")
    changed = (*changed, "classifications") if fresh or cascade else changed
    tables.save_catalogue(store, cat, changed, only, seen)


def merge_landed(spark: SparkSession, root: str, out: str, cascade: bool = False) -> int:
    """Bring the tables up to date with the rows that page streams have appended to ``out`` since
    the last merge; returns how many appended parts were new.

    The manifest's ledger says which batch of each run is in the tables, so a merge reads neither
    old parts nor untouched buckets, and repeating it changes nothing. ``landed`` remembers which
    page gave each article: of old and new, what landed later wins, whenever it is merged.
    """
    store = tables.catalogue_store(spark, root)
    new, ledger = streams.unapplied(spark, out, store.ledger.get(out, {}))
    if not new:
        return 0
    order = [F.col(c) for c in streams.MERGE_ORDER]
    rows = tables.staged(keyed.latest(streams.read_parts(spark, out, new), ["doi"], order), "merge")
    only = store.buckets_of(rows, "articles")
    seen = store.read("landed", only)
    rows = articles.newer(rows, seen)
    cat = articles.put_articles(
        tables.load_catalogue(spark, root, store, only), rows, order, cascade
    )
    seen = keyed.upsert(seen, articles.landed_rows(rows), ["doi"])
    changed = ("authors", "articles", "classifications") if cascade else ("authors", "articles")
    tables.save_catalogue(store, cat, changed, only, seen, {out: ledger})
    return len(new)


def request_files(
    spark: SparkSession, root: str, out: str, model: str, system: str,
    style: str = "messages", fresh: bool = False,
) -> None:
    """Model requests for the unclassified articles."""
    todo = worklists.to_classify(tables.load_catalogue(spark, root), fresh)
    build = {"messages": classify.message_requests, "chat": classify.chat_requests}[style]
    tables.write_lines(build(todo, model, system), f"{out}/requests")


def reply_files(
    spark: SparkSession, root: str, out: str, landed: str, geo_path: str, backend: str,
    model: str, style: str = "messages", at: Column | None = None,
) -> None:
    """Landed model replies to classifications; rejects go to ``<out>/rejected``, and region and
    country names that no table knows to ``<out>/unknown_names``.

    Request ids come from the articles, so late replies of earlier requests are found, too.
    """
    store = tables.catalogue_store(spark, root)
    cat = tables.load_catalogue(spark, root, store)
    read = {"messages": responses.read_message_replies, "chat": responses.read_chat_replies}
    replies = tables.staged(classify.parsed_replies(classify.resolve_dois(
        read[style](spark, landed), classify.request_map(cat.articles)
    )), "replies")
    geo = geography.read_geography(spark, geo_path)
    classify.rejected(replies).write.mode("overwrite").parquet(f"{out}/rejected")
    classify.unknown_names(replies, geo).write.mode("overwrite").parquet(f"{out}/unknown_names")
    new = classify.classified(replies, dims.country_lookup(geo), backend, model, at)
    only = store.buckets_of(replies.where("reason is null"), "classifications")
    cat = articles.put_classifications(tables.load_catalogue(spark, root, store, only), new)
    tables.save_catalogue(store, cat, ("classifications",), only)


def supplement(spark: SparkSession, root: str, landed: str) -> DataFrame:
    """Fill missing abstracts from landed responses; returns ``found, total``. Lines that are no
    responses go to ``<root>/rejected_abstracts``."""
    store = tables.catalogue_store(spark, root)
    answers = tables.staged(responses.read_abstracts(spark, landed), "abstracts")
    tables.write_table(responses.rejects(answers), f"{root}/rejected_abstracts")
    found = tables.staged(abstracts.abstract_rows(responses.good(answers)), "abstracts-found")
    only = store.buckets_of(found, "articles")
    cat = tables.load_catalogue(spark, root, store, only)
    filled = cat._replace(articles=abstracts.fill_abstracts(cat.articles, found))
    every = tables.load_catalogue(spark, root, store).articles
    tables.save_catalogue(store, filled, ("articles",), only)
    return abstracts.abstract_stats(every, found)


def enrich(
    spark: SparkSession, root: str, landed: str, fresh: bool = False, dry_run: bool = False
) -> DataFrame:
    """Resolve dataset links from landed responses; returns the proposals. Lines that are no
    responses go to ``<root>/rejected_responses``, unless this is a dry run."""
    store = tables.catalogue_store(spark, root)
    read = {
        "dataverse": responses.read_dataverse, "zenodo": responses.read_zenodo,
        "references": responses.read_references,
    }
    answers = {
        kind: tables.staged(reader(spark, f"{landed}/{kind}"), kind) for kind, reader in read.items()
    }
    proposals = tables.staged(links.propose_links(
        worklists.missing_links(tables.load_catalogue(spark, root, store), fresh),
        responses.good(answers["dataverse"]), responses.good(answers["zenodo"]),
        responses.read_publisher_pages(spark, f"{landed}/pages"),
        responses.good(answers["references"]),
    ), "proposals")
    if not dry_run:
        bad = [responses.rejects(a).withColumn("source", F.lit(k)) for k, a in answers.items()]
        tables.write_table(
            bad[0].unionByName(bad[1]).unionByName(bad[2]), f"{root}/rejected_responses"
        )
        only = store.buckets_of(proposals.where("replication_url is not null"), "classifications")
        cat = tables.load_catalogue(spark, root, store, only)
        tables.save_catalogue(store, links.apply_links(cat, proposals), ("classifications",), only)
    return proposals


def override(
    spark: SparkSession, root: str, documents: str, at: Column | None = None,
    cascade: bool = False,
) -> DataFrame:
    """Apply override documents; returns the counts. Documents that cannot be read go to
    ``<root>/rejected_documents``."""
    store = tables.catalogue_store(spark, root)
    docs = override_files.read_documents(spark, documents)
    tables.write_table(override_files.document_rejects(docs), f"{root}/rejected_documents")
    log = override_files.document_entries(docs)
    staged = tables.write_table(overrides.read_entries(log), f"{root}/staged_log")
    entries = spark.read.parquet(f"{root}/staged_log/v={staged}")
    only = store.buckets_of(entries, "articles")
    cat = tables.load_catalogue(spark, root, store, only)
    new = overrides.apply_overrides(cat, log, at, cascade, entries)
    tables.save_catalogue(store, new, only=only)
    return overrides.override_stats(cat, log, entries)


def normalize_countries(spark: SparkSession, root: str, geo_path: str) -> DataFrame:
    """Re-normalize stored country names; returns ``updated, total``."""
    geo = geography.read_geography(spark, geo_path)
    return rewrite_classifications(
        spark, root, lambda c: normalize.normalized_countries(c, dims.country_lookup(geo))
    )


def fix_regions(spark: SparkSession, root: str, geo_path: str) -> DataFrame:
    """Derive regions from countries; returns ``updated, total``."""
    geo = geography.read_geography(spark, geo_path)
    return rewrite_classifications(
        spark, root, lambda c: normalize.regions_from_countries(c, dims.geography_maps(geo))
    )


def fix_many_countries(
    spark: SparkSession, root: str, threshold: int = vocab.COUNTRY_THRESHOLD
) -> DataFrame:
    """Turn over-long country lists into the global region; returns ``updated, total``."""
    return rewrite_classifications(
        spark, root, lambda c: normalize.collapsed_many_countries(c, threshold)
    )


def rewrite_classifications(spark: SparkSession, root: str, change) -> DataFrame:
    """Store the rows that ``change`` alters, counting as they pass, and write their buckets."""
    store = tables.catalogue_store(spark, root)
    told = Observation("changes")
    changed = change(tables.load_catalogue(spark, root, store).classifications).observe(
        told, F.count_if("changed").alias("updated"), F.count(F.lit(1)).alias("total")
    )
    new = tables.staged(changed.where("changed").drop("changed"), "changed")
    counts = told.get
    if counts["updated"]:
        only = store.buckets_of(new, "classifications")
        cat = tables.load_catalogue(spark, root, store, only)
        rows = keyed.upsert(cat.classifications, new, ["doi"])
        tables.save_catalogue(store, cat._replace(classifications=rows), ("classifications",), only)
    return spark.createDataFrame(
        [(counts["updated"], counts["total"])], "updated BIGINT, total BIGINT"
    )


def export(spark: SparkSession, root: str, out: str) -> None:
    """Published entries as JSON lines."""
    tables.write_entries(publish.published(tables.load_catalogue(spark, root)), out)


def validate(predictions: DataFrame) -> DataFrame:
    """Golden cases against predictions: ``passed, failed, skipped, cases``."""
    cases = dims.golden_cases(predictions.sparkSession)
    return quality.scorecard(quality.golden_results(cases, predictions))


CATALOGUE_ORDER = ["-year", "title", "doi"]


def heatmap(
    entries: DataFrame, geo: DataFrame, query: str = "", continent: str | None = None,
    subregion: str | None = None, budget: int = vocab.ROW_BUDGET,
    continent_order: list[str] = vocab.CONTINENT_ORDER,
) -> DataFrame:
    """Counts of the view on screen: the world, one continent, or one sub-region.

    Row columns of the level, then the period cells, the view's peak and the heat of each cell;
    rows without entries are left out.
    """
    data = browse.search(browse.with_continents(entries, geo), query)
    if subregion is not None:
        rows = browse.subregion_countries(data, geo, CATALOGUE_ORDER).where(
            F.col("subregion") == subregion
        ).select("subregion", F.col("country").alias("row_key"), "first_seen")
    elif continent is not None:
        rows = browse.subregion_rows(data, geo, CATALOGUE_ORDER, budget).where(
            F.col("continent") == continent
        )
    else:
        rows = browse.continent_rows(data, geo, CATALOGUE_ORDER, budget, continent_order)
    return browse.with_heat(
        browse.shown_rows(rows.join(browse.count_matrix(data, geo), "row_key"))
    )
