"""Queries over landed files and rejects: the driver tables written as files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import schemas, vocab
from quire.operators import classify, dims, keyed, normalize, publish
from quire.plans import jobs
from quire.plans.tables import edits, records
from quire.plans.tables.shapes import (
    ENTRIES_SQL, GEO_SQL, SUBREGIONS, entries, geography, joined, load, text,
)
from quire.sources import geography as geography_file
from quire.sources import overrides, pages, responses, tables
from quire.streaming import jobs as streams
from quire.plans.tables.edits import _forms_of, event_pages, event_stream


def as_files(spark, rows, name):
    """One text column written as lines to a fresh folder; the folder."""
    folder = tables.scratch(spark, name)
    rows.write.text(folder)
    return folder


def page_rejects(spark, d):
    """Events as landed page lines: some cut off, some with a year as text."""
    kind = F.col("event_type")
    year = F.when(kind == "signup", F.lit('"n.d."')).otherwise(text(F.year("ts")))
    page = F.concat(
        F.lit('{"message": {"items": [{"DOI": "10.1/'), text("event_id"),
        F.lit('", "published": {"date-parts": [['), year, F.lit("]]}}]}}"),
    )
    line = F.when(kind == "error", F.substring(page, 1, 40)).otherwise(page)
    folder = tables.scratch(spark, "pages")
    lines = load(spark, d, "events").select(line.alias("value"), F.lit("JOP").alias("journal"))
    lines.write.partitionBy("journal").text(folder)
    rejects = pages.page_rejects(pages.read_pages(spark, folder))
    return rejects.groupBy("line_text").agg(F.count("*").alias("n"))


def reply_join_rejects(spark, d):
    """Events as reply lines: cut off, of an unknown id, failed, no object, and good ones."""
    kind = F.col("event_type")
    doi = F.when(kind == "signup", F.concat(F.lit("who/"), text("event_id"))).otherwise(text("user_id"))
    said = F.when(F.col("value") > 50, "no idea").otherwise('{\\"is_hpe\\": true}')
    line = F.concat(
        F.lit('{"custom_id": "'), classify.request_id(doi), F.lit('", "result": {"type": "'),
        F.when(kind == "view", "errored").otherwise("succeeded"),
        F.lit('", "message": {"content": [{"type": "text", "text": "'), said, F.lit('"}]}}}'),
    )
    lines = load(spark, d, "events").select(
        F.when(kind == "error", F.substring(line, 1, 60)).otherwise(line).alias("value")
    )
    asked = load(spark, d, "events").select(text("user_id").alias("doi")).distinct()
    replies = classify.resolve_dois(
        responses.read_message_replies(spark, as_files(spark, lines, "replies")),
        classify.request_map(asked),
    )
    return classify.rejected(replies).groupBy("reason").agg(F.count("*").alias("n"))


def _documents(spark, d):
    segment = F.col("c_mktsegment")
    entry = F.to_json(F.struct(text("c_custkey").alias("doi"), F.col("c_name").alias("title")))
    good = F.concat(F.lit('{"corrections": ['), entry, F.lit(", "), entry, F.lit('], "additions": []}'))
    value = (
        F.when(segment == "BUILDING", F.substring(good, 1, 30))
        .when(segment == "MACHINERY", F.lit('{"corrections": {}}'))
        .when(segment == "HOUSEHOLD", F.lit("[]")).otherwise(good)
    )
    return load(spark, d, "customer").select(value.alias("value"), text("c_custkey").alias("path"))


def document_rejects(spark, d):
    return overrides.document_rejects(_documents(spark, d))


def document_entries(spark, d):
    """Every entry has a position of its own, in the order of the documents."""
    return overrides.document_entries(_documents(spark, d)).select("list", "pos", "doi")


def stream_rejects(spark, d):
    """Streamed issue forms that cannot be used, next to the log."""
    log, check = tables.scratch(spark, "log"), tables.scratch(spark, "log-checkpoint")
    forms = _forms_of(event_stream(spark, d))
    kind = F.when(F.col("type") == "new-entry", "correction").otherwise("other")
    streams.issue_stream(forms.withColumn("type", kind), log, check).awaitTermination()
    return streams.read_rejects(spark, log).select("pos", "reason")


def unrecognised_names(spark, d):
    return dims.unrecognised(
        entries(spark, d), geography(spark, d), valid=SUBREGIONS[1:]
    )


# Fixed stand-ins: a geography with everyday names, and spellings of its countries.
EVERYDAY = [("Iran", "IRN"), ("Vietnam", "VNM"), ("South Korea", "KOR"), ("DR Congo", "COD"),
            ("United Kingdom", "GBR")]
SPELLED = [
    ("BUILDING", "Iran", "Iran, Islamic Republic of", "irn"),
    ("MACHINERY", "Viet Nam", "Vietnam", "vietnam"),
    ("HOUSEHOLD", "Korea, Republic of", "South Korea", "korea, republic of"),
    ("AUTOMOBILE", "DRC", "Congo, The Democratic Republic of the", "DR Congo"),
    ("FURNITURE", "Scotland", "England", "gbr"),
]


def mixed_spellings(spark, d):
    """Customers by country, each under one of three spellings: one row per country."""
    geo = dims.fixed_table(
        spark, [(i, *g, "Asia", "Eastern Asia") for i, g in enumerate(EVERYDAY)],
        "pos INT, name STRING, alpha3 STRING, continent STRING, subregion STRING",
    )
    spelled = dims.fixed_table(spark, SPELLED, "segment STRING, a STRING, b STRING, c STRING")
    rows = load(spark, d, "customer").join(spelled, F.col("c_mktsegment") == F.col("segment"))
    name = F.when(F.col("c_nationkey") < 8, F.col("a")).when(F.col("c_nationkey") < 16, F.col("b"))
    named = rows.select(F.array(name.otherwise(F.col("c"))).alias("countries"))
    clean = normalize.normalized_countries(named, dims.country_lookup(geo))
    return clean.groupBy(F.col("countries")[0].alias("country")).agg(F.count("*").alias("n"))


def stored_customers(spark, d):
    """A table written twice as snapshots and read back: the newest counts."""
    root = tables.scratch(spark, "articles")
    cust = load(spark, d, "customer")
    for mark in ("old", "new"):
        rows = cust.select(
            text("c_custkey").alias("doi"), F.lit("JOP").alias("journal"),
            F.concat(F.lit(f"{mark} "), "c_name").alias("title"), F.lit(1990).alias("year"),
            F.lit(None).cast("int").alias("month"),
            *[F.lit(None).cast("string").alias(c) for c in ("volume", "issue", "pages", "abstract")],
        )
        tables.write_table(rows, root)
    return tables.read_table(spark, root, schemas.ARTICLE).select("doi", "title", "year")


def _customer_articles(rows, title):
    blank = {c: F.lit(None).cast("string") for c in ("volume", "issue", "pages", "abstract")}
    return rows.select(text("c_custkey").alias("doi"), title.alias("title")).withColumns({
        **blank, "journal": F.lit("JOP"), "year": F.lit(1990), "month": F.lit(None).cast("int"),
    }).select(*schemas.names(schemas.ARTICLE))


def bucketed_customers(spark, d):
    """A bucketed table changed twice: customers with orders get a new title and one child row each,
    in one step; then customers in debt lose their title. Read back as of the last manifest."""
    cust = load(spark, d, "customer")
    store = tables.catalogue_store(spark, tables.scratch(spark, "bucketed"))
    store = store.commit({"articles": _customer_articles(cust, F.col("c_name"))})
    buyers = cust.join(load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")),
                       "c_custkey", "left_semi")
    busy = _customer_articles(buyers, F.concat(F.lit("busy "), "c_name"))
    only = store.buckets_of(busy, "articles")
    people = busy.select("doi", F.lit(0).alias("sequence"), F.lit("G").alias("given"),
                         F.col("title").alias("family"))
    store = store.commit({
        "articles": keyed.upsert(store.read("articles", only), busy, ["doi"]),
        "authors": keyed.replace_children(store.read("authors", only), people, busy, "doi"),
    }, only)
    debt = _customer_articles(cust.where("c_acctbal < -900"), F.lit(None).cast("string"))
    only = store.buckets_of(debt, "articles")
    store = store.commit(
        {"articles": keyed.upsert(store.read("articles", only), debt, ["doi"])}, only
    )
    return store.read("articles").select("doi", "title", "year").join(
        store.read("authors").select("doi", "family"), "doi", "left"
    )


def merged_pages(spark, d):
    """Events streamed as pages by two runs, the later half of the day first, and merged after each:
    whatever is merged last, the page that landed last counts."""
    out, root = tables.scratch(spark, "pages"), tables.scratch(spark, "merged")
    stream = event_stream(spark, d)
    for when in (F.hour("ts") >= 12, F.hour("ts") < 12):
        check = tables.scratch(spark, "pages-checkpoint")
        rows = event_pages(stream.where(when))
        streams.flatten_stream(rows, out, check).awaitTermination()
        jobs.merge_landed(spark, root, out)
    cat = tables.load_catalogue(spark, root)
    people = cat.authors.select("doi", F.col("family").alias("author"))
    return cat.articles.select("doi", "title", "year", "month", "pages", "abstract").join(people, "doi")


def response_rejects(spark, d):
    """Events as landed response lines, some cut off, some without a key, of all four kinds."""
    kind = F.col("event_type")
    doi = F.when(kind != "signup", F.concat(F.lit("10.1/"), text("event_id")))

    def lines(key, *rest):
        row = F.struct(key, *rest)
        whole = F.to_json(row)
        return load(spark, d, "events").select(
            F.when(kind == "error", F.substring(whole, 1, 9)).otherwise(whole).alias("value")
        )

    status = F.lit(200).alias("status")
    answers = {
        "abstracts": lambda p: responses.read_abstracts(spark, p),
        "dataverse": lambda p: responses.read_dataverse(spark, p),
        "zenodo": lambda p: responses.read_zenodo(spark, p),
        "references": lambda p: responses.read_references(spark, p),
    }
    out = None
    for name, read in answers.items():
        key = F.when(kind != "signup", F.array(doi)).alias("dois") if name == "abstracts" else doi.alias("doi")
        answer = tables.staged(read(as_files(spark, lines(key, status), name)), name)
        told = responses.rejects(answer).groupBy("reason").agg(F.count("*").alias("n")).unionByName(
            responses.good(answer).agg(F.lit("good").alias("reason"), F.count("*").alias("n"))
        ).select(F.lit(name).alias("kind"), "reason", "n")
        out = told if out is None else out.unionByName(told)
    return out


def landed_records(spark, d):
    """Events as landed search responses of the second repository."""
    hit = F.struct(
        F.struct(F.concat(F.lit("z:"), text("event_id")).alias("html")).alias("links"),
        F.struct(F.col("event_type").alias("title")).alias("metadata"),
    )
    hits = F.when(F.col("value") > 50, F.array(hit, hit)).when(F.col("value") > 20, F.array(hit))
    row = F.struct(
        text("event_id").alias("doi"), F.lit("field").alias("step"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.struct(F.struct(hits.alias("hits")).alias("hits")).alias("body"),
    )
    lines = load(spark, d, "events").select(F.to_json(row).alias("value"))
    return responses.good(responses.read_zenodo(spark, as_files(spark, lines, "records"))).select(
        "doi", "ok", F.col("n_hits").cast("bigint").alias("n_hits"), "url"
    )


def reply_unknown_names(spark, d):
    """Documents as replies that name their source as a region and their language as a country: what
    the geography of nations doesn't know, reported for each reply."""
    reply = F.to_json(F.struct(
        F.array("source", F.lit(SUBREGIONS[1])).alias("regions"),
        F.array("lang", F.lit("NATION_1"), "lang").alias("countries"),
    ))
    replies = load(spark, d, "documents").select(text("doc_id").alias("doi"), reply.alias("raw"))
    return classify.unknown_names(replies, geography(spark, d), valid=SUBREGIONS[1:])


def published_file(spark, d):
    """The published entries as a file of JSON lines in catalogue order, read for browsing."""
    folder = tables.scratch(spark, "entries")
    tables.write_entries(publish.published(records.catalogue(spark, d)), folder)
    return tables.read_entries(spark, folder).select(
        "doi", "title", "journal", "year", "abstract", "replication_url", "authors"
    )


def geography_document(spark, d):
    """The geography written as one document and read back, with positions in list order."""
    rows = geography(spark, d).select("pos", F.struct("name", "alpha3", "continent", "subregion").alias("c"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"])
    one = rows.agg(F.to_json(F.struct(listed.alias("countries"))).alias("value"))
    return geography_file.read_geography(spark, as_files(spark, one, "geography")).select(
        F.col("pos").cast("bigint").alias("pos"), "name", "alpha3", "continent", "subregion"
    )


def journal_issns(spark, d):
    """Documents by journal, with its registered number."""
    return load(spark, d, "documents").select(records.journal().alias("journal")).join(
        dims.journals(spark), "journal", "left"
    ).groupBy("journal", "issn").agg(F.count("*").alias("n"))


def landed_hits(spark, d):
    """Events as landed search responses of the first repository."""
    body = F.struct(F.struct(F.when(F.col("value") > 20, F.array(F.struct(
        F.concat(F.lit("u:"), text("event_id")).alias("url"), F.col("event_type").alias("name")
    ))).alias("items")).alias("data"))
    row = F.struct(
        text("event_id").alias("doi"), F.lit("title").alias("step"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), body.alias("body"),
    )
    lines = load(spark, d, "events").select(F.to_json(row).alias("value"))
    return responses.read_dataverse(spark, as_files(spark, lines, "hits")).select(
        "doi", "ok", F.col("n_hits").cast("bigint").alias("n_hits"), "url"
    )


def landed_references(spark, d):
    """Documents as landed reference lists."""
    listed = F.array(
        F.struct(F.col("text").alias("unstructured")),
        F.struct(F.concat(F.lit("Data 10.3886/E"), text("doc_id"), F.lit("V1.")).alias("unstructured")),
    )
    row = F.struct(
        text("doc_id").alias("doi"), F.when(F.col("lang") == "es", 404).otherwise(200).alias("status"),
        F.struct(F.struct(listed.alias("reference")).alias("message")).alias("body"),
    )
    lines = load(spark, d, "documents").select(F.to_json(row).alias("value"))
    return responses.read_references(spark, as_files(spark, lines, "references")).select(
        "doi", joined(F.transform("candidates", lambda c: c["repo"])).alias("repos")
    )


def migrated(spark, d):
    """An old table brought to the current columns, with a default and empty ones."""
    old = load(spark, d, "customer").select(
        text("c_custkey").alias("doi"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("journal"),
        F.col("c_mktsegment").alias("gone"),
    )
    new = keyed.with_columns_from(old, schemas.ARTICLE, {"journal": F.lit("Unpublished"), "year": F.lit(1990)})
    return new.select("doi", "journal", "year", "month", "abstract")


QUERIES = {f.__name__: f for f in (
    page_rejects, reply_join_rejects, document_rejects, document_entries, stream_rejects,
    unrecognised_names, mixed_spellings, stored_customers, published_file, geography_document,
    journal_issns, landed_hits, landed_references, migrated, bucketed_customers, merged_pages,
    response_rejects, landed_records, reply_unknown_names,
)}

_JOURNALS = ", ".join(f"('{k}', '{v}')" for k, v in vocab.JOURNALS.items())

SQL = {
    "page_rejects": """
        SELECT CASE WHEN event_type = 'error' THEN substr(page, 1, 40) ELSE page END AS line_text,
               count(*) AS n
        FROM (SELECT event_type, '{"message": {"items": [{"DOI": "10.1/' || event_id
              || '", "published": {"date-parts": [["n.d."]]}}]}}' AS page
              FROM events WHERE event_type = 'signup'
              UNION ALL SELECT event_type, '{"message": {"items": [{"DOI": "10.1/' || event_id
              || '", "published": {"date-parts": [[1990]]}}]}}' FROM events WHERE event_type = 'error')
        GROUP BY 1""",
    "reply_join_rejects": """
        SELECT CASE WHEN event_type = 'error' THEN 'unreadable line'
                    WHEN event_type = 'view' THEN 'errored'
                    WHEN event_type = 'signup' THEN 'unknown request id'
                    ELSE 'not a JSON object' END AS reason, count(*) AS n
        FROM events WHERE event_type IN ('error', 'view', 'signup') OR value > 50 GROUP BY 1""",
    "document_rejects": """
        SELECT CAST(c_custkey AS VARCHAR) AS path,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'not JSON'
                 WHEN 'MACHINERY' THEN 'corrections is not a list' ELSE 'not a JSON object' END AS reason
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
    "document_entries": """
        SELECT 'corrections' AS list,
               2 * (row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1) + i AS pos,
               CAST(c_custkey AS VARCHAR) AS doi
        FROM (SELECT * FROM customer
              WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')) c,
             (VALUES (0)) t(i)
        UNION ALL
        SELECT 'corrections', 2 * (row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1) + 1,
               CAST(c_custkey AS VARCHAR)
        FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
    "stream_rejects": """
        SELECT event_id AS pos, 'unknown type' AS reason FROM events WHERE event_type <> 'purchase'""",
    "unrecognised_names": f"""WITH {ENTRIES_SQL}
        SELECT 'country' AS kind, country AS name, count(*) AS n FROM entry_country
        WHERE country LIKE 'Old %' GROUP BY country
        UNION ALL SELECT 'region', region, count(*) FROM entry_region
        WHERE region IN ('{SUBREGIONS[0]}', '{vocab.GLOBAL}') GROUP BY region""",
    "mixed_spellings": """
        SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'Iran' WHEN 'MACHINERY' THEN 'Vietnam'
                 WHEN 'HOUSEHOLD' THEN 'South Korea' WHEN 'AUTOMOBILE' THEN 'DR Congo'
                 ELSE 'United Kingdom' END AS country, count(*) AS n FROM customer GROUP BY 1""",
    "stored_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS doi, 'new ' || c_name AS title, 1990 AS year FROM customer""",
    "published_file": records.SQL["publish_catalogue"],
    "geography_document": f"""WITH {GEO_SQL}
        SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, name, 'X' || pos AS alpha3, continent,
               subregion FROM geo""",
    "journal_issns": f"""
        SELECT journal, issn, count(*) AS n
        FROM (SELECT {records.JOURNAL_SQL} AS journal FROM documents)
        LEFT JOIN (VALUES {_JOURNALS}) t(journal, issn) USING (journal) GROUP BY ALL""",
    "bucketed_customers": """
        WITH busy AS (SELECT DISTINCT o_custkey AS c_custkey, true AS busy FROM orders)
        SELECT CAST(c_custkey AS VARCHAR) AS doi, 1990 AS year,
               CASE WHEN c_acctbal < -900 THEN NULL WHEN busy THEN 'busy ' || c_name ELSE c_name END AS title,
               CASE WHEN busy THEN 'busy ' || c_name END AS family
        FROM customer LEFT JOIN busy USING (c_custkey)""",
    "merged_pages": edits.SQL["stream_pages"],
    "response_rejects": """
        SELECT kind, reason, count(*) AS n FROM (
          SELECT CASE WHEN event_type = 'error' THEN 'unreadable line'
                      WHEN event_type <> 'signup' THEN 'good'
                      WHEN kind = 'abstracts' THEN 'no dois' ELSE 'no doi' END AS reason, kind
          FROM events, (VALUES ('abstracts'), ('dataverse'), ('zenodo'), ('references')) t(kind))
        GROUP BY ALL""",
    "landed_records": """
        SELECT CAST(event_id AS VARCHAR) AS doi, event_type <> 'error' AS ok,
               CAST(CASE WHEN value > 50 THEN 2 WHEN value > 20 THEN 1 ELSE 0 END AS BIGINT) AS n_hits,
               CASE WHEN value > 20 THEN 'z:' || event_id END AS url FROM events""",
    "reply_unknown_names": f"""
        SELECT CAST(doc_id AS VARCHAR) AS doi, 'region' AS kind, source AS name FROM documents
        WHERE source <> '' AND source NOT IN ({", ".join(f"'{s}'" for s in SUBREGIONS[1:])})
        UNION ALL
        SELECT CAST(doc_id AS VARCHAR), 'country', lang FROM documents
        WHERE lang <> '' AND lower(lang) NOT IN (SELECT lower(n_name) FROM nation)""",
    "landed_hits": """
        SELECT CAST(event_id AS VARCHAR) AS doi, event_type <> 'error' AS ok,
               CAST(CASE WHEN value > 20 THEN 1 ELSE 0 END AS BIGINT) AS n_hits,
               CASE WHEN value > 20 THEN 'u:' || event_id END AS url FROM events""",
    "landed_references": """
        SELECT CAST(doc_id AS VARCHAR) AS doi,
               CASE WHEN lang <> 'es' THEN '10.3886/E' || doc_id || 'V1' END AS repos FROM documents""",
    "migrated": """
        SELECT CAST(c_custkey AS VARCHAR) AS doi,
               CASE WHEN c_acctbal > 0 THEN c_name ELSE 'Unpublished' END AS journal, 1990 AS year,
               CAST(NULL AS INT) AS month, CAST(NULL AS VARCHAR) AS abstract FROM customer""",
}
