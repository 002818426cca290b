"""Record-keeping queries on the driver tables: ingest, upsert, worklists, publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import vocab
from quire.operators import (
    abstracts, articles, classify, dims, keyed, links, normalize, publish, quality, worklists,
)
from quire.operators.articles import Catalogue
from quire.plans.tables.shapes import (
    ENTRIES_SQL, SUBREGIONS, entries, geography, joined, load, text,
)
from quire.sources import pages, responses

# Fixed stand-ins: document language -> journal.
JOURNAL_OF = {"en": "APSR", "fr": "Econometrica", "de": "AER", "es": "Elsewhere"}
JOURNAL_SQL = "CASE lang " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in JOURNAL_OF.items()) + " END"


def journal():
    lang = F.col("lang")
    out = None
    for k, v in JOURNAL_OF.items():
        out = F.when(lang == k, v) if out is None else out.when(lang == k, v)
    return out


def catalogue(spark, d) -> Catalogue:
    """Documents as articles, conversation turns as authors, labels as classifications."""
    docs = load(spark, d, "documents")
    title = F.when(
        F.col("lang") == "de", F.concat(F.lit("Erratum: "), "text")
    ).otherwise(F.col("text"))
    arts = docs.select(
        text("doc_id").alias("doi"), journal().alias("journal"), title.alias("title"),
        (F.length("lang") + F.length("source") + 1990).alias("year"),
        F.lit(None).cast("int").alias("month"),
        *[F.lit(None).cast("string").alias(c) for c in ("volume", "issue", "pages")],
        F.when(F.col("lang") != "es", F.col("text")).alias("abstract"),
    )
    people = load(spark, d, "conversations").select(
        text("conv_id").alias("doi"), F.col("turn").cast("int").alias("sequence"),
        F.col("text").alias("given"), F.col("role").alias("family"),
    )
    none = F.array().cast("array<string>")
    classes = load(spark, d, "labels").select(
        text("doc_id").alias("doi"), (F.col("quality") == 1).alias("is_hpe"),
        *[F.lit(None).cast("int").alias(c) for c in ("period_start", "period_end")],
        none.alias("regions"), none.alias("countries"),
        F.lit("b").alias("backend"), F.lit("m").alias("model"),
        F.lit(None).cast("timestamp").alias("classified_at"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("http://data/"), text("doc_id")))
        .alias("replication_url"),
    )
    return Catalogue(arts, people, classes)


ARTICLE_SQL = f"""
article AS (
  SELECT CAST(doc_id AS VARCHAR) AS doi, {JOURNAL_SQL} AS journal,
         CASE WHEN lang = 'de' THEN 'Erratum: ' ELSE '' END || text AS title, CAST(length(lang) + length(source) + 1990 AS INT) AS year,
         CASE WHEN lang <> 'es' THEN text END AS abstract, text, lang, n_chars
  FROM documents
),
cls AS (
  SELECT CAST(doc_id AS VARCHAR) AS doi, quality = 1 AS flag,
         CASE WHEN toxic = 0 THEN 'http://data/' || doc_id END AS url FROM labels
)
"""


def flatten_items(spark, d):
    """Conversation turns as landed metadata pages, parsed and flattened."""
    turns = load(spark, d, "conversations")
    item = F.struct(
        F.concat(F.lit("10.1/CONV-"), text("conv_id"), F.lit("-"), text("turn")).alias("DOI"),
        F.when(F.col("role") == "system", F.array(F.lit("<i>Review</i>")))
        .when(F.col("role") == "user", F.array("text")).alias("title"),
        F.when(F.col("turn") != 3, F.transform(
            F.split("role", "s"), lambda p: F.struct(p.alias("family"), F.lit("G").alias("given"))
        )).alias("author"),
        F.when(F.col("turn") < 2, F.lit("")).otherwise(F.col("text")).alias("abstract"),
        F.struct(F.array(F.when(
            F.col("turn") > 0, F.array(text(F.col("turn") + 1990), F.lit("7"))
        ).otherwise(F.array(text(F.col("turn") + 1990)))).alias("date-parts")).alias("published"),
        text("turn").alias("page"),
    )
    raw = F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("message")))
    raw = F.regexp_replace(raw, '"([0-9]+)"(?=[],])', "$1")  # years as JSON numbers
    lines = turns.select(raw.alias("value"), F.lit("JOP").alias("journal"))
    items = pages.page_items(pages.parse_pages(lines))
    items = items.where(articles.in_scope(F.col("item"), 1990, 1995))
    rows = articles.article_rows(items)
    return rows.select(
        "doi", "journal", "title", "year", "month", "pages", "abstract",
        joined(F.transform("authors", lambda a: F.concat(
            text(a["sequence"]), F.lit(":"), a["family"]))).alias("authors"),
    )


def author_rows(spark, d):
    """Nested authors exploded to rows with their position."""
    turns = load(spark, d, "conversations")
    nested = turns.select(
        F.concat(text("conv_id"), F.lit("-"), text("turn")).alias("doi"),
        F.transform(F.split("text", " "), lambda w, i: F.struct(
            i.cast("int").alias("sequence"), w.alias("given"), F.lit("F").alias("family")
        )).alias("authors"),
    )
    return articles.author_rows(nested)


def latest_events(spark, d):
    return keyed.latest(
        load(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value", "props"),
        ["user_id", "event_type"], [F.col("ts"), F.col("event_id")],
    ).drop("ts")


def upsert_customers(spark, d):
    """Customers replaced as whole rows by their latest order."""
    orders = load(spark, d, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    last = keyed.latest(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    new = last.select(
        F.col("o_custkey").alias("c_custkey"), F.lit("renamed").alias("c_name"),
        F.lit(None).cast("int").alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
    )
    return keyed.upsert(load(spark, d, "customer"), new, ["c_custkey"])


def replace_children(spark, d):
    """Turns of labelled conversations replaced; toxic ones get no new turn."""
    labels = load(spark, d, "labels")
    touched = labels.select(F.col("doc_id").alias("conv_id"))
    new = labels.where("toxic = 0").select(
        F.col("doc_id").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"),
        F.lit("editor").alias("role"), F.concat(F.lit("quality "), text("quality")).alias("text"),
    )
    return keyed.replace_children(load(spark, d, "conversations"), new, touched, "conv_id")


def line_keys(spark, d):
    return load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_linenumber"
    )


def orphan_lines(spark, d):
    parents = load(spark, d, "orders").where("o_orderstatus <> 'P'")
    return keyed.orphans(line_keys(spark, d), parents, "o_orderkey")


def cascade_lines(spark, d):
    parents = load(spark, d, "orders").where("o_orderstatus <> 'P'")
    return keyed.cascade_delete(line_keys(spark, d), parents, "o_orderkey")


def updated(spark, d) -> Catalogue:
    """Later versions of documents upserted, authors replaced, classifications cascaded."""
    cat = catalogue(spark, d)
    rows = load(spark, d, "events").select(
        text("user_id").alias("doi"), F.lit("JHPE").alias("journal"),
        F.concat("event_type", F.lit(" "), "props").alias("title"),
        *[F.lit(None).cast("int").alias(c) for c in ("year", "month")],
        *[F.lit(None).cast("string").alias(c) for c in ("volume", "issue", "pages", "abstract")],
        F.array(F.struct(F.lit(0).alias("sequence"), F.lit("A").alias("given"),
                         F.col("event_type").alias("family"))).alias("authors"),
        "event_id",
    )
    return articles.put_articles(cat, rows, [F.col("event_id")], cascade=True)


def put_articles(spark, d):
    out = updated(spark, d)
    flags = out.classifications.select("doi", "is_hpe")
    return out.articles.select("doi", "journal", "title").join(flags, "doi", "left")


def put_authors(spark, d):
    return updated(spark, d).authors.select("doi", "sequence", "family")


def worklist_unclassified(spark, d):
    return worklists.to_classify(catalogue(spark, d)).select("doi", "title")


def worklist_selected(spark, d):
    cat = catalogue(spark, d)
    return worklists.selected(cat.articles, cat.classifications).select("doi", "journal")


def worklist_chunks(spark, d):
    """Sizes of the request batches over all documents without an abstract."""
    todo = worklists.missing_abstracts(catalogue(spark, d).articles, size=50)
    return todo.groupBy("chunk").agg(F.count("*").alias("n"))


def link_worklist(spark, d):
    return worklists.missing_links(catalogue(spark, d)).select(
        "doi", "journal", "configured", "dv_enabled", "dv_subtree", "zen_enabled", "page_enabled"
    )


def abstracts_filled(spark, d):
    """Requests batched, answered by the documents themselves, and filled in."""
    cat = catalogue(spark, d)
    todo = worklists.missing_abstracts(cat.articles, size=50)
    source = load(spark, d, "documents").select(
        text("doc_id").alias("doi"),
        F.when(F.col("n_chars") > 500, F.struct(F.col("text").alias("abstract"))).alias("item"),
    )
    asked = todo.join(source, "doi").groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("doi", "item"))).alias("rows")
    )
    landed = asked.select(
        F.transform("rows", lambda r: r["doi"]).alias("dois"),
        F.transform("rows", lambda r: r["item"]).alias("items"),
        F.lit(1).cast("bigint").alias("attempt"),
    )
    filled = abstracts.fill_abstracts(cat.articles, abstracts.abstract_rows(landed))
    return filled.select("doi", F.md5(F.col("abstract").cast("binary")).alias("abstract_md5"))


def abstract_stats(spark, d):
    cat = catalogue(spark, d)
    found = load(spark, d, "labels").select(text("doc_id").alias("doi"))
    return abstracts.abstract_stats(cat.articles, found)


def publish_catalogue(spark, d):
    return publish.published(catalogue(spark, d)).select(
        "doi", "title", "journal", "year", "abstract", "replication_url", "authors"
    )


def author_lines(spark, d):
    return publish.author_lines(catalogue(spark, d).authors)


def regions_from_countries(spark, d):
    """Orders tagged with the customer's sub-region, corrected by their suppliers' nations."""
    geo = geography(spark, d)
    customer = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = load(spark, d, "orders").select(text("o_orderkey").alias("doi"), "o_custkey")
    stored = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(geo.select("pos", "subregion"), F.col("c_nationkey") == F.col("pos"))
        .select("doi", F.array("subregion").alias("regions"))
    )
    rows = stored.join(entries(spark, d).select("doi", "countries"), "doi")
    out = normalize.regions_from_countries(rows, dims.geography_maps(geo), SUBREGIONS)
    return out.select("doi", joined("regions").alias("regions"), "changed")


def many_countries(spark, d):
    out = normalize.collapsed_many_countries(entries(spark, d), threshold=6)
    return out.select(
        "doi", F.size("countries").cast("bigint").alias("n_countries"),
        joined(F.array_sort("regions")).alias("regions"), "changed",
    )


def dirty_countries(spark, d):
    """Entries with lower-cased names where the year is after 1998."""
    late = F.col("year") > 1998
    return entries(spark, d).withColumn("countries", F.when(
        late, F.transform("countries", lambda c: F.lower(c))
    ).otherwise(F.col("countries")))


def country_names(spark, d):
    geo = geography(spark, d)
    aliases = geo.select(F.concat(F.lit("Old "), "name").alias("name"), F.col("name").alias("target"))
    out = normalize.normalized_countries(
        dirty_countries(spark, d), dims.country_lookup(geo, aliases)
    )
    return out.select("doi", joined(F.array_sort("countries")).alias("countries"), "changed")


def normalize_stats(spark, d):
    geo = geography(spark, d)
    return normalize.changes(
        normalize.normalized_countries(dirty_countries(spark, d), dims.country_lookup(geo))
    )


def golden_scorecard(spark, d):
    cases = load(spark, d, "labels").select(
        text("doc_id").alias("doi"), F.lit("case").alias("label"),
        (F.col("quality") == 1).alias("expected"),
    )
    got = load(spark, d, "documents").where("lang <> 'es'").select(
        text("doc_id").alias("doi"), (F.col("n_chars") > 1000).alias("is_hpe")
    )
    return quality.scorecard(quality.golden_results(cases, got))


def coverage(spark, d):
    cat = catalogue(spark, d)
    return quality.coverage(cat.articles, cat.authors)


def link_apply(spark, d):
    """Links found for flagged documents written back; others keep theirs."""
    cat = catalogue(spark, d)
    todo = worklists.missing_links(cat).where("configured")
    proposals = todo.select("doi", F.when(
        F.col("journal") != "AER", F.concat(F.lit("http://found/"), "doi")
    ).alias("replication_url"))
    return links.apply_links(cat, proposals).classifications.select(
        "doi", "is_hpe", "replication_url"
    )


def link_stats(spark, d):
    cat = catalogue(spark, d)
    todo = worklists.missing_links(cat)
    proposals = todo.where("configured").select("doi", F.when(
        F.col("journal") != "AER", F.lit("u")).alias("replication_url"))
    return links.link_stats(todo, proposals)


def message_requests(spark, d):
    rows = classify.message_requests(
        worklists.to_classify(catalogue(spark, d), fresh=True), "model-1", "Tag the article."
    )
    at = lambda p: F.get_json_object("value", p)
    return rows.select(
        at("$.custom_id").alias("custom_id"), at("$.params.model").alias("model"),
        at("$.params.system").alias("system"), at("$.params.max_tokens").alias("max_tokens"),
        F.md5(at("$.params.messages[0].content").cast("binary")).alias("content_md5"),
    )


def chat_requests(spark, d):
    rows = classify.chat_requests(
        worklists.to_classify(catalogue(spark, d)), "model-1", "Tag the article."
    )
    at = lambda p: F.get_json_object("value", p)
    return rows.select(
        at("$.custom_id").alias("custom_id"), at("$.url").alias("url"),
        at("$.body.messages[0].content").alias("system"),
        at("$.body.response_format.type").alias("format"),
        F.md5(at("$.body.messages[1].content").cast("binary")).alias("content_md5"),
    )


def reclassify(spark, d):
    """Message replies for every document, read back by id and put over the labels."""
    cat = catalogue(spark, d)
    reply = F.when(F.col("lang") == "es", F.lit("I cannot say.")).otherwise(F.concat(
        F.lit('Here: {"is_hpe": '), F.when(F.col("n_chars") > 1000, "true").otherwise("false"),
        F.lit(', "period_start": '), text("n_chars"), F.lit(', "regions": ["North America"]}'),
    ))
    block = F.struct(F.lit("text").alias("type"), reply.alias("text"))
    status = F.when(F.col("lang") == "de", "errored").otherwise("succeeded")
    result = F.struct(
        status.alias("type"), F.struct(F.array(block).alias("content")).alias("message")
    )
    lines = load(spark, d, "documents").select(F.to_json(F.struct(
        classify.request_id(text("doc_id")).alias("custom_id"), result.alias("result")
    )).alias("value"))
    replies = classify.resolve_dois(
        responses.message_replies(lines), classify.request_map(cat.articles)
    )
    new = classify.classified(
        replies, dims.country_lookup(geography(spark, d)), "b2", "m2", F.lit(None).cast("timestamp")
    )
    return articles.put_classifications(cat, new).classifications.select(
        "doi", "is_hpe", "period_start", joined("regions").alias("regions"), "backend",
        "replication_url",
    )


QUERIES = {f.__name__: f for f in (
    flatten_items, author_rows, latest_events, upsert_customers, replace_children, orphan_lines,
    cascade_lines, put_articles, put_authors, worklist_unclassified, worklist_selected, worklist_chunks,
    link_worklist, abstracts_filled, abstract_stats, publish_catalogue, author_lines,
    regions_from_countries, many_countries, country_names, normalize_stats, golden_scorecard,
    coverage, link_apply, link_stats, message_requests, chat_requests, reclassify,
)}

NEW_SQL = """
new AS (SELECT CAST(user_id AS VARCHAR) AS doi, event_type || ' ' || props AS title, event_type
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
"""
PROMPT_SQL = (
    "'Title: ' || title || chr(10) || 'Abstract: ' || coalesce(abstract, "
    f"'{vocab.NO_ABSTRACT}')"
)
TODO_SQL = f"""WITH {ARTICLE_SQL},
todo AS (
  SELECT doi, journal, journal IN ('APSR', 'Econometrica', 'AER') AS configured
  FROM article JOIN cls USING (doi) WHERE flag AND url IS NULL
)
"""
DIRTY_SQL = f"""WITH {ENTRIES_SQL},
dirty AS (
  SELECT e.k, doi, CASE WHEN year > 1998 THEN lower(country) ELSE country END AS name
  FROM entry e LEFT JOIN entry_country USING (k)
)
"""

SQL = {
    "flatten_items": """
        SELECT '10.1/conv-' || conv_id || '-' || turn AS doi, 'JOP' AS journal,
               CASE WHEN role = 'user' THEN text END AS title,
               CAST(1990 + turn AS INT) AS year, CASE WHEN turn > 0 THEN 7 END AS month,
               CAST(turn AS VARCHAR) AS pages, CASE WHEN turn >= 2 THEN text END AS abstract,
               list_aggregate(list_transform(string_split(role, 's'),
                 lambda x, i: (i - 1) || ':' || x), 'string_agg', '|') AS authors
        FROM conversations WHERE role <> 'system' AND turn <> 3 AND turn <= 5""",
    "author_rows": """
        SELECT conv_id || '-' || turn AS doi, CAST(i - 1 AS INT) AS sequence, w[i] AS given,
               'F' AS family
        FROM (SELECT *, string_split(text, ' ') AS w FROM conversations) t,
             LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)""",
    "latest_events": """
        SELECT user_id, event_type, event_id, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_customers": """
        WITH new AS (
          SELECT o_custkey AS c_custkey, 'renamed' AS c_name, CAST(NULL AS INT) AS c_nationkey,
                 o_totalprice AS c_acctbal, o_orderpriority AS c_mktsegment FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
        SELECT * FROM new UNION ALL
        SELECT * FROM customer c WHERE NOT EXISTS (
          SELECT 1 FROM new n WHERE n.c_custkey = c.c_custkey)""",
    "replace_children": """
        SELECT * FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL SELECT doc_id, 0, 'editor', 'quality ' || quality FROM labels WHERE toxic = 0""",
    "orphan_lines": """
        SELECT l_orderkey AS o_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey
                          AND o_orderstatus <> 'P')""",
    "cascade_lines": """
        SELECT l_orderkey AS o_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
    "put_articles": f"""WITH {ARTICLE_SQL}, {NEW_SQL}
        SELECT doi, 'JHPE' AS journal, title, CAST(NULL AS BOOLEAN) AS is_hpe FROM new
        UNION ALL
        SELECT doi, journal, title, flag FROM article LEFT JOIN cls USING (doi)
        WHERE doi NOT IN (SELECT doi FROM new)""",
    "put_authors": f"""WITH {NEW_SQL}
        SELECT doi, 0 AS sequence, event_type AS family FROM new
        UNION ALL
        SELECT CAST(conv_id AS VARCHAR), CAST(turn AS INT), role FROM conversations
        WHERE CAST(conv_id AS VARCHAR) NOT IN (SELECT doi FROM new)""",
    "worklist_unclassified": f"""WITH {ARTICLE_SQL}
        SELECT doi, title FROM article a
        WHERE NOT EXISTS (SELECT 1 FROM cls c WHERE c.doi = a.doi)""",
    "worklist_selected": f"""WITH {ARTICLE_SQL}
        SELECT doi, journal FROM article WHERE doi IN (SELECT doi FROM cls)""",
    "worklist_chunks": """
        SELECT (r - 1) // 50 AS chunk, count(*) AS n
        FROM (SELECT row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE lang = 'es')
        GROUP BY 1""",
    "link_worklist": f"""{TODO_SQL}
        SELECT doi, journal, configured, journal = 'APSR' AS dv_enabled,
               CASE WHEN journal = 'APSR' THEN 'the_review' END AS dv_subtree,
               journal = 'Econometrica' AS zen_enabled, journal = 'Econometrica' AS page_enabled
        FROM todo""",
    "abstracts_filled": f"""WITH {ARTICLE_SQL}
        SELECT doi, md5(CASE WHEN abstract IS NULL AND n_chars > 500 THEN text ELSE abstract END)
          AS abstract_md5 FROM article""",
    "abstract_stats": f"""WITH {ARTICLE_SQL}
        SELECT count(c.doi) AS found, count(*) AS total
        FROM article a LEFT JOIN cls c USING (doi) WHERE abstract IS NULL""",
    "publish_catalogue": f"""WITH {ARTICLE_SQL},
        line AS (
          SELECT CAST(conv_id AS VARCHAR) AS doi, string_agg(
            CASE WHEN text <> '' THEN role || ', ' || substr(text, 1, 1) || '.' ELSE role END,
            '; ' ORDER BY turn) AS authors FROM conversations WHERE role <> '' GROUP BY 1)
        SELECT doi, title, journal, year, abstract, url AS replication_url,
               coalesce(authors, '') AS authors
        FROM article JOIN cls USING (doi) LEFT JOIN line USING (doi)
        WHERE flag AND url IS NOT NULL
          AND NOT regexp_matches(lower(title), 'corrigendum|erratum|errata|retraction|retracted')""",
    "author_lines": """
        SELECT CAST(conv_id AS VARCHAR) AS doi, string_agg(
          CASE WHEN text <> '' THEN role || ', ' || substr(text, 1, 1) || '.' ELSE role END,
          '; ' ORDER BY turn) AS authors FROM conversations WHERE role <> '' GROUP BY 1""",
    "regions_from_countries": f"""WITH {ENTRIES_SQL},
        stored AS (
          SELECT o_orderkey AS k, subregion AS region FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = pos),
        derived AS (
          SELECT k, string_agg(DISTINCT subregion, '|' ORDER BY subregion) AS regions
          FROM entry_country JOIN geo ON name = country GROUP BY k)
        SELECT doi, coalesce(regions, region) AS regions,
               coalesce(regions <> region, false) AS changed
        FROM stored JOIN entry USING (k) LEFT JOIN derived USING (k)""",
    "many_countries": f"""WITH {ENTRIES_SQL}
        SELECT doi, CASE WHEN n > 6 THEN 0 ELSE n END AS n_countries,
               CASE WHEN n > 6 THEN 'Global/Comparative' ELSE regions END AS regions,
               n > 6 AS changed
        FROM (SELECT doi, (SELECT count(*) FROM entry_country c WHERE c.k = e.k) AS n,
                     coalesce((SELECT string_agg(region, '|' ORDER BY region)
                      FROM entry_region r WHERE r.k = e.k), '') AS regions FROM entry e)""",
    "country_names": f"""{DIRTY_SQL},
        clean AS (
          SELECT d.*, coalesce(a.name, b.name, c.name, d.name) AS good FROM dirty d
          LEFT JOIN geo a ON a.name = d.name
          LEFT JOIN geo b ON 'Old ' || b.name = d.name
          LEFT JOIN geo c ON lower(c.name) = d.name)
        SELECT doi, coalesce(string_agg(good, '|' ORDER BY good), '') AS countries,
               coalesce(bool_or(good <> name), false) AS changed FROM clean GROUP BY doi""",
    "normalize_stats": f"""{DIRTY_SQL}
        SELECT count(DISTINCT doi) FILTER (WHERE g.name <> d.name) AS updated,
               count(DISTINCT doi) AS total
        FROM dirty d LEFT JOIN geo g ON lower(g.name) = d.name""",
    "golden_scorecard": """
        SELECT count(*) FILTER (WHERE got = expected) AS passed,
               count(*) FILTER (WHERE got <> expected) AS failed,
               count(*) FILTER (WHERE got IS NULL) AS skipped, count(*) AS cases
        FROM (SELECT quality = 1 AS expected, n_chars > 1000 AS got FROM labels l
              LEFT JOIN documents d ON d.doc_id = l.doc_id AND lang <> 'es')""",
    "coverage": f"""WITH {ARTICLE_SQL}
        SELECT journal, count(*) AS articles, count(abstract) AS with_abstract,
               CAST(coalesce(sum(n), 0) AS BIGINT) AS authors
        FROM article LEFT JOIN (SELECT CAST(conv_id AS VARCHAR) AS doi, count(*) AS n
                                FROM conversations GROUP BY 1) USING (doi) GROUP BY journal""",
    "link_apply": f"""{TODO_SQL}
        SELECT doi, flag AS is_hpe, CASE WHEN t.configured AND t.journal <> 'AER'
          THEN 'http://found/' || doi ELSE url END AS replication_url
        FROM cls LEFT JOIN todo t USING (doi)""",
    "link_stats": f"""{TODO_SQL}
        SELECT count(*) FILTER (WHERE configured AND journal <> 'AER') AS found,
               count(*) AS total FROM todo""",
    "message_requests": f"""WITH {ARTICLE_SQL}
        SELECT sha256(doi) AS custom_id, 'model-1' AS model, 'Tag the article.' AS system,
               '512' AS max_tokens, md5({PROMPT_SQL}) AS content_md5 FROM article""",
    "chat_requests": f"""WITH {ARTICLE_SQL}
        SELECT sha256(doi) AS custom_id, '/v1/chat/completions' AS url,
               'Tag the article.' AS system, 'json_object' AS format,
               md5({PROMPT_SQL}) AS content_md5 FROM article
        WHERE doi NOT IN (SELECT doi FROM cls)""",
    "reclassify": f"""WITH {ARTICLE_SQL}
        SELECT doi, n_chars > 1000 AS is_hpe, CAST(n_chars AS INT) AS period_start,
               'Northern America' AS regions, 'b2' AS backend,
               CAST(NULL AS VARCHAR) AS replication_url
        FROM article WHERE lang IN ('en', 'fr')
        UNION ALL
        SELECT doi, flag, NULL, '', 'b', url FROM cls
        WHERE doi NOT IN (SELECT doi FROM article WHERE lang IN ('en', 'fr'))""",
}
