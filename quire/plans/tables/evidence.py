"""Text, link and model-reply queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import names
from quire.functions import text as texts
from quire.operators import browse, classify, dims, links
from quire.plans.tables.shapes import GEO_SQL, SUBREGIONS, geography, joined, load, text
from quire.sources import responses, tables

SEARCHES = {
    "one": "the", "two": "that  And", "french": "éon LA", "all": "", "none": "zebra-crossing",
    "source": "src1 en", "doi": "doc/7",
}
PAGE_PATTERN = r"""(?i)href=["'][^"']*/[a-z]{2}/[0-9]+["']"""


def clean_text(spark, d):
    """Whole pages reduced to plain text."""
    return load(spark, d, "pages").select("page_id", texts.plain_text(F.col("html")).alias("t")).select(
        "page_id", F.length("t").cast("bigint").alias("n_chars"),
        F.md5(F.col("t").cast("binary")).alias("text_md5"),
    )


def document_entries(spark, d):
    return load(spark, d, "documents").select(
        F.concat(F.lit("doc/"), text("doc_id")).alias("doi"), F.col("source").alias("title"),
        F.col("text").alias("abstract"), F.array("lang").alias("regions"), "n_chars",
    )


def search_documents(spark, d):
    return browse.search_many(document_entries(spark, d), SEARCHES).select("query_id", "doi")


def search_table(spark, d):
    """The same queries from a table."""
    asked = dims.fixed_table(spark, list(SEARCHES.items()), "query_id STRING, query STRING")
    return browse.search_table(document_entries(spark, d), asked).select("query_id", "doi")


def search_own_words(spark, d):
    """A query for every document: its source, its name and its first word."""
    docs = load(spark, d, "documents")
    query = F.concat_ws(
        " ", "source", F.concat(F.lit("DOC/"), text("doc_id")), F.get(F.split("text", " "), 0),
    )
    asked = docs.select(text("doc_id").alias("query_id"), query.alias("query"))
    return browse.search_table(document_entries(spark, d), asked).select("query_id", "doi")


def search_candidates(spark, d):
    return browse.search(document_entries(spark, d), "the of").select("doi", "n_chars")


def result_count(spark, d):
    return browse.search(document_entries(spark, d), "src1 en").agg(F.count("*").alias("n"))


def page_links(spark, d):
    pages = load(spark, d, "pages").select(
        text("page_id").alias("doi"), F.lit(200).alias("status"),
        F.lit(0).cast("bigint").alias("attempt"), "url", "html",
    )
    return responses.publisher_pages(pages, ".example.", PAGE_PATTERN).select("doi", "page_url")


def reference_links(spark, d):
    """One or two repository references per document; the title decides between two."""
    refs = F.array(
        F.col("text"),
        F.concat(F.lit("Data 10.7910/ DVN/X"), text("doc_id"), F.lit(".,")),
        F.when(F.col("lang").isin("fr", "en"), F.concat(
            F.col("text"), F.lit(" 10.5281/Zenodo."), text("doc_id"), F.lit("; end")
        )).otherwise(F.lit("")),
    )
    return load(spark, d, "documents").select(
        text("doc_id").alias("doi"), links.reference_candidates(refs).alias("c"),
        texts.long_tokens(F.col("text")).alias("tokens"),
    ).select(
        "doi", F.size("c").cast("bigint").alias("candidates"),
        links.reference_link(F.col("c"), F.col("tokens")).alias("link"),
    )


STEPS = {"click": "field", "view": "full_text", "purchase": "title"}
STEPS_B = {"signup": "field", "error": "full_text"}
JOURNALS = {"click": "APSR", "error": "Econometrica", "purchase": "JOP", "signup": "AER",
            "view": "Elsewhere"}


def single_hits(spark, d):
    """Hits per user, type and day; the hit itself where it is the only one."""
    hits = load(spark, d, "events").select(
        "user_id", "event_type", F.dayofyear("ts").alias("day"), "props"
    )
    return links.one_hit(hits, ["user_id", "event_type", "day"], "props")


def link_cascade(spark, d):
    """Every (user, day) as an article, its events of that day as search hits."""
    day = load(spark, d, "events").select(
        F.concat(text("user_id"), F.lit("/"), text(F.dayofyear("ts"))).alias("doi"),
        "event_type", "value", "user_id",
    )
    kinds = [*STEPS, *STEPS_B]
    per_day = day.groupBy("doi").agg(
        F.min("event_type").alias("lead"), F.max("value").alias("top"),
        F.max("user_id").alias("user_id"),
        *[F.count_if(F.col("event_type") == k).alias(k) for k in kinds],
    )
    # Stands for what has landed, so it is stored like it.
    per_day = tables.staged(per_day, "days")
    journal = names.renamed(F.col("lead"), JOURNALS)
    todo = per_day.select("doi", journal.alias("journal"), F.when(
        F.col("lead") != "signup", F.concat(F.lit("About prices "), "lead")).alias("title"))
    sources = dims.link_sources(spark).withColumn("configured", F.lit(True))
    todo = todo.join(F.broadcast(sources), "journal", "left").fillna(
        False, ["dv_enabled", "zen_enabled", "page_enabled", "configured"])

    def steps(of):
        rows = F.array(*[F.struct(
            F.lit(step).alias("step"),
            ((F.col("top") < 30) | (F.col(k) > 0)).alias("ok"),
            F.col(k).alias("n_hits"), F.concat(F.lit(f"{k}:"), "doi").alias("url"),
        ) for k, step in of.items()])
        return per_day.select("doi", F.lit(0).cast("bigint").alias("attempt"), F.inline(rows))

    zero = F.lit(0).cast("bigint").alias("attempt")
    site = per_day.where("lead = 'error'").select("doi", zero, F.when(
        F.col("top") > 60, F.concat(F.lit("page:"), "doi")).alias("page_url"))
    ref = F.when(F.col("top") > 20, F.array(
        F.concat(F.lit("10.3886/E"), text("user_id")), F.lit("none"))).otherwise(F.array(
            F.lit("Corn 10.3886/E1"), F.concat(F.lit("PRICES 10.3886/I"), text("user_id"))))
    refs = per_day.select("doi", zero, links.reference_candidates(ref).alias("candidates"))
    return links.propose_links(todo, steps(STEPS), steps(STEPS_B), site, refs)


def reply_rows(spark, d):
    """Replies of five kinds, by event type: clean, string years, decimals, broken, a list."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    body = F.concat(
        F.lit('{"is_hpe": '), F.when(F.col("value") > 20, "true").otherwise('""'),
        F.lit(', "period_start": '),
        F.when(kind == "view", F.concat(F.lit('"'), k, F.lit('"')))
        .when(kind == "error", F.concat(k, F.lit(".0"))).otherwise(k),
        F.lit(', "period_end": -'), k,
        F.lit(', "regions": ["ASIA-1", "Mars", 4, "EUROPE-2"], "countries": ["nation_'), k,
        F.lit('", "", "NATION_1"]}'),
    )
    raw = (
        F.when(kind == "click", F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```")))
        .when(kind == "signup", F.concat(F.lit('```json\n{"is_hpe" '), body, F.lit("\n```")))
        .when(kind == "purchase", F.concat(F.lit("[1, "), k, F.lit("]"))).otherwise(body)
    )
    return load(spark, d, "events").select(text("event_id").alias("doi"), raw.alias("raw"))


def reply_parse(spark, d):
    out = classify.classified(
        reply_rows(spark, d), dims.country_lookup(geography(spark, d)), "b", "m",
        F.lit(None).cast("timestamp"), SUBREGIONS,
    )
    return out.select(
        "doi", "is_hpe", "period_start", "period_end", joined("regions").alias("regions"),
        joined("countries").alias("countries"),
    )


def reply_rejects(spark, d):
    """Conversation turns read as replies: none holds an object."""
    turns = load(spark, d, "conversations").select(
        F.concat(text("conv_id"), F.lit("-"), text("turn")).alias("doi"), F.col("text").alias("raw")
    )
    return classify.rejected(turns).select("doi", "reason")


def chat_replies(spark, d):
    """Chat-style result lines: text, empty, error, and no choices."""
    kind = F.col("event_type")
    content = F.when(kind == "click", F.col("props"))
    message = F.to_json(F.struct(content.alias("content")), {"ignoreNullFields": "false"})
    line = F.concat(
        F.lit('{"custom_id": "'), text("event_id"), F.lit('", "error": '),
        F.when(kind == "error", '{"code": 5}').otherwise("null"),
        F.lit(', "response": {"body": {"choices": ['),
        F.when(kind == "signup", "").otherwise(F.concat(F.lit('{"message": '), message, F.lit("}"))),
        F.lit("]}}}"),
    )
    line = F.when(kind == "view", F.lit("  ")).otherwise(line)
    return responses.chat_replies(load(spark, d, "events").select(line.alias("value")))


def region_lists(spark, d):
    """Region lists held as JSON text: decoded, filtered to valid names, counted."""
    raw = F.when(F.col("o_orderstatus") == "F", F.lit("")).when(
        F.col("o_orderstatus") == "O", F.to_json(F.array(
            F.lit("North America"), F.col("o_orderpriority"), F.lit("Caribbean"))))
    decoded = texts.json_list(F.col("raw"))
    return load(spark, d, "orders").select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", F.size(decoded).cast("bigint").alias("n"),
        joined(names.valid_regions(decoded)).alias("valid"),
        texts.json_list_text(names.valid_regions(decoded)).alias("encoded"),
        texts.doi_link(text("o_orderkey")).alias("link"),
    )


QUERIES = {f.__name__: f for f in (
    clean_text, search_documents, search_table, search_own_words, search_candidates, result_count, page_links, reference_links,
    single_hits, link_cascade, reply_parse, reply_rejects, chat_replies, region_lists,
)}

RE_SPACE = r"[\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
HAY_SQL = """
entry AS (SELECT 'doc/' || doc_id AS doi, n_chars,
  lower(source || '  ' || 'doc/' || doc_id || ' ' || trim(regexp_replace(regexp_replace(
    text, '<[^>]+>', ' ', 'g'), '[\\s\\x{a0}]+', ' ', 'g')) || ' ' || lang) AS hay FROM documents)
"""


def _search_sql(query: str) -> str:
    terms = query.lower().split()
    return " AND ".join(f"contains(hay, '{t}')" for t in terms) or "true"


SQL = {
    "clean_text": f"""
        SELECT page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (
          SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            html, '<[^>]+>', ' ', 'g'), '{RE_SPACE}+', ' ', 'g'), '^ | $', '', 'g'),
            '^(?i:abstract)[ :.\\-]+', '') AS t FROM pages)""",
    "search_documents": f"WITH {HAY_SQL} " + " UNION ALL ".join(
        f"SELECT '{i}' AS query_id, doi FROM entry WHERE {_search_sql(q)}"
        for i, q in SEARCHES.items()),
    "search_own_words": f"""WITH {HAY_SQL},
        asked AS (
          SELECT doc_id, lower(coalesce(source, '')) AS a, 'doc/' || doc_id AS b,
                 regexp_split_to_array(lower(coalesce(split_part(text, ' ', 1), '')), '{RE_SPACE}+') AS c
          FROM documents)
        SELECT CAST(doc_id AS VARCHAR) AS query_id, doi FROM asked JOIN entry
          ON contains(hay, a) AND contains(hay, b)
         AND len(list_filter(c, lambda t: NOT contains(hay, t))) = 0""",
    "search_candidates": f"""WITH {HAY_SQL}
        SELECT doi, n_chars FROM entry WHERE {_search_sql('the of')}""",
    "result_count": f"WITH {HAY_SQL} SELECT count(*) AS n FROM entry WHERE {_search_sql('src1 en')}",
    "page_links": f"""
        SELECT CAST(page_id AS VARCHAR) AS doi, CASE WHEN contains(url, '.example.')
          AND regexp_matches(html, '{PAGE_PATTERN.replace("'", "''")}') THEN url END AS page_url
        FROM pages""",
    "reference_links": """
        WITH doc AS (
          SELECT CAST(doc_id AS VARCHAR) AS doi, lang, lower(text) AS body,
                 list_filter(regexp_split_to_array(text,
                   '[^\\p{L}\\p{N}_]+'), lambda w: length(w) >= 6) AS tokens FROM documents)
        SELECT doi, CASE WHEN lang IN ('fr', 'en') THEN 2 ELSE 1 END AS candidates,
          CASE WHEN lang NOT IN ('fr', 'en') THEN 'https://doi.org/10.7910/DVN/X' || doi
               WHEN len(list_filter(tokens, lambda w: contains('data 10.7910/ dvn/x' || doi || '.,',
                 lower(w)))) > 0 THEN 'https://doi.org/10.7910/DVN/X' || doi
               WHEN len(list_filter(tokens, lambda w: contains(body || ' 10.5281/zenodo.' || doi
                 || '; end', lower(w)))) > 0 THEN 'https://doi.org/10.5281/Zenodo.' || doi
          END AS link FROM doc""",
    "single_hits": """
        SELECT user_id, event_type, CAST(dayofyear(ts) AS INT) AS day, count(*) AS n_hits,
               CASE WHEN count(*) = 1 THEN min(props) END AS props
        FROM events GROUP BY user_id, event_type, dayofyear(ts)""",
    "link_cascade": """
        WITH day AS (
          SELECT user_id || '/' || dayofyear(ts) AS doi, min(event_type) AS lead,
                 max(value) AS top, max(user_id) AS u,
                 count(*) FILTER (WHERE event_type = 'click') AS a1,
                 count(*) FILTER (WHERE event_type = 'view') AS a2,
                 count(*) FILTER (WHERE event_type = 'purchase') AS a3,
                 count(*) FILTER (WHERE event_type = 'signup') AS b1,
                 count(*) FILTER (WHERE event_type = 'error') AS b2
          FROM events GROUP BY 1),
        ok AS (SELECT *, top < 30 OR a1 > 0 AS oka1, top < 30 OR a2 > 0 AS oka2,
                      top < 30 OR a3 > 0 AS oka3, top < 30 OR b1 > 0 AS okb1,
                      top < 30 OR b2 > 0 AS okb2 FROM day)
        SELECT doi, coalesce(
          CASE WHEN lead = 'click' AND oka1 THEN CASE
                 WHEN a1 = 1 THEN 'click:' || doi
                 WHEN a1 = 0 AND oka2 AND a2 = 1 THEN 'view:' || doi
                 WHEN a1 = 0 AND (NOT oka2 OR a2 = 0) AND oka3 AND a3 = 1
                   THEN 'purchase:' || doi END
               WHEN lead = 'purchase' AND oka1 THEN CASE
                 WHEN a1 = 1 THEN 'click:' || doi
                 WHEN a1 = 0 AND oka3 AND a3 = 1 THEN 'purchase:' || doi END
               WHEN lead = 'error' THEN coalesce(
                 CASE WHEN okb1 THEN CASE WHEN b1 = 1 THEN 'signup:' || doi
                                          WHEN b1 = 0 AND okb2 AND b2 = 1 THEN 'error:' || doi END
                 END, CASE WHEN top > 60 THEN 'page:' || doi END) END,
          'https://doi.org/10.3886/' || CASE WHEN top > 20 THEN 'E' || u
            WHEN lead <> 'signup' THEN 'I' || u END) AS replication_url
        FROM ok WHERE lead <> 'view'""",
    "reply_parse": f"""
        WITH {GEO_SQL},
        reply AS (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
                  WHERE event_type IN ('click', 'view', 'error'))
        SELECT CAST(event_id AS VARCHAR) AS doi, value > 20 AS is_hpe,
               CASE WHEN event_type = 'click' THEN k END AS period_start,
               -k AS period_end, 'ASIA-1|EUROPE-2' AS regions,
               coalesce(name, 'nation_' || k) || '|NATION_1' AS countries
        FROM reply LEFT JOIN geo ON lower(name) = 'nation_' || k""",
    "reply_rejects": """
        SELECT conv_id || '-' || turn AS doi, 'not a JSON object' AS reason FROM conversations""",
    "chat_replies": """
        SELECT CAST(event_id AS VARCHAR) AS custom_id,
               CASE event_type WHEN 'click' THEN props WHEN 'purchase' THEN '{}' END AS raw,
               CASE event_type WHEN 'error' THEN 'error'
                 WHEN 'signup' THEN 'malformed response' END AS reason
        FROM events WHERE event_type <> 'view'""",
    "region_lists": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 0 END AS n,
               CASE WHEN o_orderstatus = 'O' THEN 'Northern America|Caribbean' ELSE '' END AS valid,
               CASE WHEN o_orderstatus = 'O' THEN '["Northern America","Caribbean"]' ELSE '[]' END
                 AS encoded,
               'https://doi.org/' || o_orderkey AS link FROM orders""",
}
SQL["search_table"] = SQL["search_documents"]
