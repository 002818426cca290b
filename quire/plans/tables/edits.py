"""Override and streaming queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import articles, overrides
from quire.operators.articles import Catalogue
from quire.operators.publish import ordered_text
from quire.plans.tables.shapes import joined, load, text
from quire.sources import issues, tables
from quire.streaming import jobs as streams


def customers(spark, d) -> Catalogue:
    """Customers as articles with one author each; those with money are classified."""
    rows = load(spark, d, "customer").select(text("c_custkey").alias("doi"), "*")
    arts = rows.select(
        "doi", F.lit("JOP").alias("journal"), F.col("c_name").alias("title"),
        F.lit(1990).alias("year"), F.lit(1).alias("month"),
        *[F.lit("x").alias(c) for c in ("volume", "issue", "pages")],
        F.col("c_mktsegment").alias("abstract"),
    )
    people = rows.select(
        "doi", F.lit(0).alias("sequence"), F.lit("C").alias("given"),
        F.col("c_mktsegment").alias("family"),
    )
    classes = rows.where("c_acctbal > 1000").select(
        "doi", F.lit(True).alias("is_hpe"), F.lit(1500).alias("period_start"),
        F.lit(1600).alias("period_end"), F.array(text("c_nationkey")).alias("regions"),
        F.array("c_mktsegment").alias("countries"), F.lit("b").alias("backend"),
        F.lit("m").alias("model"), F.lit(None).cast("timestamp").alias("classified_at"),
        F.lit("http://old").alias("replication_url"),
    )
    return Catalogue(arts, people, classes)


def events(spark, d):
    return load(spark, d, "events").select(
        "event_id", text("user_id").alias("doi"), "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def correction_log(spark, d):
    """One correction per event; which keys it carries depends on the event type."""
    e = events(spark, d)
    kind, k = F.col("event_type"), text("k")
    some = F.col("value") > 20
    extra = (
        F.when(kind == "click", F.concat(F.lit(', "title": "T'), k, F.lit('", "note": "n"')))
        .when(kind == "view", F.concat(
            F.lit(', "year": '), k, F.lit(', "period_start": '), F.when(some, k).otherwise("null")))
        .when(kind == "error", F.concat(
            F.lit(', "is_hpe": '), F.when(some, "1").otherwise('""'),
            F.lit(', "replication_url": '), F.when(some, "null").otherwise('"http://new"')))
        .when(kind == "purchase", F.concat(
            F.lit(', "countries": ["A'), k, F.lit('", "B"], "authors": [{"family": "F'), k,
            F.lit('"}, {"given": "G"}]')))
        .otherwise(F.when(some, F.lit(', "regions": "not a list"')).otherwise(F.lit(', "authors": []')))
    )
    return e.select(
        F.lit(overrides.CORRECTIONS).alias("list"), F.col("event_id").alias("pos"),
        F.lit(None).cast("string").alias("issue"), "doi",
        F.concat(F.lit('{"doi": "'), "doi", F.lit('"'), extra, F.lit("}")).alias("raw"),
    )


def addition_log(spark, d):
    """One addition per event; errors lack the link, signups carry no author list."""
    e = events(spark, d)
    kind, k = F.col("event_type"), text("k")
    raw = F.concat(
        F.lit('{"doi": "'), "doi", F.lit('", "title": "'), kind, F.lit(" "), k, F.lit('"'),
        F.when(kind != "error", F.concat(F.lit(', "replication_url": "http://'), k, F.lit('"')))
        .otherwise(""),
        F.when(kind == "view", F.lit(', "journal": "", "is_hpe": null'))
        .when(kind == "click", F.concat(F.lit(', "journal": "QJE", "regions": ["R'), k, F.lit('"]')))
        .when(kind == "purchase", F.concat(F.lit(', "year": '), k)).otherwise(""),
        F.when(kind == "signup", F.lit(', "authors": "nobody"')).otherwise(F.concat(
            F.lit(', "authors": [{"family": "'), kind, F.lit('"}]'))),
        F.lit("}"),
    )
    return e.select(
        F.lit(overrides.ADDITIONS).alias("list"), F.col("event_id").alias("pos"),
        F.lit(None).cast("string").alias("issue"), "doi", raw.alias("raw"),
    )


def people_text(authors):
    """Author rows of a result as one string per DOI."""
    name = F.concat(
        F.coalesce("given", F.lit("-")), F.lit(" "), F.coalesce("family", F.lit("-"))
    )
    rows = authors.select("doi", "sequence", name.alias("people"))
    return ordered_text(rows, "doi", "sequence", "people", "; ")


def flat(cat: Catalogue):
    """All three tables of a result side by side."""
    classes = cat.classifications.select(
        "doi", "is_hpe", "period_start", "period_end", joined("regions").alias("regions"),
        joined("countries").alias("countries"), "backend", "replication_url",
    )
    return (
        cat.articles.select("doi", "journal", "title", "year", "abstract")
        .join(classes, "doi", "left").join(people_text(cat.authors), "doi", "left")
    )


def parsed(log):
    """The log parsed once and stored, as the override job does it."""
    return tables.staged(overrides.read_entries(log), "entries")


def override_corrections(spark, d):
    cat, log = customers(spark, d), correction_log(spark, d)
    return flat(overrides.apply_overrides(cat, log, entries=parsed(log)))


def override_additions(spark, d):
    at = F.lit(None).cast("timestamp")
    cat, log = customers(spark, d), addition_log(spark, d)
    return flat(overrides.apply_overrides(cat, log, at, cascade=False, entries=parsed(log)))


def override_stats(spark, d):
    log = correction_log(spark, d).unionByName(addition_log(spark, d))
    return overrides.override_stats(customers(spark, d), log)


def override_rejects(spark, d):
    log = correction_log(spark, d).unionByName(addition_log(spark, d))
    return overrides.read_entries(log).where("reason IS NOT NULL").select("list", "pos", "reason")


def override_append(spark, d):
    """Event entries appended to a log of orders, guarded by issue or DOI."""
    orders = load(spark, d, "orders")
    log = orders.select(
        F.when(F.col("o_orderstatus") == "F", overrides.CORRECTIONS)
        .otherwise(overrides.ADDITIONS).alias("list"),
        F.col("o_orderkey").alias("pos"),
        F.when(F.col("o_orderpriority") == "1-URGENT", text("o_custkey")).alias("issue"),
        text("o_custkey").alias("doi"), F.lit("{}").alias("raw"),
    )
    kind = F.col("event_type")
    new = events(spark, d).select(
        F.when(F.col("value") > 20, overrides.CORRECTIONS).otherwise(overrides.ADDITIONS)
        .alias("list"),
        F.col("event_id").alias("pos"),
        F.when(kind.isin("click", "view"), F.col("doi")).when(kind == "error", "").alias("issue"),
        F.when(kind != "signup", F.col("doi")).alias("doi"), F.lit("{}").alias("raw"),
    )
    return overrides.append_entries(log, new).drop("raw")


def issue_forms(spark, d):
    """An issue form per event: corrections and additions with blanks, junk and repeats."""
    e = events(spark, d)
    kind, k = F.col("event_type"), text("k")

    def block(head, value):
        return F.concat(F.lit(f"### {head}\n\n"), value, F.lit("\n\n"))

    def lit(value):
        return F.lit(value)

    fix = F.concat(
        block("DOI", F.when(kind == "error", lit("_No response_")).otherwise(
            F.concat(lit(" 10.1/"), F.col("doi"), lit(" ")))),
        block("Corrected title", F.concat(lit("Title "), k)),
        block("Corrected publication year", F.when(kind == "click", k).otherwise(lit("n.d."))),
        block("Corrected time period", F.when(
            F.col("value") > 20, F.concat(lit("-"), k, lit(" – "), k)).otherwise(lit("long ago"))),
        block("Corrected countries", F.concat(lit("A, "), k, lit(", ,B "))),
        block("Corrected authors", F.when(kind == "click", lit("Doe, Jane; Roe")).otherwise("")),
        block("Should this paper be excluded from the database?", F.when(
            F.col("value") > 50, lit("Yes, exclude")).otherwise(lit("No"))),
        block("Corrected title", F.concat(lit("Final "), k)),
    )
    add = F.concat(
        block("Title (paper or dataset)", F.concat(lit("Set "), k)),
        block("Authors", F.when(F.col("value") > 50, lit("")).otherwise(lit("Doe, Jane"))),
        block("DOI", F.concat(lit("10.2/"), F.col("doi"))), block("Data link", lit("http://d")),
        block("Period start (year)", F.concat(lit("-"), k)),
        block("Period end (year)", lit("today")),
        block("Geographic coverage", F.concat(lit("R"), k, lit(",S"))),
        block("Abstract / Short Description", F.concat(lit("Two\nlines "), k)),
    )
    is_add = kind == "purchase"
    return e.select(
        F.when(kind == "view", F.concat(lit("u"), F.col("doi"))).when(
            kind == "signup", lit(None)).otherwise(text("event_id")).alias("issue_id"),
        F.when(is_add, "new-entry").otherwise("correction").alias("type"),
        F.when(is_add, add).otherwise(fix).alias("body"), F.col("event_id").alias("pos"),
    )


def issue_parse(spark, d):
    at = lambda p: F.get_json_object("raw", p)
    return issues.parsed_issues(issue_forms(spark, d)).select(
        "list", "pos", "issue", at("$.doi").alias("doi"), at("$.title").alias("title"),
        at("$.year").alias("year"), at("$.period_start").alias("period_start"),
        at("$.period_end").alias("period_end"), at("$.countries").alias("countries"),
        at("$.regions").alias("regions"), at("$.authors").alias("authors"),
        at("$.is_hpe").alias("is_hpe"), at("$.abstract").alias("abstract"), "reason",
    )


def event_pages(frame):
    """Events as landed pages, one item each."""
    item = F.struct(
        F.concat(F.lit("10.1/U"), text("user_id")).alias("DOI"),
        F.array(F.concat("event_type", F.lit(" "), "props")).alias("title"),
        F.array(F.struct(F.lit("G").alias("given"), F.col("event_type").alias("family")))
        .alias("author"),
        F.when(F.col("value") > 20, F.col("props")).alias("abstract"),
        F.struct(F.array(F.array(F.year("ts"), F.month("ts"))).alias("date-parts"))
        .alias("published"),
        F.lit(None).cast("string").alias("volume"), F.lit(None).cast("string").alias("issue"),
        text("event_id").alias("page"), F.lit(None).cast("string").alias("type"),
    )
    landed = F.struct(
        F.col("ts").alias("time"), F.lit("events").alias("path"), F.col("event_id").alias("start")
    )
    return frame.select(
        F.struct(F.array(item).alias("items")).alias("message"),
        F.lit("JOP").alias("journal"), landed.alias("landed"),
    )


def event_stream(spark, d):
    schema = load(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def stream_pages(spark, d):
    """Pages streamed into the append area, then merged: equal to the batch upsert."""
    out, check = tables.scratch(spark, "pages"), tables.scratch(spark, "pages-checkpoint")
    streams.flatten_stream(event_pages(event_stream(spark, d)), out, check).awaitTermination()
    cat = streams.merge_flattened(articles.empty(spark), spark, out)
    people = cat.authors.select("doi", F.col("family").alias("author"))
    return cat.articles.select("doi", "title", "year", "month", "pages", "abstract").join(
        people, "doi"
    )


def stream_issues(spark, d):
    """Issue forms streamed into the log, each issue once."""
    log, check = tables.scratch(spark, "log"), tables.scratch(spark, "log-checkpoint")
    forms = _forms_of(event_stream(spark, d))
    streams.issue_stream(forms, log, check).awaitTermination()
    return streams.read_log(spark, log).select("list", "issue", "doi")


def _forms_of(frame):
    """Forms without ties: one issue number or DOI always has the same content."""
    kind = F.col("event_type")
    body = F.concat(F.lit("### DOI\n\n10.1/"), text("user_id"), F.lit("\n"))
    add = F.concat(body, *[
        F.lit(f"### {h}\n\nx\n") for h in ("Title (paper or dataset)", "Authors", "Data link")
    ])
    return frame.select(
        F.when(kind != "signup", F.concat(F.lit("i"), text("user_id"))).alias("issue_id"),
        F.when(kind == "purchase", "new-entry").otherwise("correction").alias("type"),
        F.when(kind == "purchase", add).otherwise(body).alias("body"),
        F.col("event_id").alias("pos"),
    )


QUERIES = {f.__name__: f for f in (
    override_corrections, override_additions, override_stats, override_rejects, override_append,
    issue_parse, stream_pages, stream_issues,
)}

EVENTS_SQL = """
ev AS (SELECT event_id, CAST(user_id AS VARCHAR) AS doi, event_type AS kind, value,
              CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
cust AS (SELECT CAST(c_custkey AS VARCHAR) AS doi, c_acctbal > 1000 AS known, * FROM customer)
"""
BAD_FIX = "kind = 'signup' AND value > 20"

SQL = {
    "override_corrections": f"""
        WITH {EVENTS_SQL},
        fold AS (
          SELECT doi, arg_max(k, event_id) FILTER (WHERE kind = 'click') AS title_k,
                 arg_max(k, event_id) FILTER (WHERE kind = 'view') AS year,
                 arg_max({{'v': CASE WHEN value > 20 THEN k END}}, event_id)
                   FILTER (WHERE kind = 'view') AS ps,
                 arg_max(value > 20, event_id) FILTER (WHERE kind = 'error') AS flag,
                 arg_max(k, event_id) FILTER (WHERE kind = 'purchase') AS p
          FROM ev WHERE doi IN (SELECT doi FROM cust WHERE known) GROUP BY doi)
        SELECT doi, 'JOP' AS journal, coalesce('T' || title_k, c_name) AS title,
               coalesce(year, 1990) AS year, c_mktsegment AS abstract,
               CASE WHEN known THEN coalesce(flag, true) END AS is_hpe,
               CASE WHEN known THEN CASE WHEN ps IS NULL THEN 1500 ELSE ps.v END END AS period_start,
               CASE WHEN known THEN 1600 END AS period_end,
               CASE WHEN known THEN CAST(c_nationkey AS VARCHAR) END AS regions,
               CASE WHEN known THEN coalesce('A' || p || '|B', c_mktsegment) END AS countries,
               CASE WHEN known THEN 'b' END AS backend,
               CASE WHEN known AND flag IS NULL THEN 'http://old'
                    WHEN known AND NOT flag THEN 'http://new' END AS replication_url,
               coalesce('- F' || p || '; G -', 'C ' || c_mktsegment) AS people
        FROM cust LEFT JOIN fold USING (doi)""",
    "override_additions": f"""
        WITH {EVENTS_SQL},
        last AS (SELECT * FROM ev WHERE kind <> 'error'
                 QUALIFY row_number() OVER (PARTITION BY doi ORDER BY event_id DESC) = 1),
        people AS (SELECT doi, arg_max(kind, event_id) AS family FROM ev
                   WHERE kind NOT IN ('error', 'signup') GROUP BY doi)
        SELECT doi, CASE kind WHEN 'click' THEN 'QJE' ELSE 'Unpublished' END AS journal,
               kind || ' ' || k AS title, CASE WHEN kind = 'purchase' THEN k END AS year,
               CAST(NULL AS VARCHAR) AS abstract, kind <> 'view' AS is_hpe,
               CAST(NULL AS INT) AS period_start, CAST(NULL AS INT) AS period_end,
               CASE WHEN kind = 'click' THEN 'R' || k ELSE '' END AS regions, '' AS countries,
               'manual' AS backend, 'http://' || k AS replication_url,
               coalesce('- ' || family, 'C ' || c_mktsegment) AS people
        FROM last LEFT JOIN people USING (doi) LEFT JOIN cust USING (doi)
        UNION ALL
        SELECT doi, 'JOP', c_name, 1990, c_mktsegment, CASE WHEN known THEN true END,
               CASE WHEN known THEN 1500 END, CASE WHEN known THEN 1600 END,
               CASE WHEN known THEN CAST(c_nationkey AS VARCHAR) END,
               CASE WHEN known THEN c_mktsegment END, CASE WHEN known THEN 'b' END,
               CASE WHEN known THEN 'http://old' END, 'C ' || c_mktsegment
        FROM cust WHERE doi NOT IN (SELECT doi FROM last)""",
    "override_stats": f"""
        WITH {EVENTS_SQL}
        SELECT count(*) FILTER (WHERE known AND kind <> 'signup') AS corrections,
               count(*) FILTER (WHERE kind <> 'error') AS additions,
               count(*) FILTER (WHERE known IS NOT true AND NOT ({BAD_FIX})) AS unknown_dois,
               count(*) FILTER (WHERE {BAD_FIX}) + count(*) FILTER (WHERE kind = 'error')
                 AS rejected
        FROM ev LEFT JOIN cust USING (doi)""",
    "override_rejects": f"""
        WITH {EVENTS_SQL}
        SELECT 'corrections' AS list, event_id AS pos, 'unreadable: regions' AS reason
        FROM ev WHERE {BAD_FIX}
        UNION ALL SELECT 'additions', event_id, 'missing required fields: replication_url'
        FROM ev WHERE kind = 'error'""",
    "override_append": """
        WITH log AS (
          SELECT CASE WHEN o_orderstatus = 'F' THEN 'corrections' ELSE 'additions' END AS list,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS VARCHAR) END AS issue,
                 CAST(o_custkey AS VARCHAR) AS doi FROM orders),
        new AS (
          SELECT CASE WHEN value > 20 THEN 'corrections' ELSE 'additions' END AS list,
                 event_id AS pos, event_type AS kind,
                 CASE WHEN event_type IN ('click', 'view') THEN CAST(user_id AS VARCHAR)
                      WHEN event_type = 'error' THEN '' END AS issue,
                 CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS doi
          FROM events),
        issued AS (
          SELECT list, pos, issue, doi FROM new n WHERE issue <> ''
            AND NOT EXISTS (SELECT 1 FROM log l WHERE l.list = n.list AND l.issue = n.issue)
          QUALIFY row_number() OVER (PARTITION BY list, issue ORDER BY pos) = 1),
        plain AS (
          SELECT list, pos, issue, doi FROM new n WHERE coalesce(issue, '') = '' AND doi IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM log l WHERE l.list = n.list AND l.doi = n.doi)
          QUALIFY row_number() OVER (PARTITION BY list, doi ORDER BY pos) = 1)
        SELECT * FROM issued UNION ALL
        SELECT * FROM plain p WHERE NOT EXISTS (
          SELECT 1 FROM issued i WHERE i.list = p.list AND i.doi = p.doi AND i.pos < p.pos)
        UNION ALL SELECT list, pos, issue, doi FROM new WHERE coalesce(issue, '') = '' AND doi IS NULL""",
    "issue_parse": f"""
        WITH {EVENTS_SQL},
        form AS (SELECT *, kind = 'purchase' AS adds, kind = 'error' AS nodoi,
                        kind = 'purchase' AND value > 50 AS noauthor FROM ev),
        good AS (SELECT *, NOT nodoi AND NOT noauthor AS ok FROM form)
        SELECT CASE WHEN adds THEN 'additions' ELSE 'corrections' END AS list, event_id AS pos,
               CASE kind WHEN 'view' THEN 'u' || doi WHEN 'signup' THEN NULL
                 ELSE CAST(event_id AS VARCHAR) END AS issue,
               CASE WHEN ok THEN CASE WHEN adds THEN '10.2/' ELSE '10.1/' END || doi END AS doi,
               CASE WHEN ok THEN CASE WHEN adds THEN 'Set ' ELSE 'Final ' END || k END AS title,
               CASE WHEN kind = 'click' THEN CAST(k AS VARCHAR) END AS year,
               CASE WHEN ok AND (adds OR value > 20) THEN CAST(-k AS VARCHAR) END AS period_start,
               CASE WHEN ok AND NOT adds AND value > 20 THEN CAST(k AS VARCHAR) END AS period_end,
               CASE WHEN ok THEN CASE WHEN adds THEN '[]'
                 ELSE '["A","' || k || '","B"]' END END AS countries,
               CASE WHEN ok AND adds THEN '["R' || k || '","S"]' END AS regions,
               CASE WHEN ok AND adds THEN '[{{"family":"Doe","given":"Jane"}}]'
                    WHEN ok AND kind = 'click'
                    THEN '[{{"family":"Doe","given":"Jane"}},{{"family":"Roe","given":""}}]'
               END AS authors,
               CASE WHEN ok AND adds THEN 'true' WHEN ok AND value > 50 THEN 'false' END AS is_hpe,
               CASE WHEN ok AND adds THEN 'Two' || chr(10) || 'lines ' || k END AS abstract,
               CASE WHEN nodoi THEN 'DOI is required'
                    WHEN noauthor THEN 'Missing required fields: Authors' END AS reason
        FROM good""",
    "stream_pages": """
        SELECT '10.1/u' || user_id AS doi, event_type || ' ' || props AS title,
               CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
               CAST(event_id AS VARCHAR) AS pages, CASE WHEN value > 20 THEN props END AS abstract,
               event_type AS author FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_issues": """
        WITH form AS (
          SELECT CASE WHEN event_type = 'purchase' THEN 'additions' ELSE 'corrections' END AS list,
                 CASE WHEN event_type <> 'signup' THEN 'i' || user_id END AS issue,
                 '10.1/' || user_id AS doi, event_id AS pos FROM events),
        issued AS (SELECT list, issue, doi, min(pos) AS pos FROM form WHERE issue IS NOT NULL
                   GROUP BY ALL),
        plain AS (SELECT list, issue, doi, min(pos) AS pos FROM form WHERE issue IS NULL
                  GROUP BY ALL)
        SELECT list, issue, doi FROM issued UNION ALL
        SELECT list, issue, doi FROM plain p WHERE NOT EXISTS (
          SELECT 1 FROM issued i WHERE i.list = p.list AND i.doi = p.doi AND i.pos < p.pos)""",
}
