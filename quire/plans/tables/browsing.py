"""Browse queries on the driver tables: counts, filters, drill-down."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import vocab
from quire.functions import names, periods
from quire.operators import browse, dims
from quire.plans.tables.shapes import (
    BUCKETS, CONTINENTS, ENTRIES_SQL, ENTRY_ORDER, GEO_SQL, entries, geography,
    joined, load, text,
)
from quire.sources import tables

BUDGET = 9
WORLD_BUDGET = 24

CELL_SQL = ", ".join(
    "count(*) FILTER (WHERE " + " AND ".join(
        ([f"coalesce(ps, pe) <= {hi}"] if hi is not None else [])
        + ([f"coalesce(pe, ps) >= {lo}"] if lo is not None else [])
    ) + f") AS b{i}"
    for i, (_, lo, hi) in enumerate(BUCKETS)
)
MATRIX_SQL = f"""WITH {ENTRIES_SQL},
matrix AS (
  SELECT row_key, {CELL_SQL} FROM entry_key JOIN entry USING (k)
  WHERE ps IS NOT NULL OR pe IS NOT NULL GROUP BY row_key
)
"""


def heatmap_matrix(spark, d):
    return browse.count_matrix(entries(spark, d), geography(spark, d), BUCKETS)


def heatmap_cells(spark, d):
    cells = browse.matrix_cells(heatmap_matrix(spark, d), BUCKETS)
    return cells.select(
        "row_key", F.col("bucket").cast("bigint").alias("bucket"), "n", "peak",
        F.round("heat", 6).alias("heat"),
    )


def fixed_rows_matrix(spark, d):
    """Counts of given rows only, zero-filled: all sub-regions plus names nobody uses."""
    geo = geography(spark, d)
    rows = geo.select(F.explode(F.array("subregion", F.concat(F.lit("No "), "name")))
                      .alias("row_key")).distinct()
    return browse.count_matrix(entries(spark, d), geo, BUCKETS, rows)


def cell_entries(spark, d):
    """Entries behind one cell, for a continent, a sub-region, a country and the world."""
    cells = {key: (key, bucket) for key, bucket in (
        ("ASIA", BUCKETS[3]), ("EUROPE-1", BUCKETS[5]), ("NATION_7", BUCKETS[4]),
        ("Global/Comparative", None),
    )}
    return browse.cells_filter(entries(spark, d), geography(spark, d), cells).select(
        "doi", F.col("cell_id").alias("row_key")
    )


def period_labels(spark, d):
    return entries(spark, d).select(
        "doi", periods.period_label(F.col("period_start"), F.col("period_end")).alias("label"),
        periods.overlaps(F.col("period_start"), F.col("period_end"), 1997, 1998).alias("in_97_98"),
    )


def period_counts(spark, d):
    """Entries per period bucket."""
    s, e = F.col("period_start"), F.col("period_end")
    flags = [F.when(periods.overlaps(s, e, lo, hi), F.lit(label)) for label, lo, hi in BUCKETS]
    return entries(spark, d).select(
        F.explode(F.array_compact(F.array(*flags))).alias("label")
    ).groupBy("label").agg(F.count("*").alias("n"))


def entry_continents(spark, d):
    out = browse.with_continents(entries(spark, d), geography(spark, d))
    return out.select("doi", joined(F.array_sort("continents")).alias("continents"))


def visible_countries(spark, d):
    return browse.subregion_countries(entries(spark, d), geography(spark, d), ENTRY_ORDER).select(
        "subregion", "country", "entries",
        F.col("first_seen.k2").alias("first_doi"),
    )


def drilldown_report(spark, d):
    out = browse.drilldown_report(entries(spark, d), geography(spark, d), "ASIA-1")
    counts = F.transform("region_counts", lambda c: F.concat(c["region"], F.lit("="), text(c["n"])))
    return out.select(
        "doi", joined(counts).alias("region_counts"), joined("anchors").alias("anchors"),
        joined(F.array_sort("shown")).alias("shown"),
    )


def country_homes(spark, d):
    data = entries(spark, d)
    asked = data.select(F.explode("countries").alias("country")).distinct()
    return browse.home_subregions(asked, data, geography(spark, d), ENTRY_ORDER)


def subregion_plan(spark, d):
    return browse.subregion_plan(entries(spark, d), geography(spark, d), ENTRY_ORDER, BUDGET)


def seen_names(spark, d):
    """What the drill-down has to show, stored: a few rows that the plans read repeatedly."""
    return tables.staged(
        browse.sightings(entries(spark, d), geography(spark, d), ENTRY_ORDER), "sightings"
    )


def subregion_rows(spark, d):
    rows = browse.subregion_rows(
        entries(spark, d), geography(spark, d), ENTRY_ORDER, BUDGET, seen_names(spark, d)
    )
    return rows.select("continent", "subregion", "row_key", "is_country")


def world_rows(spark, d):
    rows = browse.continent_rows(
        entries(spark, d), geography(spark, d), ENTRY_ORDER, WORLD_BUDGET, CONTINENTS,
        seen_names(spark, d),
    )
    return rows.select(F.col("ord").cast("bigint").alias("ord"), "continent", "row_key", "is_country")


def geo_hierarchy(spark, d):
    geo = geography(spark, d)
    subs = dims.subregions(geo).select(
        "continent", "subregion", joined("countries").alias("countries")
    )
    tops = dims.continents(geo, CONTINENTS).select(
        F.col("continent").alias("continent"), joined("subregions").alias("subregion"),
        text("ord").alias("countries"),
    )
    return subs.unionByName(tops)


def display_names(spark, d):
    """Country names as shown, over one dirty name per customer."""
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", "Viet Nam").when(segment == "MACHINERY", "Russian Federation")
        .when(segment == "HOUSEHOLD", "Korea, Republic of").otherwise(segment)
    )
    return load(spark, d, "customer").select(
        "c_custkey", names.display_country(name).alias("shown")
    )


ANCHOR_SQL = f"""WITH {ENTRIES_SQL},
home AS (
  SELECT ec.k, ec.country, g.subregion AS home
  FROM entry_country ec LEFT JOIN geo g ON g.name = ec.country
),
region_n AS (
  SELECT er.k, er.region, count(h.country) AS n
  FROM entry_region er LEFT JOIN home h ON h.k = er.k AND h.home = er.region GROUP BY ALL
),
anchor AS (
  SELECT k, region FROM (
    SELECT *, max(n) OVER (PARTITION BY k) AS top FROM region_n) WHERE n = top
),
visible AS (
  SELECT h.k, er.region AS subregion, h.country
  FROM home h JOIN entry_region er ON er.k = h.k AND er.region = h.home
  UNION ALL
  SELECT h.k, a.region, h.country FROM home h JOIN anchor a ON a.k = h.k
  JOIN subs s ON s.subregion = a.region WHERE h.home IS NULL
),
listed AS (
  SELECT subregion, country, count(DISTINCT k) AS entries,
         arg_min(doi, (-year, title, doi)) AS first_doi
  FROM visible JOIN entry USING (k) GROUP BY ALL
),
active AS (
  SELECT s.continent, s.subregion, count(*) AS entries
  FROM entry_region er JOIN subs s ON er.region = s.subregion GROUP BY ALL
),
sized AS (
  SELECT a.*, coalesce(n, 0) AS countries FROM active a
  LEFT JOIN (SELECT subregion, count(*) AS n FROM listed GROUP BY 1) USING (subregion)
),
plan AS (
  SELECT *, countries > 0 AND count(*) OVER (PARTITION BY continent)
    + sum(CASE WHEN countries > 0 THEN countries - 1 ELSE 0 END) OVER (
        PARTITION BY continent ORDER BY CASE WHEN countries > 0 THEN countries END NULLS FIRST,
        subregion ROWS UNBOUNDED PRECEDING) <= {{budget}} AS expanded
  FROM sized
)
"""
PLAN_SQL = ANCHOR_SQL.replace("{budget}", str(BUDGET))
WORLD_SQL = ANCHOR_SQL.replace("{budget}", str(WORLD_BUDGET)) + f""",
needs AS (
  SELECT continent, CAST(sum(CASE WHEN expanded THEN countries ELSE 1 END) AS BIGINT) AS n,
         list_position({CONTINENTS!r}, continent) AS ord FROM plan GROUP BY continent
  UNION ALL SELECT 'Global/Comparative', 1, {len(CONTINENTS) + 1}
  FROM (SELECT 1 FROM entry WHERE world LIMIT 1)
),
world AS (
  SELECT *, continent <> 'Global/Comparative' AND (SELECT count(*) FROM needs)
    + sum(CASE WHEN continent = 'Global/Comparative' THEN 0 ELSE n - 1 END) OVER (
        ORDER BY continent = 'Global/Comparative', n, ord ROWS UNBOUNDED PRECEDING)
    <= {WORLD_BUDGET} AS opened FROM needs
)
SELECT ord, continent, continent AS row_key, false AS is_country FROM world WHERE NOT opened
UNION ALL
SELECT ord, continent, subregion, false FROM world JOIN plan USING (continent)
WHERE opened AND NOT expanded
UNION ALL
SELECT ord, w.continent, country, true FROM world w JOIN plan p USING (continent)
JOIN listed l ON l.subregion = p.subregion WHERE opened AND expanded
"""

QUERIES = {
    "heatmap_matrix": heatmap_matrix,
    "heatmap_cells": heatmap_cells,
    "fixed_rows_matrix": fixed_rows_matrix,
    "cell_entries": cell_entries,
    "period_labels": period_labels,
    "period_counts": period_counts,
    "entry_continents": entry_continents,
    "visible_countries": visible_countries,
    "drilldown_report": drilldown_report,
    "country_homes": country_homes,
    "subregion_plan": subregion_plan,
    "subregion_rows": subregion_rows,
    "world_rows": world_rows,
    "geo_hierarchy": geo_hierarchy,
    "display_names": display_names,
}

_TOTAL = " + ".join(f"b{i}" for i in range(len(BUCKETS)))
_CELLS = ", ".join(f"b{i}" for i in range(len(BUCKETS)))

SQL = {
    "heatmap_matrix": f"{MATRIX_SQL} SELECT *, {_TOTAL} AS total FROM matrix",
    "heatmap_cells": f"""{MATRIX_SQL}
        SELECT row_key, CAST(substr(b, 2) AS BIGINT) AS bucket, n,
               greatest(1, max(n) OVER ()) AS peak,
               round(pow(n / greatest(1, max(n) OVER ()), {vocab.HEAT_EXPONENT}), 6) AS heat
        FROM (UNPIVOT matrix ON {_CELLS} INTO NAME b VALUE n)""",
    "fixed_rows_matrix": f"""{MATRIX_SQL},
        wanted AS (SELECT DISTINCT unnest([subregion, 'No ' || name]) AS row_key FROM geo)
        SELECT row_key, {', '.join(f'coalesce(b{i}, 0) AS b{i}' for i in range(len(BUCKETS)))},
               coalesce({_TOTAL}, 0) AS total FROM wanted LEFT JOIN matrix USING (row_key)""",
    "cell_entries": f"""WITH {ENTRIES_SQL}
        SELECT doi, row_key FROM entry JOIN entry_key USING (k)
        WHERE (row_key = 'ASIA' AND coalesce(ps, pe) <= 1997 AND coalesce(pe, ps) >= 1997)
           OR (row_key = 'EUROPE-1' AND coalesce(ps, pe) <= 1999 AND coalesce(pe, ps) >= 1999)
           OR (row_key = 'NATION_7' AND coalesce(ps, pe) <= 1998 AND coalesce(pe, ps) >= 1998)
           OR row_key = 'Global/Comparative'""",
    "period_labels": f"""WITH {ENTRIES_SQL}
        SELECT doi, CASE WHEN ps IS NULL AND pe IS NULL THEN NULL
                         WHEN ps = pe THEN CAST(ps AS VARCHAR)
                         ELSE coalesce(CAST(ps AS VARCHAR), '?') || '–'
                              || coalesce(CAST(pe AS VARCHAR), '?') END AS label,
               coalesce(coalesce(ps, pe) <= 1998 AND coalesce(pe, ps) >= 1997, false) AS in_97_98
        FROM entry""",
    "period_counts": f"""WITH {ENTRIES_SQL},
        bucket(label, lo, hi) AS (VALUES {', '.join(
            f"('{n}', {lo if lo is not None else -99999}, {hi if hi is not None else 99999})"
            for n, lo, hi in BUCKETS)})
        SELECT label, count(*) AS n FROM entry JOIN bucket
          ON coalesce(ps, pe) <= hi AND coalesce(pe, ps) >= lo GROUP BY label""",
    "entry_continents": f"""WITH {ENTRIES_SQL}
        SELECT doi, coalesce(string_agg(continent, '|' ORDER BY continent), '') AS continents
        FROM entry LEFT JOIN entry_region USING (k) LEFT JOIN subs ON region = subregion
        GROUP BY doi""",
    "visible_countries": f"{PLAN_SQL} SELECT * FROM listed",
    "drilldown_report": f"""{PLAN_SQL}
        SELECT doi,
          (SELECT string_agg(region || '=' || n, '|' ORDER BY region = 'Global/Comparative', region)
           FROM region_n r WHERE r.k = e.k) AS region_counts,
          (SELECT string_agg(region, '|' ORDER BY region = 'Global/Comparative', region)
           FROM anchor a WHERE a.k = e.k) AS anchors,
          coalesce((SELECT string_agg(country, '|' ORDER BY country)
           FROM visible v WHERE v.k = e.k AND v.subregion = 'ASIA-1'), '') AS shown
        FROM entry e JOIN entry_region r ON r.k = e.k AND r.region = 'ASIA-1'""",
    "country_homes": f"""{PLAN_SQL}
        SELECT country, coalesce(max(g.subregion), arg_min(l.subregion, first_pos)) AS subregion
        FROM (SELECT DISTINCT country FROM entry_country) c LEFT JOIN geo g ON g.name = country
        LEFT JOIN listed l USING (country) LEFT JOIN subs s ON s.subregion = l.subregion
        GROUP BY country""",
    "subregion_plan": f"{PLAN_SQL} SELECT continent, subregion, entries, countries, expanded FROM plan",
    "subregion_rows": f"""{PLAN_SQL}
        SELECT continent, subregion, subregion AS row_key, false AS is_country
        FROM plan WHERE NOT expanded
        UNION ALL SELECT continent, p.subregion, country, true
        FROM plan p JOIN listed l ON l.subregion = p.subregion WHERE expanded""",
    "world_rows": WORLD_SQL,
    "geo_hierarchy": f"""WITH {GEO_SQL}
        SELECT max(continent) AS continent, subregion,
               string_agg(name, '|' ORDER BY pos) AS countries FROM geo GROUP BY subregion
        UNION ALL
        SELECT continent, string_agg(subregion, '|' ORDER BY subregion),
               CAST(list_position({CONTINENTS!r}, continent) AS VARCHAR)
        FROM subs GROUP BY continent
        UNION ALL SELECT 'Global/Comparative', '', '{len(CONTINENTS) + 1}'""",
    "display_names": """
        SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Vietnam'
          WHEN 'MACHINERY' THEN 'Russia' WHEN 'HOUSEHOLD' THEN 'South Korea'
          ELSE c_mktsegment END AS shown FROM customer""",
}
