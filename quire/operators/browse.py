"""Catalogue browsing: text search, geography x period counts, and drill-down rows.

An entry holds its regions and countries as arrays, so keys, anchors and period overlap
are computed inside the row. Only (entry, key) pairs that count are exploded, and every
grouped result is an aggregation with map-side combine over at most a few keys per entry.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire import vocab
from quire.functions import names, periods, text
from quire.operators import dims, postings

NONE = "array<string>"


def with_continents(entries: DataFrame, geo: DataFrame) -> DataFrame:
    """Add ``continents``: one per mapped region."""
    return entries.withColumn("_geo", dims.geography_maps(geo)).withColumn(
        "continents", names.continents_of(F.col("regions"), F.col("_geo")["continent"])
    ).drop("_geo")


# -- search ------------------------------------------------------------------------------


def haystack(columns: list[str], flat: bool = False) -> Column:
    """Lower-cased searchable text of an entry; ``flat``: with blanks for all other white space.

    Plain text has no other anyway, so a long abstract isn't read again.
    """
    def blanks(part: Column) -> Column:
        return F.regexp_replace(part, text.WEB_SPACE, " ") if flat else part

    parts = {
        "title": blanks(F.coalesce(F.col("title"), F.lit(""))) if "title" in columns else None,
        "authors": blanks(F.coalesce(F.col("authors"), F.lit(""))) if "authors" in columns else None,
        "doi": blanks(F.coalesce(F.col("doi"), F.lit(""))) if "doi" in columns else None,
        "abstract": text.plain_text(F.col("abstract")) if "abstract" in columns else None,
    }
    texts = [parts[c] if parts[c] is not None else F.lit("") for c in parts]
    tags = [
        F.coalesce(F.transform(F.col(c), blanks) if flat else F.col(c), F.array().cast(NONE))
        for c in ("regions", "countries", "continents") if c in columns
    ]
    return F.lower(F.array_join(F.concat(F.array(*texts), *tags), " "))


def search_terms(query: str) -> list[str]:
    return [t for t in re.split(text.WEB_SPACE, query.lower()) if t]


def matches(hay: Column, query: str) -> Column:
    """All whitespace-separated terms occur; an empty query matches everything."""
    found = F.lit(True)
    for term in search_terms(query):
        found = found & hay.contains(term)
    return found


def search(entries: DataFrame, query: str) -> DataFrame:
    """Entries that match the search box."""
    if not search_terms(query):
        return entries
    return entries.where(text.let(haystack(entries.columns), lambda h: matches(h, query)))


def search_many(entries: DataFrame, queries: dict[str, str]) -> DataFrame:
    """Entries x the queries they match, as ``query_id`` plus the entry columns.

    The searchable text is built once per entry, and only matches become rows.
    """
    def matched(hay: Column) -> Column:
        return F.array_compact(F.array(*[
            F.when(matches(hay, q), F.lit(i)) for i, q in queries.items()
        ]))

    hits = text.let(haystack(entries.columns), matched)
    return entries.select(F.explode(hits).alias("query_id"), *entries.columns)


def search_table(entries: DataFrame, queries: DataFrame) -> DataFrame:
    """:func:`search_many` for a table of queries (``query_id, query``) of any size."""
    return postings.search_texts(entries, haystack(entries.columns, flat=True), queries)


# -- row keys and counts -----------------------------------------------------------------


def row_keys(regions: Column, countries: Column, continent_of: Column) -> Column:
    """Every heatmap row an entry belongs to, each once.

    A name that is a continent or a sub-region is never read as a country.
    """
    mapped = F.filter(regions, lambda r: F.map_contains_key(continent_of, r))
    above = names.continents_of(regions, continent_of)
    whole = F.filter(regions, lambda r: r == vocab.GLOBAL)
    taken = F.map_values(continent_of)
    own = F.filter(countries, lambda c: (
        (c != "") & (c != vocab.GLOBAL)
        & ~F.map_contains_key(continent_of, c) & ~F.array_contains(taken, c)
    ))
    return F.array_distinct(F.concat(whole, above, mapped, own))


def keyed_entries(entries: DataFrame, geo: DataFrame) -> DataFrame:
    """Add ``keys`` (see :func:`row_keys`)."""
    none = F.array().cast(NONE)
    return text.once(
        entries.withColumn("_geo", dims.geography_maps(geo)), "keys",
        row_keys(F.coalesce("regions", none), F.coalesce("countries", none),
                 F.col("_geo")["continent"]),
    ).drop("_geo")


def ascending(buckets: list[tuple]) -> bool:
    """Do the bounds of ``(label, low, high)`` ascend? None is open."""
    lows = [float("-inf") if b[1] is None else b[1] for b in buckets]
    highs = [float("inf") if b[2] is None else b[2] for b in buckets]
    return lows == sorted(lows) and highs == sorted(highs)


def bucket_span(start: Column, end: Column, buckets: list[tuple]) -> tuple[Column, Column]:
    """First and last bucket that a period touches; where it touches none, the last is one less
    than the first."""
    first, last = F.coalesce(start, end), F.coalesce(end, start)
    low, high = F.lit(len(buckets)), F.lit(-1)
    for i, (_, _, hi) in reversed(list(enumerate(buckets))):
        low = F.lit(i) if hi is None else F.when(first <= hi, F.lit(i)).otherwise(low)
    for i, (_, lo, _) in enumerate(buckets):
        high = F.lit(i) if lo is None else F.when(last >= lo, F.lit(i)).otherwise(high)
    return low, F.greatest(high, low - 1)


def span_counts(entries: DataFrame, buckets: list[tuple]) -> DataFrame:
    """``regions, country, low, high, n``: entries by their set of regions (country null), and by
    each of their countries (regions null), for every span of buckets.

    The one pass over the entries, without a look-up and with map-side combine. The result follows
    the names in use, not the entries.
    """
    none = F.array().cast(NONE)
    low, high = bucket_span(F.col("period_start"), F.col("period_end"), buckets)
    regions = F.sort_array(F.array_distinct(F.coalesce("regions", none)))
    countries = F.array_compact(F.array_distinct(F.coalesce("countries", none)))
    dated = F.col("period_start").isNotNull() | F.col("period_end").isNotNull()
    spread = entries.where(dated).select(
        regions.alias("_set"), low.alias("low"), high.alias("high"),
        F.posexplode(F.concat(F.array(F.lit(None).cast("string")), countries)).alias("_at", "country"),
    )
    whole = F.when(F.col("_at") == 0, F.col("_set")).alias("regions")
    return spread.groupBy(whole, "country", "low", "high").agg(F.count("*").alias("n"))


def key_counts(spans: DataFrame, geo: DataFrame) -> DataFrame:
    """``row_key, low, high, n`` of :func:`span_counts`. Names are looked up here, once for each
    set of regions and each country in use, however many entries share them."""
    none = F.array().cast(NONE)
    countries = F.when(F.col("country").isNotNull(), F.array("country")).otherwise(none)
    keys = row_keys(F.coalesce("regions", none), countries, F.col("_geo")["continent"])
    return spans.withColumn("_geo", dims.geography_maps(geo)).select(
        F.explode(keys).alias("row_key"), "low", "high", "n"
    )


def count_matrix(
    entries: DataFrame, geo: DataFrame, buckets: list[tuple] = vocab.BUCKETS,
    rows: DataFrame | None = None,
) -> DataFrame:
    """``row_key, b0, b1, ..., total``: entries per row and period bucket.

    Without ``rows`` every key with a dated entry is a row. With ``rows`` (a ``row_key`` column)
    exactly those are, zero-filled. The bounds of ``buckets`` must ascend, so that a period touches a
    span of them: an entry counts +1 at the first and -1 after the last, and a cell is the
    sum of all steps up to it. The cost of an entry follows neither the buckets nor the geography.
    """
    if not ascending(buckets):
        raise ValueError("the bounds of the buckets must ascend")
    cells = [f"b{i}" for i in range(len(buckets))]
    steps = key_counts(span_counts(entries, buckets), geo).select("row_key", F.inline(F.array(
        F.struct(F.col("low").alias("at"), F.col("n").alias("step")),
        F.struct((F.col("high") + 1).alias("at"), (-F.col("n")).alias("step")),
    )))
    counts = steps.groupBy("row_key").agg(*[
        F.sum(F.when(F.col("at") <= i, F.col("step")).otherwise(F.lit(0).cast("bigint"))).alias(c)
        for i, c in enumerate(cells)
    ])
    if rows is not None:
        counts = rows.select("row_key").join(counts, "row_key", "left").fillna(0, cells)
    total = sum((F.col(c) for c in cells[1:]), F.col(cells[0]))
    return counts.withColumn("total", total)


def shown_rows(matrix: DataFrame) -> DataFrame:
    """Rows with at least one entry."""
    return matrix.where("total > 0")


def with_peak(matrix: DataFrame) -> DataFrame:
    """Add ``peak``: the largest cell of the rows at hand (the view on screen), at least 1.

    One window over rows that are already one per key.
    """
    cells = [c for c in matrix.columns if c[0] == "b" and c[1:].isdigit()]
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.max(F.greatest(*cells, F.lit(1).cast("bigint"))).over(everything)
    return matrix.withColumn("peak", top)


def with_heat(matrix: DataFrame) -> DataFrame:
    """Add ``peak`` and ``heat``, the intensities of the cells in order."""
    cells = [c for c in matrix.columns if c[0] == "b" and c[1:].isdigit()]
    heat = F.array(*[periods.heat(F.col(c), F.col("peak")) for c in cells])
    return with_peak(matrix).withColumn("heat", heat)


def matrix_cells(
    matrix: DataFrame, buckets: list[tuple] = vocab.BUCKETS
) -> DataFrame:
    """Long form: ``row_key, bucket, label, n, peak, heat``."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("bucket"), F.lit(b[0]).alias("label"), F.col(f"b{i}").alias("n"))
        for i, b in enumerate(buckets)
    ])
    return with_peak(matrix).select("row_key", "peak", F.inline(cells)).withColumn(
        "heat", periods.heat(F.col("n"), F.col("peak"))
    ).select("row_key", "bucket", "label", "n", "peak", "heat")


# -- filters -----------------------------------------------------------------------------


def key_filter(entries: DataFrame, geo: DataFrame, key: str) -> DataFrame:
    """Entries of one heatmap row."""
    return keyed_entries(entries, geo).where(F.array_contains("keys", key)).drop("keys")


def cell_filter(
    entries: DataFrame, geo: DataFrame, key: str, bucket: tuple | None = None
) -> DataFrame:
    """Entries behind one heatmap cell; without ``bucket`` the whole row, undated ones too."""
    rows = key_filter(entries, geo, key)
    if bucket is None:
        return rows
    _, lo, hi = bucket
    return rows.where(periods.overlaps(F.col("period_start"), F.col("period_end"), lo, hi))


def cells_filter(
    entries: DataFrame, geo: DataFrame, cells: dict[str, tuple[str, tuple | None]]
) -> DataFrame:
    """Entries behind several cells (id -> key, bucket), as ``cell_id`` and the entry columns.

    All cells are tested in one pass over the entries.
    """
    start, end = F.col("period_start"), F.col("period_end")

    def inside(key: str, bucket: tuple | None) -> Column:
        here = F.array_contains("keys", key)
        return here if bucket is None else here & periods.overlaps(start, end, *bucket[1:])

    hits = [F.when(inside(*cell), F.lit(i)) for i, cell in cells.items()]
    return keyed_entries(entries, geo).select(
        F.explode(F.array_compact(F.array(*hits))).alias("cell_id"), *entries.columns
    )


# -- countries of a sub-region -------------------------------------------------------------


def homes_of(countries: Column, home: Column) -> Column:
    """``struct<country, home, i>`` per country with its position, blanks dropped."""
    located = F.transform(countries, lambda c, i: F.struct(
        c.alias("country"), F.try_element_at(home, c).alias("home"), i.alias("i")
    ))
    return F.filter(located, lambda h: h["country"] != "")


def places_of(regions: Column, homes: Column, continent_of: Column) -> Column:
    """``struct<region, n, known>`` per region of an entry: how many of its countries are at
    home there, and whether the geography has it."""
    return F.transform(F.array_distinct(regions), lambda r: F.struct(
        r.alias("region"), F.size(F.filter(homes, lambda h: h["home"] == r)).alias("n"),
        F.map_contains_key(continent_of, r).alias("known"),
    ))


def anchored(entries: DataFrame, geo: DataFrame) -> DataFrame:
    """Entries with ``homes``, ``places`` and the highest ``n`` of a place as ``top``.

    Places at ``top`` are the anchors: they claim the entry's unlisted countries.
    """
    none = F.array().cast(NONE)
    regions, countries = F.coalesce("regions", none), F.coalesce("countries", none)
    maps = F.col("_geo")
    located = text.once(
        entries.withColumn("_geo", dims.geography_maps(geo)),
        "homes", homes_of(countries, maps["home"]),
    )
    placed = text.once(
        located, "places", places_of(regions, F.col("homes"), maps["continent"])
    ).drop("_geo")
    return placed.withColumn("top", F.array_max(F.transform("places", lambda p: p["n"])))


def listed_in(place: Column) -> Column:
    """Countries of an entry listed in one of its places: those at home there, and in an
    anchor those at home nowhere."""
    anchor = place["n"] == F.col("top")
    return F.filter("homes", lambda h: F.coalesce(h["home"] == place["region"], anchor))


def sightings(entries: DataFrame, geo: DataFrame, order: list[str]) -> DataFrame:
    """``subregion, country, entries, first_seen``: what the drill-down has to show.

    A row with a null country counts the entries of a region (the global one included).
    The others count the entries that list a country there: a country of the geography at
    home only, any other in the anchor regions. ``order`` names the columns that put
    entries in list order (``-name`` for descending); ``first_seen`` is the least of it,
    then of the position within the entry. One pass, and one small group per listed name.
    """
    def rank(name: str) -> Column:
        if name.startswith("-"):
            return F.struct(F.col(name[1:]).isNull(), -F.col(name[1:]))
        return F.col(name)

    keys = [rank(n).alias(f"k{i}") for i, n in enumerate(order)]
    first = F.transform("countries", lambda c, i: F.array_position("countries", c) == i + 1)

    def pairs(place: Column) -> Column:
        region = place["region"].alias("subregion")
        nothing = F.lit(None).cast("string").alias("country")
        own = F.filter(listed_in(place), lambda h: F.get("_first", h["i"]))
        named = F.transform(own, lambda h: F.struct(
            region, h["country"].alias("country"), h["i"].alias("i")
        ))
        return F.concat(F.array(F.struct(region, nothing, F.lit(0).alias("i"))), F.when(
            place["known"], named
        ).otherwise(F.slice(named, 1, 0)))

    wanted = F.filter("places", lambda p: p["known"] | (p["region"] == vocab.GLOBAL))
    seen = F.struct(*[f"k{i}" for i in range(len(order))], "i")
    rows = anchored(entries, geo).withColumn("_first", first)
    return (
        text.once(rows, "_pairs", F.flatten(F.transform(wanted, pairs)))
        .select(*keys, F.inline("_pairs")).groupBy("subregion", "country")
        .agg(F.count("*").alias("entries"), F.min(seen).alias("first_seen"))
    )


def subregion_countries(entries: DataFrame, geo: DataFrame, order: list[str]) -> DataFrame:
    """Distinct countries listed in each sub-region, with their first sighting."""
    return countries_of(sightings(entries, geo, order))


def countries_of(seen: DataFrame) -> DataFrame:
    return seen.where(F.col("country").isNotNull())


def drilldown_report(entries: DataFrame, geo: DataFrame, subregion: str) -> DataFrame:
    """Why countries appear in a sub-region: counts, anchors and shown countries per entry."""
    here = F.get(F.filter("places", lambda p: p["region"] == subregion), 0)
    top = F.filter("places", lambda p: p["n"] == F.col("top"))
    return anchored(entries, geo).where(F.array_contains("regions", subregion)).select(
        "doi", "regions", "countries",
        F.transform("places", lambda p: F.struct(p["region"], p["n"])).alias("region_counts"),
        F.transform(top, lambda p: p["region"]).alias("anchors"),
        F.transform(listed_in(here), lambda h: h["country"]).alias("shown"),
    )


def home_subregions(countries: DataFrame, entries: DataFrame, geo: DataFrame,
                    order: list[str]) -> DataFrame:
    """``country, subregion``: home in the geography, else the first sub-region listing it."""
    home = F.try_element_at(F.col("_geo")["home"], F.col("country"))
    listed = (
        subregion_countries(entries, geo, order)
        .join(dims.subregions(geo).select("subregion", "first_pos"), "subregion")
        .groupBy("country").agg(F.min_by("subregion", "first_pos").alias("_listed"))
    )
    return (
        countries.select("country").join(listed, "country", "left")
        .withColumn("_geo", dims.geography_maps(geo))
        .select("country", F.coalesce(home, "_listed").alias("subregion"))
    )


# -- rows within a budget ------------------------------------------------------------------


def subregion_plan(
    entries: DataFrame, geo: DataFrame, order: list[str], budget: int = vocab.ROW_BUDGET
) -> DataFrame:
    """Per active sub-region: continent, entries, number of countries, whether to expand it.

    The smallest groups of a continent are replaced by their countries while the rows stay
    within ``budget``. Costs ascend, so a running sum decides. The windows run over one row
    per sub-region.
    """
    return plan_subregions(sightings(entries, geo, order), geo, budget)


def plan_subregions(seen: DataFrame, geo: DataFrame, budget: int) -> DataFrame:
    subs = dims.subregions(geo).select("subregion", "continent")
    sizes = seen.groupBy("subregion").agg(
        F.max(F.when(F.col("country").isNull(), F.col("entries"))).alias("entries"),
        F.count("country").alias("countries"),
    )
    together = Window.partitionBy("continent")
    ascending = Window.partitionBy("continent", F.col("countries") > 0).orderBy(
        "countries", "subregion"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = F.count("*").over(together) + F.sum(F.col("countries") - 1).over(ascending)
    return subs.join(sizes, "subregion").withColumn(
        "expanded", (F.col("countries") > 0) & (rows <= budget)
    ).select("continent", "subregion", "entries", "countries", "expanded")


def subregion_rows(
    entries: DataFrame, geo: DataFrame, order: list[str], budget: int = vocab.ROW_BUDGET,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Rows of every continent's view: ``continent, subregion, row_key, is_country,
    first_seen``. Display order is sub-region, then first sighting.

    The rows come from :func:`sightings`, one row per listed name, read several times. Who has
    stored them gives them as ``seen``.
    """
    seen = sightings(entries, geo, order) if seen is None else seen
    return rows_of_subregions(seen, plan_subregions(seen, geo, budget))


def rows_of_subregions(seen: DataFrame, plan: DataFrame) -> DataFrame:
    opened = plan.where("expanded").select("continent", "subregion")
    countries = countries_of(seen).join(opened, "subregion").select(
        "continent", "subregion", F.col("country").alias("row_key"),
        F.lit(True).alias("is_country"), "first_seen",
    )
    return plan.where("NOT expanded").select(
        "continent", "subregion", F.col("subregion").alias("row_key"),
        F.lit(False).alias("is_country"),
    ).unionByName(countries, allowMissingColumns=True)


def continent_plan(
    entries: DataFrame, geo: DataFrame, order: list[str], budget: int = vocab.ROW_BUDGET,
    continent_order: list[str] = vocab.CONTINENT_ORDER,
) -> DataFrame:
    """Per active continent: rows its view needs, and whether to expand it in the world view.

    The global row never expands but takes a row. One row per continent in the window.
    """
    seen = sightings(entries, geo, order)
    return plan_continents(
        seen, plan_subregions(seen, geo, budget), geo, budget, continent_order
    )


def plan_continents(
    seen: DataFrame, subs: DataFrame, geo: DataFrame, budget: int, continent_order: list[str]
) -> DataFrame:
    per_sub = F.when(F.col("expanded"), F.col("countries")).otherwise(F.lit(1))
    sizes = subs.groupBy("continent").agg(F.sum(per_sub).alias("rows"))
    world = seen.where(F.col("subregion") == vocab.GLOBAL).select(
        F.col("subregion").alias("continent"), F.lit(1).cast("bigint").alias("rows")
    )
    listed = dims.continents(geo, continent_order).select("ord", "continent")
    groups = listed.join(sizes.unionByName(world), "continent")
    is_world = F.col("continent") == vocab.GLOBAL
    together = Window.partitionBy(F.lit(0))
    ascending = Window.partitionBy(is_world).orderBy("rows", "ord").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    needed = F.count("*").over(together) + F.sum(F.col("rows") - 1).over(ascending)
    return groups.withColumn("expanded", ~is_world & (needed <= budget)).select(
        "ord", "continent", "rows", "expanded"
    )


def continent_rows(
    entries: DataFrame, geo: DataFrame, order: list[str], budget: int = vocab.ROW_BUDGET,
    continent_order: list[str] = vocab.CONTINENT_ORDER, seen: DataFrame | None = None,
) -> DataFrame:
    """Rows of the world view: ``ord, continent, subregion, row_key, is_country, first_seen``.

    ``seen`` as in :func:`subregion_rows`.
    """
    seen = sightings(entries, geo, order) if seen is None else seen
    subs = plan_subregions(seen, geo, budget)
    plan = plan_continents(seen, subs, geo, budget, continent_order)
    opened = plan.where("expanded").select("ord", "continent")
    inner = rows_of_subregions(seen, subs).join(opened, "continent")
    closed = plan.where("NOT expanded").select(
        "ord", "continent", F.col("continent").alias("row_key"), F.lit(False).alias("is_country")
    )
    return closed.unionByName(inner, allowMissingColumns=True)
