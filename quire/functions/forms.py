"""Issue-form expressions: heading blocks, lists, and the override entry they describe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import vocab
from quire.functions.periods import bare_number, bare_years
from quire.functions.text import blank_to_null, first_part, let, second_part, strip

# Headings of an addition form that must be filled in.
REQUIRED_HEADINGS = ["Title (paper or dataset)", "Authors", "DOI", "Data link"]


def sections(body: Column) -> Column:
    """Form body as ``map<heading, value>``, without space at the ends of either; a repeated heading
    keeps its last value."""
    blocks = F.filter(F.split(body, r"(?dm)^### "), lambda b: strip(b) != "")
    pairs = F.transform(blocks, lambda b: F.struct(
        strip(first_part(b, "\n")).alias("key"), strip(second_part(b, "\n")).alias("value"),
    ))
    pairs = F.transform(pairs, lambda p: F.struct(
        p["key"].alias("key"),
        F.when(p["value"] == vocab.NO_RESPONSE, F.lit("")).otherwise(p["value"]).alias("value"),
    ))
    return let(pairs, last_of_each)


def last_of_each(pairs: Column) -> Column:
    """Key-value pairs as a map; of pairs with the same key the last one counts."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    last = F.transform(keys, lambda k: F.element_at(
        F.filter(pairs, lambda p: p["key"] == k), -1
    ))
    unique = F.size(keys) == F.size(pairs)
    return F.map_from_entries(F.when(unique, pairs).otherwise(last))


def field(fields: Column, heading: str) -> Column:
    """Value of a heading, '' when the form lacks it."""
    return F.coalesce(F.try_element_at(fields, F.lit(heading)), F.lit(""))


def author_list(raw: Column) -> Column:
    """``Last, First; ...`` as an array of ``struct<family, given>``."""
    people = F.filter(F.transform(F.split(raw, ";"), lambda p: strip(p)), lambda p: p != "")
    return F.transform(people, lambda p: F.struct(
        strip(first_part(p, ",")).alias("family"), strip(second_part(p, ",")).alias("given"),
    ))


def comma_list(raw: Column) -> Column:
    return F.filter(F.transform(F.split(raw, ","), lambda x: strip(x)), lambda x: x != "")


def given(value: Column, result: Column) -> Column:
    """``result`` when the field was filled in, else null, which JSON output leaves out."""
    return F.when(value != "", result)


def json_entry(*parts: Column) -> Column:
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def correction_entry(fields: Column) -> Column:
    """Correction as JSON with only the changed keys; null when the DOI is missing."""
    def at(name: str) -> Column:
        return field(fields, name)

    doi = blank_to_null(at("DOI"))
    start, end = bare_years(at("Corrected time period"))
    exclude = at("Should this paper be excluded from the database?")
    entry = json_entry(
        doi.alias("doi"),
        blank_to_null(at("Corrected title")).alias("title"),
        bare_number(at("Corrected publication year")).alias("year"),
        blank_to_null(at("Corrected abstract")).alias("abstract"),
        given(at("Corrected authors"), author_list(at("Corrected authors"))).alias("authors"),
        given(
            at("Corrected geographic coverage"), comma_list(at("Corrected geographic coverage"))
        ).alias("regions"),
        given(at("Corrected countries"), comma_list(at("Corrected countries"))).alias("countries"),
        start.alias("period_start"),
        end.alias("period_end"),
        blank_to_null(at("Corrected data link")).alias("replication_url"),
        F.when(exclude.startswith("Yes"), F.lit(False)).alias("is_hpe"),
        blank_to_null(at("Source / justification")).alias("note"),
    )
    return F.when(doi.isNotNull(), entry)


def missing_headings(fields: Column) -> Column:
    """Required addition headings that are absent or blank, in form order."""
    return F.array_compact(F.array(*[
        F.when(field(fields, h) == "", F.lit(h)) for h in REQUIRED_HEADINGS
    ]))


def addition_entry(fields: Column) -> Column:
    """Addition as JSON; null when a required heading is missing."""
    def at(name: str) -> Column:
        return field(fields, name)

    entry = json_entry(
        F.lit(True).alias("is_hpe"),
        at("Title (paper or dataset)").alias("title"),
        at("DOI").alias("doi"),
        at("Data link").alias("replication_url"),
        comma_list(at("Countries")).alias("countries"),
        blank_to_null(at("Journal")).alias("journal"),
        bare_number(at("Publication year")).alias("year"),
        given(at("Geographic coverage"), comma_list(at("Geographic coverage"))).alias("regions"),
        blank_to_null(at("Abstract / Short Description")).alias("abstract"),
        given(at("Authors"), author_list(at("Authors"))).alias("authors"),
        bare_number(at("Period start (year)")).alias("period_start"),
        bare_number(at("Period end (year)")).alias("period_end"),
        blank_to_null(at("Notes")).alias("note"),
    )
    complete = F.lit(True)
    for h in REQUIRED_HEADINGS:
        complete = complete & (at(h) != "")
    return F.when(complete, entry)
