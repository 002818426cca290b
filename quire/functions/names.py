"""Name expressions: regions, countries and continents inside array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import vocab


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def renamed(name: Column, pairs: dict[str, str]) -> Column:
    """``name`` mapped through a small fixed table, unchanged when it is not there."""
    return F.coalesce(F.try_element_at(literal_map(pairs), name), name)


def region_name(name: Column, valid: list[str] = vocab.REGIONS) -> Column:
    return F.when(name.isin(valid), name).otherwise(renamed(name, vocab.REGION_ALIASES))


def valid_regions(names: Column, valid: list[str] = vocab.REGIONS) -> Column:
    """Normalized names that are valid regions; order and repeats are kept."""
    return F.filter(
        F.transform(names, lambda n: region_name(n, valid)), lambda n: n.isin(valid)
    )


def country_name(name: Column, lookup: Column) -> Column:
    """Catalogue name of a country.

    ``lookup`` is ``struct<exact, folded>`` from :func:`quire.operators.dims.country_lookup`:
    an exact spelling wins over a case-folded one, and unknown names stay as they are.
    """
    return F.coalesce(
        F.try_element_at(lookup["exact"], name),
        F.try_element_at(lookup["folded"], F.lower(name)),
        name,
    )


def country_names(names: Column, lookup: Column) -> Column:
    return F.transform(names, lambda n: country_name(n, lookup))


def continents_of(regions: Column, continent_of: Column) -> Column:
    """Continent of each region, regions without one dropped."""
    return F.filter(
        F.transform(regions, lambda r: F.try_element_at(continent_of, r)),
        lambda c: c.isNotNull(),
    )


def display_country(name: Column) -> Column:
    return renamed(name, vocab.DISPLAY_NAMES)
