"""Typed reading of free-form JSON with VARIANT type gates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import names
from quire.functions.text import json_slice, let

EMPTY = "array<string>"


def field(value: Column, name: str) -> Column:
    """Member of a JSON object as VARIANT; null when the key is absent."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))


def is_list(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("ARRAY"), F.lit(False))


def truthy(value: Column) -> Column:
    """False for absent, null, false, zero and empty values; true for all others."""
    empty = F.to_json(value).isin("null", "false", '""', "[]", "{}")
    number = F.try_variant_get(value, "$", "double")
    zero = kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE)") & (number == 0)
    return value.isNotNull() & ~empty & ~zero


def strict_int(value: Column) -> Column:
    """JSON integers (and booleans as 0/1); numeric strings and decimals give null."""
    return F.when(kind(value).isin("BIGINT", "BOOLEAN"), F.try_variant_get(value, "$", "int"))


def string_items(value: Column) -> Column:
    """The strings of a JSON list, other items dropped; anything but a list gives []."""
    items = F.filter(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda x: F.schema_of_variant(x) == "STRING",
    )
    texts = F.transform(items, lambda x: F.try_variant_get(x, "$", "string"))
    return F.coalesce(F.when(is_list(value), texts), F.array().cast(EMPTY))


def parse_reply(raw: Column) -> Column:
    """Reply text as VARIANT when it holds a JSON object, else null (a reject)."""
    return let(F.try_parse_json(json_slice(raw)), lambda v: F.when(is_object(v), v))


def reply_fields(value: Column, lookup: Column, valid: list[str]) -> list[Column]:
    """Typed columns of a parsed reply. ``value`` comes from :func:`parse_reply`."""
    countries = F.filter(string_items(field(value, "countries")), lambda c: c != "")
    return [
        truthy(field(value, "is_hpe")).alias("is_hpe"),
        strict_int(field(value, "period_start")).alias("period_start"),
        strict_int(field(value, "period_end")).alias("period_end"),
        names.valid_regions(string_items(field(value, "regions")), valid).alias("regions"),
        names.country_names(countries, lookup).alias("countries"),
    ]
