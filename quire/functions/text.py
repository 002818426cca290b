"""Text expressions: trimming, JSON slicing, markup removal, identifiers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import vocab

# The two whitespace sets in play: form and reply text follow the first,
# catalogue text the second. Java's own \s knows ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WEB_SPACE = r"[\t-\r \xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
LINE_BREAK = r"(?:\r\n|[\n-\r\x1c-\x1e\x85\u2028\u2029])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def members(space: str) -> str:
    """The characters of a whitespace class."""
    return "".join(c for c in map(chr, range(0x10000)) if re.fullmatch(space, c))


SPACES, WEB_SPACES = members(SPACE), members(WEB_SPACE)


def strip(text: Column, spaces: str = SPACES) -> Column:
    """Remove whitespace, line breaks included, from both ends."""
    return F.btrim(text, F.lit(spaces))


def first_part(text: Column, mark: str) -> Column:
    """Text before the first ``mark``, all of it when there is none."""
    return F.substring_index(text, mark, 1)


def second_part(text: Column, mark: str) -> Column:
    """Text after the first one-character ``mark``, '' when there is none."""
    return F.substr(text, F.length(first_part(text, mark)) + F.lit(1 + len(mark)))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    The optimizer copies a projected expression into every filter and column that uses it.
    It does not look through a generator, here one that gives a single row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def json_slice(raw: Column) -> Column:
    """The JSON object inside a chatty or code-fenced reply, else the stripped reply."""
    def unfenced(whole: Column) -> Column:
        lines = F.regexp_replace(whole, LINE_BREAK, "\n")
        inner = second_part(lines, "\n")
        bare = F.regexp_replace(inner, f"(?:^|\\n){SPACE}*```{SPACE}*\\z", "")
        return F.when(whole.startswith("```"), bare).otherwise(whole)

    def sliced(body: Column) -> Column:
        inside = F.regexp_extract(body, r"(?s)\{.*\}", 0)
        return F.when(body.contains("{") & body.contains("}"), inside).otherwise(body)

    return let(let(strip(raw), unfenced), sliced)


def prompt(title: Column, abstract: Column) -> Column:
    """The user message that asks for one record's tags."""
    return F.concat(
        F.lit("Title: "), F.coalesce(title, F.lit("")),
        F.lit("\nAbstract: "), F.coalesce(abstract, F.lit(vocab.NO_ABSTRACT)),
    )


def long_tokens(title: Column, least: int = 6) -> Column:
    """Words of at least ``least`` characters, in one pass over the text."""
    return F.regexp_extract_all(title, F.lit(rf"[\p{{L}}\p{{N}}_]{{{least},}}+"), F.lit(0))


def repository_doi(reference: Column) -> Column:
    """First repository DOI in a reference string, null when there is none."""
    packed = F.replace(reference, F.lit(" "), F.lit(""))
    found = F.when(packed.contains("10."), F.regexp_extract(packed, vocab.REPOSITORY_DOI, 0))
    return blank_to_null(F.regexp_replace(found, r"[.,;]+\z", ""))


def plain_text(markup: Column) -> Column:
    """Markup reduced to plain text without a leading "Abstract" heading; null gives ''.

    Single blanks are left alone when whitespace is collapsed, as they are most of it.
    """
    runs = f" {WEB_SPACE}+|{WEB_SPACE[:6]}{WEB_SPACE[7:]}{WEB_SPACE}*"
    untagged = F.regexp_replace(F.coalesce(markup, F.lit("")), "<[^>]+>", " ")
    flat = strip(F.regexp_replace(untagged, runs, " "), WEB_SPACES)
    return strip(F.regexp_replace(flat, r"(?i)^abstract[ :.\-]+", ""), WEB_SPACES)


def doi_link(doi: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), doi)


def has_archive_link(html: Column, pattern: str = vocab.ARCHIVE_LINK) -> Column:
    return html.rlike(pattern)


def json_list(text: Column) -> Column:
    """Decode a JSON list of strings; null, '' and non-lists give an empty list."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def json_list_text(items: Column) -> Column:
    return F.to_json(F.coalesce(items, F.array().cast("array<string>")))


def excluded_title(title: Column) -> Column:
    """True for notices such as errata; null when the title is null."""
    return F.lower(title).rlike("|".join(vocab.EXCLUDED_TITLE_WORDS))
