"""Substring search for a whole table of queries, over an index of the entries' tokens.

A search term holds no white space, so each place it occurs in lies within one token of a text. The
index has two levels: grams lead to distinct tokens, tokens lead to entries. A term looks its
tokens up under its rarest gram of the greatest size in ``SIZES`` that it has, and verifies them, so that
numbered names, which have few different trigrams, meet few others; a query takes its rarest term's
entries and verifies its other terms on their texts. A token of one or two entries is held with them,
only for others are the texts read again. The entries' texts never meet the queries but for these
candidates. What is looked up goes to all tasks while it measures at most ``SENT`` bytes, so that the
index is not shuffled for a few queries; beyond that both sides are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text
from quire.sources.tables import staged

#: Lengths of the grams; a term shorter than ``GRAM`` is a gram of its own length.
GRAM = 3
SIZES = (1, 2, GRAM, 6, 12, 24)
#: Characters of what is cut in grams place by place, which takes the square of its length.
LONG = 64
#: Text that is sent to all tasks at most.
SENT = 16 << 20


def sent(rows: DataFrame, *texts: Column | str) -> DataFrame:
    """Stored rows, to be broadcast if ``texts`` and 64 bytes a row measure at most ``SENT``."""
    sizes = [F.coalesce(F.octet_length(F.col(t) if isinstance(t, str) else t), F.lit(0)) for t in texts]
    measured = rows.agg(F.sum(sum(sizes, F.lit(64)).cast("long"))).first()[0] or 0
    return F.broadcast(rows) if measured <= SENT else rows


def overlapping(value: Column, size: int) -> Column:
    """All grams of one size; of a long text in one pass."""
    places = F.sequence(F.lit(1), F.length(value) - (size - 1))
    short = F.transform(places, lambda i: F.substring(value, i, F.lit(size)))
    return F.when(F.length(value) < size, F.array().cast("array<string>")).when(
        F.length(value) <= LONG, short
    ).otherwise(F.regexp_extract_all(value, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def gram_size(term: Column) -> Column:
    """The greatest of ``SIZES`` that a term has; 0 for ''."""
    return F.coalesce(*[F.when(F.length(term) >= n, F.lit(n)) for n in reversed(SIZES)], F.lit(0))


def term_grams(term: Column) -> Column:
    """The grams of a term, of its greatest size; the whole term if it is shorter than ``GRAM``."""
    grams = F.array(term)
    for n in SIZES:
        if n >= GRAM:
            grams = F.when(F.length(term) >= n, overlapping(term, n)).otherwise(grams)
    return F.array_distinct(grams)


def token_grams(token: Column, sizes: Column) -> Column:
    """The grams of a token of those ``sizes`` that some term needs."""
    none = F.array().cast("array<string>")
    kinds = [
        F.when(F.array_contains(sizes, n) & (F.length(token) >= n), overlapping(token, n)).otherwise(none)
        for n in SIZES
    ]
    return F.array_distinct(F.concat(*kinds, F.when(token == "", F.array(token)).otherwise(none)))


def asked_terms(queries: DataFrame) -> DataFrame:
    """``query_id, terms``: each query's distinct terms; one that has none asks for ''."""
    terms = F.filter(F.split(F.lower("query"), text.WEB_SPACE), lambda t: t != "")
    found = F.array_distinct(F.coalesce(terms, F.array().cast("array<string>")))
    return queries.select(
        "query_id", F.when(F.size(found) == 0, F.array(F.lit(""))).otherwise(found).alias("terms")
    )


def entry_tokens(held: DataFrame, empty: Column) -> DataFrame:
    """``_id, token``: each distinct token of an entry, and '' where some query asks for it.

    ``_hay`` has no white space but blanks.
    """
    tokens = F.array_distinct(F.split("_hay", " "))
    tokens = F.array_remove(tokens, "")
    return held.withColumn("_empty", empty).select("_id", F.explode(
        F.when(F.col("_empty"), F.array_append(tokens, F.lit(""))).otherwise(tokens)
    ).alias("token"))


def tokens_of_terms(dictionary: DataFrame, terms: DataFrame) -> DataFrame:
    """``term`` and the dictionary's columns: the tokens that contain each term.

    Tokens meet only the terms whose rarest gram they share.
    """
    sizes = terms.agg(F.collect_set(gram_size(F.col("term")))).scalar()
    grams = dictionary.withColumn("_sizes", sizes).select(
        *dictionary.columns, F.explode(token_grams(F.col("token"), F.col("_sizes"))).alias("gram")
    )
    wanted = terms.select("term", F.explode(term_grams(F.col("term"))).alias("gram"))
    asked_for = sent(staged(wanted.select("gram").distinct(), "wanted"), "gram")
    grams = staged(grams.join(asked_for, "gram", "left_semi"), "wanted-grams")
    common = grams.groupBy("gram").agg(F.count("*").alias("df"))
    # A gram that no token has is the rarest of all: its term is nowhere.
    rarest = wanted.join(common, "gram", "left").groupBy("term").agg(
        F.min_by("gram", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("gram")
    )
    rarest = staged(rarest, "grams")
    # Far fewer grams lead to terms than tokens have, so most rows go before any shuffle.
    leading = sent(staged(rarest.select("gram").distinct(), "leading"), "gram")
    met = grams.join(leading, "gram", "left_semi")
    return met.join(sent(rarest, "term", "gram"), "gram").where(F.col("token").contains(F.col("term"))).select(
        "term", *dictionary.columns
    )


def rarest_terms(asked: DataFrame, term_tokens: DataFrame) -> DataFrame:
    """``query_id, terms, term``: the term of each query that is in the fewest entries; queries with a
    term that is nowhere are left out."""
    sizes = term_tokens.groupBy("term").agg(F.sum("n").alias("size"))
    each = asked.select("query_id", "terms", F.explode("terms").alias("term"))
    return each.join(sizes, "term", "left").groupBy("query_id", "terms").agg(
        F.min_by(F.struct("term", "size"), F.struct(F.coalesce("size", F.lit(0)).alias("s"), "term"))
        .alias("_least")
    ).where("_least.size is not null").select("query_id", "terms", F.col("_least.term").alias("term"))


def search_texts(entries: DataFrame, hay: Column, queries: DataFrame) -> DataFrame:
    """``query_id`` and the entry columns, one row for every query an entry's text ``hay`` matches.

    ``hay`` has no white space but blanks, which alone part its tokens (``browse.haystack(flat=True)``).
    All white-space separated terms of a ``query`` must occur in it; a query without a term, or a null one,
    matches everything. Equal rows of either table count each.
    """
    texts = entries.select("*", F.monotonically_increasing_id().alias("_id"), hay.alias("_hay"))
    held = staged(texts, "texts")
    asked = staged(asked_terms(queries), "asked")
    terms = staged(asked.select(F.explode("terms").alias("term")).distinct(), "terms")
    empty = terms.agg(F.coalesce(F.bool_or(F.col("term") == ""), F.lit(False))).scalar()
    places = entry_tokens(held, empty)
    dictionary = staged(places.groupBy("token").agg(
        F.count("*").alias("n"), F.min("_id").alias("first"), F.max("_id").alias("last")
    ), "tokens")
    term_tokens = staged(tokens_of_terms(dictionary, terms), "term-tokens")
    rarest = staged(rarest_terms(asked, term_tokens), "rarest")
    lead = staged(term_tokens.join(rarest.select("term").distinct(), "term", "left_semi"), "lead")
    met = lead.where("n <= 2").select(F.explode(F.array_distinct(F.array("first", "last"))).alias("_id"), "term")
    more = lead.where("n > 2").select("token", "term")
    if not more.isEmpty():
        met = met.union(places.join(sent(more, "token", "term"), "token").select("_id", "term"))
    # An entry may hold a term in several tokens.
    candidates = staged(met.distinct().join(rarest, "term").select("_id", "query_id", "terms"), "candidates")

    def held_by(some: DataFrame) -> DataFrame:
        return held.join(sent(some, F.col("query_id").cast("string"), F.array_join("terms", " ")), "_id")

    # A single term is found already, its entries' texts aren't read again.
    found = held_by(candidates.where(F.size("terms") > 1)).where(
        F.forall("terms", lambda t: F.col("_hay").contains(t))
    ).select("query_id", *entries.columns).union(
        held_by(candidates.where(F.size("terms") == 1)).select("query_id", *entries.columns)
    )
    return found
