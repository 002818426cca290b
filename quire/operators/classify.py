"""Classification: request rows out, landed replies back in as typed records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import vocab
from quire.functions import replies, text
from quire.operators import dims


def request_id(doi: Column) -> Column:
    """Identifier a batch service accepts: letters and digits, 64 characters."""
    return F.sha2(doi, 256)


def request_map(articles: DataFrame) -> DataFrame:
    """``custom_id, doi``: stored next to the requests, joined to the replies."""
    return articles.select(request_id(F.col("doi")).alias("custom_id"), "doi")


def message_requests(
    articles: DataFrame, model: str, system: str, max_tokens: int = vocab.REPLY_TOKENS
) -> DataFrame:
    """One JSON line per article, message-style batch format."""
    user = F.struct(
        F.lit("user").alias("role"), text.prompt(F.col("title"), F.col("abstract")).alias("content")
    )
    params = F.struct(
        F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"),
        F.lit(system).alias("system"), F.array(user).alias("messages"),
    )
    line = F.struct(request_id(F.col("doi")).alias("custom_id"), params.alias("params"))
    return articles.select(F.to_json(line).alias("value"))


def chat_requests(
    articles: DataFrame, model: str, system: str, max_tokens: int = vocab.REPLY_TOKENS
) -> DataFrame:
    """One JSON line per article, chat-completion batch format."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    body = F.struct(
        F.lit(model).alias("model"),
        F.array(
            message("system", F.lit(system)),
            message("user", text.prompt(F.col("title"), F.col("abstract"))),
        ).alias("messages"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
        F.lit(max_tokens).alias("max_tokens"),
    )
    line = F.struct(
        request_id(F.col("doi")).alias("custom_id"), F.lit("POST").alias("method"),
        F.lit("/v1/chat/completions").alias("url"), body.alias("body"),
    )
    return articles.select(F.to_json(line).alias("value"))


def score_with(
    articles: DataFrame, score: Callable[[Iterator], Iterator]
) -> DataFrame:
    """Plug in a classifier of one's own: pandas batches of ``doi, title, abstract`` in,
    batches of ``doi, raw`` (reply text) out."""
    return articles.select("doi", "title", "abstract").mapInPandas(
        score, "doi STRING, raw STRING"
    )


def resolve_dois(reply_rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Replies keyed by request id to replies keyed by DOI; ``custom_id`` stays.

    No reply is lost: one that cannot be read keeps its reason, one with an id that nobody
    asked for gets a reason.
    """
    if "reason" not in reply_rows.columns:
        reply_rows = reply_rows.withColumn("reason", F.lit(None).cast("string"))
    found = reply_rows.join(ids, "custom_id", "left")
    unknown = F.when(F.col("doi").isNull(), F.lit("unknown request id"))
    return found.withColumn("reason", F.coalesce("reason", unknown))


def parsed_replies(reply_rows: DataFrame) -> DataFrame:
    """Add ``parsed`` (VARIANT object or null) and a reject ``reason``.

    Rows that have been parsed, and perhaps stored, stay as they are.
    """
    if "parsed" in reply_rows.columns:
        return reply_rows
    if "reason" not in reply_rows.columns:
        reply_rows = reply_rows.withColumn("reason", F.lit(None).cast("string"))
    reason = F.when(F.col("parsed").isNull(), F.lit("not a JSON object"))
    return text.once(reply_rows, "parsed", replies.parse_reply(F.col("raw"))).withColumn(
        "reason", F.coalesce("reason", reason)
    )


def classified(
    reply_rows: DataFrame, lookup: Column, backend: str, model: str,
    at: Column | None = None, valid: list[str] = vocab.REGIONS,
) -> DataFrame:
    """Typed classification records from ``doi, raw`` replies.

    Rejected replies are left out, so their articles stay on the worklist;
    :func:`rejected` lists them. ``lookup`` comes from ``dims.country_lookup``.
    """
    good = parsed_replies(reply_rows).where(F.col("reason").isNull())
    stamp = F.current_timestamp() if at is None else at
    return good.withColumn("_lookup", lookup).select(
        "doi", *replies.reply_fields(F.col("parsed"), F.col("_lookup"), valid),
        F.lit(backend).alias("backend"), F.lit(model).alias("model"),
        stamp.alias("classified_at"), F.lit(None).cast("string").alias("replication_url"),
    )


def rejected(reply_rows: DataFrame) -> DataFrame:
    """Replies that gave no record, with the reason."""
    return parsed_replies(reply_rows).where(F.col("reason").isNotNull()).drop("parsed")


def unknown_names(
    reply_rows: DataFrame, geo: DataFrame, aliases: DataFrame | None = None,
    valid: list[str] = vocab.REGIONS,
) -> DataFrame:
    """``doi, kind, name``: region and country names of good replies that no table knows, each once
    for a reply."""
    good = parsed_replies(reply_rows).where(F.col("reason").isNull())
    listed = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.array_distinct(
            replies.string_items(replies.field(F.col("parsed"), field))
        ).alias("names"))
        for kind, field in (("region", "regions"), ("country", "countries"))
    ])
    each = good.select("doi", F.inline(listed)).select("doi", "kind", F.explode("names").alias("name"))
    strange = (F.col("kind") == "country") | ~F.col("name").isin([*valid, *vocab.REGION_ALIASES])
    known = dims.known_countries(geo, aliases).select(
        F.lit("country").alias("kind"), F.col("known").alias("_known")
    )
    same = (each["kind"] == known["kind"]) & (F.lower(each["name"]) == known["_known"])
    return each.where((F.col("name") != "") & strange).join(known, same, "left_anti")
