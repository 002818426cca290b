"""Landed responses of other services, one JSON line per response.

Every reader gives a flat table; ``attempt`` orders repeated responses for one key. A line that cannot
be used is a row with its text and a reason: :func:`good` and :func:`rejects` tell them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas, vocab
from quire.functions import replies
from quire.functions.text import once
from quire.operators.links import page_link, reference_candidates


#: Columns that tell what a response line could not be used for; null in good rows.
REJECT = ["line_text", "reason"]
BROKEN = "_broken"


def read_lines(spark: SparkSession, path: str, ddl: str, key: str) -> DataFrame:
    """Response lines, blank ones skipped, with ``line_text`` and ``reason`` where a line is cut off,
    holds a value of another type, or lacks its ``key``."""
    broken = {"columnNameOfCorruptRecord": BROKEN}
    parsed = F.from_json("value", f"{ddl}, {BROKEN} STRING", broken)
    rows = once(spark.read.text(path).where(F.trim("value") != ""), "_line", parsed)
    line = F.col("_line")
    reason = F.when(
        line.isNull() | line[BROKEN].isNotNull(), F.lit("unreadable line")
    ).when(line[key].isNull(), F.lit(f"no {key}"))
    return rows.select(
        *[line[c].alias(c) for c in schemas.names(ddl)],
        F.when(reason.isNotNull(), F.col("value")).alias("line_text"), reason.alias("reason"),
    )


def carried(responses: DataFrame) -> list[str]:
    return [c for c in REJECT if c in responses.columns]


def good(responses: DataFrame) -> DataFrame:
    """The responses that can be used."""
    return responses.where(F.col("reason").isNull()).drop(*REJECT)


def rejects(responses: DataFrame) -> DataFrame:
    """``line_text, reason`` of the lines that cannot."""
    return responses.where(F.col("reason").isNotNull()).select(*REJECT)


def read_abstracts(spark: SparkSession, path: str) -> DataFrame:
    """Abstract batches: requested ``dois`` and answers aligned by position, and rejects."""
    ddl = f"{schemas.ABSTRACT_RESPONSE}, attempt BIGINT"
    return read_lines(spark, path, ddl, "dois").fillna(0, ["attempt"])


def read_dataverse(spark: SparkSession, path: str) -> DataFrame:
    return dataverse_hits(read_lines(spark, path, schemas.DATAVERSE_RESPONSE, "doi"))


def dataverse_hits(responses: DataFrame) -> DataFrame:
    """``doi, step, attempt, ok, n_hits, url`` of first-repository searches.

    ``step`` is ``field``, ``full_text`` or ``title``.
    """
    items = F.col("body.data.items")
    return search_hits(responses, F.size(items), F.get(items, 0)["url"])


def read_zenodo(spark: SparkSession, path: str) -> DataFrame:
    return zenodo_hits(read_lines(spark, path, schemas.ZENODO_RESPONSE, "doi"))


def zenodo_hits(responses: DataFrame) -> DataFrame:
    """``doi, step, attempt, ok, n_hits, url`` of second-repository searches."""
    items = F.col("body.hits.hits")
    return search_hits(responses, F.size(items), F.get(items, 0)["links"]["html"])


def search_hits(responses: DataFrame, n_hits, url) -> DataFrame:
    return responses.select(
        "doi", "step", F.coalesce("attempt", F.lit(0)).alias("attempt"),
        (F.coalesce("status", F.lit(0)) == 200).alias("ok"),
        F.coalesce(n_hits, F.lit(0)).alias("n_hits"), url.alias("url"), *carried(responses),
    )


def read_references(spark: SparkSession, path: str) -> DataFrame:
    return references(read_lines(spark, path, schemas.REFERENCE_RESPONSE, "doi"))


def references(responses: DataFrame) -> DataFrame:
    """``doi, attempt, candidates``: repository DOIs in an article's reference list."""
    listed = F.transform(
        "body.message.reference", lambda r: F.coalesce(r["unstructured"], F.lit(""))
    )
    answered = F.coalesce("status", F.lit(0)) == 200
    return responses.select(
        "doi", F.coalesce("attempt", F.lit(0)).alias("attempt"),
        F.when(answered, reference_candidates(listed)).alias("candidates"), *carried(responses),
    )


def read_publisher_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed publisher pages (parquet)."""
    return publisher_pages(spark.read.schema(schemas.PUBLISHER_PAGE).parquet(path))


def publisher_pages(
    pages: DataFrame, site: str = vocab.PAGE_SITE, pattern: str = vocab.ARCHIVE_LINK
) -> DataFrame:
    """``doi, attempt, page_url``: the page's final URL when it links to an archive."""
    return pages.select(
        "doi", F.coalesce("attempt", F.lit(0)).alias("attempt"),
        page_link(F.col("status"), F.col("url"), F.col("html"), site, pattern).alias("page_url"),
    )


def message_replies(lines: DataFrame, text: str = "value") -> DataFrame:
    """Result lines of the message-style batch format to ``custom_id, raw, reason``.

    The first content block counts when it is text; otherwise the reply is an empty object.
    """
    ddl = (
        "custom_id STRING, result STRUCT<type: STRING, message: STRUCT<"
        "content: ARRAY<STRUCT<type: STRING, text: STRING>>>>"
    )
    row = lines.where(F.trim(text) != "").select(F.from_json(text, ddl).alias("r"))
    first = F.get(F.col("r.result.message.content"), 0)
    kind = F.coalesce("r.result.type", F.lit("unreadable line"))
    return row.select(
        "r.custom_id",
        F.when(kind == "succeeded", F.coalesce(
            F.when(first["type"] == "text", first["text"]), F.lit("{}")
        )).alias("raw"),
        F.when(kind != "succeeded", kind).alias("reason"),
    )


def chat_replies(lines: DataFrame, text: str = "value") -> DataFrame:
    """Result lines of the chat-completion batch format to ``custom_id, raw, reason``.

    Blank lines are skipped; a line with an error, or without a message, is a reject.
    """
    row = lines.where(F.trim(text) != "").select(F.try_parse_json(text).alias("v"))
    v = F.col("v")
    content = F.try_variant_get(v, "$.response.body.choices[0].message.content", "variant")
    kind = replies.kind(content)
    said = F.try_variant_get(content, "$", "string")
    reason = (
        F.when(v.isNull(), "unreadable line")
        .when(replies.truthy(replies.field(v, "error")), "error")
        .when(content.isNull() | ~kind.isin("STRING", "VOID"), "malformed response")
    )
    return row.select(
        F.try_variant_get(v, "$.custom_id", "string").alias("custom_id"),
        F.when(reason.isNull(), F.when(said != "", said).otherwise(F.lit("{}"))).alias("raw"),
        reason.alias("reason"),
    )


def read_message_replies(spark: SparkSession, path: str) -> DataFrame:
    return message_replies(spark.read.text(path))


def read_chat_replies(spark: SparkSession, path: str) -> DataFrame:
    return chat_replies(spark.read.text(path))
