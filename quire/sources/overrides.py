"""The override log: landed documents with two arrays, or the stored entry table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import replies
from quire.operators.overrides import ADDITIONS, CORRECTIONS


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Override documents as ``value, path`` (one hand-edited JSON document per file).

    A document is one row, as JSON arrays have no line structure to split at; large amounts of
    entries belong in the stored log (:func:`read_log`), which is read row by row.
    """
    return spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("path")
    )


def parsed_documents(docs: DataFrame) -> DataFrame:
    """``path, d, reason``: the two entry arrays, or why a document cannot be used."""
    ddl = f"STRUCT<{CORRECTIONS}: ARRAY<VARIANT>, {ADDITIONS}: ARRAY<VARIANT>>"
    v = F.col("v")
    parsed = docs.select("path", F.try_parse_json("value").alias("v"))

    def wrong(name: str):
        part = F.try_variant_get(v, f"$.{name}", "variant")
        return F.when(part.isNotNull() & ~replies.is_list(part), F.lit(f"{name} is not a list"))

    reason = F.when(v.isNull(), "not JSON").when(
        ~replies.is_object(v), "not a JSON object"
    ).otherwise(F.coalesce(wrong(CORRECTIONS), wrong(ADDITIONS)))
    return parsed.select(
        "path", reason.alias("reason"), F.try_variant_get(v, "$", ddl).alias("d")
    )


def document_rejects(docs: DataFrame) -> DataFrame:
    """``path, reason`` of the documents that give no entries because they cannot be read."""
    return parsed_documents(docs).where("reason is not null").select("path", "reason")


def document_entries(docs: DataFrame) -> DataFrame:
    """``value, path`` documents to log entries; explicit nulls and absent keys stay apart.

    Entries are ordered by document path, then by position: ``pos`` counts all entries up to
    the document, one row per document in the running sum, and then goes on inside it.
    """
    parsed = parsed_documents(docs).where("reason is null")
    none = F.lit(0).cast("bigint")
    sizes = [F.coalesce(F.size(f"d.{name}").cast("bigint"), none) for name in (CORRECTIONS, ADDITIONS)]
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parsed.select(F.col("path").alias("of"), F.greatest(*sizes).alias("n")).select(
        "of", F.coalesce(F.sum("n").over(before), none).alias("before")
    )
    placed, both = parsed.join(offsets, F.col("path") == F.col("of")), None
    for name in (CORRECTIONS, ADDITIONS):
        rows = placed.select(
            F.lit(name).alias("list"), "before",
            F.posexplode(F.col(f"d.{name}")).alias("i", "entry"),
        )
        both = rows if both is None else both.unionByName(rows)
    return both.select(
        "list", (F.col("before") + F.col("i")).alias("pos"),
        F.try_variant_get("entry", "$._issue", "string").alias("issue"),
        F.try_variant_get("entry", "$.doi", "string").alias("doi"),
        F.to_json("entry").alias("raw"),
    ).select(*schemas.names(schemas.LOG_ENTRY))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored log: one row per entry, appended by the issue job."""
    return spark.read.schema(schemas.LOG_ENTRY).parquet(path)
