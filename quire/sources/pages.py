"""Landed metadata pages: JSON lines, one page ``{message: {items: [...]}}`` per line.

Files lie in one directory per journal (``journal=<abbrev>/``), so a journal is a
partition filter and not a loop. The explicit schema names only the fields in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas


BROKEN = "_broken"
LINES = "value STRING, journal STRING"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page rows with ``journal`` from the path and the landing order of the line.

    A line that is not such a page, or has a value of another type (a year as text), is kept
    in ``_broken`` as it stands; :func:`good_pages` and :func:`page_rejects` tell them apart.
    """
    return with_lines(with_files(spark.read.schema(LINES).text(path)))


def good_pages(pages: DataFrame) -> DataFrame:
    return pages.where(f"{BROKEN} is null").drop(BROKEN)


def page_rejects(pages: DataFrame) -> DataFrame:
    """The broken lines, with what else is known of them."""
    rest = [c for c in pages.columns if c not in ("message", BROKEN)]
    return pages.where(f"{BROKEN} is not null").select(F.col(BROKEN).alias("line_text"), *rest)


def page_of(text: str) -> Column:
    ddl = f"{schemas.PAGE}, {BROKEN} STRING"
    return F.from_json(text, ddl, {"columnNameOfCorruptRecord": BROKEN})


def with_files(lines: DataFrame) -> DataFrame:
    """Parsed lines with ``landed``: when and in which file split a page came in."""
    landed = F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    rows = lines.where(F.trim("value") != "").select(
        page_of("value").alias("_page"), "journal", landed.alias("landed")
    )
    return rows.select("_page.message", "journal", f"_page.{BROKEN}", "landed")


def with_lines(pages: DataFrame) -> DataFrame:
    """Add ``line``, which ascends within a file split."""
    return pages.withColumn("line", F.monotonically_increasing_id())


def parse_pages(lines: DataFrame, text: str = "value") -> DataFrame:
    """Pages held as text in a column; other columns are carried along."""
    rest = [c for c in lines.columns if c != text]
    return lines.select(page_of(text).alias("_page"), *rest).select("_page.message", f"_page.{BROKEN}", *rest)


def page_items(pages: DataFrame) -> DataFrame:
    """One row per item: ``item``, its position ``item_pos``, and the page's other columns."""
    rest = [c for c in pages.columns if c != "message"]
    return pages.select(F.posexplode("message.items").alias("item_pos", "item"), *rest)


INGEST_ORDER = ["landed", "line", "item_pos"]
