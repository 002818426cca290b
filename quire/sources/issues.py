"""Issue forms: a table of bodies in, override log entries out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import forms
from quire.functions.text import once
from quire.operators.overrides import ADDITIONS, CORRECTIONS

# Issue types and the log list each goes to.
LISTS = {"correction": CORRECTIONS, "new-entry": ADDITIONS}


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{schemas.ISSUE}, pos BIGINT").json(path)


def parsed_issues(issues: DataFrame) -> DataFrame:
    """Issue rows to ``list, pos, issue, doi, raw`` plus a reject ``reason``."""
    fields = F.col("fields")
    is_fix = F.col("type") == "correction"
    missing = forms.missing_headings(fields)
    reason = (
        F.when(~F.coalesce(F.col("type"), F.lit("")).isin(list(LISTS)), F.lit("unknown type"))
        .when(is_fix & F.col("raw").isNull(), F.lit("DOI is required"))
        .when(~is_fix & F.col("raw").isNull(), F.concat(
            F.lit("Missing required fields: "), F.array_join(missing, ", ")))
    )
    parsed = once(issues, "fields", forms.sections(F.col("body")))
    entry = F.when(is_fix, forms.correction_entry(fields)).when(
        F.col("type") == "new-entry", forms.addition_entry(fields)
    )
    return once(parsed, "raw", entry).select(
        F.when(is_fix, CORRECTIONS).otherwise(ADDITIONS).alias("list"), "pos",
        F.col("issue_id").alias("issue"), forms_doi(fields).alias("doi"),
        "raw", reason.alias("reason"),
    )


def forms_doi(fields: Column) -> Column:
    return forms.field(fields, "DOI")


def accepted(parsed: DataFrame) -> DataFrame:
    """Log entries of the issues that parse."""
    return parsed.where(F.col("reason").isNull()).select(*schemas.names(schemas.LOG_ENTRY))


def rejected(parsed: DataFrame) -> DataFrame:
    """Issues that give no entry, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("list", "pos", "issue", "doi", "reason")


def accepted_entries(issues: DataFrame) -> DataFrame:
    return accepted(parsed_issues(issues))
