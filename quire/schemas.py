"""Schemas of the tables and of the landed files."""

ARTICLE = (
    "doi STRING, journal STRING, title STRING, year INT, month INT, "
    "volume STRING, issue STRING, pages STRING, abstract STRING"
)
AUTHOR = "doi STRING, sequence INT, given STRING, family STRING"
CLASSIFICATION = (
    "doi STRING, is_hpe BOOLEAN, period_start INT, period_end INT, "
    "regions ARRAY<STRING>, countries ARRAY<STRING>, backend STRING, model STRING, "
    "classified_at TIMESTAMP, replication_url STRING"
)
#: Which landed page last gave each article.
LANDED = (
    "doi STRING, landed STRUCT<time: TIMESTAMP, path: STRING, start: BIGINT>, line BIGINT, "
    "item_pos INT, run STRING, batch INT"
)
LOG_ENTRY = "list STRING, pos BIGINT, issue STRING, doi STRING, raw STRING"

ITEM = (
    "STRUCT<DOI: STRING, title: ARRAY<STRING>, "
    "author: ARRAY<STRUCT<given: STRING, family: STRING>>, abstract: STRING, "
    "published: STRUCT<`date-parts`: ARRAY<ARRAY<INT>>>, "
    "volume: STRING, issue: STRING, page: STRING, type: STRING>"
)
PAGE = f"message STRUCT<items: ARRAY<{ITEM}>>"

ABSTRACT_RESPONSE = "dois ARRAY<STRING>, items ARRAY<STRUCT<abstract: STRING>>"
DATAVERSE_RESPONSE = (
    "doi STRING, step STRING, status INT, attempt BIGINT, "
    "body STRUCT<data: STRUCT<items: ARRAY<STRUCT<url: STRING, name: STRING>>>>"
)
ZENODO_RESPONSE = (
    "doi STRING, step STRING, status INT, attempt BIGINT, "
    "body STRUCT<hits: STRUCT<hits: ARRAY<STRUCT<links: STRUCT<html: STRING>, "
    "metadata: STRUCT<title: STRING>>>>>"
)
REFERENCE_RESPONSE = (
    "doi STRING, status INT, attempt BIGINT, "
    "body STRUCT<message: STRUCT<reference: ARRAY<STRUCT<unstructured: STRING>>>>"
)
PUBLISHER_PAGE = "doi STRING, status INT, attempt BIGINT, url STRING, html STRING"
ISSUE = "issue_id STRING, type STRING, body STRING"
GEOGRAPHY = (
    "countries ARRAY<STRUCT<name: STRING, alpha3: STRING, continent: STRING, subregion: STRING>>"
)

ENTRY_FIELDS = [
    "doi", "title", "journal", "year", "abstract", "period_start", "period_end",
    "regions", "countries", "replication_url", "authors",
]


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL schema string."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).names
