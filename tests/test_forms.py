import json

from pyspark.sql import functions as F

from quire.operators.overrides import append_entries
from quire.sources.issues import accepted_entries, parsed_issues

ISSUE = "issue_id STRING, type STRING, body STRING, pos BIGINT"
LOG = "list STRING, pos BIGINT, issue STRING, doi STRING, raw STRING"


def form(**fields):
    return "\n".join(f"### {k}\n\n{v}\n" for k, v in fields.items())


def parse(spark, kind, **fields):
    df = spark.createDataFrame([("1", kind, form(**fields), 0)], ISSUE)
    return parsed_issues(df).first()


def correction(spark, **fields):
    return json.loads(parse(spark, "correction", **fields)["raw"])


FULL_ADDITION = {
    "Title (paper or dataset)": "A Title", "Authors": "Doe, Jane; Roe, R.", "DOI": "10.1/new",
    "Data link": "https://data.example/x", "Journal": "", "Publication year": "2020",
    "Geographic coverage": "Western Europe, Caribbean", "Countries": "France, Cuba",
    "Period start (year)": "-20", "Period end (year)": "late", "Notes": "_No response_",
    "Abstract / Short Description": "Short.",
}


def test_correction_fields(spark):
    assert correction(spark, **{
        "DOI": " 10.1/x ", "Corrected title": "New", "Corrected publication year": "1999",
        "Corrected abstract": "Text", "Corrected authors": "Doe, Jane",
        "Corrected geographic coverage": "Western Europe", "Corrected countries": "France, Spain",
        "Corrected time period": "1800–1870", "Corrected data link": "http://d",
        "Should this paper be excluded from the database?": "Yes, exclude it",
        "Source / justification": "see paper",
    }) == {
        "doi": "10.1/x", "title": "New", "year": 1999, "abstract": "Text",
        "authors": [{"family": "Doe", "given": "Jane"}], "regions": ["Western Europe"],
        "countries": ["France", "Spain"], "period_start": 1800, "period_end": 1870,
        "replication_url": "http://d", "is_hpe": False, "note": "see paper",
    }


def test_correction_leaves_out_what_was_not_given(spark):
    assert correction(spark, **{
        "DOI": "10.1/x", "Corrected title": "", "Corrected publication year": "soon",
        "Corrected authors": "_No response_", "Corrected time period": "unknown",
        "Should this paper be excluded from the database?": "No",
    }) == {"doi": "10.1/x"}


def test_correction_requires_doi(spark):
    row = parse(spark, "correction", DOI="_No response_")
    assert row["raw"] is None and row["reason"] == "DOI is required"


def test_addition(spark):
    assert json.loads(parse(spark, "new-entry", **FULL_ADDITION)["raw"]) == {
        "is_hpe": True, "title": "A Title", "doi": "10.1/new",
        "replication_url": "https://data.example/x", "countries": ["France", "Cuba"],
        "year": 2020, "regions": ["Western Europe", "Caribbean"], "abstract": "Short.",
        "authors": [{"family": "Doe", "given": "Jane"}, {"family": "Roe", "given": "R."}],
        "period_start": -20,
    }


def test_addition_minimal_and_missing(spark):
    least = {k: FULL_ADDITION[k] for k in
             ("Title (paper or dataset)", "Authors", "DOI", "Data link")}
    entry = json.loads(parse(spark, "new-entry", **least)["raw"])
    assert entry["countries"] == [] and "regions" not in entry and "year" not in entry
    row = parse(spark, "new-entry", **{**least, "Authors": "", "Data link": " "})
    assert row["raw"] is None and row["reason"] == "Missing required fields: Authors, Data link"


def entry(pos, issue, doi, which="corrections"):
    return (which, pos, issue, doi, json.dumps({"doi": doi}))


def positions(df):
    return sorted(r["pos"] for r in df.collect())


def test_append_guards(spark):
    log = spark.createDataFrame(
        [entry(0, "7", "10.1/a"), entry(1, None, "10.1/b"), entry(2, "9", "10.1/z", "additions")], LOG
    )
    new = spark.createDataFrame([
        entry(10, "7", "10.1/q"),      # issue applied before
        entry(11, "8", "10.1/a"),      # another issue, same DOI: kept
        entry(12, None, "10.1/a"),     # no issue, DOI in the log
        entry(13, None, "10.1/c"),     # kept
        entry(14, None, "10.1/c"),     # repeats the one before
        entry(15, "20", "10.1/d"),     # kept
        entry(16, None, "10.1/d"),     # DOI came in with issue 20
        entry(17, None, "10.1/e"),     # kept
        entry(18, "21", "10.1/e"),     # kept
        entry(19, None, None),         # neither: kept
        entry(20, None, ""),           # neither: kept
        entry(21, "9", "10.1/z"),      # other list: kept
        entry(22, "8", "10.1/f"),      # repeats issue 8
    ], LOG)
    assert positions(append_entries(log, new)) == [11, 13, 15, 17, 18, 19, 20, 21]


def test_accepted_entries_feed_the_log(spark):
    issues = spark.createDataFrame([
        ("1", "correction", form(DOI="10.1/x"), 0),
        ("2", "new-entry", form(DOI="10.1/y"), 1),
        ("3", "question", "hello", 2),
    ], ISSUE)
    rows = accepted_entries(issues).collect()
    assert [(r["list"], r["issue"], r["doi"]) for r in rows] == [("corrections", "1", "10.1/x")]
    reasons = {r["issue"]: r["reason"] for r in parsed_issues(issues).where(
        F.col("reason").isNotNull()).collect()}
    assert set(reasons) == {"2", "3"} and reasons["3"] == "unknown type"
