"""Searching with a table of queries, against one query at a time."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import browse, postings

DDL = "doi STRING, title STRING, abstract STRING, regions ARRAY<STRING>, n INT"
QUERIES = "query_id STRING, query STRING"


@pytest.fixture(scope="module")
def entries(spark):
    draw = random.Random(4)
    words = ["Trade", "traders", "de", "d", "🙂xy", "a🙂", "C++", "(x)", "é", "ÉON", "aaa", "aa", "10.1/7", "10.1/77", "x\ny"]
    rows = [
        (f"10.1/{i}", " ".join(draw.choice(words) for _ in range(draw.randrange(6))),
         draw.choice([None, "", "<b>Tariffs</b>  and more", "éon LA"]), draw.choice([None, [], ["Asia", None]]), i)
        for i in range(80)
    ]
    return spark.createDataFrame(rows + rows[:3] + [(None, None, None, None, None)], DDL)


ASKED = [
    ("trade", "TRADE"), ("two", "trade  aa"), ("short", "d"), ("two letters", "de"), ("emoji", "🙂x"), ("half", "🙂"),
    ("signs", "c++ (x"), ("none", "zebra"), ("half none", "trade zebra"), ("empty", ""), ("blank", " \t\n"), ("null", None),
    ("twice", "aa aa aaa"), ("twice", "trade"), ("doi", "10.1/7"), ("tag", "tariffs and"), ("accent", "éON"),
    (None, "asia"), ("line", "x y"), ("far", "aaaa"),
]


def rows(df):
    return sorted(map(tuple, df.select("query_id", "doi", "n").collect()), key=repr)


def test_a_table_of_queries_equals_single_queries(spark, entries):
    got = rows(browse.search_table(entries, spark.createDataFrame(ASKED, QUERIES)))
    want = []
    for i, q in ASKED:
        hits = browse.search(entries, q or "").select("doi", "n").collect()
        want += [(i, *r) for r in hits]
    assert got == sorted(want, key=repr) and len(got) > 100


def test_no_queries_and_no_entries(spark, entries):
    none = spark.createDataFrame([], QUERIES)
    assert browse.search_table(entries, none).count() == 0
    asked = spark.createDataFrame(ASKED, QUERIES)
    assert browse.search_table(entries.limit(0), asked).count() == 0
    assert browse.search_table(entries, asked).columns == ["query_id", *entries.columns]


def test_grams_of_a_term_are_among_its_tokens_grams(spark):
    draw = random.Random(2)
    letters = "ab🙂é́ .(𝔸x"
    pairs = []
    for _ in range(300):
        token = "".join(draw.choice(letters) for _ in range(draw.randrange(1, 9)))
        a = draw.randrange(len(token))
        pairs.append((token, token[a:a + draw.randrange(1, 6)]))
    df = spark.createDataFrame(pairs, "token STRING, term STRING")
    sizes = F.array(F.lit(1), F.lit(2), F.lit(3))
    missing = F.array_except(
        postings.term_grams(F.col("term")), postings.token_grams(F.col("token"), sizes))
    assert df.where(F.size(missing) > 0).count() == 0


def test_only_tokens_with_a_terms_rarest_gram_are_compared(spark):
    dictionary = spark.createDataFrame([(f"common{i}", 5) for i in range(50)] + [("commonrare", 1)], "token STRING, n LONG")
    terms = spark.createDataFrame([("nrare",), ("common",), ("absent",)], "term STRING")
    got = postings.tokens_of_terms(dictionary, terms)
    assert got.where("term = 'nrare'").collect() == [("nrare", "commonrare", 1)]
    assert got.where("term = 'common'").count() == 51 and got.where("term = 'absent'").count() == 0
    asked = spark.createDataFrame([("q", ["common", "nrare"]), ("r", ["absent", "common"])], "query_id STRING, terms ARRAY<STRING>")
    assert [tuple(r) for r in postings.rarest_terms(asked, got).select("query_id", "term").collect()] == [("q", "nrare")]


def test_numbered_names_meet_few_others(spark):
    # By trigrams, every name would meet a hundredth of all.
    names = spark.range(1000, 6000).select(
        F.format_string("doc/%d", "id").alias("token"), F.lit(1).cast("long").alias("n"))
    terms = names.select(F.col("token").alias("term"))
    sizes = F.array(*[F.lit(n) for n in postings.SIZES])
    grams = names.select("token", F.explode(postings.token_grams(F.col("token"), sizes)).alias("gram"))
    met = terms.select("term", F.explode(postings.term_grams(F.col("term"))).alias("gram")).join(grams, "gram")
    least = met.groupBy("term", "gram").count().groupBy("term").agg(F.min("count").alias("n"))
    assert least.agg(F.max("n")).first()[0] <= 10
    assert sorted(postings.tokens_of_terms(names, terms).select("term", "token").collect()) == [
        (f"doc/{i}", f"doc/{i}") for i in range(1000, 6000)]


def test_white_space_of_all_kinds_and_long_tokens(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(90)) + "🙂é" * 20
    held = [("a", f"one\u2003two\xa0{long}", None, ["x\ty"], 1), ("b", "onetwo", f"z{long}z\ufeff", [None], 2)]
    entries = spark.createDataFrame(held, DDL)
    asked = [("1", "one two"), ("2", long), ("3", long[10:115]), ("4", "x y"), ("5", long[70:94]), ("6", "onet"), ("7", "e two")]
    got = rows(browse.search_table(entries, spark.createDataFrame(asked, QUERIES)))
    want = [(i, *r) for i, q in asked for r in browse.search(entries, q).select("doi", "n").collect()]
    assert got == sorted(map(tuple, want), key=repr) and len(got) == 12


def test_queries_are_joined_and_never_gathered(spark, entries):
    plan = browse.search_table(entries, spark.createDataFrame(ASKED, QUERIES))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "collect_list" not in plan
