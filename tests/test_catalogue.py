import datetime
import json

import pytest
from pyspark.sql import functions as F

from quire import schemas, vocab
from quire.operators import (
    abstracts, articles, classify, dims, keyed, links, normalize, overrides, publish, quality,
    worklists,
)
from quire.operators.articles import Catalogue
from quire.sources import pages, responses

NOW = datetime.datetime(2024, 5, 1)
LOG = schemas.LOG_ENTRY


def article(doi, journal="APSR", title="A Title", year=2000, abstract="Text."):
    return (doi, journal, title, year, 1, "1", "2", "3-4", abstract)


def classification(doi, flag=True, start=1800, end=1900, regions=("Western Europe",),
                   countries=("France",), url="http://data"):
    return (doi, flag, start, end, list(regions), list(countries), "b", "m", NOW, url)


def catalogue(spark, arts, people=(), classes=()):
    return Catalogue(
        spark.createDataFrame(list(arts), schemas.ARTICLE),
        spark.createDataFrame(list(people), schemas.AUTHOR),
        spark.createDataFrame(list(classes), schemas.CLASSIFICATION),
    )


@pytest.fixture(scope="module")
def cat(spark):
    return catalogue(
        spark,
        [article("10.1/a"), article("10.1/b", title="B"), article("10.1/c", abstract=None)],
        [("10.1/a", 0, "Ann", "Lee"), ("10.1/a", 1, None, "Roe"), ("10.1/b", 0, "Bo", "Kim")],
        [classification("10.1/a"), classification("10.1/b", url=None)],
    )


def by_doi(df):
    return {r["doi"]: r for r in df.collect()}


def people(df):
    return sorted((r["doi"], r["sequence"], r["given"], r["family"]) for r in df.collect())


# -- ingest --------------------------------------------------------------------------------


def item(doi="10.1/New", title="A Title", authors=({"given": "Ann", "family": "Lee"},), **rest):
    return {"DOI": doi, "title": [title] if title is not None else [],
            "author": list(authors), **rest}


def flatten(spark, *items):
    lines = [(json.dumps({"message": {"items": [i]}}), "APSR", n) for n, i in enumerate(items)]
    df = spark.createDataFrame(lines, "value STRING, journal STRING, landed INT")
    return articles.article_rows(pages.page_items(pages.parse_pages(df)))


def test_flatten_full_item(spark):
    row = flatten(spark, item(
        abstract="", volume="5", issue="2", page="1-9",
        published={"date-parts": [[2001, 7, 3]]},
        author=[{"given": "Ann", "family": "Lee"}, {"family": "Roe"}],
    )).first()
    assert row["doi"] == "10.1/new" and row["abstract"] is None
    assert (row["year"], row["month"], row["pages"]) == (2001, 7, "1-9")
    assert [tuple(a) for a in row["authors"]] == [(0, "Ann", "Lee"), (1, None, "Roe")]


@pytest.mark.parametrize("published,want", [
    (None, (None, None)), ({"date-parts": [[]]}, (None, None)), ({"date-parts": []}, (None, None)),
    ({"date-parts": [[1999]]}, (1999, None)), ({}, (None, None)),
])
def test_flatten_dates(spark, published, want):
    row = flatten(spark, item(published=published)).first()
    assert (row["year"], row["month"]) == want


def test_flatten_accepts(spark):
    rows = flatten(
        spark, item(doi="10.1/1", title=None), item(doi="10.1/2", title="<i>Book</i>"),
        item(doi=""), item(doi="10.1/4", authors=()), {"title": ["No DOI"], "author": [{}]},
        item(doi="10.1/6", title="On <i>x</i>"), {"DOI": "10.1/7", "author": [{"family": "A"}]},
    )
    assert sorted(by_doi(rows)) == ["10.1/1", "10.1/6", "10.1/7"]


def test_scope(spark):
    df = spark.createDataFrame([(json.dumps({"message": {"items": [
        item(doi=str(y), published={"date-parts": [[y]]}, type=t)
        for y, t in ((1999, None), (2000, None), (2001, "journal-article"), (2002, "book"), (2003, None))
    ]}}), "JOP")], "value STRING, journal STRING")
    items = pages.page_items(pages.parse_pages(df)).where(
        articles.in_scope(F.col("item"), 2000, 2002)
    )
    assert sorted(r["item"]["DOI"] for r in items.collect()) == ["2000", "2001"]


def test_put_articles_last_wins_whole_row(spark, cat):
    new = flatten(
        spark, item(doi="10.1/A", title="Old", abstract="x"),
        item(doi="10.1/a", title="New", authors=({"family": "Zed"},)),
        item(doi="10.1/d"),
    )
    out = articles.put_articles(cat, new, [F.col("landed")])
    rows = by_doi(out.articles)
    assert sorted(rows) == ["10.1/a", "10.1/b", "10.1/c", "10.1/d"]
    assert rows["10.1/a"]["title"] == "New" and rows["10.1/a"]["abstract"] is None
    assert people(out.authors) == [
        ("10.1/a", 0, None, "Zed"), ("10.1/b", 0, "Bo", "Kim"), ("10.1/d", 0, "Ann", "Lee"),
    ]
    assert sorted(by_doi(out.classifications)) == ["10.1/a", "10.1/b"]
    again = articles.put_articles(out, new, [F.col("landed")])
    assert by_doi(again.articles) == rows and people(again.authors) == people(out.authors)
    gone = articles.put_articles(cat, new, [F.col("landed")], cascade=True)
    assert sorted(by_doi(gone.classifications)) == ["10.1/b"]


def test_put_classifications_resets_link(spark, cat):
    new = spark.createDataFrame(
        [classification("10.1/a", flag=False), classification("10.1/c")], schemas.CLASSIFICATION
    )
    rows = by_doi(articles.put_classifications(cat, new).classifications)
    assert sorted(rows) == ["10.1/a", "10.1/b", "10.1/c"]
    assert rows["10.1/a"]["replication_url"] is None and not rows["10.1/a"]["is_hpe"]


def test_empty_and_old_schema(spark):
    cat = articles.empty(spark)
    assert [df.count() for df in cat] == [0, 0, 0]
    old = spark.createDataFrame(
        [("10.1/a", True, 1, 2, ["X"], "b", "m", NOW)],
        "doi STRING, is_hpe BOOLEAN, period_start INT, period_end INT, regions ARRAY<STRING>, "
        "backend STRING, model STRING, classified_at TIMESTAMP",
    )
    row = articles.current_classifications(old).first()
    assert row["countries"] == [] and row["replication_url"] is None


def test_orphans_and_cascade(spark, cat):
    extra = cat.authors.union(spark.createDataFrame([("10.9/x", 0, "O", "Rphan")], schemas.AUTHOR))
    assert people(keyed.orphans(extra, cat.articles, "doi")) == [("10.9/x", 0, "O", "Rphan")]
    assert people(keyed.cascade_delete(extra, cat.articles, "doi")) == people(cat.authors)


def test_clearing_authors(spark, cat):
    none = spark.createDataFrame([], schemas.AUTHOR)
    touched = spark.createDataFrame([("10.1/a",)], "doi STRING")
    out = keyed.replace_children(cat.authors, none, touched, "doi")
    assert people(out) == [("10.1/b", 0, "Bo", "Kim")]


# -- worklists -----------------------------------------------------------------------------


def test_worklists(spark, cat):
    assert sorted(by_doi(worklists.unclassified(cat))) == ["10.1/c"]
    assert sorted(by_doi(worklists.to_classify(cat))) == ["10.1/c"]
    assert len(by_doi(worklists.to_classify(cat, fresh=True))) == 3
    assert sorted(by_doi(worklists.missing_abstracts(cat.articles))) == ["10.1/c"]
    assert sorted(by_doi(worklists.missing_links(cat))) == ["10.1/b"]
    assert sorted(by_doi(worklists.missing_links(cat, fresh=True))) == ["10.1/a", "10.1/b"]


def test_chunks_are_full(spark):
    df = spark.range(1201).select(F.concat(F.lit("10.1/"), "id").alias("doi"))
    sizes = {r["chunk"]: r["count"] for r in
             keyed.chunked(df, "doi", 500, buckets=16).groupBy("chunk").count().collect()}
    assert sizes == {0: 500, 1: 500, 2: 201}
    numbers = keyed.numbered(df, "doi", buckets=16).agg(
        F.min("row_no"), F.max("row_no"), F.count_distinct("row_no")).first()
    assert tuple(numbers) == (1, 1201, 1201)


# -- abstracts -----------------------------------------------------------------------------


def test_fill_abstracts(spark, cat):
    landed = spark.createDataFrame([
        (["10.1/c", "10.1/a"], [{"abstract": "Found."}, {"abstract": "Other."}], 1),
        (["10.1/x", "10.1/y", "10.1/z"], [None, {"abstract": ""}, {"abstract": None}], 1),
    ], f"{schemas.ABSTRACT_RESPONSE}, attempt BIGINT")
    found = abstracts.abstract_rows(landed)
    assert sorted(by_doi(found)) == ["10.1/a", "10.1/c"]
    rows = by_doi(abstracts.fill_abstracts(cat.articles, found))
    assert rows["10.1/c"]["abstract"] == "Found." and rows["10.1/a"]["abstract"] == "Text."
    assert tuple(abstracts.abstract_stats(cat.articles, found).first()) == (1, 1)


# -- links ---------------------------------------------------------------------------------

HITS = "doi STRING, step STRING, attempt BIGINT, ok BOOLEAN, n_hits INT, url STRING"


def resolve(spark, journal, dataverse=(), zenodo=(), page=None, refs=None, title="Grain Prices"):
    cat = catalogue(
        spark, [article("d", journal=journal, title=title)], (), [classification("d", url=None)]
    )
    hits = lambda rows: spark.createDataFrame(
        [("d", s, 0, ok, n, u) for s, ok, n, u in rows], HITS
    )
    site = spark.createDataFrame(
        [("d", 0, page)] if page else [], "doi STRING, attempt BIGINT, page_url STRING"
    )
    reference = spark.createDataFrame(
        [("d", 200, 0, {"message": {"reference": [{"unstructured": r} for r in refs or []]}})],
        schemas.REFERENCE_RESPONSE,
    )
    todo = worklists.missing_links(cat)
    out = links.propose_links(
        todo, hits(dataverse), hits(zenodo), site, responses.references(reference)
    )
    return out.select("replication_url").first()


@pytest.mark.parametrize("journal,steps,want", [
    ("APSR", [("field", True, 1, "u1")], "u1"),
    ("APSR", [("field", True, 2, "u1"), ("title", True, 1, "u3")], None),
    ("APSR", [("field", True, 1, None), ("title", True, 1, "u3")], None),
    ("APSR", [("field", False, 0, None), ("title", True, 1, "u3")], None),
    ("APSR", [("field", True, 0, None), ("full_text", True, 1, "u2")], "u2"),
    ("APSR", [("field", True, 0, None), ("full_text", True, 3, "u2"), ("title", True, 1, "u3")], None),
    ("APSR", [("field", True, 0, None), ("full_text", False, 0, None), ("title", True, 1, "u3")], "u3"),
    ("APSR", [("field", True, 0, None), ("full_text", True, 0, None), ("title", True, 2, "u3")], None),
    ("JOP", [("field", True, 0, None), ("full_text", True, 1, "u2"), ("title", True, 1, "u3")], "u3"),
    ("JOP", [("field", True, 0, None), ("title", False, 1, "u3")], None),
    ("AER", [("field", True, 1, "u1")], None),
])
def test_dataverse_steps(spark, journal, steps, want):
    assert resolve(spark, journal, dataverse=steps)[0] == want


def test_dataverse_needs_title_for_title_search(spark):
    steps = [("field", True, 0, None), ("title", True, 1, "u3")]
    assert resolve(spark, "JOP", dataverse=steps, title="")[0] is None


@pytest.mark.parametrize("steps,want", [
    ([("field", True, 1, "z1")], "z1"),
    ([("field", True, 0, None), ("full_text", True, 1, "z2")], "z2"),
    ([("field", True, 2, "z1"), ("full_text", True, 1, "z2")], None),
    ([("field", False, 0, None), ("full_text", True, 1, "z2")], None),
    ([("field", True, 0, None), ("full_text", True, 2, "z2")], None),
])
def test_zenodo_steps(spark, steps, want):
    assert resolve(spark, "Econometrica", zenodo=steps)[0] == want


def test_cascade_order(spark):
    refs = ["data 10.7910/DVN/REF"]
    assert resolve(spark, "Econometrica", [("field", True, 1, "no")], [], "page", refs)[0] == "page"
    assert resolve(spark, "AJPS", page="page", refs=refs)[0] == "https://doi.org/10.7910/DVN/REF"
    assert resolve(spark, "Elsewhere", refs=refs) is None


def test_reference_choice(spark):
    one, two = "Grains, data, 10.7910/DVN/ONE.", "PRICES of corn 10.5281/zenodo.22;"
    assert resolve(spark, "EHR", refs=["none", two])[0] == "https://doi.org/10.5281/zenodo.22"
    assert resolve(spark, "EHR", refs=[one, two])[0] == "https://doi.org/10.5281/zenodo.22"
    assert resolve(spark, "EHR", refs=[one, two], title="Corn")[0] is None
    assert resolve(spark, "EHR", refs=[one, one], title=None)[0] is None
    assert resolve(spark, "EHR", refs=[])[0] is None


def test_link_dims_and_stats(spark, cat):
    dim = {r["journal"]: r for r in dims.link_sources(spark).collect()}
    assert len(dim) == 15 and set(dim) == set(vocab.JOURNALS)
    assert dim["JPE"]["dv_enabled"] and dim["JPE"]["dv_subtree"] is None
    assert not dim["EHR"]["dv_enabled"] and dim["Econometrica"]["page_enabled"]
    todo = worklists.missing_links(cat, fresh=True)
    proposals = spark.createDataFrame(
        [("10.1/a", "new"), ("10.1/b", None)], "doi STRING, replication_url STRING")
    assert tuple(links.link_stats(todo, proposals).first()) == (1, 2)
    rows = by_doi(links.apply_links(cat, proposals).classifications)
    assert rows["10.1/a"]["replication_url"] == "new" and rows["10.1/b"]["replication_url"] is None


def test_response_shapes(spark):
    dv = spark.createDataFrame([
        ("a", "field", 200, None, {"data": {"items": [{"url": "u", "name": "n"}]}}),
        ("b", "field", 500, 1, None), ("c", "title", 200, 1, {"data": {"items": []}}),
    ], schemas.DATAVERSE_RESPONSE)
    rows = {r["doi"]: tuple(r)[2:] for r in responses.dataverse_hits(dv).collect()}
    assert rows == {"a": (0, True, 1, "u"), "b": (1, False, 0, None), "c": (1, True, 0, None)}
    zen = spark.createDataFrame([
        ("a", "field", 200, 0, {"hits": {"hits": [{"links": {"html": "h"}, "metadata": None}] * 2}}),
    ], schemas.ZENODO_RESPONSE)
    assert tuple(responses.zenodo_hits(zen).first())[3:] == (True, 2, "h")
    site = f"https://www.{vocab.PAGE_SITE}/x"
    html = '<a href="d.zip">'
    pub = spark.createDataFrame([
        ("a", 200, 0, site, html), ("b", 404, 0, site, html), ("c", 200, 0, "http://other", html),
        ("d", 200, 0, site, "<p>"),
    ], schemas.PUBLISHER_PAGE)
    found = {r["doi"]: r["page_url"] for r in responses.publisher_pages(pub).collect()}
    assert found == {"a": site, "b": None, "c": None, "d": None}


# -- classification ------------------------------------------------------------------------


def test_requests(spark, cat):
    todo = worklists.to_classify(cat)
    line = json.loads(classify.message_requests(todo, "m", "sys").first()[0])
    assert line["params"]["messages"][0]["content"].endswith(vocab.NO_ABSTRACT)
    assert line["params"]["max_tokens"] == 512 and len(line["custom_id"]) == 64
    chat = json.loads(classify.chat_requests(todo, "m", "sys").first()[0])
    assert [m["role"] for m in chat["body"]["messages"]] == ["system", "user"]
    assert chat["method"] == "POST" and chat["body"]["response_format"] == {"type": "json_object"}
    assert classify.request_map(todo).first()["custom_id"] == line["custom_id"]


def test_message_replies(spark):
    def line(i, kind, content):
        return (json.dumps({"custom_id": i, "result": {"type": kind, "message": {"content": content}}}),)

    rows = responses.message_replies(spark.createDataFrame([
        line("1", "succeeded", [{"type": "text", "text": "hi"}, {"type": "text", "text": "x"}]),
        line("2", "succeeded", []), line("3", "succeeded", [{"type": "tool_use"}]),
        line("4", "errored", []), ("",),
    ], "value STRING")).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "hi", None), ("2", "{}", None), ("3", "{}", None), ("4", None, "errored"),
    ]


def test_chat_replies(spark):
    def line(i, **rest):
        return (json.dumps({"custom_id": i, **rest}),)

    def body(content):
        return {"response": {"body": {"choices": [{"message": {"content": content}}]}}}

    rows = responses.chat_replies(spark.createDataFrame([
        line("1", **body("hi"), error=None), line("2", **body(None)), line("3", **body("")),
        line("4", **body("x"), error={"code": 1}), line("5", response={"body": {"choices": []}}),
        line("6", **body({"a": 1})), ("  ",), ("not json",),
    ], "value STRING")).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "hi", None), ("2", "{}", None), ("3", "{}", None), ("4", None, "error"),
        ("5", None, "malformed response"), ("6", None, "malformed response"),
        (None, None, "unreadable line"),
    ]


def test_classified_and_rejected(spark, geo, cat):
    ids = classify.request_map(cat.articles)
    replies = ids.select("custom_id", F.when(F.col("doi") == "10.1/a", "oops").otherwise(
        '{"is_hpe": true, "countries": ["Iran"]}').alias("raw"))
    known = classify.resolve_dois(replies, ids)
    out = by_doi(classify.classified(known, dims.country_lookup(geo), "b", "m", F.lit(NOW)))
    assert sorted(out) == ["10.1/b", "10.1/c"]
    assert out["10.1/b"]["countries"] == ["Iran"] and out["10.1/b"]["classified_at"] == NOW
    assert [r["reason"] for r in classify.rejected(known).collect()] == ["not a JSON object"]


def test_score_with(spark, geo, cat):
    def score(batches):
        for pdf in batches:
            yield pdf.assign(raw='{"is_hpe": false}')[["doi", "raw"]]

    out = classify.classified(
        classify.score_with(cat.articles, score), dims.country_lookup(geo), "own", "v1"
    )
    assert {r["is_hpe"] for r in out.collect()} == {False}


# -- clean-up ------------------------------------------------------------------------------


def test_cleanup(spark, geo):
    df = spark.createDataFrame([
        classification("a", countries=["Russia", "France"]),
        classification("b", countries=["France", "Poland"], regions=["Caribbean"]),
        classification("c", countries=["Prussia"], regions=["Caribbean"]),
        classification("d", countries=[], regions=[vocab.GLOBAL]),
        classification("e", countries=["Poland", "France"], regions=["Western Europe", "Eastern Europe"]),
        classification("f", countries=["x"] * 26),
        classification("g", countries=["x"] * 25),
    ], schemas.CLASSIFICATION)
    names = by_doi(normalize.normalized_countries(df, dims.country_lookup(geo)))
    assert names["a"]["countries"] == ["Russian Federation", "France"]
    assert [d for d, r in names.items() if r["changed"]] == ["a"]
    regions = by_doi(normalize.regions_from_countries(df, dims.geography_maps(geo)))
    assert regions["b"]["regions"] == ["Eastern Europe", "Western Europe"]
    assert regions["c"]["regions"] == ["Caribbean"]
    assert regions["e"]["regions"] == ["Western Europe", "Eastern Europe"]
    assert [d for d, r in regions.items() if r["changed"]] == ["b"]
    many = normalize.collapsed_many_countries(df)
    assert by_doi(many)["f"]["regions"] == [vocab.GLOBAL] and by_doi(many)["f"]["countries"] == []
    assert tuple(normalize.changes(many).first()) == (1, 7)


# -- overrides -----------------------------------------------------------------------------


def log_of(spark, corrections=(), additions=()):
    rows = [("corrections", i, None, c.get("doi"), json.dumps(c)) for i, c in enumerate(corrections)]
    rows += [("additions", i, None, a.get("doi"), json.dumps(a)) for i, a in enumerate(additions)]
    return spark.createDataFrame(rows, LOG)


def test_corrections(spark, cat):
    log = log_of(spark, [
        {"doi": "10.1/a", "regions": ["Caribbean"], "title": "First"},
        {"doi": "10.1/a", "title": "Second", "period_start": None, "note": "n"},
        {"doi": "10.1/b", "is_hpe": 0, "year": "1950", "authors": [{"family": "New"}, {"given": "G"}]},
        {"doi": "10.1/zz", "title": "Unknown"},
        {"doi": "10.1/c", "title": "Not classified"},
        {"title": "No DOI"},
        {"doi": "10.1/a", "authors": []},
        {"doi": "10.1/b", "regions": "Caribbean"},
        {"doi": "10.1/b", "countries": None},
    ])
    out = overrides.apply_overrides(cat, log)
    arts, classes = by_doi(out.articles), by_doi(out.classifications)
    assert arts["10.1/a"]["title"] == "Second" and arts["10.1/a"]["abstract"] == "Text."
    assert arts["10.1/b"]["year"] == 1950 and arts["10.1/c"]["title"] == "A Title"
    assert classes["10.1/a"]["regions"] == ["Caribbean"] and classes["10.1/a"]["period_end"] == 1900
    assert classes["10.1/a"]["period_start"] is None and classes["10.1/a"]["countries"] == ["France"]
    assert not classes["10.1/b"]["is_hpe"] and classes["10.1/b"]["regions"] == ["Western Europe"]
    assert people(out.authors) == [
        ("10.1/a", 0, "Ann", "Lee"), ("10.1/a", 1, None, "Roe"),
        ("10.1/b", 0, None, "New"), ("10.1/b", 1, "G", None),
    ]
    stats = overrides.override_stats(cat, log).first().asDict()
    assert stats == {"corrections": 3, "additions": 0, "unknown_dois": 2, "rejected": 3}
    again = overrides.apply_overrides(out, log)
    assert by_doi(again.articles) == arts and by_doi(again.classifications) == classes


def test_additions(spark, cat):
    log = log_of(spark, [{"doi": "10.1/n", "title": "Too early"}], [
        {"doi": "10.1/n", "title": "N", "replication_url": "http://n"},
        {"doi": "10.1/a", "title": "Again", "replication_url": "http://x", "journal": "JOP",
         "is_hpe": False, "year": 1990, "regions": ["Caribbean"], "period_end": 7,
         "authors": [{"family": "Only", "given": "One"}]},
        {"doi": "10.1/b", "title": "B2", "replication_url": None, "authors": "nobody"},
        {"doi": "10.1/q", "title": "No link"},
        {"title": "No DOI", "replication_url": "u"},
        {"doi": "10.1/r", "title": "R", "replication_url": "u", "regions": None},
    ])
    out = overrides.apply_overrides(cat, log, stamp=F.lit(NOW))
    arts, classes = by_doi(out.articles), by_doi(out.classifications)
    assert sorted(arts) == ["10.1/a", "10.1/b", "10.1/c", "10.1/n"]
    assert arts["10.1/n"]["journal"] == "Unpublished" and arts["10.1/n"]["title"] == "N"
    assert arts["10.1/a"]["volume"] is None and arts["10.1/a"]["abstract"] is None
    new = classes["10.1/n"]
    assert new["is_hpe"] and new["regions"] == [] and new["countries"] == []
    assert (new["backend"], new["model"], new["replication_url"]) == ("manual", "override", "http://n")
    assert not classes["10.1/a"]["is_hpe"] and classes["10.1/a"]["period_end"] == 7
    assert classes["10.1/b"]["replication_url"] is None
    assert people(out.authors) == [("10.1/a", 0, "One", "Only"), ("10.1/b", 0, "Bo", "Kim")]
    gone = overrides.apply_overrides(cat, log, cascade=True)
    assert people(gone.authors) == [("10.1/a", 0, "One", "Only")]
    stats = overrides.override_stats(cat, log).first().asDict()
    assert stats == {"corrections": 0, "additions": 3, "unknown_dois": 1, "rejected": 3}


# -- publishing ----------------------------------------------------------------------------


def test_published(spark):
    cat = catalogue(
        spark,
        [article("a", year=1999, title="Beta"), article("b", year=2005), article("c", year=None),
         article("d", title="Corrigendum to x"), article("e", title=None), article("f"),
         article("g"), article("h", year=1999, title="Alpha")],
        [("a", 2, "", "Third"), ("a", 0, "Ann", "Lee"), ("a", 1, None, "Roe"), ("a", 3, "X", ""),
         ("a", 4, "Y", None), ("a", 5000, "Éva", "Far")],
        [classification(d) for d in "abcdeh"]
        + [classification("f", flag=False), classification("g", url=None)],
    )
    rows = publish.in_catalogue_order(publish.published(cat)).collect()
    assert [r["doi"] for r in rows] == ["b", "h", "a", "c"]
    assert rows[0].asDict().keys() == dict.fromkeys(schemas.ENTRY_FIELDS).keys()
    assert rows[2]["authors"] == "Lee, A.; Roe; Third; Far, É." and rows[0]["authors"] == ""


def test_ordered_text_blocks(spark):
    rows = spark.range(10_000).select(
        F.lit("hot").alias("k"), F.col("id").cast("int").alias("n"), F.col("id").cast("string").alias("t")
    ).orderBy(F.rand(1))
    out = publish.ordered_text(rows, "k", "n", "t", ",", block=64).first()["t"]
    assert out == ",".join(map(str, range(10_000)))


def test_scorecard_and_coverage(spark, cat):
    cases = dims.golden_cases(spark)
    got = spark.createDataFrame(
        [(d, e if i else not e) for i, (d, _, e) in enumerate(vocab.GOLDEN_CASES[:5])],
        "doi STRING, is_hpe BOOLEAN",
    )
    card = quality.scorecard(quality.golden_results(cases, got)).first()
    assert tuple(card) == (4, 1, 6, 11)
    assert [tuple(r) for r in quality.coverage(cat.articles, cat.authors).collect()] == [
        ("APSR", 3, 2, 3)
    ]


def test_last_classification_of_a_batch_wins(spark, cat):
    later = datetime.datetime(2024, 6, 1)
    first = classification("10.1/c", start=1)
    second = (*classification("10.1/c", start=2)[:8], later, None)
    new = spark.createDataFrame([second, first], schemas.CLASSIFICATION)
    rows = articles.put_classifications(cat, new).classifications.where("doi = '10.1/c'").collect()
    assert [r["period_start"] for r in rows] == [2]


def test_fixed_dims(spark):
    journals = {r["journal"]: r["issn"] for r in dims.journals(spark).collect()}
    assert journals == vocab.JOURNALS
    buckets = dims.period_buckets(spark).orderBy("bucket").collect()
    assert [(r["label"], r["lo"], r["hi"]) for r in buckets] == vocab.BUCKETS
    assert dims.golden_cases(spark).where("expected").count() == 6


def test_scope_ends_this_year(spark):
    this_year = datetime.date.today().year
    rows = flatten(spark, *[
        item(doi=f"10.1/{y}", published={"date-parts": [[y]]})
        for y in (2009, 2010, this_year, this_year + 1)
    ])
    line = json.dumps({"message": {"items": [
        item(doi=f"10.1/{y}", published={"date-parts": [[y]]})
        for y in (2009, 2010, this_year, this_year + 1)
    ]}})
    df = spark.createDataFrame([(line, "JOP")], "value STRING, journal STRING")
    items = pages.page_items(pages.parse_pages(df)).where(articles.in_scope(F.col("item")))
    assert [r["item"]["DOI"] for r in items.collect()] == ["10.1/2010", f"10.1/{this_year}"]
    assert rows.count() == 4


def test_dimensions_have_no_bound(spark):
    rows = spark.range(300).select(
        F.col("id").alias("pos"), F.concat(F.lit("c"), "id").alias("name"),
        F.concat(F.lit("a"), "id").alias("alpha3"), F.lit("Europe").alias("continent"),
        F.lit("Western Europe").alias("subregion"),
    )
    aliases = spark.range(10_000).select(
        F.concat(F.lit("n"), "id").alias("name"), F.concat(F.lit("c"), F.col("id") % 300).alias("target")
    )
    df = spark.createDataFrame([(["n9999", "c299", "A7"],)], "countries ARRAY<STRING>")
    out = normalize.normalized_countries(df, dims.country_lookup(rows, aliases)).first()
    assert out["countries"] == ["c99", "c299", "c7"]
    assert spark.range(1).select(F.size(dims.geography_maps(rows)["home"])).first()[0] == 300


def test_one_name_per_country(spark):
    names = ["Iran", "Vietnam", "South Korea", "DR Congo", "Russian Federation", "United Kingdom"]
    geo = spark.createDataFrame(
        [(i, n, n[:3].upper(), "Asia", "x") for i, n in enumerate(names)],
        "pos INT, name STRING, alpha3 STRING, continent STRING, subregion STRING",
    )
    said = ["Iran, Islamic Republic of", "Viet Nam", "Korea, Republic of", "DRC",
            "Congo, The Democratic Republic of the", "Russia", "Scotland", "North Korea", "Atlantis"]
    df = spark.createDataFrame([(said,)], "countries ARRAY<STRING>")
    out = normalize.normalized_countries(df, dims.country_lookup(geo)).first()["countries"]
    assert out == ["Iran", "Vietnam", "South Korea", "DR Congo", "DR Congo", "Russian Federation",
                   "United Kingdom", "Korea, Democratic People's Republic of", "Atlantis"]
    rows = spark.createDataFrame([(["Europe 9"], ["Iran", "Atlantis"])], "regions ARRAY<STRING>, countries ARRAY<STRING>")
    assert {(r["kind"], r["name"]) for r in dims.unrecognised(rows, geo).collect()} == {
        ("region", "Europe 9"), ("country", "Atlantis")}
