from pyspark.sql import functions as F

from quire import vocab
from quire.functions import forms, names, periods, replies, text
from quire.operators import dims

X = F.col("x")


def test_json_slice(evaluate):
    cases = {
        '{"a": 1}': '{"a": 1}',
        '  {"a": 1}\n': '{"a": 1}',
        '```json\n{"a": 1}\n```': '{"a": 1}',
        '```\n{"a":\n1}': '{"a":\n1}',
        '```json\r\n{"a":\r\n1}\r\n```  ': '{"a":\n1}',
        'Sure! {"a": {"b": 2}} Bye': '{"a": {"b": 2}}',
        '```{"a": 1}```': "",
        "plain": "plain",
        "```\nplain\n```": "plain",
        "} {": "",
        " {}　": "{}",
    }
    assert evaluate(text.json_slice(X), list(cases)) == list(cases.values())


def test_plain_text(evaluate):
    cases = {
        "<jats:p>We study trade.</jats:p>": "We study trade.",
        "<t>Abstract</t> <p>We study trade.</p>": "We study trade.",
        "<p>a</p>\n <p>b</p>": "a b",
        "Abstracting away.": "Abstracting away.",
        "ABSTRACT: Grain": "Grain",
        "abstract": "abstract",
        "": "",
        None: "",
        "Grain prices, 1500-1800.": "Grain prices, 1500-1800.",
    }
    assert evaluate(text.plain_text(X), list(cases)) == list(cases.values())


def test_repository_doi(evaluate):
    cases = {
        "Data: https://doi.org/10.7910/DVN/ABC123.": "10.7910/DVN/ABC123",
        "see 10.3886/E113. Next": "10.3886/E113.Next",
        "10.3886/i99,;.": "10.3886/i99",
        "doi 10.5281/ZENODO.42 and 10.7910/dvn/x1": "10.5281/ZENODO.42",
        "10.7910/ DVN/ Z9": "10.7910/DVN/Z9",
        "10.1000/none": None,
        "": None,
    }
    assert evaluate(text.repository_doi(X), list(cases)) == list(cases.values())


def test_long_tokens(evaluate):
    out = evaluate(text.long_tokens(X), ["The Überfall of Städtebund-Kämpfer in 1848", None])
    assert out == [["Überfall", "Städtebund", "Kämpfer"], None]


def test_prompt(spark):
    df = spark.createDataFrame(
        [("T", "A"), ("T", None), (None, "A")], "title STRING, abstract STRING"
    )
    out = [r[0] for r in df.select(text.prompt(F.col("title"), F.col("abstract"))).collect()]
    assert out == [
        "Title: T\nAbstract: A", f"Title: T\nAbstract: {vocab.NO_ABSTRACT}", "Title: \nAbstract: A"
    ]


def test_json_list(evaluate):
    out = evaluate(text.json_list(X), ['["a","b"]', "[]", "", None, "nope"])
    assert out == [["a", "b"], [], [], [], []]


def test_archive_link(evaluate):
    out = evaluate(text.has_archive_link(X), [
        '<a href="x/y.zip">', "<A HREF='Y.ZIP'>", '<a href="y.zip?x=1">', 'href=y.zip', None,
    ])
    assert out == [True, True, False, False, None]


def test_excluded_title(evaluate):
    out = evaluate(text.excluded_title(X), ["Erratum to X", "RETRACTED: Y", "Fine", None])
    assert out == [True, True, False, None]


def test_parse_period(evaluate):
    cases = {
        "1800–1870": (1800, 1870), "1800-1870": (1800, 1870), " 1800 ": (1800, 1800),
        "-500 – -300": (-500, -300), "-500-300": (-500, 300), "c. 1800": (None, None),
        "": (None, None), "1800–": (None, None), "99999999999": (None, None),
    }
    out = evaluate(periods.parse_period(X), list(cases))
    assert [(r["start"], r["end"]) for r in out] == list(cases.values())


def test_whole_number(evaluate):
    out = evaluate(periods.whole_number(X), [" 1900 ", "+12", "-5", "1_000", "19a", "1.5", "", None])
    assert out == [1900, 12, -5, 1000, None, None, None, None]


def test_period_label(spark):
    rows = [(1800, 1900), (1850, 1850), (1800, None), (None, 1900), (None, None), (-500, 500)]
    df = spark.createDataFrame(rows, "s INT, e INT")
    out = [r[0] for r in df.select(periods.period_label(F.col("s"), F.col("e"))).collect()]
    assert out == ["1800–1900", "1850", "1800–?", "?–1900", None, "500 BCE–500"]


def test_overlaps(spark):
    rows = [
        (1810, 1840, True), (1780, 1820, True), (1600, 1699, False), (None, None, False),
        (1820, None, True), (None, 1849, True), (1849, 1900, True), (1850, 1900, False),
    ]
    df = spark.createDataFrame(rows, "s INT, e INT, want BOOLEAN")
    hit = periods.overlaps(F.col("s"), F.col("e"), 1800, 1849)
    assert all(r["want"] == r["got"] for r in df.select("want", hit.alias("got")).collect())
    early = periods.overlaps(F.col("s"), F.col("e"), None, 999)
    late = periods.overlaps(F.col("s"), F.col("e"), 1945, None)
    old_new = spark.createDataFrame([(-500, 500), (1990, 2020)], "s INT, e INT")
    assert [tuple(r) for r in old_new.select(early, late).collect()] == [
        (True, False), (False, True)
    ]


def test_heat(spark):
    df = spark.createDataFrame([(0, 5), (5, 5), (1, 4)], "n INT, peak INT")
    out = [r[0] for r in df.select(periods.heat(F.col("n"), F.col("peak"))).collect()]
    assert out[:2] == [0.0, 1.0] and abs(out[2] - 0.25 ** 0.55) < 1e-12


def test_region_names(evaluate):
    lists = F.split(X, "; ")
    out = evaluate(names.valid_regions(lists), [
        "Western Europe; North America; Mid-Atlantic; Southern America; Western Europe"
    ])
    assert out == [["Western Europe", "Northern America", "South America", "Western Europe"]]


def test_country_names(spark, geo):
    lookup = dims.country_lookup(
        geo, spark.createDataFrame([("Prussia", "Germany")], "name STRING, target STRING")
    )
    cases = {
        "France": "France", "Russia": "Russian Federation", "Iran": "Iran", "iran": "Iran",
        "Czech Republic": "Czechia", "fra": "France", "Westeros": "Westeros",
        "England": "United Kingdom", "Prussia": "Germany", "DRC": vocab.COUNTRY_ALIASES["DRC"],
    }
    df = spark.createDataFrame([(list(cases),)], "c ARRAY<STRING>").withColumn("l", lookup)
    out = df.select(names.country_names(F.col("c"), F.col("l"))).first()[0]
    assert out == list(cases.values())


def test_display_country(evaluate):
    out = evaluate(names.display_country(X), ["Korea, Republic of", "France"])
    assert out == ["South Korea", "France"]


def reply(spark, geo, raws):
    lookup = dims.country_lookup(geo)
    df = spark.createDataFrame(list(enumerate(raws)), "i INT, raw STRING").withColumn(
        "v", replies.parse_reply(F.col("raw"))
    ).withColumn("l", lookup)
    cols = replies.reply_fields(F.col("v"), F.col("l"), vocab.REGIONS)
    return df.select("i", F.col("v").isNotNull().alias("ok"), *cols).orderBy("i").collect()


def test_reply_fields(spark, geo):
    rows = reply(spark, geo, [
        '{"is_hpe": true, "period_start": 1800, "period_end": null, '
        '"regions": ["Western Europe", "Atlantis", 3], "countries": ["Russia", "", null, "X"]}',
        '{"is_hpe": false, "period_start": "1800", "period_end": 1800.0}',
        '{"is_hpe": "false", "period_start": true, "period_end": 1e3, "regions": "Western Europe"}',
        '{"is_hpe": [], "regions": null, "countries": {"a": 1}}',
        "{}", "[]", "null", "no json", '{"is_hpe": 0.0}', '{"is_hpe": {"a": 0}, "period_end": -44}',
    ])
    assert [r["ok"] for r in rows] == [True] * 5 + [False] * 3 + [True] * 2
    assert rows[0]["regions"] == ["Western Europe"]
    assert rows[0]["countries"] == ["Russian Federation", "X"]
    assert (rows[0]["period_start"], rows[0]["period_end"]) == (1800, None)
    assert (rows[1]["is_hpe"], rows[1]["period_start"], rows[1]["period_end"]) == (False, None, None)
    assert (rows[2]["is_hpe"], rows[2]["period_start"], rows[2]["period_end"]) == (True, 1, None)
    assert rows[2]["regions"] == [] and rows[3]["countries"] == [] and not rows[3]["is_hpe"]
    assert not rows[4]["is_hpe"] and not rows[8]["is_hpe"]
    assert rows[9]["is_hpe"] and rows[9]["period_end"] == -44


def test_sections(evaluate):
    body = (
        "### DOI\n\n10.1/x\n\n### Corrected abstract\n\nTwo\nlines\n\n### Notes\n_No response_\n"
        "### Empty\n\n### DOI\n 10.1/y \n###not a heading\n"
    )
    assert evaluate(forms.sections(X), [body, ""]) == [
        {"DOI": "10.1/y \n###not a heading", "Corrected abstract": "Two\nlines", "Notes": "",
         "Empty": ""},
        {},
    ]


def test_author_list(evaluate):
    out = evaluate(forms.author_list(X), ["Doe, Jane; Roe ; , Ann;; A, B, C", ""])
    got = [[(a["family"], a["given"]) for a in people] for people in out]
    assert got == [[("Doe", "Jane"), ("Roe", ""), ("", "Ann"), ("A", "B, C")], []]


def test_comma_list(evaluate):
    out = evaluate(forms.comma_list(X), [" Spain , ,France", "", "One"])
    assert out == [["Spain", "France"], [], ["One"]]
