import pytest
from pyspark.sql import functions as F

from quire import vocab
from quire.operators import browse, dims
from quire.plans import jobs

DDL = ("doi STRING, title STRING, authors STRING, abstract STRING, year INT, "
       "regions ARRAY<STRING>, countries ARRAY<STRING>, period_start INT, period_end INT")


def entry(doi, regions, countries, start=1800, end=1900, title=None, authors="", abstract=None, year=2000):
    return (doi, title or doi.upper(), authors, abstract, year, regions, countries, start, end)


@pytest.fixture(scope="module")
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), DDL)


@pytest.fixture(scope="module")
def entries(make):
    return make(
        entry("a", ["Western Europe"], ["Germany"], 1800, 1850),
        entry("b", ["Western Europe"], ["France"], 1700, 1799),
        entry("c", ["Eastern Europe"], ["Poland"], 1900, 1944),
        entry("d", ["South America"], ["Brazil"], 1500, 1600),
        entry("e", [vocab.GLOBAL], [], 1800, 1900),
        entry("f", ["Western Europe"], ["Germany"], None, None),
    )


def dois(df):
    return sorted(r["doi"] for r in df.collect())


def test_search(make, geo):
    e = browse.with_continents(make(
        entry("10.1/p", ["Eastern Europe"], ["Germany"], title="The Rise of Prussia",
              authors="HINTZE, O.", abstract="<t>Abstract</t><jats:p>Tariff schedules.</jats:p>"),
        entry("10.1/l", ["Northern America"], ["United States"], title="Suppressing Votes"),
    ), geo)
    hits = lambda q: dois(browse.search(e, q))
    for q in ("prussia", "PRUSS", "hintze", "eastern europe", "germany", "europe", "tariff",
              "prussia  germany", "10.1/p", "schedules."):
        assert hits(q) == ["10.1/p"], q
    for q in ("jats", "prussia france", "louisiana"):
        assert hits(q) == [], q
    assert len(hits("")) == len(hits("  ")) == len(hits("americas")) + 1 == 2
    many = browse.search_many(e, {"x": "prussia", "y": "", "z": "none"})
    assert sorted((r["query_id"], r["doi"]) for r in many.collect()) == [
        ("x", "10.1/p"), ("y", "10.1/l"), ("y", "10.1/p")]


def test_key_and_cell_filters(entries, geo):
    f = lambda k: dois(browse.key_filter(entries, geo, k))
    assert f(vocab.GLOBAL) == ["e"] and f("Europe") == ["a", "b", "c", "f"]
    assert f("Western Europe") == ["a", "b", "f"] and f("Germany") == ["a", "f"]
    assert f("Prussia") == []
    cell = dois(browse.cell_filter(entries, geo, "Western Europe", vocab.BUCKETS[5]))
    assert cell == ["a"]
    assert dois(browse.cell_filter(entries, geo, "Europe")) == ["a", "b", "c", "f"]


def test_country_named_like_a_region_is_not_a_country_row(make, geo):
    e = make(entry("m", ["Melanesia"], ["Micronesia", "Europe", "Fiji", "Fiji"]))
    keys = browse.keyed_entries(e, geo).first()["keys"]
    assert sorted(keys) == ["Fiji", "Melanesia", "Oceania"]


def counts(df):
    return {r["row_key"]: [r[f"b{i}"] for i in range(9)] for r in df.collect()}


def test_count_matrix(entries, geo, spark):
    got = counts(browse.count_matrix(entries, geo))
    assert got["Western Europe"] == [0, 0, 0, 0, 1, 1, 1, 0, 0]
    assert got["Europe"] == [0, 0, 0, 0, 1, 1, 1, 1, 0]
    assert got[vocab.GLOBAL] == [0, 0, 0, 0, 0, 1, 1, 1, 0]
    rows = spark.createDataFrame([("Caribbean",), ("Germany",)], "row_key STRING")
    fixed = browse.count_matrix(entries, geo, rows=rows)
    assert counts(fixed) == {"Caribbean": [0] * 9, "Germany": [0, 0, 0, 0, 0, 1, 1, 0, 0]}
    assert [r["row_key"] for r in browse.shown_rows(fixed).collect()] == ["Germany"]
    cells = browse.matrix_cells(fixed).where("n > 0").collect()
    assert {(r["row_key"], r["label"], r["n"], r["peak"], r["heat"]) for r in cells} == {
        ("Germany", "1800–1849", 1, 1, 1.0), ("Germany", "1850–1899", 1, 1, 1.0)}
    assert browse.matrix_cells(fixed.where("total < 0")).count() == 0


def test_brute_force_matrix(make, geo, spark):
    """Every cell equals a direct count over the rows."""
    import random
    rng = random.Random(7)
    listing = [r.asDict() for r in geo.collect() if r["subregion"]]
    subs = {r["subregion"]: r["continent"] for r in listing}
    names = [r["name"] for r in listing] + ["Prussia", "Europe"]
    rows = []
    for i in range(200):
        s = rng.choice([None, rng.randrange(-500, 2020)])
        t = None if rng.random() < 0.2 else (s or 1500) + rng.randrange(0, 400)
        rows.append(entry(f"{i}", rng.sample([*subs, vocab.GLOBAL, "Atlantis"], rng.randrange(4)),
                          rng.sample(names, rng.randrange(5)), s, t))
    got = counts(browse.count_matrix(make(*rows), geo))

    def member(r, key):
        if key == vocab.GLOBAL or key in subs:
            return key in r[5]
        if key in subs.values():
            return any(subs.get(x) == key for x in r[5])
        return key in r[6]

    def inside(r, lo, hi):
        first = r[7] if r[7] is not None else r[8]
        last = r[8] if r[8] is not None else r[7]
        return first is not None and (hi is None or first <= hi) and (lo is None or last >= lo)

    for key in {*subs, *subs.values(), vocab.GLOBAL, *names}:
        want = [sum(member(r, key) and inside(r, lo, hi) for r in rows) for _, lo, hi in vocab.BUCKETS]
        assert got.get(key, [0] * 9) == want, key


def test_matrix_of_many_buckets_and_odd_entries(make, geo):
    """Spans that miss every bucket, turned periods, gaps between buckets, null and repeated names."""
    buckets = [(str(y), y, y + 5) for y in range(1500, 1990, 10)]
    rows = [entry(f"{i}", ["Caribbean", "Caribbean", None, "Central America"], [None, "Cuba", "Cuba", ""], s, t)
            for i, (s, t) in enumerate([(1500, 1500), (1516, 1519), (1600, 1550), (1700, None), (1400, 2500),
                                        (2000, 2010), (1526, 1525)])]
    got = {r["row_key"]: r for r in browse.count_matrix(make(*rows), geo, buckets).collect()}
    assert sorted(got) == ["Americas", "Caribbean", "Central America", "Cuba"]
    spans = [(r[7], r[8] if r[8] is not None else r[7]) for r in rows]
    want = [sum(s <= hi and t >= lo for s, t in spans) for _, lo, hi in buckets]
    assert sum(want) > len(buckets) and all(
        [r[f"b{i}"] for i in range(len(buckets))] == want and r["total"] == sum(want) for r in got.values())
    missed = browse.count_matrix(make(entry("x", [], ["Cuba"], 2000, 2010)), geo, buckets).collect()
    assert [(r["row_key"], r["total"]) for r in missed] == [("Cuba", 0)]
    with pytest.raises(ValueError):
        browse.count_matrix(make(*rows), geo, buckets[::-1])


def test_matrix_looks_names_up_after_the_shuffle(entries, geo):
    """Entries are only counted by their own names; the geography meets the counts."""
    import re
    plan = browse.count_matrix(entries, geo)._jdf.queryExecution().optimizedPlan().toString()
    scan = max(i for i, line in enumerate(plan.splitlines()) if "Aggregate" in line)
    below = "\n".join(plan.splitlines()[scan + 1:])
    assert "subquery" not in below and len(re.findall("posexplode", below)) == 1


def test_view_carries_peak_and_heat(entries, geo):
    rows = jobs.heatmap(entries, geo).collect()
    cells = [[r[f"b{i}"] for i in range(9)] for r in rows]
    top = max(max(c) for c in cells)
    assert {r["peak"] for r in rows} == {top}
    assert all(r["heat"] == pytest.approx([(n / top) ** vocab.HEAT_EXPONENT if n else 0 for n in c])
               for r, c in zip(rows, cells))


ORDER = ["-year", "title", "doi"]


def listed(e, geo, sub):
    df = browse.subregion_countries(e, geo, ORDER).where(F.col("subregion") == sub)
    return [r["country"] for r in df.orderBy("first_seen").collect()]


def test_anchor_regions(make, geo):
    e = make(entry("m", ["Caribbean", "Eastern Europe"],
                   ["Cuba", "Bulgaria", "Poland", "Romania", "OldEmpire"]))
    assert listed(e, geo, "Caribbean") == ["Cuba"]
    assert listed(e, geo, "Eastern Europe") == ["Bulgaria", "Poland", "Romania", "OldEmpire"]
    tie = make(entry("t", ["Caribbean", "Eastern Europe"], ["Cuba", "Poland", "Old", None, ""]))
    assert listed(tie, geo, "Caribbean") == ["Cuba", "Old"]
    assert listed(tie, geo, "Eastern Europe") == ["Poland", "Old"]
    none = make(entry("n", ["Caribbean", "Eastern Europe"], ["Old", "France"]))
    assert listed(none, geo, "Caribbean") == ["Old"] and listed(none, geo, "Western Europe") == []
    report = browse.drilldown_report(e, geo, "Caribbean").first()
    assert [(c["region"], c["n"]) for c in report["region_counts"]] == [
        ("Caribbean", 1), ("Eastern Europe", 3)]
    assert report["anchors"] == ["Eastern Europe"] and report["shown"] == ["Cuba"]


def test_first_seen_follows_catalogue_order(make, geo):
    e = make(entry("1", ["Western Europe"], ["France"], year=None),
             entry("2", ["Western Europe"], ["Germany"], year=1990),
             entry("3", ["Western Europe"], ["Austria", "Belgium"], year=2010))
    assert listed(e, geo, "Western Europe") == ["Austria", "Belgium", "Germany", "France"]


WEST = ["Germany", "France", "Austria", "Belgium", "Switzerland", "Netherlands", "Luxembourg",
        "Monaco", "Liechtenstein"]


def test_row_budget(make, geo):
    rows = [entry("n1", ["Northern Europe"], ["Norway"]), entry("e1", ["Eastern Europe"], ["Poland"]),
            entry("e2", ["Eastern Europe"], ["Hungary"])]
    rows += [entry(f"w{i}", ["Western Europe"], [c]) for i, c in enumerate(WEST)]
    out = browse.subregion_rows(make(*rows), geo, ORDER).collect()
    assert {r["row_key"] for r in out} == {"Norway", "Poland", "Hungary", "Western Europe"}
    only = browse.subregion_rows(make(rows[0]), geo, ORDER).collect()
    assert [(r["row_key"], r["is_country"]) for r in only] == [("Norway", True)]
    polity = make(entry("h", ["Eastern Europe"], ["Prussia"]))
    assert [r["row_key"] for r in browse.subregion_rows(polity, geo, ORDER).collect()] == ["Prussia"]
    bare = make(entry("x", ["Eastern Europe"], []))
    assert [r["row_key"] for r in browse.subregion_rows(bare, geo, ORDER).collect()] == ["Eastern Europe"]
    assert browse.subregion_rows(make(), geo, ORDER).count() == 0


def greedy(groups, budget=10, fixed=0):
    """Plain restatement of the expansion rule, for comparison."""
    total, opened = len(groups) + fixed, set()
    for name, n in sorted((g for g in groups if g[1] > 0), key=lambda g: g[1]):
        if total + n - 1 <= budget:
            opened.add(name)
            total += n - 1
    return opened


def test_plans_equal_greedy(make, geo):
    import random
    rng = random.Random(3)
    listing = [r.asDict() for r in geo.collect() if r["subregion"]]
    for _ in range(3):
        rows = []
        for i, r in enumerate(listing):
            if rng.random() < 0.6:
                extra = [f"Old {r['subregion']} {k}" for k in range(rng.randrange(4))]
                rows.append(entry(f"{i}", [r["subregion"]], [r["name"], *extra]))
        rows.append(entry("g", [vocab.GLOBAL], []))
        e = make(*rows)
        plan = browse.subregion_plan(e, geo, ORDER).collect()
        sizes = {}
        for continent in {r["continent"] for r in plan}:
            subs = sorted((r["subregion"], r["countries"]) for r in plan if r["continent"] == continent)
            opened = greedy(subs)
            assert opened == {r["subregion"] for r in plan if r["expanded"] and r["continent"] == continent}
            sizes[continent] = sum(n if s in opened else 1 for s, n in subs)
        world = browse.continent_plan(e, geo, ORDER).collect()
        ordered = [(c, sizes[c]) for c in vocab.CONTINENT_ORDER if c in sizes]
        assert {r["continent"] for r in world} == {*sizes, vocab.GLOBAL}
        assert {r["continent"] for r in world if r["expanded"]} == greedy(ordered, fixed=1)


def test_home_subregion(make, geo, spark):
    e = make(entry("a", ["Eastern Europe", "Caribbean"], ["Old"]), entry("b", ["Melanesia"], ["New"]))
    asked = spark.createDataFrame([("France",), ("Old",), ("New",), ("Mars",)], "country STRING")
    got = {r["country"]: r["subregion"] for r in browse.home_subregions(asked, e, geo, ORDER).collect()}
    assert got == {"France": "Western Europe", "Old": "Caribbean", "New": "Melanesia", "Mars": None}


def test_geography(geo):
    subs = {r["subregion"]: r for r in dims.subregions(geo).collect()}
    assert subs["Southern Asia"]["countries"] == ["Iran", "India"] and None not in subs
    rows = dims.continents(geo).orderBy("ord").collect()
    assert [r["continent"] for r in rows] == [*vocab.CONTINENT_ORDER, vocab.GLOBAL]
    assert rows[3]["subregions"] == sorted(
        s for s, r in subs.items() if r["continent"] == "Europe")


def test_heatmap_levels(entries, geo):
    world = {r["row_key"]: r["total"] for r in jobs.heatmap(entries, geo).collect()}
    assert world == {"Brazil": 2, "Germany": 2, "France": 1, "Poland": 1, vocab.GLOBAL: 3}
    europe = jobs.heatmap(entries, geo, continent="Europe").collect()
    assert {r["row_key"] for r in europe} == {"Germany", "France", "Poland"}
    west = jobs.heatmap(entries, geo, subregion="Western Europe").orderBy("first_seen").collect()
    assert [r["row_key"] for r in west] == ["Germany", "France"]
    assert jobs.heatmap(entries, geo, query="brazil").first()["row_key"] == "Brazil"
