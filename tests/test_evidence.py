"""All landed responses in one aggregation: last attempts, and what the plan reads."""

import random

from pyspark.sql import functions as F

from quire.operators import links

STEP = "doi STRING, step STRING, attempt BIGINT, ok BOOLEAN, n_hits INT, url STRING"
REFS = "doi STRING, attempt BIGINT, candidates ARRAY<STRUCT<repo: STRING, ref: STRING>>"
TODO = ("doi STRING, journal STRING, title STRING, configured BOOLEAN, dv_enabled BOOLEAN, dv_subtree STRING, "
        "zen_enabled BOOLEAN, page_enabled BOOLEAN")


def made(spark, seed):
    draw = random.Random(seed)
    dois = [f"10.1/{i}" for i in range(30)]

    def searches(steps):
        return [(draw.choice(dois), draw.choice(steps), draw.randrange(4), draw.random() < .8, draw.randrange(3),
                 draw.choice([None, "u1", "u2"])) for _ in range(150)]

    dv, zen = searches(links.DATAVERSE_STEPS + ("other",)), searches(links.ZENODO_STEPS)
    pages = [(draw.choice(dois), draw.randrange(4), draw.choice([None, "p1", "p2"])) for _ in range(50)]
    refs = [(draw.choice(dois), draw.randrange(4), draw.choice([None, [], [("r", "a b")], [("r", "x"), ("s", "prices")]]))
            for _ in range(50)]
    frames = (spark.createDataFrame(dv, STEP), spark.createDataFrame(zen, STEP),
              spark.createDataFrame(pages, "doi STRING, attempt BIGINT, page_url STRING"),
              spark.createDataFrame(refs, REFS))
    return (dv, zen, pages, refs), frames


def least_null(x):
    return (x is not None, x if x is not None else "")


def test_evidence_is_the_last_attempt_of_each_step(spark):
    (dv, zen, pages, refs), frames = made(spark, 3)
    got = {r["doi"]: r for r in links.evidence(*frames).collect()}
    assert set(got) == {r[0] for r in dv + zen + pages + refs}
    for doi, r in got.items():
        for rows, steps, column in ((dv, links.DATAVERSE_STEPS, "dataverse"), (zen, links.ZENODO_STEPS, "zenodo")):
            for step in steps:
                mine = [x for x in rows if x[:2] == (doi, step)]
                last = max(mine, key=lambda x: (x[2], x[4], least_null(x[5])), default=None)
                told = r[column][step]
                if last is None:
                    assert told is None
                else:
                    assert (told["n"], told["url"]) == (last[4], last[5])
        mine = [x for x in pages if x[0] == doi]
        assert r["page_url"] == (max(mine, key=lambda x: (x[1], least_null(x[2])))[2] if mine else None)


def test_the_worklist_meets_the_evidence_in_one_join(spark):
    _, frames = made(spark, 4)
    todo = spark.createDataFrame(
        [(f"10.1/{i}", "J", "On prices", True, True, None, True, True) for i in range(30)], TODO)
    plan = links.propose_links(todo, *frames)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate ") == 1
    assert links.propose_links(todo, *frames).count() == 30
