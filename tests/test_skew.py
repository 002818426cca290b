"""One key holding a third of the rows: results stay whole, tasks stay balanced."""

import pytest
from pyspark.sql import functions as F

from quire.operators import keyed, overrides, publish

ROWS = 60_000


@pytest.fixture(scope="module")
def rows(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, ROWS, 1, 8).select(hot.alias("doi"), F.col("id").alias("pos"))


def shuffled_rows(spark, df):
    """Rows every shuffle of a finished plan carried."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_latest_combines_before_the_shuffle(spark, rows):
    out = keyed.latest(rows.withColumn("text", F.lit("x")), ["doi"], [F.col("pos")])
    got = {r["doi"]: r["pos"] for r in out.collect()}
    assert got["hot"] == ROWS - 3 and len(got) == 5001
    # at most one row per key and map task
    assert max(shuffled_rows(spark, out)) <= 8 * 5001


def test_fold_combines_before_the_shuffle(spark, rows):
    raw = F.concat(F.lit('{"doi": "'), "doi", F.lit('", "year": '), "pos", F.lit("}"))
    log = rows.select(
        F.lit("corrections").alias("list"), "pos", F.lit(None).cast("string").alias("issue"),
        "doi", raw.alias("raw"),
    )
    entries = overrides.read_entries(log)
    fold = overrides.fold_corrections(overrides.usable(entries, "corrections"))
    got = {r["doi"]: r["year"]["value"] for r in fold.select("doi", "year").collect()}
    assert got["hot"] == ROWS - 3 and len(got) == 5001


def test_author_line_of_a_hot_key_is_built_in_blocks(spark, rows):
    people = rows.select(
        "doi", F.col("pos").cast("int").alias("sequence"), F.lit("A").alias("given"),
        F.concat(F.lit("F"), "pos").alias("family"),
    )
    lines = publish.author_lines(people)
    got = {r["doi"]: r["authors"] for r in lines.collect()}
    assert got["hot"] == "; ".join(f"F{i}, A." for i in range(0, ROWS, 3))
    blocks = people.groupBy("doi", F.floor(F.col("sequence") / 1024)).count()
    assert blocks.agg(F.max("count")).first()[0] <= 1024
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doi#" in plan and ", _block#" in plan


def test_children_of_a_hot_parent_are_replaced(spark, rows):
    new = spark.createDataFrame([("hot", 1)], "doi STRING, pos BIGINT")
    out = keyed.replace_children(rows, new, new.select("doi"), "doi")
    assert out.count() == ROWS - ROWS // 3 + 1
