"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, served round after round. A document's
virtual finish time is the number of its source's words up to its end, divided by the source's
target. All turns are sorted by that time and cut where the total budget is spent.

The clock deals the work evenly: between two times, all sources together send words in
proportion to the span, so equal spans of the clock are range partitions of equal size. Sums
along a source and along the clock are made in two levels, so no source or sort is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most rounds of a source.
ROUNDS = 3
#: Ranges of the shuffled order in a source, and of the clock up to the cut.
LANES = 4096
WORDS = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Sources in code point order (null last) weigh 1, 2, 3 and so on again. The share per
    weight rises until the targets, each stopped at ``ROUNDS`` times its source's size, add up to
    all sizes: with sources in the order of cap over weight, the first ones are capped.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    weighed = sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    cap = F.col("source_size") * ROUNDS
    by_cap = Window.orderBy(cap / F.col("weight"), F.asc_nulls_last("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (F.col("all") - F.col("capped")) / (F.col("weights") - F.col("passed"))
    level = weighed.select(
        "source", "source_size", "weight", cap.alias("cap"),
        F.sum("source_size").over(everything).alias("all"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("capped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("passed"),
        F.row_number().over(by_cap).alias("place"),
    ).withColumn("share", share)
    # The first source that its share doesn't fill to the cap sets the share of the rest.
    fits = F.col("share") * F.col("weight") <= F.col("cap")
    final = F.min(F.when(fits, F.struct("place", "share"))).over(everything)["share"]
    return level.select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), final * F.col("weight")).alias("target"),
    )


def entries(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, n): documents with equal id, source and size are n copies of one."""
    return docs.select("source", "doc_id", words_in(F.col("text")).alias("size")).groupBy(
        "source", "doc_id", "size"
    ).agg(F.count("*").alias("n")).withColumn("words", F.col("n") * F.col("size"))


def _queued(queue: DataFrame) -> DataFrame:
    """Entries in their source's shuffled order, with ``passed``: its words up to their end."""
    draw = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit("000"))
    named = queue.withColumn("draw", draw).withColumn(
        "lane", F.conv(F.substring("draw", 1, 3), 16, 10).cast("int")
    )
    order = Window.partitionBy("source").orderBy("lane")
    lanes = named.groupBy("source", "lane").agg(F.sum("words").alias("w")).select(
        F.col("source").alias("s"), F.col("lane").alias("l"),
        (F.sum("w").over(order) - F.col("w")).alias("base"),
    )
    within = Window.partitionBy("source", "lane").orderBy("draw", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0
    )
    summed = named.withColumn("inner", F.sum("words").over(within))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("lane") == F.col("l"))
    return summed.join(lanes, same).select(
        *queue.columns, "draw", (F.col("base") + F.col("inner")).alias("passed")
    )


def turns(queue: DataFrame) -> DataFrame:
    """All turns of the queues in global order, from ``entries``.

    Adds source_size, target, round, finish (virtual time), span (range partition of the clock),
    running (words up to and with this turn) and taken (whether the budget reaches it).
    """
    goals = targets(queue.groupBy("source").agg(F.sum("words").alias("source_size")))
    goals = goals.withColumnRenamed("source", "goal")
    queued = _queued(queue).join(goals, F.col("source").eqNullSafe(F.col("goal"))).drop("goal")
    served = F.when(F.col("target") > 0, F.ceil(F.col("target") / F.col("source_size")))
    rounds = F.sequence(F.lit(0), F.greatest(F.least(served, F.lit(ROUNDS)), F.lit(1)).cast("int") - 1)
    each = queued.withColumn("round", F.explode(rounds))
    spent = F.col("round") * F.col("source_size") + F.col("passed")
    each = each.withColumn(
        "finish", F.when(F.col("target") > 0, spent / F.col("target")).otherwise(F.lit(0.0))
    )
    # Equal spans up to twice the budget's time, then LANES for each doubling: turns of sources with
    # small targets end far beyond the cut.
    beyond = 2 * LANES + F.floor(F.log2(F.greatest(F.col("finish") / 2, F.lit(1.0))) * LANES)
    span = F.when(F.col("finish") < 2, F.floor(F.col("finish") * LANES)).otherwise(beyond)
    each = each.withColumn("span", span)
    spans = each.groupBy("span").agg(F.sum("words").alias("w"))
    # At most 2 * LANES and LANES for each of a few dozen doublings, at any input size.
    clock = Window.orderBy("span")
    spans = spans.select(
        F.col("span").alias("at"),
        (F.sum("w").over(clock) - F.col("w")).alias("base"),
    )
    within = Window.partitionBy("span").orderBy(
        "finish", F.asc_nulls_last("source"), "round", "draw", "doc_id", "size"
    ).rowsBetween(Window.unboundedPreceding, 0)
    ordered = each.withColumn("inner", F.sum("words").over(within)).join(
        F.broadcast(spans), F.col("span") == F.col("at")
    )
    budget = queue.agg(F.sum("words")).scalar()
    running = F.col("base") + F.col("inner")
    return ordered.withColumn("running", running).withColumn(
        "taken", running <= budget
    ).drop("at", "base", "inner", "passed", "draw")


def drawn(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, n, source_size, target, copies): how often the mix takes each entry."""
    return turns(entries(docs)).groupBy(
        "source", "doc_id", "size", "n", "source_size", "target"
    ).agg(F.count_if("taken").alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    A null text has size 0; zero-size documents take 0 words; a null source is a source of its
    own. Rows that share id, source and size are taken equally often. An empty table gives no
    rows. Only doc_id, text and source are read, so other columns don't matter. The shuffle is
    by md5 of the id, so reruns agree.
    """
    each = drawn(docs).withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    return each.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def draw(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with the columns it came with."""
    found = drawn(docs).where("copies > 0 and size > 0").select(
        F.col("source").alias("s"), F.col("doc_id").alias("d"), F.col("size").alias("z"), "copies"
    )
    rows = docs.select(F.struct("*").alias("row"), words_in(F.col("text")).alias("size"))
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z"))
        & F.col("row.source").eqNullSafe(F.col("s"))
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return rows.join(found, same).select("row", copies.alias("copy")).select("row.*")
