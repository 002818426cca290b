"""URL filters: fixed rules first, else a logistic regression on hashed character n-grams.

Everything is DataFrame work: features are arrays of bucket numbers, each training step is
one aggregation by bucket over a small labelled table, and scoring is one array expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.shared import stored

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BUCKETS = 4096
GRAMS = (3, 4, 5)
#: At most so many distinct labelled (host, path) rows are fitted; the least hashes are taken.
MAX_LABELLED = 20_000
ROUNDS = 12

# Rules are (verdict, host, path prefix).
Rules = Sequence[tuple[str, str, str]]


def with_address(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; a null url or one without ``://`` has both empty."""
    rest = F.when(
        F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")
    ).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), A_TO_Z, A_TO_Z.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": host, "path": path})


def rule_of(rules: Rules) -> Column:
    """The longest fitting rule as struct (size, rule, verdict), or null."""
    fits = [
        F.when(
            (F.concat(F.lit("."), F.col("host")).endswith("." + host))
            & F.col("path").startswith(path),
            F.struct(
                F.lit(len(host + path)).alias("size"), F.lit(host + path).alias("rule"),
                F.lit(verdict).alias("verdict"),
            ),
        )
        for verdict, host, path in rules
    ]
    none = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.array_compact(F.array(none, *fits)))


def grams_of(host: Column, path: Column) -> Column:
    """Bucket numbers of the distinct n-grams of host and of path, each marked as such."""
    def grams(text: Column, n: int, mark: int) -> Column:
        last = F.length(text) - (n - 1)
        return F.transform(
            F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
            lambda i: F.pmod(F.xxhash64(F.lit(mark), text.substr(i, F.lit(n))), F.lit(BUCKETS))
            .cast("int"),
        )

    both = ((F.concat(F.lit("^"), host, F.lit("$")), 1), (F.concat(path, F.lit("$")), 2))
    return F.array_distinct(F.concat(*[grams(t, n, m) for t, m in both for n in GRAMS]))


def margin(grams: Column, weights: list[float], bias: float) -> Column:
    """Bias plus the mean-scaled sum of the weights of the buckets."""
    table = F.split(F.lit(",".join(repr(w) for w in weights)), ",").cast("array<double>")
    total = F.aggregate(grams, F.lit(0.0), lambda s, g: s + F.get(table, g))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1)))


def fit(labelled: DataFrame, limit: int = MAX_LABELLED) -> tuple[list[float], float]:
    """Weights and bias from rows (host, path, label 0/1).

    Each round is a diagonal Newton step with a ridge, from one aggregation by bucket. The
    model has ``BUCKETS`` weights at any size, so it can pass through the driver. Without rows
    all weights are 0 and the bias is even.
    """
    rows = labelled.where("label is not null").groupBy("host", "path").agg(
        F.max("label").alias("label")
    ).orderBy(F.xxhash64("host", "path"), "host", "path").limit(limit)
    rows = stored(
        rows.select("label", grams_of(F.col("host"), F.col("path")).alias("grams")), "urls"
    )
    ones, n = rows.agg(F.sum("label"), F.count("*")).first()
    weights = [0.0] * BUCKETS
    if not n:
        return weights, 0.0
    bias = math.log((ones + 1) / (n - ones + 1))
    for _ in range(ROUNDS):
        p = F.lit(1) / (1 + F.exp(-margin(F.col("grams"), weights, bias)))
        scale = 1 / F.sqrt(F.greatest(F.size("grams"), F.lit(1)))
        told = rows.select("grams", (F.col("label") - p).alias("e"), (p * (1 - p)).alias("h"),
                           scale.alias("s"))
        # Bucket -1 is the bias.
        steps = told.select(
            F.explode(F.array_append("grams", F.lit(-1))).alias("g"), "e", "h",
            F.col("s"),
        ).withColumn("x", F.when(F.col("g") < 0, F.lit(1.0)).otherwise(F.col("s"))).groupBy(
            "g"
        ).agg(F.sum(F.col("e") * F.col("x")).alias("e"),
              F.sum(F.col("h") * F.col("x") * F.col("x")).alias("h"))
        for g, e, h in steps.collect():
            # Buckets move together, so each takes part of its own Newton step.
            if g < 0:
                bias += 0.5 * e / (h + 1e-3)
            else:
                weights[g] += 0.2 * (e - 0.05 * weights[g]) / (h + 0.05)
    return weights, bias


def judge(urls: DataFrame, rules: Rules, labelled: DataFrame | None = None) -> DataFrame:
    """Add host, path, rule, verdict and block_score to rows with a ``url``.

    ``labelled`` is a table (host, path, label; 1 blocks). Without it, the distinct urls that
    a rule decides teach the model. Columns of the input with one of these names are
    replaced; other columns pass through. Null and malformed urls fit no rule and are judged
    by the bias alone, as their address is empty. Repeated rows are judged alike.
    """
    found = with_address(urls).withColumn("rule", rule_of(rules))
    if labelled is None:
        labelled = found.where("rule is not null").select(
            "host", "path", (F.col("rule.verdict") == "block").cast("int").alias("label")
        )
    weights, bias = fit(labelled)
    score = 1 / (1 + F.exp(-margin(grams_of(F.col("host"), F.col("path")), weights, bias)))
    scored = found.withColumn("block_score", score)
    learnt = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("rule.verdict", learnt)).withColumn(
        "rule", F.col("rule.rule")
    )
