"""Toxicity by nearest labelled examples.

Labelled documents are examples: TF-IDF vectors over words and their beginnings. Examples that
score a document are found by exact cosine over an inverted index whose postings lie in blocks of
examples, each with its largest weight (block-max): blocks are scored in the order of their upper
bounds, some at a time, until no further block can reach the K nearest. The votes of the K nearest count with
their cosines, and the vote is turned into a probability by a logistic curve fitted to examples
that score each other (each without itself).

The examples are a bounded, documented sample of the labelled rows, so the index has a fixed size at
any input; every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from quire.llm import texts
from quire.llm.shared import remainder, stored

#: Labelled rows fitted at most, of either label: those with the least hashes.
MAX_EXAMPLES = 3000
#: Terms of the index: those that tell the labels apart best.
MAX_TERMS = 20_000
K = 15
BLOCK = 128
#: Blocks scored at first, and how many times more each time after.
FIRST, MORE = 4, 4
#: Tasks of the leave-one-out votes.
TASKS = 32
#: Lengths in bytes of the word beginnings that are terms besides whole words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
TRIM = ~texts.table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
MEMBER = texts.WORD & TRIM


def terms(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term hashes of the texts of a chunk, the text of each, and the word before each."""
    lo, hi, at = chunk.words(MEMBER)
    of = np.repeat(np.arange(len(chunk)), np.diff(at))
    sums = texts.prefix(texts.BYTE[texts.LOWER[chunk.data]])
    words = texts.ranged(sums, lo, hi)
    before = np.append(np.zeros(1, np.uint64), words)[:-1]
    out, owner, last = [words], [of], [before]
    for n in BEGINNINGS:
        long = hi - lo > n
        out.append(texts.mix(texts.ranged(sums, lo[long], lo[long] + n) + np.uint64(n)))
        owner.append(of[long])
        last.append(before[long])
    return np.concatenate(out), np.concatenate(owner), np.concatenate(last)


class Index(NamedTuple):
    """Terms in order with idf; postings by (term, block) with the largest weight of each."""

    term: np.ndarray
    idf: np.ndarray
    n_docs: int
    post_at: np.ndarray     # by term * blocks + block
    example: np.ndarray
    weight: np.ndarray
    best: np.ndarray        # term, block
    toxic: np.ndarray
    curve: np.ndarray       # of the calibration: slope, offset, and the rate without neighbours
    ids: list               # doc_id of each example


def bags(known: np.ndarray, chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term number, count) of the known terms, by text."""
    words, owner, _ = terms(chunk)
    at = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
    hit = known[at] == words if len(known) else np.zeros(len(words), bool)
    pairs, n = np.unique(owner[hit] * len(known) + at[hit], return_counts=True)
    return pairs // max(1, len(known)), pairs % max(1, len(known)), n


def weighed(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(tf)) * idf


def nearest(index: Index, term: np.ndarray, weight: np.ndarray, without: int = -1,
            k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The k examples of greatest cosine above 0 with a unit vector, and the cosines."""
    n_blocks = index.best.shape[1]
    bound = weight @ index.best[term]
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    found, score = np.zeros(0, np.int64), np.zeros(0)
    at, group = 0, FIRST
    while at < len(order):
        some = order[at: at + group]
        if len(score) == k:
            some = some[score[-1] < bound[some] + 1e-9]
            if not len(some):
                break
        at, group = at + group, group * MORE
        run = (term[:, None] * n_blocks + some).ravel()
        lo = index.post_at[run]
        size = index.post_at[run + 1] - lo
        places = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        dots = np.bincount(
            index.example[places],
            index.weight[places] * np.repeat(np.repeat(weight, len(some)), size), index.n_docs,
        )
        if without >= 0:
            dots[without] = 0
        new = np.flatnonzero(dots > 0)
        found, score = np.append(found, new), np.append(score, dots[new])
        top = np.lexsort((found, -score))[:k]
        found, score = found[top], score[top]
    return found, score


def vote(index: Index, found: np.ndarray, score: np.ndarray) -> float:
    """Share of toxic examples among the nearest, weighed by cosine; nan without any."""
    return float((score * index.toxic[found]).sum() / score.sum()) if len(found) else np.nan


def calibrated(index: Index, votes: np.ndarray) -> np.ndarray:
    slope, offset, bare = index.curve
    p = 1 / (1 + np.exp(-(slope * np.nan_to_num(votes) + offset)))
    return np.where(np.isnan(votes), bare, p)


def scores(
    index: Index, chunk: texts.Chunk, without: np.ndarray | None = None
) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """Vote, nearest examples and cosines of each text, perhaps without an example each."""
    text, term, tf = bags(index.term, chunk)
    weight = weighed(tf, index.idf[term])
    at = np.searchsorted(text, np.arange(len(chunk) + 1))
    for i in range(len(chunk)):
        t, w = term[at[i]: at[i + 1]], weight[at[i]: at[i + 1]]
        unit = w / max(np.sqrt((w * w).sum()), 1e-12)
        found, score = nearest(index, t, unit, -1 if without is None else int(without[i]))
        yield vote(index, found, score), found, score


def gains(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood ratio of a term's rates in either label, and the log of their odds."""
    a, b = (bad + 0.5) / (n_bad + 1), (good + 0.5) / (n_good + 1)
    rest = np.log1p(-np.minimum(a, 1 - 1e-9)) - np.log1p(-np.minimum(b, 1 - 1e-9))
    gain = bad * np.log(a / b) + np.maximum(n_bad - bad, 0) * rest
    return np.where(a > b, gain, 0), np.log(a / b)


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, bad, good): examples of either label with the term, by chunk."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for chunk in texts.chunks(batch.column("text"), 1 << 19):
            words, owner, _ = terms(chunk)
            _, first = np.unique(words ^ texts.mix(owner.astype(np.uint64) + np.uint64(1)), return_index=True)
            term, which = np.unique(words[first], return_inverse=True)
            bad = np.bincount(which, toxic[chunk.first + owner[first]], len(term)).astype(np.int64)
            good = np.bincount(which, minlength=len(term)) - bad
            yield pa.RecordBatch.from_arrays(
                [pa.array(term.view(np.int64)), pa.array(bad), pa.array(good)], ["term", "bad", "good"]
            )


def contexts_of(known: np.ndarray):
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(term, last): the different words before each known term, by chunk."""
        for batch in batches:
            for chunk in texts.chunks(batch.column("text"), 1 << 19):
                words, _, last = terms(chunk)
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                hit = known[at] == words
                pair = np.unique(np.stack([words[hit].view(np.int64), last[hit].view(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["term", "last"])

    return contexts


def vectors_of(known: np.ndarray):
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(example, term, tf) of the known terms of the examples."""
        for batch in batches:
            number = np.asarray(batch.column("example"))
            for chunk in texts.chunks(batch.column("text"), 1 << 19):
                text, term, tf = bags(known, chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[chunk.first + text]), pa.array(term), pa.array(tf)],
                    ["example", "term", "tf"],
                )

    return vectors


def build(term: np.ndarray, idf: np.ndarray, row: np.ndarray, col: np.ndarray, tf: np.ndarray,
          toxic: np.ndarray) -> Index:
    """The index of examples: term ``col`` occurs ``tf`` times in example ``row``."""
    n = len(toxic)
    weight = weighed(tf, idf[col])
    weight = weight / np.sqrt(np.bincount(row, weight * weight, n))[row]
    n_blocks = max(1, -(-n // BLOCK))
    key = col * n_blocks + row // BLOCK
    order = np.lexsort((row, key))
    post_at = np.searchsorted(key[order], np.arange(n_blocks * len(term) + 1))
    best = np.zeros(n_blocks * len(term))
    np.maximum.at(best, key, weight)
    return Index(term, idf, n, post_at, row[order], weight[order],
                 best.reshape(len(term), n_blocks), toxic.astype(float), np.zeros(3), [])


def own_votes(examples: DataFrame, index: Index) -> np.ndarray:
    """The vote for each example by the others, counted in tasks; one number comes back for each."""
    sent = examples.sparkSession.sparkContext.broadcast(tuple(index))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Index(*sent.value)
        for batch in batches:
            number = np.asarray(batch.column("example"))
            told = [
                v for chunk in texts.chunks(batch.column("text"))
                for v, _, _ in scores(known, chunk, number[chunk.first:])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(np.array(told, float))], ["example", "vote"]
            )

    rows = examples.select("example", "text").repartition(TASKS, "example").mapInArrow(
        votes, "example LONG, vote DOUBLE"
    ).toPandas()
    out = np.full(index.n_docs, np.nan)
    out[rows["example"].to_numpy(np.int64)] = rows["vote"].to_numpy(float)
    return out


def curve(index: Index, votes: np.ndarray) -> np.ndarray:
    """Logistic fit of labels on leave-one-out votes, and the rate among rows without neighbours."""
    bare = np.isnan(votes)
    rate = (index.toxic[bare].sum() + 0.5) / (bare.sum() + 1) if bare.any() else 0.5
    x, y = votes[~bare], index.toxic[~bare]
    slope, offset = 4.0, -2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        h = p * (1 - p)
        # A weak pull to the start keeps the fit finite where labels separate.
        g = np.array([((y - p) * x).sum() - 0.1 * (slope - 4), (y - p).sum() - 0.1 * (offset + 2)])
        m = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.1]])
        slope, offset = np.array([slope, offset]) + np.linalg.solve(m, g)
    return np.array([slope, offset, rate])


def shape_of(kind: str) -> str:
    return f"score DOUBLE, evidence ARRAY<STRUCT<doc_id: {kind}, toxic: BOOLEAN, cosine: DOUBLE>>"


def examples_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored (example, id, toxic, text): labelled rows outside the held-out fifth, at most MAX_EXAMPLES
    of either label. Repeated rows count once; null ids, labels and texts teach nothing.

    Toxic ones have the first numbers, so that blocks are of one label and bounds are tight.
    """
    told = labels.where("toxic is not null").select(
        F.col("doc_id").alias("id"), "toxic"
    ).where(remainder("id", 5) != 0).distinct()
    draw = F.xxhash64("id")
    few = told.where("toxic = 1").orderBy(draw, "id").limit(MAX_EXAMPLES).union(
        told.where("toxic = 0").orderBy(draw, "id").limit(MAX_EXAMPLES)
    )
    rows = docs.where("text is not null").join(F.broadcast(few), F.col("doc_id") == F.col("id"))
    rows = rows.select("id", "text", F.col("toxic").cast("long").alias("toxic")).distinct()
    order = Window.orderBy(F.desc("toxic"), draw, "id", F.xxhash64("text"))
    return stored(
        rows.select((F.row_number().over(order) - 1).cast("long").alias("example"), "id", "toxic", "text"),
        "examples",
    )


def fit(docs: DataFrame, labels: DataFrame) -> Index:
    """The index of the examples; only what it holds reaches the driver."""
    examples = examples_of(docs, labels)
    told = examples.select("example", "id", "toxic").orderBy("example").collect()
    toxic, ids = np.array([r["toxic"] for r in told], np.int64), [r["id"] for r in told]
    n_bad, n_good = int(toxic.sum()), int(len(toxic) - toxic.sum())
    counts = examples.mapInArrow(frequencies, "term LONG, bad LONG, good LONG").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    counts = stored(counts, "terms")
    # So many terms are tried that only a ratio beyond their number tells something.
    least = np.log(max(2, counts.count()))
    found = counts.where("bad >= 3").toPandas()
    term = found["term"].to_numpy(np.int64).view(np.uint64)
    bad, good = found["bad"].to_numpy(np.int64), found["good"].to_numpy(np.int64)
    gain, _ = gains(bad, good, n_bad, n_good)
    order = np.lexsort((term, -gain))[: 2 * MAX_TERMS]
    order = order[gain[order] > least]
    order = order[np.argsort(term[order])]
    term, bad, good = term[order], bad[order], good[order]
    if len(term):
        # Copies of a toxic document repeat all of its words; a word that is toxic itself comes
        # after different words. So support is the number of different words before it, at most.
        spread = examples.where("toxic = 1").select("text").mapInArrow(
            contexts_of(term), "term LONG, last LONG"
        ).groupBy("term").agg(F.count_distinct("last").alias("n")).toPandas()
        at = np.searchsorted(term, spread["term"].to_numpy(np.int64).view(np.uint64))
        wide = np.zeros(len(term), np.int64)
        wide[at] = spread["n"].to_numpy(np.int64)
        df, bad = bad + good, np.minimum(bad, wide)
        gain, odds = gains(bad, good, n_bad, n_good)
        keep = np.flatnonzero((bad >= 3) & (gain > least))
        keep = np.sort(keep[np.argsort(-gain[keep], kind="stable")[:MAX_TERMS]])
        term, df, odds = term[keep], df[keep], odds[keep]
    if not len(term):
        none = np.zeros(0, np.int64)
        index = build(none.view(np.uint64), np.zeros(0), none, none, none, toxic)
        return index._replace(curve=curve(index, np.full(len(toxic), np.nan)), ids=ids)
    # Terms that good examples share as well count less by their odds.
    idf = (np.log((len(toxic) + 1) / (df + 1)) + 1) * np.clip(odds / np.log(50), 0.05, 1)
    rows = examples.select("example", "text").mapInArrow(
        vectors_of(term), "example LONG, term LONG, tf LONG"
    ).toPandas().sort_values(["example", "term"])
    row, col, tf = (rows[c].to_numpy(np.int64) for c in ("example", "term", "tf"))
    index = build(term, idf, row, col, tf, toxic)
    return index._replace(curve=curve(index, own_votes(examples, index)), ids=ids)


def scored(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` with a struct column ``tox``: score and the nearest examples as evidence."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(index))
    shape = StructType.fromDDL(shape_of(docs.schema["doc_id"].dataType.simpleString()))
    kind = to_arrow_type(shape["evidence"].dataType)

    @F.arrow_udf(shape)
    def score(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Index(*sent.value)
        for part in column:
            votes, evidence = [], []
            for chunk in texts.chunks(part):
                for v, found, cosine in scores(known, chunk):
                    votes.append(v)
                    evidence.append([
                        {"doc_id": known.ids[e], "toxic": bool(known.toxic[e]), "cosine": float(c)}
                        for e, c in zip(found[:3], cosine[:3])
                    ])
            p = calibrated(known, np.array(votes, float))
            yield pa.StructArray.from_arrays(
                [pa.array(p, pa.float64()), pa.array(evidence, kind)], ["score", "evidence"]
            )

    return docs.select("*", score.asNondeterministic()("text").alias("tox"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, evidence.

    A null, empty or neutral text has no neighbours and gets the rate of toxic ones among examples
    without neighbours. Without toxic examples no text has neighbours. A null id is not held out.
    """
    docs = docs.select("doc_id", "text")
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored(docs, fit(docs, labels)).select(
        "doc_id", held.alias("held_out"), "tox.score",
        (F.col("tox.score") >= 0.5).cast("int").alias("predicted"), "tox.evidence",
    )
