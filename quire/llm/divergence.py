"""Divergence of sources within each language, by a three-dimensional cube of tasks.

Every (language, source) group has an integer share p of each term its language keeps, so a
pair of groups (g, h) differs by the sum over all kept terms of floor((p - q)^2 / q). A language's
groups are dealt to blocks and its kept terms to blocks, both by hash, in numbers that follow their counts.
A cell of the cube is (group block a, group block b, term block c) with a <= b. The slice of block a
in term block c is replicated to every cell that has a among its group blocks; a cell's task computes the
partial divergences of all pairs between its two blocks, both ways round, over its terms, and the
partials are summed along the term axis. A task holds at most two slices, whatever the size of
the language or of one source.

A group without a term has the constant share p0 of it, so cells add, for terms that any of their groups
has, the difference to the constant f(p0, q0); the cells of term block 0 add V times the constant. All is
integer arithmetic: shares by long division in thousands, so that counts up to 9e15 fit.

Terms are counted per task in numpy and Arrow: rows (lang, source, term, occurrences, documents)
leave a task already summed. Null text, lang and source count as ''. Repeated rows are documents of
their own. A language with no kept term has value 0 for every pair. An empty table gives no rows. Columns other than
text, lang and source are never read, so none can clash. Long texts are cut between terms; a task's memory
follows ``BATCH``, or a longer single term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import texts
from quire.llm.shared import stored

#: Bytes that belong to terms: ASCII letters and all beyond ASCII.
TERM = texts.table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Documents of a language that a kept term is in, at least.
LEAST = 3
#: What the shares of a group add up to, about.
UNIT = 1_000_000_000
#: Groups of a block and terms of a block, about.
GROUPS = 16
TERMS = 8192
#: Ranks of the term report.
TOP = 200
#: Bytes of text counted at a time.
BATCH = 8 << 20


# -- counts ----------------------------------------------------------------------------------


def cut(chunk: texts.Chunk) -> Iterator[texts.Chunk]:
    """The chunk, or a long text in parts that end between terms."""
    data, at = chunk.data, 0
    while len(chunk) == 1 and len(data) - at > BATCH:
        gap = np.flatnonzero(~TERM[data[at + BATCH // 2: at + BATCH]])
        to = at + BATCH // 2 + int(gap[-1]) + 1 if len(gap) else len(data)
        yield texts.Chunk(chunk.first, data[at:to], np.array([0]), np.array([to - at]))
        at = to
    if at == 0:
        yield chunk
    elif at < len(data):
        yield texts.Chunk(chunk.first, data[at:], np.array([0]), np.array([len(data) - at]))


def terms(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and term number of each occurrence, and the distinct terms."""
    inside = TERM[chunk.data]
    lo, hi, at = chunk.words(TERM)
    offsets = np.append(0, np.cumsum(hi - lo)).astype(np.int64)
    data = texts.LOWER[chunk.data[inside]]
    words = pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(offsets), pa.py_buffer(data))
    coded = words.dictionary_encode()
    return (
        np.repeat(np.arange(len(chunk)), np.diff(at)), np.asarray(coded.indices).astype(np.int64),
        coded.dictionary,
    )


def pairs(first: np.ndarray, second: np.ndarray, n: int, weight: np.ndarray | None = None):
    """Distinct (first, second) with second < n: both columns, how often, and summed weights."""
    key = first * max(1, n) + second
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    often = np.diff(np.append(at, len(key)))
    total = often if weight is None else np.add.reduceat(weight[order], at) if len(at) else often
    return key[at] // max(1, n), key[at] % max(1, n), often, total


def task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), summed for every ``BATCH``.

    A long text comes in parts; its terms' document counts are settled over all of them.
    """
    for batch in batches:
        langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
        wide = max(1, len(sources.dictionary))
        group_of = np.asarray(langs.indices).astype(np.int64) * wide + np.asarray(sources.indices)
        for chunk in texts.chunks(batch.column(2), BATCH):
            parts = [(*terms(c),) for c in cut(chunk)]
            if len(parts) > 1:  # one long text
                known = pa.chunked_array([p[2] for p in parts]).unique()
                index = [np.asarray(pc.index_in(p[2], known)).astype(np.int64) for p in parts]
                text_of = np.concatenate([p[0] for p in parts])
                term_of = np.concatenate([index[i][p[1]] for i, p in enumerate(parts)])
            else:
                text_of, term_of, known = parts[0]
            text, term, often, _ = pairs(text_of, term_of, len(known))
            group, term, docs, n = pairs(
                group_of[chunk.first + text], term, len(known), often
            )
            yield pa.RecordBatch.from_arrays([
                langs.dictionary.take(pa.array(group // wide)),
                sources.dictionary.take(pa.array(group % wide)),
                known.take(pa.array(term)).cast(pa.string()), pa.array(n), pa.array(docs),
            ], ["lang", "source", "term", "n", "docs"])


def counted(docs: DataFrame) -> DataFrame:
    """Stored (lang, source, term, n, docs) of rows (lang, source, text) without nulls."""
    each = docs.select("lang", "source", "text").mapInArrow(
        task_counts, "lang STRING, source STRING, term STRING, n LONG, docs LONG"
    )
    return stored(each.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    ), "terms")


# -- shares ----------------------------------------------------------------------------------


def share(count: Column, whole: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / whole), by long division in thousands; exact in longs."""
    a = (count + 1) * 1000
    b = a % whole * 1000
    c = b % whole * 1000
    digits = [F.call_function("div", x, whole) for x in (a, b, c)]
    return 1 + digits[0] * 1_000_000 + digits[1] * 1000 + digits[2]


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def blocks_of(n: Column, size: int) -> Column:
    """How many blocks n things need, one at least."""
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("long")


def spread(what: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(what), F.col(blocks))


class Shares:
    """Stored tables that both parts of the report read.

    ``groups``: lang, source, blank (share of an absent term, null where the language keeps none), v, n_blocks, c_blocks,
    block. ``rows``: lang, source, term, p, q for terms the group has; q is the language's share.
    """

    def __init__(self, docs: DataFrame, least: int = LEAST, groups: int = GROUPS, terms: int = TERMS):
        texts_ = docs.select(
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
        )
        counts = counted(texts_)
        kept = stored(counts.groupBy("lang", "term").agg(
            F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")
        ).where(F.col("docs") >= least).drop("docs"), "kept")
        # Many rows of counts to one kept term; a term of a language has a row for each source at most.
        rows = stored(counts.drop("docs").join(kept, ["lang", "term"]), "rows")
        found = texts_.select("lang", "source").distinct()
        langs = found.groupBy("lang").agg(F.count("*").alias("sources")).join(
            kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n_lang")),
            "lang", "left",
        ).select(
            "lang", F.coalesce("v", F.lit(0)).alias("v"),
            (F.coalesce("n_lang", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("whole_lang"),
            blocks_of(F.col("sources"), groups).alias("n_blocks"),
            blocks_of(F.coalesce("v", F.lit(0)), terms).alias("c_blocks"),
        )
        totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        whole = F.coalesce("n", F.lit(0)) + F.col("v")
        self.groups = stored(
            found.join(totals, ["lang", "source"], "left").join(langs, "lang").select(
                "lang", "source", "v", whole.alias("whole"), "whole_lang", "n_blocks", "c_blocks",
                spread("source", "n_blocks").alias("block"),
            ).withColumn("blank", F.when(F.col("v") > 0, share(F.lit(0), F.col("whole")))),
            "groups",
        )
        # One row for each group, so the join is many to one.
        self.rows = stored(
            rows.join(self.groups, ["lang", "source"]).select(
                "lang", "source", "term", "n_blocks", "block",
                spread("term", "c_blocks").alias("c"),
                share(F.col("n"), F.col("whole")).alias("p"),
                share(F.col("n_lang"), F.col("whole_lang")).alias("q"), "blank",
            ), "shares",
        )


# -- cube ------------------------------------------------------------------------------------

CELL = "lang STRING, source STRING, item STRING, partial LONG"


def cells(shares: Shares) -> DataFrame:
    """Rows (lang, a, b, c, block, source, term, p, blank, v) of every cell's slices; a null term
    announces a group to a cell."""
    heads = shares.groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), "n_blocks", "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("c_blocks") - 1)).alias("c"),
        F.lit(0).cast("long").alias("p"), F.coalesce("blank", F.lit(1)).alias("blank"), "v",
    )
    data = shares.rows.select(
        "lang", "source", "term", "n_blocks", "block", "c", "p", "blank",
        F.lit(0).cast("long").alias("v"),
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    return heads.unionByName(data).withColumn("other", other).select(
        "lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        "c", "block", "source", "term", "p", "blank", "v",
    )


def partials(rows: pa.Table) -> pa.Table:
    """Partial divergences of one cell, both ways round."""
    term = rows.column("term").combine_chunks()
    head = rows.filter(pc.is_null(rows.column("term")))
    body = rows.filter(pc.is_valid(rows.column("term")))
    sources = head.column("source").combine_chunks()
    block = np.asarray(head.column("block"))
    blank = np.asarray(head.column("blank"))
    lang, a, b, c = (rows.column(k)[0].as_py() for k in ("lang", "a", "b", "c"))
    coded = body.column("term").combine_chunks().dictionary_encode()
    p = np.repeat(blank[:, None], len(coded.dictionary), axis=1)
    at = np.asarray(pc.index_in(body.column("source").combine_chunks(), sources))
    p[at, np.asarray(coded.indices)] = np.asarray(body.column("p"))
    of, item, value = [], [], []
    base = int(head.column("v")[0].as_py()) if c == 0 and len(head) else 0
    for g in range(len(sources)):
        others = np.flatnonzero((block == (a if block[g] == b else b)) & (np.arange(len(block)) != g))
        if not len(others):
            continue
        rest = (blank[g] - blank[others]) ** 2 // blank[others]
        total = ((p[g] - p[others]) ** 2 // p[others]).sum(1) - rest * p.shape[1]
        of += [g] * len(others)
        item.append(others)
        value.append(total + base * rest)
    item = np.concatenate(item) if item else np.zeros(0, np.int64)
    return pa.table({
        "lang": pa.array([lang] * len(of), pa.string()),
        "source": sources.take(pa.array(of, pa.int64())), "item": sources.take(pa.array(item)),
        "partial": pa.array(np.concatenate(value) if value else [], pa.int64()),
    }).select(["lang", "source", "item", "partial"])


def divergences(shares: Shares) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources."""
    each = cells(shares).groupBy("lang", "a", "b", "c").applyInArrow(partials, CELL)
    return each.groupBy("lang", "source", "item").agg(F.sum("partial").alias("value"))


def overused(shares: Shares) -> DataFrame:
    """(lang, source, item, value) of the terms a group uses more than its language does."""
    return shares.rows.where("p > q").select(
        "lang", "source", F.col("term").alias("item"),
        difference(F.col("p"), F.col("q")).alias("value"),
    )


def ranked(rows: DataFrame, part: str) -> DataFrame:
    """Ranks in each group by value, greatest first; equal values by the item's bytes."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
    )


def report(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources, and each group's ``top`` terms."""
    shares = Shares(docs)
    # Each map task keeps its first ``top`` ranks of a group before the shuffle.
    return ranked(divergences(shares), "pair").unionByName(
        ranked(overused(shares), "term").where(F.col("rank") <= top)
    )
