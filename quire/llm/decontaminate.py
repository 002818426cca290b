"""Benchmark decontamination with a positional inverted index of the training tokens.

The index is distributed by documents: every shard of documents has, for each of its terms, the
list of its token positions. A benchmark window is searched in each shard by intersecting the
offset-adjusted lists of its terms, the rarest term of the shard first, so that most windows end
after one empty list. Positions leave a gap between documents, so no match crosses one.

``report`` stores the index as a table, one row per shard, and searches it; ``clean`` searches each
shard while the documents pass by, so that their other columns need no join. The windows go to all
shards in blocks of a fixed number, as benchmarks may grow. No posting is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm import texts
from quire.llm.shared import stored

WINDOW = 10
#: Windows sent to the shards at a time: at most 10 terms of 8 bytes each, so 20 MB.
BLOCK = 250_000
SHARD = 4 << 20
MEMBER = texts.table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
GAP = 64


@dataclass
class Windows:
    """Distinct phrases: term hashes by row (0 beyond ``length``) and the items that hold them."""

    terms: np.ndarray
    length: np.ndarray
    item_at: np.ndarray
    items: np.ndarray


@dataclass
class Shard:
    """Terms in order, their lists of positions, and where texts begin among the positions."""

    terms: np.ndarray
    list_at: np.ndarray
    places: np.ndarray
    text_at: np.ndarray
    n_words: np.ndarray


def term_hashes(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    lo, hi, at = chunk.words(MEMBER)
    sums = texts.prefix(texts.BYTE[texts.LOWER[chunk.data]])
    return texts.ranged(sums, lo, hi) | np.uint64(1), at


def index(chunk: texts.Chunk) -> Shard:
    """The positional inverted index of a chunk of texts."""
    words, at = term_hashes(chunk)
    n_words = np.diff(at)
    text_at = at[:-1] + GAP * np.arange(len(n_words))
    places = np.arange(len(words)) + GAP * np.repeat(np.arange(len(n_words)), n_words)
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(words) else order
    return Shard(ranked[first], np.append(first, len(words)), places[order], text_at, n_words)


def search(shard: Shard, windows: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all matches: every term at its offset, give or take ``slop`` words."""
    if not len(shard.terms) or not len(windows.length):
        none = np.zeros(0, np.int64)
        return none, none
    at = np.searchsorted(shard.terms, windows.terms)
    at = np.minimum(at, len(shard.terms) - 1)
    used = np.arange(windows.terms.shape[1]) < windows.length[:, None]
    there = shard.terms[at] == windows.terms
    size = np.where(used, shard.list_at[at + 1] - shard.list_at[at], np.iinfo(np.int64).max)
    alive = np.flatnonzero((there | ~used).all(1))
    found, begin = [], []
    for w in alive:
        order = np.argsort(size[w, : windows.length[w]], kind="stable")
        starts = None
        for o in order:
            t = at[w, o]
            listed = shard.places[shard.list_at[t]: shard.list_at[t + 1]] - o
            if starts is None:
                starts = listed
                continue
            near = np.searchsorted(listed, starts - slop)
            near_enough = near < len(listed)
            near_enough[near_enough] = listed[near[near_enough]] <= starts[near_enough] + slop
            starts = starts[near_enough]
            if not len(starts):
                break
        if len(starts):
            found.append(np.full(len(starts), w))
            begin.append(starts)
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(found), np.concatenate(begin)


def sent(spark, windows: Windows):
    """Broadcast of the fields; ``BLOCK`` bounds its size."""
    w = windows
    return spark.sparkContext.broadcast((w.terms, w.length, w.item_at, w.items.tolist()))


def received(of) -> Windows:
    terms, length, item_at, items = of.value
    return Windows(terms, length, item_at, np.array([*items, None], object)[:-1])


def windows_of(rows: list[tuple[str, list[bytes]]]) -> Windows:
    """Windows from rows (item, terms); equal phrases of several items are one window."""
    items: dict[tuple[bytes, ...], list[str]] = {}
    for item, terms in rows:
        items.setdefault(tuple(terms), []).append(item)
    length = np.array([len(k) for k in items], np.int64)
    terms = np.zeros((len(items), max([1, *length])), np.uint64)
    joined = pa.array([b"".join(k) for k in items], pa.binary())
    # The terms of all windows are hashed like those of texts.
    sums = texts.prefix(texts.BYTE[np.frombuffer(b"".join(joined.to_pylist()), np.uint8)])
    sizes = np.array([len(t) for k in items for t in k], np.int64)
    ends = np.cumsum(sizes)
    hashes = texts.ranged(sums, ends - sizes, ends) | np.uint64(1)
    used = np.arange(terms.shape[1]) < length[:, None]
    terms[used] = hashes
    held = [sorted(set(v)) for v in items.values()]
    flat = np.array([x for v in held for x in v], object)
    return Windows(terms, length, np.append(0, np.cumsum([len(v) for v in held])), flat)


def phrases(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item, terms) for every window of the items; a shorter item is one window."""
    words = F.regexp_extract_all(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0),
    )
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w"))
    items = items.where("size(w) > 0")
    last = F.greatest(F.size("w") - width + 1, F.lit(1))
    each = items.select("item", "w", F.explode(F.sequence(F.lit(1), last)).alias("i"))
    return each.select(
        F.coalesce("item", F.lit("")).alias("item"), F.slice("w", F.col("i"), width).alias("terms")
    ).distinct()


def blocks(benchmark: DataFrame, width: int, size: int) -> Iterator[tuple[Windows, bool]]:
    """The windows in blocks of at most ``size`` distinct ones, and whether others follow."""
    rows = phrases(benchmark, width).orderBy("terms", "item")
    held: list[tuple[str, list[bytes]]] = []
    last, distinct = None, 0
    for r in rows.toLocalIterator():
        terms = [t.encode() for t in r["terms"]]
        if terms != last:
            if distinct == size:
                yield windows_of(held), True
                held, distinct = [], 0
            last, distinct = terms, distinct + 1
        held.append((r["item"], terms))
    yield windows_of(held), False


HITS = "n_words LONG, n_hit LONG, places ARRAY<LONG>, items ARRAY<STRING>"


def shard_hits(shard: Shard, windows: Windows, slop: int) -> Iterator[tuple]:
    """For each text of a shard: words, covered places in it, and items with a match."""
    which, start = search(shard, windows, slop)
    start = np.maximum(start, 0)
    total = int(shard.text_at[-1] + shard.n_words[-1]) + 2 * GAP
    hit = np.flatnonzero(texts.covered(start, windows.length[which], total))
    hit_of = np.searchsorted(shard.text_at, hit, "right") - 1
    inside = hit - shard.text_at[hit_of]
    real = inside < shard.n_words[hit_of]
    inside, hit_of = inside[real], hit_of[real]
    owner = np.searchsorted(shard.text_at, start, "right") - 1
    items: dict[int, set[str]] = {}
    for p in np.unique(owner * max(1, len(windows.length)) + which):
        t, w = divmod(int(p), len(windows.length))
        items.setdefault(t, set()).update(
            windows.items[windows.item_at[w]: windows.item_at[w + 1]]
        )
    at = np.searchsorted(hit_of, np.arange(len(shard.n_words) + 1))
    for i, n in enumerate(shard.n_words):
        yield int(n), inside[at[i]: at[i + 1]].tolist(), sorted(items.get(i, ()))


def _hits(column: pa.Array, windows: Windows, slop: int) -> Iterator[tuple]:
    for chunk in texts.chunks(column, SHARD):
        yield from shard_hits(index(chunk), windows, slop)


def _with_hits(windows, slop: int):
    @F.arrow_udf(StructType.fromDDL(HITS))
    def hits(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = received(windows)
        for part in column:
            rows = list(_hits(part, known, slop))
            n, places, items = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array([len(p) for p in places], pa.int64()),
                 pa.array(places, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                ["n_words", "n_hit", "places", "items"],
            )

    return hits.asNondeterministic()


def matched(
    docs: DataFrame, benchmark: DataFrame, slop: int = 0, width: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """``docs`` as one struct column ``row`` and ``hit``: n_words, n_hit, places, items.

    ``slop`` 0 gives exact phrases; above 0, proximity matches with every term at most so many
    words (below 16) from its place. A null or empty text has no words and no hits; an item without words
    has no windows; a null item id counts as ''. Columns that ``docs`` brings stay in ``row``,
    so no name clashes.
    """
    spark = docs.sparkSession
    rows, merged = docs.select(F.struct("*").alias("row")), None
    for windows, more in blocks(benchmark, width, block):
        found = _with_hits(sent(spark, windows), slop)(F.col("row.text")).alias("hit")
        rows = rows.select("row", *(["hit0"] if merged else []), found)
        if merged:
            both = F.array_sort(F.array_union("hit0.places", "hit.places"))
            rows = rows.select("row", F.struct(
                F.col("hit.n_words").alias("n_words"), F.size(both).cast("long").alias("n_hit"),
                both.alias("places"),
                F.array_sort(F.array_union("hit0.items", "hit.items")).alias("items"),
            ).alias("hit"))
        if more:
            rows, merged = stored(rows, "windows").withColumnRenamed("hit", "hit0"), True
    return rows


def postings(docs: DataFrame) -> DataFrame:
    """The stored index: one row per shard with its number, ids, term lists and numbers of words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = (
        f"shard LONG, ids ARRAY<{kind}>, n_words ARRAY<LONG>, terms BINARY, list_at BINARY, places BINARY"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Written with the shard, so that equal shards stay apart however often they are read.
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for chunk in texts.chunks(batch.column("text"), SHARD):
                s, number = index(chunk), number + 1
                ids = batch.column("doc_id").slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()),
                    pa.array([ids.to_pylist()], pa.list_(ids.type)),
                    pa.array([s.n_words], pa.list_(pa.int64())),
                    *[pa.array([x.tobytes()], pa.binary()) for x in (
                        s.terms, s.list_at.astype(np.int64), s.places.astype(np.int32)
                    )],
                ], ["shard", "ids", "n_words", "terms", "list_at", "places"])

    return stored(docs.select("doc_id", "text").mapInArrow(build, shape), "postings")


def lookup(index_rows: DataFrame, windows, slop: int = 0) -> DataFrame:
    """(shard, nth, doc_id, n_words, places, items) for every document of a stored index."""
    kind = index_rows.schema["ids"].dataType.elementType
    shape = (
        f"shard LONG, nth LONG, doc_id {kind.simpleString()}, n_words LONG, places ARRAY<LONG>, "
        "items ARRAY<STRING>"
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(windows)
        for batch in batches:
            for row in range(len(batch)):
                cells = {n: batch.column(n)[row] for n in batch.schema.names}
                ids = cells["ids"].values
                n = np.asarray(cells["n_words"].values)
                terms, list_at, places = (
                    np.frombuffer(cells[c].as_py(), t)
                    for c, t in (("terms", np.uint64), ("list_at", np.int64), ("places", np.int32))
                )
                text_at = np.cumsum(n) - n + GAP * np.arange(len(n))
                shard = Shard(terms, list_at, places.astype(np.int64), text_at, n)
                hits = list(shard_hits(shard, known, slop))
                n_words, where, items = zip(*hits)
                yield pa.RecordBatch.from_arrays([
                    pa.array([cells["shard"].as_py()] * len(n), pa.int64()),
                    pa.array(np.arange(len(n)), pa.int64()), ids, pa.array(n_words, pa.int64()),
                    pa.array(where, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())),
                ], ["shard", "nth", "doc_id", "n_words", "places", "items"])

    return index_rows.mapInArrow(find, shape)


def report(
    docs: DataFrame, benchmark: DataFrame, slop: int = 0, width: int = WINDOW, block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    The same cases as in ``matched`` hold; repeated rows are reported each.
    """
    spark = docs.sparkSession
    lists, found, parts = postings(docs), None, 0
    for windows, _ in blocks(benchmark, width, block):
        part = lookup(lists, sent(spark, windows), slop)
        found = part if found is None else found.union(part)
        parts += 1
    if parts > 1:
        distinct = F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")
        items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
        found = found.groupBy("shard", "nth", "doc_id", "n_words").agg(distinct, items)
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("places") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with all columns they came with."""
    return matched(docs, benchmark, **options).where("hit.n_hit = 0").select("row.*")
