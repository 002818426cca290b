"""Suffix-array dedup: remove what a string of LONG bytes covers that starts anywhere else, too.

The suffix arrays are sparse. Every window of LONG bytes has one anchor, the place in it whose
next CORE bytes have the least hash (the first of equals), so equal windows have equal anchors at
the same offset. Windows with one anchor are consecutive: a run. Only anchors are indexed, in
the order of their cores (hashes of their first CORE bytes), with the hash of the run's whole span.

* Index family: documents come in batches. A batch's array is merge-scanned with all levels in one
  aggregation by core; the batch and the low levels that are as large as it leave the same
  aggregation as the next level, so levels grow geometrically. A core whose runs all have one
  span repeats as a whole; one with several spans is mixed, and its windows must be compared.
* Mixed cores: of each distinct span one copy is sent to the other spans of its core, and their windows
  are compared. A core with more than SPANS spans is not gathered: its windows are counted
  by hash over the cluster.
* Removed runs of windows join the runs of the documents by span, then the texts by their hashes.

Between the passes, fixed-size bit tables tell tasks which runs are worth a row; they may say yes in
vain, and the joins that follow are exact (up to 64-bit hashes of contents).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import texts
from quire.llm.shared import stored

LONG = 200
CORE = 32
#: Batches that the documents of a table are added in.
BATCHES = 3
#: Bits of a bit table: BITS_PER_KEY for every key, up to MOST_BITS (16 MB).
BITS_PER_KEY, MOST_BITS = 16, 1 << 27
#: Spans of a core that are compared in one task, at most.
SPANS = 20_000
U = np.uint64


class Runs(NamedTuple):
    """Runs of windows: first and last start, and hashes of core and span."""

    first: np.ndarray
    last: np.ndarray
    core: np.ndarray
    span: np.ndarray


def runs(chunk: texts.Chunk) -> Runs:
    """All runs of a chunk; places are in the chunk."""
    width = LONG - CORE + 1
    full = chunk.ends - chunk.starts >= LONG
    if not full.any():
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(U), none.astype(U))
    data, n = chunk.data, len(chunk.data)
    sums = texts.prefix(texts.BYTE[data])
    key = (sums.sums[CORE:] - sums.sums[:-CORE]) * sums.down[: n - CORE + 1]
    key *= U(0x9E3779B97F4A7C15)
    key ^= key >> U(29)
    key *= U(0xBF58476D1CE4E5B9)
    # The place in the low half makes the first of equals the least.
    key = key & U(0xFFFFFFFF00000000) | np.arange(len(key), dtype=U)
    # Sliding minimum: of the end of one block and the beginning of the next.
    blocks = np.full(-(-len(key) // width) * width + width, U(0xFFFFFFFFFFFFFFFF))
    blocks[: len(key)] = key
    blocks = blocks.reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - LONG + 1
    anchor = (np.minimum(tail[:count], head[width - 1: width - 1 + count]) & U(0xFFFFFFFF)).astype(np.int64)
    low, high = chunk.starts[full], chunk.ends[full] - LONG
    valid = texts.covered(low, high - low + 1, count)
    same = np.append(False, anchor[1:] == anchor[:-1])
    begin = valid & ~(same & np.append(False, valid[:-1]))
    begin[low] = True
    first = np.flatnonzero(begin)
    end = valid & ~np.append((same & valid)[1:], False)
    end[high] = True
    last = np.flatnonzero(end)
    at = anchor[first]
    return Runs(
        first, last, texts.ranged(sums, at, at + CORE), texts.ranged(sums, first, last + LONG)
    )


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def suffix_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, lo, hi, n): cores of a task in order, least and greatest span, and 1 or 2 for more."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, ...]:
        core, lo, hi, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(core, kind="stable")
        core, lo, hi, n = core[order], lo[order], hi[order], n[order]
        first = np.flatnonzero(np.append(True, core[1:] != core[:-1]))
        return (core[first], np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first),
                np.minimum(np.add.reduceat(n, first), 2))

    def rows(core, lo, hi, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [signed(core), pa.array(lo), pa.array(hi), pa.array(n.astype(np.int32))], ["core", "lo", "hi", "n"]
        )

    size = 0
    for batch in batches:
        for chunk in texts.chunks(batch.column("text")):
            r = runs(chunk)
            if not len(r.core):
                continue
            span = r.span.view(np.int64)
            held.append((r.core, span, span, np.ones(len(span), np.int32)))
            size += len(span)
            if size > 1 << 20:
                held = [merged()]
                size = len(held[0][0])
                if size > 1 << 19:
                    yield rows(*held[0])
                    held, size = [], 0
    if held:
        yield rows(*merged())


class Family:
    """Levels of (core, span, mixed, n): tables in the shared folder, the newest last."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, texts_: DataFrame) -> None:
        """Merge-scan a batch (text) with all levels and store it, merged with equal-sized ones.

        n is 2 where the core has been seen before or more than once.
        """
        rank = 0
        kept = list(self.levels)
        while kept and kept[-1][0] == rank:
            kept.pop()
            rank += 1
        fresh = texts_.select("text").mapInArrow(suffix_array, "core LONG, lo LONG, hi LONG, n INT")
        met = fresh.select("core", "lo", "hi", F.lit(False).alias("mixed"), "n", F.lit(True).alias("goes"))
        for i, (_, level) in enumerate(self.levels):
            met = met.union(level.select(
                "core", F.col("span").alias("lo"), F.col("span").alias("hi"), "mixed", "n",
                F.lit(i >= len(kept)).alias("goes"),
            ))
        grouped = met.groupBy("core").agg(
            F.min("lo").alias("span"),
            (F.max("mixed") | (F.min("lo") != F.max("hi"))).alias("mixed"),
            F.least(F.sum("n"), F.lit(2)).cast("int").alias("n"), F.max("goes").alias("goes"),
        )
        level = stored(grouped.where("goes").drop("goes").sortWithinPartitions("core"), "level")
        self.levels = [*kept, (rank, level)]

    def repeated(self) -> DataFrame:
        """(core, mixed) of the cores seen more than once."""
        parts = [level.where("n > 1").select("core", "mixed") for _, level in self.levels]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out.groupBy("core").agg(F.max("mixed").alias("mixed"))


def bit_table(keys: DataFrame, key: str) -> np.ndarray:
    """Bit table of the hashes in a column; its size is bounded at any number of keys."""
    wanted = max(64, BITS_PER_KEY * keys.count())
    bits = min(MOST_BITS, 1 << int(wanted - 1).bit_length())
    words = keys.groupBy(F.shiftright(F.pmod(F.col(key), F.lit(bits)), 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def has(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key.view(np.int64) % (64 * len(table))
    return (table[at >> 6] >> (at & 63)) & 1 == 1


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k1, k2): null texts as empty ones, and two hashes that stand for id and text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumns({
        "k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(1), "doc_id", "text"),
    })


def found_runs(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """(k1, k2, first, last, core, span) of the runs whose core the table holds."""
    sent = rows.sparkSession.sparkContext.broadcast(table)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for chunk in texts.chunks(batch.column("text")):
                r = runs(chunk)
                hit = np.flatnonzero(has(known, r.core))
                of = np.searchsorted(chunk.starts, r.first[hit], "right") - 1
                # Of empty texts at one place, the last is the one with bytes.
                k1, k2 = (np.asarray(batch.column(k))[chunk.first + of] for k in ("k1", "k2"))
                yield pa.RecordBatch.from_arrays([
                    pa.array(k1), pa.array(k2), pa.array((r.first[hit] - chunk.starts[of]).astype(np.int32)),
                    pa.array((r.last[hit] - chunk.starts[of]).astype(np.int32)),
                    signed(r.core[hit]), signed(r.span[hit]),
                ], ["k1", "k2", "first", "last", "core", "span"])

    shape = "k1 LONG, k2 LONG, first INT, last INT, core LONG, span LONG"
    return rows.select("k1", "k2", "text").mapInArrow(find, shape)


def spans_of(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """(core, span, bytes) of the runs whose (span, text) the table holds.

    What comes in vain or twice does no harm: every row is a place of its own in the texts.
    """
    sent = rows.sparkSession.sparkContext.broadcast(table)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for chunk in texts.chunks(batch.column("text")):
                r = runs(chunk)
                of = np.searchsorted(chunk.starts, r.first, "right") - 1
                k1 = np.asarray(batch.column("k1"))[chunk.first + of]
                hit = np.flatnonzero(has(known, r.span.view(np.int64) ^ k1))
                # A text may hold a span very often.
                hit = hit[np.unique(r.span[hit], return_index=True)[1]]
                raw = chunk.data.tobytes()
                cells = [raw[a:b] for a, b in zip(r.first[hit].tolist(), (r.last[hit] + LONG).tolist())]
                yield pa.RecordBatch.from_arrays([
                    signed(r.core[hit]), signed(r.span[hit]), pa.array(cells, pa.binary()),
                ], ["core", "span", "bytes"])

    return rows.select("k1", "text").mapInArrow(cut, "core LONG, span LONG, bytes BINARY")


def windows(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and start of every window of some spans."""
    column = part.column("bytes")
    size = np.array([len(x) for x in column.to_pylist()], np.int64)
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    begin = np.cumsum(size) - size
    n = size - LONG + 1
    row = np.repeat(np.arange(len(size)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    sums = texts.prefix(texts.BYTE[data])
    at = begin[row] + start
    return texts.ranged(sums, at, at + LONG), row, start


PARTS = "span LONG, low INT, high INT, long INT, core LONG, bytes BINARY"


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows (low to high) of the spans, which come in the order of cores.

    Spans of a core with more than SPANS of them are passed on in ``bytes``.
    """
    def whole() -> Iterator[tuple[pa.RecordBatch, bool]]:
        """Batches of whole cores; of a long core, pieces that are marked as such."""
        held, long = None, None
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                core = np.asarray(part.column("core"))
                last = np.flatnonzero(core != core[-1])
                cut = int(last[-1]) + 1 if len(last) else 0
                if long is not None:
                    same = int((core == long).sum())
                    if same:
                        yield part.slice(0, same), True
                    part, core = part.slice(same), core[same:]
                    cut = max(0, cut - same)
                    if len(core):
                        long = None
                if cut:
                    yield part.slice(0, cut), False
                held = part.slice(cut) if len(part) > cut else None
                if held is not None and len(held) > SPANS:
                    long = core[-1]
                    yield held, True
                    held = None
        if held is not None:
            yield held, False

    for part, long in whole():
        if long:
            none = pa.nulls(len(part), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("span"), none, none, pa.array(np.ones(len(part), np.int32)),
                 part.column("core"), part.column("bytes")],
                ["span", "low", "high", "long", "core", "bytes"],
            )
            continue
        key, row, start = windows(part)
        hit = texts.repeated(key)
        edge = np.append(True, row[1:] != row[:-1]) if len(row) else hit
        before = np.append(False, hit[:-1]) & ~edge
        after = np.append(hit[1:] & ~edge[1:], False)
        low, high = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)
        n = len(low)
        yield pa.RecordBatch.from_arrays([
            part.column("span").take(pa.array(row[low])), pa.array(start[low].astype(np.int32)),
            pa.array(start[high].astype(np.int32)), pa.array(np.zeros(n, np.int32)),
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
        ], ["span", "low", "high", "long", "core", "bytes"])


def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, span, low) of all windows of the spans of long cores."""
    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            key, row, start = windows(part)
            yield pa.RecordBatch.from_arrays(
                [signed(key), part.column("span").take(pa.array(row)), pa.array(start.astype(np.int32))],
                ["window", "span", "low"],
            )


def repeated_parts(spans: DataFrame) -> DataFrame:
    """(span, low, high): windows of distinct spans of mixed cores that other spans hold, too."""
    dealt = spans.repartition("core").sortWithinPartitions("core", "span")
    out = stored(dealt.mapInArrow(compared, PARTS), "compared")
    short = out.where("long = 0").select("span", "low", "high")
    long = out.where("long = 1").select("span", "core", "bytes")
    if long.isEmpty():
        return short
    each = long.mapInArrow(exploded, "window LONG, span LONG, low INT")
    twice = each.groupBy("window").count().where("count > 1").select(F.col("window").alias("w"))
    hits = each.join(twice, F.col("window") == F.col("w"))
    return short.union(hits.select("span", "low", F.col("low").alias("high")))


def removed(rows: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(k1, k2, parts) of the rows of ``keyed`` that lose bytes; parts are ranges [lo, hi)."""
    family = Family()
    for b in range(batches):
        family.add(rows.where(F.pmod(F.xxhash64("text"), F.lit(batches)) == b))
    cores = stored(family.repeated(), "cores")
    found = stored(found_runs(rows, bit_table(cores, "core")), "runs")
    # Distinct spans of repeated cores; of mixed ones, the least text is the one that sends the bytes.
    told = cores.where("mixed").select(F.col("core").alias("c"))
    held = found.groupBy("core", "span").agg(F.count("*").alias("n"), F.min("k1").alias("k1"))
    held = stored(held.join(told, F.col("core") == F.col("c"), "left").select(
        "span", "n", F.when(F.col("c").isNotNull(), F.col("span").bitwiseXOR(F.col("k1"))).alias("sender")
    ), "spans")
    senders = bit_table(held.where("sender is not null"), "sender")
    # A span that occurs twice repeats as a whole; others by their windows, each named once.
    whole = held.where("n > 1").select("span", F.lit(0), F.lit(0), F.lit(True))
    parts = repeated_parts(spans_of(rows, senders)).distinct().join(whole, "span", "left_anti")
    parts = parts.withColumn("whole", F.lit(False)).union(whole).withColumnRenamed("span", "s")
    low = F.when(F.col("whole"), F.col("first")).otherwise(F.col("first") + F.col("low"))
    high = F.when(F.col("whole"), F.col("last")).otherwise(F.col("first") + F.col("high"))
    lost = found.join(parts, F.col("span") == F.col("s")).select(
        "k1", "k2", low.cast("int").alias("lo"), (high + LONG).cast("int").alias("hi")
    )
    dealt = lost.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "lo")
    return dealt.mapInArrow(united, "k1 LONG, k2 LONG, parts ARRAY<INT>")


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (k1, k2, lo, hi) to one row of disjoint ranges (lo, hi, lo, hi, ...) per text."""
    held: list[np.ndarray] | None = None

    def rows(k1, k2, lo, hi) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        ends = np.append(first[1:], len(k1)).tolist()
        parts = [
            [x for g in joined(zip(lo[a:b].tolist(), hi[a:b].tolist())) for x in g]
            for a, b in zip(first.tolist(), ends)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[first]), pa.array(k2[first]), pa.array(parts, pa.list_(pa.int32()))],
            ["k1", "k2", "parts"],
        )

    for batch in batches:
        part = [np.asarray(batch.column(i)) for i in range(4)]
        if held is not None:
            part = [np.concatenate(x) for x in zip(held, part)]
        if not len(part[0]):
            continue
        k1, k2 = part[0], part[1]
        last = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield rows(*(x[:cut] for x in part))
        held = [x[cut:] for x in part]
    if held is not None:
        yield rows(*held)


def joined(parts) -> list[list[int]]:
    """Sorted maximal runs of the union of byte ranges."""
    out: list[list[int]] = []
    for lo, hi in sorted(parts):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return out


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            rows = []
            for text, parts in zip(part.column("text").to_pylist(), part.column("parts").to_pylist()):
                data = text.encode()
                gone = parts or []
                keep = [0, *gone, len(data)]
                left = b"".join(data[a:b] for a, b in zip(keep[::2], keep[1::2]))
                rows.append((len(data), len(data) - len(left), len(gone) // 2,
                             hashlib.sha256(left).hexdigest(), left))
            n, lost, spans, digest, left = zip(*rows)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, lost, spans)],
                pa.array(digest), pa.array(left, pa.binary()),
            ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes.

    Null texts count as empty ones; texts below LONG bytes lose nothing. Repeated rows are
    separate documents and so lose all but what is shorter than LONG. ``kept`` is binary, as a
    cut may lie inside a code point. Only doc_id and text are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs)
    gone = removed(rows, batches).select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), "parts")
    same = (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2"))
    return rows.join(gone, same, "left").select("doc_id", "text", "parts").mapInArrow(
        digested,
        f"doc_id {kind}, n_bytes LONG, n_removed LONG, n_spans LONG, kept_sha256 STRING, kept BINARY",
    )
