"""Vector codes: product quantisation in integers, nearest entries found by a GNAT over each codebook.

Vectors are cut into equal consecutive parts and each part has a codebook. Training is
Lloyd's: every round is one job in which tasks assign their vectors and emit integer sums per (part,
entry, position), which Spark adds up; the driver gets one codebook's worth of sums whatever
the number of vectors.

The nearest entry is searched in a geometric near-neighbour access tree. A node holds split points;
every other entry belongs to the split point it is nearest to, and for each split point and
each child the node stores the least and greatest distance from the one to the entries of the other.
A query at distance d from a split point, with its best entry at distance r, can skip a child
whose range lies strictly outside [d - r, d + r]. Distances for that test are rounded outwards, so rounding never
skips an entry that is as near as the best; among those left, exact integer squares decide and equal
ones go to the lower index. Many queries walk the tree together; each node works on those that
haven't skipped it.

Rows whose vector is null, or holds a null or a component that isn't finite, are dropped. Rows whose vector
has another length than most (the shorter length of equally many), or a length that ``parts`` doesn't divide, take no part in
training and keep a null code and error. Repeated rows count each. Null ids come
last in the order of the first entries, equal ids in the byte order of their vectors. With fewer rows
than ``entries`` the codebooks have as many entries as rows. An empty table gives no rows. Components so
large that squared distances could leave 64 bits (46,340 either way for vectors of 64) fail the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.shared import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Split points of a node.
DEGREE = 4
#: Vectors worked on at a time.
BLOCK = 8192
#: Distinct labels whose sums are sent to all tasks; with more they are joined by a shuffle.
FEW_LABELS = 10_000
#: Widens a computed distance by more than its rounding error.
WIDER = 1 + 2.0 ** -50


# -- tree ------------------------------------------------------------------------------------


class Node(NamedTuple):
    """Split points (entry numbers), children by split point, and child ranges from each split point."""

    split: np.ndarray
    children: list[Node | None]
    low: np.ndarray
    high: np.ndarray


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to one row ``b``, or row by row."""
    diff = a - b
    return np.einsum("ij,ij->i", diff, diff)


def tree(entries: np.ndarray, of: np.ndarray | None = None, degree: int = DEGREE) -> Node:
    """The tree over entries (int64 rows); split points are picked far from each other."""
    of = np.arange(len(entries)) if of is None else of
    picked = [0]
    near = squares(entries[of], entries[of[0]])
    owner = np.zeros(len(of), int)
    while len(picked) < min(degree, len(of)):
        far = near.copy()
        far[picked] = -1
        new = int(np.argmax(far))
        dist = squares(entries[of], entries[of[new]])
        owner[dist < near] = len(picked)
        near = np.minimum(near, dist)
        picked.append(new)
    split = of[picked]
    m = len(split)
    low, high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    children: list[Node | None] = []
    rest = np.ones(len(of), bool)
    rest[picked] = False
    for j in range(m):
        mine = of[rest & (owner == j)]
        children.append(tree(entries, mine, degree) if len(mine) else None)
        for i in range(m):
            if len(mine):
                dist = np.sqrt(squares(entries[mine], entries[split[i]]).astype(float))
                low[i, j], high[i, j] = dist.min() / WIDER, dist.max() * WIDER
    return Node(split, children, low, high)


class Best:
    """Nearest entry so far of each query, and how many distances were computed."""

    def __init__(self, n: int):
        self.square = np.full(n, np.iinfo(np.int64).max)
        self.entry = np.zeros(n, np.int64)
        self.computed = 0

    def meet(self, which: np.ndarray, entry: int, square: np.ndarray) -> None:
        """Offer an entry; a smaller square wins, an equal one with a lower index too."""
        self.computed += len(which)
        best, of = self.square[which], self.entry[which]
        better = (square < best) | ((square == best) & (entry < of))
        at = which[better]
        self.square[at], self.entry[at] = square[better], entry


def _descend(node: Node, queries: np.ndarray, entries: np.ndarray, which: np.ndarray, best: Best):
    far = np.empty((len(node.split), len(which)))
    for i, entry in enumerate(node.split):
        square = squares(queries[which], entries[entry])
        best.meet(which, int(entry), square)
        far[i] = np.sqrt(square.astype(float))
    for j, child in enumerate(node.children):
        if child is None:
            continue
        # From below: no entry of the child is nearer than this, whatever the rounding.
        gap = np.maximum(
            far / WIDER - node.high[:, j, None], node.low[:, j, None] - far * WIDER
        ).max(0) / WIDER
        radius = np.sqrt(best.square[which].astype(float)) * WIDER
        stay = ~(gap > radius)
        if stay.any():
            _descend(child, queries, entries, which[stay], best)


def nearest(node: Node, entries: np.ndarray, queries: np.ndarray) -> Best:
    """Nearest entry of each query, and its exact squared distance."""
    best = Best(len(queries))
    if len(queries):
        _descend(node, queries, entries, np.arange(len(queries)), best)
    return best


# -- vectors ---------------------------------------------------------------------------------


def kept(rows: DataFrame, vector: str) -> DataFrame:
    """Stored (row, width, ints): rows with a usable vector as little-endian int32, floor(4096 x).

    ``rows`` has one struct column ``row``.
    """
    shape = rows.select("row", F.lit(0).alias("width"), F.lit(b"").alias("ints")).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = np.asarray(lists.offsets).astype(np.int64)
            values = lists.values
            x = np.array(values.fill_null(np.nan), np.float64)
            sums = np.append(0, np.cumsum(~np.isfinite(x)))
            good = sums[offsets[1:]] == sums[offsets[:-1]]
            good &= ~np.asarray(lists.is_null())
            at = np.flatnonzero(good)
            x[~np.isfinite(x)] = 0
            x = np.floor(x * SCALE)
            width = offsets[1:] - offsets[:-1]
            inside = np.repeat(good, width)
            used = x[offsets[0]:offsets[-1]][inside]
            if len(used) and 4 * np.abs(used).max() ** 2 * width[at].max() >= 2.0 ** 63:
                raise ValueError("a vector component is too large for 64-bit squares")
            x[offsets[0]:offsets[-1]][~inside] = 0
            ints = x.astype("<i4")
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)), pa.array(width[at], pa.int32()),
                pa.array([ints[offsets[i]:offsets[i + 1]].tobytes() for i in at], pa.binary()),
            ], ["row", "width", "ints"])

    values = F.col(f"row.{vector}").cast("array<double>")
    return stored(rows.select("row", values.alias("vector")).mapInArrow(whole, shape), "vectors")


def blocks(batch: pa.RecordBatch, parts: int, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of a batch and their vectors as int64 [rows, parts, positions]."""
    ints = batch.column(batch.schema.get_field_index("ints"))
    for at in range(0, len(batch), BLOCK):
        data = b"".join(ints.slice(at, BLOCK).to_pylist())
        yield slice(at, min(at + BLOCK, len(batch))), np.frombuffer(data, "<i4").reshape(
            -1, parts, width // parts
        ).astype(np.int64)


class Index:
    """The trees of all codebooks [parts, entries, positions]."""

    def __init__(self, books: np.ndarray):
        self.books, self.trees = books, [tree(b) for b in books]

    def assigned(self, vectors: np.ndarray) -> list[Best]:
        """The nearest entries of each part."""
        each = enumerate(zip(self.trees, self.books))
        return [nearest(t, b, vectors[:, p]) for p, (t, b) in each]


def sums(rows: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """(part, entry, position, total, n): what is nearest to each entry, summed per task and then in all."""
    parts, entries, positions = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(books.shape, np.int64)
        n = np.zeros(books.shape[:2], np.int64)
        index = Index(books)
        for batch in batches:
            for _, vectors in blocks(batch, parts, width):
                for p, best in enumerate(index.assigned(vectors)):
                    order = np.argsort(best.entry, kind="stable")
                    met, first = np.unique(best.entry[order], return_index=True)
                    total[p, met] += np.add.reduceat(vectors[order, p], first)
                    n[p] += np.bincount(best.entry, minlength=entries)
        part, entry, position = (x.ravel() for x in np.indices(books.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (part, entry, position, total.ravel(), np.repeat(n, positions))],
            ["part", "entry", "position", "total", "n"],
        )

    each = rows.select("ints").mapInArrow(
        add, "part LONG, entry LONG, position LONG, total LONG, n LONG"
    )
    return each.groupBy("part", "entry", "position").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
    )


def moved(rows: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Entries replaced by the floor of their parts' mean; unused ones stay."""
    out = books.copy()
    for r in sums(rows, books, width).collect():
        if r["n"]:
            out[r["part"], r["entry"], r["position"]] = int(r["total"]) // int(r["n"])
    return out


def common_width(rows: DataFrame, parts: int) -> int:
    """The length of most vectors among those that ``parts`` divides; 0 if there is none."""
    widths = rows.where((F.col("width") > 0) & (F.col("width") % parts == 0))
    top = widths.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    return top["width"] if top else 0


def train(
    rows: DataFrame, width: int, identity: str, parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """Codebooks [parts, entries, positions] of rows (row, ints) of one width."""
    key = F.col(f"row.{identity}")
    first = rows.orderBy(key.asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    data = b"".join(r["ints"] for r in first)
    books = np.frombuffer(data, "<i4").reshape(len(first), parts, width // parts)
    books = books.transpose(1, 0, 2).astype(np.int64)
    for _ in range(rounds if len(first) else 0):
        books = moved(rows, books, width)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(rows: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """(row, code, error) of rows (row, width, ints); null where the width is another."""
    shape = rows.select("row", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    for name in ("code", "error"):
        shape[name].nullable = True
    parts = len(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(books)
        for batch in batches:
            for at, vectors in blocks(batch, parts, width):
                best = index.assigned(vectors)
                hexes = np.stack([b.entry for b in best], 1).astype(np.uint8)
                error = np.sum([b.square for b in best], axis=0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at.start, at.stop - at.start),
                    pa.array([h.tobytes().hex() for h in hexes], pa.string()), pa.array(error),
                ], ["row", "code", "error"])

    fits = F.col("width") == width
    known = rows.where(fits).select("row", "ints").mapInArrow(code, shape)
    rest = rows.where(~fits).select(
        "row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    return known.unionByName(rest) if books.size else rest


def compress(
    vectors: DataFrame, identity: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(row, code, error) of every usable row, and the codebooks.

    ``row`` is the whole input row, so no name clashes. A code has two hex digits for each part, so
    ``entries`` is at most 256.
    """
    if not 1 <= entries <= 256:
        raise ValueError("between 1 and 256 entries")
    rows = kept(vectors.select(F.struct("*").alias("row")), vector)
    width = common_width(rows, parts)
    usable = rows.where(F.col("width") == width) if width else rows.limit(0)
    books = train(usable, width or parts, identity, parts, entries, rounds)
    return coded(rows, books, width or parts), books


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row."""
    rows, books = compress(vectors.select("vec_id", "embedding", "label"))
    rows = stored(rows.select("row.vec_id", "row.label", "code", "error"), "codes")
    totals = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    totals = totals.withColumnRenamed("label", "of")
    if totals.count() <= FEW_LABELS:
        totals = F.broadcast(totals)
    # Many rows to one sum, so that a hot label's rows can be split.
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
