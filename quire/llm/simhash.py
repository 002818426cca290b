"""SimHash near-duplicates over a byte-position inverted index with count filtering.

Fingerprints have eight positional bytes. Two that differ in at most four bits share at least
four of them, so four is the guaranteed minimum of the tally of shared positional bytes. A list
for one positional byte would hold a 256th of the corpus; the lists here are therefore keyed by
every set of four positions with their bytes. Whoever meets in such a list has reached the minimum,
nobody else is tallied, and what meets is verified by its differing bits.

Lists hold distinct fingerprints. Within a list, links are found by a walk that emits one link
per reached fingerprint, never all pairs. A list beyond LIST members is not worked on: its members
are dealt anew by more bits (of the bits left open, cut in five parts, two linked fingerprints
share one part), until all lists are short or all bits are fixed.

``representatives`` removes near-duplicates of texts: five-word shingles that are alike by 0.8. So far
apart, fingerprints differ in about ten bits, and no number of shared bytes is certain for one of them. A text
therefore has WIDE fingerprints, and the guaranteed minimum is MINIMUM positional bytes of one of them. The lists are
again keyed by every set of so many positions with their bytes: whoever meets has reached the minimum and is verified,
first by its differing bits in one more fingerprint, then on the texts' shingles. Where a list has many such pairs, as
near copies have, only the nearest links of a minimum spanning forest are verified at first. All its pairs between groups
are then compared in the list's task, and the nearest verified, more from round to round, until none is left. No pair
is verified that parities of the texts' shingles rule out; no pair alike fails those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from quire.llm import texts
from quire.llm.shared import components, stored

SHINGLE = 4
BITS = 4
SEED = 42
LIST = 4096


def fingerprint(text: bytes) -> int:
    """Majority bits of the hashes of a lower-cased text's shingles; 0 without words."""
    words = text.split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += 1 + len(w)
        ends.append(at)
    ends_of = ends[SHINGLE - 1:] or ends[-1:]
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends_of)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: str) -> Column:
    """Fingerprints of a text column as signed longs."""
    @F.arrow_udf(LongType())
    def prints(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # bytes.split() splits at the same six white-space bytes as the words' definition, and
        # bytes.lower() changes A-Z only.
        for part in column:
            out = []
            for piece in range(0, len(part), 256):
                data = part.slice(piece, 256).cast(pa.large_binary()).to_pylist()
                out += [fingerprint((t or b"").lower()) for t in data]
            yield pa.array(out, pa.int64())

    return prints(text)


MASKS = [
    sum(0xFF << (8 * p) for p in four) for four in combinations(range(8), BITS)
]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def finer(mask: int) -> list[int]:
    """The mask with each of five parts of its open bits added."""
    left = [b for b in range(64) if not mask >> b & 1]
    parts = [left[len(left) * i // 5: len(left) * (i + 1) // 5] for i in range(5)]
    return [mask | sum(1 << b for b in part) for part in parts if part]


def walk(members: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that join what is reachable within ``BITS`` in a list, one for each but the first."""
    a, b = [], []
    left = members
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            head, front = front[0], front[1:]
            near = np.bitwise_count(left ^ head) <= BITS
            if near.any():
                met, left = left[near], left[~near]
                a.append(np.full(len(met), head))
                b.append(met)
                front = np.append(front, met)
    return a, b


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mask, part, fp) in the order of lists to links, or to rows of lists too long."""
    def lists() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of whole lists; a longer list comes in pieces beyond LIST."""
        held = None
        for batch in batches:
            part = [np.asarray(batch.column(i)) for i in range(3)]
            part[2] = part[2].astype(np.int64)
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            if not len(part[0]):
                continue
            mask, value, _ = part
            last = np.flatnonzero((mask != mask[-1]) | (value != value[-1]))
            cut = last[-1] + 1 if len(last) else 0
            yield tuple(x[:cut] for x in part)
            held = [x[cut:] for x in part]
        if held is not None:
            yield tuple(held)

    for mask, value, fp in lists():
        if not len(fp):
            continue
        first = np.flatnonzero(
            np.append(True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
        )
        size = np.diff(np.append(first, len(fp)))
        u = fp.view(np.uint64)
        pair = first[size == 2]
        near = pair[np.bitwise_count(u[pair] ^ u[pair + 1]) <= BITS]
        a, b, long = [u[near]], [u[near + 1]], []
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            if n > LIST and mask[at] != -1:
                long.append(np.arange(at, at + n))
                continue
            x, y = walk(u[at: at + n])
            a += x
            b += y
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        rest = np.concatenate(long) if long else np.zeros(0, np.int64)
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(np.minimum(a, b)), pa.nulls(len(rest), pa.int64())]),
            pa.concat_arrays([pa.array(np.maximum(a, b)), pa.nulls(len(rest), pa.int64())]),
            pa.concat_arrays([none, pa.array(mask[rest])]),
            pa.concat_arrays([none, pa.array(fp[rest])]),
        ], ["a", "b", "mask", "fp"])


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (fp) within ``BITS`` of each other."""
    masks = F.array(*[F.lit(signed(m)) for m in MASKS])
    rows = fps.select("fp", F.explode(masks).alias("mask"))
    found = None
    while True:
        keyed = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp")
        out = stored(
            keyed.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp")
            .mapInArrow(_linked, "a LONG, b LONG, mask LONG, fp LONG"), "links",
        )
        part = out.where("a is not null").select("a", "b")
        found = part if found is None else found.union(part)
        long = out.where("mask is not null")
        masks_left = [r[0] for r in long.select("mask").distinct().collect()]
        if not masks_left:
            return found
        # The number of masks depends on the number of rounds alone, not on the rows.
        pairs = [(m, signed(f)) for m in masks_left for f in finer(m & (1 << 64) - 1)]
        next_masks = F.broadcast(fps.sparkSession.createDataFrame(pairs, "old LONG, mask LONG"))
        rows = long.select(F.col("mask").alias("old"), "fp").join(next_masks, "old").select(
            "mask", "fp"
        ).distinct()


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, fp) of every row."""
    return stored(docs.select("doc_id", fingerprints("text").alias("fp")), "fingerprints")


def groups(printed: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint: the smallest doc_id of its component.

    Components that have the same id, or none, still differ by ``root``. Null ids never name a component unless it has no other; then its id is null.
    """
    fps = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "fps")
    roots = components(links(fps.select("fp")), "simhash")
    named = fps.join(roots, F.col("fp") == F.col("v"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy(F.col("root").alias("head")).agg(F.min("first").alias("component_id"))
    return named.join(least, F.col("root") == F.col("head")).select("fp", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts have fingerprint 0 and link like others. Repeated rows are
    reported each. Only doc_id and text are read.
    """
    printed = fingerprinted(docs)
    found = groups(printed).withColumnRenamed("fp", "key")
    return printed.join(found, F.col("fp") == F.col("key")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Near-duplicate texts: words of a shingle, and the Jaccard similarity of their sets of shingles.
WORDS = 5
ALIKE = 0.8
#: Fingerprints, and positional bytes that a candidate shares in one of them: at ALIKE, one pair in 90 does not.
WIDE = 4
MINIMUM = 2
SETS = [[8 * k + p for p in some] for k in range(WIDE) for some in combinations(range(8), MINIMUM)]
#: Differing bits of what is worth verifying: at ALIKE 10 are expected, with a deviation of 3.
RADIUS = 17
SHORT = 512
#: Candidates for each member that a list gives at once.
LINKS = 4
#: Links of a group verified in the first round, and their growth from round to round.
FIRST, MORE = 1, 8
#: Pairs and words of parities that a task compares at once.
PAIRS, CELLS = 1 << 16, 1 << 21


def shingled(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of lower-cased words, and the bounds of each text's.

    A text of fewer words has one shingle, a text without words none.
    """
    lo, hi, at = chunk.words()
    words = texts.ranged(texts.prefix(texts.BYTE[texts.LOWER[chunk.data]]), lo, hi)
    n = np.diff(at)
    bounds = np.append(0, np.cumsum(np.where(n > 0, np.maximum(n - WORDS + 1, 1), 0)))
    of = np.repeat(np.arange(len(n)), np.diff(bounds))
    first = at[of] + np.arange(len(of)) - bounds[of]
    last = np.minimum(first + WORDS, at[of + 1])
    return texts.ranged(texts.prefix(words), first, last), bounds


def majorities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """1 + WIDE fingerprints of each text, by as many hashes of its shingles."""
    ones = np.zeros((len(bounds) - 1, 64 * (1 + WIDE)), np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at: at + (1 << 14)]
        all_hashes = np.stack([texts.mix(part + np.uint64(k)) for k in range(1 + WIDE)], axis=1)
        bits = np.unpackbits(all_hashes.view(np.uint8), axis=1, bitorder="little")
        # Sums of at most 255 bits fit a byte.
        inner = bounds[(bounds > at) & (bounds < at + len(part))] - at
        cuts = np.union1d(np.arange(0, len(part), 255), inner)
        sums = np.add.reduceat(bits, cuts, axis=0, dtype=np.uint8).astype(np.int64)
        of = np.searchsorted(bounds, at + cuts, "right") - 1
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        ones[of[first]] += np.add.reduceat(sums, first, axis=0)
    over = 2 * ones > np.diff(bounds)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64)


def _arrays(rows: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(rows.view(np.int64))).cast(
        pa.list_(pa.int64())
    )


def sketches(text: str) -> Column:
    """Arrays of a key of the text's shingles with their counts, and its 1 + WIDE fingerprints."""
    @F.arrow_udf(ArrayType(LongType()))
    def sketched(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            out = [np.zeros((0, 2 + WIDE), np.uint64)]
            for chunk in texts.chunks(part):
                hashes, bounds = shingled(chunk)
                sums = np.append(np.uint64(0), np.cumsum(texts.mix(~hashes), dtype=np.uint64))
                key = texts.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))
                out.append(np.column_stack([key, majorities(hashes, bounds)]))
            rows = np.concatenate(out)
            yield _arrays(rows.ravel(), np.arange(len(rows) + 1) * (2 + WIDE))

    return sketched(text)


def shingle_sets(text: str) -> Column:
    """Arrays of the distinct shingles of a text column."""
    @F.arrow_udf(ArrayType(LongType()))
    def sets(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            out = [np.zeros(0, np.uint64)]
            for chunk in texts.chunks(part):
                hashes, bounds = shingled(chunk)
                out += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield _arrays(np.concatenate(out), np.cumsum([len(x) for x in out]))

    return sets(text)


def parities(text: str) -> Column:
    """Arrays of the number of distinct shingles of a text, and the parities of how many are in each of 64 * 2^k
    buckets, as many buckets as shingles at least.

    A shingle that only one of two texts has changes one parity, so their parities differ in no more places than their
    sets in shingles. Twice as many buckets fold into half by exclusive or.
    """
    @F.arrow_udf(ArrayType(LongType()))
    def marked(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            out = [np.zeros(0, np.uint64)]
            for chunk in texts.chunks(part):
                hashes, bounds = shingled(chunk)
                for a, b in zip(bounds[:-1], bounds[1:]):
                    own = np.unique(hashes[a:b])
                    size = 64 << (max(len(own) - 1, 0) >> 6).bit_length()
                    odd = np.bincount((texts.mix(own) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
                    packed = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)
                    out.append(np.append(np.uint64(len(own)), packed))
            yield _arrays(np.concatenate(out), np.cumsum([len(x) for x in out]))

    return marked(text)


def possible(marks: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of places a, b in ``marks`` (``parities``): differing parities of each pair, -1 where they or the
    sizes rule out that the texts are alike."""
    n = np.array([m[0] for m in marks], np.int64)
    words = np.array([len(m) - 1 for m in marks])
    levels = {}
    for level in np.unique(words).tolist():
        # Texts of the next larger size are folded; those of other sizes are never alike.
        own = np.flatnonzero((words == level) | (words == 2 * level))
        place = np.zeros(len(marks), np.int64)
        place[own] = np.arange(len(own))
        levels[level] = place, np.array([
            m[1:] if len(m) - 1 == level else m[1: level + 1] ^ m[level + 1:] for m in marks[own]
        ], np.int64).view(np.uint64)

    def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        sizes = np.minimum(n[a], n[b]) >= ALIKE * np.maximum(n[a], n[b]) - 1e-6
        least = np.minimum(words[a], words[b])
        for level, (place, rows) in levels.items():
            k = np.flatnonzero(sizes & (least == level))
            step = max(1, CELLS // level)
            for some in (k[at: at + step] for at in range(0, len(k), step)):
                x, y = a[some], b[some]
                odd = np.bitwise_count(rows[place[x]] ^ rows[place[y]]).sum(1, dtype=np.int64)
                out[some] = np.where(odd <= (1 - ALIKE) / (1 + ALIKE) * (n[x] + n[y]) + 1e-6, odd, -1)
        return out

    return differ


def spanning(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (two places) of a minimum spanning forest of fingerprints within RADIUS."""
    near = np.bitwise_count(f ^ f[0]).astype(np.int64)
    to, left, out = np.zeros(len(f), np.int64), np.arange(1, len(f)), []
    near = near[1:]
    to = to[1:]
    while len(left):
        k = int(np.argmin(near))
        place = left[k]
        if near[k] <= RADIUS:
            out.append((to[k], place))
        left, near, to = np.delete(left, k), np.delete(near, k), np.delete(to, k)
        gap = np.bitwise_count(f[left] ^ f[place])
        to[gap < near] = place
        near = np.minimum(near, gap)
    return tuple(np.array(out, np.int64).reshape(-1, 2).T)


def covering(f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links from leaders to all others within RADIUS of them, and the leaders' places."""
    a, b, leaders, left = [], [], [], np.arange(len(f))
    while len(left):
        head = left[0]
        near = np.bitwise_count(f[left] ^ f[head]) <= RADIUS
        met = left[near][1:]
        a.append(np.full(len(met), head))
        b.append(met)
        leaders.append(head)
        left = left[~near]
    return np.concatenate(a), np.concatenate(b), np.array(leaders)


def _short(size: np.ndarray, first: np.ndarray, f: np.ndarray) -> tuple[list, list, np.ndarray]:
    """Candidates in the lists of at most SHORT members, all compared offset by offset, and the places of
    the lists with so many that only a spanning forest is given."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    of = np.repeat(np.arange(len(size)), size)
    i = np.flatnonzero((size <= SHORT)[of])
    for offset in range(1, SHORT):
        i = i[i + offset < len(f)]
        i = i[of[i + offset] == of[i]]
        if not len(i):
            break
        met = i[np.bitwise_count(f[i] ^ f[i + offset]) <= RADIUS]
        a.append(met)
        b.append(met + offset)
    a, b = np.concatenate(a), np.concatenate(b)
    many = np.bincount(of[a], minlength=len(size)) > LINKS * size
    given = ~many[of[a]]
    out_a, out_b, many = [a[given]], [b[given]], np.flatnonzero(many)
    for k in many:
        x, y = spanning(f[first[k]: first[k] + size[k]])
        out_a.append(first[k] + x)
        out_b.append(first[k] + y)
    return out_a, out_b, many


def _whole(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[list[np.ndarray]]:
    """Rows of n columns in the order of the first, cut only where it changes."""
    held = [np.zeros(0, np.int64) for _ in range(n)]
    for batch in batches:
        held = [np.concatenate([x, np.asarray(batch.column(i))]) for i, x in enumerate(held)]
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if cut:
            yield [x[:cut] for x in held]
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield held


def _pairs(v: np.ndarray, f: np.ndarray, a: list, b: list) -> list[pa.Array]:
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
    x, y = v[a], v[b]
    return [
        pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)),
        pa.array(np.bitwise_count(f[a] ^ f[b]).astype(np.int32)),
    ]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b, bits, sure) in rows (list, v, f) in the order of lists, and the rows of lists with more.

    Those of lists with more are not sure: they need not be tested, as all pairs of these rows are. A list beyond LIST
    gives links to leaders.
    """
    for key, v, f in _whole(batches, 3):
        f = f.view(np.uint64)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        a, b, many = _short(size, first, f)
        more = [np.arange(first[k], first[k] + size[k]) for k in many]
        sure = len(a[0])
        for k in np.flatnonzero(size > SHORT):
            mine = f[first[k]: first[k] + size[k]]
            x, y = spanning(mine) if size[k] <= LIST else covering(mine)[:2]
            a.append(first[k] + x)
            b.append(first[k] + y)
            if len(x):
                more.append(np.arange(first[k], first[k] + size[k]))
        found, more = _pairs(v, f, a, b), np.concatenate([np.zeros(0, np.int64), *more])
        found.append(pa.array(np.arange(len(found[0])) < sure))
        rows = [pa.array(key[more]), pa.array(v[more]), pa.array(f.view(np.int64)[more])]
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([x, pa.nulls(len(more), x.type)]) for x in found]
            + [pa.concat_arrays([pa.nulls(len(found[0]), x.type), x]) for x in rows],
            ["a", "b", "bits", "sure", "list", "v", "f"],
        )


def _between(f: np.ndarray, root: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within RADIUS in different groups of a list in the order of groups, some at once."""
    runs = np.append(np.flatnonzero(np.append(True, root[1:] != root[:-1])), len(f))
    a, b, n = [], [], 0
    for start, end in zip(runs[:-2].tolist(), runs[1:-1].tolist()):
        left, right = f[start:end], f[end:]
        # One vector operation for each member of the smaller side.
        for k in range(min(len(left), len(right))):
            if len(left) <= len(right):
                met = end + np.flatnonzero(np.bitwise_count(right ^ left[k]) <= RADIUS)
                one = np.full(len(met), start + k)
            else:
                met = start + np.flatnonzero(np.bitwise_count(left ^ right[k]) <= RADIUS)
                one = np.full(len(met), end + k)
            a.append(one)
            b.append(met)
            n += len(met)
            if n > PAIRS:
                yield np.concatenate(a), np.concatenate(b)
                a, b, n = [], [], 0
    if n:
        yield np.concatenate(a), np.concatenate(b)


def nearest(root: np.ndarray, a: np.ndarray, b: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """The pairs that are among the ``most`` nearest of one of their two groups."""
    side = np.concatenate([root[a], root[b]])
    order = np.lexsort((np.tile(b, 2), np.tile(a, 2), np.tile(far, 2), side))
    first = np.flatnonzero(np.append(True, side[order][1:] != side[order][:-1]))
    nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return np.unique(order[nth < most] % max(len(a), 1))


def _across(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (list, root, v, f, marks) in this order the pairs (a, b) of different groups that may be alike, the
    ``most`` nearest of each group of a list, and (list) where there are more."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, roots, vs, fs, marks in _whole(batches, 5):
            edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            for lo, hi in zip(edges, np.append(edges[1:], len(keys))):
                v, f, root = vs[lo:hi], fs[lo:hi].view(np.uint64), roots[lo:hi]
                differ, limit, cut = possible(marks[lo:hi]), PAIRS, False
                kept = np.zeros((3, 0), np.int64)
                for a, b in _between(f, root):
                    met = np.stack([a, b, differ(a, b)])
                    kept = np.concatenate([kept, met[:, met[2] >= 0]], axis=1)
                    if kept.shape[1] > limit:
                        n, kept = kept.shape[1], kept[:, nearest(root, *kept, most)]
                        limit, cut = max(PAIRS, 2 * kept.shape[1]), cut or kept.shape[1] < n
                n, kept = kept.shape[1], kept[:, nearest(root, *kept, most)]
                cut = cut or kept.shape[1] < n
                x, y, more = v[kept[0]], v[kept[1]], [int(keys[lo])] * cut
                if len(x):
                    none = pa.nulls(len(more), pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        pa.concat_arrays([pa.array(np.minimum(x, y)), none]),
                        pa.concat_arrays([pa.array(np.maximum(x, y)), none]),
                        pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(more, pa.int64())]),
                    ], ["a", "b", "list"])

    return found


def postings(heads: DataFrame) -> DataFrame:
    """(list, v, f) of every row (v, sketch): its place in the list of each set of positional bytes."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column("v"))
            sketch = np.asarray(batch.column("sketch").flatten()).reshape(-1, 2 + WIDE)
            for at in range(0, len(v), 512):
                part = np.ascontiguousarray(sketch[at: at + 512])
                places = np.ascontiguousarray(part[:, 2:]).view(np.uint8).astype(np.int64)
                keys = []
                for t, some in enumerate(SETS):
                    key = np.full(len(part), t, np.int64)
                    for p in some:
                        key = key << 8 | places[:, p]
                    keys.append(key)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys)), pa.array(np.tile(v[at: at + 512], len(SETS))),
                    pa.array(np.tile(part[:, 1], len(SETS))),
                ], ["list", "v", "f"])

    return heads.select("v", "sketch").mapInArrow(keyed, "list LONG, v LONG, f LONG")


def meetings(heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored candidates (a, b, bits) of the rows (v, sketch) of ``heads``, and the postings (list, v, f) of all
    lists with more of them. Of the candidates in the latter, only the nearest of each text are given."""
    met = stored(postings(heads).repartition("list").sortWithinPartitions("list", "v").mapInArrow(
        _met, "a LONG, b LONG, bits INT, sure BOOLEAN, list LONG, v LONG, f LONG"
    ), "meetings")
    pairs = met.where("a is not null")
    found = pairs.where("sure").select("a", "b", "bits")
    for end in ("a", "b"):
        best = pairs.where("not sure").groupBy(end).agg(F.min(F.struct("bits", "a", "b")).alias("best"))
        found = found.union(best.select("best.a", "best.b", "best.bits"))
    return stored(found.distinct(), "first"), met.where("list is not null").select("list", "v", "f")


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, bits, of_a, of_b) whose marks do not rule out that they are alike."""
    for batch in batches:
        for at in range(0, len(batch), 1024):
            part = batch.slice(at, 1024)
            n = len(part)
            differ = possible(np.concatenate([np.asarray(part.column("of_a")), np.asarray(part.column("of_b"))]))
            keep = pa.array(differ(np.arange(n), np.arange(n, 2 * n)) >= 0)
            yield part.select(["a", "b", "bits"]).filter(keep)


def plausible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Stored pairs (a, b, bits) that ``marks`` (v, marks) do not rule out."""
    one = marks.select(F.col("v").alias("a"), F.col("marks").alias("of_a"))
    two = marks.select(F.col("v").alias("b"), F.col("marks").alias("of_b"))
    return stored(
        pairs.join(one, "a").join(two, "b").select("a", "b", "bits", "of_a", "of_b")
        .mapInArrow(_plausible, "a LONG, b LONG, bits INT"), "plausible",
    )


def untested(crowded: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """Stored candidates (a, b) of the rows (list, v, f, marks) of ``crowded`` lists that are in different groups and
    that the marks do not rule out, the ``most`` nearest of each group of a list, and rows (list) for each list that
    has more."""
    of = roots.select(F.col("v").alias("member"), "root")
    rows = crowded.join(of, F.col("v") == F.col("member"), "left").select(
        "list", F.coalesce("root", "v").alias("root"), "v", "f", "marks"
    )
    found = rows.repartition("list").sortWithinPartitions("list", "root", "v").mapInArrow(
        _across(most), "a LONG, b LONG, list LONG"
    )
    return stored(found.distinct(), "across")


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored pairs (a, b) whose sets (v, shingles) are alike."""
    one = sets.select(F.col("v").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("v").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    same = both >= ALIKE * (F.size("of_a") + F.size("of_b") - both) - 1e-9
    return stored(pairs.join(one, "a").join(two, "b").where(same).select("a", "b"), "alike")


def verified(met: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, root) of everything that links of ``met`` connect whose sets (v, shingles) are alike, and these links.

    A round verifies the nearest links of every group found so far, each round more of them; links
    within a group need none. Ends when no link between groups is left untested.
    """
    left = met.select("a", "b", "bits", F.col("a").alias("x"), F.col("b").alias("y"))
    found, roots, most = None, None, FIRST
    while True:
        nearest = Window.partitionBy("root").orderBy("bits", "a", "b")
        sides = left.select("a", "b", "bits", F.explode(F.array("x", "y")).alias("root"))
        picked = stored(
            sides.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= most)
            .select("a", "b").distinct(), "picked",
        )
        if found is not None and picked.isEmpty():
            return roots, found
        links = alike(picked, sets)
        found = links if found is None else found.union(links)
        roots = components(found, "near")
        of_a = roots.select(F.col("v").alias("a"), F.col("root").alias("root_a"))
        of_b = roots.select(F.col("v").alias("b"), F.col("root").alias("root_b"))
        left = stored(
            left.join(picked, ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
            .select("a", "b", "bits", F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y"))
            .where("x <> y"), "untested",
        )
        most *= MORE


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, the one with its smallest id, with all its columns.

    Groups are what links connect between texts whose sets of five-word shingles have a Jaccard
    similarity of at least 0.8; every link is verified on the texts. Texts with the same shingles are always linked,
    others if they share MINIMUM positional bytes of a fingerprint and differ in at most RADIUS bits. Texts without words are
    one group. Of several rows with the smallest id one stays; rows with a null id stay only if their group has
    no other, and then one of them does. Ids never join or part groups.
    """
    marked = stored(docs.select(
        F.struct("*").alias("row"), "doc_id", F.monotonically_increasing_id().alias("key"),
        sketches("text").alias("sketch"),
    ), "sketched")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    heads = stored(
        marked.groupBy(F.col("sketch")[0].alias("v")).agg(
            F.min(rank).alias("best"), F.first("sketch").alias("sketch")
        ), "heads",
    )
    met, crowded = meetings(heads)

    def read(ends: DataFrame, made: Column, name: str) -> DataFrame:
        wanted = heads.join(ends.distinct(), "v", "left_semi").select("v", F.col("best.key").alias("of"))
        texts_of = marked.select("key", F.col("row.text").alias("text")).join(wanted, F.col("key") == F.col("of"))
        return stored(texts_of.select("v", made.alias(name)), name)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v")))

    def sets_of(pairs: DataFrame) -> DataFrame:
        return read(ends(pairs), shingle_sets("text"), "shingles")

    marks = read(ends(met).union(crowded.select("v")), parities("text"), "marks")
    met = plausible(met, marks)
    roots, links = verified(met, sets_of(met))
    crowded, most = stored(crowded.join(marks, "v"), "crowded"), MORE ** 2
    while not crowded.isEmpty():
        across = untested(crowded, roots, most)
        left, more = across.where("a is not null").select("a", "b"), across.where("list is not null").select("list")
        if left.isEmpty():
            break
        links = links.union(alike(left, sets_of(left)))
        roots = components(links, "all")
        # Pairs that are not alike come again, hence more of them.
        crowded, most = stored(crowded.join(more, "list", "left_semi"), "crowded"), most * MORE
    roots = roots.select(F.col("v").alias("member"), "root")
    kept = heads.join(roots, F.col("v") == F.col("member"), "left").groupBy(
        F.coalesce("root", "v").alias("group")
    ).agg(F.min("best").alias("best")).select(F.col("best.key").alias("head"))
    return marked.join(kept, F.col("key") == F.col("head"), "left_semi").select("row.*")
