"""Token counts by a two-tier lookup inside the tasks; no pre-token is ever shuffled.

A byte-level BPE works on pre-tokens, so a text's count is the sum of its pre-tokens' counts. The
first pass finds frequent pre-tokens: every task keeps a mergeable summary of ``FREQUENT`` counters
(whatever makes up more than one in ``FREQUENT`` of its pre-tokens is in it), and the summaries, one
row for each task, are merged by groups of ``FAN``. The counts of the survivors are broadcast as one compact
hash table, whose size ``FREQUENT`` bounds. In the second pass each task looks its pre-tokens up;
misses go to the task's cache and what that doesn't know to the tokenizer. The table decides only
what is fast: whatever it lacks is encoded, so every count is the library's.

Pre-tokens are found in numpy over the UTF-8 bytes of many texts at once. The class of each code point
(letter, number, white space, other) is read off the tokenizer itself. Table keys are the bytes
and the length, not hashes, so equal keys are equal pre-tokens. A text beyond ``texts.CHUNK``
bytes is cut where a space follows another character, which always ends a pre-token; memory follows the chunk
unless a single run without a space is longer.

Null and empty texts have no tokens. Repeated rows are counted each, an empty table gives none, and
other columns of the input are kept beside the counts in a struct, so no name clashes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm import texts
from quire.llm.shared import stored

#: Counters of a summary and entries of the table, at most.
FREQUENT = 65_536
#: Summaries that one task merges.
FAN = 64
#: Longest pre-token that the table can hold, in bytes.
SHORT = 15
#: Entries of a task's cache, and the longest pre-token it keeps; when full, it starts anew.
CACHE = 400_000
CACHED = 64
SPACE, LETTER, NUMBER, OTHER = range(4)
CODE_POINTS = 0x110000
#: The endings that the pre-token pattern splits off after an apostrophe (fixed values).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SHAPE = "n_bytes LONG, n_tokens LONG"
U = np.uint64
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


class Rules(NamedTuple):
    """What tasks need of a tokenizer: its file, code point classes and special strings."""

    file: str
    classes: np.ndarray
    special: bytes


class Table(NamedTuple):
    """Open-addressed hash table: two key words and the token count; count 0 is an empty slot."""

    low: np.ndarray
    high: np.ndarray
    count: np.ndarray


def library(file: str):
    """The tokenizer of a file's text, on one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(file)


def classes(tokenizer) -> np.ndarray:
    """The class of every code point, as the tokenizer's own splitter sees it."""
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    out = np.full(CODE_POINTS, OTHER, np.uint8)
    for lo in range(0, CODE_POINTS, 256):
        if 0xD800 <= lo < 0xE000:
            continue
        block = "".join(map(chr, range(lo, lo + 256)))
        bounds = [b for _, (_, b) in cut(f"a{block}1")]
        if bounds in ([257, 258], [1, 257, 258]):  # all letters, or all other
            out[lo:lo + 256] = LETTER if len(bounds) == 2 else OTHER
            continue
        found = {b for _, (_, b) in cut("".join(f"a{c}1{c}!" for c in block))}
        for i in range(256):
            after = tuple(5 * i + k in found for k in (1, 2, 3, 4))
            out[lo + i] = {
                (False, True, True, True): LETTER, (True, False, False, True): NUMBER,
                (True, True, True, False): OTHER,
            }.get(after, SPACE)
    return out


def rules(file: str) -> Rules:
    """Rules of a tokenizer file of the supported kind: byte-level BPE, texts taken as they are."""
    shape = json.loads(file)
    splitter = shape.get("pre_tokenizer") or {}
    known = (
        shape["model"]["type"] == "BPE" and shape.get("normalizer") is None
        and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space") and not shape["model"].get("dropout")
        and not any(
            t["single_word"] or t["lstrip"] or t["rstrip"] for t in shape["added_tokens"]
        )
    )
    if not known:
        raise ValueError("not a plain byte-level BPE file")
    names = sorted((t["content"].encode() for t in shape["added_tokens"]), key=len, reverse=True)
    return Rules(file, classes(library(file)), b"|".join(map(re.escape, names)))


def byte_classes(data: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Class of every byte: that of its code point."""
    out = known[:256][data]
    first = np.flatnonzero(data >= 0xC0)
    if len(first):
        wide = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        b0, b1, b2, b3 = (wide[first + k] for k in range(4))
        two, three = b0 < 0xE0, b0 < 0xF0
        point = np.where(
            two, (b0 & 31) << 6 | b1 & 63,
            np.where(three, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63,
                     (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63),
        )
        kind = known[np.minimum(point, CODE_POINTS - 1)]
        for k, has in enumerate((None, None, ~two, ~three)):
            at = first + k if has is None else first[has] + k
            fits = at < len(data)
            out[at[fits]] = (kind if has is None else kind[has])[fits]
    return out


def bounds(data: np.ndarray, edges: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Flags of the bytes that begin a pre-token; ``edges`` are flags of text starts and ends."""
    n = len(data)
    kind = byte_classes(data, known)
    change = edges[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(change)
    stops = np.append(runs[1:], n)
    space = kind[runs] == SPACE
    # A run of white space gives its last character to what follows in the same text.
    marks = np.zeros(n + 3, bool)
    marks[runs[space]] = True
    last = stops[space & ~edges[stops]] - 1
    while True:
        inner = (data[last] & 0xC0) == 0x80
        if not inner.any():
            break
        last = last - inner
    marks[last] = True
    # Other runs begin where they begin, unless a space before them is theirs.
    other = runs[~space]
    own = (other == 0) | edges[other] | (data[np.maximum(other - 1, 0)] != 32)
    marks[other[own]] = True
    # An apostrophe that begins a pre-token takes an ending from the letters after it.
    quote = other[own]
    quote = quote[(data[quote] == 39) & (quote + 1 < n)]
    quote = quote[change[np.minimum(quote + 1, n - 1)] & ~edges[quote + 1]]
    second = data[np.minimum(quote + 2, n - 1)]
    whole = (quote + 2 < n) & ~edges[np.minimum(quote + 2, n)]
    for ending in ENDINGS:
        fits = data[quote + 1] == ord(ending[0])
        if len(ending) == 2:
            fits &= whole & (second == ord(ending[1]))
        marks[quote[fits] + 1] = False
        marks[quote[fits] + 1 + len(ending)] = True
    return marks[:n]


class Found(NamedTuple):
    """Pre-tokens of a chunk in order: bounds, keys of the short ones, and special strings."""

    start: np.ndarray
    size: np.ndarray
    low: np.ndarray
    high: np.ndarray
    special: np.ndarray


def found(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: Rules) -> Found:
    """Pre-tokens and special strings of texts that lie end to end in ``data``."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Found(none, none, none.astype(U), none.astype(U), none.astype(bool))
    edges = np.zeros(n + 1, bool)
    edges[starts] = edges[ends] = True
    spans = []
    if of.special:
        for m in re.finditer(of.special, data.tobytes()):
            a, b = m.span()
            if not edges[a + 1:b].any():
                spans.append((a, b))
        for a, b in spans:
            edges[a] = edges[b] = True
    marks = bounds(data, edges, of.classes)
    special = np.zeros(n, bool)
    for a, b in spans:
        marks[a:b] = False
        marks[a] = special[a] = True
    start = np.flatnonzero(marks)
    size = np.diff(np.append(start, n))
    words = np.append(data, np.zeros(16, np.uint8))
    at = np.ndarray(n + 9, "<u8", words, strides=(1,))
    low = at[start] & MASK[np.minimum(size, 8)]
    high = at[start + 8] & MASK[np.clip(size - 8, 0, 7)]
    return Found(start, size, low, high | size.astype(U) << U(56), special[start])


def safe_cuts(data: np.ndarray) -> list[int]:
    """Places about every ``CHUNK`` bytes where a space follows an ASCII character that isn't one."""
    cuts, at = [], texts.CHUNK
    while at < len(data):
        part = data[at - 1: at + texts.CHUNK]
        place = np.flatnonzero((part[1:] == 32) & (part[:-1] > 32) & (part[:-1] < 127))
        if len(place):
            cuts.append(at + int(place[0]))
            at = cuts[-1]
        at += texts.CHUNK
    return cuts


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, bytes, starts, ends): some texts, or a part of a long one."""
    for chunk in texts.chunks(column):
        if len(chunk) == 1 and len(chunk.data) > texts.CHUNK:
            cuts = [0, *safe_cuts(chunk.data), len(chunk.data)]
            for a, b in zip(cuts, cuts[1:]):
                yield chunk.first, chunk.data[a:b], np.array([0]), np.array([b - a])
        else:
            yield chunk.first, chunk.data, chunk.starts, chunk.ends


def slots(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Mixed keys; equal keys give equal values."""
    return texts.mix(low ^ high * texts.STEP)


# -- frequent pre-tokens ---------------------------------------------------------------------


class Summary(NamedTuple):
    """Counters of some keys."""

    low: np.ndarray
    high: np.ndarray
    count: np.ndarray


def combined(parts: list[Summary], most: int = FREQUENT) -> Summary:
    """One summary of ``most`` counters: sums less the greatest sum that isn't kept."""
    low, high, count = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((high, low))
    low, high, count = low[order], high[order], count[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    low, high = low[at], high[at]
    count = np.add.reduceat(count, at) if len(at) else count
    if len(at) > most:
        kept = np.argpartition(-count, most)
        rest = count[kept[most]]
        kept = kept[:most]
        kept = kept[count[kept] > rest]
        low, high, count = low[kept], high[kept], count[kept] - rest
    return Summary(low, high, count)


NONE = Summary(np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64))


def packed(s: Summary) -> bytes:
    return np.concatenate([s.low, s.high, s.count.astype(U)]).tobytes()


def unpacked(data: bytes) -> Summary:
    low, high, count = np.frombuffer(data, U).reshape(3, -1)
    return Summary(low, high, count.astype(np.int64))


def summaries(docs: DataFrame, sent, text: str) -> DataFrame:
    """Stored (piece, summary): the frequent short pre-tokens of each input partition."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = Rules(*sent.value), NONE
        for batch in batches:
            for _, data, starts, ends in pieces(batch.column(0)):
                got = found(data, starts, ends, of)
                use = (got.size <= SHORT) & ~got.special
                ones = np.ones(int(use.sum()), np.int64)
                part = combined([Summary(got.low[use], got.high[use], ones)], len(ones))
                total = combined([total, part])
        piece = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int64()), pa.array([packed(total)], pa.binary())],
            ["piece", "summary"],
        )

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "piece LONG, summary BINARY")
    return stored(rows, "frequent")


def merged(rows: pa.Table) -> pa.Table:
    piece = rows.column("piece")[0].as_py() // FAN
    parts = [unpacked(x) for x in rows.column("summary").to_pylist()]
    return pa.table({
        "piece": pa.array([piece], pa.int64()),
        "summary": pa.array([packed(combined(parts))], pa.binary()),
    })


def frequent(docs: DataFrame, sent, text: str) -> Summary:
    """The most frequent short pre-tokens of all texts, with lower bounds of their counts."""
    rows = summaries(docs, sent, text)
    while rows.count() > 1:
        group = F.floor(F.col("piece") / FAN)
        rows = stored(
            rows.groupBy(group).applyInArrow(merged, "piece LONG, summary BINARY"), "frequent"
        )
    last = rows.first()
    return unpacked(last["summary"]) if last else NONE


def letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary, as the library has it:
    visible ones stand for themselves, the others follow in order."""
    from tokenizers.pre_tokenizers import ByteLevel

    known = sorted(ByteLevel.alphabet())
    own = {ord(c): c for c in known if ord(c) < 256}
    spare = iter(c for c in known if ord(c) >= 256)
    return {b: own.get(b) or next(spare) for b in range(256)}


class Encoder:
    """Token counts of single pre-tokens by the library's merges alone."""

    def __init__(self, file: str):
        self.model, self.letters = library(file).model, letters()

    def lengths(self, pre_tokens: list[bytes]) -> list[int]:
        one, to = self.model.tokenize, self.letters
        return [len(one(p.decode("latin-1").translate(to))) for p in pre_tokens]


def table(keys: Summary, of: Rules) -> Table:
    """The compact table: at most half full, with the counts of the keys' tokens."""
    n = len(keys.low)
    both = np.stack([keys.low, keys.high], 1).astype("<u8")
    sizes = (keys.high >> U(56)).astype(int)
    known = Encoder(of.file).lengths([b.tobytes()[:k] for b, k in zip(both, sizes)])
    bits = max(4, int(2 * n).bit_length())
    low, high, count = np.zeros(1 << bits, U), np.zeros(1 << bits, U), np.zeros(1 << bits, np.uint8)
    at = (slots(keys.low, keys.high) >> U(64 - bits)).astype(int)
    for i, (slot, tokens) in enumerate(zip(at.tolist(), known)):
        while count[slot]:
            slot = (slot + 1) & (1 << bits) - 1
        low[slot], high[slot], count[slot] = keys.low[i], keys.high[i], tokens
    return Table(low, high, count)


def looked_up(of: Table, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Token counts of keys; 0 where the table lacks them."""
    last = len(of.count) - 1
    out = np.zeros(len(low), np.int64)
    at = (slots(low, high) >> U(64 - last.bit_length())).astype(np.int64)
    left = np.arange(len(low))
    while len(left):
        known = of.count[at]
        same = (of.low[at] == low[left]) & (of.high[at] == high[left]) & (known > 0)
        out[left[same]] = known[same]
        go = ~same & (known > 0)
        left, at = left[go], (at[go] + 1) & last
    return out


# -- counts ----------------------------------------------------------------------------------


class Counter:
    """A task's lookups: the broadcast table, then the cache, then the tokenizer."""

    def __init__(self, of: Rules, known: Table):
        self.of, self.known = of, known
        self.encoder, self.cache, self.encoded = None, {}, 0

    def missing(self, parts: list[bytes]) -> list[int]:
        """Counts of pre-tokens that the table lacks."""
        if len(self.cache) > CACHE:
            self.cache = {}
        new = list({p for p in parts if p not in self.cache})
        fresh: dict[bytes, int] = {}
        if new:
            self.encoder = self.encoder or Encoder(self.of.file)
            self.encoded += len(new)
            fresh = dict(zip(new, self.encoder.lengths(new)))
            self.cache.update((p, n) for p, n in fresh.items() if len(p) <= CACHED)
        return [fresh[p] if p in fresh else self.cache[p] for p in parts]

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        n_bytes, n_tokens = np.zeros((2, len(column)), np.int64)
        for first, data, starts, ends in pieces(column):
            got = found(data, starts, ends, self.of)
            tokens = np.zeros(len(got.start), np.int64)
            short = (got.size <= SHORT) & ~got.special
            tokens[short] = looked_up(self.known, got.low[short], got.high[short])
            tokens[got.special] = 1
            miss = np.flatnonzero(tokens == 0)
            if len(miss):
                raw = data.tobytes()
                tokens[miss] = self.missing([
                    raw[a:b] for a, b in
                    zip(got.start[miss].tolist(), (got.start + got.size)[miss].tolist())
                ])
            sums = np.append(0, np.cumsum(tokens))
            here = slice(first, first + len(starts))
            at = np.searchsorted(got.start, np.stack([starts, ends]))
            n_bytes[here] += ends - starts
            n_tokens[here] += sums[at[1]] - sums[at[0]]
        return n_bytes, n_tokens


def counted(sent, table_sent, text: str) -> Column:
    @F.arrow_udf(StructType.fromDDL(SHAPE))
    def tokens(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(Rules(*sent.value), Table(*table_sent.value))
        for part in column:
            yield pa.StructArray.from_arrays(
                [pa.array(x) for x in counter.counts(part)], ["n_bytes", "n_tokens"]
            )

    # So the optimizer doesn't repeat it in filters.
    return tokens.asNondeterministic()(text)


def read_file(path: str) -> str:
    """A tokenizer file's text; only the driver reads it, tasks get it by broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def with_counts(docs: DataFrame, file: str, text: str = "text") -> DataFrame:
    """``docs`` as one struct column ``row``, and ``tokens``: n_bytes, n_tokens.

    ``file`` is the text of a tokenizer file (byte-level BPE without a normalizer).
    """
    context = docs.sparkSession.sparkContext
    of = rules(file)
    sent = context.broadcast(tuple(of))
    known = context.broadcast(tuple(table(frequent(docs, sent, text), of)))
    rows = docs.select(F.struct("*").alias("row"))
    return rows.select("row", counted(sent, known, f"row.{text}").alias("tokens"))


def report(docs: DataFrame, file: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a document has more than ``limit`` tokens."""
    return with_counts(docs.select("doc_id", "text"), file).select(
        "row.doc_id", "tokens.n_bytes", "tokens.n_tokens",
        (F.col("tokens.n_tokens") > limit).alias("over_limit"),
    )
