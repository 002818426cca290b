"""LM scoring with a hashed maximum-entropy model.

P(token | history) = P(class | history) * P(token | class). The class softmax is a log-linear
model on hashed features of the history: the last word (bigram), the two last words (trigram), and
the last but one alone (skip). Frequent words are classes of their own; all others share classes
made from their endings, by the words they follow. In a shared class a token has its smoothed share.

Training is one pass of mini-batch gradient updates in every task, followed by averaging the
weights with the number of updates each feature had (parameter mixing). Token counts come from
all training texts. Counts of the HEAD most frequent tokens go to all tasks; the others' are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import texts
from quire.llm.shared import remainder, stored

#: Tokens whose counts go to all tasks, at most.
HEAD = 1 << 17
#: Tokens that are features by themselves; others are by their ending.
NAMED = 2048
#: Tokens that are classes by themselves (with the end), and shared classes.
OWN, SHARED = 16, 24
ENDINGS, FOLLOWED = 1024, 64
#: Rows of the weight tables of bigrams, skips and trigrams.
ROWS = 4096
TABLES = 3
BATCH = 8192
RATE = 0.5
#: Rows of weights that travel together.
GROUP = 16
END = np.uint64(0xE0D0E0D0E0D0E0D0)
START = np.uint64(0x5A5A5A5A5A5A5A5A)


class Tokens(NamedTuple):
    """Tokens of a chunk, an end after each text; ``at`` are the texts' bounds."""

    token: np.ndarray
    ending: np.ndarray
    at: np.ndarray


def tokens(chunk: texts.Chunk) -> Tokens:
    lo, hi, at = chunk.words()
    data = texts.LOWER[chunk.data]
    words = texts.ranged(texts.prefix(texts.BYTE[data]), lo, hi)
    n = np.diff(at)
    place = np.arange(len(lo)) + np.repeat(np.arange(len(n)), n)
    token = np.full(len(lo) + len(n), END)
    token[place] = words
    last = data[hi - 1].astype(np.uint32)
    second = np.where(hi - lo > 1, data[np.maximum(hi - 2, 0)], 0).astype(np.uint32)
    ending = np.zeros(len(token), np.int64)
    ending[place] = ((second << np.uint32(8) | last) * np.uint32(2654435761)) >> np.uint32(22)
    return Tokens(token, ending, at + np.arange(len(at)))


def _before(values: np.ndarray, at: np.ndarray, back: int, fill) -> np.ndarray:
    """The value ``back`` places before each one in its text."""
    out = np.full_like(values, fill)
    out[back:] = values[:-back] if back else values
    for k in range(back):
        first = at[:-1] + k
        out[first[first < at[1:]]] = fill
    return out


def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, token, ending, n): token counts (0), and counts of (ending, ending before) (1)."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    cells = np.zeros(ENDINGS * FOLLOWED, np.int64)

    def merged():
        token, ending, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(token, kind="stable")
        token, ending, n = token[order], ending[order], n[order]
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        return token[first], ending[first], np.add.reduceat(n, first)

    def rows(kind: int, token: np.ndarray, ending: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(token), kind, np.int32)), pa.array(token.view(np.int64)),
            pa.array(ending.astype(np.int32)), pa.array(n.astype(np.int64)),
        ], ["kind", "token", "ending", "n"])

    size = 0
    for batch in batches:
        for chunk in texts.chunks(batch.column("text")):
            t = tokens(chunk)
            if not len(t.token):
                continue
            token, first, n = np.unique(t.token, return_index=True, return_counts=True)
            held.append((token, t.ending[first], n))
            before = _before(t.ending, t.at, 1, 0) % FOLLOWED
            cells += np.bincount(t.ending * FOLLOWED + before, minlength=len(cells))
            size += len(token)
            if size > 1 << 21:
                held = [merged()]
                size = len(held[0][0])
                if size > 1 << 20:
                    yield rows(0, *held[0])
                    held, size = [], 0
    if held:
        yield rows(0, *merged())
    cell = np.flatnonzero(cells)
    yield rows(1, cell.astype(np.uint64), np.zeros(len(cell)), cells[cell])


class Model(NamedTuple):
    """Head tokens in order with counts and ranks, class of each ending, and the weights."""

    head: np.ndarray
    count: np.ndarray
    rank: np.ndarray
    class_of: np.ndarray       # by ending
    own: np.ndarray            # tokens that are classes, in the order of their classes
    log_in_class: np.ndarray   # log10 of a shared class's tokens, types and one unknown
    bias: np.ndarray
    weights: np.ndarray        # TABLES * ROWS, classes
    n_tokens: int
    n_types: int


def clusters(cells: np.ndarray, n: int) -> np.ndarray:
    """Classes of endings by the endings they follow: k-means of the roots of their shares."""
    mass = cells.sum(1)
    points = np.sqrt(cells / np.maximum(mass, 1)[:, None])
    seen = np.flatnonzero(mass)
    out = np.arange(len(cells)) % n
    if len(seen) <= n:
        out[seen] = np.arange(len(seen))
        return out
    x, w = points[seen], mass[seen]
    centre = x[[np.argmax(w)]]
    while len(centre) < n:
        gap = ((x[:, None] - centre[None]) ** 2).sum(2).min(1)
        centre = np.vstack([centre, x[np.argmax(gap * w)]])
    for _ in range(15):
        near = ((x[:, None] - centre[None]) ** 2).sum(2).argmin(1)
        for k in range(n):
            if (near == k).any():
                centre[k] = np.average(x[near == k], axis=0, weights=w[near == k])
    out[seen] = near
    return out


def looked_up(model: Model, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place among the head tokens or -1, class, and rows of the three features of each token."""
    at = np.minimum(np.searchsorted(model.head, t.token), max(0, len(model.head) - 1))
    known = model.head[at] == t.token if len(model.head) else np.zeros(len(at), bool)
    rank = np.where(known, model.rank[at] if len(model.head) else 0, 1 << 30)
    group = np.where(rank < len(model.own), rank, len(model.own) + model.class_of[t.ending])
    name = np.where(rank < NAMED, t.token, texts.mix(t.ending.astype(np.uint64) + np.uint64(7)))
    one = _before(name, t.at, 1, START)
    two = _before(name, t.at, 2, START)
    keys = (one, texts.mix(two + np.uint64(1)), texts.mix(one ^ texts.mix(two + np.uint64(2))))
    rows = np.stack([(k % np.uint64(ROWS)).astype(np.int64) + i * ROWS for i, k in enumerate(keys)])
    return np.where(known, at, -1), group, rows


def shares(model: Model, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """P(class | history) for the feature rows of some tokens."""
    z = weights[rows[0]]
    z += weights[rows[1]]
    z += weights[rows[2]]
    z += model.bias
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def step(model: Model, weights: np.ndarray, energy: np.ndarray, updates: np.ndarray,
         group: np.ndarray, rows: np.ndarray) -> None:
    """One mini-batch update of ``weights``, with a rate for each feature that falls as it moves."""
    p = shares(model, weights, rows)
    p[np.arange(len(group)), group] -= 1
    for row in rows:
        order = np.argsort(row.astype(np.uint16), kind="stable")
        ranked = row[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        g = np.add.reduceat(p[order], first, axis=0)
        which = ranked[first]
        energy[which] += (g * g).sum(1)
        weights[which] -= g * (RATE / np.sqrt(energy[which] + 1e-3))[:, None]
        updates[which] += np.diff(np.append(first, len(row)))


def learnt(docs: DataFrame, model: Model) -> np.ndarray:
    """Weights after one pass over ``docs`` (text)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(tuple(small(model)))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        weights = m.weights.copy()
        energy = np.zeros(len(weights), np.float32)
        updates = np.zeros(len(weights), np.float32)
        for batch in batches:
            for chunk in texts.chunks(batch.column("text")):
                t = tokens(chunk)
                _, group, rows = looked_up(m, t)
                for at in range(0, len(group), BATCH):
                    step(m, weights, energy, updates, group[at: at + BATCH], rows[:, at: at + BATCH])
        moved = np.flatnonzero(updates.reshape(-1, GROUP).any(1))
        w = weights.reshape(len(updates) // GROUP, -1)[moved].astype(np.float16)
        n = updates.reshape(-1, GROUP)[moved]
        yield pa.RecordBatch.from_arrays([
            pa.array(moved.astype(np.int32)), pa.array([x.tobytes() for x in w], pa.binary()),
            pa.array([x.tobytes() for x in n], pa.binary()),
        ], ["part", "weights", "updates"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted means of sorted parts, one after the other."""
        now, w, n = None, None, None

        def done() -> pa.RecordBatch:
            mean = (w / np.maximum(n, 1e-9)[:, None]).astype(np.float32)
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([mean.tobytes()], pa.binary())],
                ["part", "weights"],
            )

        for batch in batches:
            for part, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                each = np.frombuffer(b, np.float32).astype(float)
                values = np.frombuffer(a, np.float16).reshape(GROUP, -1) * each[:, None]
                if part != now:
                    if now is not None:
                        yield done()
                    now, w, n = part, values, each
                else:
                    w, n = w + values, n + each
        if now is not None:
            yield done()

    sums = docs.select("text").mapInArrow(train, "part INT, weights BINARY, updates BINARY")
    sums = sums.repartition("part").sortWithinPartitions("part")
    weights = model.weights.copy()
    # As many rows as the model has groups of features, at any input.
    for row in sums.mapInArrow(average, "part INT, weights BINARY").collect():
        at = row["part"] * GROUP
        weights[at: at + GROUP] = np.frombuffer(row["weights"], np.float32).reshape(GROUP, -1)
    return weights


def small(model: Model) -> Model:
    """The model with only the head tokens that are features or classes by themselves."""
    keep = model.rank < NAMED
    return model._replace(head=model.head[keep], count=model.count[keep], rank=model.rank[keep])


def counted(docs: DataFrame) -> DataFrame:
    """Stored token counts of the texts (kind 0) and of pairs of endings (kind 1)."""
    rows = docs.select("text").mapInArrow(tally, "kind INT, token LONG, ending INT, n LONG")
    return stored(
        rows.groupBy("kind", "token").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")),
        "counts",
    )


def prepared(counts: DataFrame) -> Model:
    """The model before training. What reaches the driver has a fixed size at any input."""
    words = counts.where("kind = 0")
    n_tokens, n_types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    level = F.floor(F.log2("n") * 32)
    sizes = words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    cut, size = 1 << 30, 0
    for r in sizes:
        size += r["count"]
        if size > HEAD:
            break
        cut = r["level"]
    top = words.where(level >= cut).select("token", "ending", "n").toPandas()
    token = top["token"].to_numpy(np.int64).view(np.uint64)
    count, ending = top["n"].to_numpy(np.int64), top["ending"].to_numpy(np.int64)
    order = np.argsort(token)
    token, count, ending = token[order], count[order], ending[order]
    by_count = np.lexsort((token, -count))
    rank = np.empty(len(token), np.int64)
    rank[by_count] = np.arange(len(token))
    own = token[by_count[:OWN]]
    pairs = counts.where("kind = 1").toPandas()
    cells = np.zeros(ENDINGS * FOLLOWED)
    cells[pairs["token"].to_numpy(np.int64)] = pairs["n"].to_numpy(float)
    class_of = clusters(cells.reshape(ENDINGS, FOLLOWED), SHARED)
    by_ending = words.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    held = np.zeros((2, ENDINGS))
    held[:, by_ending["ending"].to_numpy(np.int64)] = by_ending[["n", "v"]].to_numpy(float).T
    is_own = rank < OWN
    np.subtract.at(held[0], ending[is_own], count[is_own])
    np.subtract.at(held[1], ending[is_own], 1)
    n_in, v_in = (np.bincount(class_of, h, SHARED) for h in held)
    mass = np.concatenate([count[by_count[:OWN]], n_in]) + 0.5
    weights = np.zeros((TABLES * ROWS, len(own) + SHARED), np.float32)
    return Model(
        token, count, rank, class_of, own, np.log10(n_in + v_in + 1),
        np.log(mass / mass.sum()).astype(np.float32), weights, int(n_tokens), int(n_types),
    )


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The trained model and all token counts, from all texts of ``docs``."""
    counts = counted(docs)
    model = prepared(counts)
    return model._replace(weights=learnt(docs, model)), counts.where("kind = 0")


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Rows for texts and rows for their rare tokens leave one pass; rare tokens meet their counts
    in a join, and both kinds meet again in sums by text. Text rows have a random token, so they
    spread evenly over the join, too. A null or empty text is one end. Repeated rows are
    scored each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = (
        f"key LONG, token LONG, doc STRUCT<doc_id: {kind}, n_tokens: LONG, n_known: LONG, "
        "logs: DOUBLE, own: DOUBLE, score: DOUBLE>"
    )
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        log_count = np.log10(np.append(m.count, 0) + 1.0)
        for batch in batches:
            for chunk in texts.chunks(batch.column("text")):
                here = batch.slice(chunk.first, len(chunk))
                keys, n = np.asarray(here.column("key")), len(chunk)
                t = tokens(chunk)
                at, group, rows = looked_up(m, t)
                of = np.repeat(np.arange(n), np.diff(t.at))
                logs = np.zeros(len(at))
                for lo in range(0, len(at), BATCH):
                    p = shares(m, m.weights, rows[:, lo: lo + BATCH])
                    own = group[lo: lo + BATCH]
                    logs[lo: lo + BATCH] = np.log10(np.maximum(p[np.arange(len(own)), own], 1e-30))
                shared = group >= len(m.own)
                logs[shared] -= m.log_in_class[group[shared] - len(m.own)]
                counted = log_count[at]
                part = pa.StructArray.from_arrays([
                    here.column("doc_id"), pa.array(np.diff(t.at)),
                    pa.array(np.bincount(of[at >= 0], minlength=n)),
                    pa.array(np.bincount(of, counted, n)),
                    pa.array(np.bincount(of[~shared], counted[~shared], n)),
                    pa.array(np.bincount(of, logs, n)),
                ], ["doc_id", "n_tokens", "n_known", "logs", "own", "score"])
                rare = np.flatnonzero(at < 0)
                token = np.concatenate([texts.mix(keys.view(np.uint64)), t.token[rare]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([keys, keys[of[rare]]])), pa.array(token.view(np.int64)),
                    pa.concat_arrays([part, pa.nulls(len(rare), part.type)]),
                ], ["key", "token", "doc"])

    named = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    told = counts.select(F.col("token").alias("t"), F.col("n").alias("c"))
    met = named.mapInArrow(score, shape).join(told, F.col("token") == F.col("t"), "left")
    is_rare = F.col("doc").isNull()
    rare_log = F.sum(F.when(is_rare, F.log10(F.coalesce("c", F.lit(0)) + 1.0)).otherwise(0.0))
    sums = met.groupBy("key").agg(
        F.max("doc.doc_id").alias("doc_id"), F.max("doc.n_tokens").alias("n_tokens"),
        (F.max("doc.n_known") + F.count_if(is_rare & F.col("c").isNotNull())).alias("n_known"),
        (F.max("doc.logs") + rare_log).alias("logs"),
        (F.max("doc.score") + F.max("doc.logs") - F.max("doc.own") + rare_log).alias("score"),
    )
    all_types = F.log10(F.lit(float(model.n_tokens + model.n_types + 1)))
    return sums.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * all_types).alias("base_score"), "score",
    )


def report(docs: DataFrame) -> DataFrame:
    """Train outside the held-out seventh of ids and score every row; a null id is not held out.

    Without training texts every token is unknown. Only doc_id and text are read.
    """
    docs = docs.select("doc_id", "text")
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    model, counts = fit(docs.where(~held))
    return scored(docs, model, counts).withColumn("held_out", held)
