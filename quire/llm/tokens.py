"""Token-ID output in training order, as fixed-stride binary shards.

Documents become token ids of a public byte-level BPE, each followed by one end token, and are
cut into sequences of a fixed length, the last one padded. Sequences are numbered in the order
of the stored token rows; a keyed Feistel permutation with cycle-walking sends that number to a global
slot, so the training order is random, has no collisions and needs no sort by random keys.
Slots are dealt by range: shard k holds slots [k * per_shard, (k + 1) * per_shard), in order, as records
of one stride. Slot s is therefore at byte (s mod per_shard) * stride of shard s // per_shard, and a reader
can resume anywhere.

Record: int64 doc_id, uint32 part of the document, uint32 tokens used, then ``length`` ids as
uint16, all little-endian.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import texts
from quire.llm.shared import stored

#: Vocabulary file with byte_bpe ranks; 50,256 ids, so the end token is the next one.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
LENGTH = 256
PER_SHARD = 4096
KEY = 20240229
HEAD = np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("used", "<u4")])
#: Stands for a null id in records.
NO_ID = -(1 << 63)
#: Shards that a task makes, at most about.
SHARDS_PER_TASK = 64
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
)


def encoder(vocabulary: str):
    """The tokenizer, its ranks read from the bytes of the vocabulary file."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenized(docs: DataFrame, length: int, vocabulary: str) -> DataFrame:
    """Stored (doc_id, piece, inner, parts, ids), one row per document.

    ``piece`` is the input partition, ``inner`` the number of sequences before this document in it.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, before = encoder(vocabulary).encode_to_numpy, 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids = [
                    np.append(one(t or ""), END).astype("<u2")
                    for t in part.column("text").to_pylist()
                ]
                parts = np.array([-(-len(x) // length) for x in ids])
                inner = before + np.cumsum(parts) - parts
                before += int(parts.sum())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("piece"), pa.array(inner, pa.int64()),
                    pa.array(parts, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
                ], ["doc_id", "piece", "inner", "parts", "ids"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.spark_partition_id().alias("piece"), "text"
    )
    shape = "doc_id LONG, piece INT, inner LONG, parts LONG, ids BINARY"
    return stored(rows.mapInArrow(encode, shape), "tokens")


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, base, ids) with the number of each document's first sequence, and their total.

    Documents are numbered in the order of the stored rows. The sums that are sent out are one
    row for each input partition, so their size follows the number of tasks, not of documents.
    """
    order = Window.orderBy("piece")
    sums = rows.groupBy("piece").agg(F.sum("parts").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    before = sums.select(
        F.col("piece").alias("at"), (F.sum("n").over(order) - F.col("n")).alias("n0")
    )
    return rows.join(F.broadcast(before), F.col("piece") == F.col("at")).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
        (F.col("n0") + F.col("inner")).alias("base"), "ids",
    ), total


def permuted(number: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """Slot of each number below ``total``: four Feistel rounds over the next even power of two,
    walked along the cycle until the value is below ``total`` again."""
    half = max(1, -(-max(1, int(total - 1).bit_length()) // 2))
    low = np.uint64((1 << half) - 1)
    out = number.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & low
        for turn in range(4):
            salt = np.uint64((key * 4 + turn + 1) & (1 << 64) - 1)
            left, right = right, left ^ (texts.mix(right + texts.mix(np.array([salt]))) & low)
        out[walking] = left << np.uint64(half) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


def sequences(
    docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, key: int = KEY,
) -> tuple[DataFrame, int]:
    """(slot, used, record) of every sequence, and how many there are.

    A null or empty text is one sequence with just the end token. Repeated rows are separate
    documents. ``doc_id`` must be integral; a null one is written as NO_ID.
    """
    placed, total = numbered(tokenized(docs, length, vocabulary))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids = [np.frombuffer(x, "<u2") for x in part.column("ids").to_pylist()]
                n = np.array([len(x) for x in ids])
                parts = -(-n // length)
                of = np.repeat(np.arange(len(ids)), parts)
                first = np.cumsum(parts) - parts
                nth = np.arange(len(of)) - first[of]
                record = np.zeros(len(of), np.dtype([("head", HEAD), ("ids", "<u2", length)]))
                body = np.zeros((len(of), length), "<u2")
                for x, row, p in zip(ids, first, parts):
                    body[row: row + p].reshape(-1)[: len(x)] = x
                record["ids"] = body
                used = np.minimum(n[of] - nth * length, length)
                record["head"]["doc_id"] = np.asarray(part.column("doc_id"))[of]
                record["head"]["part"], record["head"]["used"] = nth, used
                slot = permuted(np.asarray(part.column("base"))[of] + nth, total, key)
                offsets = (np.arange(len(of) + 1) * record.dtype.itemsize).astype(np.int32)
                held = pa.Array.from_buffers(
                    pa.binary(), len(of),
                    [None, pa.py_buffer(offsets), pa.py_buffer(record.tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(used, pa.int64()), held], ["slot", "used", "record"]
                )

    return placed.mapInArrow(cut, "slot LONG, used LONG, record BINARY"), total


SHAPE = (
    "shard LONG, first_slot LONG, sequences LONG, stride LONG, tokens LONG, sha256 STRING, data BINARY"
)


def shards(docs: DataFrame, per_shard: int = PER_SHARD, **options) -> DataFrame:
    """One row per shard: its slots, sizes, checksum and bytes.

    Shards go to tasks by range, straight from the slot: slots are uniform, so no sampling is
    needed and no task gets more than its part, whatever the documents' sizes.
    """
    rows, total = sequences(docs, **options)
    count = max(1, -(-total // per_shard))
    spark = docs.sparkSession
    tasks = min(count, max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // SHARDS_PER_TASK)
    ))
    shard = F.floor(F.col("slot") / per_shard)
    task = F.floor(shard * tasks / count).cast("int")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(number: int, held: list[bytes], tokens: int) -> pa.RecordBatch:
            data = b"".join(held)
            cells = (number, number * per_shard, len(held), len(held[0]), tokens,
                     hashlib.sha256(data).hexdigest(), data)
            kinds = (*[pa.int64()] * 5, pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(cells, kinds)],
                ["shard", "first_slot", "sequences", "stride", "tokens", "sha256", "data"],
            )

        now, held, tokens = None, [], 0
        for batch in batches:
            slots = np.asarray(batch.column("slot")) // per_shard
            used = np.asarray(batch.column("used"))
            bounds = np.append(np.flatnonzero(np.append(True, slots[1:] != slots[:-1])), len(slots))
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if held and slots[lo] != now:
                    yield row(now, held, tokens)
                    held, tokens = [], 0
                now = int(slots[lo])
                held += batch.column("record").slice(lo, hi - lo).to_pylist()
                tokens += int(used[lo:hi].sum())
        if held:
            yield row(now, held, tokens)

    dealt = rows.repartitionById(tasks, task).sortWithinPartitions("slot")
    return dealt.mapInArrow(write, SHAPE)


def name_of(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def save(made: DataFrame, folder: str) -> DataFrame:
    """Write every shard as a file in ``folder`` (a URI that all executors reach); the manifest.

    A shard is written under a name of its own and then renamed, so that a task that is run
    again replaces it by the same bytes. The manifest is stored as Parquet beside the shards, when all of
    them are there.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        for batch in batches:
            for number, data in zip(batch.column("shard").to_pylist(), batch.column("data")):
                part = f"{root}/.{name_of(number)}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(data.as_buffer())
                store.move(part, f"{root}/{name_of(number)}")
            yield batch.drop_columns(["data"])

    shape = SHAPE.rpartition(",")[0]
    made.mapInArrow(write, shape).write.parquet(f"{folder}/manifest")
    return made.sparkSession.read.parquet(f"{folder}/manifest")


def read(data: bytes, length: int = LENGTH) -> np.ndarray:
    """Records of a shard's bytes; any aligned range of bytes may be read alone."""
    kind = np.dtype([("head", HEAD), ("ids", "<u2", length)])
    return np.frombuffer(data, kind)
