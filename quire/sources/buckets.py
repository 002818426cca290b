"""Bucketed tables that change together.

The rows of each table are dealt to buckets by a hash of the table's key, and one manifest says which
folder holds each bucket:

    <root>/manifest/<number>.json
    <root>/<table>/v=<number>/job=<id>/bucket=<b>/part-...parquet

A job finds the buckets its keys fall into, reads those, writes them anew into folders of its
own, and then writes the next manifest, which names the new folders and, for every other
bucket, the old ones. So the cost of a change follows the buckets it touches, all tables of a job switch
at once, and what a job wrote before it failed is never seen. Two jobs that start from the same
manifest cannot both finish: the second finds its manifest written.

A manifest also carries a ledger, small facts that must change together with the tables, such as
the stream batches that are in them.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new store. More buckets make a small change cheaper and a whole write finer.
BUCKETS = 32


class Kind(NamedTuple):
    """A table's columns, and those whose hash deals its rows."""

    ddl: str
    key: tuple[str, ...] = ("doi",)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as its object."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, folder = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    found = names_in(spark, f"{root}/manifest")
    return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = hadoop_path(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A whole file under a name that must be free; fails where it is taken."""
    fs, draft = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, hadoop.Path(path), options)


class Store:
    """The tables below ``root`` as of one manifest."""

    def __init__(self, spark: SparkSession, root: str, kinds: dict[str, Kind], state: dict):
        self.spark, self.root, self.kinds, self.state = spark, root, kinds, state

    @classmethod
    def open(
        cls, spark: SparkSession, root: str, kinds: dict[str, Kind], buckets: int = BUCKETS
    ) -> Store:
        """The newest manifest; ``buckets`` counts only where there is none yet."""
        known = manifest_numbers(spark, root)
        if known:
            state = json.loads(read_text(spark, f"{root}/manifest/{known[-1]}.json"))
        else:
            state = {"number": 0, "buckets": buckets, "tables": {}, "ledger": {}}
        return cls(spark, root, kinds, state)

    @property
    def is_new(self) -> bool:
        return self.state["number"] == 0

    @property
    def ledger(self) -> dict:
        return self.state["ledger"]

    def bucket(self, name: str) -> Column:
        """The bucket of a row of a table."""
        return F.pmod(F.xxhash64(*self.kinds[name].key), F.lit(self.state["buckets"])).cast("int")

    def buckets_of(self, keys: DataFrame, name: str) -> list[int] | None:
        """The buckets that hold a table's rows with these keys: at most as many numbers as there
        are buckets. None, which stands for all, while nothing is stored."""
        if self.is_new:
            return None
        rows = keys.select(self.bucket(name).alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in rows)

    def read(self, name: str, only: list[int] | None = None) -> DataFrame:
        """A table, or the given buckets of it."""
        held = self.state["tables"].get(name, {})
        wanted = held if only is None else [str(b) for b in only if str(b) in held]
        folders = [f"{self.root}/{name}/{held[b]}/bucket={b}" for b in wanted]
        if not folders:
            return self.spark.createDataFrame([], self.kinds[name].ddl)
        return self.spark.read.schema(self.kinds[name].ddl).parquet(*folders)

    def _write(self, df: DataFrame, name: str, only: list[int] | None) -> dict[str, str]:
        """Rows written by bucket; the folder of each bucket that has any."""
        folder = f"v={self.state['number'] + 1}/job={uuid.uuid4().hex}"
        path = f"{self.root}/{name}/{folder}"
        # Rebalancing splits a bucket that a few keys fill and joins small ones in a task.
        rows = df.withColumn("bucket", self.bucket(name)).hint("rebalance", F.col("bucket"))
        rows.write.partitionBy("bucket").parquet(path)
        met = [n.removeprefix("bucket=") for n in names_in(self.spark, path) if n.startswith("bucket=")]
        strange = set(met) - set(map(str, only)) if only is not None else set()
        if strange:
            raise ValueError(f"{name}: rows outside the buckets of this change")
        return {b: folder for b in met}

    def commit(
        self, frames: dict[str, DataFrame], only: list[int] | None = None, ledger: dict | None = None
    ) -> Store:
        """Replace whole tables, or their buckets ``only``, and switch to the next manifest.

        Tables that are not named, and all other buckets, stay as they are, files included.
        """
        tables = dict(self.state["tables"])
        for name, df in frames.items():
            gone = set() if only is None else set(map(str, only))
            old = {} if only is None else tables.get(name, {})
            kept = {b: f for b, f in old.items() if b not in gone}
            tables[name] = kept | self._write(df, name, only)
        state = {
            **self.state, "number": self.state["number"] + 1, "tables": tables,
            "ledger": {**self.ledger, **(ledger or {})},
        }
        write_new(self.spark, f"{self.root}/manifest/{state['number']}.json", json.dumps(state))
        return Store(self.spark, self.root, self.kinds, state)

    def rebucketed(self, buckets: int) -> Store:
        """All tables dealt anew, for a store that has outgrown its buckets."""
        wider = Store(self.spark, self.root, self.kinds, {**self.state, "buckets": buckets})
        return wider.commit({name: self.read(name) for name in self.state["tables"]})
