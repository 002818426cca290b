"""Storage in the shared folder and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local one only where that is unset and there
    is one machine."""
    base = spark.conf.get(KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {KEY} to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="quire-")
        spark.conf.set(KEY, base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts lineage, survives executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: str, n: int):
    """crc32 of a key as text, modulo n; null keys give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable vertex of every vertex of ``edges`` (a, b): rows (v, root).

    Minimum labels move along edges and are then replaced by their label's label, so long
    chains need logarithmically many rounds. Each round is a stored table, and a vertex with
    very many edges is aggregated map-side.
    """
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(),
        f"{name}-edges",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("root")),
        f"{name}-labels",
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(
            F.min("root").alias("least")
        )
        met = labels.join(near, F.col("v") == F.col("a")).select(
            "v", F.col("root").alias("old"), F.least("root", "least").alias("root")
        )
        met = stored(met, f"{name}-met")
        heads = met.select(F.col("v").alias("head"), F.col("root").alias("up"))
        new = stored(
            met.join(heads, F.col("root") == F.col("head"), "left").select(
                "v", "old", F.least("root", F.coalesce("up", "root")).alias("root")
            ),
            f"{name}-labels",
        )
        labels = new.select("v", "root")
        if new.where("old <> root").isEmpty():
            return labels
