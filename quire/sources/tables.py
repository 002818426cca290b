"""Stored tables and published files.

The catalogue's tables are bucketed and change together (:mod:`quire.sources.buckets`). Other
tables, such as rejects and staged rows, are directories of complete, numbered parquet snapshots: a
job reads the newest one and writes the next, so it never overwrites what it is reading and a
lost executor or a failed job leaves the last complete version in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire import schemas
from quire.operators.articles import Catalogue, current_classifications
from quire.operators.publish import in_catalogue_order
from quire.sources.buckets import BUCKETS, Kind, Store

KINDS = {
    "articles": Kind(schemas.ARTICLE), "authors": Kind(schemas.AUTHOR),
    "classifications": Kind(schemas.CLASSIFICATION), "landed": Kind(schemas.LANDED),
}
CORE = ("authors", "classifications", "articles")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshot numbers of a table, oldest first; of a bucketed table those of the
    manifests with which it changed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "v=*/{_SUCCESS,job=*/_SUCCESS}")
    found = {
        int(part[2:]) for s in fs.globStatus(done) or []
        for part in s.getPath().toString().removeprefix(folder.toString()).split("/")
        if part.startswith("v=")
    }
    return sorted(found)


def read_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Newest snapshot, or an empty table when there is none."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], ddl)
    return spark.read.parquet(f"{path}/v={known[-1]}")


def write_table(df: DataFrame, path: str) -> int:
    """Write the next snapshot and return its number."""
    known = versions(df.sparkSession, path)
    number = known[-1] + 1 if known else 1
    df.write.mode("overwrite").parquet(f"{path}/v={number}")
    return number


def catalogue_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Store:
    """The stored catalogue; ``buckets`` counts only for a new one."""
    return Store.open(spark, root, KINDS, buckets)


def load_catalogue(
    spark: SparkSession, root: str, store: Store | None = None, only: list[int] | None = None
) -> Catalogue:
    """The three tables, or the given buckets of them. Before the first manifest these are the
    newest snapshots of older data."""
    store = catalogue_store(spark, root) if store is None else store

    def read(name: str) -> DataFrame:
        if store.is_new:
            return read_table(spark, f"{root}/{name}", KINDS[name].ddl)
        return store.read(name, only)

    return Catalogue(
        read("articles"), read("authors"), current_classifications(read("classifications"))
    )


def save_catalogue(
    store: Store, cat: Catalogue, names: tuple[str, ...] = CORE, only: list[int] | None = None,
    landed: DataFrame | None = None, ledger: dict | None = None,
) -> Store:
    """Write the tables a job changed, or their buckets ``only``, and switch to them at once.

    The first manifest takes in all tables. A job that stopped half-way has changed nothing.
    """
    frames = {name: getattr(cat, name) for name in (CORE if store.is_new else names)}
    if landed is not None:
        frames["landed"] = landed
    return store.commit(frames, only, ledger)


def write_lines(rows: DataFrame, path: str) -> None:
    """Request rows (one ``value`` column) as text shards."""
    rows.select("value").write.mode("overwrite").text(path)


def write_entries(entries: DataFrame, path: str) -> None:
    """Published entries as JSON lines in catalogue order, all fields present."""
    ordered = in_catalogue_order(entries.select(*schemas.ENTRY_FIELDS))
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Published entries, for browsing."""
    types = {"year": "INT", "period_start": "INT", "period_end": "INT",
             "regions": "ARRAY<STRING>", "countries": "ARRAY<STRING>"}
    ddl = ", ".join(f"{c} {types.get(c, 'STRING')}" for c in schemas.ENTRY_FIELDS)
    return spark.read.schema(ddl).json(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back, for plans that use them several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder path for stream checkpoints and sinks.

    Lies in the shared folder of ``spark.checkpoint.dir``. Where that is unset, a local one is made, as in
    tests; on more than one machine this fails, as they wouldn't see each other's files.
    """
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="quire-")
    return f"{base}/{name}-{uuid.uuid4().hex}"
