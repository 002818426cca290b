"""Structured Streaming forms of the two jobs that run again and again.

Both append what each micro-batch brings, under the query and the batch, so a batch that is
retried after a lost executor overwrites itself. Cost follows the batch, not the table: the tables are
brought up to date by a batch job over the parts appended since the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire import schemas
from quire.operators import articles, keyed
from quire.operators.articles import Catalogue
from quire.operators.overrides import append_entries
from quire.sources import buckets, issues, pages, tables


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """Landed page files as a stream."""
    return pages.with_files(spark.readStream.schema(pages.LINES).text(path))


def part(batch: DataFrame, folder: str, number: int) -> str:
    """Folder of a micro-batch: of the query, whose id lies in its checkpoint, and the batch.

    A retried batch overwrites itself; a query with a new checkpoint never touches what an
    earlier one wrote.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{folder}/run={query}/batch={number}"


def started(rows: DataFrame, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """By default all that has landed is taken and the query ends."""
    stream = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()


def flatten_stream(
    page_rows: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append flattened articles of every micro-batch to ``out``, broken lines to
    ``<out>-rejected``. A batch is parsed once, into the shared folder."""
    def write(batch: DataFrame, number: int) -> None:
        if pages.BROKEN in batch.columns:
            batch = tables.staged(pages.with_lines(batch), "pages")
            pages.page_rejects(batch).write.mode("overwrite").parquet(
                part(batch, f"{out}-rejected", number)
            )
            batch = pages.good_pages(batch)
        else:
            batch = pages.with_lines(batch)
        rows = articles.article_rows(pages.page_items(batch))
        newest = keyed.latest(rows, ["doi"], [F.col(c) for c in pages.INGEST_ORDER])
        newest.write.mode("overwrite").parquet(part(batch, out, number))

    return started(page_rows, write, checkpoint, trigger)


MERGE_ORDER = [*pages.INGEST_ORDER, "run", "batch"]


def merge_flattened(
    cat: Catalogue, spark: SparkSession, out: str, cascade: bool = False
) -> Catalogue:
    """The tables with everything that was ever appended; what landed later wins. Stored tables
    are brought up to date by ``plans.jobs.merge_landed``, which reads new parts only."""
    rows = spark.read.parquet(out)
    return articles.put_articles(cat, rows, [F.col(c) for c in MERGE_ORDER], cascade)


def unapplied(
    spark: SparkSession, out: str, applied: dict[str, int]
) -> tuple[list[str], dict[str, int]]:
    """Folders of complete appended batches beyond those ``applied`` (last batch of each run), and
    the same with them. A run appends its batches in order."""
    new, last = [], dict(applied)
    for run in sorted(n for n in buckets.names_in(spark, out) if n.startswith("run=")):
        for batch in sorted(buckets.names_in(spark, f"{out}/{run}"), key=lambda n: int(n[6:])):
            number = int(batch.removeprefix("batch="))
            folder = f"{out}/{run}/{batch}"
            if number > applied.get(run[4:], -1) and tables.exists(spark, f"{folder}/_SUCCESS"):
                new.append(folder)
                last[run[4:]] = max(number, last.get(run[4:], -1))
    return new, last


def read_parts(spark: SparkSession, out: str, folders: list[str]) -> DataFrame:
    """Appended rows of these folders, with their ``run`` and ``batch``."""
    return spark.read.option("basePath", out).parquet(*folders)


MEMORY = {"keys": buckets.Kind("list STRING, kind STRING, value STRING", ("list", "kind", "value"))}


def memory_of(spark: SparkSession, log: str) -> buckets.Store:
    """What a log holds, as keys: (list, ``issue`` or ``doi``, value), bucketed by their hash."""
    return buckets.Store.open(spark, f"{log}-memory", MEMORY)


def log_keys(entries: DataFrame) -> DataFrame:
    """The keys that log entries occupy."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("issue", "doi")])
    each = entries.select("list", F.inline(pairs))
    return each.where(F.coalesce(F.col("value") != "", F.lit(False))).distinct()


def as_log(keys: DataFrame) -> DataFrame:
    """Keys as bare log entries, for :func:`append_entries` to check against."""
    held = {k: F.when(F.col("kind") == k, F.col("value")).alias(k) for k in ("issue", "doi")}
    return keyed.with_columns_from(keys.select("list", *held.values()), schemas.LOG_ENTRY, {})


def issue_stream(
    issue_rows: DataFrame, log: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append approved issue forms to the override log, each issue once; forms that cannot be
    used go to ``<log>-rejected`` with the reason.

    ``issue_rows`` streams ``issue_id, type, body, pos``. A form can be approved again at any time, so
    the memory of what was applied never expires. It lies in ``<log>-memory``: the log's keys,
    bucketed by their hash. A batch is parsed once and reads and writes the buckets of its own keys, so
    its cost doesn't follow the log; repeats of one issue are reduced to one row in each map task.
    The memory's manifest also says which batch of each run is in it, so a batch that is retried
    after it was applied does nothing, and before that it overwrites its own part. A new checkpoint finds
    the memory as it is; a log without one is read once to build it.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = part(batch, log, number)
        run = own.rsplit("/", 2)[1].removeprefix("run=")
        memory = memory_of(spark, log)
        if memory.is_new:
            memory = memory.commit({"keys": log_keys(read_log(spark, log, without=own))})
        if memory.ledger.get(run, -1) >= number:
            return
        parsed = tables.staged(batch, "issues")
        issues.rejected(parsed).write.mode("overwrite").parquet(part(batch, f"{log}-rejected", number))
        new = issues.accepted(parsed)
        only = memory.buckets_of(log_keys(new), "keys")
        old = memory.read("keys", only)
        append_entries(as_log(old), new).write.mode("overwrite").parquet(own)
        added = log_keys(spark.read.schema(schemas.LOG_ENTRY).parquet(own))
        memory.commit({"keys": old.unionByName(added).distinct()}, only, {run: number})

    return started(issues.parsed_issues(issue_rows), write, checkpoint, trigger)


def read_log(spark: SparkSession, log: str, without: str | None = None) -> DataFrame:
    """The appended log, or the log as if one batch and those after it had not been written."""
    if not tables.exists(spark, log):
        return spark.createDataFrame([], schemas.LOG_ENTRY)
    rows = spark.read.schema(f"{schemas.LOG_ENTRY}, run STRING, batch INT").parquet(log)
    if without is not None:
        run, number = without.rsplit("/", 2)[1:]
        later = F.col("batch") >= int(number.removeprefix("batch="))
        rows = rows.where(~((F.col("run") == run.removeprefix("run=")) & later))
    return rows.select(*schemas.names(schemas.LOG_ENTRY))


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a stream could not use: ``<log>-rejected`` or ``<out>-rejected``."""
    return spark.read.parquet(f"{folder}-rejected").drop("run", "batch")
