"""Keyed table changes as DataFrame-to-DataFrame operators.

Tables are immutable snapshots; every change returns the next snapshot lazily.

Hot keys: ``latest`` keeps at most one row per key and map task before the shuffle, so a
key that holds a large share of the rows costs no more than any other. The row filters
(``keep_keys``, ``drop_keys``) put the table that may repeat a key on the left of the
join and shuffle nothing afterwards, which lets adaptive execution split a hot partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
        .select(*df.columns)
    )


def keep_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys.select(*on), on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in ``keys``; rows with a null key stay."""
    return df.join(keys.select(*on), on, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-row replace by key. ``new`` holds one row per key (see :func:`latest`)."""
    return drop_keys(old, new, keys).unionByName(new)


def replace_children(
    old: DataFrame, new: DataFrame, touched: DataFrame, key: str
) -> DataFrame:
    """Replace all child rows of the touched parents; a parent without new rows is cleared."""
    return drop_keys(old, touched, [key]).unionByName(new.select(*old.columns))


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent does not exist."""
    return drop_keys(children, parents, [key])


def cascade_delete(children: DataFrame, surviving: DataFrame, key: str) -> DataFrame:
    """Child rows left after the other parents were deleted."""
    return keep_keys(children, surviving, [key])


def set_column(
    df: DataFrame, new: DataFrame, key: str, column: str, only_missing: bool = False
) -> DataFrame:
    """Overwrite ``column`` from ``new`` (one row per key) where ``new`` has a value.

    With ``only_missing`` a value already present is kept.
    """
    found = new.select(key, F.col(column).alias("_new"))
    current, update = F.col(column), F.col("_new")
    value = F.coalesce(current, update) if only_missing else F.coalesce(update, current)
    return df.join(found, key, "left").withColumn(column, value).select(*df.columns)


def with_columns_from(df: DataFrame, ddl: str, defaults: dict[str, Column]) -> DataFrame:
    """Bring old data to the current schema: missing columns get a default or null."""
    from pyspark.sql.types import StructType

    columns = []
    for f in StructType.fromDDL(ddl).fields:
        if f.name in df.columns:
            value = F.col(f.name)
            if f.name in defaults:
                value = F.coalesce(value, defaults[f.name])
        else:
            value = defaults.get(f.name, F.lit(None))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def numbered(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Add ``row_no``: 1..n over all rows, without a global sort.

    Rows are numbered inside hash buckets of the (unique) key. The bucket sizes, one row
    per bucket, give each bucket's offset. Unless given, the number of buckets follows the
    session's shuffle partitions, so that it never holds a larger cluster back.
    """
    from pyspark.sql import Window

    if buckets is None:
        buckets = 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy("_bucket").agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        spread.withColumn("_local", local)
        .join(offsets, "_bucket")
        .withColumn("row_no", F.col("_offset") + F.col("_local"))
        .select(*df.columns, "row_no")
    )


def chunked(df: DataFrame, key: str, size: int, buckets: int | None = None) -> DataFrame:
    """Add ``chunk``: fixed-size request batches, all full but the last."""
    chunk = F.floor((F.col("row_no") - 1) / size).cast("bigint")
    return numbered(df, key, buckets).withColumn("chunk", chunk).drop("row_no")
