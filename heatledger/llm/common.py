"""What the corpus operators share: table access, the shared folder, text primitives."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether Spark drops the shuffle files of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one below the warehouse.

    Where neither the setting nor a checkpoint folder exists yet, the latter is set as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end within drop their shuffle files then, not when the driver's heap happens to be collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    This cuts lineage the same way a reliable checkpoint does: the rows survive lost executors.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with dropping_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def remove(spark: SparkSession, name: str) -> None:
    """Delete a path of the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialise`` wrote for frames that nothing reads any more."""
    for df in frames:
        remove(df.sparkSession, df.stored_at)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names equal one of ``names``, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def text_or_empty(column: str) -> Column:
    """The text as a string, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def as_bytes(array: pa.Array) -> list:
    """UTF-8 bytes of a string column without decoding it; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [x or b"" for x in array.cast(kind).to_pylist()]


def batches(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows."""
    return (b for b in items if b.num_rows)


def byte_slices(array: pa.Array, limit: int = 4 << 20):
    """Runs of rows of a string column as (first row, bytes as uint8, offsets from 0).

    A run has about ``limit`` bytes; a longer text is a run of its own. Null texts have no bytes.
    """
    import numpy as np

    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    flat = pa.concat_arrays([array.cast(kind)]) if array.offset == 0 else pa.array(array.cast(kind).to_pylist(), kind)
    if flat.null_count:
        flat = flat.fill_null(b"")
    buffers = flat.buffers()
    width = np.int64 if kind == pa.large_binary() else np.int32
    offsets = np.frombuffer(buffers[1], width)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < len(flat):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def bounded_sample(rows: DataFrame, id_col: str, size: int) -> DataFrame:
    """At most ``size`` ids of ``rows``, chosen by hash; the same ids whatever the partitioning."""
    ids = rows.select(F.col(id_col).alias("_s_id")).filter("_s_id IS NOT NULL").distinct()
    return ids.orderBy(F.xxhash64("_s_id"), "_s_id").limit(size)
