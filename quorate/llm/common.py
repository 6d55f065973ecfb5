"""Helpers that several operators share: durable intermediates, Arrow batches, distributed ranks, joins on hot keys."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that one rank bucket should hold on average.
RANK_BUCKET_ROWS = 20_000
#: At most this many keys count as hot in `join_on_hot_key`, so what it broadcasts is bounded.
MOST_HOT_KEYS = 1_000


#: Rows of an Arrow batch of whole texts.
BATCH_ROWS = 1_000
#: Rows that a task reads of Parquet at once; it holds their whole texts, up to twice.
READ_ROWS = 256
#: Bytes of a row group, of what durable() writes and of what a caller writes after documents(), such as a stage's output. A task
#: holds the row group that it writes and that it reads, so by Parquet's own 128 MB a few tasks with whole texts fill a small heap.
ROW_GROUP_BYTES = 16 << 20
#: Paths that durable() wrote, for each scratch() that is open.
_written: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of the session's spark.checkpoint.dir. Unset, a temporary one, but only where driver and executors are one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "quorate-checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    for paths in _written:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """What durable() writes in here is deleted at the end, but for paths that are taken from the list that this gives."""
    paths: list[str] = []
    _written.append(paths)
    try:
        yield paths
    finally:
        _written.remove(paths)
        delete(spark, paths)


def arrow_rows(df: DataFrame, keep: list[str], source: str, make: Callable[[list], list[list]], fields: str, rows: int = 1_000, many: bool = False) -> DataFrame:
    """The columns `keep` beside what `make` gives for lists of values of the column `source`: a list for each of `fields` (as DDL).

    Kept columns stay Arrow arrays, so nulls and long integers come out as they went in. With `many` the last list of
    `make` isn't a column: it holds for each row that comes out the number of the row that it comes from.
    """
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([*(df.schema[k] for k in keep), *added])
    kinds = list(to_arrow_schema(added).types)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = make(part.column(len(keep)).to_pylist())
                kept = [part.column(i) for i in range(len(keep))]
                if many:
                    origin = pa.array(out.pop() if out else [], pa.int64())
                    kept = [k.take(origin) for k in kept]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, kind) for x, kind in zip(out, kinds, strict=True))], names)

    return df.select(*keep, F.col(source).alias("_source")).mapInArrow(run, schema)


def bucket_count(rows: int) -> int:
    return max(32, rows // RANK_BUCKET_ROWS)


def ranked(df: DataFrame, key: list[str], order: list[str], name: str, rows: int) -> DataFrame:
    """Add `name`: the gapless rank from 0 of each row among the rows of equal `key`.

    Rows are numbered inside buckets of a hash of `order`; the buckets' sizes are then summed up within each
    key. So no task ever holds all rows of a key, and the rank depends on the data only, not on partitions.
    `order` must identify a row: tables with rows that may be equal add a column of numbered().
    """
    n = bucket_count(rows)
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)))
    inside = Window.partitionBy("_bucket", *key).orderBy(*order)
    sizes = df.groupBy("_bucket", *key).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", *key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        df.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, ["_bucket", *key])
        .withColumn(name, (F.col("_start") + F.col("_at")).cast("long"))
        .drop("_bucket", "_at", "_start")
    )


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """`df` with a number that no other row has; write it with durable() before it is used, so that it stays."""
    return df.withColumn(name, F.monotonically_increasing_id())


def join_on_hot_key(rows: DataFrame, sizes: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of `rows` with `sizes` (one row per key, `n` = rows of that key) where a few keys may be hot.

    A key with more than 1/1000 of all rows is hot: there are at most 1000 of these, which are broadcast. The
    other keys go through an ordinary join.
    """
    hot = sizes.where(F.col(n) > max(100, total // MOST_HOT_KEYS))
    cold = sizes.where(F.col(n) <= max(100, total // MOST_HOT_KEYS))
    marks = hot.select(key)
    return (
        rows.join(F.broadcast(hot), key)
        .unionByName(rows.join(F.broadcast(marks), key, "left_anti").join(cold, key))
    )


def held_out(doc_id: Column) -> Column:
    """True for a fifth of the ids: crc32 of the id as text is a multiple of 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts are read in batches of READ_ROWS rows, go to Python in Arrow batches of BATCH_ROWS rows and are written in row groups of ROW_GROUP_BYTES, unless the session has set another number than Spark's own."""
    for name, own, rows in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS), ("spark.sql.parquet.columnarReaderBatchSize", "4096", READ_ROWS)):
        if spark.conf.get(name) == own:
            spark.conf.set(name, str(rows))
    name = "parquet.block.size"
    if spark.conf.get(name, None) is None and spark._jsc.hadoopConfiguration().get(name) is None:
        spark.conf.set(name, str(ROW_GROUP_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
