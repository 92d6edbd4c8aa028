"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventide.session import scratch_path, table_path

# Rows of one Arrow batch sent to a Python worker.  Documents have no length
# limit, so a batch holds few of them.
BATCH_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a new table in the shared scratch folder, with the
    writer's options, and read it back: it is computed once, and lost
    executors only cost a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it again."""
    spark = table.sparkSession
    if files := table.inputFiles():
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getParent().getName() != "scratch":
            raise ValueError(f"not a scratch table: {folder}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    usual = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def batch_rows(spark: SparkSession, rows: int):
    """What runs inside sends Python workers so many rows a batch."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_removed(spark: SparkSession):
    """What is written inside leaves no shuffle files behind."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str,
                together: int = 0) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of ``df`` inside the tasks; batches are
    joined until they hold ``together`` bytes."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def joined() -> list[pa.RecordBatch]:
            return held if len(held) < 2 else pa.Table.from_batches(held).combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.nbytes for b in held) >= together:
                    yield from map(fn, joined())
                    held = []
        yield from map(fn, joined())

    return df.mapInArrow(run, schema)


def in_fold(doc_id, modulus: int, remainder: int):
    """Whether crc32 of ``doc_id`` as text leaves ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus) == F.lit(remainder)
