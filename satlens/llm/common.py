"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from satlens.session import ensure_checkpoint_dir, settings

#: Words of a text: runs of anything but blanks and the ASCII controls tab to carriage return.
WORD_GAP, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows with whole texts or sets that a worker gets at once: Spark and the worker each hold a batch a task.
WIDE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends at the files.

    ``batch_rows``: rows that go to a Python worker at once, where they are wide (the caller's setting, if that is less)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    most = int(spark.conf.get(BATCH_ROWS))
    with settings(spark, {BATCH_ROWS: str(min(batch_rows, most) if batch_rows and most > 0 else batch_rows or most)}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a whole text; empty for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces: whole texts and what a worker makes of them are held for one piece only.

    After the last one Arrow's unused memory goes back to the system: the worker stays for later stages."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    b = None
    pa.default_memory_pool().release_unused()


def let(value: Column, use) -> Column:
    """use(value) with ``value`` evaluated once, even where ``use`` has it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def broadcast_if_small(df: DataFrame, most_rows: int = 2_000_000) -> DataFrame:
    """Marks a side of a few fixed-width columns for broadcasting when its counted rows are few; else Spark joins by shuffle."""
    return F.broadcast(df) if df.count() <= most_rows else df


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
