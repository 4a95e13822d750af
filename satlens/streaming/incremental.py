"""Daily increments as a Structured Streaming run.

The reference processes each day's survey snapshot as a dated batch slice.
Here new snapshot files are picked up by a file-source stream, cleaned with
the same (narrow) batch operators, and appended to a partitioned sink; the
stream's progress lives in a checkpoint under ``spark.checkpoint.dir``, so a
lost executor or a restarted job resumes exactly where it stopped and each
file is processed once.  ``availableNow`` processes what is there and stops,
which is how a scheduled daily job runs it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from satlens.session import ensure_checkpoint_dir


def run_increments(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                   transform: Callable[[DataFrame], DataFrame], partition_by: Sequence[str],
                   name: str, max_files_per_trigger: int | None = None) -> None:
    """Stream every snapshot file under ``source`` through ``transform`` into
    ``sink`` (Parquet, partitioned), then stop.

    ``transform`` must be a per-row (narrow) plan: it runs on each micro-batch.
    The file sink commits each batch in its metadata log, so a replayed batch
    is not written twice (exactly-once) and readers of ``sink`` only see
    committed files.
    """
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = transform(reader.load(source))
    q = (stream.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
         .option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).queryName(name).start())
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"stream {name} failed: {err}")
