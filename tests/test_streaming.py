"""The increment stream resumes from its checkpoint: re-running adds nothing,
new snapshot files are processed once (exactly-once file sink)."""

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions.scalar import month_start
from satlens.plans.etl import clean_survey
from satlens.sources.files import write_partitioned
from satlens.streaming.incremental import run_increments

COLS = [C.ID, C.DATE, C.CARRIER, "invitegroup_ib", "invitegroup", C.CABIN, C.HAUL, "delay", "nps_category", C.SCORE]


def test_increments_exactly_once(spark, inputs):
    base = tempfile.mkdtemp(prefix="satlens-stream-test-")
    src, sink = os.path.join(base, "src"), os.path.join(base, "sink")
    snap = inputs.survey.select(*COLS, month_start(C.DATE).alias(C.SNAPSHOT))
    first = snap.filter(F.col(C.DATE) < F.lit("1998-01-01").cast("date"))
    later = snap.filter(F.col(C.DATE) >= F.lit("1998-01-01").cast("date"))
    write_partitioned(first, src, [C.SNAPSHOT])
    schema = spark.read.parquet(src).schema
    name = f"t_{uuid.uuid4().hex[:8]}"

    def transform(df):
        return clean_survey(df).select(C.ID, C.SCORE, C.SNAPSHOT)

    expected_first = clean_survey(first).count()
    run_increments(spark, src, schema, sink, transform, [C.SNAPSHOT], name, max_files_per_trigger=5)
    assert spark.read.parquet(sink).count() == expected_first
    run_increments(spark, src, schema, sink, transform, [C.SNAPSHOT], name)       # nothing new
    assert spark.read.parquet(sink).count() == expected_first
    write_partitioned(later, src, [C.SNAPSHOT], mode="append")                    # new day files arrive
    run_increments(spark, src, schema, sink, transform, [C.SNAPSHOT], name)
    assert spark.read.parquet(sink).count() == expected_first + clean_survey(later).count()
