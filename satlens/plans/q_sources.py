"""Registered queries: sources and sinks (inventory §2.1) and the remaining
union / tagging operators (X1, R5).

Each source query first writes data derived from the driver's tables into a
fresh folder under the shared checkpoint directory, then scans it back with
the operator under test; the oracle computes the same result from the tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlens import config as C
from satlens.functions.scalar import month_start
from satlens.operators import nps
from satlens.operators.reshape import tag_union
from satlens.plans.oracle_base import BASE, MODEL, SCORED, SURVEY, SURVEY_CLEAN, with_ctes
from satlens.plans.registry import Inputs, r6, register, rounded
from satlens.session import scratch_path
from satlens.sources import files as FS

CSV_SCHEMA = T.StructType([T.StructField("respondent_id", T.LongType()),
                           T.StructField("date_flight_local", T.DateType()),
                           T.StructField("operating_airline_code", T.StringType()),
                           T.StructField("nps_100", T.IntegerType()),
                           T.StructField("ticket_price", T.DoubleType())])


def _fresh(x: Inputs, name: str) -> str:
    return scratch_path(x.spark, f"{name}-{uuid.uuid4().hex}")


def _csv_prefix(x: Inputs) -> str:
    """Survey answers as many CSV files under one prefix."""
    path = _fresh(x, "survey-csv")
    (x.survey.select(*[f.name for f in CSV_SCHEMA.fields]).write.mode("overwrite")
     .option("header", True).option("maxRecordsPerFile", 5000).csv(path))
    return path


@register("scan_prefix", BASE + """
SELECT operating_airline_code, count(*) AS n, CAST(sum(nps_100) AS BIGINT) AS nps_sum, round(sum(ticket_price), 6) AS price_sum
FROM survey GROUP BY ALL""")
def q_scan_prefix(x: Inputs):
    df = FS.scan_csv(x.spark, _csv_prefix(x), CSV_SCHEMA, mode="FAILFAST")
    return df.groupBy(C.CARRIER).agg(F.count(F.lit(1)).alias("n"), F.sum(C.SCORE).alias("nps_sum"),
                                     r6(F.sum("ticket_price")).alias("price_sum"))


@register("scan_typed", BASE + """
SELECT date_flight_local, count(*) AS n FROM survey GROUP BY ALL""")
def q_scan_typed(x: Inputs):
    df = FS.scan_csv(x.spark, _csv_prefix(x), CSV_SCHEMA, mode="FAILFAST", columns=[C.DATE])
    return nps.group_count(df, [C.DATE])


@register("union_by_name", BASE + """
SELECT count(*) AS n, count_if(date_flight_local < DATE '1998-01-01' AND ticket_price IS NOT NULL) AS n_price,
  count_if(date_flight_local >= DATE '1998-01-01' AND delay IS NOT NULL) AS n_delay
FROM survey""")
def q_union_by_name(x: Inputs):
    s = x.survey
    cut = F.lit(dt.date(1998, 1, 1))
    a = s.filter(F.col(C.DATE) < cut).select(C.ID, C.SCORE, "ticket_price")   # older files: no delay
    b = s.filter(F.col(C.DATE) >= cut).select(C.ID, "delay", C.SCORE)         # newer files: no price
    u = FS.union_by_name([a, b])
    return u.agg(F.count(F.lit(1)).alias("n"), F.count("ticket_price").alias("n_price"),
                 F.count("delay").alias("n_delay"))


@register("scan_tolerant", BASE + """
SELECT count_if(respondent_id % 97 <> 0) AS n_good, count_if(respondent_id % 97 = 0) AS n_rejected,
  CAST(sum(CASE WHEN respondent_id % 97 <> 0 THEN nps_100 END) AS BIGINT) AS nps_sum_good,
  CAST(1 AS BIGINT) AS n_empty_files, CAST(1 AS BIGINT) AS n_unreadable_files
FROM survey""")
def q_scan_tolerant(x: Inputs):
    """Survey text with malformed lines, beside a file of zero bytes and one that is no gzip file in spite of its name."""
    path = _fresh(x, "survey-text")
    rid = F.col(C.ID)
    line = F.when(rid % 97 == 0, F.concat(F.lit("x"), rid.cast("string"), F.lit(",bad,??"))).otherwise(
        F.concat_ws(",", rid.cast("string"), F.col(C.SCORE).cast("string"),
                    F.coalesce(F.col("ticket_price").cast("string"), F.lit(""))))
    x.survey.select(line.alias("value")).write.mode("overwrite").text(path)
    FS.write_bytes(x.spark, f"{path}/part-empty.csv", b"")
    FS.write_bytes(x.spark, f"{path}/part-damaged.csv.gz", b"1,2,3 and no gzip head")
    schema = T.StructType([T.StructField("respondent_id", T.LongType()), T.StructField("nps_100", T.IntegerType()),
                           T.StructField("ticket_price", T.DoubleType())])
    good, _ = FS.scan_tolerant(x.spark, path, schema, header=False)
    total = good.agg(F.sum(C.SCORE).alias("s")).select("s").scalar()
    files = FS.scan_outcomes(x.spark, path, schema)
    # A task without rows writes an empty part of its own: only the planted one is counted.
    planted = (F.col("status") == "empty") & F.col("file").endswith("/part-empty.csv")
    return files.agg(F.sum("n_good").alias("n_good"), F.sum("n_rejected").alias("n_rejected"), total.alias("nps_sum_good"),
                     F.count_if(planted).alias("n_empty_files"), F.count_if(F.col("status") == "unreadable").alias("n_unreadable_files"))


def _snapshots(x: Inputs) -> str:
    """Survey written as monthly snapshot partitions ``insert_date_ci=YYYY-MM-01``."""
    path = _fresh(x, "survey-snap")
    s = x.survey.select(C.ID, C.CABIN, C.SCORE, month_start(C.DATE).alias(C.SNAPSHOT))
    FS.write_partitioned(s, path, [C.SNAPSHOT])
    return path


@register("scan_partition", BASE + """
SELECT cabin_in_surveyed_flight, count(*) AS n FROM survey
WHERE CAST(date_trunc('month', date_flight_local) AS DATE) = DATE '1997-03-01' GROUP BY ALL""")
def q_scan_partition(x: Inputs):
    df = FS.read_partition(x.spark, _snapshots(x), C.SNAPSHOT, dt.date(1997, 3, 1))
    return nps.group_count(df, [C.CABIN])


@register("partition_asof", BASE + """
, parts AS (SELECT DISTINCT CAST(date_trunc('month', date_flight_local) AS DATE) AS p FROM survey
            WHERE CAST(date_trunc('month', date_flight_local) AS DATE) <= DATE '1997-03-15'),
pick AS (SELECT p FROM parts ORDER BY p DESC LIMIT 1 OFFSET 1)
SELECT cabin_in_surveyed_flight, count(*) AS n FROM survey
WHERE CAST(date_trunc('month', date_flight_local) AS DATE) = (SELECT p FROM pick) GROUP BY ALL""")
def q_partition_asof(x: Inputs):
    df = x.spark.read.parquet(_snapshots(x))
    return nps.group_count(FS.partition_asof(df, C.SNAPSHOT, dt.date(1997, 3, 15), n=2), [C.CABIN])


@register("partition_parts", BASE + """
, m AS (SELECT DISTINCT CAST(date_trunc('month', date_flight_local) AS DATE) AS d FROM survey),
t AS (SELECT 'insert_date_ci=' || strftime(d, '%Y-%m-%d') AS partition_text FROM m
      UNION ALL SELECT strftime(d, '%Y%m%d') FROM m UNION ALL SELECT strftime(d, '%Y-%m-%d') FROM m
      UNION ALL SELECT 'bad-' || strftime(d, '%Y') FROM m)
, v AS (SELECT partition_text, regexp_extract(partition_text, '(?:^|=)(\\d{4}-?\\d{2}-?\\d{2})$', 1) AS v FROM t)
, d AS (SELECT partition_text, CAST(coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y%m%d')) AS DATE) AS partition_date FROM v)
SELECT *, CAST(year(partition_date) AS INTEGER) AS year, CAST(month(partition_date) AS INTEGER) AS month,
  CAST(day(partition_date) AS INTEGER) AS day FROM d""")
def q_partition_parts(x: Inputs):
    m = x.survey.select(month_start(C.DATE).alias("d")).distinct()
    t = m.select(F.concat(F.lit("insert_date_ci="), F.date_format("d", "yyyy-MM-dd")).alias("partition_text")) \
        .unionByName(m.select(F.date_format("d", "yyyyMMdd").alias("partition_text"))) \
        .unionByName(m.select(F.date_format("d", "yyyy-MM-dd").alias("partition_text"))) \
        .unionByName(m.select(F.concat(F.lit("bad-"), F.date_format("d", "yyyy")).alias("partition_text")))
    return t.select("partition_text", *FS.partition_parts(F.col("partition_text")))


@register("incremental_slice", BASE + """
SELECT respondent_id, nps_100 FROM survey WHERE insert_date_ci = DATE '1997-03-14'""")
def q_incremental_slice(x: Inputs):
    return FS.incremental_slice(x.survey, C.SNAPSHOT, dt.date(1997, 3, 14)).select(C.ID, C.SCORE)


@register("run_mode", MODEL + """
SELECT 'predict' AS use_type, count(*) AS n FROM model_input WHERE date_flight_local = DATE '2000-03-14'
UNION ALL SELECT 'train', count(*) FROM model_input""")
def q_run_mode(x: Inputs):
    hist = x.model_input
    inc = FS.incremental_slice(hist, C.DATE, dt.date(2000, 3, 14))
    out = None
    for mode in ("predict", "train"):
        d = FS.by_run_mode(hist, inc, mode).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(mode).alias("use_type"), "n")
        out = d if out is None else out.unionByName(d)
    return out


@register("sink_roundtrip", MODEL + """
SELECT CAST(date_trunc('month', date_flight_local) AS DATE) AS run_date, count(*) AS n, CAST(sum(nps_100) AS BIGINT) AS nps_sum
FROM model_input GROUP BY ALL""")
def q_sink_roundtrip(x: Inputs):
    path = _fresh(x, "model-input-sink")
    m = x.model_input.withColumn("run_date", month_start(C.DATE))
    FS.write_partitioned(m, path, ["run_date"])
    # Re-running one month rewrites only that month (dynamic partition overwrite).
    FS.write_partitioned(m.filter(F.col("run_date") == F.lit(dt.date(2000, 3, 1))), path, ["run_date"])
    back = x.spark.read.parquet(path)
    return back.groupBy("run_date").agg(F.count(F.lit(1)).alias("n"), F.sum(C.SCORE).cast("bigint").alias("nps_sum"))


@register("union_quarters", SCORED + """
SELECT CAST(quarter(date_flight_local) AS INTEGER) AS quarter, count(*) AS n,
  round(sum(out_prob_nps), 6) AS out_prob_nps_sum FROM scored_nps GROUP BY ALL""")
def q_union_quarters(x: Inputs):
    """Quarters written as partitions by one job, one of them rewritten alone, then united by name from their own files."""
    path = _fresh(x, "scored-quarters")
    s = x.scored.select(C.ID, "out_prob_nps", F.quarter(C.DATE).alias("quarter"))
    FS.write_partitioned(s, path, ["quarter"])
    FS.write_partitioned(s.where("quarter = 2"), path, ["quarter"])
    stored = [r[0] for r in x.spark.read.parquet(path).select("quarter").distinct().collect()]  # four at most
    u = FS.union_by_name([x.spark.read.parquet(f"{path}/quarter={q}").withColumn("quarter", F.lit(q).cast("int")) for q in sorted(stored)])
    return u.groupBy("quarter").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("out_prob_nps")).alias("out_prob_nps_sum"))


@register("tag_union", MODEL + """
SELECT CASE WHEN year(date_flight_local) = 1997 THEN 'before' ELSE 'after' END AS period,
  count(*) AS n, round(avg(nps_100), 6) AS mean_score
FROM model_input WHERE year(date_flight_local) IN (1997, 2000) GROUP BY ALL""")
def q_tag_union(x: Inputs):
    m = x.model_input
    u = tag_union({"before": m.filter(F.year(C.DATE) == 1997), "after": m.filter(F.year(C.DATE) == 2000)})
    return rounded(u.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.avg(C.SCORE).alias("mean_score")))


_STREAM_COLS = [C.ID, C.DATE, C.CARRIER, "invitegroup_ib", "invitegroup", C.CABIN, C.HAUL, "delay",
                "nps_category", C.SCORE]


@register("stream_increments", with_ctes(SURVEY, SURVEY_CLEAN) + """
SELECT flight_month, cabin_in_surveyed_flight, haul, count(nps_100) AS n_answers,
  count_if(nps_100 > 8) AS promoters, count_if(nps_100 <= 6) AS detractors, CAST(sum(otp15_takeoff) AS BIGINT) AS n_late
FROM survey_clean GROUP BY ALL""")
def q_stream_increments(x: Inputs):
    """Monthly snapshot files streamed (availableNow) through the cleaning step
    into a partitioned sink; the NPS counts are then read from the sink."""
    from satlens.plans.etl import FLIGHT_MONTH, clean_survey
    from satlens.streaming.incremental import run_increments
    src, sink = _fresh(x, "stream-src"), _fresh(x, "stream-sink")
    snap = x.survey.select(*_STREAM_COLS, month_start(C.DATE).alias(C.SNAPSHOT))
    FS.write_partitioned(snap, src, [C.SNAPSHOT])
    schema = x.spark.read.parquet(src).schema

    def transform(df):
        return clean_survey(df).select(C.ID, C.CABIN, C.HAUL, C.SCORE, C.OTP, FLIGHT_MONTH, C.SNAPSHOT)

    run_increments(x.spark, src, schema, sink, transform, [C.SNAPSHOT], f"increments_{uuid.uuid4().hex[:8]}",
                   max_files_per_trigger=20)
    out = x.spark.read.parquet(sink)
    return out.groupBy(FLIGHT_MONTH, C.CABIN, C.HAUL).agg(
        F.count(C.SCORE).alias("n_answers"), F.count_if(F.col(C.SCORE) > 8).alias("promoters"),
        F.count_if(F.col(C.SCORE) <= 6).alias("detractors"), F.sum(C.OTP).cast("bigint").alias("n_late"))
