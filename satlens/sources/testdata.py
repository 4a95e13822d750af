"""Survey-shaped views over the driver's TPC-H-like tables.

The production inputs (survey snapshots, flight load factors) are not public,
so the same columns are derived from lineitem / orders / customer with plain
column expressions.  The oracle SQL in ``satlens.plans.oracle`` states the
same derivation for DuckDB.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixture choice: residence country code per customer nation key (0..24).
NATION_COUNTRY = ["ES", "FR", "DE", "GB", "IT", "US", "CA", "MX", "BR", "AR", "CO", "PE", "CL",
                  "PT", "NL", "CN", "JP", "IN", "MA", "DZ", "SA", "AE", "IL", "RU", "ZZ"]

# Fixture choice: issue columns raised by a survey row (non-null = raised).
ISSUE_RULES = [("iss_checkin_queue", 7), ("iss_checkin_staff", 9), ("iss_cabin_dirty", 13),
               ("iss_wifi_slow", 19)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _case_list(col: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(col == i, F.lit(v)) if expr is None else expr.when(col == i, F.lit(v))
    return expr


def _clock_text(day: Column, minutes: Column) -> Column:
    """'yyyyMMdd HH:mm:00' for a date plus a minute offset, from integer
    fields only (no session time zone is involved)."""
    shift = F.floor(minutes / 1440).cast("int")
    mod = (minutes - shift * 1440).cast("int")
    d = F.date_add(day, shift)
    return F.format_string("%04d%02d%02d %02d:%02d:00", F.year(d), F.month(d), F.dayofmonth(d),
                           (mod / 60).cast("int"), mod % 60)


def ids_hold_one_order(spark: SparkSession, sf_dir: str) -> bool:
    """Whether no two orders share a respondent_id (order * 10 + line): all line numbers are single digits."""
    ln = F.col("l_linenumber")
    return not table(spark, sf_dir, "lineitem").where(ln.isNull() | (ln < 0) | (ln > 9)).limit(1).count()


def survey(spark: SparkSession, sf_dir: str, also: Sequence[str] = ()) -> DataFrame:
    """One row per survey answer (FIXTURES B1); lineitem ⋈ orders ⋈ customer.  ``also``: columns of these tables to keep."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = li.join(od.join(cu, od.o_custkey == cu.c_custkey), li.l_orderkey == od.o_orderkey)  # the lines move once
    pk, sk, ln, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_orderkey")
    score = F.least(F.lit(10), F.floor(F.col("l_quantity") / 8) + F.floor(F.col("l_discount") * 40)).cast("int")
    day = F.col("o_orderdate").cast("date")
    sched_min = (pk % 24) * 60
    real_min = sched_min + (pk % 91 - 30)
    cols = {
        "respondent_id": ok * 10 + ln,
        "date_flight_local": F.col("o_orderdate").cast("date"),
        "insert_date_ci": F.col("o_orderdate").cast("date"),
        "surveyed_flight_number": sk,
        "cabin_in_surveyed_flight": F.when(F.col("l_returnflag") == "A", "Business")
        .when(F.col("l_returnflag") == "N", "Premium Economy").otherwise("Economy"),
        "haul": F.when(ln % 3 == 0, "LH").when(ln % 3 == 1, "SH").otherwise("MH"),
        "operating_airline_code": F.when(F.col("o_orderstatus") == "O", "IB")
        .when(F.col("o_orderstatus") == "F", "YW").otherwise("XX"),
        "invitegroup_ib": F.when(ln == 7, F.lit(None).cast("int")).when(ln == 3, F.lit(3)).otherwise(F.lit(1)),
        "invitegroup": F.when(pk % 11 == 0, F.lit(1)).otherwise(F.lit(2)),
        "delay": F.when(pk % 17 == 0, F.lit(None).cast("double")).otherwise((pk % 91 - 30).cast("double")),
        "ticket_price": F.when(pk % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice") / 100),
        "nps_100": score,
        "nps_category": F.when(score > 8, "Promoter").when(score <= 6, "Detractor").otherwise("Passive"),
        "pfl_100_checkin": F.floor(F.col("l_quantity") / 5).cast("int"),
        "ifl_300_cabin": F.round(F.col("l_discount") * 100).cast("int"),
        "ifl_600_wifi": F.when(F.col("l_tax") >= 0.05, F.lit(None).cast("int"))
        .otherwise(F.round(F.col("l_tax") * 200).cast("int")),
        "monthly_weight": F.when(ok % 13 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(0.5) + (ok % 4) * F.lit(0.5)),
        "res100_country_code_survey": _case_list(F.col("c_nationkey"), NATION_COUNTRY),
        "scheduled_departure_time_local": _clock_text(day, sched_min),
        "real_departure_time_local": F.when(pk % 29 == 0, F.lit("bad")).otherwise(_clock_text(day, real_min)),
        "time_spent_hrminsec": F.format_string("%02d:%02d:%02d", (pk % 3).cast("int"),
                                               (sk % 60).cast("int"), ((ln * 7) % 60).cast("int")),
        "cla_600_wifi_t_f": F.when(pk % 4 == 0, "Yes").when(pk % 4 == 1, "Could not get it to work")
        .when(pk % 4 == 2, "Yes, but not enough").otherwise(F.lit(None).cast("string")),
        "tvl_journey_reason": F.when(F.col("o_orderpriority").startswith("1"), "Business")
        .when(F.col("o_orderpriority").startswith("2"), "Business/work").otherwise("Leisure"),
        "ticket_num": F.when(ln % 2 == 0, F.lit(None).cast("string")).otherwise(ok.cast("string")),
        "ticket_num_orig": pk.cast("string"),
    }
    for name, m in ISSUE_RULES:
        cols[name] = F.when(pk % m == 0, F.lit("Y")).otherwise(F.lit(None).cast("string"))
    return j.select(*[c.alias(n) for n, c in cols.items()], *also)


def load_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly flight load factor inputs (FIXTURES B2), one row per month × flight."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.filter(F.col("l_suppkey") % 10 != 0).join(od, li.l_orderkey == od.o_orderkey)
    aggs = []
    for flag, cabin in (("A", "business"), ("N", "premium_ec"), ("R", "economy")):
        hit = F.col("l_returnflag") == flag
        aggs.append(F.sum(F.when(hit, F.col("l_quantity")).otherwise(0.0)).alias(f"pax_{cabin}"))
        aggs.append(F.sum(F.when(hit, F.lit(50)).otherwise(F.lit(0))).alias(f"capacity_{cabin}"))
    sk, flight = F.col("l_suppkey"), F.col("op_flight_num")
    haul = F.when(flight % 3 == 0, "LH").when(flight % 3 == 1, "SH").otherwise("MH")
    sums = j.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("flight_date_local"), sk.alias("op_flight_num")).agg(*aggs)
    return sums.select("flight_date_local", "op_flight_num", haul.alias("haul"), *sums.columns[2:])


def load_factor_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seats taken and offered by month, flight, cabin, haul and carrier; every seventh flight still has its former carrier's code."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = li.filter(F.col("l_suppkey") % 10 != 0).join(od, li.l_orderkey == od.o_orderkey)
    sk = F.col("l_suppkey")
    cabin = (F.when(F.col("l_returnflag") == "A", "Business").when(F.col("l_returnflag") == "N", "Premium Economy")
             .otherwise("Economy"))
    carrier = (F.when(sk % 7 == 0, "I2").when(F.col("o_orderstatus") == "O", "IB").when(F.col("o_orderstatus") == "F", "YW")
               .otherwise("XX"))
    return (j.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("flight_month"),
                      sk.alias("surveyed_flight_number"), cabin.alias("cabin_in_surveyed_flight"),
                      F.when(sk % 3 == 0, "LH").when(sk % 3 == 1, "SH").otherwise("MH").alias("haul"),
                      carrier.alias("operating_airline_code"))
            .agg(F.sum("l_quantity").alias("pax"), (F.count(F.lit(1)) * 50).alias("capacity")))


def issues_dictionary(spark: SparkSession) -> DataFrame:
    """Issue code -> touchpoint dictionary (fixture; a few rows, broadcast-safe)."""
    rows = [("pfl_100_checkin", "iss_checkin_queue"), ("pfl_100_checkin", "iss_checkin_staff"),
            ("ifl_300_cabin", "iss_cabin_dirty"), ("ifl_600_wifi", "iss_wifi_slow")]
    return spark.createDataFrame(rows, "associated_touchpoint string, issue_type_2 string")
