"""Registered queries: splits, folds, class balance, metrics and the gate
(inventory §2.10 M1-M3, M9, M11; §2.5 A22-A24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators import metrics as M
from satlens.operators import split as SP
from satlens.plans.oracle_base import MODEL, SCORED
from satlens.plans.registry import Inputs, register, rounded

_Y = "CAST(year(date_flight_local) AS INTEGER)"


def _rank_sql(strata: str, seed) -> str:
    h = f"md5(CAST(respondent_id AS VARCHAR) || '-{seed}')"
    return (f"row_number() OVER (PARTITION BY {strata} ORDER BY {h}, respondent_id) AS rk, "
            f"count(*) OVER (PARTITION BY {strata}) AS n")


def _split_sql(src: str, strata: str, seed, test: float, val: float, cols: str = "respondent_id") -> str:
    nt = f"ceil(n * {test})"
    nv = f"ceil((n - {nt}) * {val})" if val else "0"
    return (f", ranked AS (SELECT *, {_rank_sql(strata, seed)} FROM {src}),\n"
            f"splitted AS (SELECT *, CASE WHEN rk <= {nt} THEN 'test' WHEN rk <= {nt} + {nv} THEN 'val' "
            f"ELSE 'train' END AS split FROM ranked)\n")


@register("split_stratified", MODEL + f", src AS (SELECT *, {_Y} AS year FROM model_input)"
          + _split_sql("src", "year", 0, 0.2, 0.2) + "SELECT respondent_id, split FROM splitted")
def q_split_stratified(x: Inputs):
    m = x.model_input.withColumn("year", F.year(C.DATE))
    return SP.split_stratified(m, ["year"], 0.2, 0.2, seed=0).select(C.ID, "split")


@register("split_80_20", MODEL + ", src AS (SELECT * FROM model_input)"
          + _split_sql("src", "promoter_binary", 42, 0.2, 0.0) + "SELECT respondent_id, split FROM splitted")
def q_split_80_20(x: Inputs):
    return SP.split_stratified(x.model_input, [C.PROMOTER], 0.2, 0.0, seed=42).select(C.ID, "split")


@register("kfold_ids", MODEL + f"""
, ranked AS (SELECT *, {_rank_sql('promoter_binary', 1)} FROM model_input)
SELECT respondent_id, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM ranked""")
def q_kfold_ids(x: Inputs):
    return SP.kfold_ids(x.model_input, 5, [C.PROMOTER], seed=1).select(C.ID, "fold")


@register("class_weights", MODEL + """
, c AS (SELECT promoter_binary, count(*) AS c FROM model_input GROUP BY ALL),
w AS (SELECT promoter_binary, (SELECT max(c) FROM c) / c AS weight FROM c)
SELECT m.promoter_binary, round(w.weight, 6) AS weight, count(*) AS n
FROM model_input m JOIN w USING (promoter_binary) GROUP BY ALL""")
def q_class_weights(x: Inputs):
    t = SP.class_weights(x.model_input.select(C.ID, C.PROMOTER), C.PROMOTER)
    return rounded(t.groupBy(C.PROMOTER, "weight").agg(F.count(F.lit(1)).alias("n")))


@register("undersample", MODEL + f"""
, ranked AS (SELECT *, {_rank_sql('promoter_binary', 0)} FROM model_input),
lim AS (SELECT min(n) AS lo, max(n) AS hi FROM (SELECT DISTINCT promoter_binary, n FROM ranked))
SELECT promoter_binary, round(CASE WHEN n = lo THEN hi / lo ELSE 1.0 END, 6) AS weight, count(*) AS n
FROM ranked, lim WHERE rk <= lo GROUP BY ALL""")
def q_undersample(x: Inputs):
    t = SP.undersample(x.model_input.select(C.ID, C.PROMOTER), C.PROMOTER, seed=0)
    return rounded(t.groupBy(C.PROMOTER, "weight").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------ metrics
_EVAL = (SCORED + f", src AS (SELECT *, {_Y} AS year FROM scored_nps)" + _split_sql("src", "year", 0, 0.2, 0.2)
         + ", ev AS (SELECT split, cabin_in_surveyed_flight, haul, promoter_binary AS y, out_prob_prom AS s FROM splitted)\n")


def _metrics_sql(group: str) -> str:
    g = f"{group}, " if group else ""
    pg = f"PARTITION BY {group}" if group else ""
    pg2 = f"PARTITION BY {group}, s" if group else "PARTITION BY s"
    return f""", conf AS (SELECT {g} count_if(s > 0.5 AND y = 1) AS tp, count_if(s > 0.5 AND y <> 1) AS fp,
  count_if(NOT (s > 0.5) AND y = 1) AS fn, count_if(NOT (s > 0.5) AND y <> 1) AS tn FROM ev {'GROUP BY ' + group if group else ''}),
rk AS (SELECT {g} y, rank() OVER ({pg} ORDER BY s) + (count(*) OVER ({pg2}) - 1) / 2.0 AS ar FROM ev),
au AS (SELECT {g} (sum(CASE WHEN y = 1 THEN ar ELSE 0 END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
          / nullif(count_if(y = 1) * count_if(y <> 1), 0)::DOUBLE AS auc FROM rk {'GROUP BY ' + group if group else ''})
SELECT {g} tp, fp, fn, tn,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1,
  round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0)::DOUBLE, 0), 6) AS accuracy,
  round(auc, 6) AS auc
FROM conf {'JOIN au USING (' + group + ')' if group else ', au'}"""


def _eval(x: Inputs):
    s = x.scored.withColumn("year", F.year(C.DATE))
    return SP.split_stratified(s, ["year"], 0.2, 0.2, seed=0)


@register("binary_metrics", _EVAL + _metrics_sql("split"))
def q_binary_metrics(x: Inputs):
    return rounded(M.binary_metrics(_eval(x), C.PROMOTER, "out_prob_prom", ["split"]))


@register("segment_metrics", _EVAL + _metrics_sql("split, cabin_in_surveyed_flight, haul"))
def q_segment_metrics(x: Inputs):
    return rounded(M.binary_metrics(_eval(x), C.PROMOTER, "out_prob_prom", ["split", C.CABIN, C.HAUL]))


@register("class_report", _EVAL + """
, c AS (SELECT split, count(*) AS n, count_if(y = 1) AS n_pos,
  count_if(s > 0.5 AND y = 1) AS tp, count_if(s > 0.5 AND y <> 1) AS fp,
  count_if(NOT (s > 0.5) AND y = 1) AS fn, count_if(NOT (s > 0.5) AND y <> 1) AS tn,
  avg(CASE WHEN y = 1 THEN -ln(least(greatest(s, 1e-15), 1 - 1e-15)) ELSE -ln(1 - least(greatest(s, 1e-15), 1 - 1e-15)) END) AS ll
  FROM ev GROUP BY split),
d AS (SELECT *, n - n_pos AS n_neg,
  coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS p1, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS r1,
  coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p0, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r0,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f11, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0) AS f10
  FROM c)
SELECT split, n, round(n_pos / n * 100, 6) AS share_pos_pct, round(n_neg / n * 100, 6) AS share_neg_pct, tp, fp, fn, tn,
  round(coalesce((p0 * n_neg + p1 * n_pos) / nullif(n, 0), 0), 6) AS precision_weighted,
  round(coalesce((r0 * n_neg + r1 * n_pos) / nullif(n, 0), 0), 6) AS recall_weighted,
  round(coalesce((f10 * n_neg + f11 * n_pos) / nullif(n, 0), 0), 6) AS f1_weighted,
  round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN ll END, 6) AS log_loss
FROM d""")
def q_class_report(x: Inputs):
    return rounded(M.class_report(_eval(x), C.PROMOTER, "out_prob_prom", ["split"]))
