"""Scoring plans: deterministic linear scoring (checkable by SQL) and the
model-based predict-and-explain composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators.contributions import linear_contributions, nps_merge, to_probability

# Fixture model (FIXTURES B3): promoter log-odds linear in three touchpoints,
# detractor = -0.5 x promoter; missing wifi answers count as 0.
LINEAR_WEIGHTS = {"pfl_100_checkin": 0.30, "ifl_300_cabin": 0.20, "ifl_600_wifi": 0.05}
LINEAR_FILL = {"ifl_600_wifi": 0.0}
LINEAR_BASE_PROM = -1.0
LINEAR_BASE_DET = -0.5
DET_FACTOR = -0.5


def linear_contribution_table(model_input: DataFrame, features=C.FEATURES) -> DataFrame:
    """Log-odds contributions for both labels plus stand-in uncertainties."""
    p = linear_contributions(model_input, LINEAR_WEIGHTS, "_prom", base_value=LINEAR_BASE_PROM,
                             fill=LINEAR_FILL, features=features)
    det_cols = {f"{f}_det": F.col(f"{f}_prom") * F.lit(DET_FACTOR) for f in features}
    p = p.withColumns(det_cols).withColumn("base_value_det", F.lit(LINEAR_BASE_DET))
    det_total = sum((F.col(f"{f}_det") for f in features), F.col("base_value_det"))
    p = p.withColumns({
        "out_value_det": det_total,
        "out_prob_det": F.lit(1.0) / (F.lit(1.0) + F.exp(-det_total)),
        "uncertainty_prom": F.lit(0.01) + (F.col(C.ID) % 50) / F.lit(1000.0),
        "uncertainty_det": F.lit(0.01) + (F.col(C.ID) % 40) / F.lit(1000.0),
    })
    return p


def linear_scored(model_input: DataFrame, features=C.FEATURES) -> DataFrame:
    """model input + probability-scale NPS contributions (the ``scored`` table)."""
    t = linear_contribution_table(model_input, features)
    t = to_probability(t, features, "_prom")
    t = to_probability(t, features, "_det")
    return nps_merge(t, features)



# ---------------------------------------------------------------------------
# Model-based scoring (MLlib GBT pair)
# ---------------------------------------------------------------------------
def predict_and_explain(df: DataFrame, trees_prom, trees_det, features=C.FEATURES,
                        step: int = C.ENSEMBLE_STEP, lineage: dict | None = None) -> DataFrame:
    """Score every row with both classifiers and explain it.

    Tree SHAP and the virtual ensemble of both labels come from one Arrow pass
    (columns pass through); then the probability-scale rescale, the promoter -
    detractor merge and lineage columns.  Narrow plan: no shuffle.
    """
    from satlens.operators.treeshap import explain_many

    t = nps_columns(explain_many(df, {"_prom": trees_prom, "_det": trees_det}, features, ensemble_step=step), features)
    for k, v in (lineage or {}).items():
        t = t.withColumn(k, F.lit(v))
    return t


def nps_columns(t: DataFrame, features=C.FEATURES) -> DataFrame:
    """Probabilities, contributions in probability units and the promoter - detractor merge of explained rows."""
    from satlens.functions.scalar import inv_logit

    t = t.withColumns({"out_prob_prom": inv_logit(F.col("out_value_prom")),
                       "out_prob_det": inv_logit(F.col("out_value_det"))})
    t = to_probability(t, features, "_prom")
    t = to_probability(t, features, "_det")
    return nps_merge(t, features)
