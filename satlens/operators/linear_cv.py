"""Cross-validated logistic regression, the linear alternative (section 2.10 M19, M20).

Each fold's pipeline (median imputation, then the fit) sees the other folds only, so
neither medians nor coefficients leak.  A held-out row is scored by its fold's
coefficients as one column expression; the folds' mean model feeds the linear explanation.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens.functions.scalar import inv_logit
from satlens.operators.models import logistic


@dataclass
class LinearModel:
    intercept: float
    weights: dict[str, float]
    fills: dict[str, float]  # medians of the rows fitted on

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for f, w in self.weights.items():
            x = F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
            out = out + F.lit(w) * F.coalesce(x, F.lit(self.fills[f]))
        return out


def read_pipeline(model, features: Sequence[str]) -> LinearModel:
    imputer, _, lr = model.stages
    medians = imputer.surrogateDF.first()  # one row, a column a feature
    return LinearModel(float(lr.intercept), {f: float(w) for f, w in zip(features, lr.coefficients)}, {f: float(medians[f]) for f in features})


def cross_validate_lr(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold", k: int = 5, reg: float = 0.0) -> list[LinearModel]:
    """The model of every fold 0..k-1, fitted on the rows of the others."""
    data = df.select(*features, label, F.col(fold_col).alias("__fold")).cache()
    try:
        with ThreadPoolExecutor(max_workers=4) as pool:
            return list(pool.map(lambda i: read_pipeline(logistic(data.where(F.col("__fold") != i), features, label, reg), features), range(k)))
    finally:
        data.unpersist()


def held_out(df: DataFrame, folds: Sequence[LinearModel], out: str, fold_col: str = "fold") -> DataFrame:
    """``df`` with the probability by the model that did not see the row; NULL without a fold."""
    p = F.lit(None).cast("double")
    for i, m in enumerate(folds):
        p = F.when(F.col(fold_col) == i, inv_logit(m.margin())).otherwise(p)
    return df.withColumn(out, p)


def mean_model(folds: Sequence[LinearModel]) -> LinearModel:
    """Intercept, coefficients and fills averaged over the folds."""
    n = len(folds)
    return LinearModel(sum(m.intercept for m in folds) / n, {f: sum(m.weights[f] for m in folds) / n for f in folds[0].weights},
                       {f: sum(m.fills[f] for m in folds) / n for f in folds[0].fills})
