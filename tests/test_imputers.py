"""Monthly imputers: the store, train and predict mode, and the one-pass fill against MLlib's own prediction."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from satlens.operators import imputers as I
from satlens.sources import models_store as S

PARAMS = {"maxIter": 4, "maxDepth": 2}


@pytest.fixture(scope="module")
def rows(spark):
    """Months 1 to 3; month 3 knows no price; a NULL month; NaN and NULL on both sides; a level only month 2 has."""
    rng, out = np.random.default_rng(3), []
    for i in range(240):
        month = None if i % 40 == 0 else 1 + i % 3
        a = None if i % 7 == 0 else math.nan if i % 11 == 0 else float(rng.integers(0, 9))
        seat = None if i % 13 == 0 else "x" if i % 2 else "y" if month != 2 else "z"
        price = None if month == 3 or i % 5 == 0 else math.nan if i % 17 == 0 else float(rng.integers(50, 90))
        out.append((i, month, a, None if month == 1 else float(i % 4), seat, price))
    return spark.createDataFrame(out, "id long, month int, a double, b double, seat string, price double")


def filled(df):
    return {r["id"]: (r["price_imputed"], r["imputer_version"]) for r in df.collect()}


def test_train_equals_predict_and_mllib(spark, rows, tmp_path):
    root = f"{tmp_path}/store"
    fitted = I.fit_months(rows, "price", ["a", "b"], ["seat"], params=PARAMS)
    assert sorted(fitted) == [1, 2]
    trained = filled(I.train_and_fill(rows, root, "2000-01-01", "price", ["a", "b"], ["seat"], params=PARAMS))
    assert trained == filled(I.predict_and_fill(rows, root, "2000-02-01", "price")) and len(trained) == 240
    data = rows.collect()
    for m in (1, 2):
        known = [r for r in data if r["month"] == m and r["price"] is not None and not math.isnan(r["price"])]
        about, model = fitted[m]
        for f, median in zip(("a", "b"), about.medians):
            values = [r[f] for r in known if r[f] is not None and not math.isnan(r[f])]
            assert median == (np.median(values) if values else 0.0)
        assert [tuple(lv) for lv in about.levels] == [("seat", v) for v in sorted({r["seat"] for r in known if r["seat"]})]
    for r in data:
        got, version = trained[r["id"]]
        if r["price"] is not None and not math.isnan(r["price"]):
            assert got == r["price"] and version is None
        elif r["month"] not in (1, 2):
            assert got is None and version is None
        else:
            about, model = fitted[r["month"]]
            x = [med if r[f] is None or math.isnan(r[f]) else r[f] for f, med in zip(about.numeric, about.medians)]
            x += [float(r["seat"] == v) for _, v in about.levels]
            assert got == pytest.approx(model.predict(Vectors.dense(x)), abs=1e-9) and version == "2000-01-01"


def test_versions_by_month_and_day(spark, rows, tmp_path):
    root = f"{tmp_path}/store"
    both = I.fit_months(rows, "price", ["a"], ["seat"], params=PARAMS)
    I.save_months(spark, root, "2000-01-01", both)
    I.save_months(spark, root, "2000-06-01", {1: both[1]})
    used = lambda day: {i.about.month: i.version for i in I.load_months(spark, root, day)}
    assert used("1999-12-31") == {} and used("2000-01-01") == {1: "2000-01-01", 2: "2000-01-01"}
    assert used("2000-07-01") == {1: "2000-06-01", 2: "2000-01-01"}
    before = I.predict_and_fill(rows, root, "1999-12-31", "price")
    assert before.where(~F.col("price_imputed").eqNullSafe(I.number("price"))).count() == 0
    with pytest.raises(RuntimeError):  # killed while writing, also while writing a version again
        with S.ready_version(spark, root, I.month_folder(1), "2000-06-01"):
            raise RuntimeError("lost")
    assert used("2000-07-01") == {1: "2000-01-01", 2: "2000-01-01"}


def test_empty_table_and_unknown_levels(spark, rows, tmp_path):
    root = f"{tmp_path}/store"
    assert I.train_and_fill(rows.limit(0), root, "2000-01-01", "price", ["a"], ["seat"]).count() == 0
    I.save_months(spark, root, "2000-01-01", I.fit_months(rows, "price", ["a"], ["seat"], params=PARAMS))
    new = spark.createDataFrame([(1, 1, None, "never seen", None), (2, 1, None, None, None)], "id long, month int, a double, seat string, price double")
    got = filled(I.predict_and_fill(new, root, "2000-01-01", "price"))
    assert got[1] == got[2] and got[1][0] is not None


def test_registered_query(spark, inputs):
    from satlens.plans.q_ml import q_impute_gbt
    got = {(r["as_of"], r["month"]): r for r in q_impute_gbt(inputs).collect()}
    assert len(got) == 24 and all(r["n_filled"] == r["n"] > r["n_known"] for r in got.values())
    assert {r["imputer_version"] for (day, m), r in got.items() if day < "2000"} == {"1997-12-31"}
    assert all(r["imputer_version"] == ("2000-06-30" if m <= 6 else "1997-12-31") for (day, m), r in got.items() if day > "2000")
