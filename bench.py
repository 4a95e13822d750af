"""Benchmark the headline plans on $BENCH_SF_DIR with local[$BENCH_CPUS].

Mirrors a production run: the ETL step writes the model input once (its
sink), the downstream steps read it back; every timed plan is fully executed
into a no-op sink (nothing is collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from satlens.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    mem = os.environ.get("BENCH_MEM", "4g")
    spark = get_session(f"local[{cpus}]", app="satlens-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": mem})

    from satlens.plans import catalog
    from satlens.plans.registry import QUERIES, Inputs
    catalog.load()

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}

    # JVM / executor warm-up on a synthetic range (not our plans; reported apart).
    t0 = time.time()
    spark.range(0, 5_000_000, numPartitions=cpus).selectExpr("sum(id * 2) AS s").collect()
    warmup = time.time() - t0

    # ETL step (survey + load factor -> model input) and the linear scoring
    # step each write their table once, like production; later plans read them.
    x = Inputs(spark, sf_dir)
    t0 = time.time()
    model_input = x.model_input
    timings["etl_model_input"] = time.time() - t0
    t0 = time.time()
    _ = x.scored
    timings["score_linear"] = time.time() - t0
    n_rows = model_input.count()
    rows["model_input"] = n_rows

    def inputs() -> Inputs:
        return x

    headline = ["nps_by_segment", "nps_weighted", "satisfaction", "explain_period", "explain_daily",
                "explain_yoy", "flip_negate", "mae_auto", "waterfall", "trust_verdict", "uncertainty_curve",
                "split_stratified", "binary_metrics", "quantiles"]
    for name in headline:
        t0 = time.time()
        run(QUERIES[name].build(inputs()))
        timings[name] = time.time() - t0

    # Model step: fit the promoter / detractor pair, then score + explain.
    from satlens import config as C
    from satlens.operators import models
    from satlens.operators import trees as TR
    from satlens.operators.treeshap import tree_shap
    from satlens.plans.q_ml import QUERY_GBT
    from satlens.plans.scoring import predict_and_explain
    t0 = time.time()
    fitted = models.train_pair(model_input, params=QUERY_GBT)
    pair = {lab: TR.read_trees(spark, m) for lab, m in fitted.items()}
    timings["train_pair"] = time.time() - t0
    t0 = time.time()
    run(tree_shap(model_input, pair[C.PROMOTER], C.FEATURES, "_prom"))
    timings["tree_shap"] = time.time() - t0
    t0 = time.time()
    run(TR.virtual_ensemble(model_input, pair[C.PROMOTER], C.FEATURES, 2, "_prom"))
    timings["virtual_ensemble"] = time.time() - t0
    t0 = time.time()
    run(predict_and_explain(model_input, pair[C.PROMOTER], pair[C.DETRACTOR]))
    timings["predict_explain"] = time.time() - t0

    total = sum(timings.values())
    out = {
        "metric": "headline_plans_wall_time",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "rows_per_sec": {"tree_shap": round(n_rows / timings["tree_shap"], 1),
                         "predict_explain": round(n_rows / timings["predict_explain"], 1)},
        "rows": rows,
        "warmup_sec": round(warmup, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
