"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "prof_full", "prof_cardinality", "prof_quantiles", "prof_outlier_ratio", "prof_text", "drop_redundant",
    "split_stratified", "folds_kfold", "impute_median", "impute_mode", "scale_standard", "scale_robust", "tf_yeo_johnson",
    "prep_build", "enc_onehot_nominal", "enc_target", "enc_leave_one_out", "enc_frequency", "txt_tfidf",
    "met_classification", "met_roc_auc", "thr_optimize", "top_k_by_group", "sel_kbest_classif", "reg_ridge",
    "clf_gaussian_nb", "clf_logistic_l2", "clf_decision_tree",
)


def main() -> None:
    from tabloom.plans.catalogue import QUERIES
    from tabloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
