"""Registered queries against their SQL on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

from tabloom.plans.catalogue import QUERIES, SQL  # noqa: E402

QUICK = (
    "src_csv", "split_train_test", "split_stratified", "folds_kfold", "drop_redundant", "prof_cardinality", "prof_quantiles",
    "prof_full", "prof_text", "impute_median", "impute_mode", "scale_robust", "prep_build", "enc_target", "enc_frequency",
    "dt_components", "txt_tfidf", "met_macro", "roc_curve", "thr_optimize", "top_k_by_group", "sel_kbest_classif",
    "reg_ridge", "clf_gaussian_nb", "clf_knn", "ens_vote_hard",
)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 130


@pytest.mark.parametrize("name", QUICK)
def test_matches_sql(spark, sf, name):
    note = check.compare(QUERIES[name](spark, sf), check.connect(sf), SQL[name])
    assert note.startswith("ok"), note


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 11
    assert set(e.oracle_sql()) <= set(e.queries())
