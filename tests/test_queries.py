"""Every registered query next to its check SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from flowlens.plans import catalog
from tools.check_queries import compare, oracle_connection

# These train five models with the full settings; test_training.py trains smaller ones.
TRAINING = {"model_status", "model_scores", "model_proba", "score_confidence", "detect_ml",
            "feature_importance", "model_roundtrip", "cross_validation", "model_comparison",
            "pipe_train_evaluate", "model_scores_hold", "model_proba_hold", "detect_ml_hold", "feature_importance_hold",
            "cross_validation_hold", "model_comparison_hold", "pipe_train_evaluate_hold"}


@pytest.fixture(scope="module")
def tables(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in TRAINING])
def test_query_matches_sql(spark, sf, tables, name):
    assert compare(spark, tables, catalog.QUERIES[name], catalog.ORACLES.get(name), sf) is None


def test_every_other_query_has_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) <= TRAINING
    assert catalog.QUERIES.items() <= entry.queries().items() and catalog.ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() == 38 + 38 + 37 + 1
