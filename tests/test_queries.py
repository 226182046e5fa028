"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES
from workload.verify import compare, open_database

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

# fitted models: rows only; kmeans_fit and forest_fit check what their rows must fulfil
MODELS = {"kmeans_regimes", "k_sweep", "rf_predictions", "feature_importance"}


@pytest.fixture(scope="module")
def db():
    return open_database(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    verdict = compare(spark, db, SF_DIR, QUERIES[name], ORACLE[name])
    assert verdict.startswith("ok"), verdict
    assert not verdict.startswith("ok: 0 rows")


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == MODELS and set(ORACLE) <= set(QUERIES)


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
