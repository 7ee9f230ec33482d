"""Every registered query beside its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.check import compare, database  # noqa: E402

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
# minutes of sequential MLlib fits; test_models.py covers the same code with fewer rounds
LONG = {"boosted_trees", "margin_classifier", "cv_tuning", "refit_best", "linear_search", "linear_refit",
        "pipeline"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, connection, name):
    frame = QUERIES[name](spark, sf_dir)
    assert compare(frame, frame.collect(), connection, ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - LONG))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    row = entry.entry(spark).first()
    assert 0.0 <= row["accuracy"] <= 1.0
    assert row["accuracy"] == pytest.approx(row["recall_weighted"], abs=1e-6)
