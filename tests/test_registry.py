"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, name):
    assert compare(spark, FOLDER, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


WITHOUT_BROADCAST = [
    "build_dataset", "sample_n_per_class", "erase_n", "head_n_per_class", "random_split_exact", "class_folds", "seq_split",
    "sigma_filter", "profile", "phase_split", "extend_one", "knn1", "quarantine_files", "erase_windows",
]


@pytest.mark.parametrize("name", WITHOUT_BROADCAST)
def test_query_equals_sql_without_broadcasts(spark, monkeypatch, name):
    """Lookup tables that are too large to broadcast must lead to the same rows."""
    monkeypatch.setattr("trackframe.session.MAX_BROADCAST_BYTES", -1)
    assert compare(spark, FOLDER, entry.queries()[name], entry.oracle_sql()[name]) is None
