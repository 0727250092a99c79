"""Every query with SQL must equal DuckDB on the same tables; a few others are checked by invariants."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("label", sorted(ORACLES))
def test_query_equals_sql(spark, con, label):
    assert differences(entry.queries()[label](spark, SF), con, ORACLES[label]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_classifier_beats_majority(spark):
    rows = {r["metric"]: r["value"] for r in entry.queries()["i1_classifier_metrics"](spark, SF).collect()}
    assert rows["roc_auc"] > 0.8 and rows["accuracy"] > 0.7


def test_power_transform_standardises(spark):
    row = entry.queries()["e3_power_transform"](spark, SF).first()
    assert abs(row["mean_l_extendedprice"]) < 1e-6 and abs(row["std_l_extendedprice"] - 1) < 1e-6


def test_outlier_share_is_near_contamination(spark):
    rows = {r["is_outlier"]: r["n"] for r in entry.queries()["l11_outliers"](spark, SF).collect()}
    assert 0.01 < rows[True] / sum(rows.values()) < 0.12


def test_stream_monitor_writes_history(spark):
    rows = entry.queries()["m3_stream_monitor"](spark, SF).orderBy("check_key").collect()
    assert len(rows) == 2 and [r["check_id"] for r in rows] == [1, 2]


def test_stream_scores_like_batch(spark):
    for row in entry.queries()["m2_stream_model_scoring"](spark, SF).collect():
        assert row["n_stream"] == row["n_batch"] and row["mean_stream"] == row["mean_batch"]
