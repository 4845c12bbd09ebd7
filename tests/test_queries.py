"""Every registered query against its SQL counterpart, and its plan against the house rules."""

import pytest

from check import compare
from conftest import SF
from millrace.queries import ORACLES, QUERIES

# models are fitted anew by each of these; test_models covers them on their own
MODEL_JOBS = {"m5_elbow", "m9_lifetime_value", "m10_calibration_curve", "m18_batch_inference",
              "m26_classifier_selection", "m27_propensity_scores", "m8_retention_model", "m16_text_classification"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for wasteful in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert wasteful not in plan
    assert compare(name, df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - MODEL_JOBS))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1


def test_each_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry():
    import __spark_entry__ as entry
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(ORACLES) <= set(oracles) <= set(queries)
    # what else is there belongs to the training-data part, which may be absent
    assert all(n == "pipeline" or n.startswith("op") for n in set(queries) - set(QUERIES))
