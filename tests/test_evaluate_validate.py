from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourloom.operators import evaluate
from hourloom.operators.validate import validation_gate
from tests.helpers import rows


def frame(spark, pairs, k="m"):
    data = [(k, i, float(y), float(p)) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(data, "k string, row_id long, y_true double, y_pred double")


GOOD = [(1, 1.1), (2, 1.9), (3, 3.1), (4, 3.9)]


def ids(spark, name, k="m"):
    return spark.createDataFrame([(k, name)], "k string, model_id string")


def test_a_good_model_is_safe(spark):
    got = validation_gate(frame(spark, GOOD), ids(spark, "reg_mae0.1000"), ["k"]).first()
    assert got.success and got.mae_matches and got.issues == []
    assert got.recommendation == "SAFE FOR PRODUCTION"
    assert got.mae == pytest.approx(0.1) and got.expected_mae == 0.1


def test_without_series_the_gate_is_one_row(spark):
    claimed = spark.createDataFrame([("x_mae_0.12",)], "model_id string")
    runs = evaluate.stack_runs([frame(spark, GOOD).drop("k")] * 2)
    got = validation_gate(frame(spark, GOOD).drop("k"), claimed, runs=runs).collect()
    assert len(got) == 1
    assert (got[0].expected_mae, got[0].mae_matches, got[0].max_std, got[0].inconsistent) == (0.12, False, 0.0, False)


@pytest.mark.parametrize("claim", ["no_metric", "mae0", None])
def test_absent_or_zero_claims_never_match(spark, claim):
    model_ids = None if claim is None else ids(spark, claim)
    got = validation_gate(frame(spark, [(1, 1), (2, 2)]), model_ids, ["k"]).first()
    assert got.mae == 0 and not got.mae_matches
    assert got.expected_mae == (0.0 if claim == "mae0" else None)


def test_issue_texts(spark):
    low = validation_gate(frame(spark, [(1, -1), (2, 0), (3, 1), (9, 2)]), None, ["k"]).first()
    assert low.issues == [
        "Negative predictions (1/4)",
        "Prediction range much smaller than true range",
        "Systematic bias detected (mean residual: 3.2500)",
    ]
    assert low.recommendation == "USE WITH CAUTION" and low.success
    wide = validation_gate(frame(spark, [(5, 0), (5, 10), (6, 6), (5, 5)]), None, ["k"]).first()
    assert wide.issues == ["Prediction range much larger than true range"]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf")])
def test_values_that_are_not_finite_stop_the_validation(spark, bad):
    got = validation_gate(frame(spark, [*GOOD, (1, bad)]), ids(spark, "mae0.1"), ["k"]).first()
    assert (got.success, got.mae, got.r2, got.issues, got.recommendation) == (False, None, None, [], "UNKNOWN")
    assert got.expected_mae == 0.1 and not got.mae_matches


def test_range_is_judged_by_one_rule_only(spark):
    checked = evaluate.range_check(frame(spark, [(0, 0), (1, 2)]))
    assert tuple(checked.first()) == (2.0, 1.0, False, False)
    assert evaluate.range_check(frame(spark, [(0, 0), (1, 2.1)])).first().too_wide
    assert evaluate.range_check(frame(spark, [(0, 0), (1, 0.4)])).first().too_narrow


def test_residuals_and_counts(spark):
    df = frame(spark, [(1, 0.5), (2, 2.5), (3, float("nan"))])
    assert tuple(evaluate.residual_profile(df.where("row_id < 2")).first()) == (0.0, 0.5, False)
    assert rows(evaluate.issue_counts(df, ["k"])) == [("m", 3, 1, 0, 0)]


def test_repeatability_flags_a_spread(spark):
    base = frame(spark, GOOD)
    moved = base.withColumn("y_pred", F.col("y_pred") + F.when(F.col("row_id") == 2, 0.01).otherwise(0.0))
    steady = evaluate.repeatability(evaluate.stack_runs([base] * 5), by=["k"]).first()
    assert (steady.max_std, steady.inconsistent) == (0.0, False)
    shaky = evaluate.repeatability(evaluate.stack_runs([base, base, base, base, moved]), by=["k"]).first()
    assert shaky.max_std == pytest.approx(0.004) and shaky.inconsistent
    gate = validation_gate(base, None, ["k"], evaluate.stack_runs([base, moved])).first()
    assert gate.inconsistent and gate.recommendation == "SAFE FOR PRODUCTION"


def test_alignment_cuts_to_the_shorter_side(spark):
    both = frame(spark, GOOD)
    got = evaluate.align(both.select("k", "row_id", "y_true"), both.where("row_id < 3").select("k", "row_id", "y_pred"), by=["k"])
    assert got.count() == 3
    assert evaluate.regression_metrics(got).first().rows == 3


def test_missing_groups_keep_their_claim_and_ids_are_single(spark):
    df = frame(spark, GOOD, None).unionByName(frame(spark, GOOD, "m"))
    both = ids(spark, "mae0.1", None).unionByName(ids(spark, "mae0.1", "m"))
    assert {(r.k, r.mae_matches) for r in validation_gate(df, both, ["k"]).collect()} == {(None, True), ("m", True)}
    with pytest.raises(Exception, match="several model ids"):
        validation_gate(df, both.unionByName(ids(spark, "mae0.2", "m")), ["k"]).collect()


def test_metrics_need_finite_values(spark):
    bad = evaluate.usable_metrics(frame(spark, [*GOOD, (1, float("nan"))])).first()
    none = evaluate.usable_metrics(frame(spark, GOOD).where("row_id < 0")).first()
    assert (bad.rows, bad.mae, bad.r2) == (5, None, None) and (none.rows, none.mae) == (0, None)
