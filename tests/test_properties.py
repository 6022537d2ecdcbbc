"""Property tests: metrics agree with the confusion cells and with a brute-force count."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from attrition.operators import metrics as me

pairs = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), min_size=0, max_size=40)


def brute(rows):
    tp = sum(1 for a, p in rows if a == 1 and p == 1)
    fp = sum(1 for a, p in rows if a == 0 and p == 1)
    fn = sum(1 for a, p in rows if a == 1 and p == 0)
    tn = sum(1 for a, p in rows if a == 0 and p == 0)

    def div(x, y):
        return x / y if y else 0.0

    return {"accuracy": div(tp + tn, len(rows)), "precision": div(tp, tp + fp), "recall": div(tp, tp + fn),
            "f1": div(2 * tp, 2 * tp + fp + fn), "cells": {(1, 1): tp, (0, 1): fp, (1, 0): fn, (0, 0): tn}}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=pairs)
def test_metrics_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "actual long, predicted long")
    exp = brute(rows)
    m = me.class_metrics(df).first()
    for k in ("accuracy", "precision", "recall", "f1"):
        assert abs(m[k] - exp[k]) < 1e-12
    cells = {(r["actual"], r["predicted"]): r["count"] for r in me.confusion(df).collect()}
    assert cells == exp["cells"]
    rep = {r["label"]: r for r in me.class_report(df).collect()}
    assert rep["1"]["support"] == exp["cells"][(1, 1)] + exp["cells"][(1, 0)]
    assert abs(rep["accuracy"]["f1"] - exp["accuracy"]) < 1e-12
