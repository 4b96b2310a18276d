"""The fitted-model queries (no SQL oracle) against brute force on sf0.001:
numpy least squares on the same training rows, R2 and hold-out predictions."""

import math

import numpy as np

from hazeline.operators import ml
from hazeline.plans.common import readings
from hazeline.plans.q_ml import FEATURES, LABEL

SF = "/root/testdata/sf0.001"


def _parts(spark):
    df = ml.hash_split(readings(spark, SF).select("reading_id", LABEL, *FEATURES), "reading_id")
    rows = [r for r in df.collect()
            if all(r[c] is not None for c in FEATURES) and r[LABEL] is not None]
    train = [r for r in rows if r.part == "train"]
    test = [r for r in rows if r.part == "test"]
    return train, test


def _lstsq(rows):
    a = np.array([[r[c] for c in FEATURES] + [1.0] for r in rows])
    y = np.array([r[LABEL] for r in rows])
    beta = np.linalg.lstsq(a, y, rcond=None)[0]
    return a, y, beta


def test_linear_fit_equals_least_squares(spark):
    from __spark_entry__ import queries
    got = {r.term: r.coefficient for r in queries()["linear_fit"](spark, SF).collect()}
    train, _ = _parts(spark)
    _, _, beta = _lstsq(train)
    for name, b in zip(FEATURES + ["intercept"], beta):
        assert math.isclose(got[name], b, rel_tol=1e-6, abs_tol=1e-9), name


def test_linear_r2_equals_brute_force(spark):
    from __spark_entry__ import queries
    r = queries()["linear_r2"](spark, SF).collect()[0]
    train, _ = _parts(spark)
    a, y, beta = _lstsq(train)
    res = y - a @ beta
    r2 = 1 - (res @ res) / ((y - y.mean()) @ (y - y.mean()))
    assert r.n == len(train)
    assert math.isclose(r.r2, r2, rel_tol=1e-9)
    assert math.isclose(r.rmse, math.sqrt((res @ res) / len(y)), rel_tol=1e-6)


def test_linear_predict_on_hold_out(spark):
    from __spark_entry__ import queries
    # reading_id is a line key that the driver data repeats, so compare the
    # sorted (key, prediction) pairs as multisets.
    got = sorted((r.reading_id, r.prediction)
                 for r in queries()["linear_predict"](spark, SF).collect())
    train, test = _parts(spark)
    _, _, beta = _lstsq(train)
    want = sorted((r.reading_id, float(np.array([r[c] for c in FEATURES] + [1.0]) @ beta))
                  for r in test)
    assert len(got) == len(want)                              # only the hold-out, all of it
    for (gk, gv), (wk, wv) in zip(got, want):
        assert gk == wk and math.isclose(gv, wv, rel_tol=1e-6, abs_tol=1e-6)
