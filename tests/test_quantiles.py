"""Exact distributed quantiles against a sorted list."""

import math
import random

import pytest

from hazeline.operators.quantiles import exact_quantiles, rank_of
from hazeline.sources.inline import inline_rows


def _expected(vals, q):
    s = sorted(v for v in vals if v is not None)
    return s[rank_of(q, len(s)) - 1] if s else None


@pytest.mark.parametrize("max_collect,accuracy", [(20_000, 10_000), (50, 100), (7, 50)])
def test_exact_with_ties_and_hot_value(spark, max_collect, accuracy):
    random.seed(11)
    hot = [5.0] * 3000                                  # a third of the rows
    ties = [float(random.randint(0, 20)) for _ in range(3000)]
    cont = [random.random() * 100 for _ in range(3000)]
    nulls = [None] * 50
    rows = list(zip(hot + ties + cont + nulls, cont + hot + ties + nulls))
    random.shuffle(rows)
    df = inline_rows(spark, rows, "a double, b double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, ["a", "b"], qs, accuracy=accuracy, max_collect=max_collect)
    for c, col in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows])):
        for q in qs:
            assert got[(c, q)] == _expected(col, q), (c, q)


def test_all_null_and_single_value(spark):
    df = inline_rows(spark, [(None, 2.0), (None, 2.0)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.25])
    assert got[("a", 0.25)] is None and got[("b", 0.25)] == 2.0


def test_rank_rule():
    assert [rank_of(0.25, n) for n in (1, 4, 5, 8)] == [1, 1, 2, 2]
    assert rank_of(0.0, 10) == 1 and rank_of(1.0, 10) == 10
    assert rank_of(0.1, 30) == math.ceil(3)
