"""Pairs exactly at a threshold that floating point can't hold."""

from fractions import Fraction

import pytest

from hazeline.llm.spotsigs import near_duplicates


@pytest.mark.parametrize("threshold,sizes", [(0.55, (16, 15, 11)), (0.7, (9, 8, 7)), (0.07, (54, 53, 7))])
def test_pairs_at_the_threshold_are_found(spark, threshold, sizes):
    a, b, common = sizes
    assert Fraction(common, a + b - common) == Fraction(str(threshold))
    spots = [f"the a{i} b{i}" for i in range(a + b - common)]
    rows = [(1, " ".join(spots[:a])), (2, " ".join(spots[a - common:])), (3, "of other words")]
    members, pairs = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold)
    assert [(r.a, r.b) for r in pairs.collect()] == [(1, 2)] and members.count() == 3
    above = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold + 0.001)[1]
    assert above.count() == 0
