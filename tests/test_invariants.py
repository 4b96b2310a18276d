"""Invariants on the landed driver tables."""

import math

from pyspark.sql import functions as F

from hazeline.operators.filters import cutoff_values
from hazeline.plans.common import cleaned, readings
from hazeline.schemas import MEASURES

SF = "/root/testdata/sf0.001"


def test_month_means_weighted_equal_total(spark):
    c = cleaned(spark, SF)
    per = (c.filter(F.col("district").isNotNull())
             .groupBy("district", "month")
             .agg(F.count("PM25").alias("n"), F.avg("PM25").alias("m")))
    w = per.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("w")).first().w
    total = c.filter(F.col("district").isNotNull()).agg(F.avg("PM25")).first()[0]
    assert math.isclose(w, total, rel_tol=1e-12)


def test_gold_is_band_of_silver(spark):
    s, g = readings(spark, SF), cleaned(spark, SF)
    assert g.join(s, "reading_id", "left_anti").count() == 0
    cut = cutoff_values(s, MEASURES)
    conds = [(F.col(m) >= cut[f"lo_{m}"]) & (F.col(m) < cut[f"hi_{m}"]) for m in MEASURES]
    ok = conds[0]
    for c in conds[1:]:
        ok = ok & c
    assert g.filter(~ok).count() == 0
    assert s.filter(ok).count() == g.count()
