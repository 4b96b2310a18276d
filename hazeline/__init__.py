"""hazeline: station-readings analytics as plain Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function over the public
PySpark API. Sessions are created by callers (tests, bench, the driver);
library code never creates one, never collects unbounded data and never
calls a Python UDF.

The names below are the public surface; see README.md for a worked example.
"""

from hazeline.functions import (district_of, dmy_to_date, dmy_to_iso,
                                pairwise_corr, parse_measured, to_double)
from hazeline.operators.aggregates import (histogram, max_all_numeric, mean_all_numeric,
                                           mean_by, measure_range, nonnull_count_by, profile)
from hazeline.operators.filters import cutoff_values, outlier_band, sigma_cutoff
from hazeline.operators.joins import boundary_join, row_aligned_join, series_join, with_ordinal
from hazeline.operators.quantiles import exact_quantiles
from hazeline.operators.stats import (corr_lower_triangle, corr_matrix, regression_lines,
                                      regression_residuals)
from hazeline.plans.readings import ingest
from hazeline.schemas import MEASURES

__all__ = [
    "MEASURES", "ingest", "outlier_band", "cutoff_values", "sigma_cutoff", "exact_quantiles",
    "mean_by", "mean_all_numeric", "max_all_numeric", "nonnull_count_by", "measure_range",
    "profile", "histogram", "corr_matrix", "corr_lower_triangle", "regression_lines",
    "regression_residuals", "boundary_join", "series_join", "row_aligned_join", "with_ordinal",
    "district_of", "dmy_to_date", "dmy_to_iso", "exact_mean", "pairwise_corr",
    "parse_measured", "to_double",
]
