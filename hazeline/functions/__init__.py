"""Column-level helpers: built-in expressions only, all inside codegen."""

from hazeline.functions.address import district_of
from hazeline.functions.dates import (date_part_strings, dmy_to_date, dmy_to_iso,
                                      int_part, parse_measured)
from hazeline.functions.safe import (pairwise_corr, to_double,
                                     unify_null)

__all__ = ["district_of", "date_part_strings", "dmy_to_date", "dmy_to_iso",
           "int_part", "parse_measured", "exact_mean", "pairwise_corr",
           "to_double", "unify_null"]
