"""District from a comma-separated address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the district is the third comma-separated field.
DISTRICT_FIELD = 2  # zero-based


def district_of(address: Column | str, field: int = DISTRICT_FIELD) -> Column:
    """Trimmed field of the address; NULL when the address is shorter
    (``get`` instead of ``getItem``, which raises under ANSI)."""
    address = F.col(address) if isinstance(address, str) else address
    return F.trim(F.get(F.split(address, ","), F.lit(field)))
