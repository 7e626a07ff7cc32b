"""Verbal bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Half-open bands [low, high). A correlation of exactly 1.0 lies in
# none of them and is reported with the fallback, like every other leftover.
CORR_BANDS = (
    (0.7, 1.0, "strong positive"),
    (0.3, 0.7, "moderate positive"),
    (-0.3, 0.3, "weak"),
    (-0.7, -0.3, "moderate negative"),
    (-1.0, -0.7, "strong negative"),
)
CORR_FALLBACK = "weak"
CORR_MISSING = "N/A"


def corr_band(c: Column) -> Column:
    """Name of the band a correlation falls into; NULL (or NaN) is not available."""
    band = F.when(c.isNull() | F.isnan(c), F.lit(CORR_MISSING))
    for low, high, name in CORR_BANDS:
        band = band.when((c >= low) & (c < high), F.lit(name))
    return band.otherwise(F.lit(CORR_FALLBACK))
