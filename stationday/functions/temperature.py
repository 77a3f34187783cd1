"""Daily temperature functions.

All three are plain Column expressions: Catalyst folds them into the
projection, they stay inside whole-stage codegen and no Python worker is
started on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the reference's for identical results.
# Normal ranges (inclusive) of the outlier test, in degrees Fahrenheit.
TMAX_RANGE = (68.0, 104.0)
TMIN_RANGE = (14.0, 59.0)
# The four labels, in the order the test applies them.
OUTLIER_LABELS = (
    "Both TMAX and TMIN are outliers",
    "TMAX is an outlier",
    "TMIN is an outlier",
    "Neither TMAX nor TMIN is an outlier",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def avg_temp(tmax, tmin) -> Column:
    """(tmax + tmin) / 2; NULL when either input is NULL (UF1)."""
    return (_c(tmax) + _c(tmin)) / F.lit(2.0)


def temp_change(tmax, tmin) -> Column:
    """tmax - tmin, may be negative; NULL when either input is NULL (UF2)."""
    return _c(tmax).cast("double") - _c(tmin).cast("double")


def outlier_label(tmax, tmin, tmax_range=TMAX_RANGE, tmin_range=TMIN_RANGE) -> Column:
    """One of four labels saying which of tmax / tmin lies outside its range (UF3).

    Bounds are included in the normal range. NULL in either input gives NULL;
    NaN counts as outside (Spark orders NaN above every number).
    """
    tmax, tmin = _c(tmax), _c(tmin)
    tmax_out = ~tmax.between(F.lit(float(tmax_range[0])), F.lit(float(tmax_range[1])))
    tmin_out = ~tmin.between(F.lit(float(tmin_range[0])), F.lit(float(tmin_range[1])))
    both, only_max, only_min, neither = OUTLIER_LABELS
    return (
        F.when(tmax.isNull() | tmin.isNull(), F.lit(None).cast("string"))
        .when(tmax_out & tmin_out, F.lit(both))
        .when(tmax_out, F.lit(only_max))
        .when(tmin_out, F.lit(only_min))
        .otherwise(F.lit(neither))
    )
