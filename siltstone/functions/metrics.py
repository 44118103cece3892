"""Business metrics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def delay_days(eta: Column, arrival: Column) -> Column:
    """Days late, 0 if on time or early, NULL while in transit.

    ``greatest`` skips NULLs, so without the outer guard a shipment still in
    transit would count as on time.
    """
    return F.when(arrival.isNotNull(), F.greatest(F.datediff(arrival, eta), F.lit(0)))


def is_delayed(delay: Column, threshold_days: int) -> Column:
    """Strictly more than the threshold; False (never NULL) while in transit."""
    return F.coalesce(delay > threshold_days, F.lit(False))


def date_key(d: Column) -> Column:
    """DATE as the integer YYYYMMDD, NULL for NULL."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def days_until(d: Column, as_of: Column) -> Column:
    return F.datediff(d, as_of)


def expiry_status(days_left: Column, warning_days: int = 90) -> Column:
    return (
        F.when(days_left < 0, F.lit("Expired"))
        .when(days_left <= warning_days, F.lit(f"At Risk (within {warning_days} days)"))
        .otherwise(F.lit("OK"))
    )


def stock_status(quantity: Column, minimum: int, maximum: int) -> Column:
    return (
        F.when(quantity < minimum, F.lit("Below Min"))
        .when(quantity > maximum, F.lit("Above Max"))
        .otherwise(F.lit("OK"))
    )


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """``part / whole`` in percent, rounded half up; NULL when ``whole`` is 0."""
    ratio = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(ratio, places).cast("double")


def hours_since(ts: Column, as_of: Column) -> Column:
    """Hours from ``ts`` to ``as_of``, rounded to 2 places."""
    return F.round(F.timestamp_diff("MICROSECOND", ts, as_of) / F.lit(3.6e9), 2)


def within_freshness_window(hours: Column, max_age_hours: float) -> Column:
    return hours <= max_age_hours


def row_count_deviation_pct(today: Column, average: Column) -> Column:
    """Unsigned deviation from the average in percent, NULL without history."""
    return F.try_divide(F.abs(today - average), average) * 100


def within_deviation_tolerance(deviation: Column, threshold_pct: float) -> Column:
    return deviation <= threshold_pct
