"""Calendar parts and day names. Weekdays count from 1 = Sunday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def calendar_parts(date: Column) -> dict[str, Column]:
    """year, month, weekday and the Saturday/Sunday flag of a date."""
    weekday = F.dayofweek(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "weekday": weekday,
        "is_weekend": weekday.isin(1, 7),
    }


def weekday_name(weekday: Column) -> Column:
    """Day name of a weekday number; null for a number outside 1 to 7."""
    return F.try_element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), weekday)


def full_date(text: Column) -> Column:
    """A date only from a whole ``y-m-d`` text; partial, padded or other texts give null."""
    whole = text.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z")
    return F.when(whole, text.try_cast("date"))
