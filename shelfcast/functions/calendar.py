"""Calendar expressions of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sunday is day 1 of the week; "month end" starts on day 28.
WEEKEND_DAYS = (1, 7)
MONTH_END_FROM = 28


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def calendar_columns(date: Column) -> dict[str, Column]:
    """Calendar features by output name, for ``DataFrame.withColumns``."""
    day, dow = F.dayofmonth(date), F.dayofweek(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": day,
        "weekofyear": F.weekofyear(date),
        "dow": dow,
        "is_weekend": flag(dow.isin(*WEEKEND_DAYS)),
        "is_month_start": flag(day == 1),
        "is_month_end": flag(day >= MONTH_END_FROM),
    }
