"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(col: str | Column, formats=("dd/MM/yyyy", "yyyy-MM-dd")) -> Column:
    """First format that fits; text that fits none gives null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*(F.try_to_date(col, f) for f in formats))


def date_parts(col: str | Column) -> dict[str, Column]:
    """Day of week (Monday = 0), month, year and day of year."""
    return {"DayOfWeek": F.weekday(col), "Month": F.month(col), "Year": F.year(col), "DayOfYear": F.dayofyear(col)}


def unix_seconds(col: str | Column) -> Column:
    """Seconds from 1970-01-01 to the start of the day, whatever the session's time zone."""
    return F.unix_date(col).cast("bigint") * 86_400
