"""Date arguments and the request formats of a window."""

from __future__ import annotations

import re
from calendar import monthrange
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Year, month and day of a date argument; years run from 1.
_DATE = r"(?!0000)([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})"


def parse_date_arg(value: str | None, name: str) -> date:
    """One driver-side date argument, by the column rule below."""
    match = re.fullmatch(_DATE, value or "")
    year, month, day = map(int, match.groups()) if match else (0, 0, 0)
    if 1 <= month <= 12 and 1 <= day <= monthrange(year, month)[1]:
        return date(year, month, day)
    raise ValueError(f"{name} must be a date like 2024-01-31, got {value!r}" if value else f"{name} is missing")


def parse_date(value: Column | str) -> Column:
    """DATE, or NULL where a date argument held in a column is no such date."""
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column.rlike(rf"\A{_DATE}\z"), F.try_to_date(column, "yyyy-M-d"))


def date_status(value: Column | str) -> Column:
    """'missing', 'malformed' or 'ok' for a date argument held in a column."""
    column = F.col(value) if isinstance(value, str) else value
    return (
        F.when(column.isNull() | (column == ""), "missing")
        .when(parse_date(column).isNull(), "malformed")
        .otherwise("ok")
    )


def day_param(value: Column | str) -> Column:
    """dd/MM/yyyy, the form the search takes."""
    return F.date_format(value, "dd/MM/yyyy")
