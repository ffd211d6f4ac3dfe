"""Column expressions over a date."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; unreadable text gives null."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def date_parts(d: Column) -> dict[str, Column]:
    """The eight calendar features of the feature table; Monday is 0."""
    return {
        "day_of_week": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "is_weekend": _flag(F.weekday(d) >= 5),
        "is_month_start": _flag(F.dayofmonth(d) == 1),
        "is_month_end": _flag(d == F.last_day(d)),
    }


def boundary_flags(d: Column) -> dict[str, Column]:
    following = F.date_add(d, 1)
    flags: dict[str, Column] = {}
    for unit in ("quarter", "year"):
        flags[f"is_{unit}_start"] = _flag(d == F.trunc(d, unit))
        flags[f"is_{unit}_end"] = _flag(following == F.trunc(following, unit))
    return flags


def cyclical(d: Column) -> dict[str, Column]:
    """Position on the week, month and year circle."""
    turns = {
        "day_of_week": F.weekday(d) / F.lit(7.0),
        "day_of_month": F.dayofmonth(d) / F.lit(31.0),
        "month": F.month(d) / F.lit(12.0),
    }
    out: dict[str, Column] = {}
    for name, turn in turns.items():
        out[f"{name}_sin"] = F.sin(turn * (2 * math.pi))
        out[f"{name}_cos"] = F.cos(turn * (2 * math.pi))
    return out


def day_of_year(d: Column) -> Column:
    return F.dayofyear(d)


def weekday_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def expand_datetimes(df: DataFrame) -> DataFrame:
    """Replace every date or timestamp column by its year, month, day and weekday."""
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    columns: list[Column] = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if not isinstance(field.dataType, moments):
            columns.append(col)
            continue
        for part, expr in (
            ("year", F.year(col)),
            ("month", F.month(col)),
            ("day", F.dayofmonth(col)),
            ("dayofweek", F.weekday(col)),
        ):
            columns.append(expr.alias(f"{field.name}_{part}"))
    return df.select(*columns)
