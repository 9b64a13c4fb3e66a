"""Column helpers shared by the models. All are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tried in this order; text in none of these forms raises.
CLOCK_FORMATS = ("hh:mm a", "h:mm a", "HH:mm", "HH:mm:ss")


def quoted(name: str) -> str:
    """A column name that may hold dots, ready for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised(c: Column | str) -> Column:
    """Upper case without leading or trailing spaces (tabs stay)."""
    return F.trim(F.upper(_column(c)))


def day_of(c: Column | str, tolerant: bool = False) -> Column:
    """ISO text to DATE. Bad text raises, or gives NULL when ``tolerant``.

    The plain cast also takes one-digit months and days and, unlike a parse with a
    pattern, needs no formatter per row.
    """
    return _column(c).try_cast("date") if tolerant else _column(c).cast("date")


def year_month(c: Column | str, tolerant: bool = False) -> Column:
    return F.date_format(day_of(c, tolerant), "yyyy-MM")


def year_of(c: Column | str, tolerant: bool = False) -> Column:
    return F.year(day_of(c, tolerant))


def rounded(c: Column | str, scale: int = 2) -> Column:
    """Floating point to a decimal of ``scale`` places, halves away from zero.

    The value is first cut to 15 significant digits, as the conversion from double
    precision to numeric does in PostgreSQL: 2.3449999999999998 gives 2.35. That
    also takes out the noise of the order in which a distributed sum was added up.
    """
    digits = F.format_string("%.14e", _column(c).cast("double"))
    return F.round(F.when(_column(c).isNotNull(), digits).cast("decimal(38,10)"), scale)


def whole_number(c: Column | str, dtype: T.DataType) -> Column:
    """Cast to INT: text must be a whole number, numbers are rounded, not cut."""
    column = _column(c)
    if isinstance(dtype, T.StringType):
        return column.cast("int")
    if isinstance(dtype, T.DecimalType):
        return F.round(column, 0).cast("int")
    if isinstance(dtype, T.FractionalType):
        return F.rint(column).cast("int")
    return column.cast("int")


def clock(c: Column | str) -> Column:
    """Clock text, with or without AM and PM, as a time of one and the same day."""
    text = _column(c)
    *some, last = CLOCK_FORMATS
    tried = [F.try_to_timestamp(text, F.lit(form)) for form in some]
    return F.coalesce(*tried, F.to_timestamp(text, last))


def clock_diff(end: Column | str, start: Column | str) -> Column:
    """Interval between two clock texts of one day; no wrap past midnight."""
    return clock(end) - clock(start)


def clock_seconds(end: Column | str, start: Column | str) -> Column:
    """``clock_diff`` in whole seconds."""
    return F.unix_timestamp(clock(end)) - F.unix_timestamp(clock(start))
