"""Date parsing and formatting as Column expressions.

Spark 4 runs with ANSI on, where ``to_date('', fmt)`` raises; the
``try_`` forms turn unparseable text into NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_compact_date(c: Column | str) -> Column:
    """'yyyyMMdd' text -> DATE; blank or malformed -> NULL.

    Text that is not eight digits is NULL without attempting a parse
    (a failed parse costs an exception per row)."""
    col = _col(c)
    return F.when(col.rlike("^[0-9]{8}$"), F.try_to_date(col, "yyyyMMdd"))


def recall_duration_days(initiation: Column | str, termination: Column | str, report: Column | str) -> Column:
    """Days from initiation to termination, or to the report date while open."""
    return F.datediff(F.coalesce(_col(termination), _col(report)), _col(initiation))


def recall_month(c: Column | str) -> Column:
    """'yyyy-MM' of a date."""
    return F.date_format(_col(c), "yyyy-MM")


def iso_date_text(c: Column | str) -> Column:
    """DATE / TIMESTAMP -> 'yyyy-MM-dd' text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def coerce_date(c: Column | str, data_type=None) -> Column:
    """Best-effort conversion of a column to DATE; unparseable -> NULL.

    Dates stay, timestamps are truncated, text is parsed as ISO date or
    timestamp ('yyyy-MM-dd', 'yyyy-MM-dd HH:mm:ss', ...).
    """
    col = _col(c)
    if isinstance(data_type, DateType):
        return col
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.to_date(col)
    text = col.cast(StringType()) if data_type is not None and not isinstance(data_type, StringType) else col
    return F.coalesce(F.try_to_date(text), F.to_date(F.try_to_timestamp(text)))


def to_date_literal(value) -> Column:
    """A 'yyyy-MM-dd' or 'yyyyMMdd' string (or date) as a DATE literal."""
    text = str(value).replace("-", "")
    return F.to_date(F.lit(text), "yyyyMMdd")
