"""Number, time and nested-field functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_or_zero(value: Column, strict: bool = True) -> Column:
    """Text number as bigint, 0 where missing; bad text fails unless ``strict`` is off."""
    number = value.cast("bigint") if strict else value.try_cast("bigint")
    return F.coalesce(number, F.lit(0).cast("bigint"))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def percentage(part: Column, total: Column) -> Column:
    """``(part / total) * 100`` in this order, 0 where the total is 0."""
    return F.when(total > 0, (part / total) * 100).otherwise(F.lit(0.0))


def one_decimal(value: Column) -> Column:
    return F.format_number(value, 1)


def two_decimals(value: Column) -> Column:
    return F.format_number(value, 2)


def with_thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def days_before(as_of: Column, days: int) -> Column:
    """ISO text of the time ``days`` before ``as_of``."""
    moment = as_of - F.make_dt_interval(days=F.lit(days))
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_time(value: Column) -> Column:
    """A timestamp as fixed-width ISO text, so that text order is time order."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_width(value: Column | str) -> Column:
    """ISO text with six digits of a second and a final Z, whatever fraction it has; text shorter
    than a full second stays as it is."""
    c = F.col(value) if isinstance(value, str) else value
    fraction = F.rpad(F.substring(F.regexp_extract(c, r"^.{19}\.([0-9]+)", 1), 1, 6), 6, "0")
    whole = F.concat(F.substring(c, 1, 19), F.lit("."), fraction, F.lit("Z"))
    return F.when(F.length(c) >= 19, whole).otherwise(c)


def run_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def report_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
