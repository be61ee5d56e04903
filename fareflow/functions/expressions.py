"""Scalar Column helpers.  All are built-in expressions (codegen, no UDF)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sums and averages of doubles are the engine's own; operators and written
# tables never round.  Two engines add the same doubles in different orders and
# differ in the last bits, so the registered queries compare rounded figures
# (``reported``).  Averages of money often lie half-way between two of them; a
# nudge sends those upwards, so that a last bit does not decide.
SUM_DIGITS = 4
MEAN_DIGITS = 6
HALF_WAY_NUDGE = 1e-9


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(columns: Iterable[Column]) -> Column:
    """OR fold with SQL three-valued logic (NULL unless some operand is true)."""
    return reduce(lambda a, b: a | b, columns)


def guarded_ratio(num: str | Column, den: str | Column, guard: Column) -> Column:
    """num / den where ``guard`` holds, else NULL (never divides by zero)."""
    return F.when(guard, col_or(num) / col_or(den)).otherwise(F.lit(None).cast("double"))


def epoch_seconds(ts: str | Column) -> Column:
    """Whole epoch seconds of a zone-less timestamp (sub-second part dropped)."""
    return F.unix_timestamp(col_or(ts))


def minute_boundaries_between(start: str | Column, end: str | Column) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    Counts boundaries, not full minutes: 00:00:59 -> 00:01:01 is 1.
    """
    return (F.floor(epoch_seconds(end) / F.lit(60))
            - F.floor(epoch_seconds(start) / F.lit(60)))


def iso_day_of_week(d: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(col_or(d)) + F.lit(1)


def date_key(d: str | Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.date_format(col_or(d), "yyyyMMdd").cast("int")


def zero_padded(c: str | Column, width: int) -> Column:
    return F.lpad(col_or(c).cast("string"), width, "0")


def month_start(year: str | Column, month: str | Column) -> Column:
    """First instant of the month as a zone-less timestamp."""
    return F.make_date(col_or(year).cast("int"), col_or(month).cast("int"),
                       F.lit(1)).cast("timestamp_ntz")


def next_month_start(year: str | Column, month: str | Column) -> Column:
    """First instant of the following month; December rolls the year."""
    start = F.make_date(col_or(year).cast("int"), col_or(month).cast("int"), F.lit(1))
    return F.add_months(start, 1).cast("timestamp_ntz")


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL on zero rows, like SQL."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def null_count(c: str) -> Column:
    return count_when(F.col(c).isNull())


def as_sum(value: Column) -> Column:
    """A computed sum as it is reported (NaN and NULL stay what they are)."""
    return F.round(value, SUM_DIGITS)


def as_mean(value: Column) -> Column:
    """A computed average as it is reported (NaN and NULL stay what they are)."""
    return F.round(value + F.lit(HALF_WAY_NUDGE), MEAN_DIGITS)


def reported_sum(c: str | Column) -> Column:
    return as_sum(F.sum(c))


def reported_mean(c: str | Column) -> Column:
    """AVG (NULLs ignored; NULL when no value)."""
    return as_mean(F.avg(c))


def reported(df: DataFrame, only_means: bool = False) -> DataFrame:
    """The double columns of a result as they are compared: averages by their
    name (``avg_*``), all others as sums unless ``only_means``."""
    def shown(f):
        if not isinstance(f.dataType, T.DoubleType):
            return F.col(f.name)
        if f.name.startswith("avg_"):
            return as_mean(F.col(f.name)).alias(f.name)
        return F.col(f.name) if only_means else as_sum(F.col(f.name)).alias(f.name)
    return df.select(*[shown(f) for f in df.schema])


def canonical_text(c: str | Column, kind: str) -> Column:
    """Engine-independent text form of a value, '' for NULL.

    Used for surrogate keys: timestamps with microseconds, doubles through
    decimal(38,10) (beyond its range, and NaN, as the engine writes a
    double), integers and strings as is.
    """
    c = col_or(c)
    if kind == "timestamp":
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif kind == "double":
        text = F.coalesce(c.try_cast("decimal(38,10)").cast("string"), c.cast("string"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))
