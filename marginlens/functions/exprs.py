"""Column expressions shared by every layer (all JVM built-ins, codegen-friendly)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / den`` that is NULL when ``den`` is 0 or NULL instead of raising."""
    return F.try_divide(_c(num), _c(den))


def date_key(date_col) -> Column:
    """``yyyymmdd`` integer key, shared by the date dimension PK and fact FKs."""
    d = _c(date_col)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def key_year(key_col) -> Column:
    """Year backed out of a ``yyyymmdd`` key with integer arithmetic."""
    return F.expr(f"cast({_name(key_col)} div 10000 as int)")


def key_month(key_col) -> Column:
    """Month backed out of a ``yyyymmdd`` key with integer arithmetic."""
    return F.expr(f"cast(({_name(key_col)} div 100) % 100 as int)")


def _name(key_col) -> str:
    if isinstance(key_col, str):
        return f"`{key_col}`"
    raise TypeError("key helpers take a column name")


def month_key(year_col, month_col) -> Column:
    """``yyyymm`` integer key."""
    return _c(year_col) * 100 + _c(month_col)


def quarter_label(date_col) -> Column:
    """``Q1`` .. ``Q4``."""
    return F.concat(F.lit("Q"), F.quarter(_c(date_col)).cast("string"))


def weekday_name(date_col) -> Column:
    """Full English weekday name (``Wednesday``)."""
    return F.date_format(_c(date_col), "EEEE")


#: Decimal places kept of every summed measure. Sums are exact on these
#: decimals: a double is read as the shortest decimal that names it, rounded
#: half up once at this scale.
SUM_SCALE = 6
_UNIT = 10 ** SUM_SCALE


def fixed(x) -> Column:
    """A measure as ``decimal(38, SUM_SCALE)``; NULL for NaN and infinities."""
    c = _c(x)
    return F.when(_finite(c), c).cast(f"decimal(38,{SUM_SCALE})")


def _finite(c: Column) -> Column:
    d = c.cast("double")
    return ~F.isnan(d) & (F.abs(d) != float("inf"))


def sum_units(x) -> Column:
    """Exact sum in units of ``10 ** -SUM_SCALE``, as a double.

    Decimal sums are associative, so the result does not depend on
    partitioning or task order, and they cannot overflow at table size. NaN
    and infinities surface as a plain double sum would show them.
    """
    c = _c(x).cast("double")
    exact = (F.sum(fixed(x)) * F.lit(_UNIT)).cast("decimal(38,0)").cast("double")
    odd = F.sum(F.when(~_finite(c), c))
    return F.coalesce(odd, exact)


def exact_sum(x) -> Column:
    """Order-free sum of a double measure, returned as double."""
    return sum_units(x) / float(_UNIT)


def exact_avg(x) -> Column:
    """Order-free average of a double measure."""
    return F.try_divide(sum_units(x), F.count(_c(x)).cast("double")) / float(_UNIT)


def ratio_of_sums(num, den, pct: bool = True) -> Column:
    """``100 * sum(num) / sum(den)`` from exact sums; NULL when ``sum(den)`` is 0."""
    top = sum_units(num) * 100 if pct else sum_units(num)
    return F.try_divide(top, sum_units(den))
