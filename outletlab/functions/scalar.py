"""Column-expression helpers. All are built-in Spark expressions (JVM side,
whole-stage codegen); none is a Python UDF.

ANSI mode stays on: user data is cast with ``try_cast`` and divided with
``try_divide`` so a bad value or a zero divisor gives NULL instead of failing
the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outletlab import conf


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    return col_(c).try_cast("double")


def yyyymmdd_to_date(c) -> Column:
    return F.try_to_timestamp(col_(c), F.lit("yyyyMMdd")).cast("date")


def fiscal_period_start_date(p) -> Column:
    """First day of fiscal period ``YYYY0MM``."""
    p = col_(p).cast("string")
    return F.make_date(F.substring(p, 1, 4).cast("int"), F.substring(p, 6, 2).cast("int"), F.lit(1))


def fiscal_period_shift(p, months: int) -> Column:
    """Fiscal period ``YYYY0MM`` moved by ``months`` (may be negative)."""
    return F.date_format(F.add_months(fiscal_period_start_date(p), months), "yyyy'0'MM")


def days_since_month_start(d) -> Column:
    d = col_(d)
    return F.datediff(d, F.trunc(d, "month"))


def ccaf_group(digit) -> Column:
    digit = col_(digit)
    expr = None
    for code, name in conf.CCAF_GROUPS:
        expr = (F.when(digit == code, F.lit(name)) if expr is None
                else expr.when(digit == code, F.lit(name)))
    return expr.otherwise(F.lit(conf.CCAF_OTHER))


def routed_flag(order_block) -> Column:
    """0 for the not-routed order block, 1 otherwise (also when NULL)."""
    return F.when(col_(order_block) == conf.NOT_ROUTED_CODE, F.lit(0)).otherwise(F.lit(1))


def zero_default_sum(a, b, dtype: str) -> Column:
    zero = F.lit(0).cast(dtype)
    return (F.coalesce(col_(a), zero) + F.coalesce(col_(b), zero)).cast(dtype)


def clean_column_name(name: str) -> str:
    """Non-alphanumerics -> '_' (metadata only, applied on the driver)."""
    import re

    return re.sub(r"[^0-9A-Za-z_]", "_", name.strip())
