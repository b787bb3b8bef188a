"""Numeric helpers that behave the same on every engine and partitioning.

Expressions are written as Spark SQL text and turned into a Column with one
``F.expr`` call; ``*_sql`` variants return the text for composition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_sql(x: str, digits: int) -> str:
    """ROUND(x, digits), HALF_UP, evaluated on the decimal value.

    Rounding a double through DECIMAL(28,10) makes the result identical
    across engines (the decimal form is exact); it equals plain ROUND except
    for values within 1e-10 of a tie. Values beyond the decimal range fall
    back to plain ROUND instead of failing under ANSI mode.
    """
    return (f"CAST(coalesce(round(try_cast(({x}) AS DECIMAL(28,10)), {digits}), "
            f"round(({x}), {digits})) AS DOUBLE)")


def half_up(x, digits: int) -> Column:
    """Column form of :func:`half_up_sql`; ``x`` is SQL text / a column name,
    or a Column (built with Column calls)."""
    if isinstance(x, str):
        return F.expr(half_up_sql(x, digits))
    dec = F.round(x.try_cast("decimal(28,10)"), digits)
    return F.coalesce(dec, F.round(x, digits)).cast("double")


def safe_ratio_sql(num: str, den: str, digits: int | None = None) -> str:
    """num / NULLIF(den, 0) as double, optionally rounded (AGG-9)."""
    r = f"try_divide(CAST(({num}) AS DOUBLE), CAST(nullif(({den}), 0) AS DOUBLE))"
    return half_up_sql(r, digits) if digits is not None else r


def safe_ratio(num: str, den: str, digits: int | None = None) -> Column:
    return F.expr(safe_ratio_sql(num, den, digits))
