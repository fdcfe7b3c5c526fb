"""Sums that do not depend on row order, and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ebbtide.contracts import EPS

MONEY_UNITS = 10_000


def units(amount: Column) -> Column:
    """Money as a whole number of ten-thousandths, so partial sums add up the same in any order."""
    return F.round(amount * F.lit(float(MONEY_UNITS))).cast("long")


def money(total_units: Column) -> Column:
    return total_units.cast("double") / F.lit(float(MONEY_UNITS))


def per(numerator: Column, denominator: Column) -> Column:
    """Ratio whose denominator is nudged off zero."""
    return numerator / (denominator + F.lit(EPS))


def share(numerator: Column, denominator: Column) -> Column:
    """Ratio that is NULL, not an error, on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def flag(condition: Column) -> Column:
    """1/0 where an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def truthy(condition: Column) -> Column:
    """The condition with NULL read as false, so that negating it keeps unknown rows."""
    return F.coalesce(condition, F.lit(False))


def finite(value: Column) -> Column:
    """NULL, NaN and infinities become zero."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))


def clip_to(ranges: dict, name: str, value: Column) -> Column:
    return clip(value, *ranges[name]) if name in ranges else value


def dates(days) -> Column:
    return F.array(*[F.lit(d).cast("date") for d in days])


# The same rules as SQL text, for long lists of formulas.

def units_sql(amount: str) -> str:
    return f"cast(round({amount} * {float(MONEY_UNITS)}D) AS bigint)"


def money_sql(total_units: str) -> str:
    return f"cast({total_units} AS double) / {float(MONEY_UNITS)}D"


def scrub_sql(name: str) -> str:
    return f"CASE WHEN {name} IS NULL OR isnan({name}) OR abs({name}) = double('infinity') THEN 0D ELSE {name} END"


def clip_sql(value: str, bounds: tuple[float, float] | None) -> str:
    return f"least(greatest({value}, {float(bounds[0])}D), {float(bounds[1])}D)" if bounds else value
