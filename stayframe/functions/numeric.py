"""Number columns: flags, null-safe sums, ratios, scores and unit rules."""

from __future__ import annotations

import operator

from pyspark.sql import Column, functions as F

COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}

INCH_IN_CM = 2.54
POUND_IN_KG = 0.453592
IMPERIAL_BMI = 703.0


def flag(predicate: Column) -> Column:
    """1 when the predicate holds, 0 when it is false or NULL."""
    return F.when(predicate, 1).otherwise(0)


def first_match(*cases: tuple[Column, object]) -> Column:
    """Value of the first true case, NULL when none holds."""
    result = None
    for predicate, value in cases:
        result = F.when(predicate, value) if result is None else result.when(predicate, value)
    return result


def sum_of_known(a: Column, b: Column) -> Column:
    """a + b, the known one when the other is NULL, NULL when both are."""
    return F.coalesce(a + b, a, b)


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding of the printed value, halves away from zero; NULL from 1e20 on."""
    return F.round(value.try_cast("decimal(38,18)"), digits).cast("double")


def fahrenheit_to_celsius(value: Column) -> Column:
    return (value - 32) / 1.8


def metric_bmi(weight_kg: Column, height_m: Column) -> Column:
    return F.try_divide(weight_kg, height_m * height_m)


def imperial_bmi(weight_lb: Column, height_in: Column) -> Column:
    return F.lit(IMPERIAL_BMI) * F.try_divide(weight_lb, height_in * height_in)


def oxygen_ratio(po2: Column, fio2: Column) -> Column:
    """PaO2 over FiO2 given in percent; NULL unless 0 < FiO2 < 100."""
    return F.when((fio2 > 0) & (fio2 < 100), 100 * po2 / fio2)


def threshold_score(value: Column, steps, default: int = 0) -> Column:
    """Points of the first step (op, bound, points) that holds; NULL for NULL."""
    cases = [(COMPARE[op](value, F.lit(bound)), points) for op, bound, points in steps]
    return F.when(value.isNotNull(), first_match(*cases).otherwise(default))


def order_flag(event: Column, reference: Column, when_no_reference: Column,
               eligible: Column, has_reference: Column) -> Column:
    """Did the event come before the reference? 1, 0 or unknown.

    With a reference: event <= reference gives 1, later gives 0. Without one the
    caller's predicate decides. NULL when the row is not eligible or no
    comparison is possible.
    """
    return first_match(
        (has_reference & eligible & (event <= reference), 1),
        (has_reference & eligible & (event > reference), 0),
        (~has_reference & when_no_reference, 1),
        (~has_reference & ~when_no_reference, 0),
    )
