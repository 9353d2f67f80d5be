"""Exact number helpers: decimals are rounded half away from zero, never through a double."""

from decimal import Decimal

from pyspark.sql import Column, functions as F


def dec(value: str | int) -> Column:
    """Exact decimal literal of the shortest type that holds it."""
    return F.lit(Decimal(str(value)))


def safe_number(col: Column, type_name: str) -> Column:
    """NULL stays NULL and text that is no number becomes NULL.

    Whole-number targets cut the fraction off, towards zero.
    """
    if type_name in ("int", "bigint"):
        return col.try_cast("decimal(38,10)").try_cast(type_name)
    return col.try_cast(type_name)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def half_up_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """Exact ``round(numerator / denominator, scale)`` of two whole non-negative numbers.

    A decimal division first rounds at its own scale and would then be rounded twice.
    """
    wide = "decimal(38,0)"
    n = numerator.cast(wide) * F.lit(2 * 10**scale).cast("decimal(12,0)")
    d = denominator.cast("decimal(20,0)")
    whole = F.call_function("div", (n.cast(wide) + d), (d * 2))
    return (whole * dec(Decimal(1).scaleb(-scale))).cast(f"decimal(20,{scale})")


def mean_half_up(col: Column, in_scale: int, out_scale: int) -> Column:
    """Mean of a non-negative column with ``in_scale`` decimals, rounded exactly.

    NULL when no value is present.
    """
    unscaled = (col * F.lit(10**in_scale)).cast("bigint") if in_scale else col.cast("bigint")
    total, present = F.sum(unscaled), F.count(col)
    return F.when(
        present > 0, half_up_ratio(total, present * F.lit(10**in_scale), out_scale)
    )


def quotient_half_up(numerator: Column, denominator: Column, in_scale: int, scale: int) -> Column:
    """``round(a / b, scale)`` of two decimals that both have ``in_scale`` decimals."""
    factor = F.lit(10**in_scale)
    return half_up_ratio(
        (numerator * factor).cast("decimal(38,0)"), (denominator * factor).cast("bigint"), scale
    )
