"""Derived energy, cost and climate figures as exact decimal expressions."""

from pyspark.sql import Column, functions as F

from gridsight import fixed_values as V
from gridsight.functions.numbers import dec, quotient_half_up

MWH = "decimal(20,5)"


def cooling_overhead_pct(pue: Column) -> Column:
    return ((pue - dec("1.0")) * dec(100)).cast("decimal(10,3)")


def annual_waste_mwh(pue: Column, capacity: Column) -> Column:
    """Energy above the IT load in a year; NULL without a capacity."""
    return ((pue - dec("1.0")) * capacity * dec(V.HOURS_PER_YEAR)).cast(MWH)


def with_derived_metrics(df):
    """Add overhead and waste where their inputs exist."""
    if "pue_value" not in df.columns:
        return df
    new = {"cooling_overhead_pct": cooling_overhead_pct(F.col("pue_value"))}
    if "capacity_mw" in df.columns:
        new["annual_waste_mwh"] = annual_waste_mwh(F.col("pue_value"), F.col("capacity_mw"))
    return df.withColumns(new)


def tariff_inr(country: Column) -> Column:
    return (
        F.when(country == "India", dec("7.0"))
        .when(country == "United States", dec("10.0"))
        .otherwise(dec("8.5"))
        .cast("decimal(3,1)")
    )


def emission_factor(country: Column) -> Column:
    return (
        F.when(country == "India", dec("0.82"))
        .when(country == "United States", dec("0.42"))
        .otherwise(dec("0.47"))
    )


def cost_inr(mwh: Column, tariff: Column) -> Column:
    return F.round(mwh * dec(1000) * tariff, 2).cast("decimal(24,2)")


def crores(mwh: Column, tariff: Column) -> Column:
    """Cost in units of ten million rupees, not rounded: MWh x 1000 x tariff / 10^7."""
    return mwh * tariff * dec("0.0001")


def saving_mwh(pue: Column, capacity: Column, target: str = "1.2") -> Column:
    return ((pue - dec(target)) * capacity * dec(V.HOURS_PER_YEAR)).cast(MWH)


def cost_per_mw(cost: Column, capacity: Column) -> Column:
    return F.when(capacity > 0, quotient_half_up(cost, capacity, 2, 2))


def co2(mwh: Column, factor: Column, unit: str = "kg") -> Column:
    """Emissions of the wasted energy.

    ``kg`` keeps the figure the published views and marts print (under the name tons);
    ``tons`` divides by 1000 as the measures and the scenario form do.
    """
    scaled = mwh * dec(1000) * factor if unit == "kg" else mwh * factor
    return F.round(scaled, 2).cast("decimal(24,2)")


def water_liters(wue: Column, capacity: Column) -> Column:
    return F.round(wue * capacity * dec(V.HOURS_PER_YEAR * 1000), 0).cast("decimal(24,0)")


def climate_adjusted_pue(pue: Column, temperature: Column) -> Column:
    warm = F.coalesce(temperature, dec("25.00").cast("decimal(5,2)")) - dec(10)
    return F.round(pue * (dec(1) + warm * dec("0.01")), 3).cast("decimal(10,3)")


def efficiency_category(pue: Column) -> Column:
    return (
        F.when(pue < dec("1.2"), "Exceptional")
        .when(pue < dec("1.4"), "Excellent")
        .when(pue < dec("1.6"), "Good")
        .when(pue < dec("1.8"), "Fair")
        .otherwise("Needs Improvement")
    )


def traffic_light(pue: Column) -> Column:
    """Green below 1.3, yellow below 1.5, orange up to 1.7, red above."""
    return (
        F.when(pue < dec("1.3"), "green")
        .when(pue < dec("1.5"), "yellow")
        .when(pue <= dec("1.7"), "orange")
        .otherwise("red")
    )


def recommendation_band(pue: Column) -> Column:
    return (
        F.when(pue > dec("1.8"), "high")
        .when(pue > dec("1.5"), "moderate")
        .otherwise("good")
    )


def is_india(country: Column) -> Column:
    """True only for India; an unknown country counts as not India."""
    return country.eqNullSafe(F.lit("India"))


def region_group(country: Column) -> Column:
    return F.when(is_india(country), "India").otherwise("Global")


def pue_bin(pue: Column, low: int = 1, high: int = 3, bins: int = 20) -> Column:
    """Equal-width histogram bin 1..bins; the last bin includes its upper edge.

    Whole thousandths, since a bin edge such as 1.3 is not exact in binary.
    """
    offset = ((pue - dec(low)) * dec(1000)).cast("bigint") * F.lit(bins)
    return F.least(F.floor(offset / F.lit((high - low) * 1000)) + 1, F.lit(bins)).cast("int")
