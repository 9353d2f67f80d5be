"""Staging and the four marts."""

from pyspark.sql import DataFrame, functions as F

from gridsight.functions import metrics as X
from gridsight.functions.numbers import dec, mean_half_up
from gridsight.operators.ranking import DIGITS, row_numbers_by_value


def staging(raw: DataFrame) -> DataFrame:
    """Renamed columns, derived figures, and only rows with a PUE in range."""
    pue, mw = F.col("pue_value"), F.col("capacity_mw")
    kept = raw.filter(pue.isNotNull() & pue.between(dec("1.0"), dec("3.0")))
    named = kept.withColumnsRenamed({"id": "pue_id", "company": "company_name", "year": "metric_year"})
    return named.withColumns(
        {"cooling_overhead_pct": X.cooling_overhead_pct(pue), "annual_waste_mwh": X.annual_waste_mwh(pue, mw)}
    )


def leaderboard(stg: DataFrame, digits: int = DIGITS, ordered: bool = False) -> DataFrame:
    """Overall rank, rank in the tier, and category of every staged row; ``ordered`` by rank."""
    columns = [
        "pue_id", "company_name", "tier", "facility_name", "city", "country", "metric_year", "pue_value",
        "pue_type", "cooling_overhead_pct", "capacity_mw", "renewable_pct", "wue_l_per_kwh", "annual_waste_mwh",
    ]
    ranks = {"pue_rank": [], "tier_rank": ["tier"]}
    ranked = row_numbers_by_value(stg.select(*columns), "pue_value", "pue_id", ranks, digits)
    board = ranked.select(
        "pue_rank", "tier_rank", "company_name", "tier", "facility_name", "city", "country", "metric_year",
        "pue_value", "pue_type",
        F.round("cooling_overhead_pct", 2).cast("decimal(10,2)").alias("cooling_overhead_pct"),
        "capacity_mw", "renewable_pct", "wue_l_per_kwh",
        F.round("annual_waste_mwh", 2).cast("decimal(18,2)").alias("annual_waste_mwh"),
        X.efficiency_category(F.col("pue_value")).alias("efficiency_category"),
    )
    return board.orderBy("pue_rank") if ordered else board


def india_vs_global(stg: DataFrame) -> DataFrame:
    """Two rows, also for empty input: one pass with conditional aggregates, then unpivoted."""
    india = X.is_india(F.col("country"))
    figures = []
    for group, here in (("i", india), ("g", ~india)):
        def of(name: str, here=here):
            return F.when(here, F.col(name))

        figures += [
            F.count_if(here).alias(f"{group}_n"),
            mean_half_up(of("pue_value"), 3, 3).alias(f"{group}_avg"),
            F.min(of("pue_value")).alias(f"{group}_min"),
            F.max(of("pue_value")).alias(f"{group}_max"),
            mean_half_up(of("renewable_pct"), 0, 1).alias(f"{group}_ren"),
            F.round(F.sum(of("capacity_mw")), 1).cast("decimal(20,1)").alias(f"{group}_mw"),
            F.round(F.sum(of("annual_waste_mwh")), 1).cast("decimal(24,1)").alias(f"{group}_mwh"),
            mean_half_up(of("cooling_overhead_pct"), 1, 2).alias(f"{group}_over"),
        ]
    names = (
        "region_group, facility_count, avg_pue, min_pue, max_pue, avg_renewable_pct, total_capacity_mw, "
        "total_waste_mwh, avg_cooling_overhead_pct"
    )
    parts = ["n", "avg", "min", "max", "ren", "mw", "mwh", "over"]
    sides = ", ".join(f"'{label}', " + ", ".join(f"{g}_{p}" for p in parts) for label, g in (("India", "i"), ("Global", "g")))
    return stg.agg(*figures).selectExpr(f"stack(2, {sides}) as ({names})")


def cost_waste(stg: DataFrame, ordered: bool = False) -> DataFrame:
    """What the energy above the IT load costs, and what an improvement to 1.2 would save.

    ``ordered``: the most expensive first, unknown costs last.
    """
    pue, mw, mwh, tariff = (F.col(c) for c in ("pue_value", "capacity_mw", "annual_waste_mwh", "tariff_inr_per_kwh"))
    rows = stg.filter(mw.isNotNull() & mwh.isNotNull()).withColumn("tariff_inr_per_kwh", X.tariff_inr(F.col("country")))
    rows = rows.withColumn("annual_waste_cost_crores", F.round(X.crores(mwh, tariff), 2).cast("decimal(20,2)"))
    if ordered:
        rows = rows.orderBy(F.desc_nulls_last("annual_waste_cost_crores"), "pue_id")
    saving = F.round(X.crores(X.saving_mwh(pue, mw), tariff), 2).cast("decimal(20,2)")
    return rows.select(
        "company_name", "tier", "facility_name", "city", "country", "pue_value", "capacity_mw",
        F.round("cooling_overhead_pct", 2).cast("decimal(10,2)").alias("cooling_overhead_pct"),
        F.round(mwh, 2).cast("decimal(18,2)").alias("annual_waste_mwh"),
        "tariff_inr_per_kwh",
        X.cost_inr(mwh, tariff).alias("annual_waste_cost_inr"),
        "annual_waste_cost_crores",
        F.when(pue > dec("1.2"), saving).otherwise(dec(0)).cast("decimal(20,2)").alias("potential_savings_crores"),
        X.cost_per_mw(F.col("annual_waste_cost_crores"), mw).alias("waste_cost_per_mw_crores"),
    )


def climate_impact(stg: DataFrame, temperatures: DataFrame, unit: str = "kg", ordered: bool = False) -> DataFrame:
    """Emissions, water and a temperature-adjusted PUE; temperatures are found by city alone.

    A seed with two rows for one city ends the job: it would double that city's facilities.
    Spark broadcasts the seed if it is small.  ``ordered``: the largest emissions first, unknown last.
    """
    mwh, factor = F.col("annual_waste_mwh"), F.col("grid_emission_factor")
    seed = temperatures.groupBy("city").agg(F.count(F.lit(1)).alias("_n"), F.any_value("avg_temp_celsius").alias("_t"))
    seed = seed.where(F.assert_true(F.col("_n") == 1, F.lit("the temperature seed has a city twice")).isNull()).drop("_n")
    rows = stg.filter(F.col("capacity_mw").isNotNull())
    if "avg_temp_celsius" in rows.columns:
        rows = rows.drop("avg_temp_celsius")
    rows = rows.join(seed, "city", "left").withColumnRenamed("_t", "avg_temp_celsius")
    rows = rows.withColumn("grid_emission_factor", X.emission_factor(F.col("country")))
    if ordered:
        rows = rows.orderBy(F.desc_nulls_last(X.co2(mwh, factor, unit)), "pue_id")
    return rows.select(
        "company_name", "tier", "facility_name", "city", "country", "avg_temp_celsius", "pue_value", "capacity_mw",
        F.round("cooling_overhead_pct", 2).cast("decimal(10,2)").alias("cooling_overhead_pct"),
        F.round(mwh, 2).cast("decimal(18,2)").alias("annual_waste_mwh"),
        "grid_emission_factor",
        X.co2(mwh, factor, unit).alias("annual_co2_tons"),
        X.water_liters(F.col("wue_l_per_kwh"), F.col("capacity_mw")).alias("annual_water_liters"),
        X.climate_adjusted_pue(F.col("pue_value"), F.col("avg_temp_celsius")).alias("climate_adjusted_pue"),
    )
