"""Views over the star schema.

Row-level views join the dimensions with salt and without a hint: a dimension grows with the
data, so Spark broadcasts it only while it is below the session's size limit.  ``hot`` is the table
of the facts' frequent keys (``fact_hot_keys``), kept beside the facts: with it the facts are read
once, whatever the number of dimensions.  Aggregate views first reduce the facts to one row per key and
join the dimension afterwards, so a company with a third of the facts is one row by then.
"""

from pyspark.sql import Column, DataFrame, functions as F

from gridsight.functions import metrics as X
from gridsight.functions.numbers import dec, half_up_ratio
from gridsight.operators.joins import frequent_keys, salted_join


def fact_hot_keys(fact: DataFrame) -> DataFrame:
    """The frequent companies and places of the facts, from one pass over them."""
    return frequent_keys(fact, ["company_id"], ["location_id"])


def with_dimensions(fact: DataFrame, dim_company: DataFrame, dim_location: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Facts with their company (inner) and their place, if any (left)."""
    companies = dim_company.select("company_id", "company_name", "tier")
    places = dim_location.select("location_id", "city", "country", "avg_temp_celsius")
    named = salted_join(fact, companies, ["company_id"], "inner", "fact_id", hot)
    return salted_join(named, places, ["location_id"], "left", "fact_id", hot)


def efficiency_leaderboard(fact: DataFrame, dim_company: DataFrame, dim_location: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    rows = with_dimensions(fact, dim_company, dim_location, hot)
    return rows.orderBy("pue_value", "fact_id").select(
        "company_name", "tier", "facility_name", "city", "country", "year", "pue_value", "pue_type",
        "cooling_overhead_pct", "capacity_mw", "renewable_pct", "wue_l_per_kwh", "annual_waste_mwh",
    )


def _partials(fact: DataFrame, key: str) -> DataFrame:
    """Sums and counts per dimension key that add up to any coarser group."""
    kind = F.col("pue_type")
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("pue_value") * 1000).cast("bigint")).alias("pue_milli"),
        F.min("pue_value").alias("min_pue"),
        F.max("pue_value").alias("max_pue"),
        F.sum(F.col("renewable_pct").cast("bigint")).alias("ren"),
        F.count("renewable_pct").alias("ren_n"),
        F.sum("capacity_mw").alias("mw"),
        F.sum("annual_waste_mwh").alias("mwh"),
        F.count_if(kind == "operating").alias("operating"),
        F.count_if(kind == "design").alias("design"),
    )


def _avg_pue() -> Column:
    return half_up_ratio(F.sum("pue_milli"), F.sum("n") * 1000, 3)


def _avg_renewable() -> Column:
    return F.when(F.sum("ren_n") > 0, half_up_ratio(F.sum("ren"), F.sum("ren_n"), 1))


def region_comparison(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """India and Global; a group without facts has no row."""
    partial = _partials(fact, "location_id").join(dim_location.select("location_id", "country"), "location_id", "left")
    return partial.groupBy(X.region_group(F.col("country")).alias("region_group")).agg(
        F.sum("n").alias("facility_count"),
        _avg_pue().alias("avg_pue"),
        F.min("min_pue").alias("min_pue"),
        F.max("max_pue").alias("max_pue"),
        _avg_renewable().alias("avg_renewable_pct"),
        F.round(F.sum("mw"), 1).cast("decimal(20,1)").alias("total_capacity_mw"),
        F.round(F.sum("mwh"), 1).cast("decimal(24,1)").alias("total_waste_mwh"),
    )


def tier_comparison(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    partial = _partials(fact, "company_id").join(dim_company.select("company_id", "tier"), "company_id")
    return (
        partial.groupBy("tier")
        .agg(
            F.sum("n").alias("facility_count"),
            _avg_pue().alias("avg_pue"),
            F.min("min_pue").alias("best_pue"),
            _avg_renewable().alias("avg_renewable_pct"),
            F.sum("operating").alias("operating_pue_count"),
            F.sum("design").alias("design_pue_count"),
        )
        .orderBy("avg_pue", "tier")
    )


def climate_view(fact: DataFrame, dim_company: DataFrame, dim_location: DataFrame, unit: str = "kg", hot: DataFrame | None = None) -> DataFrame:
    """Emissions with one factor for all countries."""
    rows = with_dimensions(fact.filter(F.col("capacity_mw").isNotNull()), dim_company, dim_location, hot)
    return (
        rows.withColumn("annual_co2_tons", X.co2(F.col("annual_waste_mwh"), dec("0.82"), unit))
        .orderBy(F.desc_nulls_last("annual_co2_tons"), "fact_id")
        .select(
            "company_name", "tier", "country", "avg_temp_celsius", "pue_value", "capacity_mw",
            "cooling_overhead_pct", "annual_waste_mwh", "annual_co2_tons",
        )
    )


def design_vs_operating(fact: DataFrame, dim_company: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    rows = fact.filter(F.col("pue_type").isin("design", "operating", "TTM"))
    return (
        salted_join(rows, dim_company.select("company_id", "company_name"), ["company_id"], "inner", "fact_id", hot)
        .orderBy("company_name", F.desc_nulls_first("year"), "fact_id")
        .select("company_name", "pue_type", "pue_value", "year", "facility_name")
    )
