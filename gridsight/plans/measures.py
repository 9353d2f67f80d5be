"""Report measures over the star schema, all from one pass over the facts.

A measure over one table needs no other; those that look at the country first reduce the
facts to one row per location and join the places to that.
"""

from pyspark.sql import Column, DataFrame, functions as F

from gridsight.functions import metrics as X
from gridsight.functions.numbers import dec, mean_half_up
from gridsight.plans.views import with_dimensions


def _crores_sum(mwh: Column, tariff: str = "7") -> Column:
    return F.round(F.sum(X.crores(mwh, dec(tariff))), 2).cast("decimal(24,2)")


def pue_measures(fact: DataFrame) -> DataFrame:
    return fact.agg(
        mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"),
        F.min("pue_value").alias("best_pue"),
        F.max("pue_value").alias("worst_pue"),
    )


def count_measures(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Facilities are facts; companies are rows of the dimension, used or not.

    Both ids are the keys of their tables, so counting them is enough.
    """
    facts = fact.agg(F.count("fact_id").alias("value")).select(F.lit("total_facilities").alias("measure"), "value")
    companies = dim_company.agg(F.count("company_id").alias("value")).select(
        F.lit("total_companies").alias("measure"), "value"
    )
    return facts.unionByName(companies)


def energy_measures(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.sum("capacity_mw").alias("total_capacity_mw"), F.sum("annual_waste_mwh").alias("annual_waste_mwh")
    )


def waste_cost(fact: DataFrame) -> DataFrame:
    return fact.agg(_crores_sum(F.col("annual_waste_mwh")).alias("annual_waste_cost_crores"))


def potential_savings(fact: DataFrame) -> DataFrame:
    pue, mw = F.col("pue_value"), F.col("capacity_mw")
    saving = F.when((pue > dec("1.2")) & mw.isNotNull(), X.saving_mwh(pue, mw))
    return fact.agg(_crores_sum(saving).alias("potential_savings_crores"))


def climate_measures(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.round(F.sum(F.col("annual_waste_mwh") * dec("0.82")), 2).cast("decimal(24,2)").alias("annual_co2_tons"),
        mean_half_up(F.col("renewable_pct"), 0, 1).alias("avg_renewable_pct"),
    )


def region_gap(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Mean PUE of India and of the rest, and the gap; an unknown country is not India."""
    per_place = fact.groupBy("location_id").agg(
        F.sum((F.col("pue_value") * 1000).cast("bigint")).alias("s"), F.count("pue_value").alias("n")
    )
    placed = per_place.join(dim_location.select("location_id", "country"), "location_id", "left")
    india = X.is_india(F.col("country"))

    def mean(here: Column) -> Column:
        return F.sum(F.when(here, F.col("s"))).cast("double") / F.nullif(F.sum(F.when(here, F.col("n"))), F.lit(0)) / 1000

    means = placed.agg(mean(india).alias("i"), mean(~india).alias("g"))
    return means.select(
        F.round("i", 3).alias("india_avg_pue"),
        F.round("g", 3).alias("global_avg_pue"),
        F.round(F.col("i") - F.col("g"), 3).alias("pue_gap"),
    )


def co2_by_company(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    per = fact.groupBy("company_id").agg(F.sum("annual_waste_mwh").alias("_mwh"))
    return per.join(dim_company.select("company_id", "company_name"), "company_id").select(
        "company_name", F.round(F.col("_mwh") * dec("0.82"), 2).cast("decimal(24,2)").alias("annual_co2_tons")
    )


def operator_ranking(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    per = fact.groupBy("company_id").agg(
        mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"),
        # the fact id is the primary key, so counting it is counting it distinctly
        F.count("fact_id").alias("facilities"),
        F.sum("capacity_mw").alias("total_capacity_mw"),
    )
    return (
        per.join(dim_company.select("company_id", "company_name"), "company_id")
        .select("company_name", "avg_pue", "facilities", "total_capacity_mw")
        .orderBy("avg_pue", "company_name")
    )


def report_rows(fact: DataFrame, dim_company: DataFrame, dim_location: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Facts with dimensions and the calculated columns of the report."""
    pue = F.col("pue_value")
    return with_dimensions(fact, dim_company, dim_location, hot).withColumns(
        {
            "efficiency_category": X.efficiency_category(pue),
            "is_india": X.region_group(F.col("country")),
            "traffic_light": X.traffic_light(pue),
        }
    )
