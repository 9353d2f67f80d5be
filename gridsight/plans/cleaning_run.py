"""From extracted records to the cleaned table, and what is reported about it."""

from pyspark.sql import DataFrame, functions as F

from gridsight.functions.metrics import with_derived_metrics
from gridsight.functions.numbers import mean_half_up
from gridsight.operators.cleaning import backfill_tier, estimated_pue, in_tier, mark_estimates, nan_cells_to_null, normalize_schema, wanted_tier, with_storage_types
from gridsight.operators.dedup import hot_hash, keep_best_quality
from gridsight.operators.joins import frequent_keys
from gridsight.operators.location import enrich_normal, with_normal_city
from gridsight.operators.quality import passes


def clean(records: DataFrame, registry: DataFrame, as_of_year: int, seq: str = "id") -> DataFrame:
    """Normalise, enrich, impute, validate, keep the best row per facility, derive.

    Rows are checked on the values as they came and only then rounded to their storage types: a
    PUE of 3.0004 or "n/a" is rejected, not stored as 3.000 or estimated.

    Before the choice of the best row only that is done, row by row, on which it depends: the
    normal form of the city, the checks and the mark of an estimate.  Places, tiers, estimates
    and derived figures are filled in for the rows that stay.  One sketch of the records finds the
    frequent keys of the choice and of the tiers.
    """
    rows = nan_cells_to_null(normalize_schema(records, extra=(seq,), keep_numbers=True))
    hot = frequent_keys(rows.select(hot_hash(["company", "facility_name"]).alias("_part"), wanted_tier().alias("_wanted")), ["_part"], ["_wanted"])
    rows = rows.withColumns({"_had": F.coalesce("city", F.lit("")) != "", "_missing": F.col("pue_value").isNull()})
    rows = mark_estimates(with_normal_city(rows), F.col("_missing"))
    rows = rows.withColumn("_valid", passes(as_of_year, rows.columns, missing_pue=True))
    best = keep_best_quality(with_storage_types(rows), seq=seq, valid=F.col("_valid"), hot=hot)
    best = backfill_tier(enrich_normal(best, F.col("_had")), registry, seq, hot)
    return with_derived_metrics(estimated_pue(best, F.col("_missing")).drop("_had", "_missing", "_valid"))


def final_order(df: DataFrame, seq: str = "id") -> DataFrame:
    """Tier, company, PUE; missing values last.  The row id breaks ties and spreads the sort."""
    return df.orderBy(
        F.asc_nulls_last("tier"), F.asc_nulls_last("company"), F.asc_nulls_last("pue_value"), F.asc(seq)
    )


def summary_stats(df: DataFrame) -> DataFrame:
    """Fourteen figures about the cleaned table in one row, in one pass."""
    pue, tier, kind = F.col("pue_value"), F.col("tier"), F.col("pue_type")

    def tier_mean(part: str):
        return mean_half_up(F.when(in_tier(tier, part), pue), 3, 3)

    return df.agg(
        F.count(F.lit(1)).alias("total_facilities"),
        F.count_distinct("company").alias("total_companies"),
        F.count("pue_value").alias("companies_with_pue"),
        mean_half_up(pue, 3, 3).alias("avg_pue_all"),
        tier_mean("Tier 1").alias("avg_pue_tier1"),
        tier_mean("Tier 2").alias("avg_pue_tier2"),
        tier_mean("Tier 3").alias("avg_pue_tier3"),
        mean_half_up(F.col("renewable_pct"), 0, 1).alias("avg_renewable_pct"),
        F.count_if(kind == "operating").alias("operating_records"),
        F.count_if(kind == "design").alias("design_records"),
        F.count_if(kind == "TTM").alias("ttm_records"),
        F.count_if(kind == "estimated").alias("estimated_records"),
        F.round(F.sum("capacity_mw"), 1).cast("decimal(20,1)").alias("total_capacity_mw"),
        F.concat(F.min("year").cast("string"), F.lit("-"), F.max("year").cast("string")).alias("year_range"),
        F.when(F.count(F.lit(1)) == 0, "No valid records after cleaning").alias("status"),
    )
