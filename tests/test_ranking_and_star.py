"""Ranking against the plain window, star loading, marts on edge cases."""

from decimal import Decimal

import pytest
from pyspark.sql import Window as W, functions as F

from gridsight.operators import quality, star
from gridsight.operators.ranking import row_numbers_by_value
from gridsight.plans import analytics, marts, measures
from gridsight.functions.numbers import half_up_ratio, mean_half_up


@pytest.mark.parametrize("digits", [0, 1, 3])
def test_ranks_equal_the_plain_window(spark, digits):
    """A third of the rows share one value and one group; some values and groups are NULL."""
    df = spark.range(600).select(
        F.concat(F.lit("r"), "id").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1.5)).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 20) / 10 + 1).cast("decimal(5,3)").alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("g"),
    )
    got = row_numbers_by_value(df, "v", "id", {"r": [], "gr": ["g"]}, digits)
    order = [F.col("v").asc_nulls_last(), F.md5("id"), F.col("id")]
    want = df.withColumns({"r": F.row_number().over(W.orderBy(*order)), "gr": F.row_number().over(W.partitionBy("g").orderBy(*order))})
    key = ["id", "v", "g", "r", "gr"]
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, want.select(key).collect()))


def test_ranks_are_one_lazy_plan(spark):
    """No job while the plan is built, and one exchange of the whole rows."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).cast("decimal(5,3)").alias("v"), F.concat(F.lit("g"), F.col("id") % 3).alias("g"), F.lit("wide").alias("wide"))
    spark.sparkContext.setJobGroup("ranking", "")
    got = row_numbers_by_value(df, "v", "id", {"r": [], "gr": ["g"]})
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ranking")) == 0
    got.count()
    plan = got._jdf.queryExecution().sparkPlan().toString()
    spark.sparkContext.setJobGroup("other", "")
    physical = got._jdf.queryExecution().executedPlan().toString()
    final = physical.split("== Initial Plan ==")[0]
    assert sum("wide" in line and "Exchange" in line for line in final.splitlines()) <= 1 and "Window" in plan


def test_the_hash_does_not_travel_with_the_rows(spark):
    """Slices are dealt out before the hash by which they are sorted is computed."""
    df = spark.range(1000).select(F.concat(F.lit("r"), "id").alias("id"), (F.col("id") % 7).cast("decimal(5,3)").alias("v"), F.concat(F.lit("g"), F.col("id") % 3).alias("g"))
    plan = row_numbers_by_value(df, "v", "id", {"r": [], "gr": ["g"]})._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert "AS _hash#" in plan[dealt - 1] and "_hash#" not in "".join(plan[dealt:dealt + 2])


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id string, v decimal(5,3)")
    assert row_numbers_by_value(df, "v", "id", {"r": []}).count() == 0


ROW = "id string, company string, city string, country string, region string, country_code string, avg_temp_celsius decimal(5,2), tier string, year int, pue_value decimal(5,3), renewable_pct int, facility_name string, pue_type string, capacity_mw decimal(10,2), rack_count int, wue_l_per_kwh decimal(10,3), source_url string, source_type string, extraction_date date"


def facts_of(spark, *rows):
    full = [(i, c, city, country, None, None, None, "T", year, Decimal(pue), ren, None, "design", None, None, None, None, None, None) for i, c, city, country, year, pue, ren in rows]
    return spark.createDataFrame(full, ROW)


def test_dimensions_are_inserted_once(spark):
    df = facts_of(spark, ("1", "a", "x", None, 2020, "1.2", None), ("2", "a", "x", "India", 2020, "1.2", None), ("3", "b", "", None, 2020, "1.2", None), ("4", None, "x", None, 2020, "1.2", None))
    companies, places = star.company_candidates(df), star.location_candidates(df)
    assert companies.count() == 2 and places.count() == 2
    assert star.absent_from(places, places, "location_id").count() == 0
    assert star.upserted(companies, companies, "company_id").count() == 2


def test_fact_keys_and_rejects(spark):
    df = facts_of(spark, ("1", "a", "x", None, 2020, "1.2", None), ("2", "new", "x", None, 2020, "1.2", None), ("3", "a", None, None, None, "1.2", None), ("4", "a", "", None, 2020, "9.0", 150), ("5", "a", "", None, 2020, "2.0", None))
    dims = df.filter("id = '1'")
    facts, rejected = star.fact_rows(df, star.company_candidates(dims), star.location_candidates(dims))
    rows = facts.collect()
    assert len(rows) == 2 and sorted(r.location_id is None for r in rows) == [False, True]
    # the review asks for this: a row of an unknown company is rejected with its reason, not dropped
    assert {r.id: r.reasons for r in rejected.collect()} == {"2": ["unknown_company"], "3": ["year_not_null"], "4": ["pue_range", "renewable_range"]}
    assert quality.orphans(facts, star.location_candidates(dims), "location_id").count() == 0


def test_two_rows_for_no_rows(spark):
    stg = marts.staging(facts_of(spark).limit(0))
    got = {r.region_group: (r.facility_count, r.avg_pue, r.total_capacity_mw) for r in marts.india_vs_global(stg).collect()}
    assert got == {"India": (0, None, None), "Global": (0, None, None)}


def test_exact_means(spark):
    df = spark.createDataFrame([(Decimal("1.000"),), (Decimal("1.001"),), (None,)], "v decimal(5,3)")
    assert df.select(mean_half_up(F.col("v"), 3, 3)).first()[0] == Decimal("1.001")
    assert df.select(half_up_ratio(F.lit(10), F.lit(3), 2)).first()[0] == Decimal("3.33")


def test_histogram_edges(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ("1.000", "1.099", "1.100", "1.300", "3.000", "0.999")], "pue_value decimal(5,3)")
    assert sorted(map(tuple, analytics.pue_histogram(df).collect())) == [(1, 2), (2, 1), (4, 1), (20, 1)]


def test_scenario_form(spark):
    df = spark.createDataFrame([("a", Decimal("1.5"), Decimal("1.2"), Decimal("10"), Decimal("7")), ("b", Decimal("1.5"), Decimal("1.6"), Decimal("10"), Decimal("7"))],
                               "id string, current_pue decimal(5,3), target_pue decimal(5,3), capacity_mw decimal(10,2), tariff decimal(6,2)")
    r, = analytics.scenario_results(analytics.valid_scenarios(df)).collect()
    assert (r.savings_mwh, r.savings_crores, r.co2_tons, r.pue_improvement_pct, r.band) == (Decimal("26280.00000"), Decimal("18.3960"), Decimal("21549.60"), Decimal("20.0"), "good")


def test_unit_of_emissions(spark):
    from gridsight.functions.metrics import co2
    df = spark.createDataFrame([(Decimal("43800.00000"),)], "mwh decimal(20,5)")
    kg, tons = df.select(co2(F.col("mwh"), F.lit(Decimal("0.82"))), co2(F.col("mwh"), F.lit(Decimal("0.82")), "tons")).first()
    assert (kg, tons) == (Decimal("35916000.00"), Decimal("35916.00"))


def test_unknown_country_is_global_in_the_gap(spark):
    fact = spark.createDataFrame([("l1", Decimal("1.5")), (None, Decimal("1.2"))], "location_id string, pue_value decimal(5,3)")
    places = spark.createDataFrame([("l1", "India")], "location_id string, country string")
    assert tuple(measures.region_gap(fact, places).first()) == (1.5, 1.2, 0.3)
