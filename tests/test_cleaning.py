"""Validators, back-filling, deduplication and the cleaning run."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridsight.functions.metrics import with_derived_metrics
from gridsight.functions.text import clean_text, normalize_city, title_case
from gridsight.operators import cleaning, dedup, quality
from gridsight.plans.cleaning_run import clean, summary_stats
from gridsight.sources.lookups import city_dim, city_temperatures, company_registry


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize("check, good, bad", [
    (quality.valid_pue, ["1.09", "1.5", "2.0", "3.0"], ["0.5", "3.5", None, "x"]),
    (quality.valid_renewable, ["0", "50", "100", "100.9", None], ["150", "-10", "x"]),
    (quality.valid_wue, ["0", "10", None], ["-0.1", "10.1"]),
    (quality.valid_capacity, ["10", "500", None], ["-5", "0", "1000"]),
    (quality.valid_racks, ["1", "50000.9", None], ["0", "0.9", "50001"]),
    (lambda c: quality.valid_year(c, 2025), ["2025", "2026", "2020", "2000", None], ["1999", "2027"]),
])
def test_validators(spark, check, good, bad):
    assert column(spark, good + bad, check) == [True] * len(good) + [False] * len(bad)


def test_row_messages(spark):
    df = spark.createDataFrame([("1", "a", None, 150), ("2", None, "0.5", 50), ("3", "b", "1.2", None)], "id string, company string, pue_value string, renewable_pct int")
    got = {r.id: r.message for r in quality.error_messages(df, 2025).collect()}
    assert got == {
        "1": "Row 1 (a): Missing required field: pue_value, Invalid PUE value: None, Invalid renewable %: 150",
        "2": "Row 2 (None): Missing required field: company, Invalid PUE value: 0.5",
    }
    assert [r.id for r in quality.valid_rows(df, 2025).collect()] == ["3"]


def test_missing_required_column_fails_every_row(spark):
    df = spark.createDataFrame([("1", "a")], "id string, company string")
    assert quality.valid_rows(df, 2025).count() == 0


KEYED = "id string, company string, facility_name string, city string, pue_value double, year int, pue_type string, source_type string"


def test_quality_dedup_order(spark):
    rows = [
        ("1", "a", "f", None, 1.2, 2023, "TTM", "esg_report"), ("2", "a", "f", None, 1.3, 2024, "estimated", "benchmark"),
        ("3", "b", None, "x", 1.2, 2024, "design", "esg_report"), ("4", "b", None, "x", 1.2, 2024, "TTM", "unknown"),
        ("5", "c", "f", "x", 1.2, None, "TTM", "esg_report"), ("6", "c", "f", "x", 1.2, 2001, "design", None),
        ("7", "d", "f", "x", 1.2, 2020, "design", "news_article"), ("8", "d", "f", "x", 1.2, 2020, "design", "esg_report"),
    ]
    df = spark.createDataFrame(rows, KEYED)
    once = dedup.keep_best_quality(df)
    assert sorted(r.id for r in once.collect()) == ["2", "4", "6", "8"]
    assert sorted(r.id for r in dedup.keep_best_quality(once).collect()) == ["2", "4", "6", "8"]
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    assert sorted(r.id for r in dedup.keep_best_quality(shuffled).collect()) == ["2", "4", "6", "8"]


def test_simple_dedup_modes(spark):
    df = spark.createDataFrame([("1", "a", None, "", 1.2, 2023), ("2", "a", "", None, 1.3, 2024)], "id string, company string, facility_name string, city string, pue_value double, year int")
    assert [dedup.keep_simple(df, keep=m).first().id for m in ("newest", "first", "last")] == ["2", "1", "1"]
    assert dedup.keep_simple(df.drop("year")).count() == 1
    with pytest.raises(ValueError):
        dedup.keep_simple(df, keep="any")


def test_derived(spark):
    df = spark.createDataFrame([(Decimal("1.500"), Decimal("10.00")), (Decimal("1.200"), None)], "pue_value decimal(5,3), capacity_mw decimal(10,2)")
    got = [(r.cooling_overhead_pct, r.annual_waste_mwh) for r in with_derived_metrics(df).collect()]
    assert got == [(Decimal("50.000"), Decimal("43800.00000")), (Decimal("20.000"), None)]


def test_text_functions(spark):
    cities = ["bombay", " navi mumbai ", "noida/greater noida", "CHENNAI", "", None, "bengaluru"]
    assert column(spark, cities, normalize_city) == ["Mumbai", "Navi Mumbai", "Noida", "Chennai", "", "", "Bangalore"]
    samples = ["o'neil st. 4th", "ÉCOLE élan", "a1b2", "x-y z"]
    assert column(spark, samples, title_case) == [s.title() for s in samples]
    assert column(spark, ["a  \n b @#$ c! (1.5%)"], clean_text) == ["a b  c! (1.5%)"]


def test_lookups_are_keyed(spark):
    assert city_dim(spark).count() == city_dim(spark).select("city").distinct().count() == 26
    assert city_temperatures(spark).select("city").distinct().count() == 19
    registry = company_registry(spark)
    assert registry.count() == 24 and registry.select(F.explode("facilities")).count() == 14


def test_backfill_and_impute(spark):
    df = spark.createDataFrame([("GOOGLE", None, None), ("nobody", None, None), (None, None, None), ("AWS", "T", Decimal("1.1"))], "company string, tier string, pue_value decimal(5,3)")
    df = df.withColumns({"pue_type": F.lit("design"), "source_type": F.lit("web_page")})
    got = {r.company: (r.tier, r.pue_value, r.pue_type, r.source_type) for r in cleaning.fill_missing_pue(cleaning.backfill_tier(df, company_registry(spark))).collect()}
    assert got["GOOGLE"] == ("Tier 1 - Global Hyperscaler", Decimal("1.150"), "estimated", "benchmark")
    assert got["nobody"] == (None, Decimal("1.500"), "estimated", "benchmark")
    assert got[None][0] is None and got["AWS"] == ("T", Decimal("1.100"), "design", "web_page")


def test_clean_run_on_partial_records(spark):
    df = spark.createDataFrame([("1", "ESDS", "pune", 1.4, "design"), ("2", "ESDS", "pune", None, "design"), ("3", "ESDS", "pune", 9.0, "TTM")], "id string, company string, city string, pue_value double, pue_type string")
    rows = clean(df, company_registry(spark), 2025).collect()
    assert [(r.id, r.city, r.country, r.tier, r.country_code) for r in rows] == [("1", "Pune", "India", "Tier 2 - Indian Operator", "IN")]


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "company string, pue_value decimal(5,3), tier string, pue_type string, renewable_pct int, capacity_mw decimal(10,2), year int")
    row = summary_stats(df).first()
    assert row.total_facilities == 0 and row.avg_pue_all is None and row.status == "No valid records after cleaning"
    assert quality.size_gate(df).first().meets_requirements is False
    assert quality.output_contract(df).first().not_empty is False
