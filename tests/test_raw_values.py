"""Values as files bring them: nothing is lost or rounded before it is checked."""

import json

import pytest
from pyspark.sql import functions as F

from gridsight.operators import star
from gridsight.operators.cleaning import normalize_schema
from gridsight.operators.joins import salted_join
from gridsight.plans import cleaning_run, marts
from gridsight.sources.readers import read_records_json

REGISTRY = "name string, tier string, region string"


def cleaned(spark, tmp_path, records):
    rows = [{"company": f"C{i}", "facility_name": "F", "city": "Mumbai", "year": 2024, "pue_type": "operating", **r} for i, r in enumerate(records)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    found, skipped = read_records_json(spark, str(tmp_path))
    assert skipped.count() == 0
    out = cleaning_run.clean(found.withColumn("id", F.col("company")), spark.createDataFrame([], REGISTRY), 2025)
    return {r.company: r for r in out.collect()}


def test_validation_sees_the_unrounded_value(spark, tmp_path):
    values = [3.0004, 0.9996, 150.5, "n/a", 1.5, "1.25", None]
    got = cleaned(spark, tmp_path, [{"pue_value": v} for v in values])
    assert sorted(got) == ["C4", "C5", "C6"]
    assert (float(got["C4"].pue_value), float(got["C5"].pue_value)) == (1.5, 1.25)
    assert got["C6"].pue_type == "estimated" and got["C4"].pue_type == "operating"


def test_other_numbers(spark, tmp_path):
    cases = [{"renewable_pct": 75.5}, {"year": "2024"}, {"year": 2024.0}, {"capacity_mw": 500.004}, {"capacity_mw": 0.004}, {"rack_count": "many"}, {"wue_l_per_kwh": "1.8"}]
    got = cleaned(spark, tmp_path, [{"pue_value": 1.4} | c for c in cases])
    assert sorted(got) == ["C0", "C1", "C2", "C4", "C6"]
    assert got["C0"].renewable_pct == 75 and got["C1"].year == got["C2"].year == 2024 and float(got["C6"].wue_l_per_kwh) == 1.8


def test_one_bad_cell_does_not_end_the_job(spark):
    rows = spark.createDataFrame([("a", "n/a", "150.5"), ("b", "2024", "1.3")], "company string, year string, pue_value string")
    got = {r.company: (r.year, r.pue_value and float(r.pue_value)) for r in normalize_schema(rows).collect()}
    assert got == {"a": (None, None), "b": (2024, 1.3)}


def test_places_and_companies(spark):
    columns = "id string, company string, city string, country string, country_code string, region string, avg_temp_celsius decimal(5,2), tier string"
    rows = spark.createDataFrame([("1", "A", "X", None, None, None, None, None), ("2", "A", "X", "", None, None, None, None)], columns)
    assert star.location_candidates(rows).count() == 1
    keys = spark.range(1).select(star.key_of(F.lit("a|b"), F.lit("c")).alias("x"), star.key_of(F.lit("a"), F.lit("b|c")).alias("y"), star.key_of(F.lit(None).cast("string"), F.lit("")).alias("n")).first()
    assert keys.x != keys.y


def test_unknown_companies_are_rejected(spark):
    rows = spark.createDataFrame(
        [("1", "A"), ("2", "B")], "id string, company string"
    ).selectExpr("*", "'X' as city", "'IN' as country", "2024 as year", "cast(1.5 as decimal(5,3)) as pue_value", "'operating' as pue_type", "cast(1 as decimal(10,2)) as capacity_mw",
                 "1 as rack_count", "5 as renewable_pct", "cast(1 as decimal(10,3)) as wue_l_per_kwh", "'f' as facility_name", "'u' as source_url", "'s' as source_type", "current_date() as extraction_date")
    companies = spark.range(1).select(star.key_of(F.lit("A")).alias("company_id"))
    places = spark.range(1).select(star.key_of(F.lit("X"), F.lit("IN")).alias("location_id"))
    facts, rejected = star.fact_rows(rows, companies, places)
    assert facts.count() == 1 and [(r.id, list(r.reasons)) for r in rejected.collect()] == [("2", ["unknown_company"])]


def test_temperature_seed_must_be_unique(spark):
    stg = spark.createDataFrame([("c", "t", "f", "X", "India", 1.5, 2.0)], "company_name string, tier string, facility_name string, city string, country string, pue_value double, capacity_mw double")
    stg = stg.selectExpr("*", "cast(10 as decimal(18,5)) as annual_waste_mwh", "cast(50 as decimal(10,2)) as cooling_overhead_pct", "cast(1 as decimal(10,3)) as wue_l_per_kwh")
    stg = stg.withColumns({c: F.col(c).cast("decimal(10,3)") for c in ("pue_value", "capacity_mw")})
    seed = spark.createDataFrame([("X", 20.0), ("X", 21.0)], "city string, avg_temp_celsius double").withColumn("avg_temp_celsius", F.col("avg_temp_celsius").cast("decimal(5,2)"))
    with pytest.raises(Exception, match="city twice"):
        marts.climate_impact(stg, seed).collect()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_like_a_plain_join(spark, how):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i % 200}", i % 2) for i in range(3000)], "id int, k string, j int")
    keyed = spark.createDataFrame([("hot", 0, "H")] + [(f"k{i}", i % 2, str(i)) for i in range(150)] + [(None, 0, "N")], "key string, j2 int, v string")
    got = salted_join(rows, keyed, {"k": "key", "j": "j2"}, how, "id")
    want = rows.join(keyed, (F.col("k") == F.col("key")) & (F.col("j") == F.col("j2")), how).drop("key", "j2")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_lookup_join_spreads_null_and_hot_keys(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("100", "false", "-1")):
            spark.conf.set(k, v)
        rows = spark.range(30000).selectExpr("id", "case when id % 10 < 6 then null when id % 10 < 9 then 'hot' else concat('k', id) end as k")
        keyed = spark.range(30000).selectExpr("concat('k', id) as k", "id as v").union(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
        sizes = [r[1] for r in salted_join(rows, keyed, ["k"], "left", "id").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000 and max(sizes) < 3 * 300
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
