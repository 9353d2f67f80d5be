"""The best row per facility: chosen behind the shuffle, against the plain window and the plain order of the steps."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridsight import fixed_values as V
from gridsight.functions.metrics import with_derived_metrics
from gridsight.functions.text import lookup, normalize_city
from gridsight.operators import cleaning, dedup, quality
from gridsight.operators.location import enrich_location, with_normal_city
from gridsight.plans.cleaning_run import clean
from gridsight.schemas import UNCHECKED

KEYS = ["company", "facility_name", "city"]
REGISTRY = "name string, tier string, region string, urls array<string>, facilities array<struct<facility_name:string>>"


def _order():
    prio = [F.desc(lookup(F.col(c), t, F.lit(0))) for c, t in (("pue_type", V.PUE_TYPE_PRIORITY), ("source_type", V.SOURCE_PRIORITY))]
    return [F.desc_nulls_last("year"), *prio, F.asc("id")]


def _rows(spark, n=3000):
    """A third of the rows have one key; NULL keys, unknown years, texts that are no numbers."""
    def pick(*values):
        return "element_at(array(" + ",".join("null" if v is None else repr(v) for v in values) + f"), cast(pmod(xxhash64(id, '{values[0]}'), {len(values)}) as int) + 1)"

    made = {
        "id": "concat('r', id)", "company": f"case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else {pick('a', 'B', 'c', 'd')} end",
        "facility_name": f"case when id % 3 = 0 then 'f' else {pick(None, 'f', 'g')} end",
        "city": f"case when id % 3 = 0 then 'x' else {pick(' navi mumbai', 'MUMBAI', 'Bombay', '', None, 'noida/greater noida')} end", "country": pick(None, "India", ""),
        "year": pick(None, "2020", "2021", "2021.7", "1990", "x"), "pue_value": pick(None, "1.5", "1.5d", "n/a", "3.0004", "1.25", None, "1.2"),
        "pue_type": pick(None, "TTM", "design", "odd"), "renewable_pct": pick(None, "50", "100.9", "101"), "capacity_mw": pick("3", None, "501"),
        "source_type": pick("press_release", None, "esg_report"), "tier": pick(None, "", "Tier 1 - Global Hyperscaler", "Tier 3 - Global Colocation"),
    }
    return spark.range(n).selectExpr(*[f"{e} as {c}" for c, e in made.items()])


@pytest.mark.parametrize("bits", [6, 25])
def test_best_row_equals_the_plain_window(spark, monkeypatch, bits):
    """With few bits nearly every row passes the first choice; years may be negative."""
    monkeypatch.setattr(dedup, "BITS", bits)
    df = _rows(spark).withColumn("year", F.when(F.col("id").endswith("7"), -5).otherwise(F.col("year").try_cast("int")))
    want = dedup.first_per_key(df, KEYS, _order())
    assert sorted(r.id for r in dedup.keep_best_quality(df).collect()) == sorted(r.id for r in want.collect())


def test_cleaning_equals_its_steps_in_order(spark):
    """Places, tiers and estimates filled in after the choice are those filled in before it."""
    registry = spark.createDataFrame([("A", "Tier 2 - Indian Operator", None, None, None), ("hot", "Tier 1 - Global Hyperscaler", None, None, None)], REGISTRY)
    df = _rows(spark)
    rows = cleaning.nan_cells_to_null(cleaning.normalize_schema(df, UNCHECKED, extra=("id",), keep_numbers=True))
    rows = cleaning.fill_missing_pue(cleaning.backfill_tier(enrich_location(rows), registry, "id"))
    rows = cleaning.with_storage_types(quality.valid_rows(rows, 2025))
    want = with_derived_metrics(dedup.first_per_key(rows, KEYS, _order()))
    got = clean(df, registry, 2025)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and want.count() > 20
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_tier_defaults_are_valid(spark):
    """A missing PUE passes the checks before it is estimated."""
    defaults = [*V.TIER_DEFAULT_PUE.values(), V.FALLBACK_PUE]
    df = spark.createDataFrame([("c", Decimal(str(v))) for v in defaults], "company string, pue_value decimal(5,3)")
    assert quality.valid_rows(df, 2025).count() == len(defaults)


def test_no_input_split_is_sorted_and_no_check_is_pushed_down(spark, tmp_path):
    _rows(spark, 200).write.parquet(str(tmp_path / "r"))
    df = clean(spark.read.parquet(str(tmp_path / "r")), spark.createDataFrame([], REGISTRY), 2025)
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    limits = [i for i, line in enumerate(plan) if "WindowGroupLimit" in line and "_salt" in line]
    assert limits
    for i in limits:
        assert "Exchange" in next(line for line in plan[i + 1:] if "Exchange" in line or "Scan" in line)
    assert not any(" Filter (" in line and "renewable_pct" in line for line in plan if "FileScan" not in line)


def test_listed_cities_are_looked_up_with_the_same_result(spark):
    listed = [*V.CITIES, *V.CITY_ALIASES]
    texts = [f(c) for c in listed for f in (str, str.lower, str.upper, lambda c: f"\u2003{c} ")]
    texts += [None, "", " ", "\u212aolkata", "\u212aochi", "m\u0130lan", "stra\u00dfe", "o'neill", "Navi  Mumbai", "x-y z9a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, city string")
    want = df.select("i", F.when(F.coalesce("city", F.lit("")) != "", normalize_city(F.col("city"))).otherwise(F.col("city")).alias("city"))
    assert sorted(map(tuple, with_normal_city(df).select("i", "city").collect())) == sorted(map(tuple, want.collect()))
