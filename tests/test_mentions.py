"""Extraction from text: sentences with known results, and a brute-force comparison."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gridsight import fixed_values as V
from gridsight.operators import mentions as M
from gridsight.operators.location import place_in_text
from gridsight.operators.records import assemble_records, extraction_summary


def values(spark, extract, text):
    return spark.createDataFrame([(text,)], "text string").select(extract("text").alias("r")).first()["r"]


@pytest.mark.parametrize("text, first, kind, year", [
    ("The data center achieved a PUE of 1.09 in 2025.", 1.09, "operating", None),
    ("Designed with a PUE of 1.40.", 1.40, "design", None),
    ("Operating PUE is 1.45.", 1.45, "operating", None),
    ("Rolling average PUE reached 1.10.", 1.10, "TTM", None),
    ("In 2024, the PUE was 1.12.", 1.12, "operating", 2024),
])
def test_pue(spark, text, first, kind, year):
    found = values(spark, M.pue_mentions, text)
    assert (found[0].value, found[0].type, found[0].year) == (first, kind, year)


def test_pue_year_after_value(spark):
    found = values(spark, M.pue_mentions, "PUE of 1.09 for 2023")
    assert [(m.value, m.year) for m in found] == [(1.09, None), (1.09, 2023)]


def test_pue_out_of_range_and_many(spark):
    assert values(spark, M.pue_mentions, "The PUE is 0.5.") == []
    assert len(values(spark, M.pue_mentions, "Design PUE is 1.30 while operating PUE is 1.45.")) == 4


def test_default_patterns_miss_two_phrasings_that_the_extended_ones_cover(spark):
    twelve, mw = "Rolling twelve-month PUE reached 1.10.", "Capacity is 12.5 MW."
    assert values(spark, M.pue_mentions, twelve) == []
    assert values(spark, lambda t: M.pue_mentions(t, extended=True), twelve)[0].type == "TTM"
    assert values(spark, M.capacity_values, mw) == []
    assert values(spark, lambda t: M.capacity_values(t, extended=True), mw) == [12.5]


@pytest.mark.parametrize("extract, text, expected", [
    (M.wue_values, "Water Usage Effectiveness is 0.18 L/kWh.", [0.18]),
    (M.wue_values, "The facility uses 1.2 liters per kWh.", [1.2]),
    (M.wue_values, "No water usage data available.", []),
    (M.wue_values, "WUE of 10.5", []),
    (M.renewable_values, "We matched 100% of electricity with renewable energy.", [100]),
    (M.renewable_values, "The facility operates on 65% renewable energy.", [65]),
    (M.renewable_values, "Achieved 90% carbon-free energy.", [90, 90]),
    (M.renewable_values, "Fully renewable; earlier 40% renewable", [100]),
    (M.renewable_values, "No renewable energy information.", []),
    (M.capacity_values, "The data center has a capacity of 50 MW.", [50.0]),
    (M.capacity_values, "600 MW capacity", []),
    (M.capacity_values, "No capacity information.", []),
    (M.rack_values, "The facility has 7200 racks.", [7200]),
    (M.rack_values, "Capacity of 5,000 server racks.", [5000]),
    (M.years, "In 2024, the facility opened.", [2024]),
    (M.years, "Data from 2023 and 2024.", [2024, 2023]),
    (M.years, "In 1999, something happened.", []),
])
def test_other_metrics(spark, extract, text, expected):
    assert values(spark, extract, text) == expected


def brute_force(text):
    """Mentions by scanning with Python's own regular expressions."""
    out = []
    for pattern in V.PUE_PATTERNS:
        year_first = r"(\d{4})" in pattern and pattern.index(r"(\d{4})") < pattern.index(r"(\d+\.")
        for m in re.finditer(pattern, text, re.I):
            g = m.groups()
            value, year = (g[1], int(g[0])) if year_first else (g[0], int(g[1]) if len(g) == 2 else None)
            if 1.0 <= float(value) <= 3.0:
                around = text[max(0, m.start() - 50) : m.end() + 50]
                kind = next((n for n, p in V.PUE_TYPE_PATTERNS if re.search(p, around, re.I)), "operating")
                out.append((float(value), kind, year, around.strip()))
    return out


def test_mentions_equal_brute_force_on_random_text(spark):
    rng = random.Random(7)
    pieces = ["PUE of 1.2", "PUE 1.45", "design PUE is 1.3", "in 2024", "for 2019 ", "\n", " ", "é😀", "annual", "rolling average PUE reached 1.9",
              "PUE: 9.9", "x" * 60, "fleet-wide PUE 1.1", "pue\t1.07", "Power Usage Effectiveness is 2.5", "target", " ", "\r", "."]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", M.pue_mentions("text").alias("m")).collect()
    for r in rows:
        assert [(m.value, m.type, m.year, m.context) for m in r.m] == brute_force(texts[r.id]), texts[r.id]


def test_place_takes_the_first_listed_city(spark):
    df = spark.createDataFrame([("Navi Mumbai and Pune",), ("LONDON",), ("nowhere",)], "text string")
    got = [r.p for r in df.select(place_in_text(F.col("text")).alias("p")).collect()]
    assert [(p.city, p.country) if p else None for p in got] == [("Mumbai", "India"), ("London", "United Kingdom"), None]


def texts(spark, *rows):
    return spark.createDataFrame([("c", "u", "web_page", t) for t in rows], "company string, source_url string, source_type string, text string")


def test_record_variants(spark):
    df = texts(spark, "PUE of 1.2 near Tokyo, 50 MW capacity", "only 65% renewable energy", "7200 racks", "nothing")
    assert sorted((r.pue_value is None, r.renewable_pct) for r in assemble_records(df, "2025-06-30", "global").collect()) == [(False, None), (True, 65)]
    assert assemble_records(df, "2025-06-30", "colocation").count() == 1
    india = assemble_records(df, "2025-06-30", "india").first()
    assert (india.city, india.country, india.region, india.country_code, india.year) == ("Tokyo", "Japan", "India", "JP", 2025)
    assert str(india.extraction_date) == "2025-06-30"


def test_unknown_variant_is_refused(spark):
    with pytest.raises(ValueError):
        assemble_records(texts(spark, "x"), "2025-06-30", "other")


def test_extraction_summary(spark):
    df = assemble_records(texts(spark, "PUE of 1.2", "65% renewable energy"), "2025-06-30")
    companies = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert tuple(extraction_summary(df, companies).first()) == (3, 2, 1, 1)
