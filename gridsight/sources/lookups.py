"""Lookup relations made from the fixed values.

Each has a fixed number of rows (30 at most), so broadcasting them is safe at any scale.
"""

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsight import fixed_values as V
from gridsight import schemas
from gridsight.operators.location import country_key


def _money(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def city_dim(spark: SparkSession) -> DataFrame:
    """City with country, region and temperature; 26 rows."""
    rows = [(c, country, region, _money(t)) for c, (country, region, t) in V.CITIES.items()]
    return spark.createDataFrame(
        rows, "city string, country string, region string, avg_temp_celsius decimal(5,2)"
    )


def city_temperatures(spark: SparkSession) -> DataFrame:
    """Seed of mean temperatures; 19 rows, one per city."""
    return (
        city_dim(spark)
        .filter(F.col("avg_temp_celsius").isNotNull())
        .select("city", "country", "avg_temp_celsius")
    )


def country_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(V.COUNTRY_CODES.items()), "country string, country_code string"
    )


def country_index(spark: SparkSession) -> DataFrame:
    """Every name under which a country is known (``name_key``) with its two-letter code.

    The countries of ISO 3166 with their English names and codes are those of the Java platform;
    to these come the names of ``fixed_values``.  A few hundred rows, one per name.
    """
    locale = spark.sparkContext._jvm.java.util.Locale
    names: dict[str, str] = {}
    for code in locale.getISOCountries():
        place = locale("", code)
        for name in (place.getDisplayCountry(locale.ENGLISH), place.getISO3Country(), code):
            names.setdefault(name, code)
    names |= V.COUNTRY_ALIASES | V.COUNTRY_CODES
    rows = spark.createDataFrame(list(names.items()), "name string, country_code string")
    return rows.select(country_key(F.col("name")).alias("name_key"), "country_code").where("name_key <> ''").dropDuplicates(["name_key"])


def priorities(spark: SparkSession, table: dict) -> DataFrame:
    return spark.createDataFrame(list(table.items()), "key string, priority int")


def amounts(spark: SparkSession, table: dict) -> DataFrame:
    """Factor, tariff and default-PUE tables as (key, amount)."""
    rows = [(k, Decimal(v)) for k, v in table.items()]
    return spark.createDataFrame(rows, "key string, amount decimal(6,3)")


def company_registry(spark: SparkSession) -> DataFrame:
    """Built-in companies with their pages and known facilities; 24 rows."""
    known: dict[str, list] = {}
    for company, name, city, mw, racks, pue, source in V.KNOWN_FACILITIES:
        known.setdefault(company, []).append((name, city, Decimal(mw), racks, Decimal(pue), source))
    rows = [(n, tier, region, urls, known.get(n)) for n, tier, region, urls in V.COMPANIES]
    return spark.createDataFrame(rows, schemas.COMPANY_REGISTRY)
