"""Place names: normalising, looking up and reading them from text."""

from pyspark.sql import Column, DataFrame, functions as F

from gridsight import fixed_values as V
from gridsight.functions.text import lookup, normalize_city, strip, title_case

_COUNTRY = {c: v[0] for c, v in V.CITIES.items()}
_REGION = {c: v[1] for c, v in V.CITIES.items() if v[1]}
_TEMPERATURE = {c: v[2] for c, v in V.CITIES.items() if v[2]}
#: Listed names and aliases in small letters, with the normal form.
_NORMAL = {c.lower(): V.CITY_ALIASES.get(c, c) for c in [*V.CITIES, *V.CITY_ALIASES] if c.isascii() and c == c.lower().title()}


def country_of(city: Column) -> Column:
    return lookup(normalize_city(city), _COUNTRY)


def region_of(city: Column) -> Column:
    return lookup(normalize_city(city), _REGION)


def temperature_of(city: Column) -> Column:
    return lookup(normalize_city(city), _TEMPERATURE).cast("decimal(5,2)")


def country_code_of(country: Column) -> Column:
    return lookup(country, V.COUNTRY_CODES)


def country_key(name: Column) -> Column:
    """A country's name without case, accents, marks and a leading article."""
    plain = F.regexp_replace(F.lower(F.translate(name, "ÅÇÉÔãåçèéíôöü", "ACEOaaceeioou")), r"[^\p{L}\p{N}]+", " ")
    return F.regexp_replace(F.trim(F.replace(F.concat(F.lit(" "), plain, F.lit(" ")), F.lit(" and "), F.lit(" "))), r"^the ", "")


def resolve_countries(df: DataFrame, index: DataFrame, country: str = "country", code: str = "country_code") -> DataFrame:
    """``df`` with the code of every country that the index knows under some name; others are NULL.

    The index has a few hundred rows, so Spark broadcasts it.
    """
    named = index.select(F.col("name_key").alias("_key"), F.col("country_code").alias("_code"))
    joined = df.withColumn("_wanted", country_key(F.col(country))).join(named, F.col("_wanted") == F.col("_key"), "left")
    return joined.select(*[c for c in df.columns if c != code], F.col("_code").alias(code))


def with_normal_city(df: DataFrame) -> DataFrame:
    """Given cities in their normal form; its steps are columns, so that each runs once per row.

    Listed names, in any case, are looked up; only others are stripped and capitalised.
    """
    city, small, known = F.col("city"), F.col("_small"), F.col("_known")
    plain = F.octet_length(small) == F.octet_length(city)  # a letter of another script may have a small Latin one
    named = df.withColumn("_small", F.lower(city)).withColumn("_known", F.when(plain, lookup(small, _NORMAL)))
    named = named.withColumn("_stripped", F.when(known.isNull(), strip(city))).withColumn("_name", title_case(F.col("_stripped")))
    normal = F.when(F.coalesce(city, F.lit("")) == "", city).otherwise(F.coalesce(known, lookup(F.col("_name"), V.CITY_ALIASES, F.col("_name"))))
    return named.withColumn("city", normal).drop("_small", "_known", "_stripped", "_name")


def enrich_location(df: DataFrame) -> DataFrame:
    """Where a city is given: normalise it, fill a missing country and region, set temperature
    and country code.  Rows without a city keep what they have."""
    had_city = F.coalesce("city", F.lit("")) != ""
    return enrich_normal(with_normal_city(df.withColumn("_had", had_city)), F.col("_had")).drop("_had")


def enrich_normal(df: DataFrame, has_city: Column) -> DataFrame:
    """The same for cities in normal form.

    The tables have 26 rows, so they are map literals: no join and no shuffle.
    """
    if "avg_temp_celsius" not in df.columns:
        df = df.withColumn("avg_temp_celsius", F.lit(None).cast("decimal(5,2)"))
    if "country_code" not in df.columns:
        df = df.withColumn("country_code", F.lit(None).cast("string"))
    city = F.col("city")
    return (
        df.withColumns(
            {
                "country": F.when(
                    has_city, F.coalesce(F.nullif("country", F.lit("")), lookup(city, _COUNTRY))
                ).otherwise(F.col("country")),
                "region": F.when(
                    has_city, F.coalesce(F.nullif("region", F.lit("")), lookup(city, _REGION))
                ).otherwise(F.col("region")),
                "avg_temp_celsius": F.when(
                    has_city, lookup(city, _TEMPERATURE).cast("decimal(5,2)")
                ).otherwise(F.col("avg_temp_celsius")),
            }
        )
        .withColumn(
            "country_code",
            F.when(
                has_city & (F.coalesce("country", F.lit("")) != ""), country_code_of(F.col("country"))
            ).otherwise(F.col("country_code")),
        )
    )


def place_in_text(text: Column) -> Column:
    """struct(city, country) of the first listed city that occurs in the text, else NULL."""
    low = F.lower(text)
    hit = None
    for word, city, country in V.TEXT_CITIES:
        found = F.contains(low, F.lit(word))
        place = F.struct(F.lit(city).alias("city"), F.lit(country).alias("country"))
        hit = F.when(found, place) if hit is None else hit.when(found, place)
    return hit
