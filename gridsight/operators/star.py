"""Star schema: dimensions are inserted if absent, facts get their keys."""

from pyspark.sql import Column, DataFrame, functions as F

from gridsight.functions.metrics import annual_waste_mwh, cooling_overhead_pct
from gridsight.operators.dedup import first_in_input_order
from gridsight.operators.joins import frequent_keys, salted_join
from gridsight.operators.quality import split_by_constraints


def key_of(*parts: str | Column) -> Column:
    """Key computed from the natural key: the same on every run and on every executor.

    A missing part counts as the empty string; a bar within a part is escaped.
    """
    cols = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]
    if len(cols) > 1:
        cols = [F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for c in cols]
    return F.sha2(F.concat_ws("|", *cols), 256)


def company_candidates(df: DataFrame, seq: str = "id") -> DataFrame:
    """First row of every company."""
    named = df.filter(F.col("company").isNotNull()).select(seq, "company", "tier", "region")
    return first_in_input_order(named, ["company"], seq).select(
        key_of("company").alias("company_id"), F.col("company").alias("company_name"), "tier", "region"
    )


def location_candidates(df: DataFrame, seq: str = "id") -> DataFrame:
    """First row of every (city, country) with a city; no country and an empty one are the same place."""
    placed = df.dropna(subset=["city"]).filter("city <> ''")
    placed = placed.select(seq, "city", "country", "country_code", "region", "avg_temp_celsius")
    placed = placed.withColumn("country", F.nullif("country", F.lit("")))
    return first_in_input_order(placed, ["city", "country"], seq).select(
        key_of("city", "country").alias("location_id"),
        "city", "country", "country_code", "region", "avg_temp_celsius",
    )


def absent_from(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not there yet; rows that are there are never changed."""
    return candidates.join(existing.select(key), key, "left_anti")


def upserted(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return existing.unionByName(absent_from(candidates, existing, key))


def _with_keys(df: DataFrame) -> DataFrame:
    has_city = F.coalesce("city", F.lit("")) != ""
    return df.withColumns({"company_id": key_of("company"), "_place_key": F.when(has_city, key_of("city", "country"))})


def lookup_hot_keys(df: DataFrame) -> DataFrame:
    """The hot companies and places of rows that are to become facts; see ``frequent_keys``."""
    return frequent_keys(_with_keys(split_by_constraints(df)[0]), ["company_id"], ["_place_key"])


def absent_keys(df: DataFrame, dim_company: DataFrame, dim_location: DataFrame) -> DataFrame:
    """``company_id`` and ``_place_key`` of rows that are to become facts, as far as the dimensions
    lack them: a row per key, with NULL for the other.

    Companies and places are reduced to distinct ones before their keys are computed and compared,
    so no row is shuffled.  After an insertion of the rows' own companies and places hardly any key
    is left.
    """
    good = _with_keys(split_by_constraints(df)[0])
    companies = good.select("company").distinct().select(key_of("company").alias("company_id")).distinct()
    places = good.where("_place_key is not null").select("city", "country").distinct().select(key_of("city", "country").alias("_place_key")).distinct()
    companies = absent_from(companies, dim_company, "company_id").select("company_id", F.lit(None).cast("string").alias("_place_key"))
    there = dim_location.select(F.col("location_id").alias("_place_key"))
    return companies.unionByName(absent_from(places, there, "_place_key").select(F.lit(None).cast("string").alias("company_id"), "_place_key"))


def fact_rows(
    df: DataFrame, dim_company: DataFrame, dim_location: DataFrame, seq: str = "id", hot: DataFrame | None = None, absent: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Accepted facts and rejected rows with their reasons.

    A row whose company is not in the dimension is rejected as ``unknown_company``; an unknown
    place leaves the location key NULL.
    A key is computed from the row itself, so all there is to find is whether the dimension has
    it: rows are joined to the keys that it lacks.  These are few, as a rule, and then the rows are not
    shuffled; if they are many, both joins are salted, so large companies and places stay spread.
    ``hot`` (``lookup_hot_keys`` of the rows) and ``absent`` (``absent_keys``), stored beside the
    rows, save finding them anew for each join.
    """
    good, rejected = split_by_constraints(df)
    absent = absent_keys(df, dim_company, dim_location) if absent is None else absent
    places = absent.where("_place_key is not null").select(F.col("_place_key").alias("_place"), F.lit(True).alias("_nowhere"))
    companies = absent.where("company_id is not null").select("company_id", F.lit(True).alias("_unknown"))
    keyed = salted_join(_with_keys(good), companies, ["company_id"], "left", seq, hot)
    unknown = keyed.where("_unknown").select(*good.columns)
    located = salted_join(keyed.where("_unknown is null"), places, {"_place_key": "_place"}, "left", seq, hot)
    located = located.withColumn("location_id", F.when(F.col("_nowhere").isNull(), F.col("_place_key")))
    facts = located.select(
        F.sha2(F.col(seq), 256).alias("fact_id"),
        "company_id",
        "location_id",
        "facility_name",
        "year",
        "pue_value",
        "pue_type",
        "capacity_mw",
        "rack_count",
        "renewable_pct",
        "wue_l_per_kwh",
        cooling_overhead_pct(F.col("pue_value")).cast("decimal(6,3)").alias("cooling_overhead_pct"),
        F.round(annual_waste_mwh(F.col("pue_value"), F.col("capacity_mw")), 2)
        .cast("decimal(15,2)")
        .alias("annual_waste_mwh"),
        "source_url",
        "source_type",
        "extraction_date",
    )
    reasons = F.array(F.lit("unknown_company"))
    return facts, rejected.unionByName(unknown.withColumn("reasons", reasons), allowMissingColumns=True)


def with_audit(df: DataFrame, at: str) -> DataFrame:
    """New rows with the times of creation and last change."""
    now = F.lit(at).cast("timestamp")
    return df.withColumns({"created_at": now, "updated_at": now})


def rewritten(existing: DataFrame, changes: DataFrame, key: str, column: str, at: str) -> DataFrame:
    """Existing rows with a changed column value; only rows that change get a new ``updated_at``."""
    new = changes.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = existing.join(new, key, "left")
    changed = F.coalesce("_hit", F.lit(False)) & ~F.col(column).eqNullSafe(F.col("_new"))
    return joined.select(
        *[
            F.when(changed, F.col("_new")).otherwise(F.col(c)).alias(c) if c == column
            else F.when(changed, F.lit(at).cast("timestamp")).otherwise(F.col(c)).alias(c) if c == "updated_at"
            else F.col(c)
            for c in existing.columns
        ]
    )
