"""Enrichment, imputation, deduplication and data quality."""

from pyspark.sql import functions as F

from gridsight.catalog import fixtures as X
from gridsight.catalog.base import places, query, scratch
from gridsight.catalog.oracle_sql import BEST, dbl, mean, with_ctes
from gridsight.functions.text import normalize_city
from gridsight.operators import cleaning, dedup, location, quality, star
from gridsight.plans import cleaning_run
from gridsight.sources import readers, writers


@query("enr01_normalize_city", with_ctes("SELECT id, norm_city AS city FROM normalized", "normalized"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select("id", normalize_city(F.col("city")).alias("city"))


@query("enr02_city_country", with_ctes(
    "SELECT id, d_country AS country FROM normalized LEFT JOIN city_dim ON norm_city = d_city", "normalized", "city_dim"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select("id", location.country_of(F.col("city")).alias("country"))


@query("enr03_city_region", with_ctes(
    "SELECT id, d_region AS region, d_temp::DOUBLE AS temperature FROM normalized LEFT JOIN city_dim ON norm_city = d_city", "normalized", "city_dim"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select(
        "id", location.region_of(F.col("city")).alias("region"), location.temperature_of(F.col("city")).alias("temperature")
    )


@query("enr04_country_code", with_ctes(
    "SELECT id, country, k_code AS country_code FROM enriched LEFT JOIN codes ON country = k_country", "enriched", "codes"))
def _(spark, sf):
    return X.enriched(spark, sf).select("id", "country", location.country_code_of(F.col("country")).alias("country_code"))


@query("enr05_enrich_location", with_ctes(
    "SELECT id, city, country, region, avg_temp_celsius::DOUBLE AS avg_temp_celsius, country_code FROM enriched", "enriched"))
def _(spark, sf):
    return X.enriched(spark, sf).select("id", "city", "country", "region", "avg_temp_celsius", "country_code")


@query("enr06_backfill_tier", with_ctes(
    "SELECT id, coalesce(r.tier, g.tier) AS tier FROM raw_pue r LEFT JOIN registry g ON lower(r.company) = lower(g.name)", "raw_pue", "registry"))
def _(spark, sf):
    return cleaning.backfill_tier(X.raw_pue(spark, sf), X.registry(spark, sf)).select("id", "tier")


@query("enr07_fill_missing_pue", with_ctes("""
SELECT id, coalesce(pue_value, CAST(coalesce(p_pue, 1.50) AS DECIMAL(5,3)))::DOUBLE AS pue_value,
  CASE WHEN pue_value IS NULL THEN 'estimated' ELSE pue_type END AS pue_type,
  CASE WHEN pue_value IS NULL THEN 'benchmark' ELSE source_type END AS source_type
FROM raw_pue LEFT JOIN tier_pue ON tier = p_tier""", "raw_pue", "tier_pue"))
def _(spark, sf):
    return cleaning.fill_missing_pue(X.raw_pue(spark, sf)).select("id", "pue_value", "pue_type", "source_type")


_CLEAN = (
    "id, company, facility_name, city, country, region, year, " + dbl("pue_value") + ", pue_type, " + dbl("capacity_mw")
    + ", rack_count, renewable_pct, " + dbl("wue_l_per_kwh", "avg_temp_celsius", "cooling_overhead_pct", "annual_waste_mwh")
    + ", country_code, source_url, source_type, tier"
)


@query("enr08_cleaning_run", with_ctes(f"SELECT {_CLEAN} FROM cleaned", "cleaned"))
def _(spark, sf):
    return X.clean_run(spark, sf).drop("extraction_date")


@query("enr09_quality_dedup", with_ctes(f"SELECT id, company, facility_name, city FROM ({BEST.format(src='enriched')})", "enriched", "type_prio", "source_prio"))
def _(spark, sf):
    return dedup.keep_best_quality(X.enriched(spark, sf)).select("id", "company", "facility_name", "city")


@query("win03_best_row_per_key", with_ctes(f"SELECT id FROM ({BEST.format(src='raw_pue')})", "raw_pue", "type_prio", "source_prio"))
def _(spark, sf):
    return dedup.keep_best_quality(X.raw_pue(spark, sf)).select("id")


@query("win04_first_row_per_key", with_ctes("""
SELECT 'company' AS by_what, id FROM (SELECT id, row_number() OVER (PARTITION BY company ORDER BY id) AS n FROM raw_pue) WHERE n = 1 UNION ALL
SELECT 'place', id FROM (SELECT id, row_number() OVER (PARTITION BY city, country ORDER BY id) AS n FROM raw_pue) WHERE n = 1""", "raw_pue"))
def _(spark, sf):
    raw = X.raw_pue(spark, sf)
    firsts = [
        dedup.first_in_input_order(raw, keys).select(F.lit(what).alias("by_what"), "id")
        for what, keys in (("company", ["company"]), ("place", ["city", "country"]))
    ]
    return cleaning.append_all(firsts)


_SIMPLE = """SELECT '{m}' AS mode, id, company, coalesce(facility_name, '') AS facility_name, coalesce(city, '') AS city FROM (
  SELECT *, row_number() OVER (PARTITION BY company, coalesce(facility_name, ''), coalesce(city, '') ORDER BY {o} id) AS n FROM raw_pue) WHERE n = 1"""


@query("win05_simple_dedup", with_ctes(" UNION ALL ".join([
    _SIMPLE.format(m="newest", o="year DESC NULLS LAST,"), _SIMPLE.format(m="first", o=""), _SIMPLE.format(m="last", o="")]), "raw_pue"))
def _(spark, sf):
    raw = X.raw_pue(spark, sf)
    kept = [
        dedup.keep_simple(raw, keep=m).select(F.lit(m).alias("mode"), "id", "company", "facility_name", "city")
        for m in ("newest", "first", "last")
    ]
    return cleaning.append_all(kept)


def _check(name: str, column: str, condition: str, check) -> None:
    @query(name, with_ctes(f"SELECT id, {condition} AS is_valid FROM raw_pue", "raw_pue"))
    def _(spark, sf):
        return X.raw_pue(spark, sf).select("id", check(F.col(column)).alias("is_valid"))


_check("dq01_valid_pue", "pue_value", "coalesce(pue_value BETWEEN 1.0 AND 3.0, false)", quality.valid_pue)
_check("dq02_valid_renewable", "renewable_pct", "coalesce(renewable_pct BETWEEN 0 AND 100, true)", quality.valid_renewable)
_check("dq03_valid_wue", "wue_l_per_kwh", "coalesce(wue_l_per_kwh BETWEEN 0 AND 10, true)", quality.valid_wue)
_check("dq04_valid_capacity", "capacity_mw", "coalesce(capacity_mw > 0 AND capacity_mw <= 500, true)", quality.valid_capacity)
_check("dq05_valid_racks", "rack_count", "coalesce(rack_count > 0 AND rack_count <= 50000, true)", quality.valid_racks)
_check("dq06_valid_year", "year", "coalesce(year BETWEEN 2000 AND 2023, true)", lambda c: quality.valid_year(c, 2022))


@query("dq07_row_validation", with_ctes("""
SELECT id, 'Row ' || id || ' (' || company || '): ' || array_to_string(list_filter([
  CASE WHEN pue_value IS NULL THEN 'Missing required field: pue_value' END,
  CASE WHEN NOT coalesce(pue_value BETWEEN 1.0 AND 3.0, false) THEN 'Invalid PUE value: ' || coalesce(pue_value::VARCHAR, 'None') END,
  CASE WHEN renewable_pct NOT BETWEEN 0 AND 100 THEN 'Invalid renewable %: ' || renewable_pct::VARCHAR END,
  CASE WHEN wue_l_per_kwh NOT BETWEEN 0 AND 10 THEN 'Invalid WUE: ' || wue_l_per_kwh::VARCHAR END,
  CASE WHEN NOT (capacity_mw > 0 AND capacity_mw <= 500) THEN 'Invalid capacity: ' || capacity_mw::VARCHAR END,
  CASE WHEN NOT (rack_count > 0 AND rack_count <= 50000) THEN 'Invalid rack count: ' || rack_count::VARCHAR END,
  CASE WHEN year NOT BETWEEN 2000 AND 2023 THEN 'Invalid year: ' || year::VARCHAR END], lambda x: x IS NOT NULL), ', ') AS message
FROM raw_pue WHERE NOT (coalesce(pue_value BETWEEN 1.0 AND 3.0, false) AND coalesce(renewable_pct BETWEEN 0 AND 100, true)
  AND coalesce(wue_l_per_kwh BETWEEN 0 AND 10, true) AND coalesce(capacity_mw > 0 AND capacity_mw <= 500, true)
  AND coalesce(rack_count > 0 AND rack_count <= 50000, true) AND coalesce(year BETWEEN 2000 AND 2023, true))""", "raw_pue"))
def _(spark, sf):
    return quality.error_messages(X.raw_pue(spark, sf), 2022)


@query("dq07_valid_rows", with_ctes("SELECT id FROM valid", "valid"))
def _(spark, sf):
    rows = cleaning.backfill_tier(X.enriched(spark, sf), X.registry(spark, sf))
    return quality.valid_rows(cleaning.fill_missing_pue(rows), X.AS_OF_YEAR).select("id")


@query("dq08_constraint_gate", with_ctes("""
SELECT id, array_to_string(list_filter([CASE WHEN year IS NULL THEN 'year_not_null' END, CASE WHEN pue_value IS NULL THEN 'pue_not_null' END,
  CASE WHEN pue_value NOT BETWEEN 1.0 AND 3.0 THEN 'pue_range' END, CASE WHEN renewable_pct NOT BETWEEN 0 AND 100 THEN 'renewable_range' END],
  lambda x: x IS NOT NULL), ',') AS reasons FROM raw_pue
WHERE year IS NULL OR pue_value IS NULL OR pue_value NOT BETWEEN 1.0 AND 3.0 OR renewable_pct NOT BETWEEN 0 AND 100""", "raw_pue"))
def _(spark, sf):
    _, rejected = quality.split_by_constraints(X.raw_pue(spark, sf))
    return rejected.select("id", F.array_join("reasons", ",").alias("reasons"))


_UNIQUE = [
    ("raw_id", "raw_pue", "id"), ("source_url", "raw_pue", "source_url"), ("fact_id", "fact", "fact_id"),
    ("company_name", "dim_company", "company_name"), ("location_id", "dim_location", "location_id"),
]


def _tested_tables(spark, sf):
    facts, companies, locations = X.star(spark, sf)
    return {"raw_pue": X.raw_pue(spark, sf), "fact": facts, "dim_company": companies, "dim_location": locations}


@query("dq09_unique_keys", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS test, {c} AS key, count(*) AS n_records FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    for t, table, c in _UNIQUE), "raw_pue", "fact", "dim_company", "dim_location"))
def _(spark, sf):
    tables = _tested_tables(spark, sf)
    return cleaning.append_all([
        quality.duplicate_keys(tables[table], [c]).select(F.lit(t).alias("test"), F.col(c).alias("key"), "n_records")
        for t, table, c in _UNIQUE
    ])


_NOT_NULL = [
    ("raw_id", "raw_pue", "id"), ("raw_company", "raw_pue", "company"), ("raw_pue_value", "raw_pue", "pue_value"),
    ("company_id", "dim_company", "company_id"), ("location_id", "dim_location", "location_id"),
    ("fact_id", "fact", "fact_id"), ("fact_pue_value", "fact", "pue_value"),
]


@query("dq10_not_null", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS test, count(*) AS failures FROM {table} WHERE {c} IS NULL" for t, table, c in _NOT_NULL),
    "raw_pue", "fact", "dim_company", "dim_location"))
def _(spark, sf):
    tables = _tested_tables(spark, sf)
    return cleaning.append_all([
        quality.null_rows(tables[table], c).agg(F.count(F.lit(1)).alias("failures")).select(F.lit(t).alias("test"), "failures")
        for t, table, c in _NOT_NULL
    ])


@query("dq11_accepted_values", with_ctes(
    "SELECT pue_value::DOUBLE AS pue_value, count(*) AS n_records, 'warn' AS severity FROM raw_pue WHERE pue_value BETWEEN 1.0 AND 3.0 "
    "AND pue_value NOT IN (1.0, 1.5, 2.0, 2.5, 3.0) GROUP BY pue_value", "raw_pue"))
def _(spark, sf):
    where = F.col("pue_value").between(1.0, 3.0)
    return quality.unexpected_values(X.raw_pue(spark, sf), "pue_value", [1.0, 1.5, 2.0, 2.5, 3.0], where, "warn")


@query("dq12_foreign_keys", with_ctes("""
SELECT 'company' AS dim, f.fact_id FROM fact f ANTI JOIN dim_company d USING (company_id) UNION ALL
SELECT 'country_of_place', f.fact_id FROM fact f ANTI JOIN (SELECT * FROM dim_location WHERE country IS NOT NULL) d USING (location_id)
WHERE f.location_id IS NOT NULL""", "fact", "dim_company", "dim_location"))
def _(spark, sf):
    facts, companies, locations = X.star(spark, sf)
    known = locations.filter(F.col("country").isNotNull())
    return cleaning.append_all([
        quality.orphans(facts, companies, "company_id", hot=X.hot_keys(spark, sf)).select(F.lit("company").alias("dim"), "fact_id"),
        quality.orphans(facts, known, "location_id", hot=X.hot_keys(spark, sf)).select(F.lit("country_of_place").alias("dim"), "fact_id"),
    ])


@query("dq13_output_contract", with_ctes("""
SELECT true AS has_columns, count(*) > 0 AS not_empty, coalesce(bool_and(coalesce(pue_value BETWEEN 1.0 AND 3.0, false)), true) AS pue_in_range,
  coalesce(bool_and(company IS NOT NULL), true) AS company_present, coalesce(bool_and(year BETWEEN 2000 AND 2030), true) AS year_in_range FROM cleaned""",
    "cleaned"))
def _(spark, sf):
    return quality.output_contract(X.cleaned(spark, sf))


@query("snk07_store_failures", with_ctes("""
SELECT 'not_null_pue' AS test, count(*) AS failures FROM raw_pue WHERE pue_value IS NULL UNION ALL
SELECT 'not_null_year', count(*) FROM raw_pue WHERE year IS NULL""", "raw_pue"))
def _(spark, sf):
    root, raw = scratch(spark, "dq"), X.raw_pue(spark, sf)
    tests = {"not_null_pue": "pue_value", "not_null_year": "year"}
    writers.store_failures({t: quality.null_rows(raw, c) for t, c in tests.items()}, root)
    return cleaning.append_all([
        readers.read_table(spark, f"{root}/dq_failures/{t}").agg(F.count(F.lit(1)).alias("failures")).select(F.lit(t).alias("test"), "failures")
        for t in tests
    ])


@query("srt04_final_order", with_ctes("SELECT row_number() OVER (ORDER BY tier NULLS LAST, company NULLS LAST, pue_value NULLS LAST, id) AS place, id FROM cleaned", "cleaned"))
def _(spark, sf):
    return places(cleaning_run.final_order(X.cleaned(spark, sf)))


@query("srt07_first_errors", with_ctes("""
SELECT id FROM raw_pue WHERE NOT (coalesce(pue_value BETWEEN 1.0 AND 3.0, false) AND coalesce(renewable_pct BETWEEN 0 AND 100, true)
  AND coalesce(wue_l_per_kwh BETWEEN 0 AND 10, true)) ORDER BY id LIMIT 10""", "raw_pue"))
def _(spark, sf):
    return quality.error_messages(X.raw_pue(spark, sf), X.AS_OF_YEAR).orderBy("id").limit(10).select("id")


def _tier(n: int) -> str:
    return mean(f"(CASE WHEN contains(tier, 'Tier {n}') THEN pue_value END)", 3, 3)


@query("agg12_summary_stats", with_ctes(f"""
SELECT count(*) AS total_facilities, count(DISTINCT company) AS total_companies, count(pue_value) AS companies_with_pue,
  {mean('pue_value', 3, 3)} AS avg_pue_all, {_tier(1)} AS avg_pue_tier1, {_tier(2)} AS avg_pue_tier2, {_tier(3)} AS avg_pue_tier3,
  {mean('renewable_pct', 0, 1)} AS avg_renewable_pct,
  count(*) FILTER (pue_type = 'operating') AS operating_records, count(*) FILTER (pue_type = 'design') AS design_records,
  count(*) FILTER (pue_type = 'TTM') AS ttm_records, count(*) FILTER (pue_type = 'estimated') AS estimated_records,
  round(sum(capacity_mw), 1)::DOUBLE AS total_capacity_mw, min(year)::VARCHAR || '-' || max(year)::VARCHAR AS year_range,
  CASE WHEN count(*) = 0 THEN 'No valid records after cleaning' END AS status FROM cleaned""", "cleaned"))
def _(spark, sf):
    return cleaning_run.summary_stats(X.cleaned(spark, sf))


@query("agg13_size_gate", with_ctes(
    "SELECT count(*) AS total_facilities, count(DISTINCT company) AS total_companies, count(*) >= 20 AND count(DISTINCT company) >= 15 AS meets_requirements FROM cleaned",
    "cleaned"))
def _(spark, sf):
    return quality.size_gate(X.cleaned(spark, sf))


@query("jn03_insert_company", with_ctes("""
SELECT company_id, company_name, 'as it was' AS tier, NULL::VARCHAR AS region, false AS is_new FROM dim_company WHERE company_name < 'Supplier#000000005' UNION ALL
SELECT company_id, company_name, tier, region, true FROM dim_company WHERE company_name >= 'Supplier#000000005'""", "dim_company"))
def _(spark, sf):
    """Rows that are there differ from the candidates, and stay as they are."""
    found = star.company_candidates(X.warehouse_rows(spark, sf))
    existing = found.filter("company_name < 'Supplier#000000005'").withColumns({"tier": F.lit("as it was"), "region": F.lit(None).cast("string"), "is_new": F.lit(False)})
    return star.upserted(found.withColumn("is_new", F.lit(True)), existing, "company_id")


@query("jn04_insert_location", with_ctes("""
SELECT location_id, city, country, country_code, region, avg_temp_celsius::DOUBLE AS avg_temp_celsius, country IS NOT NULL AS is_new FROM dim_location""",
    "dim_location"))
def _(spark, sf):
    found = star.location_candidates(X.warehouse_rows(spark, sf))
    existing = found.filter("country is null").withColumn("is_new", F.lit(False))
    return star.upserted(found.withColumn("is_new", F.lit(True)), existing, "location_id")


@query("jn05_fact_keys", with_ctes(
    "SELECT fact_id, company_id, location_id, year, " + dbl("pue_value", "capacity_mw", "cooling_overhead_pct", "annual_waste_mwh")
    + ", rack_count, renewable_pct, source_type, strftime(extraction_date, '%Y-%m-%d') AS extraction_date FROM fact", "fact"))
def _(spark, sf):
    return X.fact_load(spark, sf).select(
        "fact_id", "company_id", "location_id", "year", "pue_value", "capacity_mw", "cooling_overhead_pct", "annual_waste_mwh",
        "rack_count", "renewable_pct", "source_type", "extraction_date",
    )


@query("jn07_orphan_probe", with_ctes(
    "SELECT fact_id, company_id FROM fact WHERE company_id IN (SELECT company_id FROM dim_company WHERE company_name < 'Supplier#000000003')", "fact", "dim_company"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    some = companies.filter("company_name >= 'Supplier#000000003'")
    return quality.orphans(facts, some, "company_id", hot=X.hot_keys(spark, sf)).select("fact_id", "company_id")
