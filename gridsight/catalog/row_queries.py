"""Sources, projections and filters."""

import pandas as pd
from pyspark.sql import functions as F, types as T

from gridsight import fixed_values as V
from gridsight import schemas
from gridsight.catalog import fixtures as X
from gridsight.catalog.base import query, scratch
from gridsight.catalog.oracle_sql import dbl, with_ctes
from gridsight.functions import metrics
from gridsight.functions.text import fixed_point
from gridsight.operators import cleaning, records, search
from gridsight.plans.marts import staging
from gridsight.session import short_shuffles
from gridsight.sources import lookups, readers, writers

_RECORD = (
    "company, facility_name, city, country, region, year, " + dbl("pue_value") + ", pue_type, " + dbl("capacity_mw")
    + ", rack_count, renewable_pct, " + dbl("wue_l_per_kwh")
    + ", source_url, source_type, strftime(extraction_date, '%Y-%m-%d') AS extraction_date, tier"
)
# CSV cannot tell an empty text from a missing one
_CSV_RECORD = _RECORD.replace("city, country", "nullif(trim(city), '') AS city, country")


def _as_array(batches):
    """Lines of one JSON array, streamed: a bracket, the records, a bracket."""
    opening = "["
    for batch in batches:
        if len(batch):
            lines = "," + batch["value"]
            lines.iloc[0] = (opening if opening == "[" else ",") + batch["value"].iloc[0]
            opening = ""
            yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": [opening + "]"]})


@query("src01_json_array_files", with_ctes(f"SELECT id, {_RECORD} FROM raw_pue", "raw_pue"))
def _(spark, sf):
    """Every written partition becomes a file with one array, compressed: every record repeats all names."""
    path = scratch(spark, "arrays")
    lines = X.raw_pue(spark, sf).select(F.to_json(F.struct("*")).alias("value")).mapInPandas(_as_array, "value string")
    with short_shuffles(spark):
        lines.write.option("compression", "gzip").text(path)
    unchecked = T.StructType([T.StructField("id", T.StringType())] + schemas.UNCHECKED.fields)
    found, _skipped = readers.read_records_json(spark, path, unchecked, glob="*.txt.gz")
    return cleaning.normalize_schema(found, extra=("id",))


@query("src02_clean_csv_scan", with_ctes(f"SELECT id, {_CSV_RECORD} FROM raw_pue", "raw_pue"))
def _(spark, sf):
    path = scratch(spark, "csv")
    rows = X.raw_pue(spark, sf).withColumn("city", F.trim("city"))
    rows.write.option("header", True).csv(path)
    schema = "id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RECORD.fields)
    return readers.read_clean_csv(spark, path, schema)


@query("src03_city_seed", with_ctes(
    "SELECT d_city AS city, d_country AS country, d_temp::DOUBLE AS avg_temp_celsius, count(id) AS records "
    "FROM city_dim LEFT JOIN enriched ON city = d_city WHERE d_temp IS NOT NULL GROUP BY ALL", "enriched"))
def _(spark, sf):
    seed = lookups.city_temperatures(spark)
    per_city = X.enriched(spark, sf).groupBy("city").agg(F.count("id").alias("n"))
    return seed.join(per_city, "city", "left").select(
        "city", "country", "avg_temp_celsius", F.coalesce("n", F.lit(0)).alias("records")
    )


@query("src04_company_registry_urls", with_ctes(
    "SELECT name, tier, region, 0 AS url_no, url0 AS url FROM registry UNION ALL SELECT name, tier, region, 1, url1 FROM registry",
    "registry"))
def _(spark, sf):
    return X.registry(spark, sf).select("name", "tier", "region", F.posexplode("urls").alias("url_no", "url"))


@query("src05_known_facilities", with_ctes("""
SELECT name AS company, 'F' || s_suppkey::VARCHAR || 'a' AS facility_name, 'Navi Mumbai' AS city, 'India' AS country, region,
  2025 AS year, ((s_suppkey % 40 + 130) * 0.01)::DECIMAL(5,3)::DOUBLE AS pue_value, 'design' AS pue_type,
  (s_suppkey % 60 + 1)::DOUBLE AS capacity_mw, (s_suppkey % 70 * 100)::INTEGER AS rack_count, url0 AS source_url,
  'estimated' AS source_type, '2025-06-30' AS extraction_date, tier, 27.2::DOUBLE AS avg_temp_celsius, 'IN' AS country_code
FROM registry WHERE s_suppkey % 3 = 1 UNION ALL
SELECT name, 'F' || s_suppkey::VARCHAR || 'b', 'Mumbai', 'India', region, 2025,
  ((s_suppkey % 30 + 140) * 0.01)::DECIMAL(5,3)::DOUBLE, 'design', (s_suppkey % 30 + 2)::DOUBLE, (s_suppkey % 50 * 100)::INTEGER, url0,
  'estimated', '2025-06-30', tier, 27.2::DOUBLE, 'IN' FROM registry WHERE s_suppkey % 3 = 1""", "registry"))
def _(spark, sf):
    return records.known_facility_records(X.registry(spark, sf), X.AS_OF).drop("renewable_pct", "wue_l_per_kwh")


@query("src06_report_pages", with_ctes(
    "SELECT doc, i::INTEGER AS page_num, p[i] AS text FROM (SELECT doc, string_split(text, chr(12)) AS p FROM report_pages), "
    "unnest(range(1, len(p) + 1)) AS u(i)", "report_pages"))
def _(spark, sf):
    return search.split_pages(X.report_pages(spark, sf), "doc", "text")


@query("src07_page_corpus", "SELECT page_id, url, length(html)::BIGINT AS html_chars FROM pages")
def _(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("html_chars"))


@query("src08_priority_lookup", with_ctes(
    "SELECT pue_type, source_type, coalesce(t_prio, 0)::INTEGER AS type_priority, coalesce(s_prio, 0)::INTEGER AS source_priority, "
    "count(*) AS records FROM raw_pue LEFT JOIN type_prio ON pue_type = t_key LEFT JOIN source_prio ON source_type = s_key GROUP BY ALL",
    "raw_pue", "type_prio", "source_prio"))
def _(spark, sf):
    counted = X.raw_pue(spark, sf).groupBy("pue_type", "source_type").agg(F.count(F.lit(1)).alias("records"))
    kinds = lookups.priorities(spark, V.PUE_TYPE_PRIORITY).withColumnsRenamed({"key": "pue_type", "priority": "tp"})
    sources = lookups.priorities(spark, V.SOURCE_PRIORITY).withColumnsRenamed({"key": "source_type", "priority": "sp"})
    joined = counted.join(F.broadcast(kinds), "pue_type", "left").join(F.broadcast(sources), "source_type", "left")
    return joined.select(
        "pue_type", "source_type", F.coalesce("tp", F.lit(0)).alias("type_priority"),
        F.coalesce("sp", F.lit(0)).alias("source_priority"), "records",
    )


@query("src08_factor_and_default_lookup", with_ctes("""
SELECT tier, country, CASE country WHEN 'India' THEN 0.82 WHEN 'Singapore' THEN 0.41 ELSE 0.47 END::DOUBLE AS listed_factor,
  coalesce(p_pue, 1.50)::DOUBLE AS tier_default, count(*) AS records
FROM enriched LEFT JOIN tier_pue ON tier = p_tier GROUP BY ALL""", "enriched", "tier_pue"))
def _(spark, sf):
    grouped = X.enriched(spark, sf).groupBy("tier", "country").agg(F.count(F.lit(1)).alias("records"))
    factors = lookups.amounts(spark, V.EMISSION_FACTORS).withColumnsRenamed({"key": "country", "amount": "f"})
    defaults = lookups.amounts(spark, V.TIER_DEFAULT_PUE).withColumnsRenamed({"key": "tier", "amount": "d"})
    joined = grouped.join(F.broadcast(factors), "country", "left").join(F.broadcast(defaults), "tier", "left")
    return joined.select(
        "tier", "country",
        F.coalesce("f", F.lit(V.EMISSION_FACTORS["Global"]).cast("decimal(6,3)")).alias("listed_factor"),
        F.coalesce("d", F.lit(V.FALLBACK_PUE).cast("decimal(6,3)")).alias("tier_default"),
        "records",
    )


@query("snk01_records_json", with_ctes(f"SELECT id, {_RECORD} FROM raw_pue", "raw_pue"))
def _(spark, sf):
    path = scratch(spark, "json")
    writers.save_records_json(X.raw_pue(spark, sf), path)
    return readers.read_record_lines(spark, path, schemas.RAW).drop("avg_temp_celsius", "country_code")


@query("snk02_clean_csv", with_ctes(
    "SELECT id, company, facility_name, nullif(city, '') AS city, tier, year, " + dbl("pue_value", "cooling_overhead_pct")
    + ", round(annual_waste_mwh, 5)::DOUBLE AS annual_waste_mwh FROM cleaned", "cleaned"))
def _(spark, sf):
    path = scratch(spark, "cleaned")
    rows = X.cleaned(spark, sf).select(
        "id", "company", "facility_name", "city", "tier", "year", "pue_value", "cooling_overhead_pct", "annual_waste_mwh"
    )
    writers.save_csv(rows, path)
    return readers.read_clean_csv(spark, path, rows.schema)


@query("snk03_append_valid_rows", with_ctes("""
SELECT CASE WHEN year IS NOT NULL AND pue_value BETWEEN 1.0 AND 3.0 AND coalesce(renewable_pct BETWEEN 0 AND 100, true)
  THEN 'inserted' ELSE 'rejected' END AS outcome, id FROM raw_pue""", "raw_pue"))
def _(spark, sf):
    paths = {"inserted": scratch(spark, "raw"), "rejected": scratch(spark, "rejected")}
    writers.append_valid(X.raw_pue(spark, sf), *paths.values())
    return cleaning.append_all([readers.read_table(spark, p).select(F.lit(o).alias("outcome"), "id") for o, p in paths.items()])


@query("snk04_run_summary", with_ctes("""
SELECT 'Records Extracted' AS key, count(*)::VARCHAR AS value FROM raw_pue UNION ALL
SELECT 'Facilities with PUE', count(pue_value)::VARCHAR FROM raw_pue""", "raw_pue"))
def _(spark, sf):
    path, log = scratch(spark, "json"), scratch(spark, "log")
    summary = writers.save_records_json(X.raw_pue(spark, sf), path)
    writers.append_run_summary(spark, log, summary, X.AS_OF)
    return readers.read_table(spark, log).select("key", "value")


@query("snk05_materialize_mart", with_ctes("SELECT tier, count(*) AS records FROM stg GROUP BY tier", "stg"))
def _(spark, sf):
    writers.materialize(X.staged(spark, sf), "stg_pue")
    counts = spark.table("stg_pue").groupBy("tier").agg(F.count(F.lit(1)).alias("records"))
    return writers.materialize(counts, "tier_counts", scratch(spark, "marts"))


@query("prj01_normalize_schema", with_ctes(
    f"SELECT {_RECORD.replace('country, region, year', 'country, region, NULL::INTEGER AS year')} FROM raw_pue", "raw_pue"))
def _(spark, sf):
    return cleaning.normalize_schema(X.raw_pue(spark, sf).drop("year").withColumn("extra", F.lit(1)))


@query("prj02_allow_list", with_ctes("SELECT company, city, pue_value::DOUBLE AS pue_value FROM raw_pue", "raw_pue"))
def _(spark, sf):
    return cleaning.keep_allowed(X.raw_pue(spark, sf).select("pue_value", "id", "city", "company"), schemas.ENRICHED.fieldNames())


@query("prj03_nan_to_null", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS capacity,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity / 2 END AS half FROM lineitem""")
def _(spark, sf):
    nan = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    df = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", nan.alias("capacity"))
    return cleaning.nan_cells_to_null(df.withColumn("half", F.col("capacity") / 2))


@query("prj04_safe_conversion", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN l_partkey::INTEGER WHEN 2 THEN -l_partkey::INTEGER END AS as_int,
  CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN (l_partkey::VARCHAR || '.9')::DOUBLE WHEN 2 THEN ('-' || l_partkey::VARCHAR || '.5')::DOUBLE END AS as_double
FROM lineitem""")
def _(spark, sf):
    text = F.expr("""case l_linenumber % 4 when 0 then null when 1 then concat(cast(l_partkey as string), '.9')
                     when 2 then concat('-', cast(l_partkey as string), '.5') else 'n/a' end""")
    df = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("as_int"), text.alias("as_double"))
    return cleaning.convert(df, {"as_int": "int", "as_double": "double"})


@query("prj05_staging_names", with_ctes("SELECT pue_id, company_name, metric_year FROM stg", "stg"))
def _(spark, sf):
    return X.staged(spark, sf).select("pue_id", "company_name", "metric_year")


@query("prj06_display_formats", with_ctes("""
SELECT id, CASE WHEN pue_value IS NULL THEN 'N/A' ELSE pue_value::VARCHAR END AS pue,
  CASE WHEN capacity_mw IS NULL THEN 'N/A' ELSE capacity_mw::DECIMAL(10,1)::VARCHAR END AS capacity,
  CASE WHEN renewable_pct IS NULL THEN 'N/A' ELSE renewable_pct::VARCHAR || '%' END AS renewable FROM raw_pue""", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select(
        "id", fixed_point(F.col("pue_value"), 3).alias("pue"), fixed_point(F.col("capacity_mw"), 1).alias("capacity"),
        fixed_point(F.col("renewable_pct").cast("decimal(10,0)"), 0, "%").alias("renewable"),
    )


@query("prj07_derived_metrics", with_ctes(
    "SELECT pue_id, " + dbl("cooling_overhead_pct", "annual_waste_mwh") + ", cooling_overhead_pct::DECIMAL(6,3)::DOUBLE AS stored_overhead, "
    "round(annual_waste_mwh, 2)::DECIMAL(15,2)::DOUBLE AS stored_waste FROM stg", "stg"))
def _(spark, sf):
    rows = metrics.with_derived_metrics(X.staged(spark, sf).drop("cooling_overhead_pct", "annual_waste_mwh"))
    return rows.select(
        "pue_id", "cooling_overhead_pct", "annual_waste_mwh",
        F.col("cooling_overhead_pct").cast("decimal(6,3)").alias("stored_overhead"),
        F.round("annual_waste_mwh", 2).cast("decimal(15,2)").alias("stored_waste"),
    )


@query("prj08_named_subqueries", with_ctes(
    "SELECT city, count(*) AS records FROM stg GROUP BY city HAVING count(*) > 1", "stg"))
def _(spark, sf):
    X.enriched(spark, sf).transform(staging).createOrReplaceTempView("stg_for_chain")
    return spark.sql("""
        with base as (select * from stg_for_chain),
             per_city as (select city, count(*) as records from base group by city)
        select city, records from per_city where records > 1""")


@query("flt01_quality_filter", with_ctes("SELECT id, pue_value::DOUBLE AS pue_value FROM raw_pue WHERE pue_value >= 1.0 AND pue_value <= 3.0", "raw_pue"))
def _(spark, sf):
    return staging(X.raw_pue(spark, sf)).select(F.col("pue_id").alias("id"), "pue_value")


@query("flt02_capacity_present", with_ctes("SELECT id, capacity_mw::DOUBLE AS capacity_mw FROM raw_pue WHERE capacity_mw IS NOT NULL", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).filter(F.col("capacity_mw").isNotNull()).select("id", "capacity_mw")


@query("flt03_type_membership", with_ctes("SELECT id, pue_type FROM raw_pue WHERE pue_type IN ('design', 'operating', 'TTM')", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).filter(F.col("pue_type").isin("design", "operating", "TTM")).select("id", "pue_type")


@query("flt04_optional_filters", with_ctes(
    "SELECT id, tier, country, pue_type FROM enriched WHERE tier = 'Tier 2 - Indian Operator' AND country = 'India'", "enriched"))
def _(spark, sf):
    rows = cleaning.selected(X.enriched(spark, sf), tier=V.TIER_2, country="India", pue_type="All")
    return rows.select("id", "tier", "country", "pue_type")


@query("flt05_india_or_global", with_ctes(
    "SELECT id, CASE WHEN country = 'India' THEN 'India' ELSE 'Global' END AS region_group FROM enriched", "enriched"))
def _(spark, sf):
    return X.enriched(spark, sf).select("id", metrics.region_group(F.col("country")).alias("region_group"))


@query("flt06_official_domain", with_ctes(
    "SELECT hit_id, url FROM search_hits WHERE contains(lower(url), replace(lower(company), ' ', ''))", "search_hits"))
def _(spark, sf):
    return search.official_hits(X.search_hits(spark, sf)).select("hit_id", "url")


@query("flt07_company_lookup", with_ctes("""
SELECT 'name' AS by_what, name FROM registry WHERE lower(name) = 'supplier#000000003' UNION ALL
SELECT 'tier', name FROM registry WHERE contains(lower(tier), 'indian') UNION ALL
SELECT 'region', name FROM registry WHERE contains(lower(region), 'glob')""", "registry"))
def _(spark, sf):
    reg = X.registry(spark, sf)
    parts = [("name", {"name": "SUPPLIER#000000003"}), ("tier", {"tier": "INDIAN"}), ("region", {"region": "Glob"})]
    found = [cleaning.companies_where(reg, **by).select(F.lit(what).alias("by_what"), "name") for what, by in parts]
    return cleaning.append_all(found)


@query("flt08_drop_without_city", with_ctes("SELECT id, city FROM raw_pue WHERE city IS NOT NULL AND city <> ''", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).dropna(subset=["city"]).filter("city <> ''").select("id", "city")


@query("flt09_tier_substring", with_ctes("SELECT id, coalesce(contains(tier, 'Tier 1'), false) AS in_tier FROM raw_pue", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select("id", cleaning.in_tier(F.col("tier"), "Tier 1").alias("in_tier"))


@query("flt10_route_by_url", with_ctes(
    "SELECT hit_id, url, CASE WHEN contains(lower(url), 'pdf') THEN 'pdf' ELSE 'html' END AS kind, NOT ends_with(url, '.pdf') AS searchable FROM search_hits",
    "search_hits"))
def _(spark, sf):
    routed = records.route_urls(X.search_hits(spark, sf))
    return routed.select("hit_id", "url", "kind", (~F.col("url").endswith(".pdf")).alias("searchable"))
