"""Scalar functions, each over whole tables."""

from pyspark.sql import functions as F

from gridsight.catalog import fixtures as X
from gridsight.catalog.base import query
from gridsight.catalog.oracle_sql import mean, title_case, with_ctes
from gridsight.functions import metrics
from gridsight.functions.numbers import dec, quotient_half_up, safe_number
from gridsight.functions.text import fixed_point, lookup, title_case as title
from gridsight.operators import star
from gridsight.operators.links import absolute

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEYS = ", ".join(_LINE)


def _lines(spark, sf, **columns):
    return X.table(spark, sf, "lineitem").select(*_LINE, *[c.alias(n) for n, c in columns.items()])


@query("fn01_round_half_up", with_ctes("""
SELECT id, round(pue_value, 2)::DOUBLE AS r2, round(pue_value * capacity_mw, 1)::DOUBLE AS r1, round(pue_value - 2.5, 1)::DOUBLE AS signed FROM raw_pue""", "raw_pue"))
def _(spark, sf):
    pue = F.col("pue_value")
    return X.raw_pue(spark, sf).select(
        "id", F.round(pue, 2).alias("r2"), F.round(pue * F.col("capacity_mw"), 1).alias("r1"), F.round(pue - dec("2.5"), 1).alias("signed"))


@query("fn02_numeric_cast", f"SELECT {_KEYS}, l_quantity::DECIMAL(10,2)::DOUBLE AS exact, l_quantity::INTEGER AS whole FROM lineitem")
def _(spark, sf):
    q = F.col("l_quantity")
    return _lines(spark, sf, exact=q.cast("decimal(10,2)"), whole=q.cast("int"))


@query("fn03_case_when", with_ctes(
    "SELECT id, CASE WHEN pue_value < 1.3 THEN 'green' WHEN pue_value < 1.5 THEN 'yellow' WHEN pue_value <= 1.7 THEN 'orange' ELSE 'red' END AS light FROM raw_pue WHERE pue_value IS NOT NULL", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).dropna(subset=["pue_value"]).select("id", metrics.traffic_light(F.col("pue_value")).alias("light"))


@query("fn04_coalesce", with_ctes(
    "SELECT id, coalesce(facility_name, '') AS facility_name, coalesce(nullif(city, ''), country, '?') AS place FROM raw_pue", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select(
        "id", F.coalesce("facility_name", F.lit("")).alias("facility_name"),
        F.coalesce(F.nullif("city", F.lit("")), "country", F.lit("?")).alias("place"))


@query("fn05_map_lookup", with_ctes("SELECT id, coalesce(t_prio, 0)::INTEGER AS priority FROM raw_pue LEFT JOIN type_prio ON pue_type = t_key", "raw_pue", "type_prio"))
def _(spark, sf):
    from gridsight.fixed_values import PUE_TYPE_PRIORITY

    return X.raw_pue(spark, sf).select("id", lookup(F.col("pue_type"), PUE_TYPE_PRIORITY, F.lit(0)).alias("priority"))


@query("fn06_missing_tests", with_ctes(
    "SELECT id, pue_value IS NULL AS no_pue, year IS NOT NULL AS has_year FROM raw_pue", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select("id", F.col("pue_value").isNull().alias("no_pue"), F.col("year").isNotNull().alias("has_year"))


@query("fn07_string_functions", with_ctes(f"""
SELECT id, lower(trim(city)) AS low, {title_case('city')} AS titled, replace(source_url, 'https://', '') AS bare, string_split(source_url, '/')[4] AS part,
  ends_with(source_url, '7') AS ends7, starts_with(company, 'Supplier') AS starts, contains(source_url, 'example') AS has FROM raw_pue""", "raw_pue"))
def _(spark, sf):
    url = F.col("source_url")
    return X.raw_pue(spark, sf).select(
        "id", F.lower(F.trim("city")).alias("low"), title(F.col("city")).alias("titled"), F.replace(url, F.lit("https://"), F.lit("")).alias("bare"),
        F.get(F.split(url, "/"), F.lit(3)).alias("part"), url.endswith("7").alias("ends7"),
        F.col("company").startswith("Supplier").alias("starts"), url.contains("example").alias("has"))


@query("fn08_regex_functions", with_ctes(r"""
SELECT id, regexp_matches(source_url, '/[0-9]+/[0-9]+$') AS found, regexp_extract(source_url, '/([0-9]+)$', 1) AS last_part,
  regexp_replace(source_url, '[0-9]', '#', 'g') AS masked FROM raw_pue""", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select(
        "id", F.col("source_url").rlike("/[0-9]+/[0-9]+$").alias("found"), F.regexp_extract("source_url", "/([0-9]+)$", 1).alias("last_part"),
        F.regexp_replace("source_url", "[0-9]", "#").alias("masked"))


@query("fn09_safe_numbers", f"SELECT {_KEYS}, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey::INTEGER END AS n FROM lineitem")
def _(spark, sf):
    text = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(".75")))
    return _lines(spark, sf, n=safe_number(text, "int"))


@query("fn10_clipping", with_ctes(
    "SELECT id, greatest(0, pue_value - 1.2)::DOUBLE AS above, least(renewable_pct, 100) AS capped FROM raw_pue WHERE pue_value IS NOT NULL AND renewable_pct IS NOT NULL", "raw_pue"))
def _(spark, sf):
    rows = X.raw_pue(spark, sf).dropna(subset=["pue_value", "renewable_pct"])
    return rows.select(
        "id", F.greatest(dec(0), F.col("pue_value") - dec("1.2")).alias("above"), F.least("renewable_pct", F.lit(100)).alias("capped"))


@query("fn11_exact_mean", with_ctes(f"SELECT company, {mean('pue_value', 3, 3)} AS avg_pue, {mean('renewable_pct', 0, 1)} AS avg_renewable FROM raw_pue GROUP BY company", "raw_pue"))
def _(spark, sf):
    from gridsight.functions.numbers import mean_half_up

    return X.raw_pue(spark, sf).groupBy("company").agg(
        mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"), mean_half_up(F.col("renewable_pct"), 0, 1).alias("avg_renewable"))


@query("fn12_dates", "SELECT " + _KEYS + ", strftime(l_shipdate, '%Y-%m-%d') AS day, year(l_shipdate)::INTEGER AS y, year(l_shipdate) <= 2001 AS not_later FROM lineitem")
def _(spark, sf):
    day = F.col("l_shipdate")
    return _lines(spark, sf, day=F.date_format(day, "yyyy-MM-dd"), y=F.year(day), not_later=F.year(day) <= F.year(F.lit("2001-06-30").cast("date")))


@query("fn13_url_join", with_ctes(r"""
SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/a/b.pdf' AS rooted, regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'c.pdf' AS relative,
  'https://x.org/d.pdf' AS kept FROM pages_ext""", "pages_ext"))
def _(spark, sf):
    url = F.col("url")
    return X.pages_ext(spark, sf).select(
        "page_id", absolute(F.lit("/a/b.pdf"), url).alias("rooted"), absolute(F.lit("c.pdf"), url).alias("relative"),
        absolute(F.lit("https://x.org/d.pdf"), url).alias("kept"))


@query("fn14_number_formats", with_ctes("""
SELECT id, pue_value::VARCHAR AS three, CASE WHEN pue_value >= 2 THEN '+' ELSE '' END || (pue_value - 2.000)::DECIMAL(5,3)::VARCHAR AS signed,
  format('{:,}', rack_count * 1000) AS grouped FROM raw_pue WHERE pue_value IS NOT NULL AND rack_count IS NOT NULL""", "raw_pue"))
def _(spark, sf):
    rows, gap = X.raw_pue(spark, sf).dropna(subset=["pue_value", "rack_count"]), F.col("pue_value") - dec("2.000")
    return rows.select(
        "id", fixed_point(F.col("pue_value"), 3).alias("three"),
        F.concat(F.when(gap >= 0, "+").otherwise(""), fixed_point(gap, 3)).alias("signed"),
        F.format_number(F.col("rack_count") * 1000, 0).alias("grouped"))


@query("fn15_arrays", with_ctes("""
SELECT id, p[1] AS first, p[2] AS second, len(p) AS n FROM (SELECT id, list_filter([facility_name, city, country], lambda x: x IS NOT NULL)[1:2] AS p FROM raw_pue)""", "raw_pue"))
def _(spark, sf):
    parts = F.slice(F.array_compact(F.array("facility_name", "city", "country")), 1, 2)
    rows = X.raw_pue(spark, sf).select("id", parts.alias("p"))
    return rows.select("id", F.get("p", F.lit(0)).alias("first"), F.get("p", F.lit(1)).alias("second"), F.size("p").cast("bigint").alias("n"))


@query("fn_quotient_half_up", with_ctes("""
SELECT id, ((2 * CAST(capacity_mw * 100 AS HUGEINT) * 100 + CAST(wue_l_per_kwh * 100 AS HUGEINT)) // (2 * CAST(wue_l_per_kwh * 100 AS HUGEINT)))::DOUBLE / 100 AS q
FROM raw_pue WHERE capacity_mw IS NOT NULL AND wue_l_per_kwh > 0""", "raw_pue"))
def _(spark, sf):
    rows = X.raw_pue(spark, sf).filter("capacity_mw is not null and wue_l_per_kwh > 0")
    return rows.select("id", quotient_half_up(F.col("capacity_mw"), F.col("wue_l_per_kwh"), 2, 2).alias("q"))


@query("udf04_refresh_updated_at", with_ctes("""
SELECT company_id, CASE WHEN company_name < 'Supplier#000000004' THEN 'new' ELSE tier END AS tier,
  CASE WHEN company_name < 'Supplier#000000004' THEN '2025-02-01' ELSE '2025-01-01' END AS updated_on, '2025-01-01' AS created_on FROM dim_company""", "dim_company"))
def _(spark, sf):
    _, companies, _ = X.star(spark, sf)
    audited = star.with_audit(companies, "2025-01-01")
    changes = companies.filter("company_name < 'Supplier#000000004'").select("company_id", F.lit("new").alias("tier"))
    unchanged = companies.filter("company_name >= 'Supplier#000000004'").select("company_id", "tier")
    out = star.rewritten(audited, changes.unionByName(unchanged), "company_id", "tier", "2025-02-01")
    return out.select(
        "company_id", "tier", F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"), F.date_format("created_at", "yyyy-MM-dd").alias("created_on"))
