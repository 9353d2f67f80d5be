"""Marts, rankings, aggregates, sorts, set operations and dashboard analytics."""

from pyspark.sql import functions as F

from gridsight import fixed_values as V
from gridsight.catalog import fixtures as X
from gridsight.catalog.base import places, query, scratch
from gridsight.catalog.oracle_sql import dbl, mean, with_ctes
from gridsight.functions import metrics
from gridsight.functions.numbers import dec, mean_half_up
from gridsight.operators import cleaning
from gridsight.operators.dedup import first_n_per_key
from gridsight.operators.ranking import row_number_by_value
from gridsight.plans import analytics, marts
from gridsight.sources import lookups, readers, writers

_CATEGORY = """CASE WHEN pue_value < 1.2 THEN 'Exceptional' WHEN pue_value < 1.4 THEN 'Excellent' WHEN pue_value < 1.6 THEN 'Good'
  WHEN pue_value < 1.8 THEN 'Fair' ELSE 'Needs Improvement' END"""
_RANK = "row_number() OVER (ORDER BY pue_value NULLS LAST, md5(pue_id), pue_id)"
_TIER_RANK = "row_number() OVER (PARTITION BY tier ORDER BY pue_value NULLS LAST, md5(pue_id), pue_id)"


@query("win01_global_rank", with_ctes(f"SELECT pue_id, {_RANK} AS pue_rank FROM stg", "stg"))
def _(spark, sf):
    return row_number_by_value(X.staged(spark, sf).select("pue_id", "pue_value"), "pue_rank", "pue_value", "pue_id").select("pue_id", "pue_rank")


@query("win01_global_rank_sliced", with_ctes(f"SELECT pue_id, {_RANK} AS pue_rank FROM stg", "stg"))
def _(spark, sf):
    """The same ranks when the values are cut into few slices."""
    rows = X.staged(spark, sf).select("pue_id", "pue_value")
    return row_number_by_value(rows, "pue_rank", "pue_value", "pue_id", digits=1).select("pue_id", "pue_rank")


@query("mrt02_leaderboard_sliced", with_ctes(f"SELECT {_RANK} AS pue_rank, {_TIER_RANK} AS tier_rank, company_name, pue_value::DOUBLE AS pue_value FROM stg", "stg"))
def _(spark, sf):
    """Both ranks from few slices."""
    return marts.leaderboard(X.staged(spark, sf), digits=1).select("pue_rank", "tier_rank", "company_name", "pue_value")


@query("win02_rank_in_tier", with_ctes(f"SELECT pue_id, tier, {_TIER_RANK} AS tier_rank FROM stg", "stg"))
def _(spark, sf):
    rows = X.staged(spark, sf).select("pue_id", "tier", "pue_value")
    return row_number_by_value(rows, "tier_rank", "pue_value", "pue_id", ["tier"]).select("pue_id", "tier", "tier_rank")


@query("win06_display_rank", with_ctes(
    "SELECT id, row_number() OVER (ORDER BY pue_value NULLS LAST, md5(id), id) AS rank FROM cleaned WHERE country = 'India'", "cleaned"))
def _(spark, sf):
    rows = cleaning.selected(X.cleaned(spark, sf), country="India").select("id", "pue_value")
    return row_number_by_value(rows, "rank", "pue_value", "id").select("id", "rank")


@query("mrt01_staging", with_ctes(
    "SELECT pue_id, company_name, facility_name, city, country, region, metric_year, pue_type, rack_count, renewable_pct, source_url, source_type, tier, "
    + dbl("pue_value", "capacity_mw", "wue_l_per_kwh", "cooling_overhead_pct", "annual_waste_mwh") + " FROM stg", "stg"))
def _(spark, sf):
    return X.staged(spark, sf).drop("extraction_date", "avg_temp_celsius", "country_code")


@query("mrt02_leaderboard", with_ctes(f"""
SELECT {_RANK} AS pue_rank, {_TIER_RANK} AS tier_rank, company_name, tier, facility_name, city, country, metric_year, {dbl('pue_value')}, pue_type,
  round(cooling_overhead_pct, 2)::DOUBLE AS cooling_overhead_pct, {dbl('capacity_mw')}, renewable_pct, {dbl('wue_l_per_kwh')},
  round(annual_waste_mwh, 2)::DOUBLE AS annual_waste_mwh, {_CATEGORY} AS efficiency_category FROM stg""", "stg"))
def _(spark, sf):
    return marts.leaderboard(X.staged(spark, sf))


def _group_row(label: str, condition: str) -> str:
    return f"""SELECT '{label}' AS region_group, count(*) AS facility_count, {mean('pue_value', 3, 3)} AS avg_pue, min(pue_value)::DOUBLE AS min_pue,
  max(pue_value)::DOUBLE AS max_pue, {mean('renewable_pct', 0, 1)} AS avg_renewable_pct, round(sum(capacity_mw), 1)::DOUBLE AS total_capacity_mw,
  round(sum(annual_waste_mwh), 1)::DOUBLE AS total_waste_mwh, {mean('cooling_overhead_pct', 1, 2)} AS avg_cooling_overhead_pct FROM stg WHERE {condition}"""


_TWO_ROWS = with_ctes(_group_row("India", "country = 'India'") + " UNION ALL " + _group_row("Global", "country <> 'India' OR country IS NULL"), "stg")


@query("mrt03_india_vs_global", _TWO_ROWS)
def _(spark, sf):
    return marts.india_vs_global(X.staged(spark, sf))


_MONEY = """
SELECT *, CASE country WHEN 'India' THEN 7.0 WHEN 'United States' THEN 10.0 ELSE 8.5 END::DECIMAL(3,1) AS tariff FROM stg WHERE capacity_mw IS NOT NULL"""


@query("mrt04_cost_waste", with_ctes(f"""
SELECT company_name, tier, facility_name, city, country, {dbl('pue_value', 'capacity_mw')}, round(cooling_overhead_pct, 2)::DOUBLE AS cooling_overhead_pct,
  round(annual_waste_mwh, 2)::DOUBLE AS annual_waste_mwh, tariff::DOUBLE AS tariff_inr_per_kwh,
  round(annual_waste_mwh * 1000 * tariff, 2)::DOUBLE AS annual_waste_cost_inr, cr::DOUBLE AS annual_waste_cost_crores,
  CASE WHEN pue_value > 1.2 THEN round(CAST((pue_value - 1.2) * capacity_mw AS DECIMAL(18,5)) * 8760 * tariff * 0.0001, 2) ELSE 0 END::DOUBLE AS potential_savings_crores,
  CASE WHEN capacity_mw > 0 THEN ((2 * CAST(cr * 100 AS HUGEINT) * 100 + CAST(capacity_mw * 100 AS HUGEINT)) // (2 * CAST(capacity_mw * 100 AS HUGEINT)))::DOUBLE / 100 END AS waste_cost_per_mw_crores
FROM (SELECT *, round(annual_waste_mwh * tariff * 0.0001, 2)::DECIMAL(18,2) AS cr FROM ({_MONEY}))""", "stg"))
def _(spark, sf):
    return marts.cost_waste(X.staged(spark, sf))


_CLIMATE = """
SELECT company_name, tier, facility_name, city, country, d_temp::DOUBLE AS avg_temp_celsius, pue_value::DOUBLE AS pue_value, capacity_mw::DOUBLE AS capacity_mw,
  round(cooling_overhead_pct, 2)::DOUBLE AS cooling_overhead_pct, round(annual_waste_mwh, 2)::DOUBLE AS annual_waste_mwh,
  f::DOUBLE AS grid_emission_factor, round(annual_waste_mwh * 1000 * f, 2)::DOUBLE AS annual_co2_tons,
  round(wue_l_per_kwh * capacity_mw * 8760000, 0)::DOUBLE AS annual_water_liters,
  round(CAST(pue_value * (1 + (coalesce(d_temp, 25) - 10) * 0.01) AS DECIMAL(18,7)), 3)::DOUBLE AS climate_adjusted_pue
FROM (SELECT *, CASE country WHEN 'India' THEN 0.82 WHEN 'United States' THEN 0.42 ELSE 0.47 END::DECIMAL(3,2) AS f FROM stg) s
LEFT JOIN city_dim ON city = d_city WHERE capacity_mw IS NOT NULL"""


@query("mrt05_climate_impact", with_ctes(_CLIMATE, "stg", "city_dim"))
def _(spark, sf):
    return marts.climate_impact(X.staged(spark, sf), lookups.city_temperatures(spark))


@query("jn06_city_temperature", with_ctes(
    "SELECT pue_id, city, d_temp::DOUBLE AS avg_temp_celsius FROM stg LEFT JOIN city_dim ON city = d_city", "stg", "city_dim"))
def _(spark, sf):
    seed = lookups.city_temperatures(spark).select("city", "avg_temp_celsius")
    return X.staged(spark, sf).select("pue_id", "city").join(seed, "city", "left")


@query("jn09_facility_scenarios", with_ctes("""
SELECT id, target_pue::DOUBLE AS target_pue, (CAST((pue_value - target_pue) * capacity_mw AS DECIMAL(18,5)) * 8760)::DOUBLE AS savings_mwh,
  round(CAST((pue_value - target_pue) * capacity_mw AS DECIMAL(18,5)) * 8760 * 7.0 * 0.0001, 4)::DOUBLE AS savings_crores,
  round(CAST((pue_value - target_pue) * capacity_mw AS DECIMAL(18,5)) * 8760 * 0.82, 2)::DOUBLE AS co2_tons
FROM cleaned, (VALUES (1.100::DECIMAL(5,3)), (1.200::DECIMAL(5,3)), (1.300::DECIMAL(5,3))) AS s(target_pue)
WHERE target_pue <= pue_value AND capacity_mw BETWEEN 0.1 AND 500""", "cleaned"))
def _(spark, sf):
    rows = analytics.facility_scenarios(X.cleaned(spark, sf), ["1.1", "1.2", "1.3"])
    return rows.select("id", "target_pue", "savings_mwh", "savings_crores", "co2_tons")


_GRAND = f"""SELECT count(*) AS facility_count, {mean('pue_value', 3, 3)} AS avg_pue, min(pue_value)::DOUBLE AS min_pue, max(pue_value)::DOUBLE AS max_pue,
  {mean('renewable_pct', 0, 1)} AS avg_renewable_pct, round(sum(capacity_mw), 1)::DOUBLE AS total_capacity_mw,
  round(sum(annual_waste_mwh), 1)::DOUBLE AS total_waste_mwh FROM stg"""


@query("agg01_grand_aggregates", with_ctes(_GRAND, "stg"))
def _(spark, sf):
    return X.staged(spark, sf).agg(
        F.count(F.lit(1)).alias("facility_count"), mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"),
        F.min("pue_value").alias("min_pue"), F.max("pue_value").alias("max_pue"),
        mean_half_up(F.col("renewable_pct"), 0, 1).alias("avg_renewable_pct"),
        F.round(F.sum("capacity_mw"), 1).alias("total_capacity_mw"), F.round(F.sum("annual_waste_mwh"), 1).alias("total_waste_mwh"),
    )


@query("agg02_group_by_region_group", with_ctes(
    f"SELECT CASE WHEN country = 'India' THEN 'India' ELSE 'Global' END AS region_group, count(*) AS facility_count, {mean('pue_value', 3, 3)} AS avg_pue FROM stg GROUP BY 1", "stg"))
def _(spark, sf):
    return X.staged(spark, sf).groupBy(metrics.region_group(F.col("country")).alias("region_group")).agg(
        F.count(F.lit(1)).alias("facility_count"), mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"))


@query("agg03_conditional_counts", with_ctes(
    "SELECT tier, count(*) FILTER (pue_type = 'operating') AS operating, count(*) FILTER (pue_type = 'design') AS design FROM stg GROUP BY tier", "stg"))
def _(spark, sf):
    kind = F.col("pue_type")
    return X.staged(spark, sf).groupBy("tier").agg(
        F.count_if(kind == "operating").alias("operating"), F.count_if(kind == "design").alias("design"))


def _mean_by(name: str, key: str, prepare=lambda df: df, where: str = "true") -> None:
    @query(name, with_ctes(f"SELECT {key}, {mean('pue_value', 3, 3)} AS avg_pue FROM cleaned WHERE {key} IS NOT NULL AND {where} GROUP BY {key}", "cleaned"))
    def _(spark, sf):
        return analytics.mean_pue_by(prepare(X.cleaned(spark, sf)), key)


_mean_by("agg04_mean_by_tier", "tier")
_mean_by("agg05_mean_by_type", "pue_type")
_mean_by("agg06_mean_by_india_city", "city", lambda df: df.filter("country = 'India'"), "country = 'India'")


@query("agg07_company_mean_and_facilities", with_ctes(
    f"SELECT company, {mean('pue_value', 3, 3)} AS avg_pue, count(facility_name) AS facility_count FROM cleaned GROUP BY company", "cleaned"))
def _(spark, sf):
    return analytics.operators_by_pue(X.cleaned(spark, sf))


@query("agg08_frequency_table", with_ctes("SELECT pue_type, count(*) AS n FROM raw_pue WHERE pue_type IS NOT NULL GROUP BY pue_type", "raw_pue"))
def _(spark, sf):
    return analytics.frequencies(X.raw_pue(spark, sf), "pue_type")


@query("agg09_pue_histogram", with_ctes(
    "SELECT least(CAST(pue_value * 1000 - 1000 AS INTEGER) // 100 + 1, 20)::INTEGER AS bin, count(*) AS n FROM raw_pue WHERE pue_value BETWEEN 1.0 AND 3.0 GROUP BY 1", "raw_pue"))
def _(spark, sf):
    return analytics.pue_histogram(X.raw_pue(spark, sf))


@query("agg10_distinct_counts", with_ctes("SELECT count(DISTINCT company) AS companies, count(DISTINCT id) AS ids, count(DISTINCT city) AS cities FROM raw_pue", "raw_pue"))
def _(spark, sf):
    rows, one = X.raw_pue(spark, sf), F.lit(1).alias("_one")
    companies, ids, cities = (rows.agg(F.count_distinct(c).alias(n)).select(one, n) for c, n in (("company", "companies"), ("id", "ids"), ("city", "cities")))
    return companies.join(ids, "_one").join(cities, "_one").drop("_one")


@query("agg11_option_lists", with_ctes(" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS filter_name, {c} AS option_value FROM enriched WHERE {c} IS NOT NULL" for c in ("tier", "country", "pue_type")), "enriched"))
def _(spark, sf):
    rows = X.enriched(spark, sf)
    return cleaning.append_all([
        analytics.options(rows, c).select(F.lit(c).alias("filter_name"), F.col(c).alias("option_value")) for c in ("tier", "country", "pue_type")
    ])


@query("agg14_iterator_sums", with_ctes("""
SELECT sum(annual_waste_mwh)::DOUBLE AS all_waste, sum(annual_waste_mwh) FILTER (pue_value > 1.2)::DOUBLE AS waste_above_target FROM stg""", "stg"))
def _(spark, sf):
    mwh = F.col("annual_waste_mwh")
    return X.staged(spark, sf).agg(F.sum(mwh).alias("all_waste"), F.sum(F.when(F.col("pue_value") > dec("1.2"), mwh)).alias("waste_above_target"))


@query("agg15_filter_context", with_ctes(f"""
SELECT {mean("(CASE WHEN country = 'India' THEN pue_value END)", 3, 3)} AS india_avg, {mean("(CASE WHEN country = 'India' THEN NULL ELSE pue_value END)", 3, 3)} AS global_avg FROM stg""", "stg"))
def _(spark, sf):
    india, pue = metrics.is_india(F.col("country")), F.col("pue_value")
    return X.staged(spark, sf).agg(
        mean_half_up(F.when(india, pue), 3, 3).alias("india_avg"), mean_half_up(F.when(~india, pue), 3, 3).alias("global_avg"))


@query("agg16_drill_down", with_ctes(
    f"SELECT tier, company, facility_name, grouping_id(tier, company, facility_name)::INTEGER AS level, count(*) AS records, {mean('pue_value', 3, 3)} AS avg_pue, "
    "sum(capacity_mw)::DOUBLE AS capacity_mw FROM cleaned GROUP BY ROLLUP (tier, company, facility_name)", "cleaned"))
def _(spark, sf):
    return analytics.drill_down(X.cleaned(spark, sf))


@query("srt01_by_pue", with_ctes("SELECT row_number() OVER (ORDER BY pue_value, pue_id) AS place, pue_id FROM stg", "stg"))
def _(spark, sf):
    return places(X.staged(spark, sf).select("pue_id", "pue_value").orderBy("pue_value", "pue_id"), "pue_id")


@query("srt02_desc_nulls_last", with_ctes("SELECT row_number() OVER (ORDER BY annual_waste_mwh DESC NULLS LAST, pue_id) AS place, pue_id FROM stg", "stg"))
def _(spark, sf):
    rows = X.staged(spark, sf).select("pue_id", "annual_waste_mwh")
    return places(rows.orderBy(F.desc_nulls_last("annual_waste_mwh"), "pue_id"), "pue_id")


@query("srt03_company_year", with_ctes("SELECT row_number() OVER (ORDER BY company_name, metric_year DESC NULLS FIRST, pue_id) AS place, pue_id FROM stg", "stg"))
def _(spark, sf):
    rows = X.staged(spark, sf).select("pue_id", "company_name", "metric_year")
    return places(rows.orderBy("company_name", F.desc_nulls_first("metric_year"), "pue_id"), "pue_id")


@query("srt05_top_operators", with_ctes(f"""
SELECT company, {mean('pue_value', 3, 6)} AS avg_pue, count(facility_name) AS facility_count FROM cleaned WHERE country = 'India' GROUP BY company
ORDER BY avg_pue, company LIMIT 10""", "cleaned"))
def _(spark, sf):
    return analytics.top_operators(X.cleaned(spark, sf).filter("country = 'India'"))


@query("srt06_first_hits_per_query", with_ctes("""
SELECT hit_id, company, query_no, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY company, query_no ORDER BY pos, hit_id) AS rank FROM search_hits) WHERE rank <= 5""", "search_hits"))
def _(spark, sf):
    hits = X.search_hits(spark, sf)
    return first_n_per_key(hits, ["company", "query_no"], [F.col("pos"), F.col("hit_id")], 5).select("hit_id", "company", "query_no", "rank")


@query("set01_union_of_groups", _TWO_ROWS)
def _(spark, sf):
    """The two halves computed on their own and appended, against the same statement as the one-pass mart."""
    stg, india = X.staged(spark, sf), metrics.is_india(F.col("country"))
    halves = [marts.india_vs_global(stg.filter(c)).filter(F.col("region_group") == n) for n, c in (("India", india), ("Global", ~india))]
    return cleaning.append_all(halves)


@query("set02_append_sources", with_ctes("""
SELECT id, company, pue_type, NULL::VARCHAR AS url FROM raw_pue UNION ALL SELECT hit_id, company, NULL, url FROM search_hits""", "raw_pue", "search_hits"))
def _(spark, sf):
    a = X.raw_pue(spark, sf).select("id", "company", "pue_type")
    b = X.search_hits(spark, sf).select(F.col("hit_id").alias("id"), "company", "url")
    return cleaning.append_all([a, b])


@query("set03_distinct_companies", with_ctes("SELECT DISTINCT company FROM raw_pue", "raw_pue"))
def _(spark, sf):
    return X.raw_pue(spark, sf).select("company").distinct()


@query("an01_headline_figures", with_ctes(f"""
SELECT count(*) AS total_facilities, {mean('pue_value', 3, 3)} AS avg_pue, min(pue_value)::DOUBLE AS best_pue, {mean('renewable_pct', 0, 1)} AS avg_renewable_pct FROM cleaned""", "cleaned"))
def _(spark, sf):
    return analytics.headline(X.cleaned(spark, sf))


@query("an02_shown_of_total", with_ctes("SELECT count(*) FILTER (country = 'India') AS records_shown, count(*) AS records_total FROM cleaned", "cleaned"))
def _(spark, sf):
    return analytics.shown_of_total(X.cleaned(spark, sf), F.col("country") == "India")


_DISPLAY = with_ctes("""
SELECT row_number() OVER (ORDER BY pue_value NULLS LAST, md5(id), id) AS rank, company, facility_name, city, country, pue_value::VARCHAR AS pue_value, pue_type,
  CASE WHEN capacity_mw IS NULL THEN 'N/A' ELSE capacity_mw::DECIMAL(10,1)::VARCHAR END AS capacity_mw,
  CASE WHEN renewable_pct IS NULL THEN 'N/A' ELSE renewable_pct::VARCHAR || '%' END AS renewable_pct, tier FROM cleaned""", "cleaned")


@query("an03_display_leaderboard", _DISPLAY)
def _(spark, sf):
    return analytics.display_leaderboard(X.cleaned(spark, sf))


@query("snk06_leaderboard_export", _DISPLAY.replace("facility_name, city, country", "facility_name, nullif(city, '') AS city, country"))
def _(spark, sf):
    path, board = scratch(spark, "board"), analytics.display_leaderboard(X.cleaned(spark, sf), ordered=True)
    writers.save_csv(board, path)
    return readers.read_clean_csv(spark, path, board.schema)


@query("an04_type_counts", with_ctes("""
SELECT count(*) FILTER (pue_type = 'design') AS design_count, count(*) FILTER (pue_type IN ('operating', 'TTM')) AS operating_count,
  count(*) FILTER (pue_type = 'TTM') AS ttm_count FROM cleaned""", "cleaned"))
def _(spark, sf):
    return analytics.type_counts(X.cleaned(spark, sf))


@query("an05_company_scatter", with_ctes(
    "SELECT company, " + dbl("pue_value", "capacity_mw") + ", pue_type, facility_name, city, year FROM cleaned WHERE pue_type IN ('design', 'operating', 'TTM')", "cleaned"))
def _(spark, sf):
    return analytics.company_scatter(X.cleaned(spark, sf))


@query("an06_india_comparison", with_ctes(f"""
SELECT {mean("(CASE WHEN country = 'India' THEN pue_value END)", 3, 3)} AS india_avg_pue,
  round(sum(pue_value) FILTER (country = 'India')::DOUBLE / count(pue_value) FILTER (country = 'India')
    - sum(pue_value) FILTER (country IS DISTINCT FROM 'India')::DOUBLE / count(pue_value) FILTER (country IS DISTINCT FROM 'India'), 3) AS delta_vs_global,
  min(pue_value) FILTER (country = 'India')::DOUBLE AS india_best_pue, round(sum(capacity_mw) FILTER (country = 'India'), 1)::DOUBLE AS india_capacity_mw,
  count(*) FILTER (country = 'India') AS india_facilities FROM cleaned""", "cleaned"))
def _(spark, sf):
    return analytics.india_comparison(X.cleaned(spark, sf))


@query("an07_india_facilities", with_ctes(
    "SELECT company, facility_name, city, " + dbl("pue_value", "capacity_mw") + ", pue_type, rack_count FROM cleaned WHERE country = 'India'", "cleaned"))
def _(spark, sf):
    return analytics.india_facilities(X.cleaned(spark, sf))


@query("an08_india_waste_cost", with_ctes("""
SELECT round(sum(annual_waste_mwh * 7.0 * 0.0001), 2)::DOUBLE AS annual_waste_crores,
  round(sum(greatest(CAST((pue_value - 1.2) * capacity_mw AS DECIMAL(18,5)) * 8760, 0) * 7.0 * 0.0001), 2)::DOUBLE AS potential_savings_crores
FROM cleaned WHERE country = 'India' AND capacity_mw IS NOT NULL""", "cleaned"))
def _(spark, sf):
    return analytics.india_waste_cost(X.cleaned(spark, sf))


_FORM = """SELECT id, pue_value AS current_pue, (1.0 + (renewable_pct % 7) * 0.1)::DECIMAL(5,3) AS target_pue, capacity_mw, (2.0 + (rack_count // 100) % 20)::DECIMAL(6,2) AS tariff
  FROM raw_pue WHERE pue_value IS NOT NULL AND renewable_pct IS NOT NULL AND capacity_mw IS NOT NULL AND rack_count IS NOT NULL"""
_FORM_BOUNDS = "current_pue BETWEEN 1.0 AND 3.0 AND target_pue BETWEEN 1.0 AND current_pue AND capacity_mw BETWEEN 0.1 AND 500.0 AND tariff BETWEEN 1.0 AND 20.0"


def _form(spark, sf):
    """One scenario per record that has all four inputs."""
    return X.raw_pue(spark, sf).dropna(subset=["pue_value", "renewable_pct", "capacity_mw", "rack_count"]).select(
        "id", F.col("pue_value").alias("current_pue"),
        (dec("1.0") + (F.col("renewable_pct") % 7) * dec("0.1")).cast("decimal(5,3)").alias("target_pue"), "capacity_mw",
        (dec("2.0") + F.floor(F.col("rack_count") / 100) % 20).cast("decimal(6,2)").alias("tariff"),
    )


@query("an09_scenario_results", with_ctes(f"""
SELECT id, (CAST((current_pue - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760)::DOUBLE AS current_waste_mwh,
  (CAST((target_pue - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760)::DOUBLE AS target_waste_mwh,
  (CAST((current_pue - target_pue) * capacity_mw AS DECIMAL(18,5)) * 8760)::DOUBLE AS savings_mwh,
  round(CAST((current_pue - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760 * tariff * 0.0001, 4)::DOUBLE AS current_cost_crores,
  round(CAST((target_pue - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760 * tariff * 0.0001, 4)::DOUBLE AS target_cost_crores,
  round(CAST((current_pue - target_pue) * capacity_mw AS DECIMAL(18,5)) * 8760 * tariff * 0.0001, 4)::DOUBLE AS savings_crores,
  round(CAST((current_pue - target_pue) * capacity_mw AS DECIMAL(18,5)) * 8760 * 0.82, 2)::DOUBLE AS co2_tons,
  ((2 * CAST((current_pue - target_pue) * 1000 AS HUGEINT) * 1000 + CAST(current_pue * 1000 AS HUGEINT)) // (2 * CAST(current_pue * 1000 AS HUGEINT)))::DOUBLE / 10 AS pue_improvement_pct
FROM ({_FORM}) WHERE {_FORM_BOUNDS}""", "raw_pue"))
def _(spark, sf):
    rows = analytics.scenario_results(analytics.valid_scenarios(_form(spark, sf)))
    return rows.drop("current_pue", "target_pue", "capacity_mw", "tariff", "band")


@query("an10_recommendation_band", with_ctes(
    f"SELECT id, CASE WHEN current_pue > 1.8 THEN 'high' WHEN current_pue > 1.5 THEN 'moderate' ELSE 'good' END AS band FROM ({_FORM}) WHERE {_FORM_BOUNDS}", "raw_pue"))
def _(spark, sf):
    return analytics.scenario_results(analytics.valid_scenarios(_form(spark, sf))).select("id", "band")


@query("an11_scenario_bounds", with_ctes(f"SELECT id FROM ({_FORM}) WHERE {_FORM_BOUNDS}", "raw_pue"))
def _(spark, sf):
    return analytics.valid_scenarios(_form(spark, sf)).select("id")


@query("fn_default_pue_by_tier", with_ctes("SELECT tier, coalesce(p_pue, 1.50)::DOUBLE AS default_pue, count(*) AS n FROM raw_pue LEFT JOIN tier_pue ON tier = p_tier GROUP BY ALL", "raw_pue", "tier_pue"))
def _(spark, sf):
    filled = cleaning.fill_missing_pue(X.raw_pue(spark, sf).withColumn("pue_value", F.lit(None).cast("decimal(5,3)")))
    return filled.groupBy("tier", F.col("pue_value").alias("default_pue")).agg(F.count(F.lit(1)).alias("n"))
