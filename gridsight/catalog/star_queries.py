"""Views and report measures over the star schema."""

from pyspark.sql import functions as F

from gridsight.catalog import fixtures as X
from gridsight.catalog.base import query
from gridsight.catalog.oracle_sql import dbl, mean, with_ctes
from gridsight.functions import metrics
from gridsight.operators.joins import salted_join
from gridsight.plans import measures, views

_FACT_NUMBERS = dbl("pue_value", "cooling_overhead_pct", "capacity_mw", "wue_l_per_kwh", "annual_waste_mwh")


@query("jn01_fact_company", with_ctes("SELECT fact_id, company_name, tier FROM star_rows", "star_rows"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    return salted_join(facts, companies, ["company_id"], "inner", "fact_id", X.hot_keys(spark, sf)).select("fact_id", "company_name", "tier")


@query("jn02_fact_location", with_ctes("SELECT fact_id, city, country FROM star_rows", "star_rows"))
def _(spark, sf):
    facts, _, locations = X.star(spark, sf)
    return salted_join(facts, locations, ["location_id"], "left", "fact_id", X.hot_keys(spark, sf)).select("fact_id", "city", "country")


@query("jn08_star_relationships", with_ctes("SELECT fact_id, company_name, tier, city, country, avg_temp_celsius::DOUBLE AS avg_temp_celsius FROM star_rows", "star_rows"))
def _(spark, sf):
    return views.with_dimensions(*X.star(spark, sf), hot=X.hot_keys(spark, sf)).select("fact_id", "company_name", "tier", "city", "country", "avg_temp_celsius")


@query("vw01_efficiency_leaderboard", with_ctes(
    f"SELECT company_name, tier, facility_name, city, country, year, pue_type, renewable_pct, {_FACT_NUMBERS} FROM star_rows", "star_rows"))
def _(spark, sf):
    return views.efficiency_leaderboard(*X.star(spark, sf), hot=X.hot_keys(spark, sf))


@query("vw02_region_comparison", with_ctes(f"""
SELECT CASE WHEN country = 'India' THEN 'India' ELSE 'Global' END AS region_group, count(*) AS facility_count, {mean('pue_value', 3, 3)} AS avg_pue,
  min(pue_value)::DOUBLE AS min_pue, max(pue_value)::DOUBLE AS max_pue, {mean('renewable_pct', 0, 1)} AS avg_renewable_pct,
  round(sum(capacity_mw), 1)::DOUBLE AS total_capacity_mw, round(sum(annual_waste_mwh), 1)::DOUBLE AS total_waste_mwh FROM star_rows GROUP BY 1""", "star_rows"))
def _(spark, sf):
    facts, _, locations = X.star(spark, sf)
    return views.region_comparison(facts, locations)


@query("vw03_tier_comparison", with_ctes(f"""
SELECT tier, count(*) AS facility_count, {mean('pue_value', 3, 3)} AS avg_pue, min(pue_value)::DOUBLE AS best_pue, {mean('renewable_pct', 0, 1)} AS avg_renewable_pct,
  count(*) FILTER (pue_type = 'operating') AS operating_pue_count, count(*) FILTER (pue_type = 'design') AS design_pue_count FROM star_rows GROUP BY tier""", "star_rows"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    return views.tier_comparison(facts, companies)


@query("vw04_climate_impact", with_ctes(
    "SELECT company_name, tier, country, " + dbl("avg_temp_celsius", "pue_value", "capacity_mw", "cooling_overhead_pct", "annual_waste_mwh")
    + ", round(annual_waste_mwh * 1000 * 0.82, 2)::DOUBLE AS annual_co2_tons FROM star_rows WHERE capacity_mw IS NOT NULL", "star_rows"))
def _(spark, sf):
    return views.climate_view(*X.star(spark, sf), hot=X.hot_keys(spark, sf))


@query("vw05_design_vs_operating", with_ctes(
    "SELECT company_name, pue_type, pue_value::DOUBLE AS pue_value, year, facility_name FROM star_rows WHERE pue_type IN ('design', 'operating', 'TTM')", "star_rows"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    return views.design_vs_operating(facts, companies, X.hot_keys(spark, sf))


@query("bi01_efficiency_category", with_ctes("""
SELECT fact_id, CASE WHEN pue_value < 1.2 THEN 'Exceptional' WHEN pue_value < 1.4 THEN 'Excellent' WHEN pue_value < 1.6 THEN 'Good'
  WHEN pue_value < 1.8 THEN 'Fair' ELSE 'Needs Improvement' END AS efficiency_category FROM fact""", "fact"))
def _(spark, sf):
    facts, _, _ = X.star(spark, sf)
    return facts.select("fact_id", metrics.efficiency_category(F.col("pue_value")).alias("efficiency_category"))


@query("bi02_is_india", with_ctes("SELECT fact_id, CASE WHEN country = 'India' THEN 'India' ELSE 'Global' END AS is_india FROM star_rows", "star_rows"))
def _(spark, sf):
    return measures.report_rows(*X.star(spark, sf), hot=X.hot_keys(spark, sf)).select("fact_id", "is_india")


@query("bi03_pue_measures", with_ctes(
    f"SELECT {mean('pue_value', 3, 3)} AS avg_pue, min(pue_value)::DOUBLE AS best_pue, max(pue_value)::DOUBLE AS worst_pue FROM fact", "fact"))
def _(spark, sf):
    return measures.pue_measures(X.star(spark, sf)[0])


@query("bi04_count_measures", with_ctes("""
SELECT 'total_facilities' AS measure, count(DISTINCT fact_id) AS value FROM fact UNION ALL
SELECT 'total_companies', count(DISTINCT company_id) FROM dim_company""", "fact", "dim_company"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    return measures.count_measures(facts, companies)


@query("bi05_energy_measures", with_ctes("SELECT sum(capacity_mw)::DOUBLE AS total_capacity_mw, sum(annual_waste_mwh)::DOUBLE AS annual_waste_mwh FROM fact", "fact"))
def _(spark, sf):
    return measures.energy_measures(X.star(spark, sf)[0])


@query("bi06_waste_cost", with_ctes("SELECT round(sum(annual_waste_mwh * 7 * 0.0001), 2)::DOUBLE AS annual_waste_cost_crores FROM fact", "fact"))
def _(spark, sf):
    return measures.waste_cost(X.star(spark, sf)[0])


@query("bi07_potential_savings", with_ctes("""
SELECT round(sum(CAST((pue_value - 1.2) * capacity_mw AS DECIMAL(18,5)) * 8760 * 7 * 0.0001), 2)::DOUBLE AS potential_savings_crores
FROM fact WHERE pue_value > 1.2 AND capacity_mw IS NOT NULL""", "fact"))
def _(spark, sf):
    return measures.potential_savings(X.star(spark, sf)[0])


@query("bi08_climate_measures", with_ctes(
    f"SELECT round(sum(annual_waste_mwh * 0.82), 2)::DOUBLE AS annual_co2_tons, {mean('renewable_pct', 0, 1)} AS avg_renewable_pct FROM fact", "fact"))
def _(spark, sf):
    return measures.climate_measures(X.star(spark, sf)[0])


@query("bi09_region_gap", with_ctes("""
SELECT round(i, 3) AS india_avg_pue, round(g, 3) AS global_avg_pue, round(i - g, 3) AS pue_gap FROM (
  SELECT (sum(pue_value * 1000) FILTER (country = 'India'))::DOUBLE / (count(*) FILTER (country = 'India')) / 1000 AS i,
    (sum(pue_value * 1000) FILTER (country IS DISTINCT FROM 'India'))::DOUBLE / (count(*) FILTER (country IS DISTINCT FROM 'India')) / 1000 AS g FROM star_rows)""",
    "star_rows"))
def _(spark, sf):
    facts, _, locations = X.star(spark, sf)
    return measures.region_gap(facts, locations)


@query("bi10_traffic_light", with_ctes("""
SELECT fact_id, CASE WHEN pue_value < 1.3 THEN 'green' WHEN pue_value < 1.5 THEN 'yellow' WHEN pue_value <= 1.7 THEN 'orange' ELSE 'red' END AS traffic_light FROM fact""", "fact"))
def _(spark, sf):
    return X.star(spark, sf)[0].select("fact_id", metrics.traffic_light(F.col("pue_value")).alias("traffic_light"))


@query("bi11_temperature_scatter", with_ctes(
    "SELECT fact_id, city, " + dbl("avg_temp_celsius", "pue_value", "capacity_mw") + " FROM star_rows", "star_rows"))
def _(spark, sf):
    return measures.report_rows(*X.star(spark, sf), hot=X.hot_keys(spark, sf)).select("fact_id", "city", "avg_temp_celsius", "pue_value", "capacity_mw")


@query("agg17_co2_by_company", with_ctes(
    "SELECT company_name, round(sum(annual_waste_mwh) * 0.82, 2)::DOUBLE AS annual_co2_tons FROM star_rows GROUP BY company_name", "star_rows"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    return measures.co2_by_company(facts, companies)


@query("agg17_operator_ranking", with_ctes(
    f"SELECT company_name, {mean('pue_value', 3, 3)} AS avg_pue, count(*) AS facilities, sum(capacity_mw)::DOUBLE AS total_capacity_mw FROM star_rows GROUP BY company_name",
    "star_rows"))
def _(spark, sf):
    facts, companies, _ = X.star(spark, sf)
    return measures.operator_ranking(facts, companies)
