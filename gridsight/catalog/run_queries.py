"""Whole runs: extraction from pages to records, loading into the star schema."""

from pyspark.sql import functions as F

from gridsight.catalog import fixtures as X
from gridsight.catalog.base import places, query, scratch
from gridsight.catalog.oracle_sql import CTES, cte, with_ctes
from gridsight.catalog.text_queries import visible_text
from gridsight.operators import search
from gridsight.operators.location import resolve_countries
from gridsight.plans import build_run, marts, star_load
from gridsight.plans.extraction_run import extraction_run
from gridsight.sources.lookups import city_temperatures, country_index

# -- the same inputs and texts in SQL

cte("run_pages", [], """
SELECT page_id, page_id // 4 AS k, url, html || CASE
  WHEN page_id // 4 % 5 = 0 AND page_id % 4 = 0 OR page_id // 4 % 5 = 2 AND page_id % 4 = 3 OR page_id // 4 % 5 = 4 AND page_id % 4 >= 2
    THEN '<p>The data center achieved a PUE of 1.' || (page_id % 90 + 10)::VARCHAR || ' in 2025 near Mumbai.</p>'
  WHEN page_id // 4 % 5 = 4 AND page_id % 4 = 1 THEN '<p>It runs on 65% renewable energy.</p>' ELSE '<p>Nothing.</p>' END AS html,
  [regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/reports/' || page_id::VARCHAR || '.PDF', 'https://files.example.org/' || page_id::VARCHAR || '/x.pdf',
   regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'rel/' || page_id::VARCHAR || '.pdf'] AS links
FROM pages""")
cte("run_reports", ["report_text"], """
SELECT d.doc_id, CASE d.doc_id % 4 WHEN 3 THEN 'https://files.example.org/' || page_id::VARCHAR || CASE WHEN page_id % 4 = 0 THEN '/annual.pdf' ELSE '/never' END ELSE links[d.doc_id % 4 + 1] END AS url,
  CASE WHEN k % 5 = 1 THEN r.text ELSE d.text END AS text
FROM documents d JOIN report_text r ON d.doc_id = r.doc_id JOIN (SELECT page_id, page_id // 4 AS k, links FROM run_pages) p ON page_id = d.doc_id // 4""")
CTES["run_reports"] = (["report_text", "run_pages"], CTES["run_reports"][1])
cte("run_texts", ["run_pages", "run_reports"], f"""
SELECT 2 * page_id AS doc_id, 'html' AS kind, url, full_text AS text FROM (SELECT url, page_id, {visible_text('html')} AS full_text FROM run_pages) UNION ALL
SELECT 2 * doc_id + 1, 'pdf', url, text FROM run_reports""")
for _name in ("mentions", "text_metrics"):
    cte(f"run_{_name}", ["run_texts"], CTES[_name][1].replace("report_text", "run_texts"))
cte("run_found", ["run_texts", "run_mentions", "run_text_metrics"], """
SELECT x.kind, x.url, m.doc_id IS NOT NULL AS has_pue, len(renewable) > 0 OR len(wue) > 0 OR len(capacity) > 0 AS has_other,
  coalesce(nullif(m.year, 0), years[1], 2025) AS year, m.value::DECIMAL(5,3)::DOUBLE AS pue_value, m.type AS pue_type, capacity[1]::DECIMAL(10,2)::DOUBLE AS capacity_mw,
  racks[1] AS rack_count, renewable[1] AS renewable_pct, place
FROM run_texts x JOIN run_text_metrics t ON x.doc_id = t.doc_id LEFT JOIN run_mentions m ON x.doc_id = m.doc_id""")
cte("run_registry", ["run_pages"], """
SELECT k, 'Site' || k::VARCHAR AS name, CASE k % 3 WHEN 0 THEN 'Tier 1 - Global Hyperscaler' WHEN 1 THEN 'Tier 2 - Indian Operator' ELSE 'Tier 3 - Global Colocation' END AS tier,
  CASE WHEN k % 3 = 1 THEN 'India' ELSE 'Global' END AS region, max(CASE WHEN page_id % 4 = 0 THEN url END) AS u0, max(CASE WHEN page_id % 4 = 1 THEN url END) AS u1,
  'https://files.example.org/' || (4 * k)::VARCHAR || '/annual.pdf' AS report
FROM run_pages WHERE page_id % 4 < 2 GROUP BY k""")
cte("run_results", ["run_pages"], """
SELECT k, url, CASE WHEN page_id % 4 = 2 THEN 3 ELSE 5 END AS place FROM run_pages WHERE page_id % 4 = 2 OR page_id % 4 = 3 AND k % 2 = 0""")

_ROW = "name AS company, {url} AS source_url, {kind} AS source_type, {city} AS city, {country} AS country, r.region, r.tier, year, pue_value, pue_type, capacity_mw, rack_count, renewable_pct"


def _official(follow: int, reports: bool, rule: str, page_type: str, city: str, country: str) -> str:
    """Records of the stated addresses, and of the reports their pages link to."""
    def rows(source: str, kind: str, label: str) -> str:
        return "SELECT r.k, " + _ROW.format(url="f.url", kind=f"'{label}'", city=city, country=country) + f" FROM run_registry r JOIN {source} JOIN run_found f ON f.kind = '{kind}' AND f.url = a.url WHERE {rule}"

    parts = [rows("(SELECT k, unnest([u0, u1]) AS url FROM run_registry) a ON a.k = r.k", "html", page_type)]
    if reports:
        parts.append(rows("(SELECT k, report AS url FROM run_registry) a ON a.k = r.k", "pdf", "sustainability_report"))
        parts.append(rows(f"(SELECT k, unnest(links[1:{follow}]) AS url FROM run_pages WHERE page_id % 4 < 2) a ON a.k = r.k", "pdf", "sustainability_report"))
    return " UNION ALL ".join(parts)


_SEARCHED = "SELECT k, " + _ROW.format(url="url", kind="'search_result'", city="{city}", country="{country}") + """ FROM (
  SELECT r.*, f.* EXCLUDE (kind), dense_rank() OVER (PARTITION BY r.k ORDER BY s.place) AS first_one
  FROM run_registry r JOIN run_results s ON s.k = r.k JOIN run_found f ON f.kind = 'html' AND f.url = s.url
  WHERE has_pue AND r.k NOT IN (SELECT k FROM official)) r WHERE first_one = 1"""
_LISTED = """
SELECT k, name, u0, 'estimated', city, 'India', region, tier, 2025, pue::DOUBLE, 'design', mw::DOUBLE, racks::INTEGER, NULL FROM (
  SELECT *, unnest(['Navi Mumbai', 'Mumbai']) AS city, unnest([(k % 40 + 130) * 0.01, (k % 30 + 140) * 0.01]) AS pue, unnest([k % 60 + 1, k % 30 + 2]) AS mw, unnest([k % 70 * 100, k % 50 * 100]) AS racks
  FROM run_registry) WHERE k % 3 = 1 AND k NOT IN (SELECT k FROM official) AND k NOT IN (SELECT k FROM searched)"""
_NONE = ("NULL::VARCHAR", "NULL::VARCHAR")
_INDIA = ("place.city", "coalesce(place.country, 'India')")
_NEEDS = ("run_registry", "run_found", "run_results")
_GLOBAL = _official(3, True, "has_pue OR has_other", "web_page", *_NONE)
_COLOCATION = "SELECT * EXCLUDE (k) FROM official UNION ALL SELECT * EXCLUDE (k) FROM searched"


def _run_sql(body: str, official: str, city: str, country: str) -> str:
    steps = with_ctes("", *_NEEDS).rstrip()
    return f"{steps}, official AS ({official}), searched AS ({_SEARCHED.format(city=city, country=country)}), listed AS ({_LISTED})\n{body}"


_COLUMNS = ["company", "source_url", "source_type", "city", "country", "region", "tier", "year", "pue_value", "pue_type", "capacity_mw", "rack_count", "renewable_pct"]


def _run(spark, sf, variant):
    return extraction_run(X.run_registry(spark, sf), X.run_pages(spark, sf), X.run_reports(spark, sf), X.run_hits(spark, sf), X.AS_OF, variant, scratch(spark, f"run_{variant}"))


@query("txt27_extraction_global", _run_sql("SELECT * EXCLUDE (k) FROM official", _GLOBAL, *_NONE))
def _(spark, sf):
    return _run(spark, sf, "global")[0].select(*_COLUMNS)


@query("txt27_extraction_colocation", _run_sql(_COLOCATION, _official(2, True, "has_pue", "web_page", *_NONE), *_NONE))
def _(spark, sf):
    return _run(spark, sf, "colocation")[0].select(*_COLUMNS)


_INDIA_PAGES = _official(0, False, "has_pue", "official_page", *_INDIA)


@query("txt27_extraction_india", _run_sql(_COLOCATION + " UNION ALL SELECT * EXCLUDE (k) FROM listed", _INDIA_PAGES, *_INDIA))
def _(spark, sf):
    return _run(spark, sf, "india")[0].select(*_COLUMNS)


@query("txt28_extraction_run_summary", _run_sql("""
SELECT (SELECT count(*) FROM run_registry) AS companies_processed, count(*) AS records_extracted, count(DISTINCT company) AS companies_with_data, count(pue_value) AS records_with_pue
FROM official""", _GLOBAL, *_NONE))
def _(spark, sf):
    return _run(spark, sf, "global")[1]


_FIRST = """
SELECT *, row_number() OVER (PARTITION BY company, url ORDER BY query_no, pos, hit_id) AS u FROM (
  SELECT *, row_number() OVER (PARTITION BY company, query_no ORDER BY pos, hit_id) AS n FROM search_hits) WHERE n <= 5"""


@query("txt26_first_hits", with_ctes(f"""
SELECT company, hit_no::INTEGER AS hit_no, url FROM (
  SELECT *, row_number() OVER (PARTITION BY company ORDER BY query_no, pos, hit_id) AS hit_no FROM ({_FIRST}) WHERE u = 1) WHERE hit_no <= 5 AND NOT url LIKE '%.pdf'""", "search_hits"))
def _(spark, sf):
    return search.first_hits(X.search_hits(spark, sf)).select("company", "hit_no", "url")


@query("txt26_official_hits", with_ctes("""
SELECT hit_id, company, query_no, pos, url FROM (
  SELECT *, row_number() OVER (PARTITION BY company, url ORDER BY query_no, pos, hit_id) AS u FROM (
    SELECT *, row_number() OVER (PARTITION BY company, query_no ORDER BY pos, hit_id) AS n FROM search_hits) WHERE n <= 5 AND contains(lower(url), replace(lower(company), ' ', ''))) WHERE u = 1""", "search_hits"))
def _(spark, sf):
    return search.official_results(X.search_hits(spark, sf)).select("hit_id", "company", "query_no", "pos", "url")


# -- loading in runs: "first" has some companies, "second" has all records and is loaded twice

_FIRST_RUN = "company < 'Supplier#000000005'"


def _loaded(spark, sf, table):
    root, rows = scratch(spark, "star"), X.warehouse_rows(spark, sf)
    star_load.load(rows.where(_FIRST_RUN), root, "first")
    star_load.load(rows, root, "second")
    star_load.load(rows, root, "second")
    star_load.remove_replaced(spark, root)
    return star_load.read_star(spark, root, table)


@query("jn05_load_facts", with_ctes(f"""
SELECT sha256(id) AS fact_id, f.company_id, location_id, f.year, f.pue_value::DOUBLE AS pue_value, CASE WHEN {_FIRST_RUN} THEN 'first' ELSE 'second' END AS run
FROM fact f JOIN enriched e ON f.fact_id = sha256(e.id)""", "fact", "enriched"))
def _(spark, sf):
    return _loaded(spark, sf, "fact").select("fact_id", "company_id", "location_id", "year", "pue_value", "run")


@query("jn03_load_companies", with_ctes("""
SELECT company_id, company_name, tier, region, CASE WHEN company_name < 'Supplier#000000005' THEN 'first' ELSE 'second' END AS run FROM dim_company""", "dim_company"))
def _(spark, sf):
    return _loaded(spark, sf, "dim_company")


@query("jn04_load_places", with_ctes(f"""
SELECT sha256(city || '|' || coalesce(country, '')) AS location_id, city, country, country_code, region, avg_temp_celsius::DOUBLE AS avg_temp_celsius,
  CASE WHEN {_FIRST_RUN} THEN 'first' ELSE 'second' END AS run FROM (
  SELECT *, row_number() OVER (PARTITION BY city, country ORDER BY CASE WHEN {_FIRST_RUN} THEN 0 ELSE 1 END, id) AS rn FROM enriched WHERE coalesce(city, '') <> '') WHERE rn = 1""", "enriched"))
def _(spark, sf):
    return _loaded(spark, sf, "dim_location")


@query("snk03_load_counts", with_ctes(f"""
SELECT run, count(*) AS raw, count(*) FILTER (ok) AS fact, count(*) FILTER (NOT ok) AS rejected FROM (
  SELECT CASE WHEN {_FIRST_RUN} THEN 'first' ELSE 'second' END AS run, sha256(id) IN (SELECT fact_id FROM fact) AS ok FROM enriched) GROUP BY run""", "enriched", "fact"))
def _(spark, sf):
    root, rows = scratch(spark, "star"), X.warehouse_rows(spark, sf)
    star_load.load(rows.where(_FIRST_RUN), root, "first")
    star_load.load(rows, root, "second")
    return star_load.runs(spark, root).select("run", "raw", "fact", "rejected")


# -- building and testing


def _sources(spark, sf):
    facts, companies, places_ = X.star(spark, sf)
    return {"raw_pue_data": X.warehouse_rows(spark, sf), "seed_rows": city_temperatures(spark), "dim_company": companies, "dim_location": places_, "fact_efficiency": facts}


_TABLE_OF = {"raw_pue_data": "enriched", "dim_company": "dim_company", "dim_location": "dim_location", "fact_efficiency": "fact"}


def _test_sql(c: build_run.Check) -> str:
    table = _TABLE_OF[c.table]
    n = {
        "not_null": f"SELECT count(*) FROM {table} WHERE {c.column} IS NULL",
        "unique": f"SELECT count(*) FROM (SELECT {c.column} FROM {table} WHERE {c.column} IS NOT NULL GROUP BY ALL HAVING count(*) > 1)",
        "accepted": f"SELECT count(DISTINCT {c.column}) FROM {table} WHERE {c.where or 'true'} AND {c.column} NOT IN ({', '.join(c.values) or 'NULL'})",
    }[c.kind]
    return f"SELECT '{c.name}' AS test, '{c.table}' AS table, '{c.severity}' AS severity, ({n}) AS failures"


@query("dq09_build_and_test", with_ctes(
    "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM (" + " UNION ALL ".join(map(_test_sql, build_run.CHECKS)) + ")",
    "enriched", "fact", "dim_company", "dim_location"))
def _(spark, sf):
    return build_run.build_and_test(spark, _sources(spark, sf), scratch(spark, "build"))[1]


@query("snk05_build_models", with_ctes("""
SELECT 'city_temperatures' AS model, 19::BIGINT AS records UNION ALL SELECT 'stg_pue', count(*) FROM stg UNION ALL SELECT 'mart_leaderboard', count(*) FROM stg UNION ALL
SELECT 'mart_india_vs_global', 2 UNION ALL SELECT 'mart_cost_waste', count(*) FROM stg WHERE capacity_mw IS NOT NULL UNION ALL
SELECT 'mart_climate_impact', count(*) FROM stg WHERE capacity_mw IS NOT NULL""", "stg"))
def _(spark, sf):
    built = build_run.build(_sources(spark, sf), build_run.MODELS, scratch(spark, "build"))
    counts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("model"), "records") for n, df in built.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


_TARIFF = "CASE country WHEN 'India' THEN 7.0 WHEN 'United States' THEN 10.0 ELSE 8.5 END"


@query("srt02_mart_order", with_ctes(f"""
SELECT 'cost' AS mart, row_number() OVER (ORDER BY v DESC NULLS LAST) AS place, v::DOUBLE AS v FROM (
  SELECT round(annual_waste_mwh * {_TARIFF} * 0.0001, 2) AS v FROM stg WHERE capacity_mw IS NOT NULL)
UNION ALL SELECT 'rank', row_number() OVER (ORDER BY pue_value), pue_value::DOUBLE FROM stg""", "stg"))
def _(spark, sf):
    """The marts in the order in which they come."""
    stg = X.staged(spark, sf)
    cost = places(marts.cost_waste(stg, ordered=True).select(F.col("annual_waste_cost_crores").cast("double").alias("v")), "v")
    rank = places(marts.leaderboard(stg, ordered=True).select(F.col("pue_value").cast("double").alias("v")), "v")
    return cost.select(F.lit("cost").alias("mart"), "place", "v").unionByName(rank.select(F.lit("rank").alias("mart"), "place", "v"))


# fixed values: the country names of the table nation with their codes
_NATIONS = {
    "ALGERIA": "DZ", "ARGENTINA": "AR", "BRAZIL": "BR", "CANADA": "CA", "EGYPT": "EG", "ETHIOPIA": "ET", "FRANCE": "FR", "GERMANY": "DE", "INDIA": "IN",
    "INDONESIA": "ID", "IRAN": "IR", "IRAQ": "IQ", "JAPAN": "JP", "JORDAN": "JO", "KENYA": "KE", "MOROCCO": "MA", "MOZAMBIQUE": "MZ", "PERU": "PE",
    "CHINA": "CN", "ROMANIA": "RO", "SAUDI ARABIA": "SA", "VIETNAM": "VN", "RUSSIA": "RU", "UNITED KINGDOM": "GB", "UNITED STATES": "US",
}


@query("enr04_country_resolver", "SELECT c_custkey, n_name AS country, code AS country_code FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (VALUES "
       + ", ".join(f"('{n}', '{c}')" for n, c in _NATIONS.items()) + ") AS t(name, code) ON n_name = name")
def _(spark, sf):
    nations = X.dimension(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    rows = X.table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")
    return resolve_countries(rows, country_index(spark))
