"""Building blocks of the SQL counterparts: the same derived inputs, written for DuckDB."""

from gridsight import fixed_values as V


def _text(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def values_of(table: dict) -> str:
    return ", ".join(f"({_text(k)}, {v})" for k, v in table.items())


def title_case(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({c}), '([a-z]+|[^a-z]+)'), "
        "lambda x: upper(x[1]) || x[2:]), '')"
    )


def alias_case(c: str) -> str:
    whens = " ".join(f"WHEN {_text(a)} THEN {_text(b)}" for a, b in V.CITY_ALIASES.items())
    return f"CASE {c} {whens} ELSE {c} END"


def mean(x: str, in_scale: int, out_scale: int) -> str:
    """Exact half-up mean as a double."""
    i, o = 10**in_scale, 10**out_scale
    total = f"sum(CAST({x} * {i} AS HUGEINT))"
    return (
        f"CASE WHEN count({x}) > 0 THEN ((2 * {total} * {o} + count({x}) * {i}) // (2 * count({x}) * {i}))::DOUBLE / {o} END"
    )


def dbl(*columns: str) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in columns)


_ID = "concat_ws('-', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR)"
_STAGE = "CASE s_suppkey % 3 WHEN 0 THEN l_linenumber % 3 WHEN 1 THEN 1 + l_linenumber % 2 ELSE 2 END"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], body: str) -> None:
    CTES[name] = (needs, body)


def with_ctes(body: str, *needs: str) -> str:
    """The statement with everything it needs in front."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in CTES[n][0]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


cte("raw_pue", [], f"""
SELECT {_ID} AS id, s_name AS company,
  CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE 'DC' || (l_partkey % 4)::VARCHAR END AS facility_name,
  CASE l_partkey % 16 WHEN 0 THEN 'bombay' WHEN 1 THEN ' Navi Mumbai ' WHEN 2 THEN 'bengaluru'
    WHEN 3 THEN 'noida/greater noida' WHEN 4 THEN 'CHENNAI' WHEN 5 THEN 'Virginia' WHEN 6 THEN 'oregon'
    WHEN 7 THEN 'Frankfurt' WHEN 8 THEN 'tokyo' WHEN 9 THEN 'Singapore' WHEN 10 THEN 'Texas'
    WHEN 11 THEN 'Gurgaon' WHEN 12 THEN 'Atlantis' WHEN 13 THEN '' WHEN 14 THEN NULL ELSE 'London' END AS city,
  CASE WHEN l_linenumber = 1 THEN 'India' END AS country, CAST(NULL AS VARCHAR) AS region,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(year(l_shipdate) + 23 AS INTEGER) END AS year,
  CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN NULL
    ELSE CAST(((l_partkey*31 + l_orderkey*7 + l_linenumber) % 2300 + 950) * 0.001 AS DECIMAL(5,3)) END AS pue_value,
  CASE l_orderkey % 7 WHEN 0 THEN 'TTM' WHEN 1 THEN 'operating' WHEN 2 THEN 'annual' WHEN 3 THEN 'measured'
    WHEN 4 THEN 'design' WHEN 5 THEN 'estimated' END AS pue_type,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(10,2)) END AS capacity_mw,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) * 100 END AS rack_count,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST((l_partkey*13 + l_linenumber) % 103 AS INTEGER) END AS renewable_pct,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(((l_suppkey*17 + l_partkey) % 1020) * 0.01 AS DECIMAL(10,3)) END AS wue_l_per_kwh,
  'https://example.com/' || l_suppkey::VARCHAR || '/' || l_partkey::VARCHAR AS source_url,
  CASE l_partkey % 7 WHEN 0 THEN 'sustainability_report' WHEN 1 THEN 'esg_report' WHEN 2 THEN 'specification'
    WHEN 3 THEN 'press_release' WHEN 4 THEN 'web_page' WHEN 5 THEN 'benchmark' ELSE 'news_article' END AS source_type,
  CAST(l_shipdate AS DATE) AS extraction_date,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'Tier 1 - Global Hyperscaler'
    WHEN s_suppkey % 3 = 1 THEN 'Tier 2 - Indian Operator' ELSE 'Tier 3 - Global Colocation' END AS tier
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")

cte("registry", [], """
SELECT s_suppkey, s_name AS name,
  CASE s_suppkey % 3 WHEN 0 THEN 'Tier 1 - Global Hyperscaler' WHEN 1 THEN 'Tier 2 - Indian Operator'
    ELSE 'Tier 3 - Global Colocation' END AS tier,
  CASE WHEN s_suppkey % 3 = 1 THEN 'India' ELSE 'Global' END AS region,
  'https://example.com/' || s_suppkey::VARCHAR || '/report.PDF' AS url0,
  'https://example.com/' || s_suppkey::VARCHAR || '/about' AS url1
FROM supplier""")

cte("city_dim", [], "SELECT * FROM (VALUES " + ", ".join(
    f"({_text(c)}, {_text(v[0])}, {_text(v[1])}, CAST({v[2] or 'NULL'} AS DECIMAL(5,2)))" for c, v in V.CITIES.items()
) + ") AS t(d_city, d_country, d_region, d_temp)")
cte("codes", [], "SELECT * FROM (VALUES " + ", ".join(
    f"({_text(c)}, {_text(k)})" for c, k in V.COUNTRY_CODES.items()) + ") AS t(k_country, k_code)")
cte("type_prio", [], f"SELECT * FROM (VALUES {values_of(V.PUE_TYPE_PRIORITY)}) AS t(t_key, t_prio)")
cte("source_prio", [], f"SELECT * FROM (VALUES {values_of(V.SOURCE_PRIORITY)}) AS t(s_key, s_prio)")
cte("tier_pue", [], f"SELECT * FROM (VALUES {values_of(V.TIER_DEFAULT_PUE)}) AS t(p_tier, p_pue)")

cte("normalized", ["raw_pue"], f"""
SELECT *, CASE WHEN coalesce(city, '') = '' THEN '' ELSE {alias_case(title_case('trim(city)'))} END AS norm_city
FROM raw_pue""")

cte("enriched", ["normalized", "city_dim", "codes"], """
SELECT r.* EXCLUDE (city, country, region, norm_city),
  CASE WHEN norm_city = '' THEN city ELSE norm_city END AS city,
  coalesce(country, d_country) AS country, coalesce(region, d_region) AS region,
  d_temp AS avg_temp_celsius, CASE WHEN norm_city <> '' THEN k_code END AS country_code
FROM normalized r LEFT JOIN city_dim ON norm_city = d_city
LEFT JOIN codes ON coalesce(country, d_country) = k_country""")

cte("stg", ["enriched"], """
SELECT *, id AS pue_id, company AS company_name, year AS metric_year,
  (pue_value - 1.0) * 100 AS cooling_overhead_pct,
  CAST((pue_value - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760 AS annual_waste_mwh
FROM enriched WHERE pue_value BETWEEN 1.0 AND 3.0""")

cte("imputed", ["enriched", "registry", "tier_pue"], """
SELECT e.* EXCLUDE (tier, pue_value, pue_type, source_type), coalesce(e.tier, g.tier) AS tier,
  coalesce(pue_value, CAST(coalesce(p_pue, 1.50) AS DECIMAL(5,3))) AS pue_value,
  CASE WHEN pue_value IS NULL THEN 'estimated' ELSE pue_type END AS pue_type,
  CASE WHEN pue_value IS NULL THEN 'benchmark' ELSE source_type END AS source_type
FROM enriched e LEFT JOIN registry g ON lower(e.company) = lower(g.name)
LEFT JOIN tier_pue ON coalesce(e.tier, g.tier) = p_tier""")

cte("valid", ["imputed"], """
SELECT * FROM imputed WHERE company IS NOT NULL AND pue_value BETWEEN 1.0 AND 3.0
  AND coalesce(renewable_pct BETWEEN 0 AND 100, true) AND coalesce(wue_l_per_kwh BETWEEN 0 AND 10, true)
  AND coalesce(capacity_mw > 0 AND capacity_mw <= 500, true) AND coalesce(rack_count > 0 AND rack_count <= 50000, true)
  AND coalesce(year BETWEEN 2000 AND 2026, true)""")

BEST = """SELECT * EXCLUDE (rn, t_key, t_prio, s_key, s_prio) FROM (
  SELECT *, row_number() OVER (PARTITION BY company, facility_name, city
    ORDER BY year DESC NULLS LAST, coalesce(t_prio, 0) DESC, coalesce(s_prio, 0) DESC, id) AS rn
  FROM {src} LEFT JOIN type_prio ON pue_type = t_key LEFT JOIN source_prio ON source_type = s_key) WHERE rn = 1"""

cte("cleaned", ["valid", "type_prio", "source_prio"], f"""
SELECT *, (pue_value - 1.0) * 100 AS cooling_overhead_pct,
  CAST((pue_value - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760 AS annual_waste_mwh
FROM ({BEST.format(src='valid')})""")

cte("dim_company", ["enriched"], """
SELECT sha256(company) AS company_id, company AS company_name, tier, region FROM (
  SELECT *, row_number() OVER (PARTITION BY company ORDER BY id) AS rn FROM enriched WHERE company IS NOT NULL) WHERE rn = 1""")
cte("dim_location", ["enriched"], """
SELECT sha256(city || '|' || coalesce(country, '')) AS location_id, city, country, country_code, region, avg_temp_celsius FROM (
  SELECT *, row_number() OVER (PARTITION BY city, country ORDER BY id) AS rn FROM enriched WHERE coalesce(city, '') <> '') WHERE rn = 1""")
cte("fact", ["enriched"], """
SELECT sha256(id) AS fact_id, sha256(company) AS company_id,
  CASE WHEN coalesce(city, '') <> '' THEN sha256(city || '|' || coalesce(country, '')) END AS location_id,
  facility_name, year, pue_value, pue_type, capacity_mw, rack_count, renewable_pct, wue_l_per_kwh,
  (pue_value - 1.0) * 100 AS cooling_overhead_pct,
  round(CAST((pue_value - 1.0) * capacity_mw AS DECIMAL(18,5)) * 8760, 2) AS annual_waste_mwh,
  source_url, source_type, extraction_date
FROM enriched WHERE company IS NOT NULL AND year IS NOT NULL AND pue_value BETWEEN 1.0 AND 3.0
  AND coalesce(renewable_pct BETWEEN 0 AND 100, true)""")
cte("star_rows", ["fact", "dim_company", "dim_location"], """
SELECT f.*, c.company_name, c.tier, l.city, l.country, l.avg_temp_celsius
FROM fact f JOIN dim_company c USING (company_id) LEFT JOIN dim_location l ON f.location_id = l.location_id""")

_N = "(doc_id % 90 + 10)::VARCHAR"
cte("report_text", [], f"""
SELECT doc_id, text || ' ' || CASE doc_id % 10
  WHEN 0 THEN 'The data center achieved a PUE of 1.' || {_N} || ' in 2025.'
  WHEN 1 THEN 'Rolling average PUE reached 1.' || {_N} || ' with 65% renewable energy.'
  WHEN 2 THEN 'Designed with a PUE of 1.' || {_N} || '. Capacity of ' || (doc_id % 600)::VARCHAR || ' MW.'
  WHEN 3 THEN 'In 2024, the PUE was 1.' || {_N} || ' near Mumbai.'
  WHEN 4 THEN 'Design PUE is 1.30 while operating PUE is 1.45.'
  WHEN 5 THEN 'Water Usage Effectiveness is 0.' || {_N} || ' L/kWh.'
  WHEN 6 THEN 'It hosts ' || (doc_id % 60 + 1)::VARCHAR || ',000 server racks. Powered by 100% renewable energy.'
  WHEN 7 THEN 'The PUE is 0.5 in Tokyo.'
  WHEN 8 THEN (doc_id % 40)::VARCHAR || ' megawatts facility in Frankfurt; 90% carbon-free energy in 2023 and 2024.'
  ELSE 'No sustainability information.' END AS text
FROM documents""")

_PUE_HITS = " UNION ALL ".join(
    f"SELECT doc_id, text, {k} AS pattern_no, i AS hit_no, h[i] AS hit, "
    f"CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + "
    f"coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start_at, "
    f"TRY_CAST(regexp_extract(h[i], {_text('(?i)' + p)}, {2 if k == 13 else 1}) AS DOUBLE) AS value, "
    + (f"TRY_CAST(regexp_extract(h[i], {_text('(?i)' + p)}, {1 if k == 13 else 2}) AS INTEGER)" if k >= 13 else "CAST(NULL AS INTEGER)")
    + " AS year "
    f"FROM (SELECT doc_id, text, regexp_extract_all(text, {_text('(?i)' + p)}, 0) AS h, "
    f"string_split_regex(text, {_text('(?i)' + p)}) AS g FROM report_text), unnest(range(1, len(h) + 1)) AS u(i)"
    for k, p in enumerate(V.PUE_PATTERNS)
)
_KIND = "CASE " + " ".join(
    f"WHEN regexp_matches(ctx, {_text('(?i)' + p)}) THEN {_text(n)}" for n, p in V.PUE_TYPE_PATTERNS
) + " ELSE 'operating' END"
cte("mentions", ["report_text"], f"""
SELECT doc_id, pattern_no, hit_no, value, {_KIND} AS type, year, trim(ctx, chr(10) || chr(13) || chr(9) || ' ') AS context FROM (
  SELECT *, substring(text, greatest(start_at - 50, 0) + 1,
    least(start_at + length(hit) + 50, length(text)) - greatest(start_at - 50, 0)) AS ctx
  FROM ({_PUE_HITS})) WHERE value BETWEEN 1.0 AND 3.0""")


def hits(patterns: list[str], group: int = 1) -> str:
    """All hits of all patterns as one list, in pattern order."""
    each = [f"regexp_extract_all(text, {_text('(?i)' + p)}, {group})" for p in patterns]
    out = each[0]
    for e in each[1:]:
        out = f"list_concat({out}, {e})"
    return out


def numbers(patterns: list[str], type_name: str, keep: str, strip_commas: bool = False) -> str:
    x = "replace(x, ',', '')" if strip_commas else "x"
    return (
        f"list_filter(list_transform({hits(patterns)}, lambda x: TRY_CAST({x} AS {type_name})), "
        f"lambda v: v IS NOT NULL AND {keep})"
    )


WUE = numbers(V.WUE_PATTERNS, "DOUBLE", "v BETWEEN 0 AND 10")
_FULL = " OR ".join(f"regexp_matches(text, {_text('(?i)' + p)})" for p in V.FULL_RENEWABLE_PATTERNS)
RENEWABLE = f"CASE WHEN {_FULL} THEN [100] ELSE {numbers(V.RENEWABLE_PATTERNS, 'INTEGER', 'v BETWEEN 0 AND 100')} END"
CAPACITY = numbers(V.CAPACITY_PATTERNS, "DOUBLE", "v > 0 AND v <= 500")
RACKS = numbers(V.RACK_PATTERNS, "INTEGER", "v > 0 AND v <= 50000", strip_commas=True)
YEARS = f"list_reverse_sort(list_distinct(list_transform({hits(V.YEAR_PATTERNS)}, lambda x: CAST(x AS INTEGER))))"
_PLACE = "CASE " + " ".join(
    f"WHEN contains(lower(text), {_text(w)}) THEN {{'city': {_text(c)}, 'country': {_text(n)}}}" for w, c, n in V.TEXT_CITIES
) + " END"
cte("text_metrics", ["report_text"], f"""
SELECT doc_id, {WUE} AS wue, {RENEWABLE} AS renewable, {CAPACITY} AS capacity, {RACKS} AS racks, {YEARS} AS years,
  {_PLACE} AS place, 'Company' || (doc_id % 17)::VARCHAR AS company,
  'https://example.com/d/' || doc_id::VARCHAR AS source_url, 'web_page' AS source_type
FROM report_text""")
cte("report_pages", ["report_text"], "SELECT doc_id::VARCHAR AS doc, replace(text, chr(10), chr(12)) AS text FROM report_text")

cte("report_lines", ["report_text"], r"""
SELECT doc_id::VARCHAR AS doc, regexp_replace(regexp_replace(text, '([.]) ', '\1' || chr(10), 'g'), '(\n[^\n]*\n[^\n]*)\n', '\1' || chr(12), 'g') AS text FROM report_text""")

cte("pages_ext", [], """
SELECT page_id, url, html || '<section class="facts"><p>The data center achieved a PUE of 1.' || (page_id % 90 + 10)::VARCHAR ||
  ' in 2025.</p></section><table><tr></tr><tr><th>Site</th><th>PUE</th></tr><tr><td>S' || page_id::VARCHAR ||
  '</td><td><b>1.</b>' || (page_id % 90 + 10)::VARCHAR || '</td></tr></table><table><tr><td>only</td></tr></table>' ||
  '<a href="/reports/' || page_id::VARCHAR || '.PDF">r</a><a href="https://example.com/x.pdf">x</a>' ||
  '<a class="k" href="rel.pdf">y</a><a href="../up/z.pdf">z</a><script>var s = "PUE of 9.99";</script>' AS html
FROM pages""")
cte("search_hits", [], f"""
SELECT s_name AS company, CAST(l_linenumber % 3 AS INTEGER) AS query_no,
  CAST((l_orderkey + l_partkey) % 97 + 1 AS INTEGER) AS pos, {_ID} AS hit_id,
  'https://' || CASE WHEN l_partkey % 3 = 0 THEN lower(s_name) ELSE 'other' END || '.example.com/' ||
    (l_partkey % 5)::VARCHAR || CASE WHEN l_partkey % 9 = 0 THEN '.pdf' ELSE '' END AS url
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
cte("source_candidates", [], f"""
SELECT {_ID} AS id, s_name AS company, CAST({_STAGE} AS INTEGER) AS stage,
  CAST(CASE WHEN ({_STAGE}) = 1 THEN l_partkey % 5 ELSE 0 END AS INTEGER) AS hit
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
