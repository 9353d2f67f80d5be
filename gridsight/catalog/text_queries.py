"""Text and page extraction."""

from pyspark.sql import functions as F

from gridsight import fixed_values as V
from gridsight.catalog import fixtures as X
from gridsight.catalog.base import query
from gridsight.catalog.oracle_sql import hits, with_ctes
from gridsight.functions.text import clean_text
from gridsight.operators import html, links, mentions, records, search
from gridsight.operators.location import place_in_text


def _unnested(column: str, value: str) -> str:
    return with_ctes(
        f"SELECT doc_id, (i - 1)::INTEGER AS hit_no, {column}[i] AS {value} FROM text_metrics, unnest(range(1, len({column}) + 1)) AS u(i)",
        "text_metrics",
    )


def _exploded(spark, sf, extract, value):
    """Outer explode and filter, so that the patterns run once."""
    found = X.report_text(spark, sf).select("doc_id", F.posexplode_outer(extract("text")).alias("hit_no", value))
    return found.filter(F.col("hit_no").isNotNull())


@query("txt01_pue_mentions", with_ctes(
    "SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pattern_no, hit_no) - 1)::INTEGER AS mention_no, value, year FROM mentions",
    "mentions"))
def _(spark, sf):
    found = _exploded(spark, sf, mentions.pue_mentions, "m")
    return found.select("doc_id", F.col("hit_no").alias("mention_no"), "m.value", "m.year")


@query("txt02_mention_context", with_ctes(
    "SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pattern_no, hit_no) - 1)::INTEGER AS mention_no, context FROM mentions",
    "mentions"))
def _(spark, sf):
    found = _exploded(spark, sf, mentions.pue_mentions, "m")
    return found.select("doc_id", F.col("hit_no").alias("mention_no"), "m.context")


@query("txt03_mention_type", with_ctes("SELECT type, value, count(*) AS mentions FROM mentions GROUP BY ALL", "mentions"))
def _(spark, sf):
    found = _exploded(spark, sf, mentions.pue_mentions, "m")
    return found.groupBy("m.type", "m.value").agg(F.count(F.lit(1)).alias("mentions"))


for _name, _column, _value, _extract in (
    ("txt04_wue_values", "wue", "wue", mentions.wue_values),
    ("txt05_renewable_values", "renewable", "pct", mentions.renewable_values),
    ("txt06_capacity_values", "capacity", "mw", mentions.capacity_values),
    ("txt07_rack_values", "racks", "racks", mentions.rack_values),
    ("txt08_years", "years", "year", mentions.years),
):
    query(_name, _unnested(_column, _value))(
        lambda spark, sf, e=_extract, v=_value: _exploded(spark, sf, e, v)
    )


_PLACE, _PAIR = ("'(?i)" + p + "'" for p in V.LOCATION_PATTERNS)


@query("txt09_location_phrases", with_ctes(f"""
SELECT doc_id, first, second, count(*) AS mentions FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, {_PLACE}, 1)) AS first, CAST(NULL AS VARCHAR) AS second FROM report_text UNION ALL
  SELECT doc_id, regexp_extract(h, {_PAIR}, 1), regexp_extract(h, {_PAIR}, 2)
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, {_PAIR}, 0)) AS h FROM report_text)) GROUP BY ALL""", "report_text"))
def _(spark, sf):
    found = _exploded(spark, sf, mentions.location_phrases, "p").select("doc_id", "p.first", "p.second")
    return found.groupBy("doc_id", "first", "second").agg(F.count(F.lit(1)).alias("mentions"))


@query("txt10_place_in_text", with_ctes("SELECT doc_id, place.city AS city, place.country AS country FROM text_metrics", "text_metrics"))
def _(spark, sf):
    found = X.report_text(spark, sf).select("doc_id", place_in_text(F.col("text")).alias("p"))
    return found.select("doc_id", "p.city", "p.country")


_RECORDS = """
SELECT t.doc_id, company, source_url, source_type, coalesce(nullif(m.year, 0), years[1], 2025) AS year,
  m.value::DECIMAL(5,3)::DOUBLE AS pue_value, m.type AS pue_type, capacity[1]::DECIMAL(10,2)::DOUBLE AS capacity_mw,
  racks[1] AS rack_count, renewable[1] AS renewable_pct, wue[1]::DECIMAL(10,3)::DOUBLE AS wue_l_per_kwh
FROM text_metrics t {join} mentions m ON t.doc_id = m.doc_id {where}"""
_COLUMNS = [
    "doc_id", "company", "source_url", "source_type", "year", "pue_value", "pue_type", "capacity_mw", "rack_count",
    "renewable_pct", "wue_l_per_kwh",
]


@query("txt11_record_assembly", with_ctes(_RECORDS.format(join="JOIN", where=""), "text_metrics", "mentions"))
def _(spark, sf):
    return records.assemble_records(X.sourced_text(spark, sf), X.AS_OF, "colocation").select(*_COLUMNS)


@query("txt12_metric_only_records", with_ctes(
    _RECORDS.format(join="LEFT JOIN", where="WHERE m.doc_id IS NOT NULL OR len(renewable) > 0 OR len(wue) > 0 OR len(capacity) > 0"),
    "text_metrics", "mentions"))
def _(spark, sf):
    return records.assemble_records(X.sourced_text(spark, sf), X.AS_OF, "global").select(*_COLUMNS)


@query("txt13_india_records", with_ctes("""
SELECT t.doc_id, m.value::DECIMAL(5,3)::DOUBLE AS pue_value, place.city AS city, coalesce(place.country, 'India') AS country,
  'India' AS region, d_temp::DOUBLE AS avg_temp_celsius, CASE WHEN place IS NOT NULL THEN k_code END AS country_code
FROM text_metrics t JOIN mentions m ON t.doc_id = m.doc_id LEFT JOIN city_dim ON place.city = d_city LEFT JOIN codes ON place.country = k_country""",
    "text_metrics", "mentions", "city_dim", "codes"))
def _(spark, sf):
    found = records.assemble_records(X.sourced_text(spark, sf), X.AS_OF, "india")
    return found.select("doc_id", "pue_value", "city", "country", "region", "avg_temp_celsius", "country_code")


@query("txt14_stamp_company", with_ctes(
    "SELECT id, company, r.tier, r.region FROM raw_pue p LEFT JOIN registry r ON p.company = r.name", "raw_pue", "registry"))
def _(spark, sf):
    return records.stamp_company(X.raw_pue(spark, sf), X.registry(spark, sf)).select("id", "company", "tier", "region")


# What is left of a page without hidden parts, split at its tags.  Enough for these pages, whose
# attributes hold no ">" and whose entities are these four.
def visible_text(html: str) -> str:
    return f"""array_to_string(
list_filter(list_transform(string_split_regex(regexp_replace({html}, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '<x>', 'g'), '<[^>]*>'),
  lambda x: trim(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), chr(10) || chr(13) || chr(9) || ' ')), lambda x: x <> ''), ' ')"""


_VISIBLE = f"SELECT page_id, {visible_text('html')} AS full_text FROM pages_ext"


@query("txt15_html_text", with_ctes(_VISIBLE, "pages_ext"))
def _(spark, sf):
    return html.page_text(X.pages_ext(spark, sf))


@query("txt15_html_selected_text", with_ctes(
    "SELECT page_id, 'The data center achieved a PUE of 1.' || (page_id % 90 + 10)::VARCHAR || ' in 2025.' AS selected_text FROM pages_ext",
    "pages_ext"))
def _(spark, sf):
    return html.selected_text(X.pages_ext(spark, sf), ".facts")


_HREF = """'(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*"([^"]*)"'"""
_SHOWN = "regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"


@query("txt16_links", with_ctes(f"""
SELECT page_id, (i - 1)::INTEGER AS link_no, replace(l[i], '&amp;', '&') AS link FROM (
  SELECT page_id, regexp_extract_all({_SHOWN}, {_HREF}, 1) AS l FROM pages_ext), unnest(range(1, len(l) + 1)) AS u(i)""", "pages_ext"))
def _(spark, sf):
    return X.pages_ext(spark, sf).select("page_id", F.posexplode(links.links(F.col("html"))).alias("link_no", "link"))


@query("txt17_pdf_links", with_ctes(f"""
SELECT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all({_SHOWN}, {_HREF}, 1)) AS link FROM pages_ext)
WHERE regexp_matches(link, '(?i)\\.pdf$')""", "pages_ext"))
def _(spark, sf):
    return X.pages_ext(spark, sf).select("page_id", F.explode(links.pdf_links(F.col("html"))).alias("link"))


@query("txt18_first_absolute_links", with_ctes("""
SELECT page_id, 0 AS link_no, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/reports/' || page_id::VARCHAR || '.PDF' AS link FROM pages_ext UNION ALL
SELECT page_id, 1, 'https://example.com/x.pdf' FROM pages_ext UNION ALL
SELECT page_id, 2, regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'rel.pdf' FROM pages_ext""", "pages_ext"))
def _(spark, sf):
    first = links.first_links(F.col("html"), F.col("url"), 3)
    return X.pages_ext(spark, sf).select("page_id", F.posexplode(first).alias("link_no", "link"))


@query("txt19_table_cells", with_ctes("""
SELECT page_id, t AS table_no, r AS row_no, c AS col_no, CASE
  WHEN t = 1 THEN 'only' WHEN r = 0 AND c = 0 THEN 'Site' WHEN r = 0 THEN 'PUE'
  WHEN c = 0 THEN 'S' || page_id::VARCHAR ELSE '1.' || (page_id % 90 + 10)::VARCHAR END AS text
FROM pages_ext, (VALUES (0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 0)) AS v(t, r, c)""", "pages_ext"))
def _(spark, sf):
    return html.table_cells(X.pages_ext(spark, sf))


_FACTS = "'The data center achieved a PUE of 1.' || (page_id % 90 + 10)::VARCHAR || ' in 2025.'"


@query("txt20_keyword_sections", with_ctes(f"""
SELECT page_id, 0 AS section_no, 'section' AS tag, {_FACTS} AS text, '<section class="facts"><p>' || {_FACTS} || '</p></section>' AS html FROM pages_ext UNION ALL
SELECT page_id, 1, 'p', {_FACTS}, '<p>' || {_FACTS} || '</p>' FROM pages_ext""", "pages_ext"))
def _(spark, sf):
    return html.keyword_sections(X.pages_ext(spark, sf))


@query("txt21_clean_text", with_ctes(
    "SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '[^\\p{L}\\p{M}\\p{N}_\\s.,;:!?%\\-()]', '', 'g')) AS text FROM report_text",
    "report_text"))
def _(spark, sf):
    return X.report_text(spark, sf).select("doc_id", clean_text(F.col("text")).alias("text"))


@query("txt22_page_bundle", with_ctes(
    f"SELECT page_id, length(full_text)::INTEGER AS text_chars, 2 AS sections, 2 AS tables, 4 AS pdf_links FROM ({_VISIBLE})", "pages_ext"))
def _(spark, sf):
    found = html.page_bundle(X.pages_ext(spark, sf))
    return found.select(
        "page_id", F.length("full_text").alias("text_chars"), F.size("sections").alias("sections"),
        F.size("tables").alias("tables"), F.size("pdf_links").alias("pdf_links"),
    )


@query("txt23_search_pages", with_ctes("""
SELECT doc, page_num::INTEGER AS page_num, i::INTEGER AS line_num, trim(l[i], chr(13) || chr(9) || ' ') AS line,
  trim(array_to_string(l[greatest(i - 2, 1):i + 2], chr(10)), chr(10) || chr(13) || chr(9) || ' ') AS context
FROM (SELECT doc, j AS page_num, string_split(p[j], chr(10)) AS l FROM (SELECT doc, string_split(text, chr(12)) AS p FROM report_lines), unnest(range(1, len(p) + 1)) AS v(j)),
  unnest(range(1, len(l) + 1)) AS u(i)
WHERE contains(lower(l[i]), 'pue')""", "report_lines"))
def _(spark, sf):
    return search.search_pages(search.split_pages(X.report_lines(spark, sf), "doc", "text"), "PUE")


@query("txt24_join_pages", with_ctes("SELECT doc_id::VARCHAR AS doc, text FROM report_text", "report_text"))
def _(spark, sf):
    return search.join_pages(search.split_pages(X.report_pages(spark, sf), "doc", "text"))


@query("txt25_search_phrases", with_ctes(" UNION ALL ".join(
    f"SELECT name AS company, {i} AS query_no, replace('{t}', '{{company}}', name) AS query FROM registry"
    for i, t in enumerate(V.SEARCH_TEMPLATES.values())), "registry"))
def _(spark, sf):
    return search.search_phrases(X.registry(spark, sf), list(V.SEARCH_TEMPLATES.values()), "name")


@query("txt25_task_phrases", with_ctes(" UNION ALL ".join(
    f"SELECT name AS company, {i} AS query_no, replace('{t}', '{{company}}', name) AS query FROM registry"
    for i, t in enumerate(V.PUE_SEARCHES + V.REPORT_SEARCHES)), "registry"))
def _(spark, sf):
    return search.search_phrases(X.registry(spark, sf), V.PUE_SEARCHES + V.REPORT_SEARCHES, "name")


@query("txt26_unique_hits", with_ctes("""
SELECT hit_id, company, query_no, pos, url FROM (
  SELECT *, row_number() OVER (PARTITION BY company, url ORDER BY query_no, pos, hit_id) AS u FROM (
    SELECT *, row_number() OVER (PARTITION BY company, query_no ORDER BY pos, hit_id) AS n FROM search_hits) WHERE n <= 5) WHERE u = 1""",
    "search_hits"))
def _(spark, sf):
    return search.unique_hits(X.search_hits(spark, sf)).select("hit_id", "company", "query_no", "pos", "url")


@query("txt27_source_fallback", with_ctes("""
SELECT id, company, stage, hit FROM (
  SELECT *, dense_rank() OVER (PARTITION BY company ORDER BY stage, hit) AS r FROM source_candidates) WHERE r = 1""", "source_candidates"))
def _(spark, sf):
    return records.first_source_with_data(X.source_candidates(spark, sf)).select("id", "company", "stage", "hit")


@query("txt28_extraction_summary", with_ctes(
    "SELECT (SELECT count(*) FROM registry) AS companies_processed, count(*) AS records_extracted, count(DISTINCT company) AS companies_with_data, count(pue_value) AS records_with_pue FROM raw_pue",
    "raw_pue", "registry"))
def _(spark, sf):
    return records.extraction_summary(X.raw_pue(spark, sf), X.registry(spark, sf))
