"""Inputs derived from the given tables: metric records, report texts, pages, search hits.

The given tables have no facility figures, so these are computed from their keys, over all rows.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsight.catalog.base import scratch
from gridsight.operators.location import enrich_location
from gridsight.operators.star import absent_keys, company_candidates, fact_rows, location_candidates, lookup_hot_keys
from gridsight.plans.cleaning_run import clean
from gridsight.plans.marts import staging
from gridsight.plans.views import fact_hot_keys
from gridsight.session import short_shuffles

AS_OF = "2025-06-30"
AS_OF_YEAR = 2025


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as it is scanned.  ``spark.gridsight.inputPartitions`` deals it out to so many
    partitions: for small files that cannot be split; a large table does without."""
    rows, parts = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), spark.conf.get("spark.gridsight.inputPartitions", None)
    return rows.repartition(int(parts)) if parts else rows


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_pue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric record per order line."""
    lines, suppliers = table(spark, sf_dir, "lineitem"), dimension(spark, sf_dir, "supplier")
    return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]).selectExpr(
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string)) as id",
        "s_name as company",
        "case when l_partkey % 10 = 0 then null else concat('DC', cast(l_partkey % 4 as string)) end as facility_name",
        """case l_partkey % 16 when 0 then 'bombay' when 1 then ' Navi Mumbai ' when 2 then 'bengaluru'
           when 3 then 'noida/greater noida' when 4 then 'CHENNAI' when 5 then 'Virginia' when 6 then 'oregon'
           when 7 then 'Frankfurt' when 8 then 'tokyo' when 9 then 'Singapore' when 10 then 'Texas'
           when 11 then 'Gurgaon' when 12 then 'Atlantis' when 13 then '' when 14 then null else 'London' end as city""",
        "case when l_linenumber = 1 then 'India' else null end as country",
        "cast(null as string) as region",
        "case when l_orderkey % 13 = 0 then null else cast(year(l_shipdate) + 23 as int) end as year",
        """case when (l_orderkey + l_linenumber) % 11 = 0 then null
           else cast(((l_partkey*31 + l_orderkey*7 + l_linenumber) % 2300 + 950) * 0.001 as decimal(5,3)) end as pue_value""",
        """case l_orderkey % 7 when 0 then 'TTM' when 1 then 'operating' when 2 then 'annual' when 3 then 'measured'
           when 4 then 'design' when 5 then 'estimated' else null end as pue_type""",
        "case when l_partkey % 5 = 0 then null else cast(l_quantity as decimal(10,2)) end as capacity_mw",
        "case when l_partkey % 6 = 0 then null else cast(l_quantity as int) * 100 end as rack_count",
        "case when l_partkey % 4 = 0 then null else cast((l_partkey*13 + l_linenumber) % 103 as int) end as renewable_pct",
        "case when l_linenumber = 3 then null else cast(((l_suppkey*17 + l_partkey) % 1020) * 0.01 as decimal(10,3)) end as wue_l_per_kwh",
        "concat('https://example.com/', cast(l_suppkey as string), '/', cast(l_partkey as string)) as source_url",
        """case l_partkey % 7 when 0 then 'sustainability_report' when 1 then 'esg_report' when 2 then 'specification'
           when 3 then 'press_release' when 4 then 'web_page' when 5 then 'benchmark' else 'news_article' end as source_type""",
        "cast(l_shipdate as date) as extraction_date",
        """case when l_linenumber = 7 then null when s_suppkey % 3 = 0 then 'Tier 1 - Global Hyperscaler'
           when s_suppkey % 3 = 1 then 'Tier 2 - Indian Operator' else 'Tier 3 - Global Colocation' end as tier""",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies of the records with tier, region, two pages and two facilities."""
    return dimension(spark, sf_dir, "supplier").selectExpr(
        "s_name as name",
        """case s_suppkey % 3 when 0 then 'Tier 1 - Global Hyperscaler' when 1 then 'Tier 2 - Indian Operator'
           else 'Tier 3 - Global Colocation' end as tier""",
        "case when s_suppkey % 3 = 1 then 'India' else 'Global' end as region",
        """array(concat('https://example.com/', cast(s_suppkey as string), '/report.PDF'),
                 concat('https://example.com/', cast(s_suppkey as string), '/about')) as urls""",
        """case when s_suppkey % 3 = 1 then array(
             named_struct('facility_name', concat('F', cast(s_suppkey as string), 'a'), 'city', 'navi mumbai',
               'capacity_mw', cast(s_suppkey % 60 + 1 as decimal(10,2)), 'rack_count', cast(s_suppkey % 70 as int) * 100,
               'pue_design', cast((s_suppkey % 40 + 130) * 0.01 as decimal(5,3)), 'source_type', 'specification'),
             named_struct('facility_name', concat('F', cast(s_suppkey as string), 'b'), 'city', 'Bombay',
               'capacity_mw', cast(s_suppkey % 30 + 2 as decimal(10,2)), 'rack_count', cast(s_suppkey % 50 as int) * 100,
               'pue_design', cast((s_suppkey % 30 + 140) * 0.01 as decimal(5,3)), 'source_type', 'press_release')) end as facilities""",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_location(raw_pue(spark, sf_dir))


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table of the warehouse: written once per session, as a load does, and read back.

    Plans over it know its true size, prune its columns and push filters into its scan.
    """
    # a source whose files change gets a new copy
    files = hash(tuple(sorted(dimension(spark, sf_dir, "lineitem").select("l_orderkey").inputFiles())))
    key = (spark.sparkContext.applicationId, sf_dir, f"{name}-{files}")
    if key not in _STORED:
        path = scratch(spark, name)
        rows = build()  # may store others
        with short_shuffles(spark):
            rows.write.option("compression", "zstd").parquet(path)  # ids of hex digits halve
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def warehouse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table of the warehouse: all enriched records."""
    return stored(spark, sf_dir, "raw_pue_data", lambda: enriched(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(warehouse_rows(spark, sf_dir))


def clean_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_pue(spark, sf_dir), registry(spark, sf_dir), AS_OF_YEAR)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored result of the cleaning run."""
    return stored(spark, sf_dir, "cleaned", lambda: clean_run(spark, sf_dir))


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored company and location tables."""
    return (
        stored(spark, sf_dir, "dim_company", lambda: company_candidates(warehouse_rows(spark, sf_dir))),
        stored(spark, sf_dir, "dim_location", lambda: location_candidates(warehouse_rows(spark, sf_dir))),
    )


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts computed against the stored dimensions."""
    rows = warehouse_rows(spark, sf_dir)
    hot = stored(spark, sf_dir, "raw_hot_keys", lambda: lookup_hot_keys(rows))
    absent = stored(spark, sf_dir, "raw_absent_keys", lambda: absent_keys(rows, *dimensions(spark, sf_dir)))
    return fact_rows(rows, *dimensions(spark, sf_dir), hot=hot, absent=absent)[0]


def star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored fact, company and location tables."""
    return stored(spark, sf_dir, "fact_efficiency", lambda: fact_load(spark, sf_dir)), *dimensions(spark, sf_dir)


def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts' frequent keys, kept beside the facts."""
    return stored(spark, sf_dir, "fact_hot_keys", lambda: fact_hot_keys(star(spark, sf_dir)[0]))


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one sentence about a facility at the end."""
    n = "cast(doc_id % 90 + 10 as string)"
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        f"""concat(text, ' ', case doc_id % 10
          when 0 then concat('The data center achieved a PUE of 1.', {n}, ' in 2025.')
          when 1 then concat('Rolling average PUE reached 1.', {n}, ' with 65% renewable energy.')
          when 2 then concat('Designed with a PUE of 1.', {n}, '. Capacity of ', cast(doc_id % 600 as string), ' MW.')
          when 3 then concat('In 2024, the PUE was 1.', {n}, ' near Mumbai.')
          when 4 then 'Design PUE is 1.30 while operating PUE is 1.45.'
          when 5 then concat('Water Usage Effectiveness is 0.', {n}, ' L/kWh.')
          when 6 then concat('It hosts ', cast(doc_id % 60 + 1 as string), ',000 server racks. Powered by 100% renewable energy.')
          when 7 then 'The PUE is 0.5 in Tokyo.'
          when 8 then concat(cast(doc_id % 40 as string), ' megawatts facility in Frankfurt; 90% carbon-free energy in 2023 and 2024.')
          else 'No sustainability information.' end) as text""",
    )


def sourced_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report texts with the company and address they come from."""
    return report_text(spark, sf_dir).selectExpr(
        "doc_id",
        "concat('Company', cast(doc_id % 17 as string)) as company",
        "concat('https://example.com/d/', cast(doc_id as string)) as source_url",
        "'web_page' as source_type",
        "text",
    )


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report texts whose line breaks are page breaks."""
    return report_text(spark, sf_dir).selectExpr("cast(doc_id as string) as doc", "translate(text, '\n', '\f') as text")


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report texts with a page break at every third sentence end and a line break at the others."""
    lines = F.regexp_replace("text", "([.]) ", "$1\n")
    return report_text(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), F.regexp_replace(lines, "(\n[^\n]*\n[^\n]*)\n", "$1\f").alias("text"))


def pages_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a section, two tables, report links and a script at the end."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "url",
        """concat(html, '<section class="facts"><p>The data center achieved a PUE of 1.', cast(page_id % 90 + 10 as string),
             ' in 2025.</p></section><table><tr></tr><tr><th>Site</th><th>PUE</th></tr><tr><td>S', cast(page_id as string),
             '</td><td><b>1.</b>', cast(page_id % 90 + 10 as string), '</td></tr></table><table><tr><td>only</td></tr></table>',
             '<a href="/reports/', cast(page_id as string), '.PDF">r</a><a href="https://example.com/x.pdf">x</a>',
             '<a class="k" href="rel.pdf">y</a><a href="../up/z.pdf">z</a><script>var s = "PUE of 9.99";</script>') as html""",
    )


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web search hits per company, three queries each."""
    lines, suppliers = table(spark, sf_dir, "lineitem"), dimension(spark, sf_dir, "supplier")
    return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]).selectExpr(
        "s_name as company",
        "cast(l_linenumber % 3 as int) as query_no",
        "cast((l_orderkey + l_partkey) % 97 + 1 as int) as pos",
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string)) as hit_id",
        """concat('https://', case when l_partkey % 3 = 0 then lower(s_name) else 'other' end, '.example.com/',
             cast(l_partkey % 5 as string), case when l_partkey % 9 = 0 then '.pdf' else '' end) as url""",
    )


def source_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the stage (own pages, search, known facility) and search hit they came from."""
    lines, suppliers = table(spark, sf_dir, "lineitem"), dimension(spark, sf_dir, "supplier")
    return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]).selectExpr(
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string)) as id",
        "s_name as company",
        "cast(case s_suppkey % 3 when 0 then l_linenumber % 3 when 1 then 1 + l_linenumber % 2 else 2 end as int) as stage",
        """cast(case when (case s_suppkey % 3 when 0 then l_linenumber % 3 when 1 then 1 + l_linenumber % 2 else 2 end) = 1
             then l_partkey % 5 else 0 end as int) as hit""",
    )


# -- a whole extraction: four pages and sixteen reports per company ("Site" and a number k)

_TIER_OF = "case k % 3 when 0 then 'Tier 1 - Global Hyperscaler' when 1 then 'Tier 2 - Indian Operator' else 'Tier 3 - Global Colocation' end"


def run_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with figures, or with links to reports that have them, or with neither, by company."""
    sentence = "concat('<p>The data center achieved a PUE of 1.', cast(page_id % 90 + 10 as string), ' in 2025 near Mumbai.</p>')"
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "url",
        f"""concat(html, case
             when k % 5 = 0 and page_id % 4 = 0 then {sentence}
             when k % 5 = 2 and page_id % 4 = 3 then {sentence}
             when k % 5 = 4 and page_id % 4 >= 2 then {sentence}
             when k % 5 = 4 and page_id % 4 = 1 then '<p>It runs on 65% renewable energy.</p>' else '<p>Nothing.</p>' end,
           '<a href="/reports/', cast(page_id as string), '.PDF">r</a><a href="https://files.example.org/', cast(page_id as string), '/x.pdf">x</a>',
           '<a href="rel/', cast(page_id as string), '.pdf">y</a><a href="/late/', cast(page_id as string), '.pdf">z</a>') as html""".replace("k % 5", "floor(page_id / 4) % 5"),
    )


def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with two pages and one report; every third one has two listed facilities."""
    pages = table(spark, sf_dir, "pages").where("page_id % 4 < 2").selectExpr("cast(floor(page_id / 4) as bigint) as k", "page_id % 4 as i", "url")
    urls = pages.groupBy("k").pivot("i", [0, 1]).agg(F.first("url")).withColumnsRenamed({"0": "u0", "1": "u1"})
    return urls.selectExpr(
        "concat('Site', cast(k as string)) as name", f"{_TIER_OF} as tier", "case when k % 3 = 1 then 'India' else 'Global' end as region",
        "filter(array(u0, concat('https://files.example.org/', cast(4 * k as string), '/annual.pdf'), u1), u -> u is not null) as urls",
        """case when k % 3 = 1 then array(
             named_struct('facility_name', 'a', 'city', 'navi mumbai', 'capacity_mw', cast(k % 60 + 1 as decimal(10,2)), 'rack_count', cast(k % 70 as int) * 100,
               'pue_design', cast((k % 40 + 130) * 0.01 as decimal(5,3)), 'source_type', 'specification'),
             named_struct('facility_name', 'b', 'city', 'Bombay', 'capacity_mw', cast(k % 30 + 2 as decimal(10,2)), 'rack_count', cast(k % 50 as int) * 100,
               'pue_design', cast((k % 30 + 140) * 0.01 as decimal(5,3)), 'source_type', 'press_release')) end as facilities""",
    )


def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reports: four per page, at the addresses that the pages link to."""
    pages = dimension(spark, sf_dir, "pages").select("page_id", "url")
    docs = report_text(spark, sf_dir).join(table(spark, sf_dir, "documents").selectExpr("doc_id as d", "text as plain"), F.col("doc_id") == F.col("d"))
    return docs.join(pages, F.expr("page_id = doc_id div 4")).selectExpr(
        "doc_id",
        """case doc_id % 4 when 0 then concat(regexp_extract(url, '^(https?://[^/?#]*)', 1), '/reports/', cast(page_id as string), '.PDF')
           when 1 then concat('https://files.example.org/', cast(page_id as string), '/x.pdf')
           when 2 then concat(regexp_extract(url, '^(https?://[^?#]*/)', 1), 'rel/', cast(page_id as string), '.pdf')
           else case when page_id % 4 = 0 then concat('https://files.example.org/', cast(page_id as string), '/annual.pdf')
             else concat(regexp_extract(url, '^(https?://[^/?#]*)', 1), '/late/', cast(page_id as string), '.pdf') end end as url""",
        "case when floor(page_id / 4) % 5 = 1 then text else plain end as text",
    )


def run_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three results per query: nowhere, a report, and one of two pages; the second page of a
    company with an odd number is the sixth address."""
    pages = table(spark, sf_dir, "pages").where("page_id % 4 >= 2").selectExpr("cast(floor(page_id / 4) as bigint) as k", "page_id % 4 as i", "url")
    found = pages.selectExpr("k", "case when i = 2 then 0 when k % 2 = 0 then 1 else 2 end as query_no", "3 as pos", "url")
    other = pages.where("i = 2").selectExpr("k", "explode(sequence(0, 2)) as query_no").selectExpr(
        "k", "query_no", "inline(array(struct(1 as pos, concat('https://none.example.org/', cast(k as string), '/', cast(query_no as string)) as url), struct(2 as pos, concat('https://files.example.org/', cast(k as string), '/hit.pdf') as url)))")
    return found.unionByName(other).selectExpr("concat('Site', cast(k as string)) as company", "query_no", "pos", "concat_ws('-', cast(k as string), cast(query_no as string), cast(pos as string)) as hit_id", "url")
