"""From a registry of companies to metric records: pages, the reports they link to, searches, and
listed facilities, each used only for companies that the ones before left without a record.

Addresses are followed by joins.  A page is parsed once and a text is searched for figures once,
however many companies name its address; what was found is one row per text, which is then
looked up by the addresses of the companies.  Every stage is written below ``root``, so the
companies that a later stage asks for are read off a table.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gridsight.operators.dedup import first_per_key
from gridsight.operators.html import parse_pages
from gridsight.operators.joins import salted_join
from gridsight.operators.links import first_links
from gridsight.operators.records import assemble_records, extraction_summary, known_facility_records, route_urls, stamp_company
from gridsight.operators.search import first_hits
from gridsight.sources.writers import materialize


@dataclass(frozen=True)
class Flow:
    """How one kind of companies is looked up."""

    variant: str
    page_type: str = "web_page"
    #: Links to reports that are followed from a page; addresses of reports are read as such.
    follow: int = 0
    reports: bool = False
    search: bool = False
    known: bool = False


FLOWS = {
    "global": Flow("global", follow=3, reports=True),
    "colocation": Flow("colocation", follow=2, reports=True, search=True),
    "india": Flow("india", page_type="official_page", search=True, known=True),
}
#: Search results that are looked at per company.
HITS = 5


def _found(texts: DataFrame, as_of: str, variant: str) -> DataFrame:
    """(kind, url, found): all records of a text as one array, without company and source."""
    rows = assemble_records(texts.select("kind", "url", "text"), as_of, variant)
    fields = [c for c in rows.columns if c not in ("kind", "url")]
    return rows.groupBy("kind", "url").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("found"))


def _pages(pages: DataFrame, wanted: DataFrame, follow: int, key: str) -> DataFrame:
    """kind, url, text and links of the wanted pages; of an address that repeats the first page."""
    known = pages.join(wanted.select("url").distinct(), "url", "left_semi")
    once = first_per_key(known, ["url"], [F.col(key)])
    carry = {"links": first_links(F.col("html"), F.col("url"), follow)} if follow else {"links": F.array().cast("array<string>")}
    return parse_pages(once, key="url", carry=carry).select(F.lit("html").alias("kind"), "url", F.col("full_text").alias("text"), "links")


def _without_record(companies: DataFrame, *stages: DataFrame) -> DataFrame:
    """Companies that no stage has a record of."""
    out = companies
    for stage in stages:
        done = stage.select(F.col("company").alias("_done")).distinct()
        out = out.join(done, F.col("name") == F.col("_done"), "left_anti")
    return out


def _records(edges: DataFrame, found: DataFrame) -> DataFrame:
    """The records of the texts that the addresses (company, kind, url, source_type, place) lead to."""
    hit = salted_join(edges, found, ["kind", "url"], "inner", F.concat_ws("|", "company", "place"))
    return hit.select("company", "place", F.col("url").alias("source_url"), "source_type", "found")


def _opened(hits: DataFrame) -> DataFrame:
    return hits.select("company", "source_url", "source_type", F.inline("found"))


def extraction_run(
    registry: DataFrame, pages: DataFrame, reports: DataFrame, hits: DataFrame, as_of: str, variant: str, root: str, page_key: str = "page_id",
) -> tuple[DataFrame, DataFrame]:
    """Records of all companies of the registry, and the summary of the run.

    * ``registry``: one row per company with name, tier, region, urls and facilities
    * ``pages``: url, html and a key; ``reports``: url and text, one row per url
    * ``hits``: company, query_no, pos, hit_id and url of a web search
    * ``variant``: ``global`` follows three report links of a page; ``colocation`` follows two and
      searches for companies without a record; ``india`` reads pages only, searches, and falls
      back on listed facilities

    A search ends at the first of its results that has records.  Tier and region are those of
    the company.  An address that no page or report has gives nothing.
    """
    flow = FLOWS[variant]
    companies = registry.select("name", "tier", "region", "urls", "facilities")
    edges = companies.select(F.col("name").alias("company"), F.posexplode("urls").alias("place", "url"))
    edges = route_urls(edges) if flow.reports else edges.withColumn("kind", F.lit("html"))
    edges = materialize(edges.withColumn("place", F.format_string("%04d", "place")), "addresses", root)

    parsed = materialize(_pages(pages, edges.where("kind = 'html'"), flow.follow, page_key), "pages", root)
    edges = edges.withColumn("source_type", F.when(F.col("kind") == "pdf", "sustainability_report").otherwise(flow.page_type))
    texts = parsed.select("kind", "url", "text")
    if flow.reports:
        linked = salted_join(edges.where("kind = 'html'"), parsed.select("kind", "url", "links"), ["kind", "url"], "inner", F.concat_ws("|", "company", "place"))
        linked = linked.select("company", "place", F.posexplode("links").alias("link_no", "url")).select(
            "company", F.format_string("%s.%02d", "place", "link_no").alias("place"), "url", F.lit("pdf").alias("kind"), F.lit("sustainability_report").alias("source_type"))
        edges = materialize(edges.unionByName(linked), "all_addresses", root)
        wanted = edges.where("kind = 'pdf'").select("url").distinct()
        texts = texts.unionByName(reports.join(wanted, "url", "left_semi").select(F.lit("pdf").alias("kind"), "url", "text"))
    found = materialize(_found(texts, as_of, flow.variant), "found", root)
    stages = [materialize(_opened(_records(edges, found)), "official", root)]

    if flow.search:
        asked = salted_join(hits, _without_record(companies, *stages).select("name"), {"company": "name"}, "left_semi", "hit_id")
        results = first_hits(asked, HITS).select("company", F.format_string("%02d", "hit_no").alias("place"), "url", F.lit("html").alias("kind"), F.lit("search_result").alias("source_type"))
        results = materialize(results, "results", root)
        # pages that were parsed before are not parsed again
        new = results.select("url").distinct().join(parsed.select("url"), "url", "left_anti")
        more = materialize(_found(_pages(pages, new, 0, page_key), as_of, flow.variant), "found_by_search", root)
        with_records = _records(results, found.where("kind = 'html'").unionByName(more))
        stages.append(materialize(_opened(first_per_key(with_records, ["company"], [F.col("place")])), "searched", root))

    if flow.known:
        listed = known_facility_records(_without_record(companies, *stages), as_of).drop("tier", "region")
        stages.append(materialize(listed, "listed", root))

    records = stages[0]
    for stage in stages[1:]:
        records = records.unionByName(stage, allowMissingColumns=True)
    records = stamp_company(records, companies)
    return records, extraction_summary(records, companies)
