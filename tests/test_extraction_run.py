"""The extraction run on a small web: who is asked where, and what is kept."""

import collections

import pytest

from gridsight import schemas
from gridsight.plans.extraction_run import extraction_run

AS_OF = "2025-06-30"
FACT = "The data center achieved a PUE of 1.{} in 2024."
HITS = "company string, query_no int, pos int, hit_id string, url string"


@pytest.fixture(scope="module")
def web(spark):
    facility = [("F", "Bombay", None, 10, None, "specification")]
    registry = spark.createDataFrame([
        ("page", "T1", "R1", ["http://a/1", "http://a/1"], None),          # the same page twice: its records twice
        ("report", "T2", "R2", ["http://a/r.PDF?x"], None),
        ("links", "T3", "R3", ["http://a/2", "http://gone/9"], None),
        ("search", "T4", "R4", ["http://a/3"], facility),
        ("known", "T5", "R5", ["http://a/3"], facility),
        ("other", "T6", "R6", ["http://a/4"], None),
        ("none", "T7", "R7", None, None),
    ], schemas.COMPANY_REGISTRY)
    anchors = "".join(f'<a href="{h}">x</a>' for h in ("d/one.pdf", "/two.pdf", "http://b/three.pdf", "four.pdf"))
    pages = spark.createDataFrame([
        (1, "http://a/1", f"<p>{FACT.format(11)}</p><p>Renewable 65% renewable energy</p>"),
        (2, "http://a/2", "<p>words</p>" + anchors),
        (3, "http://a/3", "<p>nothing</p><script>PUE of 1.99</script>"),
        (4, "http://a/4", "<p>65% renewable energy</p>"),
        (5, "http://s/5", "<p>nothing here</p>"),
        (6, "http://s/6", f"<p>{FACT.format(16)} Design PUE is 1.30 while operating PUE is 1.45.</p>"),
        (7, "http://s/7", f"<p>{FACT.format(17)}</p>"),
        (8, "http://s/7", f"<p>{FACT.format(18)}</p>"),  # an address twice: the first page counts
    ], "page_id int, url string, html string")
    reports = spark.createDataFrame([(u, FACT.format(n)) for u, n in (("http://a/r.PDF?x", 21), ("http://a/d/one.pdf", 22), ("http://a/two.pdf", 23), ("http://b/three.pdf", 24), ("http://a/four.pdf", 25))], "url string, text string")
    hits = spark.createDataFrame(
        [("search", 0, 1, "1", "http://s/5"), ("search", 0, 2, "2", "http://s/x.pdf"), ("search", 1, 1, "3", "http://s/6"), ("search", 1, 2, "4", "http://s/7"),
         ("page", 0, 1, "5", "http://s/6")]
        + [("other", 0, i, f"o{i}", f"http://n/{i}") for i in range(1, 6)] + [("other", 1, 1, "o6", "http://s/6")], HITS)
    return registry, pages, reports, hits


def run(web, variant, tmp_path):
    records, summary = extraction_run(*web, AS_OF, variant, str(tmp_path))
    rows = records.collect()
    return collections.Counter((r.company, r.source_type, None if r.pue_value is None else float(r.pue_value), r.tier, r.region) for r in rows), summary.first().asDict(), rows


def test_global(web, tmp_path):
    got, summary, _ = run(web, "global", tmp_path)
    assert set(got) == {
        ("page", "web_page", 1.11, "T1", "R1"), ("report", "sustainability_report", 1.21, "T2", "R2"),
        *[("links", "sustainability_report", v, "T3", "R3") for v in (1.22, 1.23, 1.24)], ("other", "web_page", None, "T6", "R6")}
    n = got["report", "sustainability_report", 1.21, "T2", "R2"]  # as many as patterns find in the sentence
    assert got["page", "web_page", 1.11, "T1", "R1"] == 2 * n and got["other", "web_page", None, "T6", "R6"] == 1
    assert summary == {"companies_processed": 7, "records_extracted": 6 * n + 1, "companies_with_data": 4, "records_with_pue": 6 * n}


def test_colocation_follows_two_links_and_searches(web, tmp_path):
    got, summary, _ = run(web, "colocation", tmp_path)
    assert {k[:3] for k in got} == {("page", "web_page", 1.11), ("report", "sustainability_report", 1.21), ("links", "sustainability_report", 1.22), ("links", "sustainability_report", 1.23),
                                    ("search", "search_result", 1.16), ("search", "search_result", 1.3), ("search", "search_result", 1.45)}
    assert summary["companies_processed"] == 7 and summary["companies_with_data"] == 4


def test_india_reads_pages_searches_and_falls_back(web, tmp_path):
    got, _, rows = run(web, "india", tmp_path)
    assert {k[:2] for k in got} == {("page", "official_page"), ("search", "search_result"), ("known", "estimated")}
    known = next(r for r in rows if r.company == "known")
    assert (known.city, known.country, known.country_code, known.year, known.tier) == ("Mumbai", "India", "IN", 2025, "T5")
    assert {r.country for r in rows} == {"India"}


def test_nothing_gives_nothing(web, tmp_path):
    registry, pages, reports, hits = (t.limit(0) for t in web)
    for variant in ("global", "india", "colocation"):
        records, summary = extraction_run(registry, pages, reports, hits, AS_OF, variant, str(tmp_path / variant))
        assert records.count() == 0 and tuple(summary.first()) == (0, 0, 0, 0)


def test_a_page_is_parsed_once_for_all_its_companies(web, tmp_path, spark):
    _, pages, reports, hits = web
    registry = spark.createDataFrame([(f"c{i}", "T", "R", ["http://a/1"], None) for i in range(300)], schemas.COMPANY_REGISTRY)
    records, _ = extraction_run(registry, pages, reports, hits, AS_OF, "global", str(tmp_path))
    assert records.select("company").distinct().count() == 300 and spark.read.parquet(str(tmp_path / "pages")).count() == 1
