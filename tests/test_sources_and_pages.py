"""Files in and out, page parsing, links."""

import json
import random
import time
from decimal import Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gridsight import schemas
from gridsight.operators import html, links, search
from gridsight.operators.cleaning import normalize_schema
from gridsight.sources import readers, writers


def test_json_arrays_and_other_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"company": "a", "pue_value": 1.2}, {"company": "b", "year": 2024}], indent=2), encoding="utf-8")
    (tmp_path / "b.json").write_text(" [] ")
    (tmp_path / "object.json").write_text('{"company": "c"}')
    (tmp_path / "broken.json").write_text('[{"company": "d", ')
    (tmp_path / "note.txt").write_text('[{"company": "e"}]')
    records, skipped = readers.read_records_json(spark, str(tmp_path))
    # numbers are text until they are checked; the normalized schema has them typed
    assert sorted((r.company, r.pue_value, r.year) for r in records.collect()) == [("a", "1.2", None), ("b", None, "2024")]
    assert sorted((r.company, r.pue_value, r.year) for r in normalize_schema(records).collect()) == [("a", Decimal("1.200"), None), ("b", None, 2024)]
    assert sorted(r.file.rsplit("/", 1)[1] for r in skipped.collect()) == ["broken.json", "object.json"]


def records(spark, n=50):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.lit("c").alias("company"),
        F.when(F.col("id") % 5 > 0, F.lit(2020)).alias("year"), F.lit(Decimal("1.234")).alias("pue_value"),
    )
    return normalize_schema(df, extra=("id",))


def test_json_round_trip_and_summary(spark, tmp_path):
    path, log = str(tmp_path / "out"), str(tmp_path / "log")
    counts = writers.save_records_json(records(spark), path)
    assert counts == {"Records Extracted": 50, "Facilities with PUE": 50}
    assert readers.read_record_lines(spark, path).count() == 50
    for day in ("2025-01-01", "2025-01-02"):
        writers.append_run_summary(spark, log, counts, day)
    assert readers.read_table(spark, log).count() == 4


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "x"', "two\nlines", None)], "a string, b string, c string, d int")
    writers.save_csv(df, str(tmp_path / "csv"))
    assert readers.read_clean_csv(spark, str(tmp_path / "csv"), df.schema).collect() == df.collect()
    with pytest.raises(Exception):
        readers.read_clean_csv(spark, str(tmp_path / "none"), df.schema).count()


def test_append_rejects_only_bad_rows(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    assert writers.append_valid(records(spark), good, bad) == 40
    assert writers.append_valid(records(spark), good, bad) == 40
    assert readers.read_table(spark, good).count() == 80 and readers.read_table(spark, bad).count() == 20


def test_materialize_and_failures(spark, tmp_path):
    writers.materialize(records(spark), "some_view")
    assert spark.table("some_view").count() == 50
    assert writers.materialize(records(spark), "t", str(tmp_path), ("year",)).count() == 50
    writers.store_failures({"null_year": records(spark).filter("year is null")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "dq_failures" / "null_year")).count() == 10


def test_tables_are_dealt_out_only_on_request(spark, sf):
    from gridsight.catalog import fixtures

    assert fixtures.table(spark, sf, "region").rdd.getNumPartitions() == 1
    spark.conf.set("spark.gridsight.inputPartitions", "3")
    try:
        assert fixtures.table(spark, sf, "region").rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.gridsight.inputPartitions")


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><!-- <p>PUE hidden</p> -->
<div id="top" class="a b"><p>PUE <b>1.2</b> is<p>low<ul><li>one<li>two</ul></div>
<table><tr></tr><tr><th>h1</th><td>x <i>y</i></td></tr><tr><td>1<td>2</table><table></table>
<script>var s = "<p>PUE 9.99</p>";</script><section>water &amp; <article>capacity</article></section></body></html>"""


def page(spark, text=PAGE):
    return spark.createDataFrame([(1, "https://e.com/d/p.html", text)], "page_id int, url string, html string")


def test_visible_text(spark):
    assert html.page_text(page(spark)).first().full_text == "T PUE 1.2 is low one two h1 x y 1 2 water & capacity"
    assert html.page_text(page(spark, "")).first().full_text == ""


def test_selector(spark):
    assert html.selected_text(page(spark), ".b").first().selected_text == "PUE1.2islowonetwo"
    assert html.selected_text(page(spark), "#top").first().selected_text == "PUE1.2islowonetwo"
    assert html.selected_text(page(spark), "li").first().selected_text == "one two"


def test_table_cells(spark):
    got = [tuple(r)[1:] for r in html.table_cells(page(spark)).orderBy("table_no", "row_no", "col_no").collect()]
    assert got == [(0, 0, 0, "h1"), (0, 0, 1, "xy"), (0, 1, 0, "1"), (0, 1, 1, "2")]


def test_sections(spark):
    got = [(r.tag, r.text) for r in html.keyword_sections(page(spark)).orderBy("section_no").collect()]
    assert got == [("div", "PUE1.2islowonetwo"), ("p", "PUE1.2is"), ("section", "water &capacity"), ("article", "capacity")]
    assert html.keyword_sections(page(spark), ["low"]).first().html.startswith("<div")
    assert html.page_bundle(page(spark)).first().pdf_links == []


def test_table_functions_in_sql(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (3, PAGE)], "page_id int, html string")
    rows.createOrReplaceTempView("some_pages")
    html.register(spark)
    cells = spark.sql("SELECT page_id, table_no, row_no, col_no, text FROM some_pages, LATERAL page_cells(html)")
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, html.table_cells(rows).collect()))
    assert [r.page_id for r in cells.orderBy("page_id").collect()] == [1] * 4 + [3] * 4
    found = spark.sql("SELECT p.page_id, s.tag FROM some_pages p, LATERAL page_sections(p.html, array('capacity')) s WHERE p.page_id = 1 ORDER BY section_no")
    assert [r.tag for r in found.collect()] == ["section", "article"]
    # the rows leave Python as they are: no nested array is exploded, nothing is shuffled
    plan = html.table_cells(rows)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPythonUDTF" in plan and "Generate" not in plan and "Exchange" not in plan and "Join" not in plan


def test_links_and_joining(spark):
    base = "https://e.com/a/b/p.html?q=1#f"
    hrefs = ["x.pdf", "/r/Y.PDF", "../up/z.pdf", "./s.pdf", "//cdn.e.com/t.pdf", "https://o.org/u.pdf", "v.pdf?x=1"]
    body = "".join(f'<a class="k" href="{h}">l</a>' for h in hrefs) + "<a name='n'>no</a><a href='q.html'>q</a><a href=plain>p</a><!-- <a href='c.pdf'> -->"
    df = page(spark, body).withColumn("base", F.lit(base))
    row = df.select(links.links(F.col("html")).alias("all"), links.pdf_links(F.col("html")).alias("pdf"), links.first_links(F.col("html"), F.col("base"), 9).alias("abs")).first()
    assert row["all"] == hrefs + ["q.html", "plain"]
    assert row["pdf"] == hrefs[:-1]
    assert row["abs"] == [urljoin(base, h) for h in hrefs[:-1]]
    more = ["?z=2", "#top", "a/../b", "mailto:x@y.z", "", "../../../k"]
    df = spark.createDataFrame([(h,) for h in more[:4] + more[5:]], "h string")
    got = [r.r for r in df.select(links.absolute(F.col("h"), F.lit(base)).alias("r")).collect()]
    assert got == [urljoin(base, h) for h in more[:4] + more[5:]]


def test_links_with_odd_attributes(spark):
    body = """<a title="a>b" href="/a&#38;b.pdf">x</a><a href='q?x=1&amp;y=&eacute;'><a data-href=no name=x><A HREF=plain/p.pdf>
    <!-- <a href=c> --><script><a href=s></script><a href><a href="" id=1><a/href="z"><abbr href=no><a href="x" href="y"><a href = " sp.pdf " class='>'>"""
    assert page(spark, body).select(links.links(F.col("html"))).first()[0] == ["/a&b.pdf", "q?x=1&y=é", "plain/p.pdf", "z", "x", "sp.pdf"]


def test_addresses_are_resolved_like_the_standard_library(spark):
    rng, rows = random.Random(1), []
    for _ in range(2000):
        base = rng.choice(["http", "https"]) + "://h.org" + rng.choice(["", "/", "/a", "/a/", "/a/b/c.html", "//x//y", "/a/../b/c"]) + rng.choice(["", "?q=1", "?q=../x"]) + rng.choice(["", "#f"])
        link = rng.choice(["", "", "/", "//o.net/", "./", "../", "../../"]) + rng.choice(["a", "b/c", "..", ".", "a/../b", "a//b", "x.pdf", ""]) + rng.choice(["", "?f=a/../d.pdf", "?z=1"]) + rng.choice(["", "#t/../u"])
        rows.append((base, link))
    df = spark.createDataFrame(rows, "base string, link string")
    got = df.select("base", "link", links.absolute(F.col("link"), F.col("base")).alias("got")).collect()
    assert [r.got for r in got] == [urljoin(r.base, r.link) for r in got]


@pytest.mark.parametrize("body", ["<b>" * 8000 + "x", "<div>x" * 8000, "<td>" * 4000 + "</p>" * 4000, "<ul>" * 4000 + "<li>x" * 4000])
def test_deep_pages_are_parsed_in_linear_time(body):
    start = time.process_time()
    found = html.Page(body)
    found.sections(["pue"])
    assert time.process_time() - start < 0.5  # 4.5 s for half as many in the former version


def test_page_search_and_joining(spark):
    docs = spark.createDataFrame([("d", "a\nb PUE\nc\fe\nf\n\npue g ")], "doc string, text string")
    pages = search.split_pages(docs, "doc", "text")
    got = [(r.page_num, r.line_num, r.line, r.context) for r in search.search_pages(pages, "Pue").orderBy("page_num").collect()]
    assert got == [(1, 2, "b PUE", "a\nb PUE\nc"), (2, 4, "pue g", "f\n\npue g")]
    assert search.join_pages(pages).first().text == "a\nb PUE\nc\ne\nf\n\npue g "


def test_schema_is_fixed(spark):
    df = normalize_schema(spark.createDataFrame([("a", 1)], "company string, other int"))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.RECORD]


def test_record_lines_are_written_compressed(spark, tmp_path):
    from gridsight.sources import readers, writers

    df = spark.range(5000).selectExpr("concat('c', id) as company", "cast(1.5 as decimal(5,3)) as pue_value", "'https://example.com/a' as source_url")
    assert writers.save_records_json(df, str(tmp_path / "r")) == {"Records Extracted": 5000, "Facilities with PUE": 5000}
    files = [p for p in (tmp_path / "r").iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".json.gz") for p in files) and sum(p.stat().st_size for p in files) < 5000 * 30
    assert readers.read_record_lines(spark, str(tmp_path / "r")).select("company").distinct().count() == 5000
