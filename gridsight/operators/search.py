"""Searching pages of text, and handling the hits of a web search."""

from pyspark.sql import Column, DataFrame, functions as F

from gridsight.functions.binding import let
from gridsight.functions.text import contains_blank_free, strip
from gridsight.operators.dedup import first_n_per_key, first_per_key


def split_pages(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Whole documents to (doc, page_num from 1, text); pages end with a form feed."""
    return docs.select(
        F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), "\f", -1)).alias("_p", "text")
    ).select("doc", (F.col("_p") + 1).alias("page_num"), "text")


def join_pages(pages: DataFrame) -> DataFrame:
    """Text of a document: its pages in order, one per line break.

    The result is one text cell per document, so that cell's limit also bounds the group.
    """
    ordered = F.sort_array(F.collect_list(F.struct("page_num", "text")))
    return pages.groupBy("doc").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text")
    )


def search_pages(pages: DataFrame, term: str, around: int = 2) -> DataFrame:
    """Lines with the term, each with ``around`` lines of context on both sides."""
    word = F.lower(F.lit(term))

    def hits(lines: Column) -> Column:
        numbered = F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("line")))
        matching = F.filter(numbered, lambda x: F.contains(F.lower(x["line"]), word))

        def with_context(x: Column) -> Column:
            start = F.greatest(x["i"] - around, F.lit(0))
            near = F.slice(lines, start + 1, x["i"] + around + 1 - start)
            return F.struct(
                (x["i"] + 1).alias("line_num"),
                strip(x["line"]).alias("line"),
                strip(F.array_join(near, "\n")).alias("context"),
            )

        return F.transform(matching, with_context)

    found = pages.filter(F.contains(F.lower("text"), word))
    return found.select(
        "doc", "page_num", F.inline(let(F.split("text", "\n", -1), hits))
    )


def search_phrases(companies: DataFrame, templates: list[str], name: str = "company") -> DataFrame:
    """Every template filled in for every company; the short template list is exploded."""
    return companies.select(
        F.col(name).alias("company"), F.posexplode(F.array(*[F.lit(t) for t in templates])).alias("query_no", "_t")
    ).select("company", "query_no", F.replace("_t", F.lit("{company}"), F.col("company")).alias("query"))


def unique_hits(hits: DataFrame, per_query: int = 5) -> DataFrame:
    """First ``per_query`` hits of every query, then the first hit of every url."""
    order = [F.col("pos"), F.col("hit_id")]
    top = first_n_per_key(hits, ["company", "query_no"], order, per_query, "_n").drop("_n")
    return first_per_key(top, ["company", "url"], [F.col("query_no"), *order])


def official_hits(hits: DataFrame) -> DataFrame:
    """Hits whose address contains the company name written without blanks."""
    return hits.filter(contains_blank_free(F.col("url"), F.col("company")))


def first_hits(hits: DataFrame, n: int = 5, per_query: int = 5) -> DataFrame:
    """The first ``n`` different addresses of every company with their place (``hit_no`` from 1);
    report files among them are left out and not replaced."""
    order = [F.col("query_no"), F.col("pos"), F.col("hit_id")]
    top = first_n_per_key(unique_hits(hits, per_query), ["company"], order, n, "hit_no")
    return top.filter(~F.col("url").endswith(".pdf"))


def official_results(hits: DataFrame, per_query: int = 5) -> DataFrame:
    """The first hits of every query at the company's own address, each address once: the filter
    comes before the choice of one hit per address."""
    order = [F.col("pos"), F.col("hit_id")]
    top = first_n_per_key(hits, ["company", "query_no"], order, per_query, "_n").drop("_n")
    return first_per_key(official_hits(top), ["company", "url"], [F.col("query_no"), *order])
