"""Language of web pages by Bayesian evidence fusion.

Four pieces of evidence about the language of a page are multiplied: the likelihood of its text
under byte-run models of the languages, the language that its markup declares, what its address
says (suffix of the host, language segment of the path), and a prior of its host.  The prior is
learned from the pages themselves by grouped sums of their posteriors: a host is smoothed by its
domain, a domain by its suffix, a suffix by all pages, and every page is left out of its own prior.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import salted_join
from .cells import SCHEMA, packed, summed
from .html_text import main_text
from .shared import stored, table
from .toxicity import _cell, _long, _runs, _short, _stream, _within
from .words import blocks

#: Cells per language of the run counts (1 MB each as sent to the tasks).
CELLS = 1 << 19
#: Added to every count.
SMOOTH = 0.1
#: Runs of a text are not independent: their evidence counts as that of a text with so many runs at most.
TEXT_WEIGHT, MOST_RUNS = 0.2, 400
#: How often a declaration, a path segment and a country suffix are right.
DECLARED, PATH, SUFFIX = 0.9, 0.9, 0.8
#: Pages that a level of the host hierarchy weighs against the level below.
STRENGTH = 5.0

# Languages of country suffixes.
SUFFIXES = {"de": "de", "at": "de", "li": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "cl": "es", "co": "es", "pe": "es",
            "uk": "en", "us": "en", "ie": "en", "au": "en", "nz": "en", "it": "it", "nl": "nl", "pt": "pt", "br": "pt", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "se": "sv", "dk": "da", "fi": "fi", "cz": "cs"}
LANG_ATTRIBUTE = r"(?is)^(?:[^<]|<(?!html[\s>]))*+<html\s[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})(?![a-z])"
HOST = r"^(?i)(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
PATH_SEGMENT = r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//[^/?#]+/(?:[^/?#]+/)?([a-z]{2})(?:[-_][a-z]{2})?(?:[/?#]|$)"


def languages(docs: DataFrame, lang: str) -> list[str]:
    """The languages with training text (a handful, whatever the corpus)."""
    return sorted(r[0] for r in docs.where(F.col(lang).isNotNull()).select(lang).distinct().collect())


def run_tables(docs: DataFrame, names: list[str], lang: str = "lang", text: str = "text") -> np.ndarray:
    """log p(run | language) of every cell, from all labelled texts; one row per language."""
    size = len(names) * CELLS
    width = 1 << (size - 1).bit_length()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for rows, data, begin in blocks(batches, "text"):
            stream, _, a, b = _stream(data, begin)
            runs = _runs(stream)
            which = np.repeat(rows.column(1).to_numpy(zero_copy_only=False).astype(np.int64), b - a)
            np.add.at(total, which * CELLS + _cell(runs[_within(a, b, len(runs))], CELLS), 1)
        yield packed(total)

    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(lang)).cast("int") - 1
    rows = docs.where(F.col(lang).isin(names)).select(F.col(text).cast("string").alias("text"), number.alias("which"))
    counts = summed(rows.mapInArrow(count, SCHEMA), width)[:size].reshape(len(names), CELLS) + SMOOTH
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(pages: DataFrame, tables: np.ndarray, names: list[str]) -> DataFrame:
    """The pages without their source, and ``text`` (log-likelihoods, the best one being 0)."""
    kept = pages.sparkSession.sparkContext.broadcast(_short(tables))
    others = [f for f in pages.schema.fields if f.name != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _long(kept.value)
        for batch in batches:
            bodies = pa.array([main_text(x) for x in batch.column(0).to_pylist()], pa.string())
            whole = pa.record_batch([bodies, *batch.columns[1:]], batch.schema.names)
            for rows, data, begin in blocks(iter([whole]), "html"):
                stream, _, a, b = _stream(data, begin)
                cell = _cell(_runs(stream), CELLS)
                out = np.zeros((len(rows), len(names)))
                for i in range(len(names)):
                    total = np.concatenate([[0.0], np.cumsum(held[i][cell], dtype=np.float64)])
                    out[:, i] = (total[b] - total[a]) / np.maximum(b - a, 1) * np.minimum(b - a, MOST_RUNS) * TEXT_WEIGHT
                out -= out.max(axis=1, keepdims=True)
                evidence = pa.ListArray.from_arrays(np.arange(len(out) + 1, dtype=np.int32) * len(names), out.reshape(-1))
                yield pa.record_batch([*rows.columns[1:], evidence], [*rows.schema.names[1:], "evidence"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others) + ", evidence array<double>"
    return pages.select("html", *[f.name for f in others]).mapInArrow(run, schema)


def _vote(names: list[str], said: Column, right: float) -> Column:
    """log p(said | language): ``right`` for the named language, the rest shared; no vote if it names none of them."""
    other = (1 - right) / max(1, len(names) - 1)
    known = F.array_contains(F.array(*[F.lit(n) for n in names]), said)
    votes = F.array(*[F.when(said == n, F.lit(float(np.log(right)))).otherwise(F.lit(float(np.log(other)))) for n in names])
    return F.when(known, votes).otherwise(F.array(*[F.lit(0.0) for _ in names]))


def _softmax(x: Column) -> Column:
    e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    total = F.aggregate(e, F.lit(0.0), lambda s, v: s + v)
    return F.transform(e, lambda v: v / total)


def _plus(*columns: Column) -> Column:
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), columns)


def page_languages(pages: DataFrame, docs: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, the pieces of evidence (text_lang, declared, path_lang, suffix_lang,
    host), lang and its probability.

    ``docs`` (text, lang) trains the text models.  A null page has no text and no declaration, a
    null address no host: what is missing does not vote, and a page without any evidence gets the
    language of the prior.  Ties go to the first language by name.  Repeated rows repeat; other
    columns are ignored.  Without training languages every page has a null language.
    """
    names = languages(docs, "lang")
    address = F.col(url).cast("string")
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"),
        F.lower(F.nullif(F.regexp_extract(F.col(html), LANG_ATTRIBUTE, 1), F.lit(""))).alias("declared"),
        F.lower(F.nullif(F.regexp_extract(address, HOST, 1), F.lit(""))).alias("host"),
        F.lower(F.nullif(F.regexp_extract(address, PATH_SEGMENT, 1), F.lit(""))).alias("path_lang"),
    )
    if not names:
        return rows.select("page_id", "url", F.lit(None).cast("string").alias("text_lang"), "declared", "path_lang", F.lit(None).cast("string").alias("suffix_lang"), "host", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"))
    parts = F.split("host", r"\.")
    suffix = F.element_at(parts, -1)
    countries = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    found = text_evidence(rows, run_tables(docs, names), names)
    found = found.select(
        "*", F.element_at(countries, suffix).alias("suffix_lang"), suffix.alias("suffix"),
        F.array_join(F.slice(parts, -F.least(F.size(parts), F.lit(2)), F.least(F.size(parts), F.lit(2))), ".").alias("domain"),
    )
    own = _plus(F.col("evidence"), _vote(names, F.col("declared"), DECLARED), _vote(names, F.col("path_lang"), PATH), _vote(names, F.col("suffix_lang"), SUFFIX))
    found = stored(found.withColumn("own", own).withColumn("p", _softmax(F.col("own"))), "evidence")

    # sums of posteriors: hosts, domains, suffixes, everything
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(len(names))]
    by_host = found.where("host is not null").groupBy("host", "domain", "suffix").agg(*sums)
    by_host = stored(by_host.select("host", "domain", "suffix", F.array(*[f"s{i}" for i in range(len(names))]).alias("host_sum")), "hosts")
    again = [F.sum(F.col("host_sum")[i]).alias(f"s{i}") for i in range(len(names))]
    listed = F.array(*[f"s{i}" for i in range(len(names))])
    by_domain = by_host.groupBy(F.col("domain").alias("d")).agg(*again).select("d", listed.alias("domain_sum"))
    by_suffix = by_host.groupBy(F.col("suffix").alias("x")).agg(*again).select("x", listed.alias("suffix_sum"))
    everything = list(found.agg(*sums).first() or [])
    total = F.array(*[F.lit(float(v or 0.0) + 1.0) for v in everything])

    hosts = stored(by_host.join(by_domain, F.col("domain") == F.col("d")).join(by_suffix, F.col("suffix") == F.col("x")).select("host", "host_sum", "domain_sum", "suffix_sum"), "host_sums")
    found = salted_join(found.select("page_id", "url", "declared", "path_lang", "suffix_lang", "host", "evidence", "own", "p"), hosts, ["host"], "left", F.col("page_id"))
    nothing = F.array(*[F.lit(0.0) for _ in names])

    def level(sums_: str, prior: Column) -> Column:
        """Counts of a level without the page itself, over the level above."""
        rest = F.zip_with(F.coalesce(F.col(sums_), F.col("p")), F.col("p"), lambda s, x: F.greatest(s - x, F.lit(0.0)))
        n = F.aggregate(rest, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(rest, prior, lambda s, x: (s + STRENGTH * x) / (n + STRENGTH))

    all_total = F.aggregate(total, F.lit(0.0), lambda s, x: s + x)
    prior = F.transform(total, lambda x: x / all_total)
    found = found.withColumn("prior", level("suffix_sum", prior))
    found = found.withColumn("prior", level("domain_sum", F.col("prior"))).withColumn("prior", level("host_sum", F.col("prior")))
    found = found.withColumn("post", _softmax(_plus(F.col("own"), F.transform("prior", lambda x: F.log(x)), nothing)))
    all_names = F.array(*[F.lit(n) for n in names])

    def best(x: str) -> Column:
        return F.element_at(all_names, F.array_position(F.col(x), F.array_max(x)).cast("int"))

    silent = F.array_max("evidence") == F.array_min("evidence")
    return found.select("page_id", "url", F.when(~silent, best("evidence")).alias("text_lang"), "declared", "path_lang", "suffix_lang", "host", best("post").alias("lang"), F.array_max("post").alias("probability"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
