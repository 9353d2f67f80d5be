"""Benchmark decontamination by winnowing.

A fingerprint is the smallest hash among the k-word runs of a sliding window (the last one, if
several are equal).  Which one is smallest depends on the window's words alone, so two texts
that share ``WINDOW`` words in a row share a fingerprint at the same place of that span: no
shared span is missed.  Documents and benchmark items are joined on fingerprints, and every hit
is extended to the whole window and compared word by word.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .cells import bit_map, has_bit
from .shared import stored, table
from .words import ALNUM, blocks, grams, hashes, mix, spans

WINDOW = 10
RUN = 5
#: Bits of the filter that keeps document fingerprints of no item out of the shuffle.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27

SPLIT = "doc_id {id}, _text bigint, n_words bigint, found array<struct<at:int,print:bigint,span:int,first:int,words:array<string>>>"


def _run(span: int) -> int:
    return min(RUN, span)


def _prints(words: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``span`` words: the place of its fingerprint in the window, and the fingerprint."""
    k = _run(span)
    runs = grams(words, k)
    n = len(runs) - (span - k)
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, place = runs[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, span - k + 1):
        other = runs[j : j + n]
        less = other <= best
        best[less], place[less] = other[less], j
    return place, mix(best + np.uint64(span))


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Every window of every item: item_id, span, place of the fingerprint, fingerprint, words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, begin in blocks(batches, "text"):
            starts, ends, counts = spans(data, begin, ALNUM)
            words, names, at = hashes(data, starts, ends), _texts(data, starts, ends), 0
            out: list[list] = [[], [], [], [], []]
            for item, n in zip(rows.column(0).to_pylist(), counts):
                if n:
                    span = min(window, int(n))
                    place, prints = _prints(words[at : at + n], span)
                    for i in range(len(place)):
                        for column, v in zip(out, (item, span, int(place[i]), prints[i], " ".join(names[at + i : at + i + span]))):
                            column.append(v)
                at += n
            yield pa.record_batch(
                [pa.array(out[0], rows.schema.field(0).type), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                 pa.array(np.array(out[3], np.uint64).view(np.int64)), pa.array(out[4], pa.string())],
                ["item_id", "span", "place", "print", "window"],
            )

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text is not null")
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_id {kind}, span int, place int, print bigint, window string")


def print_filter(windows: DataFrame) -> np.ndarray:
    """A bit map of the fingerprints, between ``LEAST_BITS`` and ``MOST_BITS`` bits (16 MB)."""
    n = windows.select(F.approx_count_distinct("print")).first()[0]
    bits = LEAST_BITS
    while bits < MOST_BITS and bits < 64 * n:
        bits *= 2
    return bit_map(windows, F.col("print"), bits)


def _candidates(docs: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """One row per document: its word count, and its fingerprints that the filter knows, each
    with the words of all windows that may hold it."""
    kept = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = kept.value
        for rows, data, begin in blocks(batches, "text"):
            starts, ends, counts = spans(data, begin, ALNUM)
            words, owner = hashes(data, starts, ends), np.repeat(np.arange(len(rows)), counts)
            first = np.cumsum(counts) - counts
            found: list[list] = [[] for _ in range(len(rows))]
            for span in lengths:
                place, prints = _prints(words, span)
                at = np.arange(len(place))
                same = owner[at] == owner[at + span - 1] if len(at) else np.zeros(0, bool)
                at, prints = at[same] + place[same], prints[same]
                at, index = np.unique(at, return_index=True)
                prints = prints[index]
                bit = (prints % np.uint64(len(bitmap) * 8)).astype(np.int64)  # the filter has a power of two of bits
                known = has_bit(bitmap, bit)
                around = span - _run(span)
                for i, p in zip(at[known], prints[known].view(np.int64)):
                    doc = owner[i]
                    a, b = max(first[doc], i - around), min(first[doc] + counts[doc], i + span)
                    found[doc].append({"at": int(i - first[doc]), "print": int(p), "span": span, "first": int(a - first[doc]), "words": _texts(data, starts[a:b], ends[a:b])})
            kind = pa.list_(pa.struct([("at", pa.int32()), ("print", pa.int64()), ("span", pa.int32()), ("first", pa.int32()), ("words", pa.list_(pa.string()))]))
            yield pa.record_batch([rows.column(0), rows.column(1), pa.array(counts, pa.int64()), pa.array(found, kind)], ["doc_id", "_text", "n_words", "found"])

    return docs.mapInArrow(run, SPLIT.format(id=docs.schema["doc_id"].dataType.simpleString()))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, item_ids (as text, sorted), contaminated.

    Null and empty texts have no words and hit nothing; so does everything if there are no
    items.  Items shorter than the window are one window.  Repeated rows give repeated results,
    and rows of one doc_id with different texts are looked at one by one.  Other columns are
    ignored, whatever their names.
    """
    windows = stored(item_windows(items, item_id, text, window), "windows")
    lengths = sorted(r[0] for r in windows.select("span").distinct().collect())  # at most ``window`` of them
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("_text"), F.col(text).alias("text"))
    marked = stored(_candidates(rows, lengths, print_filter(windows)), "prints")
    key = ["doc_id", "_text"]

    prints = stored(windows.select("print", "span", "place", "window").distinct(), "prints_of_items")
    found = marked.select(*key, F.explode("found").alias("f")).select(*key, "f.*")
    start = F.col("at") - F.col("place")
    hits = (
        found.join(prints, ["print", "span"])
        .where(start >= F.col("first"))
        .where(F.array_join(F.slice("words", start - F.col("first") + 1, F.col("span")), " ") == F.col("window"))
        .select(*key, start.alias("start"), (start + F.col("span")).alias("end"), "span", "window")
        .distinct()
    )
    hits = stored(hits, "hits")
    before = F.max("end").over(W.partitionBy(*key).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    covered = (
        hits.select(*key, "start", "end").distinct()
        .select(*key, F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(before, F.col("start")))).alias("n"))
        .groupBy(*key).agg(F.sum("n").cast("bigint").alias("n_hit"))
    )
    owners = windows.select("window", "span", F.col("item_id").cast("string").alias("item_id")).distinct()
    named = (
        hits.select(*key, "window", "span").distinct().join(owners, ["window", "span"])
        .groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    result = covered.join(named, (covered["doc_id"].eqNullSafe(named["doc_id"])) & (covered["_text"] == named["_text"]), "left").select(
        covered["doc_id"].alias("_id"), covered["_text"].alias("_t"), "n_hit", "item_ids"
    )
    out = marked.select(*key, "n_words").join(result, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("_text") == F.col("_t")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select("doc_id", "_text", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"), ids.alias("item_ids"), (n_hit > 0).alias("contaminated"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


SQL = """
WITH lower_docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), lower_items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM lower_items WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM lower_docs, sizes WHERE len(ws) >= n)
), hits AS (
  SELECT DISTINCT d.doc_id, d.i, d.n, d.w FROM doc_windows d SEMI JOIN item_windows b ON d.w = b.w AND d.n = b.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT h.doc_id, CAST(b.item_id AS VARCHAR) AS item_id FROM hits h JOIN item_windows b ON h.w = b.w AND h.n = b.n) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(l.ws) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(x.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(x.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM lower_docs l LEFT JOIN covered c ON l.doc_id = c.doc_id LEFT JOIN named x ON l.doc_id = x.doc_id
"""
