"""N-gram Jaccard join with filters under several global token orders.

The set of a document are the hashes of its five-word runs.  Two sets with a Jaccard similarity
of 0.8 share a token among the first fifth of both, whatever global order the tokens have.

1. The rare-first order (counted over all documents, in a table of fixed size) finds candidates:
   documents that share a token of their prefixes.  Exact copies are one class from the start.
2. Each candidate is compared with the smallest document of its token first.  That links the
   bulk of a group of copies to one member, with as many pairs as documents, and documents in
   one component need no further comparison.
3. For tokens that still hold several components the remaining pairs are formed: small groups by
   a join, large ones in tiles, where only the pairs that may pass leave the task.
4. A pair goes on if the counts of its tokens by hash range allow the similarity, then if the
   prefixes under two further orders share a token; then the sets are compared.  Components of
   the links that hold are the result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import Window as W

from .cells import SCHEMA, bit_map, has_bit, packed, summed
from .graph import components
from .shared import stored, table
from .words import NOT_SPACE, blocks, grams, hashes, mix, spans

SHINGLE = 5
#: Similarity in hundredths.
PERCENT = 80
#: Cells of the token counts (8 MB).
CELLS = 1 << 21
#: Bits of the filter for the documents that a comparison needs (2 MB).
ID_BITS = 1 << 24
#: Groups up to this size are paired by a join; larger ones in tiles of so many rows.
SMALL_GROUP, TILE = 32, 1024


def _need(a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | int:
    """The least intersection of two sets of these sizes that are similar enough."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def _need_sql(a: str, b: str) -> Column:
    return F.expr(f"cast(({PERCENT} * ({a} + {b}) + {100 + PERCENT - 1}) div {100 + PERCENT} as int)")


def _sets(data: np.ndarray, begin: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted token hashes of every text."""
    starts, ends, counts = spans(data, begin, NOT_SPACE)
    words = hashes(data, starts, ends)
    runs, first = grams(words, shingle), np.cumsum(counts) - counts
    return [
        np.unique(runs[a : a + n - shingle + 1]) if n >= shingle else grams(words[a : a + n], n) if n else runs[:0]
        for a, n in zip(first.tolist(), counts.tolist())
    ]


def token_counts(docs: DataFrame, shingle: int, cells: int = CELLS) -> np.ndarray:
    """How many documents hold a token, summed over the tokens of one cell, for all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for _, data, begin in blocks(batches, "text"):
            tokens = np.concatenate(_sets(data, begin, shingle) or [np.zeros(0, np.uint64)])
            np.add.at(total, (tokens & np.uint64(cells - 1)).astype(np.int64), 1)
        yield packed(total)

    return summed(docs.select("text").mapInArrow(count, SCHEMA), cells)


def _prefix(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest tokens, as many as a similar set must share one of."""
    n = len(tokens)
    rank = counts[(tokens & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(32) | tokens >> np.uint64(32)
    return tokens[np.argsort(rank, kind="stable")[: n - (-(-PERCENT * n // 100)) + 1]]  # tokens ascend: ties go by token


def _profile(tokens: np.ndarray) -> np.ndarray:
    """How many tokens lie in each of equal hash ranges (a power of two, about one per token)."""
    bits = max(6, int(len(tokens) - 1).bit_length())
    return np.minimum(np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def _apart(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A lower bound of the size of the symmetric difference, from the profiles."""
    one, many = one.astype(np.int16), many.astype(np.int16)
    width = min(len(one), many.shape[1])
    one = one.reshape(width, -1).sum(axis=1, dtype=np.int32)
    many = many.reshape(len(many), width, -1).sum(axis=2, dtype=np.int32)
    return np.abs(many - one).sum(axis=1)


def described(docs: DataFrame, counts: np.ndarray, shingle: int) -> DataFrame:
    """doc_id, n (tokens), class (a digest of the set; null if empty), prefix and profile."""
    kept = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, begin in blocks(batches, "text"):
            sets = _sets(data, begin, shingle)
            yield pa.record_batch(
                [rows.column(0), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([_prefix(s, kept.value).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                 pa.array([_profile(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                ["doc_id", "n", "class", "prefix", "profile"],
            )

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n int, class binary, prefix array<bigint>, profile binary")


def _possible(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """The pairs (x, y) whose profiles allow the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny, px, py = (batch.column(i).to_pylist() for i in (2, 3, 4, 5))
            good = [
                int(_apart(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)[None, :])[0]) <= a + b - 2 * _need(a, b)
                for a, b, p, q in zip(nx, ny, px, py)
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = profiles.select(F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.col("profile").alias("px"))
    right = profiles.select(F.col("doc_id").alias("y"), F.col("n").alias("ny"), F.col("profile").alias("py"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", "nx", "ny", "px", "py")
    kind = profiles.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"x {kind}, y {kind}").distinct()


def _similar(pairs: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """The pairs (x, y) whose sets are similar, from the texts of just these documents."""
    ids = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    kept = docs.sparkSession.sparkContext.broadcast(bit_map(ids, F.xxhash64("id"), ID_BITS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = kept.value, set()

        def some() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bit = batch.column(1).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(has_bit(wanted, bit)))

        for rows, data, begin in blocks(some(), "text"):
            out: tuple[list, list] = ([], [])
            for doc, tokens in zip(rows.column(0).to_pylist(), _sets(data, begin, shingle)):
                piece = tokens.tobytes()
                if len(tokens) and (key := (doc, hashlib.blake2b(piece, digest_size=16).digest())) not in seen:
                    seen.add(key)  # a row that repeats within a task counts once
                    out[0].append(doc)
                    out[1].append(piece)
            yield pa.record_batch([pa.array(out[0], rows.schema.field(0).type), pa.array(out[1], pa.binary())], ["id", "tokens"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                need = int(_need(len(a), len(b)))
                good.append(
                    need <= min(len(a), len(b)) and all(_share_prefix(a, b, need, order) for order in (1, 2))
                    and len(np.intersect1d(a, b, assume_unique=True)) >= need
                )
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS)).alias("bit")
    sets = docs.select("doc_id", bit, "text").mapInArrow(read, f"id {kind}, tokens binary").join(ids, "id", "left_semi")
    sets = stored(sets, "sets")
    both = pairs.join(sets.select(F.col("id").alias("x"), F.col("tokens").alias("tx")), "x").join(
        sets.select(F.col("id").alias("y"), F.col("tokens").alias("ty")), "y").select("x", "y", "tx", "ty")
    return both.mapInArrow(verify, f"x {kind}, y {kind}").distinct()


def _share_prefix(a: np.ndarray, b: np.ndarray, need: int, order: int) -> bool:
    """Whether the prefixes under another order of all tokens have one in common."""
    turn = np.uint64(0x9E3779B97F4A7C15 * order & 0xFFFFFFFFFFFFFFFF)
    first = [np.partition(k, len(k) - need)[: len(k) - need + 1] if need > 1 else k for k in (mix(a ^ turn), mix(b ^ turn))]
    return bool(np.isin(first[0], first[1]).any())


def _in_tiles(rows: DataFrame, kind: str) -> DataFrame:
    """Possible pairs of the large groups.  Rows outside a group's largest component meet all
    rows of other components, tile by tile."""
    def run(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        ids, n, at, comp = (other.column(c).to_numpy() for c in ("doc", "n", "pos", "comp"))
        profiles = [np.frombuffer(p.as_buffer(), np.uint8) for p in other.column("profile")]
        widths = np.array([len(p) for p in profiles])
        tables = {w: (np.flatnonzero(widths == w), np.stack([p for p in profiles if len(p) == w])) for w in np.unique(widths)}
        for r in one.select(["doc", "n", "pos", "comp", "profile", "rest"]).to_pylist():
            need = _need(r["n"], n)
            fit = (comp != r["comp"]) & (r["pos"] + need <= r["n"]) & (at + need <= n)
            mine = np.frombuffer(r["profile"], np.uint8)
            for index, matrix in tables.values():
                some = fit[index]
                if some.any():
                    near = index[some][_apart(mine, matrix[some]) <= r["n"] + n[index[some]] - 2 * need[index[some]]]
                    out[0].extend([r["doc"]] * len(near))
                    out[1].extend(ids[near].tolist())
        return pa.table({"x": pa.array(out[0], other.schema.field("doc").type), "y": pa.array(out[1], other.schema.field("doc").type)})

    tiles = F.ceil(F.col("cnt") / TILE).cast("int")
    placed = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    ones = placed.where("rest").withColumn("other", each)
    ones = ones.toDF(*ones.columns)  # own column identities: both sides come from one table
    others = placed.withColumnRenamed("tile", "other").withColumn("tile", each)
    keys = ["token", "tile", "other"]
    return ones.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(run, f"x {kind}, y {kind}").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")
    ).distinct()


def linked(docs: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The described documents (doc_id, n, class) and the component of every class that is
    linked to another one (``class``, ``component``) or has copies."""
    counts = token_counts(docs, shingle)
    all_docs = stored(described(docs, counts, shingle), "described")
    kind = all_docs.schema["doc_id"].dataType.simpleString()
    # one document stands for each class
    classes = stored(all_docs.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep")), "classes")
    reps = all_docs.join(classes.withColumnRenamed("class", "c"), (F.col("class") == F.col("c")) & (F.col("doc_id") == F.col("rep")), "left_semi")
    reps = stored(reps.select("doc_id", "n", "profile", "prefix"), "representatives")
    profiles = reps.select("doc_id", "n", "profile").dropDuplicates(["doc_id", "profile"])

    rows = reps.select(F.col("doc_id").alias("doc"), "n", F.posexplode("prefix").alias("pos", "token"))
    group = W.partitionBy("token")
    shared = rows.select(
        "*", F.count(F.lit(1)).over(group).alias("cnt"), F.min(F.struct("doc", "n")).over(group).alias("hub"), F.bit_xor(F.xxhash64("doc")).over(group).alias("members")
    ).where("cnt > 1")
    # tokens with the same members: the first one in the order is enough
    shared = shared.groupBy("cnt", "hub", "members", "doc", "n").agg(F.min(F.struct("pos", "token")).alias("f"))
    shared = stored(shared.select("cnt", "hub", "doc", "n", F.col("f.pos").alias("pos"), F.col("f.token").alias("token")), "shared")

    fits = (100 * F.least("n", "hub.n") >= PERCENT * F.greatest("n", "hub.n")) & (F.col("doc") != F.col("hub.doc"))
    to_hub = stored(shared.where(fits).select(F.col("hub.doc").alias("x"), F.col("doc").alias("y")).distinct(), "pairs")
    first = stored(_similar(stored(_possible(to_hub, profiles), "possible"), docs, shingle), "similar")

    found = components(first, "x", "y").select(F.col("node").alias("doc"), F.col("component").alias("comp"))
    placed = shared.select("cnt", "doc", "n", "pos", "token").join(found, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    placed = stored(placed, "placed")
    sizes = placed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = sizes.groupBy(F.col("token").alias("t")).agg(F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    open_rows = placed.join(mixed, F.col("token") == F.col("t")).select("token", "cnt", "doc", "n", "pos", "comp", (F.col("comp") != F.col("top.comp")).alias("rest"))
    open_rows = stored(open_rows, "open")

    small = open_rows.where(F.col("cnt") <= SMALL_GROUP)
    p, q = small.where("rest").alias("p"), small.alias("q")
    need = _need_sql("p.n", "q.n")
    pairs = p.join(q, (F.col("p.token") == F.col("q.token")) & (F.col("p.comp") != F.col("q.comp")) & (~F.col("q.rest") | (F.col("p.doc") < F.col("q.doc")))
                   & (F.col("p.pos") + need <= F.col("p.n")) & (F.col("q.pos") + need <= F.col("q.n")))
    pairs = pairs.select(F.least("p.doc", "q.doc").alias("x"), F.greatest("p.doc", "q.doc").alias("y")).distinct()
    large = open_rows.where(F.col("cnt") > SMALL_GROUP).join(profiles.select(F.col("doc_id").alias("doc"), "profile"), "doc")
    done = to_hub.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    more = _possible(pairs.join(done, ["x", "y"], "left_anti"), profiles).union(_in_tiles(large, kind).join(done, ["x", "y"], "left_anti")).distinct()
    second = stored(_similar(stored(more, "possible"), docs, shingle), "similar")

    whole = components(first.union(second), "x", "y")
    labels = classes.join(whole, F.col("rep") == F.col("node"), "left").select("class", F.coalesce("component", "rep").alias("component"))
    return all_docs.select("doc_id", "n", "class"), labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Null texts and texts without words have an empty set and are alone; a text of fewer words
    than a shingle is one token.  Rows with a null doc_id get a null component of their own.
    Repeated rows give repeated results.  Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    described_rows, labels = linked(rows.where("doc_id is not null"), shingle)
    out = described_rows.join(labels.withColumnRenamed("class", "c"), F.col("class") == F.col("c"), "left")
    out = out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    lost = described(rows.where("doc_id is null"), np.zeros(1, np.uint32), shingle)
    return out.union(lost.select("doc_id", F.col("n").cast("bigint"), "doc_id"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE ws AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 5, 0) + 2)) AS i FROM ws WHERE len(ws) > 0)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), least_of AS (SELECT x, min(y) AS c FROM reached GROUP BY x)
SELECT w.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.c, w.doc_id) AS component_id
FROM ws w LEFT JOIN sizes s ON w.doc_id = s.doc_id LEFT JOIN least_of l ON l.x = w.doc_id
"""
