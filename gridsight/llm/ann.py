"""Approximate nearest neighbours by inner product with balanced posting lists.

Vectors get one more component so that all have the same length; then the nearest by distance is
the one with the largest inner product.  A bounded sample is cut in halves again and again, which
gives lists of equal size; their centroids form a neighbourhood graph that every task searches
in memory.  A vector on the border of lists is written to several of them, unless a list that it
is in already lies closer to that list than the vector does.  A query reads the lists whose
centroids are at most ``RATIO`` times as far as its nearest one.  All vectors are indexed, and
all scores are computed from the original vectors in double precision.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .shared import stored, table

#: Rows that the lists are learned from; every row is indexed.
SAMPLE = 20_000
#: Rows per list aimed at, and the most lists (their centroids are what tasks hold).
LIST_ROWS, MOST_LISTS = 256, 512
#: Links of a centroid in the graph, and the pool of the search for vectors and for queries.  A
#: query may read every list: only the distance ratio leaves lists out.
DEGREE, POOL, QUERY_POOL = 16, 32, 512
#: How much farther than the nearest list another one may be to get a copy, and at most how many get one.
BORDER, COPIES = 1.05, 2
#: Lists whose centroids are closer together than this share of the distance to the vector do not both get it.
SPREAD = 0.3
#: How much farther than the nearest centroid a list may be that a query reads.
RATIO = 1.15
#: Neighbouring lists are compared in one group, which hands on k rows of a query however many of
#: its lists the query reads; a group is compared in blocks of so many vectors and queries.
GROUPS, VECTORS, QUERIES = 16, 32_768, 512
#: Rows searched at once.
BATCH = 512


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    infinite = float("inf")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Arrow lists as rows of one matrix; shorter vectors are filled up with zeros."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (size == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _lifted(x: np.ndarray, peak: float, longest: float) -> np.ndarray:
    """Vectors divided by the greatest length, with the component that brings all to length 1.
    ``longest`` is that length in units of ``peak``."""
    x = x / peak / longest
    return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))])


def _asked(x: np.ndarray) -> np.ndarray:
    """Queries have nothing to add: of length 1, with an additional component of 0."""
    x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths of very long or short ones are no numbers
    return np.column_stack([x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.zeros(len(x))])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T)


def balanced_centroids(x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Halve the sample at the median between two centres until there are enough parts, then move
    the means twice, with a price on parts that grow beyond their share."""
    parts = [np.arange(len(x))]
    while len(parts) < lists:
        parts.sort(key=len)
        part = parts.pop()
        if len(part) < 2:
            parts.append(part)
            break
        rows = x[part]
        two = rows[rng.choice(len(rows), 2, replace=False)]
        for _ in range(4):
            near = _distances(rows, two).argmin(axis=1)
            two = np.stack([rows[near == i].mean(axis=0) if (near == i).any() else two[i] for i in (0, 1)])
        order = np.argsort(rows @ (two[1] - two[0]), kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    centroids = np.stack([x[p].mean(axis=0) for p in parts])
    share, price = len(x) / len(parts), np.zeros(len(parts))
    for _ in range(2):
        near = np.concatenate([(_distances(x[i : i + 2048], centroids) + price).argmin(axis=1) for i in range(0, len(x), 2048)])
        size = np.bincount(near, minlength=len(parts))
        spread = ((x - centroids[near]) ** 2).sum(axis=1).mean()
        price += 0.1 * spread * np.maximum(0, size / share - 1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids = np.where((size > 0)[:, None], sums / np.maximum(size, 1)[:, None], centroids)
    return centroids


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """The nearest centroids of every centroid, and half as many that name it as theirs."""
    k, degree = len(centroids), min(degree, len(centroids) - 1)
    if degree < 1:
        return np.zeros((k, 0), np.int64)
    near = np.concatenate([np.argsort(_distances(centroids[i : i + 512], centroids), axis=1)[:, : degree + 1] for i in range(0, k, 512)])
    named: list[list[int]] = [[] for _ in range(k)]
    links = []
    for i, row in enumerate(near.tolist()):
        row = [j for j in row if j != i][:degree]
        links.append(row)
        for j in row:
            if len(named[j]) < degree // 2:
                named[j].append(i)
    return np.array([row + (back + row)[: degree // 2] for row, back in zip(links, named)])


def search(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, pool: int, reach: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of the graph for many rows at once: the ``pool`` nearest centroids found
    of every row and their distances, nearest first.  Centroids farther than ``reach`` times the
    nearest are not followed."""
    n, k = len(x), len(centroids)
    norms, rows = (centroids * centroids).sum(axis=1), np.arange(n)[:, None]
    own = (x * x).sum(axis=1)[:, None]
    entries = np.unique(np.linspace(0, k - 1, max(1, int(k**0.5))).astype(np.int64))
    pool = min(pool, k)
    ids = np.broadcast_to(entries, (n, len(entries)))
    d = own - 2 * x @ centroids[entries].T + norms[entries]
    seen = np.zeros((n, k), bool)
    seen[:, entries] = True
    done = np.zeros(d.shape, bool)
    while True:
        order = np.argsort(d, axis=1, kind="stable")[:, :pool]
        ids, d, done = (np.take_along_axis(a, order, axis=1) for a in (ids, d, done))
        done = done | (d > reach * reach * np.maximum(d[:, :1], 0) + 1e-12) if reach < np.inf else done
        best = np.where(done | np.isinf(d), np.inf, d).argmin(axis=1)[:, None]
        if (np.take_along_axis(done, best, axis=1) | np.isinf(np.take_along_axis(d, best, axis=1))).all():
            return ids, np.sqrt(np.maximum(d, 0))
        np.put_along_axis(done, best, True, axis=1)
        more = graph[np.take_along_axis(ids, best, axis=1)[:, 0]]
        new = own - 2 * np.einsum("nd,nkd->nk", x, centroids[more]) + norms[more]
        new[seen[rows, more]] = np.inf
        seen[rows, more] = True
        same = np.sort(more, axis=1)
        if (same[:, 1:] == same[:, :-1]).any():  # a link named twice counts once
            first = np.zeros(more.shape, bool)
            for c in range(more.shape[1]):
                first[:, c] = (more[:, :c] != more[:, c : c + 1]).all(axis=1)
            new[~first] = np.inf
        ids, d = np.concatenate([ids, more], axis=1), np.concatenate([d, new], axis=1)
        done = np.concatenate([done, np.zeros(more.shape, bool)], axis=1)


def _homes(ids: np.ndarray, d: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and list of every copy: the nearest list, and border lists that no list taken before
    lies closer to."""
    rows, lists = [np.arange(len(ids))], [ids[:, 0]]
    taken = [ids[:, :1]]
    count = np.ones(len(ids), np.int64)
    for c in range(1, ids.shape[1]):
        fits = (d[:, c] <= BORDER * d[:, 0] + 1e-12) & (count < COPIES)
        if not fits.any():
            break
        held = np.concatenate(taken, axis=1)[fits]
        gap = np.sqrt(((centroids[np.maximum(held, 0)] - centroids[ids[fits, c]][:, None, :]) ** 2).sum(axis=2))
        gap[held < 0] = np.inf
        good = np.zeros(len(ids), bool)
        good[np.flatnonzero(fits)[(gap >= SPREAD * d[fits, c][:, None]).all(axis=1)]] = True
        count += good
        rows.append(np.flatnonzero(good))
        lists.append(ids[good, c])
        taken.append(np.where(good, ids[:, c], -1)[:, None])
    return np.concatenate(rows), np.concatenate(lists)


def top(scores: np.ndarray, q: np.ndarray, v: np.ndarray, same: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids of every row with exact scores, each with its best column: row, column, score.

    ``ids`` may repeat with different vectors; a row of an id that is not its best takes no place.
    A product of matrices may differ in the last bits from column to column; so everything near
    the border is kept, added up component by component in one order, and then ranked.
    """
    # products beyond the largest number depend on the order of their sum: such rows keep all columns
    beyond = ~np.isfinite(scores).all(axis=1)
    scores = np.where(same | np.isnan(scores), -np.inf, scores)
    names, back, often = np.unique(ids, return_inverse=True, return_counts=True)
    n = min(k, len(names))
    if len(names) < len(ids):  # the border is drawn among the best scores of the ids
        by_id = np.argsort(back, kind="stable")
        scores_ = np.maximum.reduceat(scores[:, by_id], np.cumsum(often) - often, axis=1)
    else:
        scores_ = scores
    border = np.partition(scores_, scores_.shape[1] - n, axis=1)[:, scores_.shape[1] - n]
    with np.errstate(invalid="ignore", over="ignore"):
        near = np.where(beyond | ~np.isfinite(border), -np.inf, border - 1e-9 * (1 + np.abs(border)))
        r, c = np.nonzero((scores >= near[:, None]) & ~same)
        exact = np.zeros(len(r))
        for i in range(q.shape[1]):
            exact += q[r, i] * v[c, i]
    exact = np.where(np.isnan(exact), -np.inf, exact)
    order = np.lexsort((ids[c], -exact, r))
    r, c, exact = r[order], c[order], exact[order]
    if len(names) < len(ids):
        first = np.sort(np.unique(r * len(names) + back[c], return_index=True)[1])  # the best row of every id
        r, c, exact = r[first], c[first], exact[first]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    return r[place < k], c[place < k], exact[place < k]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of every query.

    Both tables have an id and a vector; a query's own id is no candidate.  Null, zero and not
    finite vectors take no part on either side; vectors of different lengths are compared as if
    the shorter were filled up with zeros.  An id that repeats counts once, with its best score.
    A score beyond the largest number is infinite, and one whose parts are infinite with both signs
    counts as minus infinity.  Fewer candidates than ``k`` give fewer rows, an empty table none.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("v")))

    # equal rows are one; -0.0 is 0.0
    base = clean(vectors).select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct()
    asked = clean(queries)
    most = F.max(F.array_max(F.transform("v", F.abs)))
    kind = "id bigint, v array<double>"
    base = stored(base, "vectors")
    n, dim, peak = base.agg(F.count(F.lit(1)), F.max(F.size("v")), most).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = max(dim, asked.agg(F.max(F.size("v"))).first()[0] or 0)
    # lengths in units of the largest component: their squares neither overflow nor vanish
    longest = base.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / peak) * (x / peak))))).first()[0]

    share = min(1.0, 2.0 * SAMPLE / n)
    picked = base.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    sample = _lifted(_matrix(picked.column("v").combine_chunks(), dim), peak, longest)
    lists = int(max(1, min(MOST_LISTS, n // LIST_ROWS, len(sample) // 4)))
    centroids = balanced_centroids(sample, lists, np.random.default_rng(7))
    # groups of lists that follow each other along the direction in which centroids differ most
    groups = min(GROUPS, lists)
    along = np.linalg.svd(centroids - centroids.mean(axis=0), full_matrices=False)[2][0]
    group_of = np.empty(len(centroids), np.int64)
    group_of[np.argsort(centroids @ along, kind="stable")] = np.arange(len(centroids)) * groups // len(centroids)
    held = spark.sparkContext.broadcast((centroids, neighbour_graph(centroids), group_of))

    def places(lift, pool: int, reach: float, pick):
        """A row for every group that a vector belongs to, with its lists there."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, graph, group = held.value
            for batch in batches:
                for at in range(0, len(batch), BATCH):
                    part = batch.slice(at, BATCH)
                    x = lift(_matrix(part.column(1), dim))
                    rows, found = pick(*search(x, centres, graph, pool, reach), centres)
                    key = rows * len(centres) + group[found]
                    order = np.argsort(key, kind="stable")
                    key, first = np.unique(key[order], return_index=True)
                    lists_ = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(found[order], pa.int32()))
                    rows = pa.array(key // len(centres))
                    yield pa.record_batch([pa.array(key % len(centres), pa.int32()), part.column(0).take(rows), part.column(1).take(rows), lists_], ["group", "id", "v", "lists"])
        return run

    def probes(ids: np.ndarray, d: np.ndarray, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, columns = np.nonzero(d <= RATIO * d[:, :1] + 1e-12)
        return rows, ids[rows, columns]

    schema = f"group int, {kind}, lists array<int>"
    indexed = stored(base.mapInArrow(places(lambda x: _lifted(x, peak, longest), POOL, np.inf, _homes), schema), "posting_lists")
    wanted = stored(asked.mapInArrow(places(_asked, QUERY_POOL, RATIO, probes), schema), "probes")

    # at most GROUPS rows
    blocks = indexed.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / VECTORS).cast("int").alias("nv")).join(
        wanted.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("nq")), "group")
    blocks = F.broadcast(stored(blocks, "blocks"))

    def dealt(rows: DataFrame, own: str, own_count: str, other_: str, other_count: str) -> DataFrame:
        return rows.join(blocks, "group").select(
            "group", F.pmod(F.xxhash64("id", "v"), F.col(own_count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other_), "id", "v", "lists")

    def by_list(t: pa.Table) -> dict[int, np.ndarray]:
        column = t.column("lists").combine_chunks()
        size = np.diff(column.offsets.to_numpy())
        flat, rows = column.flatten().to_numpy(), np.repeat(np.arange(len(size)), size)
        order = np.argsort(flat, kind="stable")
        names, first = np.unique(flat[order], return_index=True)
        return dict(zip(names.tolist(), np.split(rows[order], first[1:])))

    def compare(_, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        ids, qids = ours.column("id").to_numpy(), theirs.column("id").to_numpy()
        best: tuple = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if len(ids) and len(qids):
            v, q = (_matrix(t.column("v").combine_chunks(), dim) for t in (ours, theirs))
            asking = by_list(theirs)
            parts = [best]
            for name, rows in by_list(ours).items():
                some = asking.get(name)
                if some is not None:
                    r, c, score = top(q[some] @ v[rows].T, q[some], v[rows], qids[some, None] == ids[rows][None, :], ids[rows], k)
                    parts.append((qids[some[r]], ids[rows[c]], score))
            a, b, score = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((b, -score, a))
            a, b, score = a[order], b[order], score[order]
            once = np.ones(len(a), bool)  # copies of a vector score alike and stand together
            once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            a, b, score = a[once], b[once], score[once]
            first = np.arange(len(a)) - np.searchsorted(a, a) < k
            best = a[first], b[first], score[first]
        return pa.table(list(best), ["query_id", "vec_id", "score"])

    keys = ["group", "a", "b"]
    found = dealt(indexed, "a", "nv", "b", "nq").groupBy(*keys).cogroup(dealt(wanted, "b", "nq", "a", "nv").groupBy(*keys)).applyInArrow(
        compare, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
