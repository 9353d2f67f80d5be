"""Toxicity from class-conditional Kneser-Ney models of byte runs and of words.

Both classes have their own counts of five-byte runs; what a class has not seen often is smoothed
by the continuation counts of shorter runs, which the classes share:

    p(b | ctx, class) = max(n - D, 0) / n(ctx) + D * kinds(ctx) / n(ctx) * p(b | shorter ctx)

Words likewise have counts per class and fall back on the shared probability of their bytes:

    p(w | class) = max(n - D, 0) / n + D * kinds / n * product of p(b | ctx) of its bytes

The counts are Parquet tables with one row per run, context and word (words by a 64-bit hash), so
they grow with the corpus and nothing shares a count.  Texts are put in blocks; each block asks for
its distinct runs, contexts and words by a join.  A key has at most about one row per block, so no
key is hot.

A text's evidence is the difference of its two log-likelihoods per byte (per word), over the whole
text and over its most toxic passages of a few fixed lengths, so that one insult in a long text counts.
A logistic curve fitted on labelled rows turns that into a score.  Counts come from all labelled
rows; no label, language, source or id is an input of a score.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .cells import bit_map, has_bit
from .shared import discarded, stored, table
from .words import ALNUM, blocks, hashes, mix, release, spans

RUN = 5
DISCOUNT = 0.75
#: Bytes of text that are scored together and share one copy of what they ask for.
TEXTS = 1 << 26
#: Bytes of text that travel as one value.
PIECE = 1 << 22
#: What is asked for.
RUNS, CONTEXTS, WORDS = 0, 1, 2
#: log p of a run that is in no labelled text.
RARE = -5.5
#: Bits of the filter that finds labelled documents (2 MB).
ID_BITS = 1 << 24
#: Lengths in bytes of the passages that are looked at besides the whole text.
PASSAGES = (6, 14, 60)
#: The same in words.
WORD_PASSAGES = (1, 3, 12)
#: Occurrences at which a word's evidence counts half; what is rarer counts less.
TRUST = 4
#: Most labelled rows for fitting the curve (its few weights need no more); an eighth of the
#: training rows is set aside for it and is not counted by the models.
FIT_ROWS = 20_000
#: Distinct runs that a counting task keeps before it sums them up.
BUFFER = 1 << 19

FEATURES = ["whole", *[f"best_{n}" for n in PASSAGES], "words", *[f"words_{n}" for n in WORD_PASSAGES]]


def _short(x: np.ndarray) -> np.ndarray:
    """Floats cut to their upper 16 bits (eight bits of precision), to send less."""
    return (x.astype(np.float32).view(np.uint32) >> np.uint32(16)).astype(np.uint16)


def _long(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint32) << np.uint32(16)).view(np.float32)


def _stream(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words with one blank between them, a blank before and after every text; for every text,
    where it begins, and where its runs begin and end in the list of all runs."""
    inside = ALNUM[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    first = begin[:-1][np.diff(begin) > 0]
    keep[first] = inside[first]
    out = np.where(inside, data, 32).astype(np.uint8)[keep]
    ends = np.concatenate([[0], np.cumsum(keep)])[begin]
    last = ends[1:]
    full = last > ends[:-1]
    bare = np.zeros(len(last), bool)
    bare[full] = out[last[full] - 1] != 32  # a text that ends in a word
    out = np.insert(out, last[bare], 32)
    ends = ends + np.concatenate([[0], np.cumsum(bare)])
    out = np.concatenate([[np.uint8(32)], out])
    runs = max(0, len(out) - RUN + 1)
    first, last = ends[:-1], ends[1:] + 1 - RUN + 1  # from the blank before the text to its last full run
    last = np.maximum(first, np.where(ends[1:] > ends[:-1], last, first))
    return out, first, np.minimum(first, runs), np.minimum(last, runs)


def _runs(stream: np.ndarray) -> np.ndarray:
    """Five bytes as one whole number."""
    if len(stream) < RUN:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(stream) - RUN + 1, np.uint64)
    for i in range(RUN):
        out = out << np.uint64(8) | stream[i : len(stream) - RUN + 1 + i].astype(np.uint64)
    return out


def _cell(x: np.ndarray, cells: int) -> np.ndarray:
    return (mix(x) & np.uint64(cells - 1)).astype(np.int64)


def _within(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` runs belong to a text."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, a, 1)
    np.add.at(step, b, -1)
    return np.cumsum(step)[:n] > 0


def _counted(labelled: DataFrame, name: str, keys: Callable) -> DataFrame:
    """How often every key of the texts occurs in ordinary (n0) and toxic (n1) ones; ``keys``
    gives the keys of a slice of texts and how many each text has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
            found, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.concatenate([p[1] for p in parts])
            return found, np.stack([np.bincount(back, n[:, i], len(found)) for i in (0, 1)], axis=1).astype(np.int64)

        def batch() -> pa.RecordBatch:
            found, n = summed(parts)
            return pa.record_batch([pa.array(found.view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], [name, "n0", "n1"])

        parts: list = []
        for rows, data, begin in blocks(batches, "text"):
            found, per_text = keys(data, begin)
            toxic = np.repeat(rows.column(1).to_numpy(zero_copy_only=False), per_text).astype(np.int64)
            parts.append(summed([(found, np.stack([1 - toxic, toxic], axis=1))]))
            if sum(len(p[0]) for p in parts) > BUFFER:
                yield batch()
                parts = []
        if parts:
            yield batch()

    rows = labelled.mapInArrow(count, f"{name} bigint, n0 bigint, n1 bigint")
    return rows.groupBy(name).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def run_counts(labelled: DataFrame) -> DataFrame:
    """run, and how often it occurs in ordinary (n0) and toxic (n1) texts."""
    def keys(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stream, _, a, b = _stream(data, begin)
        runs = _runs(stream)
        return runs[_within(a, b, len(runs))], b - a

    return _counted(labelled, "run", keys)


def word_counts(labelled: DataFrame) -> DataFrame:
    """word (its hash), and how often it occurs in ordinary (n0) and toxic (n1) texts."""
    def keys(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, per_text = spans(data, begin, ALNUM)
        return hashes(data, starts, ends), per_text

    return _counted(labelled, "word", keys)


def _shared(runs: DataFrame) -> DataFrame:
    """p(b | shorter context) of the last four bytes of all runs, from continuation counts."""
    levels, counted = [], runs.select(F.col("run").alias("g"))
    for size in range(RUN - 1, 0, -1):
        last = F.col("g").bitwiseAND(F.lit((1 << 8 * size) - 1))
        counted = counted.select(last.alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("before"))
        levels.append((size, counted))
    p = None
    for size, level in reversed(levels):
        context = W.partitionBy(F.shiftright("g", 8))
        level = level.select("g", "before", F.sum("before").over(context).alias("total"), F.count(F.lit(1)).over(context).alias("kinds"))
        if p is None:
            lower = F.lit(1 / 256)
        else:
            level = level.join(p, F.col("g").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1)) == F.col("h"))
            lower = F.col("q")
        p = level.select(F.col("g").alias("h"), ((F.greatest(F.col("before") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * lower) / F.col("total")).alias("q"))
    return p


def known_items(runs: DataFrame, words: DataFrame) -> DataFrame:
    """kind, key and two values of everything known.  Of a run: log p(toxic) - log p(ordinary) and
    its shared log p; of a context: the same difference for a run that is new after it; of a word:
    its two counts."""
    context = W.partitionBy(F.shiftright("run", 8))

    def has(n: str) -> Column:
        return F.when(F.col(n) > 0, 1).otherwise(0)

    def totals(of) -> list[Column]:
        return [of(F.sum(f"n{i}")).alias(f"c{i}") for i in (0, 1)] + [of(F.sum(has(f"n{i}"))).alias(f"k{i}") for i in (0, 1)]

    seen = runs.select("*", *totals(lambda x: x.over(context)))
    seen = seen.join(_shared(runs), F.col("run").bitwiseAND(F.lit((1 << 8 * (RUN - 1)) - 1)) == F.col("h"))

    def left(i: int) -> Column:
        """What a class leaves to the shared model in this context: everything, if it is new to the class."""
        return F.when(F.col(f"c{i}") > 0, DISCOUNT * F.col(f"k{i}") / F.col(f"c{i}")).otherwise(1.0)

    def p(i: int) -> Column:
        own = F.when(F.col(f"c{i}") > 0, F.greatest(F.col(f"n{i}") - DISCOUNT, F.lit(0.0)) / F.col(f"c{i}")).otherwise(0.0)
        return own + left(i) * F.col("q")

    def item(kind: int, key: str, one: Column, two: Column) -> list[Column]:
        return [F.lit(kind).alias("kind"), F.col(key).alias("key"), one.cast("float").alias("one"), two.cast("float").alias("two")]

    contexts = runs.groupBy(F.shiftright("run", 8).alias("context")).agg(*totals(lambda x: x))
    out = seen.select(item(RUNS, "run", F.log(p(1)) - F.log(p(0)), F.log("q")))
    out = out.union(contexts.select(item(CONTEXTS, "context", F.log(left(1)) - F.log(left(0)), F.lit(0.0))))
    return stored(out.union(words.select(item(WORDS, "word", F.col("n0"), F.col("n1")))), "known")


def _closed_up(rows: pa.RecordBatch) -> bytes:
    """Rows as one compressed value."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))) as writer:
        writer.write_batch(rows)
    return out.getvalue().to_pybytes()


def _opened(pieces: pa.ChunkedArray | pa.Array) -> Iterator[pa.RecordBatch]:
    for piece in pieces:
        yield from pa.ipc.open_stream(piece.as_buffer())


def in_blocks(docs: DataFrame) -> DataFrame:
    """The texts dealt out by blocks of about ``TEXTS`` bytes: ``block``, and ``rows``, some of
    its rows as one compressed value, which halves what is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
            ends, at = before + np.cumsum(size), 0
            while at < len(batch):
                # rows of one block, as many as make a piece
                last = min(ends[at] - size[at] + PIECE, ((ends[at] - size[at]) // TEXTS + 1) * TEXTS)
                to = max(at + 1, int(np.searchsorted(ends - size, last, "left")))
                block = task + int(ends[at] - size[at]) // TEXTS
                yield pa.record_batch([pa.array([block]), pa.array([_closed_up(batch.slice(at, to - at))], pa.binary())], ["block", "rows"])
                at = to
            before = int(ends[-1]) if len(ends) else before
        release()

    return docs.mapInArrow(run, "block bigint, rows binary").repartition("block")


def asked(texts: DataFrame) -> DataFrame:
    """block, kind and key of every distinct run, context and word of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list] = {}

        def closed(block: int) -> Iterator[pa.RecordBatch]:
            for kind, parts in enumerate(zip(*open_.pop(block))):
                keys = np.unique(np.concatenate(parts)).view(np.int64)
                for at in range(0, len(keys), 1 << 16):
                    some = keys[at : at + (1 << 16)]
                    yield pa.record_batch([pa.array(np.full(len(some), block)), pa.array(np.full(len(some), kind, np.int32)), pa.array(some)], ["block", "kind", "key"])

        for batch in batches:
            for block, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                for _, data, begin in blocks(_opened([piece]), "text"):
                    stream, _, a, b = _stream(data, begin)
                    runs = _runs(stream)
                    runs = np.unique(runs[_within(a, b, len(runs))])
                    starts, ends, _ = spans(stream, np.array([0, len(stream)]), ALNUM)
                    items = runs, np.unique(runs >> np.uint64(8)), np.unique(hashes(stream, starts, ends))
                    held = open_.setdefault(block, [])
                    held.append(items)
                    if len(held) >= 16:  # what repeats is kept once
                        open_[block] = [tuple(np.unique(np.concatenate(parts)) for parts in zip(*held))]
        for block in list(open_):
            yield from closed(block)

    return texts.mapInArrow(run, "block bigint, kind int, key bigint")


def _best(total: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The largest mean over ``n`` neighbours of every stretch a..b, from running sums; a
    shorter stretch is one passage, filled up with nothing."""
    best = (total[b] - total[a]) / n
    long = np.flatnonzero(b - a > n)
    if len(long):
        edges = np.stack([a[long], b[long] - n + 1], axis=1).reshape(-1)
        best[long] = np.maximum.reduceat(np.append(total[n:] - total[:-n], -np.inf), edges)[::2] / n
    return best


def features(docs: DataFrame, runs: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id and the evidence of every whole text, in nats per byte and per word; 0 for a text
    without words."""
    n = words.agg(*[F.sum(f"n{i}") for i in (0, 1)], *[F.count_if(F.col(f"n{i}") > 0) for i in (0, 1)]).first()
    seen = [max(n[i] or 0, 1) for i in (0, 1)]
    left = [max(DISCOUNT * n[2 + i] / seen[i], 1e-9) for i in (0, 1)]
    texts = in_blocks(docs)
    found = asked(texts).join(known_items(runs, words), ["kind", "key"]).select("block", "kind", "key", "one", "two")

    def score(_, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        kind = theirs.column("kind").to_numpy()
        tables = []
        for k in (RUNS, CONTEXTS, WORDS):
            part = np.flatnonzero(kind == k)
            keys, first = np.unique(theirs.column("key").to_numpy()[part].view(np.uint64), return_index=True)
            tables.append((keys, *[theirs.column(c).to_numpy()[part[first]].astype(np.float64) for c in ("one", "two")]))

        def looked_up(k: int, keys: np.ndarray, absent: tuple[float, float]) -> tuple[np.ndarray, ...]:
            known, *values = tables[k]
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            return tuple(np.where(hit, v[at] if len(v) else 0.0, x) for v, x in zip(values, absent))

        out = []
        for rows, data, begin in blocks(_opened(ours.column("rows")), "text"):
            stream, at, a, b = _stream(data, begin)
            every, back = np.unique(_runs(stream), return_inverse=True)
            ratio, shared = looked_up(RUNS, every, (np.nan, RARE))
            new = np.flatnonzero(np.isnan(ratio))
            ratio[new] = looked_up(CONTEXTS, every[new] >> np.uint64(8), (0.0, 0.0))[0]
            total = np.concatenate([[0.0], np.cumsum(ratio[back])])
            columns = [(total[b] - total[a]) / np.maximum(b - a, 1), *[_best(total, a, b, m) for m in PASSAGES]]

            # a word's bytes under the shared model: the runs of its text that end within it or just
            # behind it; what the beginning of the text lacks counts as rare
            plain = np.concatenate([[0.0], np.cumsum(shared[back])])
            starts, ends, _ = spans(stream, np.array([0, len(stream)]), ALNUM)
            first = np.searchsorted(starts, at)
            last = np.searchsorted(starts, np.append(at[1:], len(stream)))
            owner = np.repeat(np.arange(len(at)), last - first)
            here = np.clip(starts - RUN + 1, a[owner], b[owner])
            there = np.clip(ends - RUN + 2, a[owner], b[owner])
            lacking = np.maximum(a[owner] - (starts - RUN + 1), 0)
            usual = np.exp(np.clip(plain[there] - plain[here] + RARE * lacking, -40, 0))
            n = looked_up(WORDS, hashes(stream, starts, ends), (0.0, 0.0))
            p = [np.maximum(n[i] - DISCOUNT, 0) / seen[i] + left[i] * usual for i in (0, 1)]
            often = n[0] + n[1]
            gain = (np.log(p[1]) - np.log(p[0])) * (often / (often + TRUST))
            total = np.concatenate([[0.0], np.cumsum(gain)])
            columns += [(total[last] - total[first]) / np.maximum(last - first, 1), *[_best(total, first, last, m) for m in WORD_PASSAGES]]
            out.append(pa.record_batch([rows.column(0), *[pa.array(c) for c in columns]], names))
        return pa.Table.from_batches(out) if out else empty()

    names = ["doc_id", *FEATURES]
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def empty() -> pa.Table:
        return pa.table([pa.array([], id_type), *[pa.array([], pa.float64()) for _ in FEATURES]], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def fit(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method with a slight pull to zero: weights, constant,
    and the mean and spread by which the inputs are put on one scale."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    pull = np.full(z.shape[1], 1.0)
    pull[-1] = 1e-3
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (y - p) - pull * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1]), mean, spread


def _part(column: str, of: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(of))


def held_out(doc_id: str) -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(_part(doc_id, 5) == 0, F.lit(False))


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row of ``docs``.

    Null and empty texts have no evidence and get the score of that.  Labels other than 0 and 1
    are ignored; a doc_id with both counts as toxic.  Without a row of either class in the
    labels the score is 0 for every text.  Repeated rows repeat; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    given = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("toxic")).where("toxic in (0, 1)").where(~held_out("id"))
    given = stored(given.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("fits", _part("id", 40) >= 35), "labels")

    wanted = bit_map(given, F.xxhash64("id"), ID_BITS)
    filter_ = spark.sparkContext.broadcast(wanted)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(has_bit(filter_.value, at))).select([1, 2])

    kind = rows.schema["doc_id"].dataType.simpleString()
    hashed = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS)).alias("bit"), "doc_id", "text")
    training = hashed.mapInArrow(labelled, f"doc_id {kind}, text string").join(given.where("not fits"), F.col("doc_id") == F.col("id")).select("text", "toxic")
    training = stored(training, "training", compression="zstd")
    runs = stored(run_counts(training), "runs")
    words = stored(word_counts(training), "words")
    discarded(training)
    evidence = features(rows, runs, words)
    discarded(runs)  # what texts ask for is a table of its own by now
    discarded(words)
    evidence = stored(evidence, "evidence")

    # about as many rows as are wanted, so that no task offers more than its share
    share = min(1.0, 1.2 * FIT_ROWS / max(1, given.where("fits").count()))
    sample = (
        evidence.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).join(given, F.col("doc_id") == F.col("id")).where("fits")
        .orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select(*FEATURES, "toxic").toPandas()
    )
    y = sample["toxic"].to_numpy(float)
    score = F.lit(0.0)
    if 0 < y.sum() < len(y):
        weights, constant, mean, spread = fit(sample[FEATURES].to_numpy(float), y)
        z = F.lit(constant)
        for name, w, m, s in zip(FEATURES, weights, mean, spread):
            z = z + (F.col(name) - float(m)) * float(w / s)
        score = 1 / (1 + F.exp(-z))
    out = evidence.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score"), *FEATURES)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
