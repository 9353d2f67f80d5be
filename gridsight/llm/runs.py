"""Runs (maximal stretches of words that repeat with a period) by string synchronising sets.

All texts of a block are one sequence of word numbers; a number of its own stands after every
text, so nothing reaches from one text into the next.  At the scale t = 8, 16, 32, ... a position
is synchronising if the least hash among the windows of t words that begin at it or at one of the
next t positions is its own or that of the last of them.  Windows inside a region with a period
of at most t / 4 are left out: such regions are the runs that the smaller scales found.  Whether a
position is chosen depends on the 2t words after it alone, and every run with a period p of
t <= p < 2t and a length of 4p holds a chosen position i and with it i + p, whose 2t words are
equal.  So neighbouring positions of equal context propose their distance as a period, and every
proposal is extended by comparing words.  Periods below 8, which all scales leave out, are found
by comparing the sequence with itself.  Hashes only propose; what is reported was compared.  (A run
could be missed only if two different contexts within 2t words had one 63-bit hash, mixed anew at
every scale.)
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import table
from .words import NOT_SPACE, flat, mix, release, spans

#: Words and periods that a run repeats at least.
LEAST, TIMES = 6, 4
#: The first scale; smaller periods are found by direct comparison.
SCALE = 8
#: Bytes of text worked on at once; a longer text is a block of its own.
BLOCK = 1 << 20
SCHEMA = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string, n_words bigint"


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima within pieces of that width."""
    n = len(x) - width + 1
    pad = -len(x) % width
    rows = np.concatenate([x, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _reach(x: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from ``at`` on (backwards for ``step`` -1) equal those ``period`` later."""
    n, piece = 0, 64
    while True:
        if step > 0:
            one = x[at + n : min(at + n + piece, len(x) - period)]
        else:
            one = x[max(0, at - n - piece + 1) : max(0, at - n + 1)]
        if not len(one):
            return n
        first = at + n if step > 0 else at - n - len(one) + 1
        differs = one != x[first + period : first + period + len(one)]
        if differs.any():
            return n + int(differs.argmax() if step > 0 else differs[::-1].argmax())
        n += len(one)
        piece *= 2


def _proposals(x: np.ndarray, begin: np.ndarray, found: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(first position, last position, period) of chosen positions with equal contexts.

    ``begin`` has the start of every text in ``x`` (one more entry than texts).  ``found`` are the
    runs so far, as arrays of (start, end, period); it may grow while this runs.
    """
    size, place = np.diff(begin), np.arange(len(x))
    level = mix(x.astype(np.uint64) + np.uint64(1)) >> np.uint64(1)  # of windows of ``t`` words
    t = 1
    while True:
        if t >= SCALE:
            # texts with fewer than 4t words and all that belongs to them are no longer needed
            keep = size > TIMES * t
            if not keep.any():
                return
            if not keep.all():
                held = np.repeat(keep, size)
                x, place, level = x[held], place[held], level[held[: len(level)]]
                size = size[keep]
            longer = _doubled(level, t)
            n = len(x) - 2 * t + 1  # positions with a whole context
            periodic = np.zeros(len(x) + 1, np.int64)
            spots = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            spots = spots[spots[:, 2] * 4 <= t]
            spots = spots[spots[:, 1] - spots[:, 0] >= t]
            if len(spots):
                a = np.searchsorted(place, spots[:, 0])
                b = a + (spots[:, 1] - spots[:, 0]) - t + 1
                kept = place[np.minimum(a, len(x) - 1)] == spots[:, 0]
                np.add.at(periodic, a[kept], 1)
                np.add.at(periodic, b[kept], -1)
            out = np.cumsum(periodic)[: len(level)] > 0
            values = np.where(out, ~np.uint64(0), level)
            best = _least(values, t + 1)[:n]
            chosen = (best != ~np.uint64(0)) & ((values[:n] == best) | (values[t : t + n] == best))
            at = np.flatnonzero(chosen)
            context = longer[at]
            order = np.lexsort((at, context))
            one, two = at[order[:-1]], at[order[1:]]
            period = two - one
            good = (context[order[:-1]] == context[order[1:]]) & (period >= t) & (period < 2 * t)
            one, period = one[good], period[good]
            order = np.lexsort((one, period))
            one, period = one[order], period[order]
            if len(one):
                # within a run the chosen positions lie less than t apart: they are one proposal
                cut = np.flatnonzero((np.diff(period) != 0) | (np.diff(one) > t)) + 1
                first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(one)]]) - 1
                yield from zip(place[one[first]].tolist(), place[one[last]].tolist(), period[first].tolist())
            level = longer
        else:
            level = _doubled(level, t)
        t *= 2
        if len(x) < 2 * t:
            return


def _doubled(level: np.ndarray, t: int) -> np.ndarray:
    """Hashes of the windows of 2t words, from those of t words."""
    return mix(level[: max(0, len(level) - t)] * np.uint64(0x9E3779B97F4A7C15) + level[t:]) >> np.uint64(1)


def runs_of(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """All runs of the texts x[begin[i] : begin[i + 1]] as rows of (start, end, period), sorted.

    The last entry of every text must be a number that occurs nowhere else.
    """
    found = []
    for p in range(1, min(SCALE, len(x))):
        a, b = _stretches(x[:-p] == x[p:])
        good = b - a + p >= max(LEAST, TIMES * p)
        found.append(np.stack([a[good], b[good] + p, np.full(good.sum(), p)], axis=1).astype(np.int64))
    seen: set[tuple[int, int]] = set()
    for first, last, p in _proposals(x, begin, found):
        # a stretch is known by its end and period: several groups may lie in one run
        start = first - _reach(x, first - 1, p, -1) if first else 0
        if (start, p) in seen:
            continue
        seen.add((start, p))
        end = last + _reach(x, last, p, 1) + p
        if end - start >= TIMES * p:
            found.append(np.array([[start, end, p]], np.int64))
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    # of one stretch the smallest period; its multiples were found as well
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _block(column: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Runs, collapsed text and number of words of every text of a column."""
    data, at = flat(column)
    starts, ends, count = spans(data, at, NOT_SPACE)
    length, texts = ends - starts, len(column)
    letters = data[NOT_SPACE[data]] if len(data) else data
    if int(length.sum()) >= 1 << 31:
        raise ValueError("a text of 2 GB or more")
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.py_buffer(letters)])
    # exact numbers of equal words; every text ends in a number of its own
    number = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    stop = np.cumsum(count + 1) - 1
    x = np.empty(len(number) + texts, np.int64)
    is_word = np.ones(len(x), bool)
    is_word[stop] = False
    x[is_word], x[stop] = number, len(number) + np.arange(texts)
    begin = np.concatenate([[0], stop + 1])
    runs = runs_of(x, begin)
    owner = np.searchsorted(stop, runs[:, 0])
    fields = [pa.array(runs[:, 0] - begin[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    # words after the first period of a run go; the others follow each other with one blank
    change = np.zeros(len(x) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = (np.cumsum(change)[:-1] == 0)[is_word]
    text = np.repeat(np.arange(texts), count)[kept]
    size = length[kept] + 1
    spot = np.cumsum(size) - size
    out = np.full(int(size.sum()), 32, np.uint8)
    if len(out):
        blank = np.zeros(len(out), bool)
        blank[spot + size - 1] = True
        out[~blank] = letters[np.repeat(kept, length)]
    total = np.bincount(text, weights=size, minlength=texts).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(total)]).tolist()
    raw = out.tobytes()
    collapsed = pa.array([raw[a : max(a, b - 1)].decode() for a, b in zip(edge, edge[1:])], pa.string())
    return lists, collapsed, pa.array(count.astype(np.int64))


def find_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, and of the words of ``text``: ``runs`` (start, length, period; words
    counted from 0; by start, then period), ``collapsed`` (without the words that repeat a run's
    first period) and ``n_words``.

    A run has its smallest period q and max(6, 4q) words at least, and no neighbouring word extends
    it.  A null or empty text, or one of white space, has no words, no runs and an empty collapsed
    text.  Rows are independent: repeated rows repeat, other columns are ignored whatever their
    names, an empty table gives no rows.  A text is worked on as a whole, about 150 bytes of memory
    for each of its words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(size), 0
            while at < len(batch):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
                rows = batch.slice(at, to - at)
                yield pa.record_batch([*rows.columns[1:], *_block(rows.column(0))], [*kept, "runs", "collapsed", "n_words"])
                at = to
        release()

    kept = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(F.col(text).cast("string").alias("t"), *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    schema = "".join(f"{k} {rows.schema[k].dataType.simpleString()}, " for k in kept) + SCHEMA
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(kept, keep)))


def planted(doc_id: Column, text: Column) -> Column:
    """``text`` with a repetition at a place and of a period that follow from ``doc_id``, in every
    tenth document: from word a on, the words a to a + p - 1 repeat.  A null doc_id plants none."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words).cast("bigint")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    # whole slices: an expression that is looked into word by word would be split for each of them
    period = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    repeated = F.concat(F.slice(words, F.lit(1), a.cast("int")), tail)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
