"""Byte-level BPE with recursive SQL in every partition.

The distinct words of a batch become rows of (word, place, token).  A recursive DuckDB query joins
neighbouring tokens to the merge table and contracts, in every word, the leftmost pair of the
lowest rank, until no pair of any word is in the table.  Decoding joins the ids to the vocabulary
and puts the pieces of every text together by an ordered aggregation.  Spark deals out the texts;
each task works on blocks of bounded size.
"""

import base64
import hashlib
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import table
from .words import release

#: Bytes of text encoded at once, and words and bytes contracted by one query.
BLOCK, WORDS, WORD_BYTES = 2 << 20, 60_000, 1 << 20
#: Words that a worker remembers between blocks, per generation.
MEMORY = 300_000
#: Parts of words above this length are contracted by the same rule with a heap: a recursive
#: query copies its rows once per merge, so its work would grow with the square of the length.
LONG = 256

CONTRACT = """
WITH RECURSIVE step AS (
  SELECT w, p, t, false AS done FROM start
  UNION ALL
  (WITH pairs AS MATERIALIZED (
    SELECT s.w, s.p, s.t, s.before, (CAST(m.r AS BIGINT) << 40) | s.p AS merge
    FROM (
      SELECT w, p, t, (CAST(t AS BIGINT) << 32) | lead(t) OVER along AS ab, lag(p) OVER along AS before
      FROM step WHERE NOT done WINDOW along AS (PARTITION BY w ORDER BY p)
    ) s LEFT JOIN merges m ON m.ab = s.ab
  ), least_of AS (SELECT w, min(merge) AS best FROM pairs GROUP BY w)
  SELECT s.w, s.p, CASE WHEN s.merge = b.best THEN CAST(b.best >> 40 AS INTEGER) ELSE s.t END, b.best IS NULL
  FROM pairs s JOIN least_of b ON s.w = b.w
  WHERE b.best IS NULL OR s.before IS DISTINCT FROM (b.best & 1099511627775))
)
SELECT w, t FROM step WHERE done ORDER BY w, p
"""
ASSEMBLE = "SELECT d, string_agg(v.piece, '' ORDER BY x.p) AS text FROM tokens x JOIN vocabulary v ON x.t = v.t GROUP BY d"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64, blank, rank per line) by rank."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return [ranks[i] for i in range(len(ranks))]


def merge_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair of tokens that is a token itself, and that token: its rank decides."""
    rank = {t: i for i, t in enumerate(tokens)}
    rows = [(rank[t[:i]], rank[t[i:]], r) for r, t in enumerate(tokens) for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
    return tuple(np.array(c, np.int32) for c in zip(*rows))


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, tokens: list[bytes], merges: tuple[np.ndarray, np.ndarray, np.ndarray], pattern: str) -> None:
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        # two generations, so that frequent words stay when the memory is full
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs = {(int(a), int(b)): int(r) for a, b, r in zip(*merges)}
        # neighbours that no token holds are never joined: a word falls apart between them
        self.joined = np.zeros((256, 256), bool)
        for t in tokens:
            if len(t) > 1:
                x = np.frombuffer(t, np.uint8)
                self.joined[x[:-1], x[1:]] = True
        self.sql = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self._table("merges", ab=merges[0].astype(np.int64) << 32 | merges[1], r=merges[2])
        self._table("vocabulary", t=np.arange(len(tokens), dtype=np.int32), piece=[t.decode("latin-1") for t in tokens])

    def _table(self, name: str, **columns) -> None:
        self.sql.register("_new", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.sql.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM _new")
        self.sql.unregister("_new")

    def _heap(self, part: bytes) -> list[int]:
        """Leftmost lowest-rank contraction of one long part."""
        t, n = [int(self.single[b]) for b in part], len(part)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n + 1)
        heap = [(r, i) for i in range(n - 1) if (r := self.pairs.get((t[i], t[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or self.pairs.get((t[i], t[j])) != r:
                continue
            t[i], gone[j], after[i] = r, 1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (s := self.pairs.get((t[k], t[after[k]]))) is not None:
                    heapq.heappush(heap, (s, k))
        return [x for x, lost in zip(t, gone) if not lost]

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """The ids (little-endian, 32 bits) of words that are no token as a whole."""
        length = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words), dtype=np.int32), length)
        cut = np.ones(len(data), bool)
        cut[1:] = (word[1:] != word[:-1]) | ~self.joined[data[:-1], data[1:]]
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, len(data)))
        part = np.repeat(np.arange(len(first)), size)
        owner = word[first]
        by_heap = {int(i): np.array(self._heap(data[first[i] : first[i] + size[i]].tobytes()), np.int32) for i in np.flatnonzero(size > LONG)}
        asked = (size > 1) & (size <= LONG)
        row = asked[part]
        self._table("start", w=part[row].astype(np.int32), p=(np.arange(len(data)) - np.repeat(first, size))[row], t=self.single[data[row]])
        got = self.sql.sql(CONTRACT).to_arrow_table() if row.any() else None
        parts, ids = [np.flatnonzero(size == 1)], [self.single[data[first[size == 1]]]]
        if got is not None:
            parts.append(got.column("w").to_numpy())
            ids.append(got.column("t").to_numpy())
        for i, found in by_heap.items():
            parts.append(np.full(len(found), i))
            ids.append(found)
        parts, ids = np.concatenate(parts), np.concatenate(ids)
        order = np.argsort(parts, kind="stable")  # within a part the tokens are in order already
        ends = np.cumsum(np.bincount(owner[parts], minlength=len(words))) * 4
        flat = ids[order].astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text as little-endian 32-bit numbers; a null text has none."""
        words = [self.pattern.findall(x) if x else [] for x in texts]
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
        new = set().union(*words).difference(self.known)
        open_words, held = [], 0

        def finish() -> None:
            self.known.update(zip(open_words, self._contract([w.encode() for w in open_words])))
            open_words.clear()

        for w in new:
            if w in self.older:
                self.known[w] = self.older[w]
                continue
            piece = w.encode()
            r = self.rank.get(piece)
            if r is not None:
                self.known[w] = r.to_bytes(4, "little")
                continue
            open_words.append(w)
            held += len(piece)
            if len(open_words) >= WORDS or held >= WORD_BYTES:
                finish()
                held = 0
        if open_words:
            finish()
        known = self.known
        return [b"".join([known[w] for w in ws]) for ws in words]

    def rest(self) -> None:
        """Between tasks only the words that are known stay in memory."""
        self.sql.execute("DROP TABLE IF EXISTS start")
        self.sql.execute("DROP TABLE IF EXISTS tokens")
        release()

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of every row of ids."""
        n = [len(x) // 4 for x in ids]
        if not sum(n):
            return [b""] * len(ids)
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        self._table("tokens", d=np.repeat(np.arange(len(ids), dtype=np.int32), n), p=np.arange(len(flat), dtype=np.int32), t=flat)
        got = self.sql.sql(ASSEMBLE).to_arrow_table()
        out = [b""] * len(ids)
        for d, text in zip(got.column("d").to_pylist(), got.column("text").to_pylist()):
            out[d] = text.encode("latin-1")
        return out


#: One codec per worker process and vocabulary, kept for the tasks that follow.
_codecs: dict[str, Codec] = {}


def _codec(setup: tuple) -> Codec:
    key = setup[0]
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(*setup[1:])
    return _codecs[key]


def _setup(spark: SparkSession, vocabulary: str, pattern: str):
    """What tasks need of the vocabulary (a few MB, fixed by the file), read once by the driver."""
    tokens = read_ranks(vocabulary)
    key = hashlib.sha256(b"\n".join(tokens) + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast((key, tokens, merge_table(tokens), pattern))


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
            yield batch.slice(at, to - at)
            at = to
    release()


def encode(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (little-endian 32-bit numbers in one binary value) of every row.

    A null or empty text has no ids.  Repeated rows repeat; other columns are ignored.
    """
    setup = _setup(docs.sparkSession, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(setup.value)
        for rows in _slices(batches, 1):
            yield pa.record_batch([rows.column(0), pa.array(codec.encode(rows.column(1).to_pylist()), pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(rows: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, ids and data (the bytes that the ids stand for) of every row; null ids are none."""
    setup = _setup(rows.sparkSession, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(setup.value)
        for part in _slices(batches, 1):
            data = codec.decode([x or b"" for x in part.column(1).to_pylist()])
            yield pa.record_batch([part.column(0), part.column(1), pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    known = rows.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    return known.mapInArrow(run, f"doc_id {known.schema['doc_id'].dataType.simpleString()}, ids binary, data binary")


def tokenized(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them."""
    setup = _setup(docs.sparkSession, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(setup.value)
        for part in _slices(batches, 1):
            ids = codec.encode(part.column(1).to_pylist())
            data = codec.decode(ids)
            yield pa.record_batch(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in data])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            release()
        codec.rest()

    # one step for both ways: two would keep two codecs per task
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
