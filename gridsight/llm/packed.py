"""Token ids as files of fixed-width bit-packed numbers, read back whole or from any place.

A token takes the fewest bits that hold every id of the vocabulary.  64 ids are one group of
``width`` 64-bit words, 1,024 groups are a block; so an id's place follows from its number, and a
block is packed and unpacked by whole-array shifts.  A file holds

    magic | blocks | ids of its documents, which are null, where each begins | block offsets | lengths, magic

and a folder's ``manifest.json`` lists its files in order with the number of ids before each.
Files are written through Spark's data source interface: a task writes under a name of its own
attempt, and only files that the finished write lists in the manifest are read, so a lost
executor or a second attempt leaves nothing that counts.
"""

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .shared import folder, table
from .words import flat, release

MAGIC = b"PACKIDS1"
#: Ids in a block, and ids after which a task begins a new file (at the next document).
BLOCK, FILE_IDS = 1 << 16, 1 << 26
#: Bytes of text encoded at once, and ids that a reader hands over at once.
TEXTS, BATCH_IDS = 1 << 22, 1 << 19
#: Pieces of text that a worker remembers per generation; longer ones than this are not kept.
MEMORY, LONG = 400_000, 200
MANIFEST = "manifest.json"
#: White space: the bytes that are characters of their own, and those of two or three bytes.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
LETTER, SIGN = np.zeros(256, bool), np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
SIGN[33:48] = SIGN[58:65] = SIGN[91:97] = SIGN[123:127] = True
WIDE_SPACE = [c.encode() for c in map(chr, range(128, 0x3001)) if c.isspace()]
SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


# -- packing


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to ``vocabulary`` - 1 (at most 32)."""
    if not 1 <= vocabulary <= 1 << 32:
        raise ValueError("a vocabulary has 1 to 2**32 ids")
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in groups of 64, each ``width`` words of 64 bits; the last group is filled with 0."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit into {width} bits")
    groups = -(-len(ids) // 64)
    rows = np.zeros((64, groups), np.uint64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    rows[:] = padded.reshape(groups, 64).T
    out = np.zeros((width, groups), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= rows[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= rows[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    """The first ``n`` ids of packed groups, as unsigned 32-bit numbers."""
    words = np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, width).T)
    mask = np.uint64((1 << width) - 1)
    rows = np.empty((64, words.shape[1]), np.uint32)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        got = words[word] >> np.uint64(shift)
        if shift + width > 64:
            got = got | (words[word + 1] << np.uint64(64 - shift))
        rows[i] = got & mask
    return np.ascontiguousarray(rows.T).reshape(-1)[:n]


# -- files


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


class FileWriter:
    """One file; ids come document by document and leave memory block by block."""

    def __init__(self, system: pafs.FileSystem, path: str, width: int) -> None:
        self.out, self.path, self.width = system.open_output_stream(path), path, width
        self.out.write(MAGIC)
        self.held, self.n_held, self.n_ids = [], 0, 0
        self.docs, self.begins, self.offsets, self.at = [], [], [len(MAGIC)], len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.begins.append(self.n_ids)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= 16 * BLOCK:
            self._flush(self.n_held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for i in range(0, n, BLOCK):
            data = pack(ids[i : min(i + BLOCK, n)], self.width)
            self.out.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.held, self.n_held = [ids[n:].copy()], len(ids) - n

    def close(self) -> dict:
        self._flush(self.n_held)
        null = np.array([d is None for d in self.docs], np.uint8)
        for part in (
            np.array([d or 0 for d in self.docs], "<i8"), null,
            np.array(self.begins + [self.n_ids], "<u8"), np.array(self.offsets, "<u8"),
            np.array([self.at, len(self.docs), len(self.offsets) - 1, self.n_ids, self.width], "<u8"),
        ):
            self.out.write(part.tobytes())
        self.out.write(MAGIC)
        self.out.close()
        return {"file": os.path.basename(self.path), "ids": self.n_ids, "docs": len(self.docs)}


class FileReader:
    """The tables of one file, and its ids from any place to any place."""

    def __init__(self, system: pafs.FileSystem, path: str) -> None:
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self._bytes(size - 48, 48)
        if tail[40:] != MAGIC:
            raise ValueError(f"{path} is not a whole file of packed ids")
        at, docs, blocks, self.n_ids, self.width = np.frombuffer(tail[:40], "<u8").astype(np.int64).tolist()
        data = self._bytes(at, size - 48 - at)
        self.docs = np.frombuffer(data, "<i8", docs)
        self.null = np.frombuffer(data, np.uint8, docs, 8 * docs).astype(bool)
        self.begins = np.frombuffer(data[9 * docs :], "<u8", docs + 1).astype(np.int64)
        self.offsets = np.frombuffer(data[17 * docs + 8 :], "<u8", blocks + 1).astype(np.int64)

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids ``start`` to ``stop`` of this file; only their blocks are read."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last, out = start // BLOCK, (stop - 1) // BLOCK, []
        data = self._bytes(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        for b in range(first, last + 1):
            piece = data[self.offsets[b] - self.offsets[first] : self.offsets[b + 1] - self.offsets[first]]
            out.append(unpack(piece, min(BLOCK, self.n_ids - b * BLOCK), self.width))
        return np.concatenate(out)[start - first * BLOCK : stop - first * BLOCK]


def manifest(path: str) -> dict:
    system, place = _filesystem(path)
    with system.open_input_file(f"{place}/{MANIFEST}") as f:
        return json.loads(f.read())


def read_ids(path: str, start: int, n: int) -> np.ndarray:
    """``n`` ids of a folder from id number ``start`` on: random access without Spark."""
    system, place = _filesystem(path)
    out = [np.zeros(0, np.uint32)]
    for f in manifest(path)["files"]:
        a, b = max(start, f["start"]), min(start + n, f["start"] + f["ids"])
        if a < b:
            out.append(FileReader(system, f"{place}/{f['file']}").ids(a - f["start"], b - f["start"]))
    return np.concatenate(out)


# -- Spark data source


class Written(WriterCommitMessage):
    def __init__(self, partition: int, files: list[dict]) -> None:
        self.partition, self.files = partition, files


class PackedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, vocabulary: int) -> None:
        self.path, self.vocabulary = path, vocabulary

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, place = _filesystem(self.path)
        system.create_dir(place, recursive=True)
        partition, width = TaskContext.get().partitionId(), bits_for(self.vocabulary)
        attempt, files, writer = uuid.uuid4().hex, [], None
        for batch in iterator:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if writer is not None and writer.n_ids >= FILE_IDS:
                    files.append(writer.close())
                    writer = None
                if writer is None:
                    writer = FileWriter(system, f"{place}/part-{partition:06d}-{len(files):04d}-{attempt}.ids", width)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), "<u4") if ids.is_valid else np.zeros(0, np.uint32))
        if writer is not None:
            files.append(writer.close())
        release()
        return Written(partition, files)

    def commit(self, messages: list[Written]) -> None:
        system, place = _filesystem(self.path)
        files, start = [], 0
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            for f in message.files:
                files.append(f | {"start": start})
                start += f["ids"]
        system.create_dir(place, recursive=True)
        head = {"vocabulary": self.vocabulary, "bits": bits_for(self.vocabulary), "block": BLOCK, "ids": start, "files": files}
        with system.open_output_stream(f"{place}/{MANIFEST}.new") as f:
            f.write(json.dumps(head).encode())
        system.move(f"{place}/{MANIFEST}.new", f"{place}/{MANIFEST}")

    def abort(self, messages: list[Written]) -> None:
        """Without a manifest nothing of the folder is read."""


class OneFile(InputPartition):
    def __init__(self, file: str, start: int) -> None:
        self.file, self.start = file, start


class PackedReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[OneFile]:
        return [OneFile(f["file"], f["start"]) for f in manifest(self.path)["files"]]

    def read(self, partition: OneFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None or not isinstance(partition, OneFile):  # a folder without files
            return
        system, place = _filesystem(self.path)
        file, at = FileReader(system, f"{place}/{partition.file}"), 0
        while at < len(file.docs):
            to = max(at + 1, int(np.searchsorted(file.begins, file.begins[at] + BATCH_IDS, "right")) - 1)
            begins = file.begins[at : to + 1]
            data = file.ids(int(begins[0]), int(begins[-1]))
            offsets = pa.py_buffer(((begins - begins[0]) * 4).astype(np.int32))
            yield pa.record_batch([
                pa.array(file.docs[at:to], pa.int64(), mask=file.null[at:to]),
                pa.array(begins[:-1] + partition.start, pa.int64()),
                pa.array(np.diff(begins), pa.int64()),
                pa.Array.from_buffers(pa.binary(), to - at, [None, offsets, pa.py_buffer(data.astype("<u4"))]),
            ], ["doc_id", "start", "n_tokens", "ids"])
            at = to
        release()


class PackedIds(DataSource):
    """Format ``packed_ids``: write (doc_id, ids), read (doc_id, start, n_tokens, ids)."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> PackedWriter:
        return PackedWriter(self.options["path"], int(self.options["vocabulary"]))

    def reader(self, schema) -> PackedReader:
        return PackedReader(self.options["path"])


# -- documents


def cuts(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin: at every text that is not empty; at every blank, and before
    and after every line end, that stands alone between two characters that are no white space;
    and between an ASCII letter and what is an ASCII sign.

    There the pattern of a byte-level vocabulary cuts whatever stands around, and it looks at
    nothing further back, so pieces may be encoded one by one.
    """
    first = np.zeros(len(data) + 1, bool)
    first[begin[:-1][np.diff(begin) > 0]] = True
    inner = ~first[:-1]
    at = np.flatnonzero(((data == 32) | (data == 10)) & inner)
    at = at[(at + 1 < len(data)) & ~first[np.minimum(at + 1, len(data))]]
    at = at[~SPACE[data[at - 1]] & ~SPACE[data[at + 1]]]
    # white space beyond ASCII: two or three bytes
    far = np.flatnonzero((data[at - 1] >= 128) | (data[at + 1] >= 128))
    if len(far):
        padded = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)])
        spot, odd = at[far] + 3, np.zeros(len(far), bool)
        for white in WIDE_SPACE:
            odd |= np.logical_and.reduce([padded[spot - len(white) + i] == c for i, c in enumerate(white)])
            odd |= np.logical_and.reduce([padded[spot + 1 + i] == c for i, c in enumerate(white)])
        at = np.delete(at, far[odd])
    first[1:-1] |= LETTER[data[:-1]] & SIGN[data[1:]]
    first[at] = True
    first[at[data[at] == 10] + 1] = True
    return np.flatnonzero(first[:-1])


class Encoder:
    """A tokenizer of the tokenizers library with a memory of pieces of texts.

    Pieces of a block of texts are numbered without a loop over them; every piece not seen lately
    is encoded by the library, and the ids of a text are those of its pieces.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_str(definition)
        self.tool.encode_special_tokens = True
        # in a byte-level vocabulary the letter for a blank is the one that follows 255 others
        self.blank = np.zeros(self.tool.get_vocab_size(), bool)
        self.blank[[i for t, i in self.tool.get_vocab().items() if t[0] == chr(256 + 32)]] = True
        self.line = self.tool.encode("\n").ids[0]
        # two generations, so that frequent pieces stay when the memory is full
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces, many in a row where a token tells where the next one begins: one that
        begins with a blank, or a line end put between pieces without white space."""
        kinds: tuple[list, list, list] = [], [], []
        for p in pieces:
            t = p.decode()
            parts = t.split()
            alone = len(parts) == 1
            kinds[0 if alone and t == " " + parts[0] else 1 if alone and t == parts[0] else 2].append((p, t))
        out = {}
        for kind, between in ((0, ""), (1, "\n")):
            rows = [kinds[kind][i : i + 100] for i in range(0, len(kinds[kind]), 100)]
            for i in range(0, len(rows), 100):
                part = rows[i : i + 100]
                for row, x in zip(part, self.tool.encode_batch_fast([between.join([t for _, t in r]) for r in part], add_special_tokens=False)):
                    ids = np.array(x.ids, "<u4")
                    raw, edge = ids.tobytes(), np.flatnonzero(ids == self.line if kind else self.blank[ids])
                    ends = np.append(edge if kind else edge[1:], len(ids)) * 4
                    starts = (np.concatenate([[0], edge + 1]) if kind else edge) * 4
                    out.update(zip([p for p, _ in row], [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())], strict=True))
        got = self.tool.encode_batch_fast([t for _, t in kinds[2]], add_special_tokens=False)
        out.update((p, np.array(x.ids, "<u4").tobytes()) for (p, _), x in zip(kinds[2], got))
        return out

    def encode(self, texts: pa.Array, end_id: int | None = None) -> pa.Array:
        """The ids of every text as little-endian 32-bit numbers; a null text is empty."""
        data, begin = flat(texts)
        starts = cuts(data, begin) if len(data) else np.zeros(0, np.int64)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)])
        coded = pc.dictionary_encode(pieces)
        distinct = coded.dictionary.to_pylist()
        known, older = self.known, self.older
        ids = list(map(known.get, distinct))
        lost = [i for i, x in enumerate(ids) if x is None]
        found = {distinct[i]: older[distinct[i]] for i in lost if distinct[i] in older}
        found |= self._learn([p for i in lost if (p := distinct[i]) not in found])
        for i in lost:
            ids[i] = found[distinct[i]]
        known.update((p, x) for p, x in found.items() if len(p) <= LONG)
        if len(known) > MEMORY:
            self.known, self.older = {}, known
        # the ids of all pieces in their order, and the end id as one more piece of every text
        ids.append(b"" if end_id is None else np.array([end_id], "<u4").tobytes())
        size = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
        all_ids, spot = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size, dtype=np.int32) - size
        close = np.searchsorted(starts, begin[1:])
        which = np.insert(coded.indices.to_numpy(zero_copy_only=False), close, len(ids) - 1)
        count = size[which]
        ends = np.cumsum(count, dtype=np.int32)
        place = np.repeat(spot[which] - (ends - count), count)
        place += np.arange(len(place), dtype=np.int32)
        offsets = np.concatenate([[0], ends[close + np.arange(len(texts))] * 4]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(all_ids[place])])


#: The encoder of a worker process, kept for the tasks that follow.
_encoders: dict[str, Encoder] = {}


def _encoder(definition: str) -> Encoder:
    if definition not in _encoders:
        _encoders.clear()
        _encoders[definition] = Encoder(definition)
    return _encoders[definition]


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """doc_id and ids (little-endian 32-bit numbers in one binary value, ``end_id`` last), row by row.

    ``tokenizer`` is a file of the tokenizers library with a byte-level vocabulary and nothing
    that changes a text before (other files are refused).  A null text is an empty one: only the
    end id.  Special tokens are not added, and their names in a text are ordinary text.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    parts = json.loads(definition)
    before = parts.get("pre_tokenizer") or {}
    if parts.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("a byte-level vocabulary without changes to the text is needed")
    setup = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tool = _encoder(setup.value)
        for batch in batches:
            ends = np.cumsum(batch.column(2).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(batch):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXTS, "right")))
                got = tool.encode(batch.column(1).slice(at, to - at), end_id)
                yield pa.record_batch([batch.column(0).slice(at, to - at), got], ["doc_id", "ids"])
                at = to
        release()

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), body.alias("text"), F.octet_length(body).alias("size"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def write_packed(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """The ids of all documents in ascending doc_id order as packed files below ``path``.

    Null doc_ids come first; rows of one doc_id follow each other by a hash of their text, then by
    their place in the input.  Texts are dealt by ranges of all three, so one doc_id with a third
    of the rows is cut into many ranges; each range is sorted, encoded and written by one task.
    An empty table gives a manifest without files; other columns are ignored.
    """
    docs.sparkSession.dataSource.register(PackedIds)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = rows.select("*", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_m"))
    dealt = keyed.repartitionByRange("doc_id", "_h", "_m").sortWithinPartitions("doc_id", "_h", "_m")
    encoded(dealt, tokenizer).write.format("packed_ids").option("path", path).option("vocabulary", vocabulary).mode("append").save()


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document written."""
    spark.dataSource.register(PackedIds)
    return spark.read.format("packed_ids").option("path", path).load()


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tokenizers import Tokenizer

    name = public_tokenizers.path("byte_bpe_50k.json")
    path = folder(spark, "packed")
    write_packed(table(spark, sf_dir, "documents"), path, name, Tokenizer.from_file(name).get_vocab_size())
    return read_packed(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
