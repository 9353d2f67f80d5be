"""Sums of fixed-size count tables over all tasks, and bit maps, collected with a bounded size."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Cells that travel in one row.
PER_ROW = 4096
SCHEMA = "part int, counts binary"


def packed(total: np.ndarray) -> pa.RecordBatch:
    """The cells of a table that are not zero, in parts: places (16 bits) and values (32 bits)."""
    parts = total.reshape(-1, min(PER_ROW, len(total)))
    kept, out = np.flatnonzero(parts.any(axis=1)), []
    for row in parts[kept]:
        at = np.flatnonzero(row)
        out.append(at.astype(np.uint16).tobytes() + np.minimum(row[at], 2**32 - 1).astype(np.uint32).tobytes())
    return pa.record_batch([pa.array(kept, pa.int32()), pa.array(out, pa.binary())], ["part", "counts"])


def _unpack(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(piece) // 6
    return np.frombuffer(piece, np.uint16, n), np.frombuffer(piece, np.uint32, n, 2 * n)


def summed(parts: DataFrame, cells: int) -> np.ndarray:
    """The table whose packed parts are the rows, added up.

    All rows of a part meet in one task, which adds them one after the other and keeps only the
    sums; the driver gets one table, however many tasks there were.
    """
    width = min(PER_ROW, cells)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, n = _unpack(piece)
                sums.setdefault(part, np.zeros(width, np.int64))[at] += n
        for part, row in sums.items():
            got = packed(row)
            yield pa.record_batch([pa.array([part] * len(got), pa.int32()), got.column(1)], ["part", "counts"])

    out = np.zeros((cells // width, width), np.uint32)
    for part, piece in parts.repartition("part").mapInArrow(add, SCHEMA).collect():
        at, n = _unpack(piece)
        out[part, at] = n
    return out.reshape(-1)


def bit_map(rows: DataFrame, number: Column, bits: int) -> np.ndarray:
    """A map with the bits ``number`` modulo ``bits`` of all rows set."""
    bit = F.pmod(number, F.lit(bits)) + 1
    out = np.zeros(bits // 8, np.uint8)
    for part, piece in rows.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("map")).collect():
        out[(part - 1) * 4096 : part * 4096] = np.frombuffer(piece, np.uint8)
    return out


def has_bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


#: Bits of the filter by which most rows pass without a join (2 MB).
PASS_BITS = 1 << 24


def fresh(name: str, columns: list[str]) -> str:
    """A column name that is not among ``columns``."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def _dealt(docs: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame, str]:
    """Rows that a bit map of ``ids`` does not know, the other rows, and the name under which
    ``ids`` may be joined to these."""
    bit, name = fresh("_bit", docs.columns), fresh("_id", docs.columns)
    kept = docs.sparkSession.sparkContext.broadcast(bit_map(ids, F.xxhash64(ids.columns[0]), PASS_BITS))

    def part(known: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = has_bit(kept.value, batch.column(0).to_numpy(zero_copy_only=False))
                rows = batch.filter(pa.array(hit == known))
                yield pa.record_batch(rows.columns[1:], rows.schema.names[1:])
        return run

    marked = docs.select(F.pmod(F.xxhash64(key), F.lit(PASS_BITS)).alias(bit), *docs.columns)
    return marked.mapInArrow(part(False), docs.schema), marked.mapInArrow(part(True), docs.schema), name


def _named(ids: DataFrame, name: str) -> DataFrame:
    return ids.select(F.col(ids.columns[0]).alias(name)).where(F.col(name).isNotNull())


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id", once: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is none of ``ids``; of the keys in ``once``, one row each.

    A row whose bit is not set is in neither list and goes straight through.  Only the others,
    which are about as many as are named, are joined, so texts that stay are not shuffled.
    """
    named = _named(ids, "id")
    single = _named(once, "id") if once is not None else named.limit(0)
    sure, unsure, name = _dealt(docs, named.union(single), key)
    unsure = unsure.join(_named(named, name).distinct(), F.col(key) == F.col(name), "left_anti")
    if once is None:
        return sure.union(unsure)
    flagged = unsure.join(_named(single, name).distinct(), F.col(key) == F.col(name), "left")
    repeated = flagged.where(F.col(name).isNotNull()).dropDuplicates([key])
    return sure.union(flagged.where(F.col(name).isNull()).select(*docs.columns)).union(repeated.select(*docs.columns))


def among(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` is one of ``ids``."""
    _, unsure, name = _dealt(docs, _named(ids, "id"), key)
    return unsure.join(_named(ids, name).distinct(), F.col(key) == F.col(name), "left_semi")
