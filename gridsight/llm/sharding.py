"""Shards by jump consistent hashing: no ring table, and a new shard takes rows only for itself.

The hash of a key walks through the shard counts at which the key would move: from shard b it
jumps to floor((b + 1) / r) with the next pseudo-random r of the key, and stays at the last b
below the number of shards.  All of it is Spark SQL; the 64-bit generator runs on decimals,
because whole-number products may not overflow.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .shared import stored, table

FACTOR = "2862933555777941757"
TWO_64 = "18446744073709551616"
#: Jumps that are followed.  A key makes about ln(shards) of them; 128 are never used up.
MAX_JUMPS = 128
#: Numbering groups per shard: what one task numbers is a 4096th of a shard.
SLOT_GROUPS = 4096
SHARDS = 16


def jump_shards(key: Column, shards: int) -> Column:
    """A struct of the shard among ``shards`` and the shard among one more (``grown``).

    ``key`` is a whole number; a null key counts as 0.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(
        F.pmod(F.coalesce(key, F.lit(0)).cast("decimal(38,0)"), F.lit(TWO_64).cast("decimal(20,0)")).cast("decimal(20,0)").alias("k"),
        F.lit(0).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("grown"),
        F.lit(0).cast("double").alias("j"),
    )

    def step(s: Column, _: Column) -> Column:
        k = F.pmod(s["k"] * F.lit(FACTOR).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"), F.lit(TWO_64).cast("decimal(20,0)")).cast("decimal(20,0)")
        here = s["j"].cast("bigint")
        # (k >> 33) + 1 lies in 1 .. 2**31
        top = F.floor(k / F.lit("8589934592").cast("decimal(10,0)")).cast("double") + 1.0
        moved = F.struct(
            k.alias("k"),
            F.when(s["j"] < shards, here).otherwise(s["shard"]).alias("shard"),
            here.alias("grown"),
            F.floor((s["j"] + 1.0) * (F.lit(2147483648.0) / top)).cast("double").alias("j"),
        )
        return F.when(s["j"] < shards + 1, moved).otherwise(s)

    jumps = F.sequence(F.lit(1), F.lit(min(shards + 1, MAX_JUMPS)))
    return F.aggregate(jumps, start, step, lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def with_slots(rows: DataFrame, shard: str, order: list[str], groups: int = SLOT_GROUPS) -> DataFrame:
    """``rows`` with ``slot``: their number within the shard, from 0 without a gap.

    Equal rows are counted before the shuffle, so a row that repeats a million times is one row
    to number.  Rows are numbered in hash groups of a shard; only the groups' sizes (at most
    ``groups`` per shard) are summed across the shard.
    """
    keys = list(dict.fromkeys([shard, *order, *rows.columns]))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # written once: the sizes and the numbering both read these short rows, not the texts again
    counted = stored(counted.withColumn("_g", F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int")), "slots")
    within = W.partitionBy(shard, "_g")
    sizes = counted.groupBy(shard, "_g").agg(F.sum("_n").alias("_size"))
    first = sizes.select(F.col(shard), "_g", (F.sum("_size").over(W.partitionBy(shard).orderBy("_g")) - F.col("_size")).alias("_first"))
    local = F.sum("_n").over(within.orderBy(*order, *[k for k in keys if k not in order]).rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    placed = counted.withColumn("_local", local).join(first.withColumnsRenamed({shard: "_s", "_g": "_h"}), (F.col(shard) == F.col("_s")) & (F.col("_g") == F.col("_h")))
    at = F.col("_first") + F.col("_local")
    return placed.select(*rows.columns, F.explode(F.sequence(at, at + F.col("_n") - 1)).alias("slot"))


def shard_table(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Where every row of ``docs`` goes; other columns are ignored, whatever their names.

    A null text has no bytes: size 1 and checksum 0.  A null key is hashed as 0.  Rows of one
    key lie in one shard; equal rows lie in consecutive slots.  An empty table gives no rows.
    """
    known = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = known.withColumn("_at", jump_shards(F.col("doc_id"), shards)).select(
        "*", F.col("_at.shard").alias("shard"), F.col("_at.grown").alias("grown_shard")
    ).drop("_at")
    out = with_slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", rows_per_file: int = 1_000_000) -> None:
    """The documents themselves as Parquet files, one folder ``shard=N`` per shard.

    The shuffle spreads a shard over as many tasks as its share of the partitions asks for.
    """
    placed = docs.withColumn("shard", jump_shards(F.col(key), shards)["shard"])
    placed.repartition(F.col("shard"), F.pmod(F.xxhash64(key), F.lit(64))).write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(table(spark, sf_dir, "documents"))
