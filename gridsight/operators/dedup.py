"""One row per key.

All forms are ``row_number() = 1``.  With few keys Spark keeps only the best row of a key in every
map task before it shuffles, so a key that holds a third of the rows costs no more than others.
With many keys that sort of whole input splits is dear and saves little: see ``best_per_key``.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridsight import fixed_values as V
from gridsight.functions.text import lookup
from gridsight.operators.joins import frequent_keys

#: Tasks over which the rows of a hot key are spread.
SALTS = 64
#: Binary logarithm of the bits that mark the best grades: half a million rows of 64 bits to broadcast.
BITS = 25


def first_per_key(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """Best row of every key in the given order; NULL keys equal each other."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_n_per_key(df: DataFrame, keys: list, order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows of every key, numbered from 1."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def hot_hash(keys: list[str]) -> Column:
    """What ``best_per_key`` looks for among the hot keys; NULL parts count as absent."""
    return F.xxhash64(*keys)


def _near_best(df: DataFrame, keys: list[str], grade: str) -> DataFrame:
    """Rows of the highest grade of their key, and by chance a few others; a ``grade`` below 0 never counts.

    The highest grades are hash-aggregated, before and after a shuffle of keys and grades only, and
    set one bit each in ``1 << BITS``.  The table of 64 bits a row is broadcast, so rows stay where
    they are.  A key's best row always passes; with more keys than bits so does every other.
    """
    bit = F.xxhash64(*keys, grade).bitwiseAND(F.lit((1 << BITS) - 1))
    best = df.groupBy(*keys).agg(F.max(grade).alias(grade)).where(F.col(grade) >= 0)
    words = best.withColumn("_bit", bit).selectExpr("shiftright(_bit, 6) as _word", "shiftleft(1L, cast(_bit & 63 as int)) as _set")
    words = words.groupBy("_word").agg(F.bit_or("_set").alias("_set"))
    rows = df.withColumn("_bit", bit).withColumn("_at", F.shiftright("_bit", 6))
    met = rows.join(F.broadcast(words), F.col("_at") == F.col("_word"))
    return met.where("(shiftright(_set, cast(_bit & 63 as int)) & 1) = 1").select(*df.columns)


def best_per_key(df: DataFrame, keys: list[str], grade: Column, tie: str, part: list[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """The row of every key with the highest ``grade`` (a bigint), the smallest ``tie`` among equals;
    a key whose grades are all below 0 has none.  For many keys and wide rows.

    No task sorts its input split.  Rows that cannot be the best are dropped first, see
    ``_near_best``, which reads the input twice.  Those left are sorted behind the shuffle, where a
    hash of the key leads, so that texts of different keys are hardly ever compared.

    The rows of a hot key are spread over ``SALTS`` tasks by a hash of ``tie``, and the best of
    these are compared once more.  A key can only be hot if its columns ``part`` are: these are
    sketched, in one pass; ``hot`` (``frequent_keys`` of ``hot_hash(part)`` named ``_part``) spares it.
    Which keys count as hot changes no result.
    """
    marked = df.withColumns({"_part": hot_hash(part or keys), "_grade": grade})
    hot = frequent_keys(marked.select("_part"), ["_part"]) if hot is None else hot.where("key = '_part'")
    often = F.broadcast(hot.select(F.col("hash").alias("_often")).distinct())
    salt = F.when(F.col("_often").isNull(), 0).otherwise(F.pmod(F.xxhash64(tie), F.lit(SALTS)))
    near = _near_best(marked, keys, "_grade")
    rows = near.join(often, F.xxhash64("_part") == F.col("_often"), "left").withColumns({"_key": F.xxhash64(*keys), "_salt": salt})
    order = [F.desc("_grade"), F.asc(tie)]
    parts = first_per_key(rows.drop("_part", "_often").repartition("_key", "_salt"), ["_key", "_salt", *keys], order)
    whole = first_per_key(parts, ["_key", *keys], order)
    return whole.where("_grade >= 0").drop("_key", "_salt", "_grade")


def keep_best_quality(
    df: DataFrame, keys: tuple[str, ...] = ("company", "facility_name", "city"), seq: str = "id",
    valid: Column | None = None, hot: DataFrame | None = None,
) -> DataFrame:
    """Newest year first (unknown last), then PUE type, then source, then input order.

    Only rows where ``valid`` is true are considered.  That is part of the grade: a filter would be
    merged with all that computes its columns, and compute them once per mention.
    """
    year = F.coalesce(F.col("year").cast("bigint") + F.lit(1 << 31), F.lit(-1)) + 1  # 0 is unknown
    kind, source = lookup(F.col("pue_type"), V.PUE_TYPE_PRIORITY, F.lit(0)), lookup(F.col("source_type"), V.SOURCE_PRIORITY, F.lit(0))
    grade = (year * 256 + kind) * 256 + source
    if valid is not None:
        grade = F.when(valid, grade).otherwise(F.lit(-1))
    return best_per_key(df, list(keys), grade.cast("bigint"), seq, list(keys[:2]), hot)


def keep_simple(
    df: DataFrame,
    keys: tuple[str, ...] = ("company", "facility_name", "city"),
    keep: str = "newest",
    seq: str = "id",
) -> DataFrame:
    """``newest`` prefers the latest year; ``first`` and ``last`` both keep the first row.

    Missing keys are replaced by the empty string, in the result as well.
    """
    if keep not in ("newest", "first", "last"):
        raise ValueError(f"unknown keep mode: {keep}")
    present = [k for k in keys if k in df.columns]
    filled = df.withColumns({k: F.coalesce(k, F.lit("")) for k in present})
    order = [F.col(seq).asc()]
    if keep == "newest" and "year" in df.columns:
        order.insert(0, F.desc_nulls_last("year"))
    return first_per_key(filled, present, order)


def first_in_input_order(df: DataFrame, keys: list[str], seq: str = "id") -> DataFrame:
    return first_per_key(df, keys, [F.col(seq).asc()])
