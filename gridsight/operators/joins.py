"""Joins of many rows with a table that has one row per key."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot if it has more than one in so many of the rows; so there are fewer hot keys than this.
HOT = 1000
#: Items that the frequent-items sketch of one key keeps at most.
TRACKED = 8192
#: Tasks that merge the sketches of all partitions before the last one does.
MERGES = 64
#: Groups over which rows that take no part in the shuffled join are spread.
SPREAD = 1 << 20


def _hash(columns: list[str]) -> Column:
    return F.when(reduce(and_, [F.col(c).isNotNull() for c in columns]), F.xxhash64(*columns))


def frequent_keys(rows: DataFrame, *keys: list[str]) -> DataFrame:
    """``key`` (its column names, joined by commas) and ``hash`` of the hot values of every key.

    One pass over the rows for all keys: each has a frequent-items sketch, which merges like a
    sum and stays small whatever the number of values.  The table has fewer than ``HOT`` rows
    per key and may be kept beside the rows for all later joins.
    """
    names = [",".join(k) for k in keys]
    hashed = rows.select(*[_hash(k).alias(f"k{i}") for i, k in enumerate(keys)])
    # sketches of the input partitions meet in a few tasks first, so the last one merges no more than these
    sketched = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("_merge")).agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k_accumulate(k{i}, {TRACKED}) as s{i}") for i in range(len(keys))])
    # grouped by what is always 0: sketches of no rows at all cannot be merged
    seen = sketched.groupBy(F.pmod(F.col("_merge"), F.lit(1)).alias("_one")).agg(F.sum("n").alias("all"), *[F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{i}, {TRACKED}), {HOT}) as k{i}") for i in range(len(keys))])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("key"), F.col(f"k{i}").alias("items")) for i, n in enumerate(names)]))
    items = seen.select("all", each.alias("e")).select("all", "e.key", F.explode("e.items").alias("i"))
    return items.where(F.col("i.item").isNotNull() & (F.col("i.count") * HOT > F.col("all"))).select("key", F.col("i.item").alias("hash"))


def salted_join(
    rows: DataFrame, keyed: DataFrame, keys: list[str] | dict[str, str], how: str, spread: str | Column, hot: DataFrame | None = None,
) -> DataFrame:
    """``rows`` joined to ``keyed`` on ``keys`` (a dict maps row column to key column).

    Three kinds of rows, one shuffle of the rows:

    * Hot keys are those of ``hot`` (see ``frequent_keys``; without it they are found by a pass
      over ``rows``).  They are fewer than ``HOT``, so their rows of the key table are broadcast,
      whatever its size.
    * All other keys are small and meet their row of the key table in the shuffle.
    * Rows with a NULL key and rows of hot keys have nothing to find there.  They carry a group
      number from a hash of ``spread`` (a column that differs from row to row) as a further part
      of the join key, so they spread over all partitions.

    Which keys count as hot changes no result.  Works for inner, left, left_semi and left_anti.
    The key columns of ``keyed`` are dropped; both sides' key columns have one type.
    """
    pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
    for a, b in pairs.items():
        if rows.schema[a].dataType != keyed.schema[b].dataType:
            raise ValueError(f"{a} and {b} are of different types")
    column = F.col(spread) if isinstance(spread, str) else spread
    values = [c for c in keyed.columns if c not in pairs.values()] if how in ("inner", "left") else []
    whole = reduce(and_, [F.col(a).isNotNull() for a in pairs])
    name = ",".join(pairs)
    hot = frequent_keys(rows, list(pairs)) if hot is None else hot.where(F.col("key") == name)

    known = keyed.select(*[F.col(c).alias(f"_cold_{c}") for c in [*pairs.values(), *values]], F.lit(True).alias("_cold"))
    cold_keys = [f"_cold_{b}" for b in pairs.values()]
    met = hot.select(F.col("hash").alias("_often")).join(known, F.col("_often") == F.xxhash64(*cold_keys), "left")
    # two keys of one hash, should there be any, are not hot: their rows go through the shuffle
    fields = F.struct(*[F.col(f"_cold_{c}").alias(f"_hot_{c}") for c in [*pairs.values(), *values]], F.coalesce("_cold", F.lit(False)).alias("_hot"))
    single = met.groupBy("_often").agg(F.count(F.lit(1)).alias("_n"), F.first(fields).alias("_f")).where("_n = 1").select("_often", "_f.*")

    left = rows.withColumn("_hash", _hash(list(pairs))).join(F.broadcast(single), F.col("_hash") == F.col("_often"), "left")
    same = reduce(and_, [F.col(a) == F.col(f"_hot_{b}") for a, b in pairs.items()])
    # a hot hash without a row of the key table has none for any of its keys
    found_hot = F.coalesce(F.col("_hot") & same, F.lit(False))
    aside = ~whole | found_hot | F.coalesce(~F.col("_hot"), F.lit(False))
    left = left.withColumn("_found", found_hot).withColumn("_group", F.when(aside, F.pmod(F.xxhash64(column), F.lit(SPREAD)) + 1).otherwise(0))
    # always 0, but no constant: the optimizer would take a constant out of the join key
    zero = F.pmod(F.xxhash64(*cold_keys), F.lit(1))
    on = reduce(and_, [F.col(a) == F.col(f"_cold_{b}") for a, b in pairs.items()]) & (F.col("_group") == F.col("_zero"))
    joined = left.join(known.withColumn("_zero", zero), on, "left")
    found = F.col("_found") | F.coalesce("_cold", F.lit(False))
    if how in ("inner", "left_semi"):
        joined = joined.where(found)
    elif how == "left_anti":
        joined = joined.where(~found)
    return joined.select(*rows.columns, *[F.when(F.col("_found"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in values])
