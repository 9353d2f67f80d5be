"""Row numbers over very large groups without pulling a group into one task."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Leading hex digits of the tie hash by which the rows of one value are cut: 4,096 slices.
DIGITS = 3


def _label(columns: list[str]) -> Column:
    """One text for the values of these columns; NULL is a value, and lengths keep them apart."""
    parts = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.concat(F.lit("/"), *parts)


def row_numbers_by_value(df: DataFrame, by: str, tie: str, ranks: dict[str, list[str]], digits: int = DIGITS) -> DataFrame:
    """Adds one column per rank: ``row_number() over (partition by <group> order by <by> nulls
    last, md5(tie), tie)``, where ``ranks`` maps the column to its group columns.

    One plan of one shape, whatever the size, and no job before it runs.  The rows of a value are
    cut into slices by the first ``digits`` hex digits of ``md5(tie)``.  A row's number is the
    number of rows with smaller values, plus those of earlier slices of its value, plus its place
    in its slice.  The first two are prefix sums over counts, at most 16**digits rows per value
    and group, and only the slices are sorted: the whole rows are shuffled once for all ranks,
    and any value and any group may hold a large share of them.  ``by`` takes few distinct
    values (a PUE is decimal(5,3) in [1,3]: 2,001 at most): their sums are ordered per group.
    The hash does not travel with the rows: it takes as much as the other columns of a row.
    """
    value, cut = _label([by]), F.substring(F.md5(F.col(tie)), 1, digits) if digits else F.lit("")
    groups = list(dict.fromkeys(c for within in ranks.values() for c in within))
    keys = {name: F.concat(F.lit(name), _label(within)) for name, within in ranks.items()}

    counts = df.select(by, *groups, cut.alias("_cut")).groupBy(by, "_cut", *groups).agg(F.count(F.lit(1)).alias("_n"))
    cells = counts.select(by, "_cut", "_n", F.explode(F.array(*keys.values())).alias("_key"))
    cells = cells.groupBy("_key", by, "_cut").agg(F.sum("_n").alias("_n")).withColumn("_value", value)
    values = cells.groupBy(F.col("_key").alias("_k"), F.col(by).alias("_by"), F.col("_value").alias("_v")).agg(F.sum("_n").alias("_sum"))
    smaller = F.sum("_sum").over(W.partitionBy("_k").orderBy(F.col("_by").asc_nulls_last())) - F.col("_sum")
    earlier = F.sum("_n").over(W.partitionBy("_key", "_value").orderBy("_cut")) - F.col("_n")
    before = cells.drop(by).withColumn("_earlier", earlier).join(values.withColumn("_smaller", smaller), (F.col("_key") == F.col("_k")) & (F.col("_value") == F.col("_v")))
    # a row per slice, so that the rows meet it on the key they are dealt by
    skips = before.groupBy(F.concat("_value", F.lit("#"), "_cut").alias("_s")).agg(F.map_from_entries(F.collect_list(F.struct("_key", F.col("_smaller") + F.col("_earlier")))).alias("_skip"))

    rows = df.withColumn("_slice", F.concat(value, F.lit("#"), cut)).repartition("_slice").withColumn("_hash", F.md5(F.col(tie)))
    places = {f"_place_{name}": F.row_number().over(W.partitionBy("_slice", *within).orderBy("_hash", tie)) for name, within in ranks.items()}
    joined = rows.withColumns(places).join(skips, F.col("_slice") == F.col("_s"))
    out = joined.withColumns({name: F.element_at("_skip", key) + F.col(f"_place_{name}") for name, key in keys.items()})
    return out.select(*df.columns, *ranks)


def row_number_by_value(
    df: DataFrame, name: str, by: str, tie: str, within: list[str] | None = None, digits: int = DIGITS,
) -> DataFrame:
    """One rank; see ``row_numbers_by_value``."""
    return row_numbers_by_value(df, by, tie, {name: within or []}, digits)
