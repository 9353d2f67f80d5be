"""The query registry."""

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that any client compares them alike."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL counterpart."""
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a write: on the shared storage that the cluster names in
    ``spark.checkpoint.dir``.  Only a local session may leave that out."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def places(ordered: DataFrame, *keep: str) -> DataFrame:
    """Position of every row of a sorted table, to check an order by its values.

    The sorted rows are written once, so that their partitions cannot change between the two
    reads: rows of earlier partitions plus the place in the own partition.
    """
    spark, path = ordered.sparkSession, scratch(ordered.sparkSession, "sorted")
    keep = keep or ("id",)
    ordered.select(*keep, F.monotonically_increasing_id().alias("_m")).write.parquet(path)
    rows = spark.read.parquet(path).select(
        *keep, F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("_i")
    )
    # one row per partition of the sort: this table is as small as the partition count
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    skip = F.sum("_n").over(W.orderBy("_p")) - F.col("_n")
    earlier = F.broadcast(sizes.select("_p", skip.alias("_skip")))
    return rows.join(earlier, "_p").select((F.col("_skip") + F.col("_i") + 1).alias("place"), *keep)
