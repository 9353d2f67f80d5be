"""Sinks.  A write is one Spark job whose committer survives lost tasks."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from gridsight import schemas
from gridsight.operators.quality import split_by_constraints
from gridsight.session import short_shuffles


def save_records_json(records: DataFrame, path: str) -> dict:
    """Write records as JSON lines, compressed (every record repeats all names); the counts come from the same pass."""
    seen = Observation()
    records.observe(
        seen,
        F.count(F.lit(1)).alias("Records Extracted"),
        F.count("pue_value").alias("Facilities with PUE"),
    ).write.mode("overwrite").option("compression", "gzip").json(path)
    return dict(seen.get)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def append_valid(df: DataFrame, path: str, rejected_path: str | None = None) -> int:
    """Append the rows that satisfy the constraints and return their number."""
    good, rejected = split_by_constraints(df)
    seen = Observation()
    good.observe(seen, F.count(F.lit(1)).alias("inserted")).write.mode("append").parquet(path)
    if rejected_path is not None:
        rejected.write.mode("append").parquet(rejected_path)
    return seen.get["inserted"]


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch: int = 100) -> None:
    df.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=dict(properties))


def append_run_summary(spark: SparkSession, path: str, summary: Mapping, run_at: str) -> None:
    """Append key and value rows of one run; a summary has a handful of keys."""
    rows = [(k, str(v)) for k, v in summary.items()]
    (
        spark.createDataFrame(rows, "key string, value string")
        .select(F.lit(run_at).cast("timestamp").alias("run_at"), "key", "value")
        .to(spark.createDataFrame([], schemas.RUN_SUMMARY).schema)
        .write.mode("append")
        .parquet(path)
    )


def materialize(df: DataFrame, name: str, root: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Without a root: a temporary view.  With one: a Parquet table, read back."""
    if root is None:
        df.createOrReplaceTempView(name)
        return df
    target = f"{root.rstrip('/')}/{name}"
    with short_shuffles(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).option("compression", "zstd").parquet(target)
    return df.sparkSession.read.parquet(target)


def removed(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all that is in it; False if there was none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def store_failures(failures: Mapping[str, DataFrame], root: str) -> None:
    """Write the failing rows of every data test into its own folder."""
    for test, rows in failures.items():
        rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/dq_failures/{test}")
