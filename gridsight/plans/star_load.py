"""Loading records into the star schema in runs that may be repeated and may fail at any place.

A run writes its rows of every table into a folder of its own attempt.  The last write is one row
of the manifest that names the attempt; only then is anything of the run visible.  A run that is
repeated replaces what it loaded before; a run that died left folders that nobody reads.  Both stay
until ``remove_replaced`` is called.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from gridsight.operators.star import absent_keys, company_candidates, fact_rows, location_candidates, lookup_hot_keys
from gridsight.session import short_shuffles

TABLES = ("raw", "dim_company", "dim_location", "fact", "rejected")
MANIFEST = "run string, attempt string, seq bigint, raw bigint, dim_company bigint, dim_location bigint, fact bigint, rejected bigint"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/manifest"
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(path)  # there is one from the start
    return spark.read.schema(MANIFEST).parquet(path)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The visible attempt of every run and its counts."""
    latest = F.row_number().over(W.partitionBy("run").orderBy(F.desc("seq"), "attempt"))
    return _manifest(spark, root).withColumn("_n", latest).where("_n = 1").drop("_n")


def _read(spark: SparkSession, root: str, table: str, schema, names: list[tuple[str, str]]) -> DataFrame:
    """The rows of these (run, attempt)s, with their run."""
    paths = [f"{root.rstrip('/')}/{table}/run={run}/attempt={attempt}" for run, attempt in names]
    base = f"{root.rstrip('/')}/{table}"
    if not paths:
        return spark.createDataFrame([], schema).withColumn("run", F.lit(None).cast("string"))
    whole = T.StructType(schema.fields + [T.StructField(c, T.StringType()) for c in ("run", "attempt")])
    return spark.read.schema(whole).option("basePath", base).parquet(*paths).drop("attempt")


def read_star(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as all finished runs left it, with the ``run`` of every row."""
    # one row per run: as many as there were loads
    names = [(r["run"], r["attempt"]) for r in runs(spark, root).select("run", "attempt").collect()]
    if not names:
        raise ValueError(f"no finished run below {root}")
    run, attempt = names[0]
    schema = spark.read.parquet(f"{root.rstrip('/')}/{table}/run={run}/attempt={attempt}").schema
    return _read(spark, root, table, schema, names)


def remove_replaced(spark: SparkSession, root: str) -> int:
    """Delete the folders of attempts that are not visible (any more) and return their number.

    Not while a load is running, nor while a table is read that was opened before its run was repeated.
    """
    visible = {f"run={r['run']}/attempt={r['attempt']}" for r in runs(spark, root).select("run", "attempt").collect()}
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def inside(path, start: str) -> list:
        return [f.getPath() for f in fs.listStatus(path) if f.isDirectory() and f.getPath().getName().startswith(start)]

    attempts = [a for table in inside(top, "") for run in inside(table, "run=") for a in inside(run, "attempt=")]
    gone = [a for a in attempts if f"{a.getParent().getName()}/{a.getName()}" not in visible]
    for a in gone:
        fs.delete(a, True)
    return len(gone)


def load(records: DataFrame, root: str, run: str, seq: str = "id") -> dict[str, int]:
    """Load enriched records under the name ``run`` and return how many rows each table gained.

    * Rows whose id another run has loaded already add nothing.
    * A company or place that is there keeps its row; what a former attempt of this run inserted
      stays, for other runs' facts may point to it.
    * Facts look up their keys in the tables with this run's insertions; rejected rows are kept
      with their reasons.
    """
    if not run or any(c in run for c in "/=\\%\"'*?:#{}[]^"):
        raise ValueError(f"not a name for a run: {run!r}")
    spark, attempt = records.sparkSession, uuid.uuid4().hex
    done = runs(spark, root).select("run", "attempt", "seq").collect()
    others = [(r["run"], r["attempt"]) for r in done if r["run"] != run]
    own = [(r["run"], r["attempt"]) for r in done if r["run"] == run]

    def written(df: DataFrame, table: str) -> tuple[DataFrame, int]:
        path = f"{root.rstrip('/')}/{table}/run={run}/attempt={attempt}"
        with short_shuffles(spark):
            df.write.option("compression", "zstd").parquet(path)  # keys of hex digits halve
        back = spark.read.schema(df.schema).parquet(path)
        return back, back.count()

    def before(table: str, schema, names: list[tuple[str, str]]) -> DataFrame:
        return _read(spark, root, table, schema, names).drop("run")

    counts: dict[str, int] = {}
    known = before("raw", records.schema, others).select(F.col(seq).alias("_known"))
    new = records.join(known, F.col(seq) == F.col("_known"), "left_anti") if others else records
    raw, counts["raw"] = written(new, "raw")
    dims = {}
    for table, candidates, key in (("dim_company", company_candidates(raw, seq), "company_id"), ("dim_location", location_candidates(raw, seq), "location_id")):
        kept = before(table, candidates.schema, own)
        there = before(table, candidates.schema, others).unionByName(kept)
        mine, n = written(kept.unionByName(candidates.join(there.select(F.col(key).alias("_known")), F.col(key) == F.col("_known"), "left_anti")), table)
        dims[table] = before(table, candidates.schema, others).unionByName(mine)
        counts[table] = n
    hot, _ = written(lookup_hot_keys(raw), "hot_keys")
    absent, _ = written(absent_keys(raw, dims["dim_company"], dims["dim_location"]), "absent_keys")
    facts, rejected = fact_rows(raw, dims["dim_company"], dims["dim_location"], seq, hot, absent)
    _, counts["fact"] = written(facts, "fact")
    _, counts["rejected"] = written(rejected, "rejected")
    # one row in one file: it is there or it is not
    row = (run, attempt, 1 + max((r["seq"] for r in done), default=0), *[counts[t] for t in TABLES])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return counts
