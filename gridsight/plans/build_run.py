"""Building models in the order of their needs and testing tables.

A model is a name, the tables it reads and a function of them.  Seeds and tables are written,
views are only named.  All row and key tests of a table are answered by one scan of it.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridsight.plans import marts
from gridsight.session import short_shuffles
from gridsight.sources.writers import materialize, removed


@dataclass(frozen=True)
class Model:
    """``order``: columns by which the table is sorted.  It is written as it comes and sorted from
    there, so that what it is computed with and what it is sorted with are not on disk together."""

    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    kind: str = "table"
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, unique, accepted (``values``) or between (two ``values``); ``key``
    names a failing row of a not_null test; ``where`` limits the rows that are tested."""

    table: str
    kind: str
    column: str
    key: str = ""
    values: tuple = ()
    where: str = ""
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


#: The project: staging, four marts in their stated order, and the temperature seed.
MODELS = (
    Model("city_temperatures", ("seed_rows",), lambda seed: seed, "seed"),
    Model("stg_pue", ("raw_pue_data",), marts.staging, "view"),
    Model("mart_leaderboard", ("stg_pue",), marts.leaderboard, order=("pue_rank",)),
    Model("mart_india_vs_global", ("stg_pue",), marts.india_vs_global),
    Model("mart_cost_waste", ("stg_pue",), lambda stg: marts.cost_waste(stg, ordered=True)),
    Model("mart_climate_impact", ("stg_pue", "city_temperatures"), lambda stg, seed: marts.climate_impact(stg, seed, ordered=True)),
)
CHECKS = (
    Check("raw_pue_data", "unique", "id"), Check("raw_pue_data", "not_null", "id", "source_url"),
    Check("raw_pue_data", "not_null", "company", "id"), Check("raw_pue_data", "not_null", "pue_value", "id"),
    Check("dim_company", "unique", "company_id"), Check("dim_company", "not_null", "company_id", "company_name"),
    Check("dim_location", "unique", "location_id"), Check("dim_location", "not_null", "location_id", "city"),
    Check("fact_efficiency", "unique", "fact_id"), Check("fact_efficiency", "not_null", "fact_id", "source_url"),
    Check("fact_efficiency", "not_null", "pue_value", "fact_id"),
    Check("fact_efficiency", "accepted", "pue_value", values=("1.0", "1.5", "2.0", "2.5", "3.0"), where="pue_value >= 1.0 AND pue_value <= 3.0", severity="warn"),
)


def build_order(models: Sequence[Model]) -> list[Model]:
    """Models after all that they need; a circle is an error."""
    named = {m.name: m for m in models}
    order = TopologicalSorter({m.name: [n for n in m.needs if n in named] for m in models}).static_order()
    return [named[n] for n in order]


def build(sources: Mapping[str, DataFrame], models: Sequence[Model], root: str) -> dict[str, DataFrame]:
    """All models over ``sources``, tables and seeds written below ``root`` and read from there."""
    known = dict(sources)
    for m in build_order(models):
        missing = [n for n in m.needs if n not in known]
        if missing:
            raise ValueError(f"{m.name} needs {', '.join(missing)}")
        df = m.build(*[known[n] for n in m.needs])
        if m.order:
            df = materialize(df, f"{m.name}_unsorted", root).orderBy(*m.order)
        known[m.name] = materialize(df, m.name, None if m.kind == "view" else root)
        if m.order:
            removed(df.sparkSession, f"{root.rstrip('/')}/{m.name}_unsorted")
    return {m.name: known[m.name] for m in models}


def failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``test``, ``value`` and ``n_records`` of everything that fails, from one scan of ``df``.

    Every row gives its keys under the unique tests and an entry for each row test it fails;
    these are counted together, before and after one shuffle, in which a test is a number.  A
    missing key is not tested for uniqueness.
    """
    def entry(no: int, c: Check) -> Column:
        col, kind = F.col(c.column), df.schema[c.column].dataType
        listed = [F.lit(v).cast(kind) for v in c.values]
        bad = {"unique": lambda: col.isNotNull(), "not_null": lambda: col.isNull(), "accepted": lambda: ~col.isin(*listed), "between": lambda: ~col.between(*listed)}[c.kind]()
        if c.where:
            bad &= F.expr(c.where)
        value = F.col(c.key) if c.kind == "not_null" and c.key else col
        return F.when(bad, F.struct(F.lit(no).alias("no"), value.cast("string").alias("value")))

    found = df.select(F.explode_outer(F.array_compact(F.array(*[entry(i, c) for i, c in enumerate(checks)]))).alias("e")).where("e is not null").select("e.*")
    counted = found.groupBy("no", "value").agg(F.count(F.lit(1)).alias("n_records"))
    keyed = [i for i, c in enumerate(checks) if c.kind == "unique"]
    names = F.element_at(F.array(*[F.lit(c.name) for c in checks]), F.col("no") + 1)
    return counted.where(~F.col("no").isin(keyed) | (F.col("n_records") > 1)).select(names.alias("test"), "value", "n_records")


def test_tables(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Sequence[Check], root: str) -> DataFrame:
    """Every test with its failures and status; what failed is stored below ``root``/dq_failures.

    A not_null test counts rows, the others count values.  One table is tested after the other, so
    that only one table's keys are on disk.
    """
    path = f"{root.rstrip('/')}/dq_failures"
    for i, t in enumerate(dict.fromkeys(c.table for c in checks)):
        found = failures(tables[t], [c for c in checks if c.table == t])
        with short_shuffles(spark):
            found.write.mode("append" if i else "overwrite").partitionBy("test").parquet(path)
    stored = spark.read.schema("value string, n_records bigint, test string").parquet(path)
    by_rows = [c.name for c in checks if c.kind == "not_null"]
    counts = stored.groupBy("test").agg(F.when(F.col("test").isin(by_rows), F.sum("n_records")).otherwise(F.count(F.lit(1))).alias("failures"))
    listed = spark.createDataFrame([(c.name, c.table, c.severity) for c in checks], "test string, table string, severity string")
    n = F.coalesce("failures", F.lit(0))
    return listed.join(counts, "test", "left").select("test", "table", "severity", n.alias("failures"), F.when(n == 0, "pass").otherwise(F.col("severity")).alias("status"))


test_tables.__test__ = False  # no test of this library


def build_and_test(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, models: Sequence[Model] = MODELS, checks: Sequence[Check] = CHECKS) -> tuple[dict[str, DataFrame], DataFrame]:
    """The built models, and the results of the tests of all tables."""
    built = build(sources, models, root)
    return built, test_tables(spark, {**sources, **built}, checks, root)
