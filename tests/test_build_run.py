"""Build order, one-scan tests, country names, roll-up."""

import json

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from gridsight.operators.location import resolve_countries
from gridsight.plans import analytics, build_run
from gridsight.plans.build_run import Check, Model
from gridsight.sources.lookups import country_index


def test_models_come_after_what_they_need(spark, tmp_path):
    models = [Model("c", ("b", "a"), lambda b, a: b.union(a)), Model("b", ("a",), lambda a: a.selectExpr("x + 1 as x"), "view"), Model("a", ("src",), lambda s: s, "seed")]
    assert [m.name for m in build_run.build_order(models)] == ["a", "b", "c"]
    built = build_run.build({"src": spark.range(3).selectExpr("id as x")}, models, str(tmp_path))
    assert sorted(r.x for r in built["c"].collect()) == [0, 1, 1, 2, 2, 3] and sorted(p.name for p in tmp_path.iterdir()) == ["a", "c"]
    with pytest.raises(ValueError, match="needs src"):
        build_run.build({}, models, str(tmp_path))
    with pytest.raises(ValueError):
        build_run.build_order([Model("a", ("b",), None), Model("b", ("a",), None)])


def test_tests_of_a_table_in_one_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 9.0), (2, None, 2.5), (None, None, None), (None, "c", 1.5), (3, "x", 7.0), (4, "x", 7.0)], "id int, name string, v double")
    checks = [Check("t", "unique", "id"), Check("t", "not_null", "name", "id"), Check("t", "accepted", "v", values=(1.0, 1.5), where="v < 8", severity="warn"),
              Check("t", "between", "v", values=(0, 8)), Check("t", "unique", "name", where="id < 3"), Check("t", "not_null", "v", "name")]
    found = build_run.failures(df, checks)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = {(r.test, r.value, r.n_records) for r in found.collect()}
    assert got == {("unique_t_id", "1", 2), ("not_null_t_name", "2", 1), ("not_null_t_name", None, 1), ("accepted_t_v", "2.5", 1), ("accepted_t_v", "7.0", 2), ("between_t_v", "9.0", 1), ("not_null_t_v", None, 1)}
    results = {r.test: (r.failures, r.status) for r in build_run.test_tables(spark, {"t": df}, checks, str(tmp_path)).collect()}
    assert results == {"unique_t_id": (1, "error"), "not_null_t_name": (2, "error"), "accepted_t_v": (2, "warn"), "between_t_v": (1, "error"), "unique_t_name": (0, "pass"), "not_null_t_v": (1, "error")}
    assert spark.read.parquet(f"{tmp_path}/dq_failures").where("test = 'accepted_t_v'").count() == 2


def test_ordered_models_are_sorted_from_what_is_written(spark, tmp_path, monkeypatch):
    """Computing and sorting never have their shuffle files on disk together; nothing unsorted stays."""
    written, write = [], build_run.materialize

    def seen(df, name, root):
        written.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, name, root)

    monkeypatch.setattr(build_run, "materialize", seen)
    src = spark.range(2000).select(((F.col("id") * 7919) % 2003).alias("x"), (F.col("id") % 7).alias("k"))
    models = [Model("m", ("src",), lambda s: s.groupBy("x").agg(F.max("k").alias("k")), order=("x",)), Model("n", ("m",), lambda m: m.where("k = 1"))]
    built = build_run.build({"src": src}, models, str(tmp_path))
    assert [n for n, _ in written] == ["m_unsorted", "m", "n"]
    assert "Sort [" not in written[0][1] and "Sort [" in written[1][1] and "Aggregate" not in written[1][1]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["m", "n"] and all(".zstd." in p.name for p in tmp_path.glob("m/part-*"))
    assert [r.x for r in built["m"].collect()] == sorted(r.x for r in src.collect()) and built["n"].count() == src.where("k = 1").count()
    assert [m.name for m in build_run.MODELS if m.order] == ["mart_leaderboard"]


def test_tables_are_tested_one_after_the_other(spark, tmp_path, monkeypatch):
    """A test travels as a number; what an earlier run stored goes, what the other tables store stays."""
    modes, mode = [], DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, given: (modes.append(given) if given else None) or mode(self, given))
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([("u",), (None,)], "y string")
    checks = [Check("a", "unique", "x"), Check("b", "not_null", "y"), Check("a", "between", "x", values=(0, 1)), Check("b", "unique", "y")]
    for _ in range(2):
        got = {r.test: r.failures for r in build_run.test_tables(spark, {"a": a, "b": b}, checks, str(tmp_path)).collect()}
        assert got == {"unique_a_x": 1, "not_null_b_y": 1, "between_a_x": 1, "unique_b_y": 0}
    assert modes == ["overwrite", "append"] * 2
    dealt = [line for line in build_run.failures(a, checks[:1])._jdf.queryExecution().sparkPlan().toString().splitlines() if "HashAggregate" in line]
    assert dealt and not any("unique_a_x" in line for line in dealt)


def test_country_names(spark):
    names = {"France": "FR", "canada": "CA", " AUSTRALIA ": "AU", "USA": "US", "U.S.A.": "US", "UK": "GB", "United Kingdom": "GB", "the Netherlands": "NL", "IND": "IN", "de": "DE",
             "Hong Kong": "HK", "Côte d’Ivoire": "CI", "Trinidad and Tobago": "TT", "South Korea": "KR", "Atlantis": None, "": None, None: None}
    df = spark.createDataFrame([(k, "old") for k in names], "country string, country_code string")
    assert {r.country: r.country_code for r in resolve_countries(df, country_index(spark)).collect()} == names
    assert country_index(spark).groupBy("name_key").count().where("count > 1").count() == 0


def test_roll_up_by_levels(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("tier"), F.concat(F.lit("c"), F.col("id") % 7).alias("company"), F.when(F.col("id") % 4 > 0, (F.col("id") % 5).cast("string")).alias("facility_name"),
        F.when(F.col("id") % 6 > 0, 1 + (F.col("id") % 800) / 1000).cast("decimal(5,3)").alias("pue_value"), (F.col("id") % 50).cast("decimal(10,2)").alias("capacity_mw"))
    keys = ["tier", "company", "facility_name"]
    want = df.rollup(*keys).agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("records"), F.round(F.avg(F.col("pue_value").cast("decimal(20,10)")), 3).cast("double").alias("avg_pue"), F.sum("capacity_mw").alias("capacity_mw"))
    got = analytics.drill_down(df)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, got.withColumn("avg_pue", F.col("avg_pue").cast("double")).collect())) == sorted(map(str, want.collect()))
    assert analytics.drill_down(df.limit(0)).count() == 0
