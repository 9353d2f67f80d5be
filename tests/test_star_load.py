"""Loading in runs: repeated, overlapping and failed ones; joins that read their rows once."""

from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from gridsight.catalog import fixtures as X
from gridsight.operators import star
from gridsight.operators.joins import frequent_keys, salted_join
from gridsight.plans import star_load, views

ROW = "id string, company string, city string, country string, region string, country_code string, avg_temp_celsius decimal(5,2), tier string, year int, pue_value decimal(5,3), renewable_pct int, facility_name string, pue_type string, capacity_mw decimal(10,2), rack_count int, wue_l_per_kwh decimal(10,3), source_url string, source_type string, extraction_date date"


def rows(spark, *given):
    return spark.createDataFrame([(i, c, city, None, None, None, None, tier, 2020, Decimal(pue), None, None, "design", None, None, None, None, None, None) for i, c, city, tier, pue in given], ROW)


def state(spark, root):
    return {t: sorted((r["run"], r[k]) for r in star_load.read_star(spark, root, t).collect()) for t, k in (("raw", "id"), ("dim_company", "company_name"), ("dim_location", "city"), ("fact", "fact_id"), ("rejected", "id"))}


def test_runs(spark, tmp_path):
    root = str(tmp_path)
    one = rows(spark, ("1", "a", "x", "T1", "1.2"), ("2", "b", "", "T1", "1.3"), ("3", "c", "y", "T1", "9"))
    two = rows(spark, ("3", "c", "y", "T1", "9"), ("4", "a", "z", "T9", "1.4"), ("5", None, "x", "T9", "1.5"))
    assert star_load.load(one, root, "r1") == {"raw": 3, "dim_company": 3, "dim_location": 2, "fact": 2, "rejected": 1}
    first = state(spark, root)
    assert star_load.load(two, root, "r2") == {"raw": 2, "dim_company": 0, "dim_location": 1, "fact": 1, "rejected": 1}
    both = state(spark, root)
    assert [r for r in both["dim_company"]] == first["dim_company"] and star_load.read_star(spark, root, "dim_company").where("company_name = 'a'").first()["tier"] == "T1"
    for run, df in (("r2", two), ("r1", one), ("r2", two)):  # again: nothing is added
        star_load.load(df, root, run)
        assert state(spark, root) == both
    star_load.load(one.where("id = '1'"), root, "r1")  # a run loaded anew with less replaces its rows, not the companies others point to
    less = state(spark, root)
    assert less["raw"] == [("r1", "1"), ("r2", "4"), ("r2", "5")] and less["dim_company"] == both["dim_company"]
    assert [r["run"] for r in star_load.runs(spark, root).orderBy("run").collect()] == ["r1", "r2"]


@pytest.mark.parametrize("dies_at", range(1, 8))
def test_a_run_that_dies_leaves_nothing(spark, tmp_path, monkeypatch, dies_at):
    root = str(tmp_path)
    star_load.load(rows(spark, ("1", "a", "x", "T1", "1.2")), root, "r1")
    before, n, write = state(spark, root), 0, DataFrameWriter.parquet

    def dying(self, path, *args, **kwargs):
        nonlocal n
        if "manifest" not in path or n >= 6:
            n += 1
            if n == dies_at:
                raise RuntimeError("killed")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dying)
    again = rows(spark, ("1", "a", "x", "T1", "1.9"), ("2", "b", "y", "T1", "1.3"))
    with pytest.raises(RuntimeError):
        star_load.load(again, root, "r1")
    monkeypatch.undo()
    assert state(spark, root) == before
    assert star_load.load(again, root, "r1")["fact"] == 2


def test_replaced_attempts_are_removed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    one, two = rows(spark, ("1", "a", "x", "T1", "1.2"), ("2", "b", "y", "T1", "9")), rows(spark, ("3", "c", "z", "T1", "1.3"))
    star_load.load(one, root, "r1")
    star_load.load(two, root, "r2")
    star_load.load(one, root, "r1")
    monkeypatch.setattr(star_load, "fact_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        star_load.load(two, root, "r3")
    monkeypatch.undo()
    before = state(spark, root)
    assert star_load.remove_replaced(spark, root) > 0
    assert state(spark, root) == before and star_load.remove_replaced(spark, root) == 0
    assert len({p.parent for p in tmp_path.glob("raw/*/*/*.parquet")}) == 2 and not list(tmp_path.glob("*/run=r3/*"))
    assert star_load.load(two, root, "r2")["fact"] == 1 and state(spark, root) == before


def test_rows_are_not_shuffled_to_look_up_keys(spark, tmp_path):
    """Only distinct companies and places are; rows meet the few keys that a dimension lacks."""
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"), *[
        {"company": F.concat(F.lit("c"), F.col("id") % 500), "city": F.concat(F.lit("x"), F.col("id") % 9), "year": F.lit(2020), "pue_value": F.lit(Decimal("1.500"))}.get(n, F.lit(None)).cast(kind).alias(n)
        for n, kind in (part.rsplit(" ", 1) for part in ROW.split(", ")[1:])])
    df.write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    dims = [star.company_candidates(df), star.location_candidates(df)]
    for i, given in enumerate([dims, [dims[0].where("company_name <> 'c7'"), dims[1].where("city <> 'x3'")]]):
        star.absent_keys(df, *given).write.parquet(f"{tmp_path}/absent{i}")
        star.lookup_hot_keys(df).write.parquet(f"{tmp_path}/hot{i}")
        facts, rejected = star.fact_rows(df, *given, hot=spark.read.parquet(f"{tmp_path}/hot{i}"), absent=spark.read.parquet(f"{tmp_path}/absent{i}"))
        assert not [line for line in facts._jdf.queryExecution().sparkPlan().toString().splitlines() if "SortMergeJoin" in line]
        plan = facts._jdf.queryExecution().executedPlan().toString().splitlines()
        assert not [line for line in plan if "Exchange hashpartitioning" in line and "source_url" in line]
        assert facts.count() == 2000 - 4 * i and rejected.count() == 4 * i
        assert facts.where("location_id is null").count() == i * df.where("city = 'x3' and company <> 'c7'").count()


def test_absent_keys(spark):
    """A missing company and an empty one have one key; rejected rows count for nothing."""
    df = rows(spark, ("1", "a", "x", "T", "1.2"), ("2", None, "", "T", "1.2"), ("3", "", None, "T", "1.2"), ("4", "new", "y", "T", "1.2"), ("5", "bad", "w", "T", "9"), ("6", "a", "y", "T", "1.3"))
    dims = rows(spark, ("1", "a", "x", "T", "1.2"))
    got = star.absent_keys(df, star.company_candidates(dims), star.location_candidates(dims))
    want = spark.createDataFrame([("new", None), ("", None), (None, "y")], "c string, p string").select(F.when(F.col("c").isNotNull(), star.key_of("c")), F.when(F.col("p").isNotNull(), star.key_of("p", F.lit(None))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    facts, rejected = star.fact_rows(df, star.company_candidates(dims), star.location_candidates(dims))
    assert facts.count() == 2 and {r.id: r.reasons for r in rejected.collect()} == {"2": ["unknown_company"], "3": ["unknown_company"], "4": ["unknown_company"], "5": ["pue_range"]}


def test_names_of_runs(spark, tmp_path):
    for bad in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            star_load.load(rows(spark), str(tmp_path), bad)
    with pytest.raises(ValueError):
        star_load.read_star(spark, str(tmp_path), "fact")
    star_load.load(rows(spark), str(tmp_path), "empty")
    assert star_load.read_star(spark, str(tmp_path), "fact").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("given", ["none", "all", "wrong"])
def test_joins_do_not_depend_on_what_is_hot(spark, how, given):
    """A third of the rows have one key, a tenth none, some a key that the table lacks."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, None).when(F.col("id") % 7 == 1, F.lit("absent")).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"))
    keyed = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 2)], "k string, v int")
    hot = {"none": None, "all": df.select(F.lit("k").alias("key"), F.xxhash64("k").alias("hash")).where("hash <> 42").distinct(), "wrong": spark.createDataFrame([("k", 5), ("other", 6)], "key string, hash bigint")}[given]
    got = salted_join(df, keyed, ["k"], how, "id", hot)
    want = df.join(keyed, "k", how).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_frequent_keys_of_many_columns(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"), (F.col("id") % 2).alias("b"), F.lit(None).cast("string").alias("c"))
    got = {(r["key"], r["hash"]) for r in frequent_keys(df, ["a"], ["b"], ["c"], ["a", "b"]).collect()}
    want = df.select(F.xxhash64(F.lit("hot")).alias("a"), F.xxhash64("b").alias("b"), F.xxhash64(F.lit("hot"), "b").alias("ab")).distinct().collect()
    assert got == {("a", want[0]["a"])} | {("b", r["b"]) for r in want} | {("a,b", r["ab"]) for r in want}


def scans(df, folder):
    df.count()
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [fact_id")


def test_views_read_the_facts_once(spark, sf):
    facts, companies, places = X.star(spark, sf)
    assert scans(views.efficiency_leaderboard(facts, companies, places, hot=X.hot_keys(spark, sf)), sf) == 1
    plan = X.fact_load(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id#") == 1


def test_stored_tables_are_compressed(spark, tmp_path):
    """Keys of hex digits take less than their length on disk."""
    star_load.load(rows(spark, *[(str(i), f"c{i}", "x", "T1", "1.2") for i in range(3000)]), str(tmp_path), "r")
    files = [p for p in tmp_path.glob("fact/**/*.parquet")]
    assert files and all(p.name.endswith(".zstd.parquet") for p in files)
    assert sum(p.stat().st_size for p in files) < 3000 * 2 * 64
    assert star_load.read_star(spark, str(tmp_path), "fact").select("fact_id").distinct().count() == 3000
