"""Registered queries against their SQL on the smallest tables, and the shape of their plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, canonical

CHECKED = [
    "mrt02_leaderboard", "mrt02_leaderboard_sliced", "mrt03_india_vs_global", "mrt04_cost_waste", "mrt05_climate_impact", "enr08_cleaning_run",
    "jn05_fact_keys", "vw01_efficiency_leaderboard", "vw02_region_comparison", "vw03_tier_comparison", "agg12_summary_stats", "agg16_drill_down",
    "txt02_mention_context", "txt12_metric_only_records", "txt19_table_cells", "txt27_source_fallback", "dq07_row_validation", "srt04_final_order",
    "txt27_extraction_global", "txt27_extraction_india", "txt27_extraction_colocation", "txt28_extraction_run_summary", "txt23_search_pages", "txt26_first_hits",
    "txt26_official_hits", "jn03_insert_company", "jn04_load_places", "jn05_load_facts", "snk03_load_counts", "dq09_build_and_test", "snk05_build_models", "srt02_mart_order",
    "enr04_country_resolver", "win01_global_rank", "win02_rank_in_tier", "bi02_is_india", "an03_display_leaderboard", "prj01_normalize_schema", "flt07_company_lookup",
    "set01_union_of_groups", "src01_json_array_files", "fn13_url_join", "udf04_refresh_updated_at",
]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows_as_sql(spark, sf, con, name):
    got, want = entry.queries()[name](spark, sf).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got).equals(canonical(want))


def test_names_are_registered_in_pairs():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_level_plans_stay_distributed(spark, sf):
    """No window over rows without a partition, and no Python outside page parsing."""
    for name in ("mrt02_leaderboard", "enr08_cleaning_run", "mrt04_cost_waste", "txt11_record_assembly", "vw01_efficiency_leaderboard"):
        text = plan(entry.queries()[name](spark, sf))
        assert "Python" not in text and "InPandas" not in text and "CartesianProduct" not in text, name
    assert "SinglePartition" not in plan(entry.queries()["enr08_cleaning_run"](spark, sf))


def test_dedup_reduces_before_the_shuffle(spark, sf):
    assert "Partial" in plan(entry.queries()["win03_best_row_per_key"](spark, sf))


def test_leaderboard_shuffles_whole_rows_once(spark, sf):
    """Both ranks and the join with the counts use the one exchange of the rows."""
    dealt = [line for line in plan(entry.queries()["mrt02_leaderboard"](spark, sf)).splitlines() if "REPARTITION" in line or "Exchange" in line and "facility_name" in line]
    assert len(dealt) == 1


def test_scan_reads_only_needed_columns(spark, sf):
    text = entry.queries()["flt05_india_or_global"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in text.split("Relation")[0]


def test_entry(spark, sf):
    assert entry.entry(spark).limit(1).count() == 1
