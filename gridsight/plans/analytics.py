"""What the dashboard pages show, from the cleaned table."""

from pyspark.sql import DataFrame, functions as F

from gridsight.functions import metrics as X
from gridsight.functions.numbers import dec, half_up_ratio, mean_half_up
from gridsight.functions.text import fixed_point
from gridsight.operators.ranking import row_number_by_value

COMPARED = ("design", "operating", "TTM")


def options(df: DataFrame, column: str) -> DataFrame:
    """Values to choose from, sorted."""
    return df.select(column).dropna().distinct().orderBy(column)


def shown_of_total(df: DataFrame, predicate) -> DataFrame:
    """How many rows a filter keeps, in one pass over the table."""
    return df.agg(F.count_if(predicate).alias("records_shown"), F.count(F.lit(1)).alias("records_total"))


def headline(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_facilities"),
        mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"),
        F.min("pue_value").alias("best_pue"),
        mean_half_up(F.col("renewable_pct"), 0, 1).alias("avg_renewable_pct"),
    )


def display_leaderboard(df: DataFrame, seq: str = "id", ordered: bool = False) -> DataFrame:
    """Ranked table as text, ready for printing or export."""
    ranked = row_number_by_value(df, "rank", "pue_value", seq)
    out = ranked.select(
        "rank", "company", "facility_name", "city", "country",
        fixed_point(F.col("pue_value"), 3).alias("pue_value"),
        "pue_type",
        fixed_point(F.col("capacity_mw"), 1).alias("capacity_mw"),
        fixed_point(F.col("renewable_pct").cast("decimal(10,0)"), 0, "%").alias("renewable_pct"),
        "tier",
    )
    return out.orderBy("rank") if ordered else out


def mean_pue_by(df: DataFrame, key: str) -> DataFrame:
    """Mean PUE per group, lowest first; rows without a group are left out."""
    return (
        df.dropna(subset=[key])
        .groupBy(key)
        .agg(mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"))
        .orderBy("avg_pue", key)
    )


def frequencies(df: DataFrame, key: str) -> DataFrame:
    return (
        df.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)
    )


def pue_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    """Counts of PUE in [1,3] per bin; bins without rows have no row."""
    inside = df.filter(F.col("pue_value").between(dec("1.0"), dec("3.0")))
    return inside.groupBy(X.pue_bin(F.col("pue_value"), bins=bins).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def type_counts(df: DataFrame) -> DataFrame:
    """Design, operating (which includes TTM) and TTM records."""
    kind = F.col("pue_type")
    return df.agg(
        F.count_if(kind == "design").alias("design_count"),
        F.count_if(kind.isin("operating", "TTM")).alias("operating_count"),
        F.count_if(kind == "TTM").alias("ttm_count"),
    )


def company_scatter(df: DataFrame) -> DataFrame:
    return df.filter(F.col("pue_type").isin(*COMPARED)).select(
        "company", "pue_value", "pue_type", "capacity_mw", "facility_name", "city", "year"
    )


def india_comparison(df: DataFrame) -> DataFrame:
    """India against the rest in one pass; the gap is taken before rounding."""
    india = X.is_india(F.col("country"))
    pue = F.col("pue_value")
    sums = df.agg(
        mean_half_up(F.when(india, pue), 3, 3).alias("india_avg_pue"),
        F.round(
            F.sum(F.when(india, pue)).cast("double") / F.nullif(F.count(F.when(india, pue)), F.lit(0))
            - F.sum(F.when(~india, pue)).cast("double") / F.nullif(F.count(F.when(~india, pue)), F.lit(0)),
            3,
        ).alias("delta_vs_global"),
        F.min(F.when(india, pue)).alias("india_best_pue"),
        F.round(F.sum(F.when(india, F.col("capacity_mw"))), 1).cast("decimal(20,1)").alias("india_capacity_mw"),
        F.count_if(india).alias("india_facilities"),
    )
    return sums


def operators_by_pue(df: DataFrame) -> DataFrame:
    """Mean PUE and number of named facilities per company."""
    return (
        df.dropna(subset=["company"])
        .groupBy("company")
        .agg(mean_half_up(F.col("pue_value"), 3, 3).alias("avg_pue"), F.count("facility_name").alias("facility_count"))
    )


def top_operators(df: DataFrame, n: int = 10) -> DataFrame:
    """Best operators by exact mean PUE; Spark keeps only ``n`` rows per task."""
    means = df.dropna(subset=["company"]).groupBy("company").agg(
        F.sum((F.col("pue_value") * 1000).cast("bigint")).alias("_s"),
        F.count("pue_value").alias("_n"),
        F.count("facility_name").alias("facility_count"),
    )
    exact = means.withColumn("avg_pue", half_up_ratio(F.col("_s"), F.col("_n") * 1000, 6))
    return exact.orderBy("avg_pue", "company").limit(n).select("company", "avg_pue", "facility_count")


def india_facilities(df: DataFrame, seq: str = "id") -> DataFrame:
    return (
        df.filter(F.col("country") == "India")
        .orderBy("pue_value", seq)
        .select("company", "facility_name", "city", "pue_value", "pue_type", "capacity_mw", "rack_count")
    )


def india_waste_cost(df: DataFrame, tariff: str = "7.0", target: str = "1.2") -> DataFrame:
    rows = df.filter((F.col("country") == "India") & F.col("capacity_mw").isNotNull())
    pue, mw = F.col("pue_value"), F.col("capacity_mw")
    saving = X.crores(F.greatest(X.saving_mwh(pue, mw, target), dec(0).cast(X.MWH)), dec(tariff))
    return rows.agg(
        F.round(F.sum(X.crores(X.annual_waste_mwh(pue, mw), dec(tariff))), 2).cast("decimal(24,2)").alias("annual_waste_crores"),
        F.round(F.sum(saving), 2).cast("decimal(24,2)").alias("potential_savings_crores"),
    )


def valid_scenarios(scenarios: DataFrame) -> DataFrame:
    """Scenarios within the bounds of the input form."""
    return scenarios.filter(
        F.col("current_pue").between(dec("1.0"), dec("3.0"))
        & F.col("target_pue").between(dec("1.0"), F.col("current_pue"))
        & F.col("capacity_mw").between(dec("0.1"), dec("500.0"))
        & F.col("tariff").between(dec("1.0"), dec("20.0"))
    )


def scenario_results(scenarios: DataFrame) -> DataFrame:
    """Waste now and at the target, saving, cost in crores, CO2 in tons, improvement."""
    now, target, mw, tariff = (F.col(c) for c in ("current_pue", "target_pue", "capacity_mw", "tariff"))
    rows = scenarios.withColumns(
        {"current_waste_mwh": X.annual_waste_mwh(now, mw), "target_waste_mwh": X.annual_waste_mwh(target, mw)}
    ).withColumn("savings_mwh", (F.col("current_waste_mwh") - F.col("target_waste_mwh")).cast(X.MWH))

    def money(mwh: str):
        return F.round(X.crores(F.col(mwh), tariff.cast("decimal(5,2)")), 4).cast("decimal(20,4)")

    return rows.withColumns(
        {
            "current_cost_crores": money("current_waste_mwh"),
            "target_cost_crores": money("target_waste_mwh"),
            "savings_crores": money("savings_mwh"),
            "co2_tons": F.round(F.col("savings_mwh") * dec("0.82"), 2).cast("decimal(20,2)"),
            "pue_improvement_pct": half_up_ratio((now - target) * 100_000, (now * 1000).cast("bigint"), 1),
            "band": X.recommendation_band(now),
        }
    )


def facility_scenarios(facilities: DataFrame, targets: list[str], tariff: str = "7.0") -> DataFrame:
    """Every facility under every target PUE of a list.

    The list is a literal array that is exploded in place, so nothing is joined or shuffled.
    """
    options_ = F.array(*[dec(t).cast("decimal(5,3)") for t in targets])
    rows = facilities.filter(F.col("capacity_mw").isNotNull()).select(
        "*", F.explode(options_).alias("target_pue"), dec(tariff).cast("decimal(6,2)").alias("tariff")
    )
    return scenario_results(valid_scenarios(rows.withColumnRenamed("pue_value", "current_pue")))


def drill_down(df: DataFrame) -> DataFrame:
    """Subtotals over tier, company and facility; ``level`` 0 is a facility, 7 the total.

    Rows are summed up once, to facilities; every coarser level adds up the sums of the finer one.
    """
    keys = ["tier", "company", "facility_name"]
    sums = ["records", "milli", "pues", "capacity_mw"]
    level = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.sum((F.col("pue_value") * 1000).cast("bigint")).alias("milli"),
        F.count("pue_value").alias("pues"), F.sum("capacity_mw").alias("capacity_mw"),
    )
    kinds, levels = {k: df.schema[k].dataType for k in keys}, []
    for n in range(len(keys), -1, -1):
        if n < len(keys):
            level = level.groupBy(*keys[:n]).agg(*[F.sum(c).cast(level.schema[c].dataType).alias(c) for c in sums])
        named = [F.col(k) if i < n else F.lit(None).cast(kinds[k]).alias(k) for i, k in enumerate(keys)]
        levels.append(level.where("records is not null").select(*named, F.lit(2 ** (len(keys) - n) - 1).alias("level"), *sums))
    whole = levels[0]
    for part in levels[1:]:
        whole = whole.unionByName(part)
    mean = F.when(F.col("pues") > 0, half_up_ratio(F.col("milli"), F.col("pues") * 1000, 3))
    return whole.select(*keys, "level", "records", mean.alias("avg_pue"), "capacity_mw")
