"""Data-quality checks: row validation, constraint gate and declarative tests."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from gridsight import fixed_values as V
from gridsight.functions.numbers import dec
from gridsight.operators.joins import salted_join


def _number(col: Column) -> Column:
    """The whole value, no digit cut off; NULL for what is no number."""
    return col.try_cast("double")


def valid_pue(col: Column) -> Column:
    return F.coalesce(_number(col).between(dec(V.PUE_MIN), dec(V.PUE_MAX)), F.lit(False))


def _optional(col: Column, ok: Column) -> Column:
    """A missing value passes, one that is no number does not."""
    return col.isNull() | F.coalesce(ok, F.lit(False))


# Whole-number checks look at the value without its fraction: 100.9 counts as 100, so the
# upper bound is "below 101".


def valid_renewable(col: Column) -> Column:
    return _optional(col, (_number(col) > V.RENEWABLE_MIN - 1) & (_number(col) < V.RENEWABLE_MAX + 1))


def valid_wue(col: Column) -> Column:
    return _optional(col, _number(col).between(V.WUE_MIN, V.WUE_MAX))


def valid_capacity(col: Column) -> Column:
    return _optional(col, (_number(col) > V.CAPACITY_ABOVE) & (_number(col) <= V.CAPACITY_MAX))


def valid_racks(col: Column) -> Column:
    return _optional(col, (_number(col) >= V.RACKS_ABOVE + 1) & (_number(col) < V.RACKS_MAX + 1))


def valid_year(col: Column, as_of_year: int) -> Column:
    return _optional(col, (_number(col) >= V.YEAR_MIN) & (_number(col) < as_of_year + 2))


def _checks(as_of_year: int, columns: list[str]) -> list[tuple[str, Column, Column]]:
    """(column, does it pass, message when it does not) of every check, in report order."""
    found = []
    for name in ("company", "pue_value"):
        present = F.col(name).isNotNull() if name in columns else F.lit(False)
        found.append((name, present, F.lit(f"Missing required field: {name}")))
    ranges = [
        ("pue_value", valid_pue, "Invalid PUE value: "),
        ("renewable_pct", valid_renewable, "Invalid renewable %: "),
        ("wue_l_per_kwh", valid_wue, "Invalid WUE: "),
        ("capacity_mw", valid_capacity, "Invalid capacity: "),
        ("rack_count", valid_racks, "Invalid rack count: "),
        ("year", lambda c: valid_year(c, as_of_year), "Invalid year: "),
    ]
    for name, check, text in ranges:
        if name in columns:
            shown = F.coalesce(F.col(name).cast("string"), F.lit("None"))
            found.append((name, check(F.col(name)), F.concat(F.lit(text), shown)))
    return found


def row_errors(as_of_year: int, columns: list[str]) -> Column:
    """Array of messages, empty for a valid row; checks on absent columns are left out."""
    return F.array_compact(F.array(*[F.when(~ok, message) for _, ok, message in _checks(as_of_year, columns)]))


def with_errors(df: DataFrame, as_of_year: int) -> DataFrame:
    return df.withColumn("errors", row_errors(as_of_year, df.columns))


def passes(as_of_year: int, columns: list[str], missing_pue: bool = False) -> Column:
    """Does a row pass every check?  With ``missing_pue`` a missing PUE does, since it will be
    estimated: the defaults of the tiers are all valid."""
    def ok(name: str, check: Column) -> Column:
        return check | F.col(name).isNull() if missing_pue and name == "pue_value" else check

    return reduce(and_, [ok(name, check) for name, check, _ in _checks(as_of_year, columns)])


def valid_rows(df: DataFrame, as_of_year: int) -> DataFrame:
    """Only rows that pass every check; no message is built for them."""
    return df.filter(passes(as_of_year, df.columns))


def error_messages(df: DataFrame, as_of_year: int, row: str = "id") -> DataFrame:
    """One message per invalid row."""
    bad = with_errors(df, as_of_year).filter(F.size("errors") > 0)
    return bad.select(
        row,
        F.concat(
            F.lit("Row "), F.col(row), F.lit(" ("), F.coalesce("company", F.lit("None")), F.lit("): "),
            F.array_join("errors", ", "),
        ).alias("message"),
    )


def constraint_reasons() -> Column:
    """Why a row may not enter the fact table; empty when it may."""
    pue, renewable = F.col("pue_value"), F.col("renewable_pct")
    return F.array_compact(
        F.array(
            F.when(F.col("year").isNull(), "year_not_null"),
            F.when(pue.isNull(), "pue_not_null"),
            F.when(~pue.between(dec(V.PUE_MIN), dec(V.PUE_MAX)), "pue_range"),
            F.when(~renewable.between(V.RENEWABLE_MIN, V.RENEWABLE_MAX), "renewable_range"),
        )
    )


def split_by_constraints(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the constraints, and the others with their reasons.

    One bad row is rejected alone; it does not take a batch with it.
    """
    judged = df.withColumn("reasons", constraint_reasons())
    good = judged.filter(F.size("reasons") == 0).drop("reasons")
    return good, judged.filter(F.size("reasons") > 0)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL is not tested, as in SQL."""
    return (
        df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: list, where: Column | None = None, severity: str = "error") -> DataFrame:
    """Values outside the accepted list with their counts."""
    rows = df if where is None else df.filter(where)
    return (
        rows.filter(~F.col(column).isin(accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .withColumn("severity", F.lit(severity))
    )


def orphans(fact: DataFrame, dim: DataFrame, key: str, spread: str = "fact_id", hot: DataFrame | None = None) -> DataFrame:
    """Fact rows whose key is set but absent from the dimension."""
    return salted_join(fact.filter(F.col(key).isNotNull()), dim.select(key), [key], "left_anti", spread, hot)


REQUIRED_OUTPUT = ["company", "pue_value", "tier", "city", "country", "year", "pue_type"]


def output_contract(df: DataFrame) -> DataFrame:
    """One row of booleans about the cleaned table; unknown years are not judged."""
    has = set(df.columns)
    return df.agg(
        F.lit(all(c in has for c in REQUIRED_OUTPUT)).alias("has_columns"),
        (F.count(F.lit(1)) > 0).alias("not_empty"),
        F.coalesce(F.bool_and(valid_pue(F.col("pue_value"))), F.lit(True)).alias("pue_in_range"),
        F.coalesce(F.bool_and(F.col("company").isNotNull()), F.lit(True)).alias("company_present"),
        F.coalesce(F.bool_and(F.col("year").between(2000, 2030)), F.lit(True)).alias("year_in_range"),
    )


def size_gate(df: DataFrame, min_rows: int = V.MIN_ROWS, min_companies: int = V.MIN_COMPANIES) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("total_facilities"), F.count_distinct("company").alias("total_companies")
    )
    ok = (F.col("total_facilities") >= min_rows) & (F.col("total_companies") >= min_companies)
    return counted.withColumn("meets_requirements", ok)
