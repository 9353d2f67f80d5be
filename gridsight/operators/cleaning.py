"""Schema normalising, back-filling and imputing."""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridsight import fixed_values as V
from gridsight import schemas
from gridsight.functions.numbers import dec, nan_to_null, safe_number
from gridsight.functions.text import lookup
from gridsight.operators.joins import salted_join


def typed(col: Column, kind: T.DataType) -> Column:
    """A value as the storage type: rounded, cut to a whole number, or NULL if it does not fit."""
    if isinstance(kind, T.IntegerType):
        return col.try_cast("double").try_cast(kind)
    return col.try_cast(kind)


def normalize_schema(df: DataFrame, schema: T.StructType = schemas.RECORD, extra: tuple[str, ...] = (), keep_numbers: bool = False) -> DataFrame:
    """Project onto the fixed columns; a column that is missing, and a cell that does not fit its
    type, becomes NULL.  With ``keep_numbers`` the numeric columns stay as they came, for checks
    that must see what was there."""
    def column(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        same = df.schema[f.name].dataType == f.dataType or keep_numbers and isinstance(f.dataType, T.NumericType)
        return F.col(f.name) if same else typed(F.col(f.name), f.dataType).alias(f.name)

    return df.select(*[e for e in extra if e in df.columns], *[column(f) for f in schema.fields])


def with_storage_types(df: DataFrame, schema: T.StructType = schemas.RECORD) -> DataFrame:
    """The columns of the schema in their storage types; others as they are."""
    wanted = {f.name: f.dataType for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType}
    return df.withColumns({c: typed(F.col(c), t) for c, t in wanted.items()}) if wanted else df


def keep_allowed(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Columns of the allow-list that exist, in its order."""
    return df.select([c for c in allowed if c in df.columns])


def nan_cells_to_null(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floating}) if floating else df


def convert(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed columns; cells that cannot be converted become NULL."""
    return df.withColumns({c: safe_number(F.col(c), t) for c, t in types.items()})


def _without_tier() -> Column:
    return F.coalesce("tier", F.lit("")) == ""


def wanted_tier() -> Column:
    """The name under which a row without a tier is looked up; NULL for the others."""
    return F.when(_without_tier(), F.lower("company"))


def backfill_tier(df: DataFrame, registry: DataFrame, spread: str | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Missing tier from the company registry, by name without regard to case.

    Only rows without a tier look at the registry; the others carry a NULL join key and pass.
    ``spread`` names a column that differs from row to row; by default the whole row is used.
    ``hot`` (``frequent_keys`` of ``wanted_tier`` named ``_wanted``) spares a pass to find them.
    """
    missing = _without_tier()
    known = registry.groupBy(F.lower("name").alias("_name")).agg(F.min_by("tier", "name").alias("_tier"))
    wanted = df.withColumn("_wanted", wanted_tier())
    salt = F.col(spread) if spread else F.xxhash64(*df.columns)
    joined = salted_join(wanted, known, {"_wanted": "_name"}, "left", salt, hot)
    return joined.withColumn("tier", F.when(missing, F.col("_tier")).otherwise(F.col("tier"))).drop("_wanted", "_tier")


def mark_estimates(df: DataFrame, missing: Column) -> DataFrame:
    """Type and source of rows whose PUE is estimated."""
    return df.withColumns(
        {
            "pue_type": F.when(missing, "estimated").otherwise(F.col("pue_type")),
            "source_type": F.when(missing, "benchmark").otherwise(F.col("source_type")),
        }
    )


def estimated_pue(df: DataFrame, missing: Column) -> DataFrame:
    """The default of the tier where the PUE is missing."""
    kind = df.schema["pue_value"].dataType
    default = lookup(F.col("tier"), {k: Decimal(v) for k, v in V.TIER_DEFAULT_PUE.items()}, dec(V.FALLBACK_PUE)).cast("decimal(5,3)")
    return df.withColumn("pue_value", F.when(missing, default if isinstance(kind, T.DecimalType) else default.cast(kind)).otherwise(F.col("pue_value")))


def fill_missing_pue(df: DataFrame) -> DataFrame:
    """A missing PUE becomes the default of the tier and the row is marked as an estimate.

    Only an absent value is missing; one that is no number stays, and validation rejects it.
    """
    missing = F.col("pue_value").isNull()
    return estimated_pue(mark_estimates(df, missing), missing)


def append_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def selected(df: DataFrame, **equals: str | None) -> DataFrame:
    """Equality filters; ``None`` and ``"All"`` do not filter."""
    for name, value in equals.items():
        if value is not None and value != "All":
            df = df.filter(F.col(name) == value)
    return df


def companies_where(registry: DataFrame, name: str | None = None, tier: str | None = None, region: str | None = None) -> DataFrame:
    """Look up by exact name, or by part of the tier or region, without regard to case."""
    if name is not None:
        registry = registry.filter(F.lower("name") == name.lower())
    if tier is not None:
        registry = registry.filter(F.contains(F.lower("tier"), F.lit(tier.lower())))
    if region is not None:
        registry = registry.filter(F.contains(F.lower("region"), F.lit(region.lower())))
    return registry


def in_tier(tier: Column, part: str) -> Column:
    """Does the tier name contain the text?  An unknown tier does not."""
    return F.coalesce(F.contains(tier, F.lit(part)), F.lit(False))
