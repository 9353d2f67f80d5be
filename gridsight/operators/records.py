"""From texts to records, and the choice between sources."""

from pyspark.sql import Column, DataFrame, functions as F

from gridsight import schemas
from gridsight.operators import mentions as M
from gridsight.operators.joins import salted_join
from gridsight.operators.location import enrich_location, place_in_text


def assemble_records(
    texts: DataFrame,
    as_of: str,
    variant: str = "global",
    text: str = "text",
    extended: bool = False,
) -> DataFrame:
    """One record per PUE mention of a text.

    ``texts`` has company, source_url, source_type and the text; other columns are kept.
    Variants: ``global`` also gives one record without PUE when renewable share, water use or
    capacity are named; ``colocation`` does not; ``india`` does not either, but takes India as
    the place unless the text names a listed city.
    """
    if variant not in ("global", "colocation", "india"):
        raise ValueError(f"unknown variant: {variant}")
    found = texts.withColumns(
        {
            "_mentions": M.pue_mentions(text, extended),
            "_wue": M.wue_values(text),
            "_renewable": M.renewable_values(text),
            "_capacity": M.capacity_values(text, extended),
            "_racks": M.rack_values(text),
            "_years": M.years(text),
        }
    )
    if variant == "india":
        found = found.withColumn("_place", place_in_text(F.col(text)))
    keep = [c for c in texts.columns if c != text]
    rows = found.drop(text)
    # An outer explode, filtered afterwards: for a plain one Spark first filters on the size of
    # the array, and would run all patterns a second time for that.
    rows = rows.select("*", F.explode_outer("_mentions").alias("_m"))
    has_record = F.col("_m").isNotNull()
    if variant == "global":
        has_record |= (F.size("_renewable") > 0) | (F.size("_wue") > 0) | (F.size("_capacity") > 0)
    rows = rows.filter(has_record)

    def first(name: str) -> Column:
        return F.get(F.col(name), F.lit(0))

    types = {f.name: f.dataType for f in schemas.RECORD.fields}
    default_place = F.lit("India" if variant == "india" else None).cast("string")
    record = {
        "facility_name": F.lit(None),
        "city": F.col("_place.city") if variant == "india" else F.lit(None),
        "country": F.coalesce(F.col("_place.country"), default_place) if variant == "india" else default_place,
        "region": default_place,
        "year": F.coalesce(F.nullif(F.col("_m.year"), F.lit(0)), first("_years"), F.year(F.lit(as_of).cast("date"))),
        "pue_value": F.col("_m.value"),
        "pue_type": F.col("_m.type"),
        "capacity_mw": first("_capacity"),
        "rack_count": first("_racks"),
        "renewable_pct": first("_renewable"),
        "wue_l_per_kwh": first("_wue"),
        "extraction_date": F.lit(as_of).cast("date"),
    }
    out = rows.select(*keep, *[c.cast(types[n]).alias(n) for n, c in record.items()])
    return enrich_location(out) if variant == "india" else out


def stamp_company(records: DataFrame, registry: DataFrame, spread: str = "source_url") -> DataFrame:
    """Tier and region of the company overwrite what the record says."""
    info = registry.select("name", "tier", "region")
    return salted_join(records.drop("tier", "region"), info, {"company": "name"}, "left", spread)


def known_facility_records(registry: DataFrame, as_of: str) -> DataFrame:
    """Facilities listed in the registry as records of design PUE."""
    day = F.lit(as_of).cast("date")
    rows = registry.select("name", "tier", "region", "urls", F.explode("facilities").alias("f"))
    return enrich_location(
        rows.select(
            F.col("name").alias("company"),
            F.col("f.facility_name").alias("facility_name"),
            F.col("f.city").alias("city"),
            F.lit("India").alias("country"),
            "region",
            F.year(day).alias("year"),
            F.col("f.pue_design").cast("decimal(5,3)").alias("pue_value"),
            F.lit("design").alias("pue_type"),
            F.col("f.capacity_mw").cast("decimal(10,2)").alias("capacity_mw"),
            F.col("f.rack_count").alias("rack_count"),
            F.lit(None).cast("int").alias("renewable_pct"),
            F.lit(None).cast("decimal(10,3)").alias("wue_l_per_kwh"),
            F.get("urls", F.lit(0)).alias("source_url"),
            F.lit("estimated").alias("source_type"),
            day.alias("extraction_date"),
            "tier",
        )
    )


def route_urls(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add ``kind``: report file or web page."""
    u = F.lower(F.col(url))
    return urls.withColumn("kind", F.when(F.contains(u, F.lit("pdf")), "pdf").otherwise("html"))


def first_source_with_data(candidates: DataFrame, key: str = "company", spread: str = "id") -> DataFrame:
    """Rows of the best (stage, hit) that has any row, per company.

    The best pair is one pre-aggregated row per company, joined back with salt, so a large
    company is never gathered in one window or task.
    """
    best = candidates.groupBy(key).agg(F.min(F.struct("stage", "hit")).alias("_b"))
    best = best.select(key, F.col("_b.stage").alias("stage"), F.col("_b.hit").alias("hit"))
    return salted_join(candidates, best, [key, "stage", "hit"], "left_semi", spread)


def extraction_summary(records: DataFrame, companies: DataFrame) -> DataFrame:
    """Counters of a run over ``companies``, in one row."""
    found = records.select("company", "pue_value", F.lit(False).alias("_asked"))
    asked = companies.select(F.lit(None).cast("string").alias("company"), F.lit(None).cast(found.schema["pue_value"].dataType).alias("pue_value"), F.lit(True).alias("_asked"))
    return found.unionByName(asked).agg(
        F.count_if("_asked").alias("companies_processed"),
        F.count_if(~F.col("_asked")).alias("records_extracted"),
        F.count_distinct("company").alias("companies_with_data"),
        F.count("pue_value").alias("records_with_pue"),
    )
