"""Explicit schemas.  Nothing in this package infers a schema from data."""

from pyspark.sql import types as T

_TEXT, _INT = T.StringType(), T.IntegerType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# the sixteen columns every extracted record is projected onto
RECORD = _struct(
    {
        "company": _TEXT,
        "facility_name": _TEXT,
        "city": _TEXT,
        "country": _TEXT,
        "region": _TEXT,
        "year": _INT,
        "pue_value": T.DecimalType(5, 3),
        "pue_type": _TEXT,
        "capacity_mw": T.DecimalType(10, 2),
        "rack_count": _INT,
        "renewable_pct": _INT,
        "wue_l_per_kwh": T.DecimalType(10, 3),
        "source_url": _TEXT,
        "source_type": _TEXT,
        "extraction_date": T.DateType(),
        "tier": _TEXT,
    }
)
# the same as files hold them: numbers as text, so that nothing is lost before it is checked
UNCHECKED = T.StructType([T.StructField(f.name, _TEXT if f.name in (
    "year", "pue_value", "capacity_mw", "rack_count", "renewable_pct", "wue_l_per_kwh") else f.dataType) for f in RECORD.fields])
# plus the two columns location enrichment fills
ENRICHED = T.StructType(
    RECORD.fields + _struct({"avg_temp_celsius": T.DecimalType(5, 2), "country_code": _TEXT}).fields
)
# plus the row id of the warehouse table
RAW = T.StructType([T.StructField("id", _TEXT)] + ENRICHED.fields)

COMPANY_REGISTRY = (
    "name string, tier string, region string, urls array<string>, "
    "facilities array<struct<facility_name:string,city:string,capacity_mw:decimal(10,2),"
    "rack_count:int,pue_design:decimal(5,3),source_type:string>>"
)
RUN_SUMMARY = "run_at timestamp, key string, value string"
