"""String expressions."""

from pyspark.sql import Column, functions as F

from gridsight import fixed_values as V

# Java needs these flags to treat letters, digits, blanks and line ends of any script the
# way the patterns mean them: ignore case, Unicode classes, only "\n" ends a line.
FLAGS = "(?iUd)"


def strip(col: Column) -> Column:
    """Trim any white space, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def title_case(col: Column) -> Column:
    """Upper-case every letter that does not follow a letter, lower-case the others.

    ``initcap`` only starts a word after a blank, so it serves texts of letters and blanks; the
    others are taken apart.
    """
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capital = F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.substring(r, 2, 2**31 - 1)))
    return F.when(col.rlike(r"[^\p{L} ]"), F.array_join(capital, "")).otherwise(F.initcap(col))


def lookup(col: Column, table: dict, default: Column | None = None) -> Column:
    """Small constant map; keys that are not in it give ``default``."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), col)
    return found if default is None else F.coalesce(found, default)


def normalize_city(col: Column) -> Column:
    """Trimmed title case with old names replaced; a missing city is the empty string."""
    name = title_case(strip(col))
    return F.when(F.coalesce(col, F.lit("")) == "", F.lit("")).otherwise(
        lookup(name, V.CITY_ALIASES, name)
    )


def clean_text(col: Column) -> Column:
    """One blank for every run of white space; only word characters and plain marks stay."""
    one_line = F.regexp_replace(col, r"(?U)\s+", " ")
    return strip(F.regexp_replace(one_line, r"(?U)[^\w\s.,;:!?%\-()]", ""))


def fixed_point(col: Column, digits: int, suffix: str = "", missing: str = "N/A") -> Column:
    """Decimal column as text with ``digits`` decimals."""
    text = F.round(col, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.coalesce(F.concat(text, F.lit(suffix)), F.lit(missing))


def contains_blank_free(haystack: Column, needle: Column) -> Column:
    """Does the lower-case text contain the lower-case needle written without blanks?"""
    return F.contains(F.lower(haystack), F.replace(F.lower(needle), F.lit(" "), F.lit("")))
