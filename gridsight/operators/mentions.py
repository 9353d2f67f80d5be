"""Metric mentions in text, as native array expressions.

Results are pattern-major: all hits of the first pattern in text order, then the second, and
so on.  Hits of overlapping patterns are all kept.
"""

from functools import reduce

from pyspark.sql import Column, functions as F

from gridsight import fixed_values as V
from gridsight.functions.text import FLAGS

_MENTION = "array<struct<value:double,type:string,year:int,context:string>>"
# a hit has at least six characters ("PUE1.2"), so 9 neighbours cover 50 characters
_NEIGHBOURS = 9


def all_hits(text: str, patterns: list[str], group: int = 1) -> Column:
    """Group ``group`` of every hit of every pattern."""
    return F.concat(
        *[F.regexp_extract_all(F.col(text), F.lit(FLAGS + p), F.lit(group)) for p in patterns]
    )


def _any(text: str, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(text).rlike(FLAGS + p) for p in patterns])


def _numbers(strings: Column, type_name: str) -> Column:
    return F.filter(
        F.transform(strings, lambda s: s.try_cast(type_name)), lambda x: x.isNotNull()
    )


def _where(text: str, hint: str, found: Column, type_name: str) -> Column:
    """Run the patterns only on texts that contain a word all of them need."""
    nothing = F.array().cast(f"array<{type_name}>")
    return F.when(F.col(text).rlike(FLAGS + hint), found).otherwise(nothing)


# The mention expressions are written as SQL: the same Column tree, built call by call for
# fifteen patterns, takes seconds before a query even starts.


def _context_sql() -> str:
    """Hit ``i`` of ``h`` with up to 50 characters on both sides.

    ``g`` is the text between the hits, so the surroundings are put together from the nearest
    gaps and hits; no position in the text is needed and the work per hit is constant.
    """
    n, k = V.CONTEXT_CHARS, _NEIGHBOURS
    span = f"greatest(i - {k}, 0) + 1, least(i, {k})"
    before = f"zip_with(slice(g, {span}), slice(h, {span}), (a, b) -> concat(right(a, {n}), right(b, {n})))"
    after = f"zip_with(slice(h, i + 2, {k}), slice(g, i + 3, {k}), (b, a) -> concat(left(b, {n}), left(a, {n})))"
    return (
        f"concat(right(concat(array_join({before}, ''), get(g, i)), {n}), hit, "
        f"left(concat(get(g, i + 1), array_join({after}, '')), {n}))"
    )


def _type_sql(context: str) -> str:
    """First kind whose words occur in the context; operating when none does."""
    whens = " ".join(f"when rlike({context}, r'{FLAGS}{p}') then '{name}'" for name, p in V.PUE_TYPE_PATTERNS)
    return f"case {whens} else '{V.DEFAULT_PUE_TYPE}' end"


def _mentions_sql(text: str, pattern: str) -> str:
    """All mentions of one pattern; the text is only split where there are hits."""
    p = f"r'{FLAGS}{pattern}'"
    year, value = pattern.find(r"(\d{4})"), pattern.find(r"(\d+\.\d+)")
    value_group, year_group = (2, 1) if 0 <= year < value else (1, 2)
    year_sql = f"try_cast(regexp_extract(hit, {p}, {year_group}) as int)" if year >= 0 else "cast(null as int)"
    mention = (
        f"transform(array({_context_sql()}), c -> named_struct("
        f"'value', try_cast(regexp_extract(hit, {p}, {value_group}) as double), 'type', {_type_sql('c')}, "
        rf"'year', {year_sql}, 'context', regexp_replace(c, r'(?U)^\s+|\s+$', '')))[0]"
    )
    each = f"transform(array(split({text}, {p}, -1)), g -> transform(h, (hit, i) -> {mention}))[0]"
    return f"transform(array(regexp_extract_all({text}, {p}, 0)), h -> if(size(h) = 0, {_NONE}, {each}))[0]"


_NONE = f"cast(array() as {_MENTION})"


def pue_mentions(text: str, extended: bool = False) -> Column:
    """array<struct<value, type, year, context>> of the PUE values in 1.0 to 3.0."""
    patterns = V.PUE_PATTERNS + (V.EXTENDED_PUE_PATTERNS if extended else [])
    found = ", ".join(_mentions_sql(f"`{text}`", p) for p in patterns)
    kept = f"filter(concat({found}), m -> m.value between {V.PUE_MIN}D and {V.PUE_MAX}D)"
    return F.expr(f"if(rlike(`{text}`, r'{FLAGS}PUE|Power Usage Effectiveness'), {kept}, {_NONE})")


def wue_values(text: str) -> Column:
    numbers = _numbers(all_hits(text, V.WUE_PATTERNS), "double")
    kept = F.filter(numbers, lambda x: x.between(V.WUE_MIN, V.WUE_MAX))
    return _where(text, r"WUE|Water Usage Effectiveness|per\s*kWh", kept, "double")


def renewable_values(text: str) -> Column:
    """[100] when the text says all energy is renewable, else every percentage named."""
    numbers = _numbers(all_hits(text, V.RENEWABLE_PATTERNS), "int")
    kept = F.filter(numbers, lambda x: x.between(V.RENEWABLE_MIN, V.RENEWABLE_MAX))
    full = F.when(_any(text, V.FULL_RENEWABLE_PATTERNS), F.array(F.lit(100))).otherwise(kept)
    return _where(text, r"renewable|clean|carbon[- ]free", full, "int")


def capacity_values(text: str, extended: bool = False) -> Column:
    patterns = V.CAPACITY_PATTERNS + (V.EXTENDED_CAPACITY_PATTERNS if extended else [])
    numbers = _numbers(all_hits(text, patterns), "double")
    kept = F.filter(numbers, lambda x: (x > V.CAPACITY_ABOVE) & (x <= V.CAPACITY_MAX))
    return _where(text, "MW|megawatt", kept, "double")


def rack_values(text: str) -> Column:
    digits = F.transform(all_hits(text, V.RACK_PATTERNS), lambda s: F.replace(s, F.lit(","), F.lit("")))
    kept = F.filter(_numbers(digits, "int"), lambda x: (x > V.RACKS_ABOVE) & (x <= V.RACKS_MAX))
    return _where(text, "rack", kept, "int")


def years(text: str) -> Column:
    """Distinct years 2010 to 2029, latest first."""
    found = F.sort_array(F.array_distinct(_numbers(all_hits(text, V.YEAR_PATTERNS), "int")), asc=False)
    return _where(text, "20[12]", found, "int")


def location_phrases(text: str) -> Column:
    """array<struct<first, second>>: "located in X" has no second part, "City, Country" has."""
    place, pair = V.LOCATION_PATTERNS
    singles = F.transform(
        F.regexp_extract_all(text, F.lit(FLAGS + place), F.lit(1)),
        lambda s: F.struct(s.alias("first"), F.lit(None).cast("string").alias("second")),
    )
    p = FLAGS + pair
    pairs = F.transform(
        F.regexp_extract_all(text, F.lit(p), F.lit(0)),
        lambda s: F.struct(F.regexp_extract(s, p, 1).alias("first"), F.regexp_extract(s, p, 2).alias("second")),
    )
    return F.concat(singles, pairs)
