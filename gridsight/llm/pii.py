"""Personal data by candidate generation and boosted trees, all of it in Spark SQL.

Generators with high recall propose spans that may overlap.  Every candidate is described by a
few small numbers: format (digits, groups, separators, checksums) and context (neighbouring
characters, a word that announces personal data).  All candidates of the corpus are counted per
description, a table of bounded size, on which small trees are boosted per kind.  A candidate is a
positive example by evidence that does not look at the exact pattern (``right`` of ``described``): what it says
without its disguise passes the check of its kind, its shape is one that such data is written in,
a number without a sign of its own is announced, and it is no date.  The trees become one CASE
expression.  Per kind, the threshold is the lowest score at which candidates set aside for it are
right in ``PRECISION`` of the cases; only candidates that touch nothing the exact rules find count
there, because only they can be added.  What the exact rules find always stays; candidates above
the threshold that touch none of it are added.
"""

import math
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import stored, table

KINDS = ("email", "ip", "card", "phone")

# The exact patterns.  Possessive repeats and the look behind change no match, they
# keep the search linear: what begins within a run of the class fails as its beginning did.
LOCAL = "[A-Za-z0-9._%+-]"
EXACT = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The generators.  A written telephone number is at most 33 characters long.
WIDE = {
    "email": rf"(?i)(?:(?<!{LOCAL})|\G){LOCAL}++(?:\x20?[(\[]at[)\]]\x20?|@)[A-Za-z0-9-]++(?:(?:\x20?[(\[]dot[)\]]\x20?|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++[.,:_][0-9]++[.,:_][0-9]++[.,:_][0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]?[0-9]){12}(?:[\x20./_-]?[0-9])*+",
    "phone": r"(?:\+|(?<![0-9(]))[0-9(][\x20().0-9/-]{5,30}[0-9]",
}
#: A text that lacks these has no match of the kind.
HINT = {"email": "@|(?i)[(\\[]at[)\\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
EXACT_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
#: A word that announces data of the kind, with a few small words behind it.
ANNOUNCED = {"email": "contact|mail|e-mail|email|address", "ip": "ip|server|host|address", "card": "card|visa|credit|mastercard|amex", "phone": "call|phone|tel|telephone|mobile|cell|fax|contact"}
CONTEXT = r"(?i)\b(?:%s)\b(?:[^a-z]{1,4}(?:me|us|him|her|them|at|on|is|was|number|no|now))*[^a-z]{0,12}$"
YEAR = "(?:19|20)[0-9]{2}"
#: Day, month and year in either order, eight digits of a date, or two years.
DATE = rf"^\(?(?:{YEAR}[-/.\x20][01]?[0-9][-/.\x20][0-3]?[0-9](?![0-9])|[0-3]?[0-9][-/.\x20][0-3]?[0-9][-/.\x20]{YEAR}(?![0-9])|{YEAR}[01][0-9][0-3][0-9](?![0-9])|{YEAR}[-/\x20]+{YEAR}(?![0-9]))"
#: Characters before a candidate that are looked at.
BEFORE = 24

#: The description of a candidate: name and number of values.
FEATURES = {"kind": 4, "digits": 24, "letters": 4, "groups": 6, "separator": 6, "luhn": 2, "octets": 2, "plus": 2, "at": 2, "edge": 4, "context": 2, "longest": 8, "date": 2, "ending": 2, "even": 2, "fours": 2}
ROUNDS, RATE, LEAVES_PULL = 24, 0.4, 1.0
PRECISION = 0.99


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches as structs of start and end (code points, end exclusive), the match, and the
    text up to the previous and the next match; an empty array for a text without them.

    Splitting a text at a pattern gives what lies between its matches, so lengths give places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rest = F.split(text, pattern, -1)
    n = F.size(found)
    both = F.arrays_zip(F.slice(rest, F.lit(1), n).alias("gap"), found.alias("m"), F.slice(rest, F.lit(2), n).alias("next"))
    kind = "array<struct<start:int,end:int,m:string,gap:string,next:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["m"])
        return F.struct(end.alias("at"), F.array_append(s["out"], F.struct(
            begin.alias("start"), end.alias("end"), x["m"].alias("m"), F.substring(x["gap"], -BEFORE, BEFORE).alias("gap"), F.substring(x["next"], 1, 1).alias("next"))).alias("out"))

    return F.when(text.rlike(hint), F.aggregate(both, start, step, lambda s: s["out"])).otherwise(F.array().cast(kind))


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(F.pmod(n - i, F.lit(2)) == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return s + doubled

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)) == 0


def only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def plain_address(m: Column) -> Column:
    """An address with its written-out at and dots as signs."""
    return F.regexp_replace(F.regexp_replace(m, r"(?i)\x20?[(\[]at[)\]]\x20?", "@"), r"(?i)\x20?[(\[]dot[)\]]\x20?", ".")


def octets(m: Column) -> Column:
    return m.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:[.,:_]|$)){4}$")


def valid(kind: str, m: Column) -> Column:
    digits = only_digits(m)
    if kind == "ip":
        return octets(m)
    if kind == "card":
        return F.when(F.char_length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """What the exact rules of a kind find: an array of structs of start and end, by start."""
    found = F.filter(matches(text, EXACT[kind], EXACT_HINT[kind]), lambda x: valid(kind, x["m"]))
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def candidates(text: Column, kind: str) -> Column:
    """What the generator of a kind proposes, described."""
    return F.transform(matches(text, WIDE[kind], HINT[kind]), lambda c: described(kind, c))


def named(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda c: ~F.exists(others, lambda b: (c["start"] < b["end"]) & (b["start"] < c["end"])))


def described(kind: str, c: Column) -> Column:
    """A candidate with its features, every one of them a small whole number, and whether it is
    right by evidence that is independent of the exact pattern."""
    m = c["m"]
    digits = only_digits(m)
    n = F.char_length(digits)

    def held(x: Column, name: str) -> Column:
        return F.least(x, F.lit(FEATURES[name] - 1)).cast("int").alias(name)

    groups = F.split(m, "[^0-9]+", -1)
    separators = F.regexp_replace(m, "[0-9A-Za-z]", "")
    sep = F.when(separators == "", 0).when(separators.rlike(r"^\x20+$"), 1).when(separators.rlike("^-+$"), 2).when(separators.rlike(r"^\.+$"), 3).when(separators.rlike(r"^[\x20.-]+$"), 4).otherwise(5)
    edge = F.when(F.substring(c["gap"], -1, 1).rlike("[0-9A-Za-z]"), 1).otherwise(0) + F.when(c["next"].rlike("[0-9A-Za-z]"), 2).otherwise(0)
    even, fours = F.replace(separators, F.substring(separators, 1, 1), F.lit("")) == "", m.rlike(r"^[0-9]{4}(?:[^0-9][0-9]{4}){3}(?:[^0-9][0-9]{1,3})?$")
    announced, date, whole = c["gap"].rlike(CONTEXT % ANNOUNCED[kind]), m.rlike(DATE), edge == 0
    ending = plain_address(m).rlike(r"\.[A-Za-z]{2,}$") if kind == "email" else F.lit(False)
    yes = lambda x: F.when(x, 1).otherwise(0)
    right = {
        "email": ending,
        "ip": octets(m) & even & whole & (announced | separators.startswith(".")),
        "card": valid("card", m) & whole & even & ((separators == "") | fours),
        "phone": valid("phone", m) & whole & ~date & ~octets(m) & (m.startswith("+") | announced),
    }[kind]
    return F.struct(
        c["start"].alias("start"), c["end"].alias("end"),
        F.lit(KINDS.index(kind)).alias("kind"), held(n, "digits"), held(F.char_length(m) - n - F.char_length(separators), "letters"),
        held(F.size(groups), "groups"), held(sep, "separator"), held(yes(F.when(n.between(12, 19), luhn(digits)).otherwise(F.lit(False))), "luhn"),
        held(yes(octets(m)), "octets"), held(yes(m.startswith("+")), "plus"), held(yes(m.contains("@")), "at"), held(edge, "edge"),
        held(yes(announced), "context"), held(F.array_max(F.transform(groups, F.char_length)), "longest"),
        held(yes(date), "date"), held(yes(ending), "ending"), held(yes(even), "even"), held(yes(fours), "fours"), yes(right).alias("right"),
    )


def _split_gain(sums: dict, total: tuple[float, float], value: int) -> tuple[float, float, float]:
    g = sum(a for v, (a, _) in sums.items() if v <= value)
    h = sum(b for v, (_, b) in sums.items() if v <= value)
    rest_g, rest_h = total[0] - g, total[1] - h
    gain = g * g / (h + LEAVES_PULL) + rest_g * rest_g / (rest_h + LEAVES_PULL) - total[0] ** 2 / (total[1] + LEAVES_PULL)
    return gain, g / (h + LEAVES_PULL), rest_g / (rest_h + LEAVES_PULL)


def _best_split(cells: list[tuple]) -> tuple | None:
    """The feature and value that split these cells best, with the two leaves' values."""
    total = sum(c[1] for c in cells), sum(c[2] for c in cells)
    best = None
    for f in range(len(FEATURES)):
        sums: dict[int, tuple[float, float]] = {}
        for x, g, h in cells:
            a, b = sums.get(x[f], (0.0, 0.0))
            sums[x[f]] = a + g, b + h
        for value in sorted(sums)[:-1]:
            found = _split_gain(sums, total, value)
            if found[0] > 1e-9 and (best is None or found[0] > best[0] + 1e-12):
                best = (*found, f, value)
    return best


def boost(cells: list[tuple[tuple[int, ...], float, float]]) -> tuple[float, list]:
    """Logistic boosting of trees with up to four leaves on counted cells (features, positive,
    all): the start value and the trees.  A tree is a number, or (feature, value, low, high)."""
    yes, everything = sum(c[1] for c in cells), sum(c[2] for c in cells)
    start = math.log((yes + 0.5) / (everything - yes + 0.5))
    scores, trees = [start] * len(cells), []
    for _ in range(ROUNDS):
        rows = []
        for (x, pos, n), s in zip(cells, scores):
            p = 1 / (1 + math.exp(-s))
            rows.append((x, pos - n * p, n * p * (1 - p)))
        first = _best_split(rows)
        if first is None:
            break
        _, low, high, f, value = first
        sides = []
        for leaf, part in ((low, [r for r in rows if r[0][f] <= value]), (high, [r for r in rows if r[0][f] > value])):
            second = _best_split(part)
            sides.append(RATE * leaf if second is None else (second[3], second[4], RATE * second[1], RATE * second[2]))
        tree = (f, value, *sides)
        trees.append(tree)
        scores = [s + predict(tree, x) for s, (x, _, _) in zip(scores, cells)]
    return start, trees


def predict(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def tree_sql(tree, row: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(row[list(FEATURES)[tree[0]]] <= tree[1], tree_sql(tree[2], row)).otherwise(tree_sql(tree[3], row))


def threshold(cells: list[tuple[tuple[int, ...], float, float]], start: float, trees: list) -> float:
    """The lowest score from which on ``PRECISION`` of the candidates are right, and at which
    itself most are."""
    at: Counter = Counter()
    right: Counter = Counter()
    for x, pos, n in cells:
        s = start + sum(predict(t, x) for t in trees)
        at[s] += n
        right[s] += pos
    chosen, n, good = math.inf, 0.0, 0.0
    for s in sorted(at, reverse=True):
        n, good = n + at[s], good + right[s]
        if good >= PRECISION * n and 2 * right[s] > at[s]:
            chosen = s
    return chosen


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the kept columns, the exact spans per kind (arrays ``email``, ``ip``, ``card``,
    ``phone``) and ``spans``: all of them and the added ones, as structs of kind (its place in
    ``KINDS``), start and end, by kind and start.

    A null text counts as empty and has no spans.  Repeated rows repeat; other columns are
    ignored, whatever their names.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(c).alias(f"_keep_{c}") for c in keep], body.alias("text"))
    body = F.col("text")
    rows = rows.select("doc_id", *[f"_keep_{c}" for c in keep], *[base_spans(body, k).alias(k) for k in KINDS], *[candidates(body, k).alias(f"wide_{k}") for k in KINDS])
    rows = stored(rows.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(5))), "candidates")

    # one row per description: at most the product of the features' sizes, in practice few
    base = F.concat(*[F.col(k) for k in KINDS])
    each = []
    for k in KINDS:
        one = rows.select("fold", base.alias("base"), F.explode(f"wide_{k}").alias("c"))
        free = ~F.exists("base", lambda b: (F.col("c.start") < b["end"]) & (b["start"] < F.col("c.end")))
        each.append(one.select((F.col("fold") == 0).alias("aside"), free.alias("free"), *[F.col(f"c.{f}").alias(f) for f in FEATURES], F.col("c.right").alias("right")))
    counted = reduce(DataFrame.union, each).groupBy("aside", "free", *FEATURES).agg(F.sum("right").alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    models = {}
    for i, k in enumerate(KINDS):
        cells: dict[tuple[bool, bool], list] = {(a, f): [] for a in (True, False) for f in (True, False)}
        for r in sorted(counted, key=lambda r: tuple(r)):
            if r["kind"] == i:
                cells[r["aside"], r["free"]].append((tuple(r[f] for f in FEATURES), float(r["pos"]), float(r["n"])))
        start, trees = boost(cells[False, True] + cells[False, False])
        # without a candidate set aside, those that were learned from must do
        models[k] = start, trees, threshold(cells[True, True] or cells[False, True], start, trees)

    def chosen(k: str) -> Column:
        start, trees, cut = models[k]
        if cut == math.inf:
            return F.array().cast("array<struct<kind:int,start:int,end:int>>")
        # scores are sums of floats: what stands at the threshold stays on its side
        above = F.filter(F.col(f"wide_{k}"), lambda c: reduce(lambda a, t: a + tree_sql(t, c), trees, F.lit(start)) >= cut - 1e-9)
        return named(apart(above, base), k)

    rows = rows.select("*", *[chosen(k).alias(f"more_{k}") for k in KINDS])
    # added spans of two kinds may overlap each other: the kind listed first stays
    more = [F.col(f"more_{k}") for k in KINDS]
    added = [apart(x, F.concat(*more[:i])) if i else x for i, x in enumerate(more)]
    exact = [named(F.col(k), k) for k in KINDS]
    return rows.select("doc_id", *[F.col(f"_keep_{c}").alias(c) for c in keep], *KINDS, F.array_sort(F.concat(*exact, *added)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named
    after the first of them."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("to"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], -s["to"]).alias("at"), F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(by_start, start, step)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text))))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    exact = [named(F.col(k), k) for k in KINDS]
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.concat(*exact)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
