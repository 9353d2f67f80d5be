"""A Merkle manifest of a data set: leaves, proofs and roots by nested-struct roll-up.

Leaves are numbered within their source.  The digits of that number (base 16) are grouped away
one after the other: 16 leaves become a struct with their hash and the leaves inside, 16 of these
become the next, and so on within a block of three digits (4,096 leaves), for which the rows meet
once.  Only the hashes of blocks go on to the next tier, again in blocks of 4,096, until every
source is one node; the sources are then rolled up the same way.  Proofs are emitted from the
nested structs by transform and explode, going down: siblings are never looked up by a join of
leaves.  One row per block of 4,096 is handed the path above it.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import stored, table

FAN, DIGITS = 16, 3
BLOCK = FAN**DIGITS
PATH = "array<struct<before:string,after:string>>"


def hashed(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts, put together."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return hashed(*[framed(v) for v in values])


def fold(node: Column, path: Column) -> Column:
    """The root that ``node`` and the siblings on its path lead to."""
    return F.aggregate(path, node, lambda at, s: hashed(s["before"], at, s["after"]))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"])))


def _numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, within ``group``, by ``order``) and ``n`` (rows of the group).

    One sort by ranges, whatever the groups are: a group with a third of the rows is cut into many
    ranges, and rows that repeat are told apart by their place.  The rows before a range are a
    sum over (range, group), a table with one row per range plus one per group.
    """
    # "_m" is taken from a table that is written, so it is the same in every run of a task
    named = rows.select("*", F.monotonically_increasing_id().alias("_m"))
    placed = named.repartitionByRange(group, *order, "_m").sortWithinPartitions(group, *order, "_m").drop("_m")
    placed = stored(placed.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i")), "ordered")
    counts = stored(placed.groupBy("_p", group).agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_first")), "ranges")
    # a group's ranges are summed up in one task: as many rows as the sort has partitions at most
    pieces = counts.groupBy(group).agg(F.sum("_c").alias("n"), F.array_sort(F.collect_list(F.struct("_p", "_c", "_first"))).alias("_pieces"))
    running = F.aggregate("_pieces", F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<struct<p:int,skip:bigint>>").alias("out")),
                          lambda s, x: F.struct((s["sum"] + x["_c"]).alias("sum"), F.concat(s["out"], F.array(F.struct(x["_p"].alias("p"), (s["sum"] - x["_first"]).alias("skip")))).alias("out")))
    skips = pieces.select(F.col(group).alias("_g"), "n", F.inline(running["out"])).withColumnsRenamed({"p": "_q"})
    joined = placed.join(skips, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*rows.columns, (F.col("_i") + F.col("skip")).alias("rank"), "n")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of a tier from ``g, rank, n, node, payload``: g, block, n, hash, and the nested tree.

    ``levels`` is how many of the block's three levels exist: a group stops at a single node.
    """
    left, levels = F.col("n"), F.lit(0)
    for _ in range(DIGITS):
        levels = levels + (left > 1).cast("int")
        left = F.ceil(left / FAN)
    digit = [F.shiftright("rank", 4 * i).bitwiseAND(F.lit(FAN - 1)).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select("g", F.shiftright("rank", 4 * DIGITS).alias("block"), "n", levels.alias("levels"), *digit, "node", "payload")
    keys = ["g", "block", "n", "levels"]
    rows = rows.repartition("g", "block")  # the one exchange: all groupings below hold within it
    for i in range(DIGITS):
        rest = [f"d{j}" for j in range(i + 1, DIGITS)]
        inner = ["node", "payload"] if i == 0 else ["node", "kids"]
        grouped = rows.groupBy(*keys, *rest).agg(F.array_sort(F.collect_list(F.struct(F.col(f"d{i}").alias("d"), *inner)), lambda a, b: a["d"] - b["d"]).alias("kids"))
        up = F.concat_ws("", F.col("kids.node"))
        rows = grouped.withColumn("node", F.when(F.col("levels") > i, F.sha2(up, 256)).otherwise(F.col("kids")[0]["node"]))
    return rows


def _with_siblings(inner: str) -> Column:
    """What hangs on each of the kids, and the hashes left and right of it."""
    nodes = F.col("kids.node")

    def step(k: Column, at: Column) -> Column:
        own = F.struct(F.concat_ws("", F.slice(nodes, F.lit(1), at)).alias("before"), F.concat_ws("", F.slice(nodes, at + 2, F.lit(FAN))).alias("after"))
        return F.struct(own.alias("own"), k[inner].alias(inner))

    return F.transform("kids", step)


def _unfolded(blocks: DataFrame, upper: str) -> DataFrame:
    """payload, and ``path``: siblings within the block, then the path in column ``upper``."""
    rows = blocks.select("levels", F.col(upper).alias("path"), "kids", "root", "top")
    for i in reversed(range(DIGITS)):
        inner = "kids" if i else "payload"
        rows = rows.select("levels", "path", "root", "top", F.explode(_with_siblings(inner)).alias("e"))
        path = F.when(F.col("levels") > i, F.concat(F.array("e.own"), F.col("path"))).otherwise(F.col("path"))
        rows = rows.select("levels", path.alias("path"), "root", "top", F.col(f"e.{inner}").alias(inner))
    return rows.select("payload", "path", "root", "top")


def _rolled_up(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The tiers of blocks over ``g, rank, n, node, payload``; the last has one block per group."""
    tiers = [stored(_blocks(nodes), name)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        below = tiers[-1].select("g", F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).alias("n"), "node",
                                 F.struct(F.col("g").alias("g"), F.col("block").alias("rank")).alias("payload"))
        tiers.append(stored(_blocks(below), name))
    return tiers


def _with_paths(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """payload, path, root and top of every node of the lowest tier.

    ``tops`` has ``g``, and the path, root and own hash (``top``) of every group.
    """
    tops = tops.withColumnRenamed("g", "_g")
    rows = tiers[-1].join(tops, F.col("g").eqNullSafe(F.col("_g")))
    for tier in tiers[-2::-1]:
        above = _unfolded(rows, "path").select(F.col("payload.g").alias("_g"), F.col("payload.rank").alias("_r"), "path", "root", "top")
        rows = tier.join(above, F.col("g").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_r")))
    return _unfolded(rows, "path")


def manifest(leaves: DataFrame, source: str = "source", doc_id: str = "doc_id", hash_: str = "leaf") -> DataFrame:
    """The columns of ``leaves`` (but for those of the following names), and ``subroot``, ``root`` and ``path`` (siblings before and after
    the own place, level by level up to the root).

    Leaves of a source are ordered by doc_id (null first), then hash; rows that repeat are leaves
    of their own.  A null source is a source, the first one.  A level with a single node is hashed
    alone, a source with one leaf is that leaf, and with one source its subroot is the root.  An
    empty table gives no rows.
    """
    payload = F.struct(*leaves.columns)
    rows = stored(leaves.select(F.col(source).alias("g"), F.col(doc_id).alias("_d"), F.col(hash_).alias("node"), payload.alias("payload")), "leaves")
    ranked = stored(_numbered(rows, "g", ["_d", "node"]), "numbered")
    most = ranked.agg(F.max("n")).first()[0]
    if most is None:
        nothing = leaves.drop("subroot", "root", "path").limit(0)
        return nothing.select("*", F.lit("").alias("subroot"), F.lit("").alias("root"), F.array().cast(PATH).alias("path"))
    tiers = _rolled_up(ranked, most, "tier")
    # the sources themselves: one group, numbered by name
    tops = stored(tiers[-1].select(F.lit(0).alias("g"), F.col("g").alias("name"), "node", F.struct(F.col("g").alias("name"), F.col("node").alias("top")).alias("payload")), "subroots")
    sources = _rolled_up(_numbered(tops, "g", ["name"]), tops.count(), "sources")
    whole = sources[-1].select("g", F.array().cast(PATH).alias("path"), F.col("node").alias("root"), F.col("node").alias("top"))
    paths = _with_paths(sources, whole)
    named = stored(paths.select(F.col("payload.name").alias("g"), "path", "root", F.col("payload.top").alias("top")), "paths")
    out = _with_paths(tiers, named)
    kept = [F.col("payload")[c].alias(c) for c in leaves.columns if c not in ("subroot", "root", "path")]
    return out.select(*kept, F.col("top").alias("subroot"), "root", "path")


def document_leaves(docs: DataFrame, text: Column | None = None) -> Column:
    """The leaf of a row of documents; ``text`` stands in for its text."""
    return leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text") if text is None else text)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        "doc_id", "source", document_leaves(docs).alias("leaf"),
        F.when(tampered, document_leaves(docs, F.translate("text", UPPER, LOWER))).alias("changed"),
    )
    out = manifest(leaves).withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Leaves, levels by recursion, siblings by a join of every leaf's ancestors with their fellows.
SQL = r"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, d.source, lang, n_chars, text, list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER) + 1, 1))) AS b FROM documents d
), crc AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(b, lambda x: CAST(x AS BIGINT))), lambda a, x:
    list_reduce(list_prepend(xor(a, x), list_transform(range(8), lambda i: CAST(i AS BIGINT))), lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)))) AS h FROM bytes
), leaves AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN h % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM crc)
), nodes AS (
  SELECT 0 AS lvl, source, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT lvl + 1, source, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), CAST(ceil(n / 16.0) AS BIGINT) FROM nodes WHERE n > 1 GROUP BY lvl, source, pos // 16, n
), subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), CAST(ceil(n / 16.0) AS BIGINT) FROM tops WHERE n > 1 GROUP BY lvl, pos // 16, n
), pieces AS (
  SELECT a.source, a.pos, a.lvl, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS before, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS after
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL
), top_pieces AS (
  SELECT a.pos, a.lvl, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS before, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS after
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL
), paths AS (
  SELECT l.doc_id, l.leaf, l.changed, s.subroot, s.pos AS top,
    (SELECT list({'b': coalesce(before, ''), 'a': coalesce(after, '')} ORDER BY lvl) FROM pieces p WHERE p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos >> (4 * p.lvl)) AS low,
    (SELECT list({'b': coalesce(before, ''), 'a': coalesce(after, '')} ORDER BY lvl) FROM top_pieces p WHERE p.pos = s.pos >> (4 * p.lvl)) AS high
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
), whole AS (
  SELECT *, list_concat(coalesce(low, []), coalesce(high, [])) AS path, (SELECT h FROM tops WHERE n = 1) AS root FROM paths
), folded AS (
  SELECT *, list_reduce(list_prepend({'b': coalesce(changed, leaf), 'a': ''}, path), lambda x, y: {'b': sha256(y.b || x.b || y.a), 'a': ''}).b AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(list_reduce(list_prepend('', list_transform(path, lambda p: p.b || p.a)), lambda x, y: x || y)) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""
