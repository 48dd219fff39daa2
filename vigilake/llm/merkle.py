"""A Merkle manifest of a table: rows are leaves, sources are subtrees, every row gets its proof.

Leaves are ranked in their source and the rank's digits (base 16) are grouped away one after the other, the
last digit first: a group's structs, in the order of the digit, become the `kids` of one struct that carries
their hash. Three digits make a block of at most 4,096 leaves. All three groupings need only the one shuffle
by (source, block), since a block's rows are together from then on. Block roots are ranked leaves themselves,
and are rolled up in the same way until each source has one block left; subroots then are rolled up by the
rank of their source.

Proofs come down the same structs: a block meets the path above it by grouping both under its number, and
each level is exploded, which adds the hashes of the other kids to the path. Nothing is joined for them.

Ranks need no source in one task: rows are sorted in ranges of (source, order), and a row's rank is its place
in its range and the number of rows in the ranges before. Only counts per range are summed over a source.

Defined cases: nulls are hashed as `-`; a null source is a source of its own, the first one; null ids come
first; rows of one id are ordered by their leaf hash, and equal rows are leaves each; a source of one row has
its leaf as subroot and an empty path; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.session import materialise

FAN, LEVELS = 16, 3
BLOCK = FAN**LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rank` (from 0) and `n` (rows) within `tree`, from rows sorted in ranges."""
    ranges = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # the number of a row tells its range (upper bits) and its place there; written, it stays as it is
    placed = materialise(ranges.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftrightunsigned("at", 33)), "ranges")
    runs = placed.groupBy("tree", "range").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy("tree")
    before = F.sum("rows").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("tree", "range", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"), F.sum("rows").over(own).alias("n"))
    return placed.join(shifts, ["tree", "range"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "range", "shift", *order)


def rolled(nodes: DataFrame, height: int) -> DataFrame:
    """Blocks (tree, n, block, h, kids) of the nodes (tree, n, rank, h, item) that stand `height` levels above the leaves."""
    digits = [F.expr(f"rank div {FAN**i} % {FAN}").alias(f"d{i}") for i in range(LEVELS)]
    dealt = nodes.select("tree", "n", F.expr(f"rank div {BLOCK}").alias("block"), *digits, "h", "item").repartition("tree", "block")
    below = "item"
    for i in range(LEVELS):
        rest = [f"d{j}" for j in reversed(range(i + 1, LEVELS))]
        kid = F.struct(F.col(f"d{i}").alias("d"), "h", F.col(below))
        dealt = dealt.groupBy("tree", "n", "block", *rest).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
        # a lone node is not hashed again; a lone node of a run beside other runs is
        hashed = digest(joined(F.col("kids.h")))
        dealt = dealt.withColumn("h", F.when(F.col("n") > FAN ** (height + i), hashed).otherwise(F.col("kids")[0]["h"]))
        below = "kids"
    return dealt


def climbed(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Tables of blocks, the lowest first; in the last one each tree is a single block."""
    tables: list[DataFrame] = []
    while True:
        tables.append(materialise(rolled(nodes, LEVELS * len(tables)), name))
        if tables[-1].filter("block > 0").isEmpty():
            return tables
        nodes = tables[-1].select("tree", "n", F.col("block").alias("rank"), "h", F.lit(None).cast("int").alias("item"))


def descended(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes below `tables` (tree, h, item) with their path; `tops` (tree, path, above) says what lies above each tree."""
    paths = tops.withColumn("block", F.lit(0).cast("long"))
    for number in reversed(range(len(tables))):
        both = tables[number].select("tree", "block", "n", "kids").unionByName(paths, allowMissingColumns=True)
        one = [F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "above")]
        rows = both.groupBy("tree", "block").agg(*one)
        for level in reversed(range(LEVELS)):
            around = F.col("kids.h").alias("around")
            rows = rows.select("tree", "block", "n", "path", "above", around, F.posexplode("kids").alias("i", "kid"))
            beside = F.struct(joined(F.expr("slice(around, 1, i)")).alias("before"), joined(F.expr(f"slice(around, i + 2, {FAN})")).alias("after"))
            needed = F.col("n") > FAN ** (LEVELS * number + level)
            path = F.when(needed, F.concat(F.array(beside), "path")).otherwise(F.col("path"))
            below = [F.col("kid.kids").alias("kids")] if level else [F.col("kid.h").alias("h"), F.col("kid.item").alias("item")]
            rows = rows.select("tree", (F.col("block") * FAN + F.col("i")).alias("block"), "n", path.alias("path"), "above", *below)
        paths = rows.select("tree", "block", "path", "above")
    return rows


def leaf_of(columns: list[str], changed: dict[str, Column] | None = None) -> Column:
    return digest(*[field((changed or {}).get(c, F.col(c))) for c in columns])


def manifest(
    docs: DataFrame, columns: list[str], doc: str = "doc_id", source: str = "source", altered: Column | None = None
) -> DataFrame:
    """doc_id, leaf, altered, subroot, root, path of every row.

    A leaf hashes `columns` in that order. `path` lists, from the leaf up, what stands before and after the
    node in its run (hashes as one text). `altered` is carried along as it is: say, a leaf to test a proof with.
    """
    extra = F.lit(None).cast("string") if altered is None else altered
    # '' sorts before all names, so a null source is the first
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), F.col(doc).alias("doc_id"), leaf_of(columns).alias("h"), extra.alias("altered"))
    leaves = materialise(leaves, "leaves")  # sorting in ranges reads its input twice
    item = F.struct("doc_id", "altered")
    nodes = ranked(leaves.select("tree", "h", item.alias("item"), F.col("doc_id").alias("first"), F.col("h").alias("second")), ["first", "second"])
    blocks = climbed(nodes, "blocks")

    subroots = blocks[-1].select(F.lit("").alias("tree"), "h", F.col("tree").alias("item"), F.col("tree").alias("first"))
    crowns = climbed(ranked(subroots, ["first"]), "crowns")
    nothing = F.array().cast("array<struct<before: string, after: string>>")
    roots = crowns[-1].select("tree", nothing.alias("path"), F.struct(F.col("h").alias("root"), F.lit(None).cast("string").alias("subroot")).alias("above"))
    sources = descended(crowns, roots).select(F.col("item").alias("tree"), "path", F.struct("above.root", F.col("h").alias("subroot")).alias("above"))
    found = descended(blocks, sources)
    return found.select("item.doc_id", F.col("h").alias("leaf"), "item.altered", "above.subroot", "above.root", "path")


def proof(path: str = "path") -> Column:
    """All siblings of a path in one text."""
    return joined(F.transform(path, lambda s: F.concat(s["before"], s["after"])))


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(path, start, lambda h, s: digest(s["before"], h, s["after"]))


def lowered(text: str = "text") -> Column:
    return F.translate(F.col(text), UPPER, LOWER)


def picked(doc: str = "doc_id", one_in: int = 5) -> Column:
    """The rows that are tampered with in a test; null ids are not."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % one_in == 0, F.lit(False))


def sql(columns: list[str], levels: int = 6, crowns: int = 4) -> str:
    """The same in DuckDB's SQL, for up to 16 ** levels rows a source and 16 ** crowns sources."""

    def spell(c: str, value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join(spell(c, text if c == "text" else c) for c in columns) + ")"

    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    bits = "flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ord(substr(doc_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {bits}, lambda a, x: {step}), 4294967295)"
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    out = [
        f"d AS (SELECT doc_id, source, {hashed('text')} AS leaf, CASE WHEN {crc} % {5} = 0 THEN {hashed(lower)} END AS altered FROM documents)",
        "p0 AS (SELECT doc_id, source, leaf, coalesce(altered, leaf) AS f, '' AS proof, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM d)",
        "l0 AS (SELECT source, r, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM p0)",
    ]

    def rise(level: str, run: str, above: str, power: int) -> list[str]:
        return [
            f"{run} AS (SELECT source, r // {FAN} AS r, any_value(n) AS n, list(h ORDER BY r) AS hs FROM {level} GROUP BY source, r // {FAN})",
            f"{above} AS (SELECT source, r, n, CASE WHEN n > {power} THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {run})",
        ]

    def meet(below: str, run: str, above: str, power: int) -> str:
        first, second = (f"CASE WHEN n > {power} THEN array_to_string(hs[{cut}], '') ELSE '' END" for cut in (f"1:p.r % {FAN}", f"p.r % {FAN} + 2:"))
        return (
            f"{above} AS (SELECT doc_id, p.source, leaf, sub, r // {FAN} AS r, proof || b || a AS proof, CASE WHEN n > {power} THEN sha256(b || f || a) ELSE f END AS f "
            f"FROM (SELECT p.doc_id, p.source, p.leaf, p.sub, p.r, p.proof, p.f, n, {first} AS b, {second} AS a FROM {below} p JOIN {run} u "
            f"ON p.source IS NOT DISTINCT FROM u.source AND u.r = p.r // {FAN}) p)"
        )

    for i in range(levels):
        out += rise(f"l{i}", f"u{i}", f"l{i + 1}", FAN**i)
    out.append(f"q0 AS (SELECT doc_id, p0.source, leaf, f, proof, p0.r, l{levels}.h AS sub FROM p0 JOIN l{levels} ON p0.source IS NOT DISTINCT FROM l{levels}.source)")
    out += [meet(f"q{i}", f"u{i}", f"q{i + 1}", FAN**i) for i in range(levels)]
    out.append(f"s0 AS (SELECT source AS name, '' AS source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, h, count(*) OVER () AS n FROM l{levels})")
    for i in range(crowns):
        out += rise(f"s{i}", f"v{i}", f"s{i + 1}", FAN**i)
    out.append(f"t0 AS (SELECT doc_id, '' AS source, leaf, f, proof, s0.r, sub FROM q{levels} q JOIN s0 ON q.source IS NOT DISTINCT FROM s0.name)")
    out += [meet(f"t{i}", f"v{i}", f"t{i + 1}", FAN**i) for i in range(crowns)]
    return (
        "WITH " + ",\n".join(out) + f"\nSELECT doc_id, leaf, sub AS subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified "
        f"FROM t{crowns}, s{crowns}"
    )
