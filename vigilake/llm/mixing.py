"""Mixing to target weights: a token budget handed down a tree of domain, language and source.

Every node's budget is split among its children by weight. A child cannot take more than its documents offer
in `max_epochs` epochs; what it leaves goes to its siblings by weight first, and only what a whole family
cannot take has gone to the family's siblings before (a node is never handed more than its leaves hold).
That is water-filling per family, done with window functions over the few columns of the node table in whole
numbers; rounding down loses less than one token per node.

A leaf takes whole epochs while its budget lasts and a prefix of the next one. Each epoch has its own seeded
order (md5 of seed, epoch and document id). For the prefix the first hex digits of that hash cut a leaf into
buckets; only bucket sums are added up per leaf and only the bucket in which the prefix ends is ordered, so
no leaf is sorted in one task.

Defined cases: null names are a node `(none)`; documents without tokens are never taken; equal rows are
separate offers; a node of weight 0 (and all below it) takes nothing; an empty table gives no rows. The last
document of a prefix may be taken in part (`take` below `n_tokens`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.session import materialise

DIGITS = 3  # 4096 buckets per leaf


def words(text: str = "text") -> Column:
    """The number of words of a text: what counts as tokens where no vocabulary is named."""
    flat = F.coalesce(F.col(text), F.lit(""))
    for space in "\t\n\x0b\f\r":
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    return F.size(F.array_remove(F.split(flat, " "), "")).cast("long")


def weight_of(level: str, weights: dict[str, int], other: int = 1) -> Column:
    out = None
    for name, w in weights.items():
        out = F.when(F.col(level) == name, w) if out is None else out.when(F.col(level) == name, w)
    return (F.lit(other) if out is None else out.otherwise(other)).cast("long")


def handed_down(sizes: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], percent: int, max_epochs: int) -> DataFrame:
    """Leaves (`levels`, size) with their budget: levels, size, budget."""
    nodes = None
    # what weighs nothing is out before capacities are added up, so a family is never handed more than it can take
    for level in levels:
        sizes = sizes.filter(weight_of(level, weights.get(level, {})) > 0)
    for depth, level in enumerate(levels):
        above, path = levels[:depth], levels[: depth + 1]
        here = sizes.groupBy(*path).agg(F.sum("size").alias("size"))
        here = here.withColumn("_w", weight_of(level, weights.get(level, {}))).withColumn("_cap", F.col("size") * max_epochs)
        if nodes is None:
            everything = Window.partitionBy(F.lit(0))
            here = here.withColumn("_total", F.sum("size").over(everything)).withColumn("_most", F.sum("_cap").over(everything))
            here = here.withColumn("_budget", F.expr(f"least(_total * {percent} div 100, _most)")).drop("_total", "_most")
        else:
            here = here.join(nodes.select(*above, F.col("budget").alias("_budget")), above)
        family = Window.partitionBy(*(above or [F.lit(0)]))
        order = family.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col(level))
        here = here.withColumn("_before", F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        here = here.withColumn("_weights", F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        here = here.withColumn("_full", F.col("_cap") * F.col("_weights") <= F.col("_w") * (F.col("_budget") - F.col("_before")))
        here = here.withColumn("_b", F.min(F.when(~F.col("_full"), F.col("_before"))).over(family)).withColumn("_s", F.max(F.when(~F.col("_full"), F.col("_weights"))).over(family))
        here = here.withColumn("budget", F.expr("if(_full, _cap, _w * (_budget - _b) div _s)"))
        nodes = here.select(*path, "size", "budget")
    return nodes


def key(seed: int, epoch: Column, doc: str = "doc_id") -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(doc).cast("string"), F.lit(""))))


def mix(
    docs: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], percent: int = 60, max_epochs: int = 2, seed: int = 17,
    doc: str = "doc_id", tokens: Column | None = None,
) -> DataFrame:
    """doc_id, levels, epoch, n_tokens and take of every document in every epoch it is taken in.

    The budget is `percent` percent of all tokens; `weights` maps a level to the weights of its names, others weigh 1.
    """
    none = F.lit("(none)")
    count = words() if tokens is None else tokens
    narrow = docs.select(F.col(doc).cast("long").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), none).alias(c) for c in levels], count.alias("n_tokens"))
    narrow = materialise(narrow, "mix")
    sizes = narrow.groupBy(*levels).agg(F.sum("n_tokens").alias("size")).filter("size > 0")
    leaves = handed_down(sizes, levels, weights, percent, max_epochs)
    leaves = materialise(leaves.select(*levels, F.expr("budget div size").alias("_whole"), F.expr("budget % size").alias("_rest")), "leaves")
    offered = narrow.filter("n_tokens > 0").join(leaves, levels)
    whole = offered.filter("_whole > 0").select("doc_id", *levels, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_whole") - 1)).alias("epoch"), "n_tokens", F.col("n_tokens").alias("take"))

    part = offered.filter("_rest > 0").withColumn("_key", key(seed, F.col("_whole"))).withColumn("_bucket", F.substring("_key", 1, DIGITS))
    sums = part.groupBy(*levels, "_bucket").agg(F.sum("n_tokens").alias("_n"), F.max("_rest").alias("_r"))
    upto = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    # the bucket the prefix ends in, one per leaf
    last = sums.filter("_start < _r AND _start + _n >= _r").select(*levels, F.col("_bucket").alias("_last"), "_start")
    part = part.join(materialise(last, "last"), levels)
    inside = part.filter("_bucket < _last").select("doc_id", *levels, F.col("_whole").alias("epoch"), "n_tokens", F.col("n_tokens").alias("take"))
    order = Window.partitionBy(*levels).orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = part.filter("_bucket = _last").withColumn("_at", F.col("_start") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    edge = edge.filter("_at < _rest").select("doc_id", *levels, F.col("_whole").alias("epoch"), "n_tokens", F.least("n_tokens", F.col("_rest") - F.col("_at")).alias("take"))
    return whole.unionByName(inside).unionByName(edge)


def sql(source: str, levels: list[str], weights: dict[str, dict[str, int]], percent: int = 60, max_epochs: int = 2, seed: int = 17) -> str:
    """The same in DuckDB's SQL; `source` is a query with doc_id, the levels and text."""
    names = ", ".join(levels)
    parts = []
    for depth, level in enumerate(levels):
        above, path = ", ".join(levels[:depth]), ", ".join(levels[: depth + 1])
        cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in weights.get(level, {}).items())
        weight = f"CASE {level} {cases} ELSE 1 END" if cases else "1"
        by = above or "0"
        given = f"(SELECT least(sum(size) * {percent} // 100, sum(cap)) FROM c0)" if depth == 0 else "given"
        join = "" if depth == 0 else f" JOIN (SELECT {above}, budget AS given FROM n{depth - 1}) USING ({above})"
        parts.append(f"""c{depth} AS (SELECT {path}, sum(size)::BIGINT AS size, (sum(size) * {max_epochs})::BIGINT AS cap, ({weight})::BIGINT AS w FROM sizes GROUP BY {path}),
a{depth} AS (SELECT *, ({given})::BIGINT AS b FROM c{depth}{join}),
o{depth} AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY {by} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(w) OVER (PARTITION BY {by} ORDER BY cap / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM a{depth}),
f{depth} AS (SELECT *, cap * weights <= w * (b - before) AS filled FROM o{depth}),
n{depth} AS (SELECT {path}, size, CASE WHEN filled THEN cap ELSE w * (b - min(CASE WHEN NOT filled THEN before END) OVER (PARTITION BY {by}))
  // max(CASE WHEN NOT filled THEN weights END) OVER (PARTITION BY {by}) END AS budget FROM f{depth})""")
    tree = ",\n".join(parts)
    nothing = " AND ".join(f"{c} <> '{n}'" for c in levels for n, w in weights.get(c, {}).items() if not w)
    nothing = f" WHERE {nothing}" if nothing else ""
    last = len(levels) - 1
    return rf"""
WITH docs AS ({source}),
d AS (SELECT doc_id, {', '.join(f"coalesce({c}, '(none)') AS {c}" for c in levels)},
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda y: y <> ''))::BIGINT AS n_tokens FROM docs),
sizes AS (SELECT {names}, sum(n_tokens)::BIGINT AS size FROM d{nothing} GROUP BY {names} HAVING sum(n_tokens) > 0),
{tree},
leaves AS (SELECT {names}, (budget // size)::BIGINT AS whole, (budget % size)::BIGINT AS rest FROM n{last}),
offered AS (SELECT * FROM d JOIN leaves USING ({names}) WHERE n_tokens > 0),
part AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY {names} ORDER BY md5('{seed}|' || whole || '|' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun FROM offered WHERE rest > 0)
SELECT doc_id, {names}, unnest(range(0, whole)) AS epoch, n_tokens, n_tokens AS take FROM offered WHERE whole > 0
UNION ALL SELECT doc_id, {names}, whole, n_tokens, least(n_tokens, rest - begun)::BIGINT FROM part WHERE begun < rest"""
