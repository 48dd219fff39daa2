"""Quality rules with cutoffs that are certified on labelled documents. DataFrame functions only.

Each rule compares two counts of a document: it fails when `100 * part > cutoff * whole`. For every stratum,
rule and cutoff of a fixed grid the labelled documents of good quality that would be rejected are counted, and
the exact binomial test asks whether the true rate of false rejections is below the rule's share of `alpha`.
The shares add up to `alpha`, so by the union bound a stratum's rules together reject at most that share of
its good documents; the level `delta` is divided by the number of tests (Bonferroni), so with probability
`1 - delta` that holds in all strata at once. Of the certified cutoffs the one with the best balance (share of
bad minus share of good documents rejected) is taken, the milder one on ties; a rule with none stays unused.

Defined cases: null and empty texts have no words and fail the base rules; a document of an unlabelled or null
stratum meets base rules only; contradicting labels of one document count as bad; labels that are null are
not used; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.session import materialise

SYMBOLS = "#*$%&|<>"

# rule -> (part, whole, cutoffs in percent from strict to mild)
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "n_words", (5, 10, 20, 30, 50, 100)),
    "lines": ("n_dup_lines", "n_lines", (10, 20, 30, 50, 70)),
    "repeats": ("n_repeat_words", "n_words", (5, 8, 11, 14, 17)),
    "marks": ("n_marks", "n_words", (5, 10, 20, 50)),
    "length": ("word_chars", "n_words", (900, 1100, 1500, 2500)),
}


def count_of(text: str, chars: str) -> Column:
    rest = F.col(text)
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The counts of each document: `keep` columns, then n_words to n_marks (long)."""
    d = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # white space becomes single characters first: cutting at one character needs no pattern
    flat = F.col("_text")
    for space in "\t\n\x0b\f\r":
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    d = d.withColumn("_w", F.array_remove(F.split(flat, " "), ""))
    d = d.withColumn("_lines", F.expr("filter(split(_text, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    # 64-bit hashes of the five-word windows; only texts with equal ones look at the places
    shifted = ", ".join(f"slice(_w, {i}, size(_w) - 4)" for i in range(1, 6))
    d = d.withColumn("_win", F.expr(f"if(size(_w) < 5, cast(array() AS array<bigint>), transform(arrays_zip({shifted}), s -> xxhash64(s)))"))
    d = d.withColumn(
        "_pairs",
        F.expr("if(size(array_distinct(_win)) = size(_win), NULL, sort_array(transform(_win, (x, j) -> struct(x AS h, j AS i))))"),
    )
    d = d.withColumn(
        "_again",
        F.expr(
            "if(_pairs IS NULL, cast(array() AS array<int>), sort_array(transform(filter(_pairs, (x, j) -> "
            "coalesce(get(_pairs, j - 1).h = x.h, false) OR coalesce(get(_pairs, j + 1).h = x.h, false)), x -> x.i)))"
        ),
    )
    covered = (
        "aggregate(_again, named_struct('n', 0L, 'last', -5), "
        "(a, i) -> named_struct('n', a.n + least(5, i - a.last), 'last', i), a -> a.n)"
    )
    n = lambda c: c.cast("long")
    return d.select(
        *keep,
        n(F.size("_w")).alias("n_words"),
        n(F.length(F.array_join("_w", ""))).alias("word_chars"),
        n(count_of("_text", SYMBOLS)).alias("n_symbols"),
        n(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        n(F.expr(covered)).alias("n_repeat_words"),
        n(F.size("_lines")).alias("n_lines"),
        n(count_of("_text", "!")).alias("n_marks"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def at_most(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed exactly from the logarithms of the terms."""
    step = F.log(F.lit(p / (1 - p)))
    first = F.struct((n * F.log(F.lit(1 - p))).alias("t"), F.exp(n * F.log(F.lit(1 - p))).alias("s"))

    def add(a: Column, i: Column) -> Column:
        t = a["t"] + F.log((n - i + 1).cast("double") / i) + step
        return F.struct(t.alias("t"), (a["s"] + F.exp(t)).alias("s"))

    places = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(places, first, add, lambda a: a["s"])


def certify(
    measured: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05, rules: dict | None = None,
) -> DataFrame:
    """Certified cutoffs: one row per stratum with labelled rows, a column `cut_<rule>` each (null: unused)."""
    rules = rules or RULES
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_good"))
    held = measured.filter(~base_failed() & F.col(stratum).isNotNull()).join(known, "doc_id")
    fails = {(r, c): 100 * F.col(part) > c * F.col(whole) for r, (part, whole, grid) in rules.items() for c in grid}
    good = F.col("_good") >= 1
    counts = held.groupBy(F.col(stratum).alias("_s")).agg(
        F.count_if(good).alias("n_good"),
        F.count_if(~good).alias("n_bad"),
        *[F.count_if(f & good).alias(f"g_{r}_{c}") for (r, c), f in fails.items()],
        *[F.count_if(f & ~good).alias(f"b_{r}_{c}") for (r, c), f in fails.items()],
    )
    tests = [
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cut"), F.col(f"g_{r}_{c}").alias("g"), F.col(f"b_{r}_{c}").alias("b"))
        for r, c in fails
    ]
    share = alpha / len(rules)
    # the number of tests is that of strata with labelled rows times the grid
    m = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))) * len(fails)
    each = counts.withColumn("_m", m).select("_s", "n_good", "n_bad", "_m", F.explode(F.array(*tests)).alias("t"))
    each = each.filter((F.col("t.g") <= share * F.col("n_good")) & (F.col("n_good") > 0))
    passed = each.filter(at_most(F.col("n_good"), F.col("t.g"), share) * F.col("_m") <= delta)
    gain = F.col("t.b") / F.greatest("n_bad", F.lit(1)) - F.col("t.g") / F.col("n_good")
    best = passed.filter(F.col("t.b") > 0).groupBy("_s", F.col("t.rule").alias("rule")).agg(F.max(F.struct(gain.alias("gain"), F.col("t.cut").alias("cut")))["cut"].alias("cut"))
    return best.groupBy("_s").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in rules])


def judge(measured: DataFrame, cuts: DataFrame, stratum: str = "lang", rules: dict | None = None) -> DataFrame:
    """`measured` with base_failed and kept."""
    rules = rules or RULES
    met = measured.join(cuts, F.col(stratum) == F.col("_s"), "left")
    failed = F.lit(False)
    for r, (part, whole, _) in rules.items():
        failed = failed | F.coalesce(100 * F.col(part) > F.col(f"cut_{r}") * F.col(whole), F.lit(False))
    return met.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~failed).drop("_s", *[f"cut_{r}" for r in rules])


def controlled(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Counts, base_failed and kept of every document. The counts are written once and read for both steps."""
    measured = materialise(measure(docs, keep=("doc_id", stratum)), "measured")
    return judge(measured, certify(measured, labels, stratum, alpha, delta), stratum)


def sql(alpha: float = 0.02, delta: float = 0.05) -> str:
    """The same in DuckDB's SQL, over `documents` and `labels` with `lang` as stratum."""
    grid = [(r, c, part, whole) for r, (part, whole, cuts) in RULES.items() for c in cuts]
    share = alpha / len(RULES)
    tests = " UNION ALL ".join(
        f"SELECT lang, '{r}' AS rule, {c} AS cut, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad, "
        f"count(*) FILTER (good AND 100 * {part} > {c} * {whole}) AS g, count(*) FILTER (NOT good AND 100 * {part} > {c} * {whole}) AS b "
        f"FROM held GROUP BY lang"
        for r, c, part, whole in grid
    )
    fails = " OR ".join(f"coalesce(100 * {part} > cut_{r} * {whole}, false)" for r, (part, whole, _) in RULES.items())
    cuts = ", ".join(f"max(cut) FILTER (rule = '{r}') AS cut_{r}" for r in RULES)
    return rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, lang, x, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w,
  list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS lines FROM t),
u AS (SELECT doc_id, unnest(w) AS y, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT doc_id, i, y || ' ' || lead(y, 1) OVER o || ' ' || lead(y, 2) OVER o || ' ' || lead(y, 3) OVER o || ' ' || lead(y, 4) OVER o AS five
  FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS c FROM g WHERE five IS NOT NULL),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM h WHERE c > 1),
rep AS (SELECT doc_id, sum(least(5, coalesce(i - before, 5)))::BIGINT AS n FROM r GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(x) - length(translate(x, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  len(lines)::BIGINT AS n_lines,
  (length(x) - length(translate(x, '!', '')))::BIGINT AS n_marks FROM w LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
known AS (SELECT doc_id, min(quality) >= 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT * FROM j JOIN known USING (doc_id) WHERE NOT base_failed AND lang IS NOT NULL),
tests AS ({tests}),
tail AS (SELECT *, (SELECT sum(exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({share}) + (n_good - i) * ln(1 - {share})))
  FROM range(0, g + 1) AS s(i)) * (SELECT count(*) FROM tests) AS p FROM tests WHERE g <= {share} * n_good AND n_good > 0),
best AS (SELECT lang, rule, max({{'gain': b / greatest(n_bad, 1) - g / n_good, 'cut': cut}}).cut AS cut
  FROM tail WHERE p <= {delta} AND b > 0 GROUP BY lang, rule),
cuts AS (SELECT lang AS l, {cuts} FROM best GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({fails}) AS kept
FROM j LEFT JOIN cuts ON lang = l"""
