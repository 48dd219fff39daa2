"""Running values over ranges against brute force, with one key that holds most rows and lies in many ranges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilake.plans import ranges as rg

START = datetime(2024, 1, 1)
YEAR = 425 * 86_400


@pytest.fixture(scope="module")
def df(spark):
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", None]), START + timedelta(seconds=rnd.randrange(YEAR)), i) for i in range(1200)]
    data += [("hot", START + timedelta(days=100, seconds=i // 3), 9000 + i) for i in range(90)]
    return spark.createDataFrame(data, "k string, t timestamp, i int")


def rows(df):
    return [(r.k, r.t, r.i) for r in df.collect()]


@pytest.mark.parametrize("seconds", [3600, 30 * 86_400, YEAR])
def test_rolling_counts(df, seconds):
    keyed = df.filter("k IS NOT NULL")
    got = sorted((r.i, r.n) for r in rg.rolling_count(keyed, ["k"], "t", seconds, "n", ranges=7).collect())
    data = rows(keyed)
    assert got == sorted((i, sum(k2 == k and 0 <= (t - t2).total_seconds() <= seconds for k2, t2, _ in data)) for k, t, i in data)


@pytest.mark.parametrize("seconds", [3600, YEAR])
def test_as_of(df, seconds):
    left, right = df.filter("i % 2 = 1"), df.filter("i % 2 = 0").withColumnRenamed("i", "j")
    got = rg.last_before(left, right, ["k"], "t", seconds, ["j"], ranges=7)
    data, want = rows(df), []
    for k, t, i in data:
        near = [(t2, -j) for k2, t2, j in data if j % 2 == 0 and k2 == k and t2 <= t and (t - t2).total_seconds() <= seconds] if i % 2 else []
        if near:
            want.append((k, t, i, max(near)[0], -max(near)[1]))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("gap", [60, 5 * 86_400, YEAR])
def test_sessions(df, gap):
    keyed = df.filter("k IS NOT NULL")
    got = rg.sessionize(keyed, ["k"], "t", gap, sums={"s": F.col("i")}, mins={"lo": F.col("i")}, maxs={"hi": F.col("i")}, ranges=7)
    want = []
    for k, t, i in sorted(rows(keyed)):
        if want and want[-1][0] == k and (t - want[-1][2]).total_seconds() <= gap:
            _, start, _, n, s, lo, hi = want.pop()
            want.append((k, start, t, n + 1, s + i, min(lo, i), max(hi, i)))
        else:
            want.append((k, t, t, 1, i, i, i))
    assert sorted(map(tuple, got.collect())) == want


def test_carries_are_fewer_than_ranges(df):
    laid = rg.laid_out(df, ["k"], ["t", "i"], 7)
    assert laid.select(rg.RANGE).distinct().count() == 7 and laid.groupBy(rg.RANGE).count().agg(F.max("count")).first()[0] < 400
    run = rg.carried(laid, ["k"], {"n": ("sum", F.lit(1)), "m": ("max", F.col("i"))}, before=True).collect()
    seen = {}
    for r in sorted(run, key=lambda r: r[rg.AT]):
        n, m = seen.get(r.k, (0, None))
        assert (r.n, r.m) == (n, m)
        seen[r.k] = (n + 1, r.i if m is None else max(m, r.i))
    assert rg.carried(rg.laid_out(df.limit(0), ["k"], ["t"]), ["k"], {"n": ("sum", F.lit(1))}).count() == 0
