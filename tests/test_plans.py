"""The block helpers against brute force, with one key holding most rows."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigilake.operators import detect as d
from vigilake.plans import blocked as b
from vigilake.plans import ranges as rg
from vigilake.sources.rules import Rule

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(4)}", START + timedelta(seconds=rnd.randrange(0, 6 * 86400)), i) for i in range(1500)]
    data += [("hot", START + timedelta(days=1), 9000 + i) for i in range(5)]  # equal instants
    return data


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp, i int")


def test_rolling_count(spark, rows):
    got = {r.i: r.n for r in rg.rolling_count(frame(spark, rows), ["k"], "t", 3600, "n").collect()}
    for k, t, i in rows:
        assert got[i] == sum(1 for k2, t2, _ in rows if k2 == k and t - timedelta(hours=1) <= t2 <= t)


def test_sessions(spark, rows):
    got = sorted((r.k, r.session_start, r.session_end, r.rows) for r in rg.sessionize(frame(spark, rows), ["k"], "t", 600).collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        times = sorted(r[1] for r in rows if r[0] == k)
        begun = [times[0], times[0], 1]
        for t in times[1:]:
            if t - begun[1] <= timedelta(seconds=600):
                begun[1], begun[2] = t, begun[2] + 1
            else:
                want.append((k, *begun))
                begun = [t, t, 1]
        want.append((k, *begun))
    assert got == sorted(want)


def test_last_before(spark, rows):
    left, right = [r for r in rows if r[2] % 2], [r for r in rows if not r[2] % 2]
    r_df = frame(spark, right).withColumnRenamed("i", "j")
    got = {r.i: (r.matched_ts, r.j) for r in rg.last_before(frame(spark, left), r_df, ["k"], "t", 1800, ["j"]).collect()}
    want = {}
    for k, t, i in left:
        near = [(t2, -j) for k2, t2, j in right if k2 == k and t2 <= t and (t - t2).total_seconds() <= 1800]
        if near:
            best = max(near)
            want[i] = (best[0], -best[1])
    assert got == want


def test_ranked(spark, rows):
    df = frame(spark, rows).withColumn("day", F.to_date("t"))
    got = b.ranked(df, ["k"], ["day"], [F.col("t"), F.col("i")]).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "i"]).sort_values(["k", "t", "i"])
    pdf["want"] = pdf.groupby("k").cumcount() + 1
    assert dict(zip(got.i, got["rank"])) == dict(zip(pdf.i, pdf.want))


def test_first_n_is_limited_before_the_shuffle(spark, rows):
    out = b.first_n(frame(spark, rows), ["k"], [F.col("t"), F.col("i")], 3, 3)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.groupBy("k").count().filter("count > 3").count() == 0


def test_many_rules_read_the_table_once(spark):
    from vigilake.sources.sample import canonical, raw_table

    e = canonical(raw_table(spark, "/root/testdata/sf0.001", "events"))
    rules = [Rule(f"r{i}", criteria=f"category = 'click' AND user_agent <> 'a{i}'", aggregation_key="details.user", lookback_minutes=60 + i) for i in range(50)]
    counts = d.count_hits(d.hits(e, d.watches_of(rules), "2024-01-31 00:00:00"))
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    counts.count()
