from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilake.functions import jsonfn as j
from vigilake.functions import scalars as sc
from vigilake.functions.walk import lower_keys, split_json_blocks, unfold


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_paths():
    assert j.parse_field_path("details._ips[0].x") == ["details", "_ips", 0, "x"]
    assert j.parse_field_path("  ") is None
    assert j.path_to_string(["details", "_ips", 0]) == "details._ips[0]"
    assert j.variant_path(["c-ip", 0]) == '$["c-ip"][0]'


def test_scalar_extraction(spark):
    doc = '{"a": {"b": 5, "s": "{x"}, "l": ["p", 1], "n": null, "f": false}'
    v = F.try_parse_json(F.lit(doc))
    row = spark.range(1).select(*[j.jv(v, p).alias(p) for p in ("a.b", "a.s", "a", "l", "l[1]", "n", "f", "x.y")]).first()
    assert list(row) == ["5", "{x", None, None, "1", None, "false", None]


def test_render_payload_only_touches_strings(spark):
    template = {"t": 'a "{{v}}"', "n": 3, "b": [True, None, "{{missing}}"]}
    df = spark.createDataFrame([('x"y',)], "v string")
    got = df.select(j.render_payload(template, j.row_lookup(df))).first()[0]
    import json

    assert json.loads(got) == {"t": 'a "x"y"', "n": 3, "b": [True, None, ""]}


GOOD = ["1.2.3.4", "10.0.0.0/8", "::1", "::", "2001:db8::1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::ffff:10.0.0.1", "fe80::/10"]
BAD = ["nada", "1", "1320.2555.2555.2555", "", "1.2.3", "10.0.0.1/33", ":", ":::", "1::2::3", "1:2:3:4:5:6:7:8:9", "g::1", None]


def test_is_ip(spark):
    assert column(spark, GOOD + BAD, sc.is_ip) == [True] * len(GOOD) + [False] * len(BAD)
    assert column(spark, ["1.2.3.4", "1.2.3.4/8"], sc.is_ipv4) == [True, False]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2019-09-04T17:54:59Z", datetime(2019, 9, 4, 17, 54, 59)),
        ("2020-09-01 17:48:18", datetime(2020, 9, 1, 17, 48, 18)),
        ("2020-09-01T17:48:18.5+02:00", datetime(2020, 9, 1, 15, 48, 18, 500000)),
        ("2020-09-01 17:48:18,250 +0000", datetime(2020, 9, 1, 17, 48, 18, 250000)),
        ("2020-09-01", datetime(2020, 9, 1)),
        ("1567619699", datetime(2019, 9, 4, 17, 54, 59)),
        ("1567619699.5", datetime(2019, 9, 4, 17, 54, 59, 500000)),
        ("1567619699123", datetime(2019, 9, 4, 17, 54, 59, 123000)),
        ("1567619699123456789", datetime(2019, 9, 4, 17, 54, 59, 123457)),
        ("0", datetime(1970, 1, 1)),
        ("-3.5", datetime(1970, 1, 1)),
        ("Wed, 4 Sep 2019 17:54:59 +0000", datetime(2019, 9, 4, 17, 54, 59)),
        ("04/Sep/2019:17:54:59 +0000", datetime(2019, 9, 4, 17, 54, 59)),
        ("nada", None),
        ("", None),
    ],
)
def test_to_utc(spark, text, want):
    assert spark.range(1).select(sc.to_utc(F.lit(text)).cast("timestamp_ntz")).first()[0] == want


def test_lifespan_clamp_severity(spark):
    assert column(spark, ["7 days", "1 hour", "30 min", "soon", None], sc.lifespan_seconds) == [604800, 3600, 1800, 259200, 259200]
    assert column(spark, ["5", "0", "9999", "x", None], lambda c: sc.clamp(c, 60, 1000)) == [5, 1, 1000, 60, 60]
    assert column(spark, ["HIGH", "critical", "WARNING", None], lambda c: sc.severity_allows(c, F.lit("bogus"))) == [True, True, False, False]


def test_expiry(spark):
    now = "2024-01-02 00:00:00"
    texts = ["2024-01-01T00:00:00", "2024-01-02 00:00:00", "garbage", None]
    from pyspark.sql import types as T

    assert column(spark, texts, lambda c: sc.is_expired(c, now, T.StringType())) == [True, False, False, False]


def test_keys_and_walk(spark):
    doc = '{"Outer": {"SRC": "nested"}, "src": "own", "L": [{"Src": 3}], "A": 1, "a": 2}'
    got = spark.createDataFrame([(doc,), ("[1]",), ("no",)], "v string").select(unfold(F.col("v"), ["src"]).alias("u")).collect()
    assert [x["value"] for x in got[0]["u"]["found"]] == ["own", "nested", "3"]
    assert got[0]["u"]["keys"] == ["a", "l", "outer", "src"]
    assert got[1]["u"] is None and got[2]["u"] is None
    assert lower_keys({"A": 1, "a": 2}) == {"a": 2}


def test_blocks(spark):
    df = spark.createDataFrame([('{"a":{"b":1}} {"c":2}\n',)], "t string")
    assert [r["block"] for r in split_json_blocks(df, "t").collect()] == ['{"a":{"b":1}}', '{"c":2}']
