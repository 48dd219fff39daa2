import json

import pytest
from pyspark.sql import functions as F

from vigilake.functions import templates as tp
from vigilake.functions.jsonfn import dotted
from vigilake.operators import detect as d
from vigilake.operators import ruleindex as ri
from vigilake.sources.rules import Rule
from vigilake.sources.sample import AS_OF

DOCS = [
    {"a": "x", "list": [{"n": 1, "in": ["p", "q"]}, {"n": 2, "in": []}, {"m": 3}], "flat": ["u", "v"], "o": {"k": "deep", "a": "own"}, "t": True, "f": False, "e": "", "z": 0},
    {"a": None, "list": [], "o": {}, "flat": [[1, 2], "w", None], "n": "outer"},
    {"list": "no list", "o": "text", "flat": 7},
    {},
]
TEMPLATES = [
    "plain", "", "{{a}}|{{{a}}}|{{&a}}|{{ a }}|{{missing}}", "{{#list}}<{{n}}{{#in}}({{.}}){{/in}}>{{/list}}", "{{#flat}}{{.}},{{/flat}}", "{{#o}}{{k}} {{a}}{{/o}}",
    "{{^list}}none{{/list}}{{#list}}some {{/list}}", "{{#t}}yes{{/t}}{{#f}}no{{/f}}{{^f}}not f{{/f}}{{#e}}e{{/e}}{{^e}}no e{{/e}}{{#z}}z{{/z}}", "{{! a remark }}{{o.k}}/{{list.0.n}}/{{flat.1}}",
    "{{#list}}{{#o}}{{k}}{{n}}{{/o}};{{/list}}", "line\n{{#a}}\n in {{a}}\n{{/a}}\nend", "{{#missing}}{{#deeper}}x{{/deeper}}{{/missing}}ok",
]


def render_plain(template, document):
    """One Python document at a time: what the compiled form is held against."""

    def find(contexts, path):
        if path == ".":
            return contexts[-1]
        for c in reversed(contexts):
            for key in dotted(path):
                c = c.get(key) if isinstance(c, dict) else c[key] if isinstance(c, list) and isinstance(key, int) and key < len(c) else None
                if c is None:
                    break
            if c is not None:
                return c
        return None

    def spell(value):
        if value is None:
            return ""
        if isinstance(value, bool) or isinstance(value, (list, dict)):
            return json.dumps(value, separators=(",", ":"), ensure_ascii=False)
        return str(value)

    def run(nodes, contexts):
        out = ""
        for n in nodes:
            if n.text is not None:
                out += n.text
                continue
            value = find(contexts, n.path)
            if n.inner is None:
                out += spell(value)
            elif n.inverted:
                out += "" if spell(value) not in ("", "false", "[]", "{}") else run(n.inner, contexts)
            elif spell(value) not in ("", "false", "[]", "{}"):
                out += "".join(run(n.inner, [*contexts, v]) for v in (value if isinstance(value, list) else [value]))
        return out

    return run(tp.parse(template), [document])


def test_sections_equal_a_plain_renderer(spark):
    docs = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCS)], "i int, j string").withColumn("doc", F.parse_json("j"))
    rows = docs.select("i", *[tp.render_document(t, F.col("doc")).alias(f"t{k}") for k, t in enumerate(TEMPLATES)]).orderBy("i").collect()
    for r, doc in zip(rows, DOCS):
        for k, t in enumerate(TEMPLATES):
            assert r[f"t{k}"] == render_plain(t, doc), (t, doc)
    assert rows[0]["t3"] == "<1(p)(q)><2><>" and rows[0]["t5"] == "deep own"


def test_odd_templates():
    for bad in ("{{#a}}x", "{{/a}}", "{{#a}}{{/b}}", "{{#a}}{{#b}}{{/a}}{{/b}}"):
        with pytest.raises(tp.BadTemplate):
            tp.parse(bad)
    assert tp.has_sections("{{#a}}{{/a}}") and tp.has_sections("{{{a}}}") and not tp.has_sections("{{a}} {b}")
    assert tp.paths_of(tp.parse("{{a}}{{#b}}{{c}}{{/b}}")) == ["a", "b", "c"]


def test_alerts_with_sections(events):
    rules = [
        Rule("plain", criteria="category = 'error'", lookback_minutes=43200, summary="{{metadata.count}}", event_snippet="{{eventid}}", event_sample_count=1),
        Rule("lists", criteria="source = 'gcp_audit'", aggregation_key="category", lookback_minutes=43200, event_sample_count=2, severity="LOW",
             summary="{{alert_name}}/{{severity}} {{metadata.value}}:{{#events}} {{eventid}}{{#tags}},{{.}}{{/tags}}{{/events}}", event_snippet="{{#details.user}}by {{.}}{{/details.user}}{{^details.user}}by nobody{{/details.user}}"),
    ]
    one, two = (f(events, rules, AS_OF, None, "rule").alerts.select("alert_name", "value", "summary", "events").collect() for f in (d.evaluate_rules, ri.evaluate))
    assert sorted((r.alert_name, r.value, r.summary) for r in one) == sorted((r.alert_name, r.value, r.summary) for r in two)
    for r in two:
        if r.alert_name == "lists":
            docs = [json.loads(e.record) for e in r.events]
            want = render_plain(rules[1].summary, {"alert_name": "lists", "severity": "LOW", "metadata": {"value": r.value}, "events": docs})
            assert r.summary == " ".join([want, *[render_plain(rules[1].event_snippet, x) for x in docs]])
