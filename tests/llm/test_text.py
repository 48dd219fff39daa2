"""Personal data, quality rules, classifier, mixing and pages."""

import glob
import hashlib
import html
import os
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tools.check import rows_of
from vigilake.llm import article, cotrain, mixing, pii, queries, rules

from .conftest import SF, TEXTS


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_same_as_sql(spark, con, name):
    run, sql = queries.QUERIES[name]
    got, want = run(spark, SF).toPandas(), con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {0: True, 1: all(int(p) < 256 for p in m[0].split(".")) if kind == 1 else True, 2: 12 <= len(digits) <= 19 and pii.luhn(digits), 3: 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_base_spans(documents):
    odd = ["a@b", "a@b.c@d.e", "@x.y", "a..@-.-", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.1", "4242 4242-4242 4242", "+1 2", "+1 (234) 567-8901)", "1" * 500, "a" * 300 + "@b.c", "+" * 50, "1-1 1-1 1"]
    for text in [*odd, *(t or "" for _, t in TEXTS), *(t or "" for t in documents.text)]:
        assert pii.base_spans(text) == plain_spans(text)


def test_op2_keeps_the_base(spark, documents):
    got = {r.doc_id: r for r in queries.op2_contextual_pii(spark, SF).collect()}
    for d, t in zip(documents.doc_id, documents.text):
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in plain_spans(t or ""))
        assert got[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and {*filter(None, base.split(","))} <= {*got[d].spans.split(",")}


def test_contexts_discover_what_patterns_miss(spark):
    rows = [(i, f"please write to user{i}@mail.example.org today") for i in range(20)]
    rows += [(100, "please write to jane (at) mail (dot) example (dot) org today"), (101, "they ate (at) noon (dot) fine")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got[100].spans) == 1 and not got[100].base and not got[101].spans and len(got[0].spans) == 1


def test_redaction_of_odd_texts(spark, odd_docs, no_docs):
    clean = pii.redacted(odd_docs)
    assert clean.columns == odd_docs.columns
    texts = [r.text for r in clean.filter("doc_id = 9").collect()]
    assert texts == ["Mail <EMAIL> or <PHONE>, card <CARD>, ip <IP> or 10.0.0.256"] * 2
    assert clean.count() == len(TEXTS) and pii.redacted(no_docs).count() == 0 and pii.find(no_docs).count() == 0


def test_exact_binomial(spark):
    for n, k, p in ((10, 0, 0.1), (500, 3, 0.01), (2000, 20, 0.02)):
        got = spark.range(1).select(rules.at_most(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
        terms = np.cumsum(np.log(np.r_[1, np.arange(n, n - k, -1) / np.arange(1, k + 1)])) if k else np.zeros(1)
        assert got == pytest.approx(sum(np.exp(t + i * np.log(p) + (n - i) * np.log(1 - p)) for i, t in enumerate(terms)))


def test_thresholds_hold_their_promise(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "en", int(q), " ".join(["word"] * 0 + [f"w{j}" for j in range(30)]) + " #" * int(rng.integers(8, 30) if not q else rng.integers(0, 3))) for i, q in enumerate(rng.random(6000) < 0.8)]
    docs = spark.createDataFrame([(i, s, t) for i, s, q, t in rows], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, q) for i, s, q, t in rows], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in rules.controlled(docs, labels).collect()}
    good, bad = [kept[i] for i, _, q, _ in rows if q], [kept[i] for i, _, q, _ in rows if not q]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_rules_on_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    got = rules.controlled(odd_docs, labels).collect()
    assert len(got) == len(TEXTS) and all(r.base_failed and not r.kept for r in got if r.n_words < 10)
    assert rules.controlled(no_docs, labels).count() == 0
    assert rules.controlled(odd_docs, labels.limit(0)).filter("kept = base_failed").count() == 0


def test_classifier_on_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    held = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(4)) == 0
    got = cotrain.classify(spark, docs, labels.filter(~held)).join(labels.filter(held), "doc_id").toPandas()
    assert len(got) > 50 and ((got.quality == 1) == got.kept).mean() >= 0.95
    kept = {r.doc_id for r in cotrain.accepted(docs, labels.filter(~held)).collect()}
    assert np.mean([(d in kept) == (q == 1) for d, q in zip(got.doc_id, got.quality)]) >= 0.95


def test_classifier_on_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (7, 1)], "doc_id long, quality int")
    assert cotrain.classify(spark, odd_docs, labels).count() == len(TEXTS)
    assert cotrain.classify(spark, odd_docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert cotrain.classify(spark, no_docs, labels).count() == 0
    assert cotrain.accepted(odd_docs, labels.limit(0)).columns == odd_docs.columns and cotrain.accepted(no_docs, labels).count() == 0


def test_shortages_go_to_siblings_first(spark):
    sizes = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "x", 1000), ("b", "y", 1000)], "d string, l string, size long")
    got = {(r.d, r.l): r.budget for r in mixing.handed_down(sizes, ["d", "l"], {}, 20, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 291, ("b", "x"): 150, ("b", "y"): 151 - 1}


def test_mixing_odd_texts(odd_docs, no_docs):
    for percent, epochs in ((60, 2), (100, 1), (100, 3)):
        got = mixing.mix(odd_docs, ["lang", "source"], {"lang": {"en": 3}}, percent, epochs).collect()
        total = sum(len((t or "").split()) for _, t in TEXTS if t != TEXTS[12][1]) + 12
        taken = sum(r.take for r in got)
        assert abs(taken - total * percent // 100) <= 30 and all(0 < r.take <= r.n_tokens and r.epoch < epochs for r in got)
    assert mixing.mix(no_docs, ["lang", "source"], {}).count() == 0


def test_pages_are_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    got = {r.page_id: r for r in queries.op9_best_region_text(spark, SF).collect()}
    for p, page in zip(pages.page_id, pages.html):
        body = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", body)]
        assert got[p].text == "\n".join(filter(None, blocks)) and got[p].n_chars == len(got[p].text)


def test_other_pages(spark):
    learnt = article.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    page = """<html><head><title>T t t</title><script>if (a<b) { "</p>" }</script></head><body><header><p>Site head words here</p></header>
      <nav><a href="x">one</a></nav><aside class="sidebar"><p>side words</p></aside><main><h1>Real &amp; title</h1><p>First  <i>para</i>graph
      text<br>goes on.<div class="ad">Buy now</div><p title="a > b">Second para &#8212; done.</p><form>Sign up</form></main>
      <div id="comments"><p>I disagree with all of this text here</p></div><footer>foot words</footer>"""
    assert article.extract(page, learnt) == "Real & title\nFirst paragraph text goes on.\nSecond para — done."
    for odd in (None, "", "   ", "<", "<p>", "<!-- never closed", "<script>never closed"):
        assert article.extract(odd, learnt) == ""
    assert article.extract("just words", learnt) == "just words"
    rows = spark.createDataFrame([(1, None, "u", "t"), (1, "<p>x y</p>", "u", "t"), (None, "", None, None)], "page_id long, html string, url string, text string")
    assert sorted(r.text for r in article.main_text(rows, learnt).collect()) == ["", "", "x y"]
    assert article.main_text(rows.limit(0), article.fit(rows.limit(0))).count() == 0


def test_hints_do_not_empty_pages(spark):
    learnt = article.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    nav, body = '<nav><a href="/">Home</a></nav>', "<h1>A title</h1><p>First words of it.</p><p>And some more words.</p>"
    want = "A title\nFirst words of it.\nAnd some more words."
    for page in (
        f'<body class="has-sidebar">{nav}<article>{body}</article></body>', f'<body class="sidebar">{nav}<article>{body}</article></body>',
        f'<html class="form"><body>{nav}<article class="post comment-open">{body}</article></body></html>', f'{nav}<main class="no-sidebar search">{body}</main>',
        f'{nav}<div class="widget"><form id="form"><article class="related">{body}</article></form></div>', f'{nav}<div class="social widget">{body}</div>',
        f'{nav}<form action="x">{body}</form><footer>foot</footer>', f'{nav}<article data-id="x" data-class="ad">{body}</article>',
        f'<article>{body}<section id="comments"><article class="comment"><p>I say no</p></article></section></article>',
        f'<main><article>{body}</article><aside><article><p>Read this too</p></article></aside></main>',
    ):
        assert article.extract(page, learnt) == want, page
    page = '<main><h2 id="related-work">Related work</h2><p class="notice-period">Notice period.</p><p id="form">Forms.</p><div class="comment-open">Open.</div><div class="ad">Buy</div><p class="notice">By the way</p></main>'
    assert article.extract(page, learnt) == "Related work\nNotice period.\nForms.\nOpen."


def test_blocks_commoner_in_chrome_stay():
    menu = "<ul>" + "<li><a>Some other page</a></li>" * 40 + "</ul>" + "<div>Imprint and terms</div>" * 20 + "<table>" + "<tr><td>x y</td></tr>" * 40 + "</table>"
    learnt = article.weights(article.counts_of(f"<body>{menu}<article><h1>T</h1><p>{'word ' * 60}</p></article></body>"))
    assert all(learnt["word"][k] < 0 for k in ("li", "div", "td"))
    prose = " ".join(f"word{i}" for i in range(25))
    cells = "".join(f"<tr><td>{i}</td><td>{i * i}</td></tr>" for i in range(100))
    table = "\n".join(f"{i}\n{i * i}" for i in range(100))
    page = f"<body><nav>{menu}</nav><article><p>First {prose}</p><ul><li>one</li><li>two</li></ul><table>{cells}</table><div>Last {prose}</div></article></body>"
    assert article.extract(page, learnt) == f"First {prose}\none\ntwo\n{table}\nLast {prose}"
    # the markup names no article
    divs = "".join(f"<div>Part {i} {prose}</div>" for i in range(5)) + f"<ul><li>{prose}</li><li>{prose}</li></ul>"
    page = f"<body>{menu.replace('<div>Imprint and terms</div>', '')}<div>{divs}</div><footer>Foot words</footer></body>"
    assert article.extract(page, learnt).split("\n")[-7:] == [*(f"Part {i} {prose}" for i in range(5)), prose, prose]
    assert "Some other page" not in article.extract(page, learnt)


def test_contexts_decide_and_grow(spark):
    rows = [(i, f"server 10.0.{i}.7 answered") for i in range(20)] + [(20 + i, f"call +1 (300) 555-{1000 + i} now") for i in range(40)]
    odd = ["555 1234567", "0044 20 7946 0958", "5551234567"]
    rows += [(100, "server 10[.]0[.]0[.]5 answered"), (101, "server 10 dot 9 dot 8 dot 7 answered"), *((102 + i, f"call {x} now") for i, x in enumerate(odd))]
    rows += [(110, "server 10[.]0[.]0[.]999 answered"), (111, "in 10[.]0[.]0[.]6 steps"), (112, "of 5551234568 grains")]
    # numbers sure by "call" and "now" make "fax" known, which alone tells the last one
    rows += [(200 + i, f"call 555 20{i:05d} now") for i in range(25)] + [(300 + i, f"fax 555 20{i:05d}") for i in range(25)] + [(400, "fax 777 1234567")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    named = {d: [(pii.KINDS[x.kind], text[d][x.start : x.end]) for x in r.spans] for d, r in got.items() if d >= 100 and r.spans}
    want = {100: "10[.]0[.]0[.]5", 101: "10 dot 9 dot 8 dot 7", **{102 + i: x for i, x in enumerate(odd)}, 400: "777 1234567"}
    assert {d: x for d, x in named.items() if d < 200 or d == 400} == {d: [("ip" if d < 102 else "phone", x)] for d, x in want.items()}
    assert all(d in named for d in [*range(200, 225), *range(300, 325)])


def test_rows_of_one_id_do_not_come_together(spark):
    rows = spark.range(12_000).select(F.when(F.col("id") < 6000, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 3000, "same").otherwise(F.col("id").cast("string")).alias("text"))
    for seed in range(8):
        some = cotrain.picked(rows, 12_000, 500, seed).collect()
        assert 300 <= len(some) <= 1000 and 50 < sum(r.doc_id is None for r in some) < 250 and sum(r.text == "same" for r in some) <= 1
    mail = [(None, f"please write to user{i}@mail.example.org today") for i in range(20)] + [(None, f"please write to x{i} (at) mail (dot) example (dot) org today") for i in range(5)]
    docs = spark.createDataFrame([*mail, (None, None)], "doc_id long, text string")
    assert sorted((r.text or "") for r in pii.redacted(docs).collect()) == ["", *["please write to <EMAIL> today"] * 25]


def test_tags_are_read_as_html_has_them():
    learnt = {"word": {}, "tag": {}}
    for page, want in (
        ("<article><a title=don't>x</a> y</article>", "x y"), ('<article><p title="5" wide">hello</article>', "hello"),
        ('<article><p data-x=\'"\' b = "c>d">in</p></article>', "in"), ('<article><a href="u>text</article>', "text"),
        ("<article>a < b <3 c</article>", "a < b <3 c"), ("<article>a<a href=/x/>b</a>c<br/>d</article>", "abc d"),
        ("<article>x<!-->y<!-- a --!>z</ q>w<script>s</scripty></script >v</article>", "xyzw\nv"), ("<article><p =x class=sidebar>no</p>yes</article>", "yes"),
        ("<ARTICLE><P CLASS='Sidebar'>no</P>yes<b<i>no tag</i></ARTICLE>", "yesno tag"),
    ):
        assert article.extract(page, learnt) == want, page


def test_long_pages_take_time_in_proportion():
    learnt = {"word": {}, "tag": {}}
    n = 60_000
    for part in ("<a ", "<div>", "<p>", "<a =", '<a b="', "<", "<!--", "</", "<a b = ", "<select>", "&"):
        begun = time.perf_counter()
        article.extract(part * n, learnt)
        assert time.perf_counter() - begun < 10, part
    for page in ("<div>" * n + "</x>" * n, "<a>" + "<div>" * n + "</a>" * n, "<i><div>" + "<b>" * n + "</i>" * n, "<a " + "x" * 1_000_000, "<article>" + "w " * n + "</article>"):
        begun = time.perf_counter()
        article.extract(page, learnt)
        assert time.perf_counter() - begun < 10, page[:20]


def test_cutoffs_at_the_edge_of_the_bound(spark):
    """Two rules certified in one language; one good document fewer, and none is in the other."""
    tests = sum(len(cuts) for _, _, cuts in rules.RULES.values()) * 2
    least = next(n for n in range(1, 10_000) if (1 - 0.02 / len(rules.RULES)) ** n * tests <= 0.05)
    rows = spark.range(2 * least + 199).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < least + 100, "aa").otherwise("bb").alias("lang"), (F.col("id") % (least + 100) >= 100).cast("int").alias("quality"))
    bad = F.col("quality") == 0
    count = lambda name, n: F.when(bad, n).otherwise(0).cast("long").alias(name)
    measured = rows.select(
        "doc_id", "lang", F.lit(100).cast("long").alias("n_words"), F.lit(500).cast("long").alias("word_chars"), count("n_symbols", 60), count("n_dup_lines", 3),
        F.lit(0).cast("long").alias("n_repeat_words"), F.lit(10).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_marks"))
    labels = rows.select("doc_id", "quality")
    assert rows.filter("quality = 1").groupBy("lang").count().orderBy("lang").collect() == [("aa", least), ("bb", least - 1)]
    cuts = rules.certify(measured, labels).collect()
    assert [(r["_s"], r.cut_symbols, r.cut_lines, r.cut_repeats, r.cut_marks, r.cut_length) for r in cuts] == [("aa", 50, 20, None, None, None)]
    judged = rules.judge(measured, rules.certify(measured, labels)).filter("NOT kept").groupBy("lang").count().collect()
    assert judged == [("aa", 100)]
    # one good document rejected in the first language: its cutoffs are certified no more
    spoilt = measured.withColumn("n_symbols", F.when(F.col("doc_id") == 150, 60).otherwise(F.col("n_symbols"))).withColumn("n_dup_lines", F.when(F.col("doc_id") == 150, 3).otherwise(F.col("n_dup_lines")))
    assert rules.certify(spoilt, labels).count() == 0
