"""Personal data by bootstrapped contextual extraction.

Exact patterns find the seeds (email, ip, card, phone). Each mention of a seed, and each mention of something
that may be one (spelled-out or bracketed mail address, four short numbers with dotted or bracketed points,
run of digits in any grouping), is tied to two lexical patterns: the word before and the word after it. On
that graph of patterns and instances Spark scores both sides in turns: a pattern is as trustworthy as the
share of its instances that are trusted, an instance as sure as its patterns together make it (noisy or).
Patterns need the support of several different seeds or instances that the round before made sure; those
count as much as seeds, so a discovered identifier brings in new patterns. After the last round the sure
candidates are spans too, of the kind that scores best; seeds always stay.

What cannot be of a kind is no candidate: a run of fewer than 5 or more than 15 digits is no phone number,
one of other than 12 to 19 digits or with a wrong check digit no card, one with a part over 255 no address.

Edges are counted per pattern and instance before anything is joined, so a context that a third of all
mentions share is one sum. Texts are scanned once, whole.

Defined cases: null and empty texts have no spans; rows of one id are told apart by their text; equal rows
have equal results; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.session import materialise

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where a run of digits begins, and never gives a digit back
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

# what may stand for the sign and the points of an address
SIGN, POINT = r"(?:[(\[{<] ?(?:at|@) ?[)\]}>])", r"(?:[(\[{<] ?(?:dot|\.) ?[)\]}>])"
ALIKE_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}} ?(?:{SIGN} ?[A-Za-z0-9-]{{1,63}}(?: ?(?:{POINT}| dot |\.) ?[A-Za-z0-9-]{{1,63}}){{1,4}}"
    rf"| (?:at|@) [A-Za-z0-9-]{{1,63}}(?: ?(?:{POINT}| dot |(?<! )\.(?! )) ?[A-Za-z0-9-]{{1,63}}){{1,4}}"
    rf"|@ ?[A-Za-z0-9-]{{1,63}}(?: ?(?:{POINT}| dot ) ?[A-Za-z0-9-]{{1,63}}){{1,4}})", re.I,
)
SIGNS = re.compile(r"\bat\b|@", re.I)
ALIKE_IP = re.compile(rf"(?<![0-9A-Za-z.])[0-9]{{1,3}}(?: ?(?:{POINT}| dot |\.) ?[0-9]{{1,3}}){{3}}(?![0-9A-Za-z])", re.I)
ALIKE_NUMBER = re.compile(r"(?<![0-9A-Za-z.,+-])[(\[]?[0-9](?:[ ()\[\]./-]{0,3}[0-9]){4,18}(?![0-9A-Za-z])")
BEFORE = re.compile(r"(\S{1,40})\s{1,3}\Z")
AFTER = re.compile(r"[,.;:!?)]{0,2}\s{1,3}(\S{1,40})")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from the @ signs in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the seeds, by start and kind."""
    out = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
                out.append((m.start(), m.end(), 1))
        for m in CARD.finditer(text):
            if m.end() - m.start() < 40:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2]))


def alike(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What may be one of a kind and touches no seed: (start, end, kind number); a run of digits may be of two kinds."""
    found = []
    if SIGNS.search(text):
        found += [(m.start(), m.end(), 0) for m in ALIKE_EMAIL.finditer(text)]
    if DIGIT.search(text):
        for m in ALIKE_IP.finditer(text):
            if all(int(g) < 256 for g in re.findall("[0-9]+", m[0])):
                found.append((m.start(), m.end(), 1))
        for m in ALIKE_NUMBER.finditer(text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if len(digits) >= 12 and luhn(digits):
                found.append((m.start(), m.end(), 2))
            if len(digits) <= 15:
                found.append((m.start(), m.end(), 3))
    out, k, spans = [], 0, sorted((s, e) for s, e, _ in taken)
    for s, e, kind in sorted(found):
        while k < len(spans) and spans[k][1] <= s:
            k += 1
        if k == len(spans) or spans[k][0] >= e:
            out.append((s, e, kind))
    return out


def mentions(text: str) -> list[dict]:
    """Seeds and look-alikes with their contexts."""
    base = base_spans(text)
    out = []
    for seed, spans in ((True, base), (False, alike(text, base))):
        for s, e, kind in spans:
            before = BEFORE.search(text[max(0, s - 44) : s])
            after = AFTER.match(text, e, e + 48)
            surface = text[s:e].lower()
            out.append(
                {
                    "start": s, "end": e, "kind": kind, "seed": seed,
                    "instance": surface if kind == 0 else ("." if kind == 1 else "").join(re.findall("[0-9]+", surface)),
                    "before": before[1].lower().strip(".,;:!?()\"'") or None if before else None,
                    "after": after[1].lower().strip(".,;:!?()\"'") or None if after else None,
                }
            )
    return out


MENTION = "struct<start: int, end: int, kind: int, seed: boolean, instance: string, before: string, after: string>"


def scanned(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest of the text, mentions of every row."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("seed", pa.bool_()), *((c, pa.string()) for c in ("instance", "before", "after"))]))

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["digest"], pa.array(list(map(mentions, texts)), kind)], names=["doc_id", "digest", "found"])

    narrow = docs.select(F.col(doc).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, digest long, found array<{MENTION}>")


def edges_of(found: DataFrame) -> DataFrame:
    """(pattern, kind, instance, seed): one row each, however often it is mentioned."""
    m = found.select(F.explode("found").alias("m")).select("m.*")
    sides = F.array(F.concat(F.lit("before "), F.col("before")), F.concat(F.lit("after "), F.col("after")))
    rows = m.select(F.explode(sides).alias("pattern"), "kind", "instance", "seed").filter("pattern IS NOT NULL")
    return rows.groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed"))


def bootstrap(edges: DataFrame, rounds: int = 3, support: int = 3, surest: float = 0.95, least: float = 0.9) -> DataFrame:
    """(instance, kind, score) of the candidates after scoring patterns and instances in turns.

    Candidates that reach `least` count as seeds do in the next round.
    """
    edges = materialise(edges, "edges")
    scores = None
    for _ in range(rounds):
        now = edges.withColumn("score", F.col("seed").cast("double"))
        if scores is not None:
            known = F.when(F.col("seed") | (F.col("score") >= least), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))
            now = edges.join(scores, ["instance", "kind"], "left").withColumn("score", known)
        # decimals add up to the same sum in any order
        total = F.sum(F.col("score").cast("decimal(20, 12)")).cast("double")
        patterns = now.groupBy("pattern", "kind").agg((total / (F.count(F.lit(1)) + 1)).alias("trust"), F.count_if(F.col("score") >= 1.0).alias("_n"))
        patterns = patterns.filter(F.col("_n") >= support).select("pattern", "kind", F.least("trust", F.lit(surest)).alias("trust"))
        told = edges.filter(~F.col("seed")).join(patterns, ["pattern", "kind"])
        doubt = F.sum(F.log1p(-F.col("trust")).cast("decimal(20, 12)")).cast("double")
        scores = materialise(told.groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score")), "scores")
    return scores


def spelled(spans: Column) -> Column:
    """`kind:start:end` of (start, kind, end) structs, in order, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def discovered(found: DataFrame, least: float = 0.9, rounds: int = 3) -> DataFrame:
    """From the table of `scanned` the spans beyond the seeds: doc_id, digest, more; rows with some only."""
    sure = bootstrap(edges_of(found), rounds, least=least).filter(F.col("score") >= least)
    loose = found.filter(F.exists("found", lambda m: ~m["seed"])).select("doc_id", "digest", F.explode("found").alias("m")).select("doc_id", "digest", "m.*").filter("NOT seed")
    met = loose.join(sure, ["instance", "kind"]).select("doc_id", "digest", "start", "end", (-F.col("score")).alias("doubt"), "kind")
    told = met.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("start", "end", "doubt", "kind"))).alias("all"))
    # the best kind of each span
    best = F.filter("all", lambda x, i: (i == 0) | (F.get("all", i - 1)["start"] != x["start"]) | (F.get("all", i - 1)["end"] != x["end"]))
    return told.select("doc_id", "digest", F.transform(best, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).alias("more"))


def find(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: float = 0.9, rounds: int = 3) -> DataFrame:
    """doc_id, digest, base and spans (arrays of (start, kind, end)) of every row of `docs`."""
    found = materialise(scanned(docs, doc, text), "mentions")
    more = discovered(found, least, rounds)
    as_span = lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))
    base = F.transform(F.filter("found", lambda m: m["seed"]), as_span)
    f, m = found.alias("f"), more.alias("m")
    same = F.col("f.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("f.digest") == F.col("m.digest"))
    both = f.join(m, same, "left").select("f.doc_id", "f.digest", base.alias("base"), "more")
    nothing = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    return both.select("doc_id", "digest", "base", F.concat("base", F.coalesce("more", nothing)).alias("spans"))


def redact(text: str | None, more: list[dict] | None) -> str | None:
    """`text` with its seeds and the discovered spans replaced by their kind; of overlapping spans the first names the kind."""
    if not text:
        return text
    spans = base_spans(text)
    if more:
        spans = sorted([*spans, *((s["start"], s["end"], s["kind"]) for s in more)], key=lambda x: (x[0], x[2]))
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: float = 0.9, rounds: int = 3) -> DataFrame:
    """`docs` with all spans found in `text` replaced.

    Seeds are found again where the text is, so only rows with discovered spans meet them in a join; their
    table is written first, and Spark sees its size.
    """
    found = materialise(scanned(docs, doc, text), "mentions")
    more = discovered(found, least, rounds).toDF("_of", "_digest", "_more")

    @F.arrow_udf("string")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([redact(t, m) for t, m in zip(texts.to_pylist(), lists.to_pylist())], pa.string())

    # the row travels as one column, whatever its own are called
    whole = docs.select(F.struct(*docs.columns).alias("whole"), F.col(doc).cast("long").alias("_id"), F.xxhash64(text).alias("_text"))
    met = whole.join(materialise(more, "more"), F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_text") == F.col("_digest")), "left")
    own = {c: F.col("whole").getField(c) for c in docs.columns}
    return met.select(*[(run(x, F.col("_more")) if c == text else x).alias(c) for c, x in own.items()])
