"""Main text of web pages by the best-scoring contiguous region.

A page is read as a sequence of tags and words. Words score by the place they stand in, tags score negative;
both weights are log-odds counted on labelled pages, that is pages whose markup itself names the article
(`article` or `main`). One linear scan finds the contiguous region of the highest sum. Inside it, elements
that never belong to an article (navigation, forms, notices, adverts, comments, scripts) are left out, and
all the remaining text is cut into blocks; the weights only find the region. Where the markup names the
article, its words score one each and its tags and such elements within it nothing, so that nothing parts it.
Elsewhere words outside links in plain elements (no class, id or role) score at least PLAIN each and their
tags at least -1: that lists, cells and divs are commoner in menus does not speak against long ones.

Which elements never belong is told by their name or by a whole class, id or role (`sidebar`, but not
`has-sidebar`; ids of headings and paragraphs do not count). It holds for no element that is or encloses the
html, body, main or article; articles that stand in such an element themselves (comments, teasers) do not
count while another one is free of it. On pages that name no article, it holds for no marked element or form
with more than half of the page's words.

Fitting counts on at most about `sample` labelled pages, picked by a hash of the page's id; every page is
extracted. Defined cases: null and empty pages give an empty text, pages without any words too; unclosed and
stray tags are allowed; an empty table gives no rows; equal pages give equal texts.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a tag's begin; its attributes one by one: quotes count only after an equals sign, as in HTML
TAG = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/><]*)")
ATTRIBUTE = re.compile(r"[\s/]*+(?:(?P<name>[^\s/><=]=?[^\s/><=]*+)(?:\s*+=\s*+(?:\"(?P<a>[^\"]*+)\"|'(?P<b>[^']*+)'|(?P<c>[^\s><]*+)))?+)?+")
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)", re.S)
# Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea svg iframe select math object canvas".split())
CLOSE = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
NAMING = frozenset(("class", "id", "role"))
PART = re.compile(r"[a-z]+")

# Element names of the HTML standard and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("head title nav aside footer form button menu dialog".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies "
    "footer form menu nav navbar navigation newsletter notice notices popup promo related reply replies search share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li dd dt tr td th".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())  # their ids are made from their words
WHOLE = frozenset("html body main".split())
LEAST, MOST = -6.0, -0.05
PLAIN = 0.5


class Place:
    """Where a word stands: the nearest block's key, and whether some ancestor is never part of an article."""

    __slots__ = ("name", "key", "up", "block", "marked", "hinted", "never", "inside", "link", "words", "holds")

    def __init__(self, name: str, key: str, up: Place | None, marked: bool = False):
        self.name, self.key, self.up, self.marked = name, key, up, marked
        self.hinted = marked or name in NEVER or name == "header" and not (up and up.inside)
        self.block = up.block if up and name in INLINE else key
        self.inside = bool(up and up.inside) or name in ("article", "main")
        self.link = bool(up and up.link) or name == "a"
        self.never, self.words, self.holds = "", 0, False

    @property
    def context(self) -> str:
        return self.never or self.block


def settle(places: list[Place]) -> None:
    """Decide `never` of every place of a page; they come in the order of their start tags, with their own words."""
    for p in reversed(places):
        if p.up:
            p.up.words += p.words
    articles = [p for p in places if p.name == "article"]
    for p in places:  # for now: whether a hinted element is around
        p.never = (p.up.never if p.up else "") or ("x" if p.hinted and p.name not in WHOLE else "")
    hold = [p for p in places if p.name == "main"]
    if articles:
        hold += [p for p in articles if not p.never] or articles
        hold.append(max(articles, key=lambda p: p.words))
    if not hold:
        hold = [p for p in places if (p.marked and p.name not in NEVER or p.name == "form") and p.words * 2 > places[0].words]
    for p in hold:
        while p and not p.holds:
            p.holds = True
            p = p.up
    for p in places:
        p.never = (p.up.never if p.up else "") or (p.key if p.hinted and not p.holds and p.name not in WHOLE else "")


def tokens(page: str) -> list[tuple[str, str, Place]]:
    """(kind, value, place): kind "tag" with the tag's key and whether it breaks blocks, or "text" with its raw text."""
    places = [Place("body", "body", None)]
    out = list(read(page, places))
    settle(places)
    return out


def pieces(page: str):
    """("text", text), ("raw", name) and ("start" or "end", name, class, id and role, whether it closes itself).

    One pass: a tag ends at `>`, or before the next `<` where that is missing; what is opened and not closed
    (comments, scripts) goes to the end of the page.
    """
    at, n = 0, len(page)
    while at < n:
        if page[at] != "<":
            to = page.find("<", at)
            to = n if to < 0 else to
            yield "text", page[at:to]
            at = to
            continue
        m = TAG.match(page, at)
        if not m:
            m = COMMENT.match(page, at)
            if not m and at + 1 < n:
                yield "text", "<"
            at = m.end() if m else at + 1
            continue
        name, at, named, last = m["name"].lower(), m.end(), [], ""
        while at < n and page[at] not in "<>":
            found = ATTRIBUTE.match(page, at)
            if found.end() == at:  # an equals sign without a name
                at += 1
                continue
            at, last = found.end(), "" if found["name"] else page[found.end() - 1]
            if found["name"] and found["name"].lower() in NAMING:
                value = next((found[g] for g in "abc" if found[g] is not None), "")
                if found["name"].lower() != "id" or name not in HEADINGS:
                    named.append(value.lower())
        at += page[at : at + 1] == ">"
        if not m["end"] and name in RAW:
            closed = CLOSE[name].search(page, at)
            at = closed.end() if closed else n
            yield "raw", name
        else:
            yield "end" if m["end"] else "start", name, named, last == "/"


class Open:
    """The open elements. Counts of names, and of those above each block, say what an end tag can reach without a search."""

    def __init__(self, body: Place):
        self.stack, self.names, self.blocks, self.above = [body], Counter(), [0], [Counter()]

    def push(self, place: Place) -> None:
        self.stack.append(place)
        self.names[place.name] += 1
        if place.name in INLINE:
            self.above[-1][place.name] += 1
        else:
            self.blocks.append(len(self.stack) - 1)
            self.above.append(Counter())

    def pop(self) -> Place:
        place = self.stack.pop()
        self.names[place.name] -= 1
        if place.name in INLINE:
            self.above[-1][place.name] -= 1
        else:
            self.blocks.pop()
            self.above.pop()
        return place

    def close(self, name: str) -> str | None:
        """Close the nearest element of this name; an inline end tag does not reach over the block it stands in."""
        if not (self.above[-1] if name in INLINE else self.names)[name]:
            return None
        while True:
            place = self.pop()
            if place.name == name:
                return place.key

    def close_p(self) -> None:
        if self.stack[self.blocks[-1]].name == "p":
            self.close("p")


def read(page: str, places: list[Place]):
    open_ = Open(places[0])
    for kind, name, *more in pieces(page):
        top = open_.stack[-1]
        if kind == "text":
            top.words += len(name.split())
            yield "text", name, top
        elif kind == "raw":
            yield "tag", name, top
        elif kind == "end":
            key = open_.close(name)
            yield "tag", "/" + (name if key is None else key), open_.stack[-1]
        else:
            named, empty = more
            key = " ".join([name, *sorted({p for v in named for p in PART.findall(v)})])
            marked = any(x in HINTS for v in named for x in v.split())
            if name in CLOSES_P:
                open_.close_p()
            if name in VOID or empty:
                yield "tag", key, open_.stack[-1]
                continue
            place = Place(name, key, open_.stack[-1], marked)
            open_.push(place)
            places.append(place)
            yield "tag", key, place


def counts_of(page: str) -> Counter:
    """(kind, key, inside) -> number, for a page that names its article; else empty."""
    found: Counter = Counter()
    low = page.lower()
    if "<article" not in low and "<main" not in low:
        return found
    for kind, value, place in tokens(page):
        if kind == "text":
            if n := len(value.split()):
                found["word", place.context, place.inside and not place.never] += n
        else:
            border = value.lstrip("/").split(" ")[0] in ("article", "main")
            found["tag", value, place.inside and not place.never and not border] += 1
    return found


def weights(counts: dict[tuple[str, str, bool], int]) -> dict[str, dict[str, float]]:
    """Log-odds of standing inside, smoothed by one: words within [-1, 1], tags within [LEAST, MOST]."""
    out: dict[str, dict[str, float]] = {"word": {}, "tag": {}}
    for kind, key in {(k, x) for k, x, _ in counts}:
        odds = math.log((counts.get((kind, key, True), 0) + 1) / (counts.get((kind, key, False), 0) + 1))
        out[kind][key] = min(1.0, max(-1.0, odds)) if kind == "word" else min(MOST, max(LEAST, odds))
    return out


def extract(page: str | None, learnt: dict[str, dict[str, float]]) -> str:
    """The main text: blocks of the best region, one per line."""
    if not page:
        return ""
    word, tag = learnt["word"], learnt["tag"]
    seen = tokens(page)
    named = any(place.inside for _, _, place in seen)
    best, total, first, span = 0.0, 0.0, 0, (0, 0)
    for i, (kind, value, place) in enumerate(seen):
        if kind == "text":
            n = len(value.split())
            if not n:
                continue
            if place.never:
                score = 0.0 if place.inside else n * word.get(place.never, -1.0)
            elif place.inside:
                score = float(n)
            else:
                score = word.get(place.block, 1.0)
                score = n * (score if named or place.link or " " in place.block else max(score, PLAIN))
        elif place.inside:
            score = 0.0
        else:
            score = tag.get(value, -1.0)
            score = score if named or place.never or " " in value else max(score, -1.0)
        if total <= 0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, span = total, (first, i + 1)
    blocks, now = [], []

    def close() -> None:
        if text := " ".join(entities.unescape("".join(now)).split()):
            blocks.append(text)
        now.clear()

    for kind, value, place in seen[slice(*span)]:
        if kind == "text":
            if not place.never:
                now.append(value)
        elif value.lstrip("/").split(" ")[0] not in INLINE:
            close()
        elif value.startswith(("br", "/br")):
            now.append(" ")
    close()
    return "\n".join(blocks)


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = 4_000) -> dict[str, dict[str, float]]:
    """Weights from about `sample` pages picked by a hash of their id (all, if there are fewer)."""
    every = max(1, pages.count() // sample)
    picked = pages.filter((F.pmod(F.xxhash64(page_id), F.lit(every)) == 0) & F.col(html).isNotNull()).select(F.col(html).alias("html"))

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for page in batch["html"].to_pylist():
                total.update(counts_of(page))
        rows = [{"kind": k, "key": x, "inside": i, "n": n} for (k, x, i), n in total.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("kind", pa.string()), ("key", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    counted = picked.mapInArrow(run, "kind string, key string, inside boolean, n long").groupBy("kind", "key", "inside").agg(F.sum("n").alias("n"))
    # keys of the sample only, so their number is bounded by it
    return weights({(r.kind, r.key, r.inside): r.n for r in counted.collect()})


def main_text(pages: DataFrame, learnt: dict[str, dict[str, float]], html: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of each in column `out`."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([extract(p, learnt) for p in column.to_pylist()], type=pa.string())

    return pages.withColumn(out, run(F.col(html)))
