"""Main-text extraction from HTML by a maximum-scoring subsequence.

A page becomes a sequence of tags and words. Words score positive, tags negative, words of links
lower than others; one linear scan finds the contiguous run with the highest sum: the content
region. The weights are log odds of a token lying inside against outside the marked article of
labelled pages (pages that mark it with one ``article`` or ``main`` element), counted over a bounded sample.

Elements that are never content (scripts, styles, menus, footers, sidebars, forms, hidden elements, and elements
with a class token, id or role that as a whole names an advert, notice, comment section and the like) are taken
out before the scan and count as one tag, unless they hold an ``article`` or ``main`` of their own or only mark code. Reader
comments go even so: elements named as comments, and articles nested in an article with paragraphs of its own (HTML's advice
for comments), as long as the page has an article outside them. Elements named as headers stay inside the article. Articles
that directly follow one another are parts of one. Inside the region character references are decoded, white space inside a block
becomes one space, blocks are joined in page order by one space; nothing else is dropped.

Defined cases: null or empty html gives an empty text; a page without words gives an empty text; of
equal sums the first and longest run wins; unclosed elements end with the page (a boilerplate
element without its end ends at the next ``article`` or ``main``); repeated rows give repeated results; an
empty table gives an empty result; extra columns are ignored. Pages are processed whole, one at a
time, inside Arrow batches.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"(?P<skip><!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
PRUNED = {"head", "nav", "footer", "aside", "form", "noscript", "template", "svg", "canvas", "object", "button", "select",
          "dialog", "menu", "audio", "video", "map", "datalist"} | RAW
#: A class token, id, role or label made of these words alone, or of these and ``PLAIN_MARKS``, marks an element as no
#: content ("cookie-notice" and "ad-slot" do, "has-sidebar" and "article-header" do not: the region decides about those).
PRUNED_MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "complementary", "footer",
    "contentinfo", "header", "masthead", "comment", "comments", "disqus", "respond", "reply", "replies", "cookie", "cookies", "consent",
    "gdpr", "notice", "notices", "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "share", "sharing", "social",
    "related", "recommended", "recommendations", "search", "login", "signup", "widget", "toolbar", "pagination", "pager", "skip", "hidden"}
#: Words that say nothing about an element by themselves.
PLAIN_MARKS = {"slot", "wrapper", "wrap", "container", "box", "bar", "block", "section", "area", "inner", "outer", "list", "item", "items", "unit",
               "body", "thread", "panel", "top", "bottom", "left", "right", "main", "link", "links", "buttons", "icons", "form"}
#: Marks of reader comments: such an element is taken out even if it holds an ``article``, or is one, where the page has another.
COMMENT_MARKS = {"comment", "comments", "disqus", "respond", "reply", "replies"}
#: Marks that outside the article name the site's head, inside it the article's own.
HEAD_MARKS = {"header", "masthead"}
MATH = {"math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msup", "msub", "msubsup", "munder", "mover", "munderover", "mstyle",
        "mspace", "mpadded", "mphantom", "menclose", "semantics"}
INLINE = MATH | {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
MAIN = {"article", "main"}
NAMING = {"class", "id", "role", "aria-label"}
CODE = {"pre", "code"}  # class names in highlighted code name syntax

#: Used when no page of the sample is labelled.
DEFAULT_WEIGHTS = {"#word": 1.0, "#link": -0.5, "article": -200.0, "main": -200.0, "p": -0.1, "br": -0.1, "b": -0.1, "i": -0.1, "em": -0.1,
                   "strong": -0.1, "h1": -0.25, "h2": -0.25, "h3": -0.25, "header": -0.25, "li": -1.0, "a": -0.5, "#pruned": -0.1, "#math": -0.01, "#other": -0.5}
SAMPLE_PAGES = 2000


def _mark(attrs: str) -> str:
    """What an element's attributes mark it as: "comment", "boilerplate", "head" or nothing."""
    found = ""
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden":
            found = found if found == "comment" else "boilerplate"
        elif name in NAMING:
            for t in [value] if name == "aria-label" else value.split():
                words = set(re.findall(r"[a-z]+", t))
                named = words - PLAIN_MARKS
                if not named or not named <= PRUNED_MARKS:
                    continue
                kind = "comment" if named & COMMENT_MARKS else "head" if named <= HEAD_MARKS else "boilerplate"
                if kind == "comment" or found in ("", "head"):
                    found = kind
    return found


def _ends(raw: list[tuple[str, str, bool, str]]) -> dict[int, int]:
    """Opening tag -> its closing tag, of the elements that are closed; tags of other names between do not matter."""
    stacks, out = {}, {}
    for i, (name, _, close, _) in enumerate(raw):
        if not close:
            stacks.setdefault(name, []).append(i)
        elif stacks.get(name):
            out[stacks[name].pop()] = i
    return out


def _nested(raw: list[tuple[str, str, bool, str]], ends: dict[int, int]) -> set[int]:
    """The closed articles that are nested in a closed one with a paragraph of its own."""
    stack, parent, own = [], {}, set()
    for i, (name, _, close, _) in enumerate(raw):
        if name == "article" and i in ends:
            if stack:
                parent[i] = stack[-1]
            stack.append(i)
        elif name == "article" and close and stack and ends[stack[-1]] == i:
            stack.pop()
        elif name == "p" and not close and stack:
            own.add(stack[-1])
    return {i for i, p in parent.items() if p in own}


def _comments(raw: list[tuple[str, str, bool, str]]) -> list[tuple[int, int]]:
    """[open, close] of the elements that hold reader comments: marked ones, and articles nested in an article that has
    paragraphs of its own. Those around an article only where the page has another one: else the mark means something else."""
    ends = _ends(raw)
    nested = _nested(raw, ends)
    found, i = [], 0
    while i < len(raw):
        if i in ends and (raw[i][3] == "comment" or i in nested):
            found.append((i, ends[i]))
            i = ends[i]
        i += 1
    opens = [k for k, t in enumerate(raw) if t[0] in MAIN and not t[2]]
    around = [any(raw[k][0] in MAIN and not raw[k][2] for k in range(a, b)) for a, b in found]
    inside = sum(1 for (a, b), has in zip(found, around, strict=True) if has for k in range(a, b) if raw[k][0] in MAIN and not raw[k][2])
    if opens and inside == len(opens):
        return [f for f, has in zip(found, around, strict=True) if not has]
    return found


def _without_comments(raw: list[tuple[str, str, bool, str]]) -> list[tuple[str, str, bool, str]]:
    """The tokens with each comment element outside code as one "#pruned"."""
    if not any(t[3] == "comment" for t in raw) and sum(t[0] == "article" and not t[2] for t in raw) < 2:
        return raw
    code, depth = [], 0
    for name, _, close, _ in raw:
        depth = max(0, depth + (-1 if close else 1)) if name in CODE else depth
        code.append(depth)
    out, at = [], 0
    for a, b in _comments(raw):
        if not code[a]:
            out += [*raw[at:a], ("#pruned", "", False, "")]
            at = b + 1
    return out + raw[at:]


def _joined_parts(raw: list[tuple[str, str, bool, str]]) -> list[tuple[str, str, bool, str]]:
    """The tokens with articles that follow one another directly as one: where nothing but white space stands
    between the end of one and the start of the next, both tags become plain block tags."""
    out, last = list(raw), None
    for i, (name, text, close, _) in enumerate(raw):
        if name == "article" and close:
            last = i
        elif name == "article" and last is not None:
            out[last], out[i], last = ("div", "", True, ""), ("div", "", False, ""), None
        elif name != "#text" or text.strip():
            last = None
    return out


def tokenize(page: str) -> list[tuple[str, str, bool]]:
    """(tag name or "#text" or "#pruned", text, is a closing tag) in page order, boilerplate taken out."""
    raw: list[tuple[str, str, bool, str]] = []
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        if m["text"] is not None:
            raw.append(("#text", m["text"], False, ""))
        elif m["name"]:
            name, close = m["name"].lower(), bool(m["close"])
            attrs = m["attrs"] or ""
            if name in RAW and not close and not attrs.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
                raw.append(("#pruned", "", False, ""))
            elif not (name in RAW and close):
                mark = ""
                if not close and name not in ("html", "body") and name not in VOID and not attrs.endswith("/"):
                    mark = _mark(attrs) if attrs else ""
                    if name in PRUNED:
                        mark = mark if mark == "comment" else "boilerplate"
                    elif name in MAIN and mark != "comment":
                        mark = ""
                raw.append((name, attrs, close, mark))
    raw = _joined_parts(_without_comments(raw))
    article, code = Counter(), 0
    out: list[tuple[str, str, bool]] = []
    i = 0
    while i < len(raw):
        name, text, close, mark = raw[i]
        if name in MAIN:
            article[name] += -1 if close else 1
        if name in CODE:
            code = max(0, code + (-1 if close else 1))
        bad = mark == "head" and not any(v > 0 for v in article.values()) or mark in ("boilerplate", "comment")
        bad = bad and name not in MAIN and (name in PRUNED or not code)
        # a header inside the article belongs to it, any other one does not
        if bad or (name == "header" and not close and not any(v > 0 for v in article.values())):
            depth, j, stop = 1, i + 1, None
            inside = any(v > 0 for v in article.values())
            while j < len(raw) and depth:
                if raw[j][0] == name:
                    depth += -1 if raw[j][2] else 1
                if stop is None and raw[j][0] in MAIN and not raw[j][2]:
                    stop = j
                if raw[j][0] in MAIN and raw[j][2] and any(v > 0 for v in article.values()):
                    stop = j if stop is None else stop
                    break
                j += 1
            if inside or depth or stop is None:  # a closed element around an article or main stays
                out.append(("#pruned", "", False))
                i = j if not depth else (stop if stop is not None else len(raw))
                continue
        out.append((name, text if name == "#text" else "", close))
        i += 1
    return out


def features(tokens: list[tuple[str, str, bool]]) -> Iterator[tuple[str, int]]:
    """(feature, number of tokens) of each token: words by whether they stand in a link, tags by name."""
    link = 0
    for name, text, close in tokens:
        if name == "#text":
            yield ("#link" if link > 0 else "#word"), len(text.split())
        else:
            if name == "a":
                link = 0 if close else 1
            yield "#math" if name in MATH else name, 1


def count(page: str) -> Counter | None:
    """(feature, inside the marked article) -> tokens; None if the page marks no article or several."""
    tokens = tokenize(page)
    opens = [i for i, t in enumerate(tokens) if t[0] in MAIN and not t[2]]
    closes = [i for i, t in enumerate(tokens) if t[0] in MAIN and t[2]]
    if len(opens) != 1 or len(closes) != 1 or closes[0] < opens[0]:
        return None
    got = Counter()
    for i, (f, k) in enumerate(features(tokens)):
        got[f, opens[0] < i < closes[0]] += k
    return got


def learn(counts: Counter) -> dict[str, float]:
    """Log odds of a token inside against outside the article; words positive, tags negative."""
    names = {f for f, _ in counts}
    inside, outside = (sum(v for (_, s), v in counts.items() if s is side) + len(names) for side in (True, False))
    w = dict(DEFAULT_WEIGHTS)
    for f in names:
        odds = math.log((counts[f, True] + 1) / inside) - math.log((counts[f, False] + 1) / outside)
        if f == "#word":
            w[f] = min(max(odds, 0.5), 1.0)
        elif f == "#link":
            w[f] = min(max(odds, -1.0), 0.5)
        elif f in MAIN:
            w[f] = min(max(50 * odds, -400.0), -50.0)  # the region lies within one article
        elif f not in ("#pruned", "#math"):  # what was taken out says nothing about its place, nor does a formula's mark-up
            w[f] = min(max(odds, -6.0), -0.05)
    return w


def best_region(tokens: list[tuple[str, str, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """[start, end) of the contiguous run of tokens with the highest sum (first, then longest)."""
    best, best_at, run, start = 0.0, (0, 0), 0.0, 0
    for i, (f, k) in enumerate(features(tokens)):
        if run <= 0:
            run, start = 0.0, i
        run += k * weights.get(f, weights["#other"])
        if run > best or (run == best and start == best_at[0] and k):
            best, best_at = run, (start, i + 1)
    return best_at


def extract(page: str | None, weights: dict[str, float]) -> str:
    tokens = tokenize(page or "")
    a, b = best_region(tokens, weights)
    parts = []
    for name, text, _ in tokens[a:b]:
        if name == "#text":
            parts.append(text)
        elif name not in INLINE:
            parts.append(" ")
    return " ".join(htmllib.unescape("".join(parts)).split())


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from the labelled ones among ``sample`` pages, chosen by a hash of their id."""
    # tag names beyond HTML's own are one feature, so the table is small: no page can make it grow
    ids = pages.select("page_id").where("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                got = count(page or "")
                if got:
                    total.update(got)
        if total:
            yield pa.RecordBatch.from_pydict({"f": [f for f, _ in total], "inside": [s for _, s in total], "n": list(total.values())})

    counted = pages.select("page_id", "html").join(F.broadcast(ids), "page_id").select("html").mapInArrow(run, "f string, inside boolean, n long")
    known = counted.withColumn("f", F.when(F.col("f").rlike("^(#[a-z]+|[a-z]+[1-6]?)$") & (F.length("f") <= 12), F.col("f")).otherwise("#other"))
    rows = known.groupBy("f", "inside").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "f").limit(500).collect()
    return learn(Counter({(r["f"], r["inside"]): r["n"] for r in rows})) if rows else dict(DEFAULT_WEIGHTS)


def extract_pages(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(page_id, url, html) -> page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x, weights) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
