"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative;
the weights come from labelled pages (pages whose markup names one main
region): a tag that is rarer inside than outside costs more; one that bounds
regions and is never seen inside is a wall. One linear scan finds the contiguous region of the highest
total, and the region's blocks are the text. Elements that are boilerplate by
their name or a whole class (menus, forms, adverts, reader comments, ...) are
cut out before the scan, so one in the middle of an article doesn't split it;
never one that holds the article, or most of the words of a page without one.
A part of a name (``site-footer``, ``user-comment``) cuts outside the article if
it says comments, sidebars or page furniture; other parts (``related-work``) only
cost, and the scan decides. Nothing in ``pre`` or ``code`` is cut by name.

Where the page names its articles (``units``), the scan runs within each of them
and a tag costs next to nothing, so that tables, lists, code and figures end no
article; the words of other parts don't compete. Other pages are scanned whole,
with the learned weights.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import ship

#: bound of the labelled sample (different pages, by hash)
SAMPLE = 600
WORD_WEIGHT = 1.0
WALL = -1000.0
#: tags that bound a region rather than stand in it; only these can be walls
WALLS = frozenset("html head body main article nav footer aside".split())
#: cost of a tag inside a named article: a word outweighs a million
INSIDE = -1e-6
_RAW = "script|style|noscript|template|textarea|select|option|svg|iframe|object|title"
# up to the tag's end: a quoted value may hold '>'; a quote that never closes is a plain character
_INNER = r"""(?:[^>=]|=\s*+(?:"[^"]*"|'[^']*')?+)*+"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b{_INNER}(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)|<[a-zA-Z/!?]{_INNER}(?:>|\Z)|[^<]+|<", re.DOTALL | re.IGNORECASE)
_TAG = re.compile(r"<\s*(/?)\s*([a-zA-Z][a-zA-Z0-9:-]*)")
_NAMES = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_PART = re.compile(r"[^a-z0-9]+")
BLOCK = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption").split())
SPACED = frozenset("br td th wbr mtr mtd".split())
MATH = "math semantics mrow mi mo mn ms mtext mspace mstyle mpadded mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# fixed values: boilerplate by element name, and by class, id, role or label
OUT_TAGS = frozenset("nav footer aside form button menu dialog".split())
#: boilerplate also if they hold most of the words of a page without article or main
_NEVER_PAGE = frozenset("nav footer button menu".split())
OUT_NAMES = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                       "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comments comment commentlist disqus replies respond "
                       "newsletter subscribe subscription related recommended share sharing social popup modal overlay toolbar pagination pager "
                       "masthead topbar skip login signup search contentinfo complementary alert disclaimer widget teaser teasers").split())
# fixed values: parts of a name that cut outside the article, and what unsays them
_CUT_PARTS = frozenset(("comment comments commentlist disqus replies sidebar footer navbar nav navigation menu breadcrumb breadcrumbs cookie cookies consent "
                        "advert adverts advertisement newsletter pagination teaser teasers").split())
_NOT = frozenset("no not has have with without hide hidden page layout body".split())
# fixed values: names of reader comments, cut inside the article too
_READERS = re.compile(r"(?:(?:user|reader|visitor|guest|post|article|blog|page|site)[-_]?comments?|comments?[-_]?(?:list|thread|body|area|section|wrapper|wrap|box|form|item|block|text|content))\Z")
_HOLDERS = frozenset("div section ol ul li dl dd aside article table tr td p blockquote".split())


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, key, text): kind ``open``, ``close`` or ``text``. Comments,
    declarations and raw elements (scripts, styles, title, ...) are left out.
    A head needs no rule of its own: what may stand in it has no other text."""
    out = []
    for m in _TOKEN.finditer(page):
        s = m[0]
        if s[0] != "<" or s == "<":
            out.append(("text", "", s))
            continue
        if m["raw"]:
            continue
        if t := _TAG.match(s):
            out.append(("close" if t[1] else "open", t[2].lower(), s))
    return out


def _names(tag: str) -> tuple[set[str], set[str]]:
    """Whole names (class tokens, id, roles, the label) and their parts."""
    whole, parts = set(), set()
    if "=" in tag:
        for m in _NAMES.finditer(tag):
            value = (m[2] or m[3] or m[4] or "").lower()
            whole.update([value.strip()] if m[1].lower() == "aria-label" else value.split())
            parts.update(_PART.split(value))
    return whole, parts


def _boilerplate(name: str, tag: str, inside: bool) -> str:
    """``cut`` by element name, a whole name or reader comments' names, and
    outside the article by some parts of a name; ``named`` by other parts."""
    if name in OUT_TAGS or name == "header" and not inside:
        return "cut"
    if name in ("html", "body", "main"):
        return ""
    whole, parts = _names(tag)
    if name in _HOLDERS and any(_READERS.match(w) for w in whole):
        return "cut"
    if name == "article":  # one that is named so is a comment or a teaser
        return "" if OUT_NAMES.isdisjoint(whole) else "cut"
    if not OUT_NAMES.isdisjoint(whole):
        return "cut"
    if not inside and name in _HOLDERS and not _CUT_PARTS.isdisjoint(parts) and _NOT.isdisjoint(parts):
        return "cut"
    return "" if OUT_NAMES.isdisjoint(parts) else "named"


def _ends(toks: list[tuple[str, str, str]]) -> list[int]:
    """Index after the element opened at each token. Without a closing tag it
    ends where an article, main or first-level heading starts, where the
    enclosing article ends, or with the page."""
    ends, stop, opened = [0] * len(toks), len(toks), {}
    for i in range(len(toks) - 1, -1, -1):
        kind, key, _ = toks[i]
        ends[i] = stop
        if kind == "open" and key in ("article", "main", "h1") or kind == "close" and key in ("article", "main", "body"):
            stop = i
    for i, (kind, key, _) in enumerate(toks):
        if kind == "open" and key not in VOID:
            opened.setdefault(key, []).append(i)
        elif kind == "close" and opened.get(key):
            ends[opened[key].pop()] = i + 1
    return ends


def _article_ends(toks: list[tuple[str, str, str]], ends: list[int]) -> dict[int, int]:
    """End of each ``article`` and ``main``: its closing tag, else the next
    article, the end of the enclosing main or body, or of the page."""
    out, stop = {}, len(toks)
    for i in range(len(toks) - 1, -1, -1):
        kind, key, _ = toks[i]
        if kind == "open" and key in ("article", "main"):
            closed = ends[i] <= len(toks) and ends[i] > i and toks[ends[i] - 1][:2] == ("close", key)
            out[i] = ends[i] if closed else stop
            stop = i
        elif kind == "close" and key in ("main", "body"):
            stop = i
    return out


def without_boilerplate(toks: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """The tokens without the boilerplate elements (``cut`` in their place)
    and with a mark where one is so named by a part. Outside the article of a
    page that names one, the words of the latter are ``quiet``: they score
    nothing, so they can join a region but not make one."""
    ends, words = _ends(toks), [0]
    for kind, _, s in toks:
        words.append(words[-1] + (len(s.split()) if kind == "text" else 0))
    bounds = _article_ends(toks, ends)
    # the main and the article with the most words
    held = [max(at, key=lambda i: words[bounds[i]] - words[i]) for name in ("article", "main")
            if (at := [i for i in bounds if toks[i][1] == name and (name == "main" or not _boilerplate(name, toks[i][2], True))])]
    code = 0

    def whole(i: int, key: str) -> bool:
        if any(i < k < ends[i] for k in held):
            return True
        return (not held or key == "form") and key not in _NEVER_PAGE and 2 * (words[ends[i]] - words[i]) > words[-1]

    out, i, depth, quiet = [], 0, 0, 0
    while i < len(toks):
        kind, key, s = toks[i]
        if kind == "open" and key in ("pre", "code"):
            code = max(code, ends[i] if ends[i] <= len(toks) and toks[ends[i] - 1][:2] == ("close", key) else i + 1)
        what = _boilerplate(key, s, depth > 0) if kind == "open" and key not in VOID and not s.endswith("/>") and (i >= code or key in OUT_TAGS) else ""
        if what == "cut" and not whole(i, key):
            i = ends[i]
            out.append(("open", "cut", ""))
            continue
        if key in ("article", "main"):
            depth += 1 if kind == "open" else -1
        out.append(("quiet", key, s) if kind == "text" and i < quiet and depth <= 0 else toks[i])
        if what == "named" and not whole(i, key):
            out.append(("open", "#named-inside" if depth > 0 else "#named", ""))
            if held and depth <= 0:
                quiet = max(quiet, ends[i])
        i += 1
    return out


def _key(kind: str, name: str) -> str:
    return name if kind == "open" else "/" + name


#: used for tags the labelled pages don't show
DEFAULT = {"li": -1.0, "/li": -0.3, "a": -0.5, "/a": -0.2, "td": -0.5, "option": -4.0, "input": -4.0, "label": -3.0, "p": -0.1, "/p": -0.1,
           "cut": -1.0, "img": -0.5, "#named": -15.0, "#named-inside": -3.0}
# a formula is made of more tags than words
DEFAULT |= {k: 0.0 for name in MATH for k in (name, "/" + name)}
OTHER = -0.5


def tag_counts(page: str) -> dict[str, tuple[int, int]]:
    """Tags of a labelled page inside and outside its one main region (an
    ``article`` or ``main`` element); empty if it doesn't name exactly one."""
    toks = without_boilerplate(tokens(page))
    starts = [i for i, t in enumerate(toks) if t[0] == "open" and t[1] in ("article", "main")]
    if len(starts) != 1:
        return {}
    end = next((i for i in range(starts[0], len(toks)) if toks[i][0] == "close" and toks[i][1] == toks[starts[0]][1]), len(toks))
    inside, outside = Counter(), Counter()
    for i, (kind, name, _) in enumerate(toks):
        if kind not in ("text", "quiet"):
            (inside if starts[0] < i < end else outside)[_key(kind, name)] += 1
    return {k: (inside[k], outside[k]) for k in inside.keys() | outside.keys()}


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log odds of inside against outside, from -8 to -0.05; a tag of WALLS
    seen 20 times and never inside is a wall."""
    out = dict(DEFAULT)
    for k, (a, b) in counts.items():
        if k == "cut" or k[0] == "#":
            continue  # a gap left by boilerplate says nothing about the region, and a name costs a fixed value
        if a == 0 and b >= 20 and k.lstrip("/") in WALLS:
            out[k] = WALL
        elif a + b >= 20:
            out[k] = max(-8.0, min(-0.05, math.log((a + 0.5) / (b + 0.5)) / 2 - 0.05))
    return out


def units(toks: list[tuple[str, str, str]]) -> list[tuple[int, int]]:
    """Token ranges of the articles the page names, in page order. In a
    ``main`` (the one with the most words): all its outermost articles, with
    its first-level heading before them if none has one; without an article
    the main itself. Without a main: the outermost article with the most
    words and those beside it in the same element. Articles without words
    don't count; empty if the page names none."""
    ends, words = _ends(toks), [0]
    for kind, _, s in toks:
        words.append(words[-1] + (len(s.split()) if kind == "text" else 0))
    bounds = _article_ends(toks, ends)

    def count(span: tuple[int, int]) -> int:
        return words[span[1]] - words[span[0]]

    mains = [(i, bounds[i]) for i in sorted(bounds) if toks[i][1] == "main"]
    main = max(mains, key=count, default=(0, len(toks)))
    articles, parents, stack = [], [], []
    for i in range(main[0], main[1]):
        kind, key, _ = toks[i]
        while stack and ends[stack[-1]] <= i:
            stack.pop()
        if kind != "open":
            continue
        if key == "article" and (not articles or articles[-1][1] <= i):
            articles.append((i, min(bounds[i], main[1])))
            parents.append(stack[-1] if stack else -1)
        elif key not in VOID and ends[i] > i and toks[ends[i] - 1][:2] == ("close", key):
            stack.append(i)
    kept = [(a, p) for a, p in zip(articles, parents) if count(a)]
    if not kept:
        return [main] if mains and count(main) else []
    if not mains:
        home = max(kept, key=lambda x: count(x[0]))[1]
        return [a for a, p in kept if p == home]
    out = [a for a, _ in kept]
    titles = [i for i in range(*main) if toks[i][:2] == ("open", "h1")]
    if titles and titles[0] < out[0][0] and not any(a <= i < b for i in titles for a, b in out):
        close = next((i for i in range(titles[0], out[0][0]) if toks[i][:2] == ("close", "h1")), None)
        if close is not None:
            out.insert(0, (titles[0], close + 1))
    return out


def region(toks: list[tuple[str, str, str]], weights: dict[str, float], floor: float = -math.inf) -> tuple[int, int]:
    """Token range of the highest total score, by one scan; of equal totals
    the first and longest. No tag costs more than ``floor``. Empty if no words."""
    best, best_range, run, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, name, s) in enumerate(toks):
        run += WORD_WEIGHT * len(s.split()) if kind == "text" else 0.0 if kind == "quiet" else max(floor, weights.get(_key(kind, name), OTHER))
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best or run == best and start == best_range[0]:
            best, best_range = run, (start, i + 1)
    return best_range


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Blocks of the best region, white space joined, two newlines between;
    on a page that names its articles, of the best region of each."""
    if not page:
        return ""
    toks = without_boilerplate(tokens(page))
    spans = []
    for a, b in units(toks):
        lo, hi = region(toks[a:b], weights, INSIDE)
        spans.append((a + lo, a + hi))
    blocks, run = [], []

    def flush() -> None:
        block = " ".join("".join(run).split())
        if block:
            blocks.append(block)
        run.clear()

    for lo, hi in spans or [region(toks, weights)]:
        for kind, name, s in toks[lo:hi]:
            if kind in ("text", "quiet"):
                run.append(entities.unescape(s) if "&" in s else s)
            elif name in BLOCK or name == "cut":
                flush()
            elif name in SPACED:
                run.append(" ")
        flush()
    return "\n\n".join(blocks)


def fit_weights(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Tag weights from a bounded sample of ``pages``; those that name no
    single main region teach nothing. Tag names are counted on the executors."""
    ship(pages.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            a, b = Counter(), Counter()
            for page in f["html"]:
                for k, (x, y) in tag_counts(page or "").items():
                    a[k] += x
                    b[k] += y
            keys = sorted(a.keys() | b.keys())
            if keys:
                yield pd.DataFrame({"tag": pd.Series(keys, dtype=object), "inside": [a[k] for k in keys],
                                    "outside": [b[k] for k in keys]})

    # a repeated page counts once (with its smallest html), pages without an id once for each html
    named = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    named = named.withColumn("pick", F.xxhash64("page_id", F.when(F.col("page_id").isNull(), F.col("html"))))
    ids = named.select(F.col("pick").alias("chosen")).distinct().orderBy("chosen").limit(sample)
    # at most ``sample`` hashes: a proven bound
    chosen = named.join(F.broadcast(ids), F.col("pick") == F.col("chosen")).groupBy("pick", "page_id").agg(F.min("html").alias("html"))
    # element names only: a few hundred at most in use, the rest pools in OTHER
    rows = (chosen.select("html").mapInPandas(count, "tag string, inside long, outside long")
                  .groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
                  .where("inside + outside >= 20").orderBy(F.desc(F.col("inside") + F.col("outside")), "tag").limit(500).collect())
    return weights_from({r["tag"]: (r["inside"], r["outside"]) for r in rows})


def extract(pages: DataFrame, weights: dict[str, float], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points). Null html
    counts as empty and gives an empty text; null and repeated ids are
    returned as given; other columns are ignored; an empty table gives an
    empty result."""
    spark = pages.sparkSession or SparkSession.active()
    ship(spark)

    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, weights) for h in html], dtype=object)

    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), run(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
