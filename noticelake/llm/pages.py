"""Main text of HTML pages by the maximum-scoring run of words and tags (operator 3).

Words score positive and tags negative. The weights are counted on labelled pages, those that mark up one
article: for each tag, and each word of a class, id or role, how often it stands inside of the article and how often it
keeps something out of it. Names of boilerplate are only prior counts, which the pages outvote. One linear scan finds the contiguous
region of the highest sum; runs with a negative sum in it are left out.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, slices

#: Tags that part no blocks, tags without an end, tags that are taken for boilerplate until pages tell, tags whose content is not markup.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILER = set("nav header footer aside form menu dialog button select textarea iframe object applet canvas head title fieldset datalist".split())
RAW = set("script style title textarea iframe".split())
#: Elements whose content is left out, and what ends the first two of them wherever it stands.
HIDDEN = set("svg math template noscript".split())
BREAKS = set("article aside blockquote body br center dd div dl dt em footer h1 h2 h3 h4 h5 h6 head header hr img li main nav ol p pre section span strong table td tr ul".split())
#: Words of a class, id or role that are taken for boilerplate until pages tell.
NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs header masthead footer foot "
    "comment comments disqus reply replies cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended widget toolbar pagination pager complementary contentinfo".split()
)

#: Prior counts (inside, outside) of names of boilerplate and of all others.
PRIOR = {True: (0.02, 20.0), False: (20.0, 0.2)}
#: The score of a tag that no labelled page has, the least and the most of any; an element whose words weigh less than this may be left out.
UNSEEN, LEAST, MOST, LOW = -0.7, -1.5, -0.02, 0.25
#: A name counts if this share of the labelled pages has it, so as many names come to the driver as 10,000 pages hold.
RARE = 1e-4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.I | re.S,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = re.compile(rf"</({'|'.join(sorted(RAW | HIDDEN))})\s*>", re.I)


@dataclass
class Page:
    """tokens: (element, is a tag, text) in page order, an element for each tag and for each text the one that it is in; element 0 is the page."""

    tokens: list[tuple[int, bool, str]] = field(default_factory=list)
    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    keys: list[tuple[str, ...]] = field(default_factory=lambda: [()])


def _keys(tag: str, attrs: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role, with a dot before; a div or span that has such words is known by them alone."""
    words = {f".{w.lower()}" for m in _NAMED.finditer(attrs) for w in _PART.findall(m[1] or m[2] or m[3] or "")} if "=" in attrs else set()
    return tuple(sorted(words)) if words and tag in ("div", "span") else (tag, *sorted(words))


def _prior(key: str) -> bool:
    return key[1:] in NAMES if key.startswith(".") else key in BOILER


def parse(page: str) -> Page:
    """Tokens and elements, in time in proportion to the page.

    Ends close the nearest open element of their name, with all that is open in it; an end without one counts
    for nothing. An article or main element ends what is left open of menus and adverts, but not of comments.
    The content of scripts and the like is passed over to their end; pictures and templates are elements whose content gives no tokens,
    and their parent's end is theirs. Of either kind those that close themselves or have no end at all hold nothing.
    """
    out = Page()
    stack: list[int] = []
    opened: Counter = Counter()
    suspects = comments = hidden = 0  # open elements with names of boilerplate, those of comments, those without content
    ends: dict[str, list[int]] = {}
    for m in _ENDS.finditer(page):
        ends.setdefault(m[1].lower(), []).append(m.end())

    def close() -> int:
        nonlocal suspects, comments, hidden
        e = stack.pop()
        opened[out.tags[e]] -= 1
        suspects -= any(map(_prior, out.keys[e]))
        comments -= any(k.startswith(".comment") for k in out.keys[e])
        hidden -= out.tags[e] in HIDDEN
        return e

    pos = 0
    while m := _TOKEN.match(page, pos):
        pos = m.end()
        if m["text"]:
            if not hidden:
                out.tokens.append((stack[-1] if stack else 0, False, m["text"]))
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if opened[tag]:
                seen = not hidden
                while out.tags[e := close()] != tag:
                    pass
                if seen or not (hidden or tag in HIDDEN):
                    out.tokens.append((e, True, ""))
            continue
        attrs = m["attrs"] or ""
        if tag in RAW or tag in HIDDEN:
            last = ends.get(tag, [])
            at = bisect.bisect_left(last, pos)
            if attrs.endswith("/") or at == len(last):
                continue
            if tag in RAW:
                pos = last[at]
                continue
        while hidden and tag in BREAKS and (opened["svg"] or opened["math"]):
            close()
        if tag in ("article", "main") and suspects and not comments:
            while suspects:
                close()
        if tag in ("p", "li", "tr", "td", "option", "dd", "dt") and stack and out.tags[stack[-1]] == tag:
            close()
        e = len(out.tags)
        out.tags.append(tag)
        out.parents.append(stack[-1] if stack else 0)
        out.keys.append(_keys(tag, attrs))
        hidden += tag in HIDDEN
        if not hidden:
            out.tokens.append((e, True, ""))
        if tag not in VOID and not attrs.endswith("/"):
            stack.append(e)
            opened[tag] += 1
            suspects += any(map(_prior, out.keys[e]))
            comments += any(k.startswith(".comment") for k in out.keys[e])
    return out


def _counts(page: Page) -> Counter | None:
    """(key, inside) -> words and tags, of a page with one article; None for others.

    All elements of the article stand inside, but a name that holds no more than half of the article's words there counts a tenth,
    and none if it is one of boilerplate: that articles hold adverts does not make adverts articles. Outside stands what keeps its words out: the
    outermost elements that do not hold the article, not the lists and links in these. Counts are in tenths.
    """
    articles = [e for e, t in enumerate(page.tags) if t == "article"]
    if len(articles) != 1:
        return None
    words = [0] * len(page.tags)
    for e, is_tag, text in page.tokens:
        if not is_tag:
            words[e] += len(text.split())
    for e in range(len(page.tags) - 1, 0, -1):
        words[page.parents[e]] += words[e]
    around, e = {0}, page.parents[articles[0]]
    while e:
        around.add(e)
        e = page.parents[e]
    inside = [False] * len(page.tags)
    sides: dict[bool, Counter] = {True: Counter(), False: Counter()}
    number: Counter = Counter()
    for e in range(1, len(page.tags)):
        inside[e] = e == articles[0] or inside[page.parents[e]]
        if inside[e] or (page.parents[e] in around and e not in around):
            for key in page.keys[e]:
                sides[inside[e]][key] += words[e]
                number[key, inside[e]] += 1
    found: Counter = Counter()
    for side, keys in sides.items():
        for key, n in keys.items():
            times = 10 if not side or 2 * n > words[articles[0]] else 0 if _prior(key) else 1
            found[key, side, "words"] = times * n
            found[key, side, "tags"] = times * number[key, side]
    return found


COUNTED = "key string, inside boolean, words long, tags long, pages long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts summed over a batch before they are shuffled; the row without a key has the number of labelled pages."""
    for _, texts in slices(batches, "html", 1 << 22, 10_000):
        sums: dict = {}
        for text in texts:
            if (found := _counts(parse(text))) is None:
                continue
            sums.setdefault((None, True), [0, 0, 0])[2] += 1
            for key, inside in {k[:2] for k in found}:
                row = sums.setdefault((key, inside), [0, 0, 0])
                for i, n in enumerate((found[key, inside, "words"], found[key, inside, "tags"], 1)):
                    row[i] += n
        columns = [[k[0] for k in sums], [k[1] for k in sums], *[[r[i] for r in sums.values()] for i in range(3)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), *[pa.int64()] * 3), strict=True)], names=[c.split()[0] for c in COUNTED.split(", ")])


@dataclass
class Weights:
    """words: the weight of a word in an element with a key, the square of the share of such words that stand inside, so doubtful ones count little; tags: the score of its tags, below 0. Keys without a count have their priors' ones."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def learn(self, key: str, words_in: int, words_out: int, tags_in: int, tags_out: int) -> None:
        a, b = PRIOR[_prior(key)]
        self.words[key] = ((words_in + a) / (words_in + words_out + a + b)) ** 2
        self.tags[key] = min(MOST, max(LEAST, math.log((tags_in + a) / (tags_out + b)) if _prior(key) or tags_in + tags_out else UNSEEN))

    def of(self, key: str) -> tuple[float, float]:
        if key not in self.words:
            a, b = PRIOR[_prior(key)]
            return (a / (a + b)) ** 2, LEAST if _prior(key) else UNSEEN
        return self.words[key], self.tags[key]


def learn(pages: DataFrame) -> Weights:
    """Weights from all labelled pages; a name that hardly any of them has keeps its prior."""
    rows = pages.where(F.col("html").isNotNull()).select("html").mapInArrow(_count, COUNTED)
    sums = rows.groupBy("key").agg(*[F.sum(F.when(F.col("inside") == side, F.col(c))).alias(f"{c}_{name}") for c in ("words", "tags") for side, name in ((True, "in"), (False, "out"))], F.sum("pages").alias("pages"))
    sums = checkpoint(sums)  # one pass over the pages
    labelled = sums.where(F.col("key").isNull()).first()
    out = Weights()
    if labelled:
        for r in sums.where(F.col("key").isNotNull() & (F.col("pages") >= RARE * labelled["pages"])).collect():
            out.learn(r["key"], *[r[c] or 0 for c in ("words_in", "words_out", "tags_in", "tags_out")])
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The half-open range with the highest sum, the first of these; (0, 0) if no sum is over 0."""
    best = total = 0.0
    span, start = (0, 0), 0
    for i, x in enumerate(scores):
        total += x
        if total > best:
            best, span = total, (start, i + 1)
        if total <= 0:
            total, start = 0.0, i + 1
    return span


def extract(text: str, weights: Weights) -> str:
    """The blocks of the best region, one in a line.

    A word weighs as little as in any element around it. Elements whose words weigh little and whose sum is negative
    are left out, and only their own tags count in the scan, by half. The region is widened to the element that it lies in, and to those around
    that one as long as their sums do not fall; the body is none of them.
    """
    page = parse(text)
    n = len(page.tags)
    word, tagged, low, left_out = [1.0] * n, [0.0] * n, [0] * n, [0.0] * n
    for e in range(1, n):
        found = [weights.of(k) for k in page.keys[e]]
        own, tagged[e] = min(f[0] for f in found), min(f[1] for f in found)
        up = page.parents[e]
        word[e] = min(word[up], own)
        low[e] = low[up] or (e if own < LOW else 0)
    scores = [tagged[e] if is_tag else word[e] * len(t.split()) for e, is_tag, t in page.tokens]
    for (e, _, _), x in zip(page.tokens, scores, strict=True):
        left_out[low[e]] += x
    out = [low[e] > 0 and left_out[low[e]] < 0 for e in range(n)]
    scores = [x if not out[e] else x / 2 if is_tag and low[e] == e else 0.0 for (e, is_tag, _), x in zip(page.tokens, scores, strict=True)]
    start, stop = best_run(scores)
    if start == stop:
        return ""
    # widen it to elements
    first, last, sums = [len(scores)] * n, [0] * n, [0.0] * n
    for i, ((e, _, _), x) in enumerate(zip(page.tokens, scores, strict=True)):
        first[e], last[e] = min(first[e], i), i + 1
        sums[e] += 0.0 if out[e] else x
    for e in range(n - 1, 0, -1):
        up = page.parents[e]
        first[up], last[up] = min(first[up], first[e]), max(last[up], last[e])
        sums[up] += sums[e]
    above, e = {0}, page.tokens[start][0]
    while e:
        above.add(e)
        e = page.parents[e]
    e = page.tokens[stop - 1][0]
    while e not in above:
        e = page.parents[e]
    inner = e
    while page.tags[e] not in ("", "body", "html") and (e == inner or sums[e] >= sums[inner] - 2 * abs(tagged[e])):
        start, stop = min(start, first[e]), max(stop, last[e])
        inner, e = e, page.parents[e]
    blocks, block = [], []
    for e, is_tag, t in page.tokens[start:stop]:
        if not is_tag:
            if not out[e]:
                block.append(t)
        elif page.tags[e] not in INLINE:
            blocks.append(block)
            block = []
    lines = (" ".join(html.unescape("".join(b)).split()) for b in [*blocks, block])
    return "\n".join(x for x in lines if x)


def extract_pages(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    The whole html counts, however long; a null one is empty, and its text too. Where no page is labelled, the priors
    are the weights. Repeated rows and null ids stay rows; an empty table gives an empty result; other columns are not read.
    """
    weights = weights or learn(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, htmls in slices(batches, "html"):
            texts = [extract(x, weights) for x in htmls]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
