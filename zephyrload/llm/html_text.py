"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by where they stand (the nearest
block element, its class, inside a link or not), tags score negative by their name.
The weights are log odds from labelled pages, pages whose markup names its main part
(article or main). One linear scan finds the contiguous region of the largest sum.
Elements that are named as menus, notices, adverts, forms or comments are left out:
they score nothing, so one inside an article does not part it, and give no text. That
holds for parts of a page, not for what is wrapped around its text:

- an article or main part that opens ends it for the elements around;
- a form with fewer than one field in ``WORDS_A_FIELD`` words of running text is a frame;
- a name like ``has-sidebar`` or ``search-page`` says what a page has or is, and leaves nothing out;
- where the words in one left out element score more than the best region without it, it
  and those around it are taken for wrappers. Such words score no more than the log odds of their
  elements' names being wrapped around the main part of labelled pages, where the names are known.

What remains of the region is decoded and joined block by block. All passes are linear in the page,
however deep its elements are nested.

Bounds: weights are learned from at most ``MOST_PAGES`` labelled pages.

Defined cases: NULL or empty html, and pages whose best sum is not positive, give an
empty text; unclosed and truncated markup ends with the page; without labelled pages
words score 1 and tags -3; of regions of equal sum the first is taken; repeated rows are
treated alike; very long pages are read whole; an output name that is taken gets an underscore.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import as_bytes, bound_batches, bounded_sample, map_texts

MOST_PAGES = 2000
#: Places seen fewer times than this in the labelled pages get the default weight.
MIN_SEEN = 5
#: A form of at least this many words for each of its fields is a frame around text.
WORDS_A_FIELD = 25

# Element names by their role in HTML, and words in class, id and role
# names that mark a part as no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|svg|textarea|select|object|canvas|title"
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset("head nav header footer aside form button menu dialog fieldset label".split())
#: Of these, those that hold teasers, which are articles too, once the main part has given words.
TEASERS = frozenset("nav footer aside".split())
MARKS = frozenset(
    "ad ads adsense alert advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments "
    "complementary consent contentinfo cookie cookies disqus footer form header login masthead menu menubar modal "
    "nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related search "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

#: Before a mark: the page has, or has not, such a part. At the end of a name: it is a page or article of a kind.
HAS = frozenset("has have hide hides no show shows with without".split())
WHOLE = frozenset("article layout page post site story template".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def _marks(rest: str) -> tuple[str, str]:
    """First class word of a tag, and the mark by which its names leave it out, if any."""
    names = [a or b or c for a, b, c in _MARKED.findall(rest)] if "=" in rest else []
    first, mark = "", ""
    for name in (n for group in names for n in group.lower().split()):
        words = [w for w in _PARTS.split(name) if w]
        first = first or (words[0] if words else "")
        if not mark and words and words[-1] not in WHOLE:
            had = zip(words, ["", *words], strict=False)
            mark = next((w for w, before in had if w in MARKS and before not in HAS), "")
    return first, mark


class Page:
    """Words and tags of a page in order, each with the place it stands in.

    What a token stands in is kept as a number: left out elements form a tree, and a
    token has the number of its innermost one, 0 for none.
    """

    def __init__(self, source: str):
        #: (place, text or None for a tag, breaks a block, innermost left out node, inside article or main)
        self.tokens: list[tuple[str, str | None, bool, int, bool]] = []
        #: name and class word of open elements
        self.stack: list[tuple[str, str]] = []
        self.open: Counter = Counter()
        self.blocks: list[tuple[str, str]] = []
        #: open left out elements: depth, element, node, whether an article inside leaves it so
        self.fresh: list[tuple[int, int, int, bool]] = []
        self.kept: list[tuple[int, int, int, bool]] = []
        self.forms: list[tuple[int, int]] = []
        #: by node: the node around and the element; by element: what leaves it out, words, fields, wraps the main part
        self.around, self.element = [0], [0]
        self.mark, self.words, self.fields, self.wraps = [""], [0], [0], [False]
        self.labelled = self.given = False
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if name := m["name"]:
                self._tag(name.lower(), bool(m["close"]), m["rest"])
            elif m["raw"]:
                if m["raw"].lower() in ("select", "textarea"):
                    self._field()
                self._add(f"<{m['raw'].lower()}", None, True)
        if at < len(source):
            self._text(source[at:])

    def _node(self) -> int:
        return (self.fresh or self.kept or [(0, 0, 0, False)])[-1][2]

    def _inside(self) -> bool:
        return self.open["article"] + self.open["main"] > 0

    def _add(self, place: str, text: str | None, breaks: bool) -> None:
        node, inside = self._node(), self._inside()
        if inside and not node and text and not text.isspace():
            self.given = True
        self.tokens.append((place, text, breaks, node, inside))

    def _text(self, text: str) -> None:
        name, word = self.blocks[-1] if self.blocks else ("", "")
        link = "/a" if self.open["a"] else ""
        self.words[self.element[self._node()]] += len(text.split())
        self._add(f"{name}.{word}{link}", text, False)

    def _field(self) -> None:
        if self.forms:
            self.fields[self.forms[-1][1]] += 1

    def _pop(self) -> None:
        name, _ = self.stack.pop()
        self.open[name] -= 1
        if name in BLOCKS:
            self.blocks.pop()
        for ends in (self.fresh, self.kept, self.forms):
            if ends and ends[-1][0] == len(self.stack):
                ends.pop()

    def _leave_out(self, element: int) -> int:
        self.around.append(self._node())
        self.element.append(element)
        return len(self.element) - 1

    def _main_opens(self) -> None:
        """A wrapper of the article is none of its parts; menus that hold teasers stay left out."""
        self.labelled = True
        opened, self.fresh = self.fresh, []
        for depth, element, _, stays in opened:
            if stays:
                self.kept.append((depth, element, self._leave_out(element), stays))
            else:
                self.wraps[element] = True

    def _tag(self, name: str, close: bool, rest: str) -> None:
        if close:
            self._add(f"</{name}", None, name in BLOCKS)
            if self.open[name]:
                while self.stack[-1][0] != name:
                    self._pop()
                self._pop()
            return
        word, mark = _marks(rest)
        if name in BLOCKS:
            # a new block ends open inline elements and an open paragraph; a line break does not
            while name != "br" and self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] not in BLOCKS):
                self._pop()
        if name in ("article", "main"):
            self._main_opens()
            mark = ""
        if name == "button" or (name == "input" and "hidden" not in rest.lower()):
            self._field()
        if name not in VOID and not rest.endswith("/") and name not in ("html", "body"):
            depth = len(self.stack)
            if mark or name in LEFT_OUT:
                self.mark.append(mark or f"<{name}")
                self.words.append(0)
                self.fields.append(0)
                self.wraps.append(False)
                element = len(self.mark) - 1
                self.fresh.append((depth, element, self._leave_out(element), name in TEASERS and self.given))
                if name == "form":
                    self.forms.append((depth, element))
            self.stack.append((name, word))
            self.open[name] += 1
            if name in BLOCKS:
                self.blocks.append((name, word))
        self._add(f"<{name}.{word}", None, name in BLOCKS)

    def is_frame(self, element: int) -> bool:
        """An element left out as a form alone, with much text for its fields."""
        return self.mark[element] == "<form" and self.words[element] >= WORDS_A_FIELD * self.fields[element]

    def left_out(self) -> list[bool]:
        """By node, whether it or one around it is left out."""
        out = [False]
        for around, element in zip(self.around[1:], self.element[1:], strict=True):
            out.append(out[around] or not self.is_frame(element))
        return out


def count_places(source: str | None) -> Counter:
    """Of a labelled page: how often each place, and each mark, occurs in or around its main part and elsewhere."""
    page, seen = Page(source or ""), Counter()
    if page.labelled:
        out = page.left_out()
        for place, text, _, node, inside in page.tokens:
            if not out[node]:
                seen[place, inside] += 1 if text is None else len(text.split())
        for mark, wraps in zip(page.mark[1:], page.wraps[1:], strict=True):
            seen[f"@{mark}", wraps] += 1
    return seen


def learn(seen: Counter) -> dict[str, float]:
    """Log odds of the main part by place; tags are held below zero."""
    weights = {}
    for place in {place for place, _ in seen}:
        inside, outside = seen[place, True], seen[place, False]
        if inside + outside >= MIN_SEEN:
            odds = max(-6.0, min(6.0, math.log((inside + 0.5) / (outside + 0.5))))
            weights[place] = min(odds, 0.0) - 0.25 if place.startswith("<") else odds
    return weights


def _best(scores: list[float], out: list[bool], nodes: list[int]) -> tuple[float, slice]:
    """Largest sum of a contiguous region, where tokens of left out nodes score nothing, and the region."""
    best, span, total, start = 0.0, slice(0, 0), 0.0, 0
    for k, node in enumerate(nodes):
        if total <= 0:
            total, start = 0.0, k
        if not out[node]:
            total += scores[k]
            if total > best:
                best, span = total, slice(start, k + 1)
    return best, span


def main_text(source: str | None, weights: dict[str, float]) -> str:
    """The decoded text of the best region, blocks joined by one space."""
    page = Page(source or "")
    tokens, scores = page.tokens, []
    for place, text, _, _, _ in tokens:
        if text is None:
            scores.append(weights.get(place, -0.5 if weights else -3.0))
        else:
            scores.append(len(text.split()) * weights.get(place, 1.0))
    nodes = [t[3] for t in tokens]
    out = page.left_out()
    best, span = _best(scores, out, nodes)
    wrapper = _wrapper(page, scores, out, weights, best)
    if wrapper:
        around = {0}
        while wrapper:
            around.add(wrapper)
            wrapper = page.around[wrapper]
        frames = [page.is_frame(e) for e in page.element]
        out = [False]
        for node in range(1, len(page.element)):
            out.append(out[page.around[node]] or not (node in around or frames[node]))
        best, span = _best(scores, out, nodes)
    parts = []
    for _, text, breaks, node, _ in tokens[span]:
        if text is not None:
            parts.append("" if out[node] else html.unescape(text))
        elif breaks:
            parts.append(" ")
    return " ".join("".join(parts).split())


def _wrapper(page: Page, scores: list[float], out: list[bool], weights: dict[str, float], least: float) -> int:
    """The left out node whose own words score most, if above ``least``; in labelled pages only inside the main part."""
    odds = [math.inf]
    for node in range(1, len(out)):
        element = page.element[node]
        own = math.inf if page.is_frame(element) else weights.get(f"@{page.mark[element]}", math.inf)
        odds.append(min(odds[page.around[node]], own))
    held, most = [0.0] * len(out), [0.0] * len(out)
    for (_, text, _, node, inside), score in zip(page.tokens, scores, strict=True):
        if out[node] and (inside or not page.labelled):
            if text and odds[node] < math.inf:
                score = min(score, len(text.split()) * odds[node])
            held[node] = max(held[node], 0.0) + score
            most[node] = max(most[node], held[node])
    wrapper = max(range(len(out)), key=most.__getitem__)
    return wrapper if most[wrapper] > least else 0


def train(pages: DataFrame, source: str = "html", page_id: str = "page_id", most: int = MOST_PAGES) -> dict[str, float]:
    """Weights from a bounded sample of the pages whose markup names a main part."""
    bound_batches(pages.sparkSession)
    named = pages.select(F.col(page_id).alias("page_id"), as_bytes(source).alias("html")).where(
        F.lower(F.col("html").cast("string")).rlike(r"<(article|main)[\s>]")
    )
    sample = bounded_sample(named.withColumn("one", F.lit(1)), "one", most, ["page_id"])

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for data in batch["html"]:
                total.update(count_places(data.decode()))
        yield pd.DataFrame(
            [(p, s, n) for (p, s), n in total.items()], columns=["place", "inside", "n"]
        ).astype({"place": "object", "inside": "bool", "n": "int64"})

    counted = sample.select("html").mapInPandas(count, "place string, inside boolean, n long")
    rows = counted.groupBy("place", "inside").agg(F.sum("n").alias("n")).collect()
    return learn(Counter({(r.place, r.inside): r.n for r in rows}))


def extract(
    pages: DataFrame, weights: dict[str, float], source: str = "html", keep: list[str] | None = None, name: str = "main_text"
) -> DataFrame:
    """Columns ``keep`` and the main text of every whole page."""
    keep = pages.columns if keep is None else keep

    def factory():
        return lambda texts: [[main_text(t.decode() if t else None, weights) for t in texts]]

    return map_texts(pages, source, keep, [T.StructField(name, T.StringType())], factory)
