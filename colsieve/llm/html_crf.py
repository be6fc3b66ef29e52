"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into blocks of text at block-level tags. Features are the tags, classes and ids of a
block's ancestors and the shape of its text. The field is trained on labelled pages: a bounded
sample of the given pages, whose semantic tags label their blocks, and the same texts laid out
anew under other tags and class names with notices, sidebars, comments and forms added, so that it
doesn't hang on one layout. Viterbi decoding labels every block of every page.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.llm.labelled import fraction
from colsieve.llm.store import small_batches

TRAINING_PAGES = 200
TRAINING_CHARS = 200_000  # longer pages aren't trained on
LAYOUTS = 3  # new layouts of every training page
EPOCHS = 6
RATE, DECAY = 0.3, 1e-5

# fixed values: elements of HTML by their kind
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template textarea svg math iframe object canvas audio video".split())
_SELF_CLOSING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"},
                 "option": {"select"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<hidden>script|style|noscript|template|textarea|svg|math|iframe|object|canvas|audio|video)\b[^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_NAMES = re.compile(r"[a-z]+")
MARK = 64  # every so many open elements, what lies around one is kept


# fixed values: what layouts in use call their parts
CONTENT_NAMES = ("article", "post", "entry", "content", "post-content", "article-body", "story", "main", "text", "page-content")
OTHER_NAMES = {
    "menu": ("nav", "menu", "navbar", "breadcrumb", "pagination", "toc", "tabs"),
    "header": ("header", "masthead", "topbar", "branding", "site-header"),
    "footer": ("footer", "site-footer", "copyright", "legal", "colophon"),
    "sidebar": ("sidebar", "widget", "related", "recommended", "trending", "rail"),
    "notice": ("cookie", "notice", "banner", "alert", "consent", "popup", "modal"),
    "advert": ("ad", "ads", "advert", "sponsored", "promo", "advertisement"),
    "form": ("form", "newsletter", "subscribe", "search", "login", "signup"),
    "comments": ("comments", "comment-list", "comment", "discussion", "replies", "disqus"),
    "share": ("share", "social", "tags", "author-bio", "meta"),
}
OTHER_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "div", "advert": "div",
              "form": "form", "comments": "section", "share": "ul"}
_OUTSIDE = frozenset("nav header footer aside form head title menu button select dialog".split())
#: Always set apart, even around an article; headers and forms may hold a whole page.
_APART = frozenset("nav footer aside head title menu button select dialog".split())
COMMENT_NAMES = frozenset(OTHER_NAMES["comments"])
APART_NAMES = frozenset(name for kind in ("menu", "sidebar", "advert", "comments") for name in OTHER_NAMES[kind])


#: Where a block lies by all open elements: in no article, in one, or in something set apart.
OUTSIDE, INSIDE, IN_ARTICLE, APART = range(4)


def zone_of(zone: int, tag: str, names: frozenset[str] = frozenset()) -> int:
    """The zone inside an element of the zone around it.

    An article may lie in ``main``, but one in another article is a comment or a card. Menus,
    footers and sidebars are set apart, with all that is in them, and so is what bears their names in
    an article or ``main``; outside, such names may stand on a frame around the whole page.
    """
    if zone == APART or tag in _APART or names & (APART_NAMES if zone else COMMENT_NAMES):
        return APART
    if tag == "article":
        return APART if zone == IN_ARTICLE else IN_ARTICLE
    if tag == "main":
        return max(zone, INSIDE)
    return APART if zone and tag in _OUTSIDE else zone


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # distinct tags around it, by their innermost element
    names: frozenset[str]
    label: int | None
    links: int  # characters inside links
    path: int  # changes when the parent does
    zone: int = OUTSIDE  # by the tags around it
    named: int = OUTSIDE  # by their tags and names


@dataclass
class _Open:
    tag: str
    names: frozenset[str] = frozenset()
    label: int | None = None  # its own or that of the next labelled one around it
    around: tuple[tuple[str, ...], frozenset[str]] | None = None
    zone: int = OUTSIDE
    named: int = OUTSIDE


@dataclass
class _Page:
    """State of the cut: open elements and the text since the last block border.

    Elements are looked up by tag and a block starts from the nearest mark, so both cost the same at
    any depth.
    """

    stack: list[_Open] = field(default_factory=list)
    places: defaultdict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    pieces: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    links: int = 0
    path: int = 0

    def flush(self) -> None:
        if not self.pieces:
            return
        text = _SPACE.sub(" ", "".join(self.pieces)).strip(" ")
        if text:
            top = self.stack[-1] if self.stack else _Open("")
            self.blocks.append(Block(text, *self.around(), top.label, self.links, self.path, top.zone, top.named))
        self.pieces, self.links = [], 0

    def around(self) -> tuple[tuple[str, ...], frozenset[str]]:
        """Tags and names of all open elements."""
        first = len(self.stack)
        while first and self.stack[first - 1].around is None:
            first -= 1
        known, named = self.stack[first - 1].around if first else ((), frozenset())
        tags, names = dict.fromkeys(known), set(named)
        for k in range(first, len(self.stack)):
            element = self.stack[k]
            tags.pop(element.tag, None)
            tags[element.tag] = None
            names |= element.names
            if k % MARK == 0:
                element.around = tuple(tags), frozenset(names)
        return tuple(tags), frozenset(names)

    def open(self, tag: str, names: frozenset[str], label: int | None) -> None:
        if label is None and self.stack:
            label = self.stack[-1].label
        self.places[tag].append(len(self.stack))
        over = self.stack[-1] if self.stack else _Open("")
        self.stack.append(_Open(tag, names, label, None, zone_of(over.zone, tag), zone_of(over.named, tag, names)))

    def last(self, tag: str) -> int:
        return self.places[tag][-1] if self.places.get(tag) else -1

    def close(self, tag: str, within: set[str] | None = None) -> None:
        k = self.last(tag)
        if k < 0 or (within and max(map(self.last, within)) > k):
            return
        for element in self.stack[k:]:
            self.places[element.tag].pop()
        del self.stack[k:]
        self.path += 1


def _attributes(text: str) -> tuple[frozenset[str], int | None]:
    names, label = set(), None
    for key, a, b, c in _ATTRIBUTE.findall(text):
        if key.lower() == "data-main":
            label = int((a or b or c) == "1")
        else:
            names.update(_NAMES.findall((a or b or c).lower()))
    return frozenset(names), label


def blocks_of(source: str) -> list[Block]:
    """Leaf blocks in page order. Unclosed, misnested and cut-off markup is taken as it comes."""
    page, at = _Page(), 0
    while at < len(source):
        found = _TOKEN.match(source, at)
        at = found.end()
        text = found["text"]
        if text is not None:
            page.pieces.append(html.unescape(text))
            if page.places.get("a"):
                page.links += len(text)
            continue
        hidden = found["hidden"]
        if hidden:
            # a slash ends drawings and formulas only
            if not (found[0].endswith("/>") and hidden.lower() in ("svg", "math")):
                ending = re.compile(rf"</{hidden}\b[^>]*>|\Z", re.I).search(source, at)
                at = ending.end()
            continue
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            if tag in BLOCKS:
                page.flush()
            page.close(tag)
            continue
        if tag == "br":
            page.pieces.append("\n")
        if tag in BLOCKS:
            page.flush()
            page.close("p", {"article", "aside", "body", "button", "div", "footer", "header", "main", "nav", "section", "td"})
            if tag in _SELF_CLOSING:
                page.close(tag, _SELF_CLOSING[tag])
            page.path += 1
        if tag not in VOID:
            attributes = found["attributes"] or found["attributes2"] or ""
            names, label = _attributes(attributes) if "=" in attributes else (frozenset(), None)
            page.open(tag, names, label)
    page.flush()
    return page.blocks


def _bucket(value: float, edges: tuple) -> int:
    return sum(value >= e for e in edges)


def features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for k, block in enumerate(blocks):
        text, words = block.text, block.text.count(" ") + 1
        outer = [t for t in block.tags if t in BLOCKS]
        length = f"len{_bucket(words, (2, 4, 8, 15, 30, 60, 120))}"
        link = f"link{_bucket(block.links / len(text), (0.1, 0.5, 0.9))}"
        stops = f"stop{_bucket(sum(text.count(c) for c in '.!?') / words, (0.01, 0.05, 0.15, 0.4))}"
        own = [
            "one", length, link, stops, f"parent={outer[-1] if outer else ''}",
            f"place{_bucket(k / len(blocks), (0.1, 0.25, 0.75, 0.9))}", f"{length}{link}",
            f"digits{_bucket(sum(map(str.isdigit, text)) / len(text), (0.02, 0.1, 0.3))}",
            "sentence" if text[-1] in ".!?:\"'”»)" else "open", "upper" if text[0].isupper() else "lower",
        ]
        if "©" in text or "®" in text:
            own.append("mark")
        if "|" in text or "·" in text or "»" in text:
            own.append("bar")
        if block.zone == APART:
            own.append("apart")
        own += [f"in={t}" for t in set(block.tags)]
        own += [f"name={n}" for n in block.names]
        out.append(own)
    return out


class Field:
    """Weights for content against the rest; transitions depend on whether the parent changes."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.steps = [[[0.0, 0.0], [0.0, 0.0]] for _ in range(2)]  # [other parent][from][to]

    def emissions(self, rows: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in row) for row in rows]

    def decode(self, blocks: list[Block]) -> list[int]:
        """Viterbi path: 1 for content."""
        if not blocks:
            return []
        emit = self.emissions(features(blocks))
        score, back = [0.0, emit[0]], []
        for k in range(1, len(emit)):
            step = self.steps[blocks[k].path != blocks[k - 1].path]
            origin = [int(score[1] + step[1][y] > score[0] + step[0][y]) for y in (0, 1)]
            score = [score[origin[0]] + step[origin[0]][0], score[origin[1]] + step[origin[1]][1] + emit[k]]
            back.append(origin)
        path = [int(score[1] > score[0])]
        for origin in reversed(back):
            path.append(origin[path[-1]])
        return path[::-1]

    def text(self, source: str) -> str:
        blocks = blocks_of(source)
        return " ".join(b.text for b, y in zip(blocks, self.decode(blocks), strict=True) if y)


def _more(a: float, b: float) -> float:
    top = max(a, b)
    return top + math.log(math.exp(a - top) + math.exp(b - top))


def train(pages: list[list[Block]]) -> Field:
    """Maximum likelihood by AdaGrad on forward-backward gradients; every block has a label."""
    model, squares = Field(), defaultdict(lambda: 1e-8)
    prepared = [(features(b), b) for b in pages if b]
    order, shuffle = list(range(len(prepared))), random.Random(23)

    def update(key, gradient: float, value: float) -> float:
        squares[key] += gradient * gradient
        return value - RATE / math.sqrt(squares[key]) * (gradient + DECAY * value)

    for _ in range(EPOCHS):
        shuffle.shuffle(order)
        for at in order:
            rows, blocks = prepared[at]
            emit, count = model.emissions(rows), len(rows)
            kinds = [int(blocks[k].path != blocks[k - 1].path) for k in range(count)]
            ahead = [[0.0, emit[0]]]
            for k in range(1, count):
                s, prior = model.steps[kinds[k]], ahead[-1]
                ahead.append([_more(prior[0] + s[0][y], prior[1] + s[1][y]) + y * emit[k] for y in (0, 1)])
            behind = [[0.0, 0.0] for _ in rows]
            for k in range(count - 2, -1, -1):
                s, after = model.steps[kinds[k + 1]], behind[k + 1]
                behind[k] = [_more(s[y][0] + after[0], s[y][1] + emit[k + 1] + after[1]) for y in (0, 1)]
            whole = _more(*ahead[-1])
            steps = defaultdict(float)
            for k in range(count):
                p = math.exp(min(ahead[k][1] + behind[k][1] - whole, 0.0))
                gradient = p - blocks[k].label
                if k:
                    s = model.steps[kinds[k]]
                    for a in (0, 1):
                        for b in (0, 1):
                            joint = ahead[k - 1][a] + s[a][b] + b * emit[k] + behind[k][b] - whole
                            steps[kinds[k], a, b] += math.exp(min(joint, 0.0)) - (blocks[k - 1].label == a and blocks[k].label == b)
                if abs(gradient) > 1e-4:
                    for f in rows[k]:
                        model.weights[f] = update(f, gradient, model.weights.get(f, 0.0))
            for (kind, a, b), gradient in steps.items():
                model.steps[kind][a][b] = update((kind, a, b), gradient, model.steps[kind][a][b])
    return model


def by_semantic_tags(blocks: list[Block]) -> list[int]:
    """Label 1 inside article or main, but not in what is set apart there, by tag or by name."""
    return [int(block.named in (INSIDE, IN_ARTICLE)) for block in blocks]


def _laid_out(content: list[str], other: list[str], draw: random.Random) -> str:
    """The texts under tags and names drawn anew, with ``data-main`` as the label."""

    def text() -> str:
        return html.escape(draw.choice(other) if other and draw.random() < 0.6 else draw.choice(content))

    def part(kind: str) -> str:
        tag = OTHER_TAGS[kind] if draw.random() < 0.5 else draw.choice(("div", "section"))
        name = draw.choice(OTHER_NAMES[kind])
        given = f' {draw.choice(("class", "id"))}="{name}"' if tag in ("div", "section") or draw.random() < 0.5 else ""
        if kind in ("menu", "share") or (kind in ("footer", "sidebar") and draw.random() < 0.4):
            words = [w for w in text().split() if "&" not in w][: draw.randint(2, 8)] or ["x"]
            body = "<ul>" + "".join(f'<li><a href="/{k}">{w}</a></li>' for k, w in enumerate(words)) + "</ul>"
        else:
            cards = kind in ("comments", "sidebar") and draw.random() < 0.5
            wrap = "article" if cards else draw.choice(("p", "div", "span", "li", "h3"))
            body = "".join(f"<{wrap}>{text()}</{wrap}>" for _ in range(draw.randint(1, 4)))
        return f'<{tag}{given} data-main="0">{body}</{tag}>'

    kind = draw.choice(("article", "main", "div", "div", "section"))
    named = f' {draw.choice(("class", "id"))}="{draw.choice(CONTENT_NAMES)}"' if kind in ("div", "section") or draw.random() < 0.3 else ""
    head, *rest = [html.escape(t) for t in content]
    inner = [f"<{draw.choice(('h1', 'h2', 'p'))}>{head}</p>"]
    for t in rest:
        inner.append(f"<{draw.choice(('p', 'p', 'p', 'p', 'li', 'blockquote', 'h2'))}>{t}")
        if draw.random() < 0.06:
            inner.append(part(draw.choice(("advert", "share", "sidebar"))))
    inner += [part(k) for k in ("comments", "sidebar") if draw.random() < 0.3]
    before = [part(k) for k in ("notice", "header", "menu", "advert") if draw.random() < 0.6]
    after = [part(k) for k in ("share", "comments", "sidebar", "form", "advert", "footer") if draw.random() < 0.6]
    return (f'<html><head><title data-main="0">{head}</title></head><body data-main="0">{"".join(before)}'
            f'<{kind}{named} data-main="1">{"".join(inner)}</{kind}>{"".join(after)}</body></html>')


def training_pages(sources: list[str], layouts: int = LAYOUTS) -> list[list[Block]]:
    """Labelled blocks of the given pages and of their new layouts."""
    out, draw = [], random.Random(41)
    for source in sources:
        blocks = blocks_of(source)
        labels = by_semantic_tags(blocks)
        if any(labels):
            for block, label in zip(blocks, labels, strict=True):
                block.label = label
            out.append(blocks)
        else:  # a page without such tags: its long texts serve as content of new layouts
            labels = [int(b.text.count(" ") >= 20) for b in blocks]
        content = [b.text for b, y in zip(blocks, labels, strict=True) if y]
        other = [b.text for b, y in zip(blocks, labels, strict=True) if not y]
        if content:
            out += [[b for b in blocks_of(_laid_out(content, other, draw)) if b.label is not None] for _ in range(layouts)]
    return out


def fit(pages: DataFrame) -> Field:
    """Train on a sample of about ``TRAINING_PAGES`` pages."""
    usable = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).filter(
        (F.length("html") > 0) & (F.length("html") <= TRAINING_CHARS) & F.col("page_id").isNotNull())
    share = TRAINING_PAGES / max(usable.count(), 1)
    rows = usable.filter(fraction(F.col("page_id")) < share).limit(4 * TRAINING_PAGES).collect()
    return train(training_pages([r.html for r in sorted(rows)]))


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages(page_id, url, html)``.

    Null, empty and text-free html gives an empty text. Other columns are ignored; ids aren't used.
    """
    small_batches(pages.sparkSession)
    field_ = model or fit(pages)

    def texts(sources: pa.Array) -> pa.Array:
        return pa.array([field_.text(s) for s in sources.to_pylist()], pa.string())

    found = F.arrow_udf(texts, "string")(F.coalesce(F.col("html").cast("string"), F.lit("")))
    return pages.select("page_id", "url", found.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
