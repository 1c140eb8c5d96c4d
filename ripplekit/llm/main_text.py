"""The main text of web pages, chosen by ratios of their tag paths.

A page is read once, in order: tags open and close elements by the short rules of HTML
(void elements, paragraphs that end where a block begins, end tags without a start), and
text gathers into blocks, each with its path of block elements from root to leaf. Inline
elements neither end a block nor enter its path. The steps of a path carry their classes,
so that a column of comments has another path than an article.

All blocks of a path are judged together. A path's ratio is its length of text outside
links for each block, times one more than its punctuation for each block (the two ratios
fused); ratios are smoothed over neighbouring blocks of one container, and paths whose mean
smoothed ratio reaches the standard deviation of all blocks' values are content. A container
(an article, or else the nearest section) most of whose text lies on such paths is kept
with its headings, lists and short lines, but for blocks that are mostly links.
Menus, page headers and footers, sidebars, notices, adverts, forms and comments are left out
by element, role, class or id before anything is measured.

Defined results: a null or empty page has the empty text; text outside all elements is a
block like any other; character references are decoded as browsers do; a tag or
comment that never ends takes the rest of the page with it; a no-break space is white
space; every row gives one row, whatever repeats; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import html
import re
import statistics
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ripplekit.llm.common import map_rows

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>\x00]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = re.compile(r"[a-z]+|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…،。、，；：！？؟]")

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("head nav footer aside form button select option dialog menu svg math object audio video canvas".split())
CONTAINERS = frozenset("article main section div td th body center html".split())
# Elements that end an open one of the same set when they begin, unless one of the bounds lies between.
CLOSERS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
# Words of class, id or role that name what is not main text.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs captcha comment comments "
    "commentlist consent contentinfo cookie cookies copyright disqus footer footers gdpr header headers login masthead menu menus "
    "modal nav navbar navigation newsletter notice notices notification notifications pagination pager popup promo promos promotion "
    "related replies reply respond search share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe "
    "subscription toolbar topbar widget widgets".split()
)
ARTICLE_WORDS = frozenset("article articlebody story storybody main".split())
KERNEL = (0.25, 0.5, 0.25)
# Deeper elements become siblings, as in browsers, so that time and memory stay linear in the page.
DEEPEST = 400


@dataclass(slots=True)
class Element:
    name: str
    path: tuple[str, ...]
    dropped: bool = False
    article: bool = False
    link: bool = False
    inline: bool = False
    number: int = 0


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]
    container: int
    article: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _names(attributes: str) -> tuple[set[str], str]:
    """The words of class, id, role and itemprop; and the classes, for the path."""
    words, label = set(), []
    for name, *values in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop"):
            value = html.unescape(next(filter(None, values), ""))
            words.update(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
            if name == "class":
                label = sorted(value.split())
    return words, ".".join(label)


class Reader:
    """Blocks of one page; ``stack`` holds the open elements, outermost first."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack: list[Element] = [Element("html", ("html",))]
        self.open: Block | None = None
        self.count = 0

    def close_to(self, depth: int) -> None:
        if any(not e.inline for e in self.stack[depth:]):
            self.open = None
        del self.stack[depth:]

    def nearest(self, names, bounds=()) -> int | None:
        """Depth of the innermost open element of these names; none beyond a bound."""
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name in names:
                return depth
            if self.stack[depth].name in bounds:
                return None
        return None

    def start(self, name: str, attributes: str, closed: bool) -> None:
        inline = name in INLINE
        if not inline:
            self.open = None
            enders = CLOSERS.get(name)
            for names, bounds in ([enders] if enders else []) + [({"p"}, {"td", "th", "table", "button", "object"})]:
                depth = self.nearest(names, bounds)
                if depth is not None:
                    self.close_to(depth)
            if name in HEADINGS and self.stack[-1].name in HEADINGS:
                self.close_to(len(self.stack) - 1)
        if name in VOID:
            if name == "br" and self.open is not None:
                self.open.parts.append(" ")
            return
        if closed and name in ("svg", "path"):
            return
        if len(self.stack) >= DEEPEST:
            self.stack.pop()
        parent = self.stack[-1]
        words, label = _names(attributes) if "=" in attributes else (set(), "")
        article = parent.article or name in ("article", "main") or not ARTICLE_WORDS.isdisjoint(words)
        dropped = parent.dropped or name in DROPPED or (name == "header" and not parent.article)
        if name in ("html", "body", "article", "main"):
            dropped = parent.dropped or (name == "article" and not {"comment", "comments", "reply"}.isdisjoint(words))
        elif not inline and not dropped:
            found = words & ASIDE_WORDS
            dropped = bool(found - {"header"} if parent.article else found)
        self.count += 1
        path = parent.path if inline else (*parent.path, f"{name}.{label}" if label else name)
        self.stack.append(Element(name, path, dropped, article, parent.link or name == "a", inline, self.count))

    def end(self, name: str) -> None:
        if name in INLINE:
            for depth in range(len(self.stack) - 1, 0, -1):
                if not self.stack[depth].inline:
                    return
                if self.stack[depth].name == name:
                    del self.stack[depth]
                    return
        else:
            self.open = None
            depth = self.nearest({name} if name not in HEADINGS else HEADINGS)
            if depth is not None and name not in ("html", "body"):
                self.close_to(depth)

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.dropped:
            return
        text = html.unescape(raw)
        if self.open is None:
            if text.isspace():
                return
            outer = [e for e in self.stack if not e.inline]
            articles = [e for e in outer if e.name == "article"] or [e for e in outer if e.article]
            within = articles[0] if articles else next(e for e in reversed(outer) if e.name in CONTAINERS)
            self.open = Block(outer[-1].path, within.number, bool(articles))
            self.blocks.append(self.open)
        self.open.parts.append(text)
        if top.link:
            self.open.linked += len("".join(text.split()))


def read_blocks(page: str) -> list[Block]:
    reader, at, size = Reader(), 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            reader.text(page[at:])
            break
        after = page[mark + 1 : mark + 2]
        if not (after.isascii() and after.isalpha() or after in ("/", "!", "?")) or not after:
            follow = page.find("<", mark + 1)
            follow = size if follow < 0 else follow
            reader.text(page[at:follow])
            at = follow
            continue
        if mark > at:
            reader.text(page[at:mark])
        if page.startswith("<!--", mark):
            stop = page.find("-->", mark + 2)
            at = size if stop < 0 else stop + 3
            continue
        tag = TAG.match(page, mark)
        if tag is None:
            second = page[mark + 2 : mark + 3]
            if after in ("!", "?") or (after == "/" and not (second.isascii() and second.isalpha())):
                stop = page.find(">", mark + 1)  # a declaration or a broken end tag
                at = size if stop < 0 else stop + 1
                continue
            break  # a tag without an end
        at = tag.end()
        slash, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        if slash:
            if name == "p" and reader.nearest({"p"}) is None:
                reader.open = None
            else:
                reader.end(name)
        elif name in RAW:
            if name not in INLINE and name not in ("script", "style", "noscript"):
                reader.open = None
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if stop is None:
                break
            close = page.find(">", stop.end())
            at = size if close < 0 else close + 1
        else:
            reader.start(name, attributes, attributes.endswith("/"))
    for block in reader.blocks:
        block.text = " ".join("".join(block.parts).split())
    return [b for b in reader.blocks if b.text]


def path_ratios(blocks: list[Block]) -> dict[tuple[str, ...], float]:
    """Text outside links a block, times one more than punctuation a block."""
    sums: dict[tuple[str, ...], list[int]] = {}
    for block in blocks:
        found = sums.setdefault(block.path, [0, 0, 0])
        found[0] += 1
        found[1] += max(0, len(block.text) - block.linked)
        found[2] += len(PUNCTUATION.findall(block.text))
    return {path: length / n * (1 + signs / n) for path, (n, length, signs) in sums.items()}


def smoothed(blocks: list[Block], ratios: dict[tuple[str, ...], float]) -> list[float]:
    """Each block's ratio, averaged with those of the blocks before and after it in its container."""
    values = [ratios[b.path] for b in blocks]
    out = []
    for i, block in enumerate(blocks):
        near = [
            (w, values[j])
            for w, j in zip(KERNEL, (i - 1, i, i + 1))
            if 0 <= j < len(blocks) and blocks[j].container == block.container
        ]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def content_paths(blocks: list[Block]) -> set[tuple[str, ...]]:
    values = smoothed(blocks, path_ratios(blocks))
    bound = statistics.pstdev(values)
    by: dict[tuple[str, ...], list[float]] = {}
    for block, value in zip(blocks, values):
        by.setdefault(block.path, []).append(value)
    return {path for path, found in by.items() if statistics.fmean(found) >= bound}


def main_text(page: str | None) -> str:
    blocks = read_blocks(page) if page else []
    if not blocks:
        return ""
    good = content_paths(blocks)
    shares: dict[int, list[int]] = {}
    for block in blocks:
        share = shares.setdefault(block.container, [0, 0])
        share[0] += len(block.text) * (block.path in good)
        share[1] += len(block.text)
    articles = {b.container for b in blocks if b.article and 2 * shares[b.container][0] >= shares[b.container][1]}

    def kept(block: Block) -> bool:
        if articles:  # what the page itself marks as its article
            return block.container in articles
        if 2 * block.linked > len(block.text):
            return False
        inside, total = shares[block.container]
        return block.path in good or 2 * inside >= total

    return "\n".join([b.text for b in blocks if kept(b)])


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars): the main text of each page, empty if there is none, and its code points."""

    def start():
        def work(row_key, row_url, row_page):
            text = main_text(row_page)
            yield row_key, row_url, text, len(text)

        return work

    kind = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}
    ddl = f"`{key}` {kind[key]}, `{url}` {kind[url]}, text string, n_chars bigint"
    return map_rows(pages.select(key, url, page), start, ddl)
