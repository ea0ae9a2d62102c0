"""Main text of web pages by consensus paths of each host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, cut, ship, small

# The vote climbs from the deepest container with this share of the content.
HOLDS = 0.6
# A host's path wins with this share of the votes: at most 10 paths a host.
WINS = 0.1

# HTML element names by their role.
RAW = frozenset("script style noscript textarea title iframe".split())
SKIPPED = frozenset("template svg select button object canvas audio video annotation annotation-xml".split())
CONTAINER = frozenset("div section article main aside nav header footer form ul ol dl table tbody thead tfoot tr td th "
                      "blockquote figure fieldset details center menu dialog address".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr figcaption caption summary legend option".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
OUT = frozenset("nav aside footer form menu dialog header".split())
# Words of class, id and role that mark what is not the article.
OUT_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside complementary "
                      "contentinfo ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent gdpr "
                      "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
                      "related recommended comment comments commentlist disqus replies reply respond widget toolbar pagination".split())
_ARTICLE = re.compile(r"(article|main)(?![^.#])")
# A class that begins like this names a state or topic; an id of other words
# than these and OUT_WORDS names its part of the text.
TOPIC = frozenset("has with without no not is tag category cat topic term type format template layout".split())
PLAIN = frozenset("post posts page site main content area section wrapper wrap container box inner outer left right top bottom primary "
                  "secondary global bar list link links form block item items panel button buttons slot sticky js row col".split())
# A marked part with this share of the content is no mere part.
WHOLE = 0.9
# Plain text beside the article belongs to it from so many words; tables,
# lists and quotes, headings and paragraphs do whatever their length.
SAID_WORDS = 8
# Elements whose rest of the page is no text if they stay open.
CODE = frozenset("script style".split())
_LISTED = frozenset("ul ol dl table tbody thead tfoot tr td th blockquote figure".split())
_JUDGED = re.compile(r"class|hidden|style|aria-|role", re.I)
_HEAD = frozenset({"header", "masthead"})

_TAG = re.compile(r"""<(?:!--(?:.*?--!?>|.*\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|[!?/][^>]*>)""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(source)} if source.strip(" /\n\t") else {}


def _marks(attrs: dict[str, str], in_article: bool) -> set[str]:
    """The OUT_WORDS that class, id and role say."""
    split = lambda t: [w.lower() for w in _WORDS.findall(t)]
    words = {w for c in attrs.get("class", "").split() if (ws := split(c)) and ws[0] not in TOPIC for w in ws}
    own = set(split(attrs.get("id", "")))
    words |= own if own <= OUT_WORDS | PLAIN else set()
    words = (words | set(split(attrs.get("role", "")))) & OUT_WORDS
    return words - _HEAD if in_article else words


def _is_out(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """2: no article by its tag or hidden; 1: marked as none, which Page weighs
    against the content; 0: neither."""
    if tag in OUT and tag != "form" and not (tag == "header" and in_article):
        return 2
    if tag != "main" and attrs and ("hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", ""))):
        return 2
    if tag in ("article", "main") or tag in PROSE and tag != "p":
        return 0
    return int(tag == "form" or bool(attrs) and bool(_marks(attrs, in_article)))


def _skipped_to(html: str, tag: str, at: int) -> int:
    """The end of the element to skip that opened before ``at``; ``at`` if it
    isn't closed before it opens again or a container around it closes."""
    m = re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
    if not m or not m[1]:
        return at
    depth = 0
    for t in _TAG.finditer(html, at, m.start()):
        if t[2] and t[2].lower() in CONTAINER:
            depth += -1 if t[1] else 1
            if depth < 0:
                return at
    return m.end()


def _inline_out(source: str) -> bool:
    """Whether an inline element is hidden, or marked by nothing but words of
    what is not the article."""
    attrs = _attributes(source)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
        return True
    words = {w.lower() for w in _WORDS.findall(attrs.get("class", "") + " " + attrs.get("role", ""))}
    return bool(words & OUT_WORDS - _HEAD) and words <= OUT_WORDS | PLAIN


def _inline_end(html: str, tag: str, at: int) -> int:
    """The end of the inline element that opened before ``at``; ``at`` if a
    container ends before it, or the page."""
    depth, inside = 1, 0
    for t in _TAG.finditer(html, at):
        name = (t[2] or "").lower()
        if name == tag:
            depth += -1 if t[1] else int(not t[3].rstrip().endswith("/"))
            if not depth:
                return t.end()
        elif name in CONTAINER:
            inside += -1 if t[1] else 1
            if inside < 0:
                return at
    return at


def _step(tag: str, attrs: dict[str, str]) -> str:
    """A container in a generalised path: the tag and its classes, or else its
    id, with numbers made alike."""
    names = sorted(_DIGITS.sub("0", c.lower()) for c in attrs.get("class", "").split())
    return tag + "".join("." + c for c in names) if names else tag + "#" + _DIGITS.sub("0", attrs["id"]) if attrs.get("id") else tag


class Page:
    """The containers of a page and the blocks of text in them.

    ``nodes`` are (parent, generalised path); ``blocks`` are (node, text,
    characters within links).  Parts that are no article by their tag, and
    raw elements, are left out; so are parts marked by class, id or role,
    unless they hold the article.  Inline tags that are not
    closed do no harm; a block tag ends the block before it.
    """

    def __init__(self, html: str | None):
        self.nodes: list[tuple[int, str]] = [(-1, "")]
        self.blocks: list[tuple[int, str, int]] = []
        self._prose: list[bool] = []  # of each block: part of a text and no label
        self._marked: list[bool] = [False]  # of each node
        self._heads: list[int] = [0]  # of each node: article, main and h1 elements
        self._gone: list[bool] = []  # of each node
        self._read(html or "")
        self._weigh()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]  # open containers
        out = 0  # depth of the stack at which a part to leave out began
        leaf_out = False
        text: list[str] = []
        linked, in_link, articles, at = 0, False, 0, 0
        prose = listed = False

        def end_block() -> None:
            nonlocal linked
            if text:
                joined = "".join(text)
                block = " ".join((unescape(joined) if "&" in joined else joined).split())
                if block:
                    self.blocks.append((stack[-1][1], block, min(linked, len(block))))
                    self._prose.append(prose or stack[-1][0] in _LISTED or listed or block.count(" ") + 1 >= SAID_WORDS)
                text.clear()
            linked = 0

        while True:
            m = _TAG.search(html, at)
            piece = html[at:m.start() if m else len(html)]
            if piece and not out and not leaf_out:
                text.append(piece)
                if in_link:
                    linked += len(piece)
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag in RAW:
                if not closing and not m[3].rstrip().endswith("/"):
                    close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
                    at = close.end() if close else len(html) if tag in CODE else at
            elif tag in SKIPPED:
                if not closing and not m[3].rstrip().endswith("/"):
                    at = _skipped_to(html, tag, at)
            elif tag == "br":
                if not out and not leaf_out:
                    text.append(" ")
            elif tag == "a":
                in_link = not closing
            elif tag in LEAF:
                end_block()
                prose, listed = tag in PROSE and not closing, tag in ("li", "dt", "dd", "pre", "figcaption") and not closing
                self._heads[stack[-1][1]] += tag == "h1" and not closing and not out
                leaf_out = not closing and not out and bool(m[3]) and _is_out(tag, _attributes(m[3]), articles > 0) > 0
            elif tag == "body":  # the root; its classes often name the single page
                end_block()
            elif tag in CONTAINER:
                end_block()
                leaf_out = prose = listed = False
                if closing:
                    k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                    if k:
                        articles -= sum(t in ("article", "main") for t, _ in stack[k:])
                        del stack[k:]
                        if len(stack) <= out:
                            out = 0
                else:
                    attrs = _attributes(m[3])
                    kind = 2 if out else _is_out(tag, attrs, articles > 0)
                    if not out and kind == 2:
                        out = len(stack)
                    if out:
                        node = stack[-1][1]
                    else:
                        node = len(self.nodes)
                        parent = stack[-1][1]
                        self.nodes.append((parent, f"{self.nodes[parent][1]}/{_step(tag, attrs)}"))
                        self._marked.append(kind == 1)
                        self._heads.append(int(tag in ("article", "main") and not _marks(attrs, True)))
                    stack.append((tag, node))
                    articles += tag in ("article", "main")
            elif not closing and not out and not leaf_out and m[3] and _JUDGED.search(m[3]) and _inline_out(m[3]):
                at = _inline_end(html, tag, at)
        end_block()

    def _weigh(self) -> None:
        """Drop the marked parts.  One with most of the content is a wrapper if
        the page's article, main or h1 is in it, or if there is none and
        nearly all of the content is."""
        n, heads = len(self.nodes), self._heads
        held = [0.0] * n
        self._gone = [False] * n
        if not any(self._marked):
            return
        for node, text, linked in self.blocks:
            held[node] += max(0, len(text) - 2 * linked)
        for k in range(n - 1, 0, -1):
            held[self.nodes[k][0]] += held[k]
            heads[self.nodes[k][0]] += heads[k]
        for k in range(1, n):
            whole = held[k] >= WHOLE * held[0]
            inside = heads[k] > 0 and (whole or heads[k] == heads[0])
            wrapper = held[k] >= HOLDS * held[0] and (inside or whole and not heads[0])
            self._gone[k] = self._gone[self.nodes[k][0]] or self._marked[k] and not wrapper
        stay = [i for i, b in enumerate(self.blocks) if not self._gone[b[0]]]
        self.blocks, self._prose = [self.blocks[i] for i in stay], [self._prose[i] for i in stay]

    def vote(self) -> tuple[str, float]:
        """The path of the smallest container that holds essentially all of
        the article, and its share of the content.  Content is text, less
        twice what is linked.

        The search starts at the deepest container with most of the content
        and goes up while parts of a text that are not mostly linked stand
        beside what is held: headings, paragraphs, tables, lists, quotes and
        plain text of some length.  It does not leave an article or main
        element."""
        n = len(self.nodes)
        held, prose = [0.0] * n, [0] * n
        for (node, text, linked), is_prose in zip(self.blocks, self._prose):
            held[node] += max(0, len(text) - 2 * linked)
            prose[node] += is_prose and 2 * linked < len(text)
        for k in range(n - 1, 0, -1):  # children come after their parents
            held[self.nodes[k][0]] += held[k]
            prose[self.nodes[k][0]] += prose[k]
        if not held[0]:
            return "", 0.0
        best = at = max((k for k in range(n) if held[k] >= HOLDS * held[0]), default=0)
        while at > 0 and not _ARTICLE.match(self.nodes[at][1].rsplit("/", 1)[-1]):
            at = self.nodes[at][0]
            if prose[at] > prose[best]:
                best = at
        return self.nodes[best][1], held[best] / held[0]

    def text(self, paths: list[str]) -> str:
        """The blocks within the first of ``paths`` that the page has, or else
        within its own choice."""
        have = {p for (_, p), gone in zip(self.nodes, self._gone) if not gone}
        path = next((p for p in paths if p in have), None)
        path = self.vote()[0] if path is None else path
        inside: list[bool] = []
        for parent, p in self.nodes:
            inside.append(p == path or (parent >= 0 and inside[parent]))
        return "\n\n".join(t for node, t, _ in self.blocks if inside[node])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _votes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        yield pd.DataFrame([Page(h).vote() for h in pages], columns=["path", "share"])


def _texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, paths in batches:
        yield pd.Series([Page(h).text([] if p is None else list(p)) for h, p in zip(pages, paths)], dtype="object")


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): the paths that win a host's votes, best first.

    Each page votes with the share of its content that its container holds.
    The votes of a host are summed map-side, so a host with a third of all
    pages costs a row per task and path.
    """
    vote = F.pandas_udf(_votes, "path string, share double")("html")
    v = pages.select(host_of(F.col("url")).alias("host"), vote.alias("v")).select("host", "v.path", "v.share")
    v = cut(v.filter(F.col("share") > 0).groupBy("host", "path").agg(F.sum("share").alias("votes")))
    own = Window.partitionBy("host")
    won = v.withColumn("all", F.sum("votes").over(own)).filter(F.col("votes") >= WINS * F.col("all"))
    return won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("votes", "path")), asc=False).alias("w")).select(
        "host", F.col("w.path").alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text and n_chars (its code points).

    Texts are taken from the first of the host's winning paths that a page
    has; a page with none of them, or of a host without votes, takes the
    container that it would vote for.  Null and empty pages, and pages
    without text, have the empty text; null urls share one host; repeated
    rows get the same text; html that breaks off is read as far as it goes.
    """
    host, paths = apart(pages, "_host", "_paths")
    won = small(cut(winning_paths(pages))).withColumnsRenamed({"host": host, "paths": paths})
    names = [c for c in pages.columns if c not in ("text", "n_chars")]
    d = pages.select(*names).join(won, host_of(F.col("url")) == F.col(host), "left")
    d = d.select(*names, F.pandas_udf(_texts, "string")("html", paths).alias("text"))
    return d.select(*names, "text", F.char_length("text").cast("long").alias("n_chars"))


ship(__name__)
