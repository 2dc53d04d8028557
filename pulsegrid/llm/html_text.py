"""Main text of web pages by composite text density (operator 3).

A page becomes a tree. Parts that are no article by their element, class or id (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, comments) are cut off; of the
header of an article its headings stay. For
every node left, characters per tag are weighted down by its share of link text (composite
text density), and a node's density sum is that of its children. The node of the largest
sum (in the article element, if there is one) is the core; the least density on its path to the body is the threshold. The article
(or main element) around the core is content as a whole; without one, so are the core and
the blocks beside its path that are text rather than links. In the rest of the page (of the
other articles, where the core is in an article: comments and notices beside it have any
name) every node whose density reaches the threshold is content: the whole of it, or if it
is mostly links, the subtree of the largest sum in it.

Scale: one pass over the pages, without a shuffle; a task holds one batch. Trees are kept
in flat lists in page order and summed from the end, so depth costs no recursion, and
every step is linear in the page.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workers import ship_by_value
from . import kernels
from .common import read

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
BLOCK = CLOSES_P | {"html", "body", "text", "li", "dt", "dd", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "option", "legend"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "svg", "math", "time", "tt", "u", "var"} | VOID
#: Elements that end an open one of the second set, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
DROP = RAW | {"head", "nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "annotation", "annotation-xml", "defs", "desc", "metadata", "object", "audio", "video", "canvas", "input"}
#: Elements whose insides are drawn as one sign or picture: their texts count, their tags don't.
DRAWN = {"math", "svg"}
#: Words that mark a part as no article. A class, id or role does if it has one of them and
#: otherwise only words that say where or how the part stands.
DROP_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "popup", "modal", "overlay",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "header", "masthead", "footer", "sidebar", "aside", "complementary", "contentinfo",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "disclaimer", "newsletter", "subscribe", "subscription", "signup", "login", "search", "form",
    "share", "sharing", "social", "related", "recommended", "recommendations", "trending", "comment", "comments", "disqus", "discussion", "feedback", "replies", "respond", "widget", "toolbar", "skip", "hidden",
}
PLACE_WORDS = {
    "", "site", "global", "main", "primary", "secondary", "top", "bottom", "left", "right", "inner", "outer", "fixed", "sticky", "floating", "mobile", "desktop",
    "block", "box", "bar", "container", "wrapper", "wrap", "area", "section", "panel", "slot", "unit", "zone", "space", "list", "item", "items", "link", "links", "button", "buttons", "icon", "icons",
    "thread", "user", "users", "reader", "readers", "visitor", "visitors", "guest", "policy", "media", "posts", "articles", "stories", "text", "message", "to", "by", "us", "js",
}
#: Words that name such a part whatever words stand before them, but for those of a state.
HEAD_WORDS = {"ads", "advert", "adverts", "advertisement", "comments", "feedback", "replies", "disqus", "newsletter", "sidebar", "navbar", "breadcrumbs", "popup", "cookies", "consent"}
STATE_WORDS = {"no", "not", "has", "have", "with", "without", "is", "hide", "show"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VERSION = re.compile(r"v?[0-9]+")
SPACE = re.compile(r"\s+")


class Page:
    """Nodes in page order: tag, parent, whether cut off; texts as (node, block, text).

    Elements that are no article by their tag are cut at once, those that are none by a word
    when the page is known: never what holds the page's article (its longest article element
    or main, without one more than half of the text), and none if nothing would be left."""

    def __init__(self, source: str):
        self.tag, self.parent, self.cut, self.texts = ["#page"], [-1], [False], []
        self.loose: set[int] = set()  # nodes whose own text is content, but not all that is in them
        self.named: list[int] = []  # nodes that are no article by a word
        muted: set[int] = set()  # the header of an article, but for its headings
        stack, open_tags, block, at = [0], {}, 0, 0
        n = len(source)

        def text(a: int, b: int) -> None:
            if b > a and not self.cut[stack[-1]] and stack[-1] not in muted:
                self.texts.append((stack[-1], block, html.unescape(source[a:b])))

        def pop_to(names, scope=()) -> None:
            nonlocal block
            if not any(open_tags.get(x) for x in names):
                return
            for i in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[i]]
                if t in names:
                    for x in stack[i:]:
                        open_tags[self.tag[x]] -= 1
                        block += self.tag[x] in BLOCK
                    del stack[i:]
                    return
                if t in scope:
                    return

        while at < n:
            m = TOKEN.search(source, at)
            if not m:
                text(at, n)
                break
            text(at, m.start())
            at = m.end()
            if not m[2]:
                continue
            t = m[2].lower()
            if m[1]:
                pop_to((t,))
                continue
            if t in CLOSES_P:
                pop_to(("p",), ("table", "td", "th", "button"))
            if t in ENDS:
                pop_to(*ENDS[t])
            block += t in BLOCK
            title = t == "header" and bool(open_tags.get("article") or open_tags.get("main"))
            cut = self.cut[stack[-1]] or t in DROP and not title
            if not cut and t not in ("html", "body") and m[3] and self.unwanted(m[3]):
                self.named.append(len(self.tag))
            if title or stack[-1] in muted and t not in HEADINGS:
                muted.add(len(self.tag))
            self.tag.append(t)
            self.parent.append(stack[-1])
            self.cut.append(cut)
            if t == "br":
                text_at = stack[-1]
                if not self.cut[text_at] and text_at not in muted:
                    self.texts.append((text_at, block, " "))
            if t in RAW:
                end = re.compile(rf"</{re.escape(t)}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else n
                after = source.find(">", at)
                at = n if after < 0 else after + 1
            elif t not in VOID and not m[3].endswith("/"):
                stack.append(len(self.tag) - 1)
                open_tags[t] = open_tags.get(t, 0) + 1

        if self.named:
            self.cut_named()

    @staticmethod
    def unwanted(attributes: str) -> bool:
        for m in NAMES.finditer(attributes):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                words = [w for w in re.split(r"[^a-z0-9]+", name) if not VERSION.fullmatch(w)]
                known = set(words)
                if known & DROP_WORDS and known <= DROP_WORDS | PLACE_WORDS:
                    return True
                named = [w for w in words if w not in PLACE_WORDS]
                if named and named[-1] in HEAD_WORDS and not known & STATE_WORDS:
                    return True
        return False

    def cut_named(self) -> None:
        n = len(self.tag)
        chars = [0] * n
        for i, _, t in self.texts:
            chars[i] += len(t) - sum(map(t.count, " \n\t\r"))
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        articles = [i for t in ("article", "main") for i in range(n) if self.tag[i] == t and chars[i]]
        holds, i = set(), max(articles, key=lambda i: (self.tag[i] == "article", chars[i])) if articles else 0
        while i > 0:
            holds.add(i)
            i = self.parent[i]
        named = {i for i in self.named if i not in holds and (articles or 2 * chars[i] <= chars[0])}
        cut = self.cut[:]
        for i in range(1, n):
            cut[i] = cut[i] or i in named or cut[self.parent[i]]
        left = [x for x in self.texts if not cut[x[0]]]
        if any(not t.isspace() for _, _, t in left):
            self.cut, self.texts = cut, left

    def densities(self) -> tuple[list[int], list[int], list[float], list[float]]:
        """Of each node: characters and link characters, composite density, sum of its children's densities."""
        n = len(self.tag)
        chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link, drawn = [False] * n, [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
            drawn[i] = drawn[self.parent[i]] or self.tag[i] in DRAWN
        for i, _, t in self.texts:
            c = len(t) - t.count(" ") - t.count("\n")
            chars[i] += c
            link_chars[i] += c * in_link[i]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if not self.cut[i]:
                chars[p] += chars[i]
                link_chars[p] += link_chars[i]
                tags[p] += tags[i] + (not drawn[i])
                link_tags[p] += link_tags[i] + (self.tag[i] == "a")
        body_share = link_chars[0] / max(chars[0], 1)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n):
            c = chars[i]
            if c and not self.cut[i]:
                lc, tag = link_chars[i], max(tags[i], 1)
                base = math.log(c / max(c - lc, 1) * lc + body_share * c + math.e)
                weight = math.log(max(c / max(lc, 1) * tag / max(link_tags[i], 1), 1.0)) / max(math.log(base), 0.1)
                density[i] = c / tag * weight
        for i in range(1, n):  # formatting inside a line is no part of the layout
            if self.tag[i] not in INLINE:
                sums[self.parent[i]] += density[i]
        return chars, link_chars, density, sums

    def content(self) -> list[int]:
        """The nodes whose subtrees are the main text, in page order."""
        n = len(self.tag)
        chars, link_chars, density, sums = self.densities()
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        if not chars[body]:
            body = 0
        inside = [False] * n
        inside[body] = True
        for i in range(body + 1, n):
            inside[i] = inside[self.parent[i]] and not self.cut[i]
        in_article, outer = [False] * n, []
        for i in range(body + 1, n):
            in_article[i] = in_article[self.parent[i]] or self.tag[i] == "article"
            if inside[i] and chars[i] and self.tag[i] == "article" and not in_article[self.parent[i]]:
                outer.append(i)
        # a page's only article holds the core, however long the comments beside it are
        only = len(outer) == 1 and outer[0] not in self.named
        core = max((i for i in range(n) if inside[i] and (in_article[i] or not only)), key=lambda i: (sums[i], -i))
        if not sums[core]:
            return [outer[0] if only else body] if chars[body] else []
        threshold, i = density[core], core
        while i != body and i > 0:
            threshold = min(threshold, density[i])
            i = self.parent[i]
        if core == body:
            return [body]
        path = [core]
        while path[-1] != body:
            path.append(self.parent[path[-1]])
        own = next((i for t in ("article", "main") for i in path[::-1] if self.tag[i] == t), core)
        # beside the path of the core, every block stays that is text rather than links; an article stays as it is
        near, best = set(path[1:]) if own == core and self.tag[core] not in ("article", "main") else set(), list(range(n))
        texts, links = chars[:], [0] * n  # of a node on the path without the blocks in it
        for i in range(n - 1, body, -1):
            p = self.parent[i]
            if inside[i]:
                best[p] = max(best[p], best[i], key=lambda k: (sums[k], -k))
                texts[p] -= link_chars[i] if self.tag[i] in INLINE else chars[i]
                links[p] += link_chars[i] * (self.tag[i] in INLINE)
        self.loose = {i for i in near if texts[i] >= links[i]}
        path, whole = set(path), {own}
        for i in range(body + 1, n):
            if inside[i] and (in_article[i] or self.tag[own] != "article") and i not in path:
                p, text = self.parent[i], 2 * link_chars[i] <= chars[i]
                if p in self.loose if p in near and self.tag[i] in INLINE else text and (p in near or density[i] >= threshold):
                    whole.add(i)
                elif density[i] >= threshold:
                    whole.add(best[i])
        return sorted(whole)

    def text(self) -> str:
        chosen = self.content()
        keep = [False] * len(self.tag)
        for i in chosen:
            keep[i] = True
        for i in range(1, len(self.tag)):
            keep[i] = keep[i] or keep[self.parent[i]]
        blocks: dict[int, list[str]] = {}
        for i, b, t in self.texts:
            if keep[i] or i in self.loose:
                blocks.setdefault(b, []).append(t)
        lines = (SPACE.sub(" ", "".join(x)).strip() for x in blocks.values())
        return "\n".join(x for x in lines if x)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The input without ``html_col``, with ``text`` and ``n_chars`` (code points) added; input
    columns of these names are replaced.

    A null, empty or text-free page gives the empty text. Broken markup never fails: open
    elements end with the page, a tag cut off by the page's end is dropped, unknown closing
    tags are ignored. Each row gives a row, repeated ones too; an empty table none.
    """
    keep = [c for c in pages.columns if c.lower() not in (html_col.lower(), "text", "n_chars")]
    schema = pages.select(*[F.col(f"`{c}`") for c in keep]).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.slices(batches):
            found = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=schema.names)

    return pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`")).mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


ship_by_value(__name__)
