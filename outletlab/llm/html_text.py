"""Main-text extraction from web pages by composite text density.

A page is parsed into a tree. Elements that are never part of an article
(menus, page headers and footers, sidebars, notices, adverts, forms, comments,
scripts, styles) are taken out. Every remaining node gets its composite text
density: characters per tag, scaled by how few of them are link text. The
sums of the children's densities pick the subtree that holds the article; the
smallest density on the path from the body down to it is the threshold that
nodes beside the path must reach to be kept too.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
WORDS = re.compile(r"[a-z]+")

RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav footer aside form script style noscript textarea title iframe template button select "
                    "svg canvas object dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot "
                   "th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# words of class, id and role values that mark what isn't the article
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
                        "breadcrumb breadcrumbs header masthead footer sidebar aside complementary notice notices cookie cookies "
                        "consent gdpr popup modal newsletter subscribe signup login share sharing social related recommended "
                        "disclaimer alert privacy copyright legal teaser teasers skip "
                        "comment comments respond reply replies disqus pagination pager toolbar widget widgets search contentinfo".split())
# of these, words that name a topic or a style as often as a page's furniture: inside an article they take nothing out
WEAK = frozenset("alert notice notices privacy copyright legal disclaimer search related recommended banner header teaser teasers "
                 "skip complementary aside menu toolbar".split())
# an id, too, takes its element out when it says that here stand the readers' comments
COMMENTS = frozenset("comment comments respond reply replies disqus".split())
COMMENT_PLACES = frozenset("section area list thread wrapper container block box form the user reader".split())
NOTICE = re.compile(r"\bcookies?\b|\u00a9|\(c\) ?\d{4}|\bcopyright\b|\ball rights reserved\b|\bprivacy policy\b|\bterms of (?:use|service)\b", re.I)
KEPT = frozenset("article main body html h1 h2 h3 h4 h5 h6".split())
NAMES = frozenset("class id role aria-label".split())
# a start tag ends an open element of these kinds, up to the nearest of the third column
P_ENDERS = BLOCKS - {"html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
P_SCOPE = frozenset("table td th caption button object html".split())


class Tree:
    """Nodes in page order: parent, name, and text parts owned by a node."""

    def __init__(self, source: str):
        self.name, self.parent = ["html"], [-1]
        self.dropped, self.marked = [False], [False]  # by its element, or by its class, id or role
        self.whole = [False]  # marked by a whole class, id or role, not by a word in one
        self.anchor = [False]  # marked by nothing but an id, a label or a weak word, as a section of an article can be
        self.parts: list[tuple[int, str]] = []  # (node, text), in page order
        self.open: Counter[str] = Counter()  # names on the stack, so that it is only searched for what is there
        stack = [0]
        at, n = 0, len(source)
        lowered: str | None = None
        while at < n:
            m = MARKUP.search(source, at)
            stop = m.start() if m else n
            if stop > at:
                self.parts.append((stack[-1], source[at:stop]))
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                self._end(stack, name)
                continue
            self._start(stack, name, m[3])
            if name in RAW:
                lowered = lowered if lowered is not None else _ascii_lower(source)
                close = lowered.find("</" + name, at)
                self._cut(stack, len(stack) - 1)
                if close < 0:
                    break
                at = source.find(">", close) + 1 or n

    def _start(self, stack: list[int], name: str, attributes: str) -> None:
        if name in P_ENDERS:
            self._close(stack, {"p"}, P_SCOPE)
        if name in CLOSES:
            self._close(stack, *CLOSES[name])
        if name in HEADINGS and self.name[stack[-1]] in HEADINGS:
            self._cut(stack, len(stack) - 1)
        node = len(self.name)
        self.name.append(name)
        self.parent.append(stack[-1])
        hidden, marks, whole, sure, weak = False, set(), False, False, True
        for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
            key = key.lower()
            if key in NAMES:
                value = value.strip("\"'").lower()
                words = BOILERPLATE.intersection(found := WORDS.findall(value))
                if words:
                    marks.add(key)
                    weak = weak and words <= WEAK
                    sure = sure or not COMMENTS.isdisjoint(found) and COMMENTS.union(COMMENT_PLACES).issuperset(found)
                    whole = whole or not BOILERPLATE.isdisjoint([value] if key == "aria-label" else value.split())
            elif key == "hidden" or key == "aria-hidden" and value.strip("\"'").lower() == "true" or key == "style" and NOT_SHOWN.search(value):
                hidden = True
        self.dropped.append(name in DROPPED or hidden or name == "header" and not (
            self.open["article"] or self.open["main"]))  # a page's header; an article's own holds its title
        anchor = bool(marks) and (weak or marks <= {"id", "aria-label"} and not sure)
        self.marked.append(bool(marks) and name not in KEPT and not (anchor and self.open["article"]))
        self.whole.append(whole)
        self.anchor.append(anchor)
        if name in VOID:
            if name == "br":
                self.parts.append((stack[-1], " "))
        else:
            stack.append(node)
            self.open[name] += 1

    def _cut(self, stack: list[int], k: int) -> None:
        for node in stack[k:]:
            self.open[self.name[node]] -= 1
        del stack[k:]

    def _close(self, stack: list[int], names: set[str], scope: frozenset[str] | set[str]) -> None:
        if not any(self.open[x] for x in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if self.name[stack[k]] in names:
                self._cut(stack, k)
                return
            if self.name[stack[k]] in scope:
                return

    def _end(self, stack: list[int], name: str) -> None:
        if not self.open[name]:
            return
        for k in range(len(stack) - 1, 0, -1):
            if self.name[stack[k]] == name:
                self._cut(stack, k)
                return
            if name not in BLOCKS and self.name[stack[k]] in BLOCKS:
                return  # an inline end tag doesn't close the block around it


def _ascii_lower(text: str) -> str:
    return "".join(c.lower() if c < "\x80" else c for c in text) if not text.isascii() else text.lower()


def main_text(source: str) -> str:
    """The article's blocks, joined by two line feeds; empty if there is none.

    A class, id, role or label takes no heading out, no element that holds an
    article or main element, and none that holds most of the page's text (see
    ``_unmark_most``); an id or label alone that doesn't say comments, and a name
    of words that may be a topic (``WEAK``), take nothing out inside an article
    element, nor inside the chosen subtree but a div. Names count for nothing
    when nothing would be left."""
    tree = Tree(source)
    holds = [False] * len(tree.name)
    for k in range(len(tree.name)):
        if tree.name[k] in ("article", "main"):
            while k > 0 and not holds[k]:
                holds[k], k = True, tree.parent[k]
                tree.marked[k] = False
    if any(tree.marked):
        _unmark_most(tree)
    text, best = _select(tree, [a or b for a, b in zip(tree.dropped, tree.marked, strict=True)])
    if text and tree.name[best] not in ("html", "body"):
        inside, again = [k == best for k in range(len(tree.name))], False
        for k in range(best + 1, len(tree.name)):
            inside[k] = inside[tree.parent[k]]
            if inside[k] and tree.marked[k] and tree.anchor[k] and tree.name[k] != "div":
                tree.marked[k], again = False, True
        if again:
            text, _ = _select(tree, [a or b for a, b in zip(tree.dropped, tree.marked, strict=True)])
    return text or _select(tree, list(tree.dropped))[0]


def _unmark_most(tree: Tree) -> None:
    """Take the mark off elements that hold over half of the page's text: where
    it is only a word in a longer name (has-sidebar), or where less than a tenth
    of the text would stay outside of them. What is marked inside stays so."""
    n = len(tree.name)
    gone = list(tree.dropped)
    for k in range(1, n):
        gone[k] = gone[k] or gone[tree.parent[k]]
    chars = [0] * n
    for k, text in tree.parts:
        if not gone[k]:
            chars[k] += len("".join(text.split()))
    free = list(chars)  # without what smaller marked elements hold
    for k in range(n - 1, 0, -1):
        chars[tree.parent[k]] += chars[k]
    large = [2 * c > chars[0] for c in chars]
    for k in range(n - 1, 0, -1):
        if large[k] or not tree.marked[k]:
            free[tree.parent[k]] += free[k]
    for k in range(1, n):
        if large[k] and tree.marked[k]:
            if tree.whole[k] and 10 * (free[0] - free[k]) >= chars[0]:
                break  # the elements of over half of the text stand in each other
            tree.marked[k] = False


def _select(tree: Tree, gone: list[bool]) -> tuple[str, int]:
    """The text that stays without the nodes ``gone``, and the node chosen."""
    n = len(tree.name)
    for k in range(1, n):
        gone[k] = gone[k] or gone[tree.parent[k]]
    parts = [(k, html.unescape(t) if "&" in t else t) for k, t in tree.parts if not gone[k]]
    # phrasing elements (b, br, span ..) are transparent: their text is their block's or link's
    solid = [0] * n
    for k in range(1, n):
        solid[k] = k if tree.name[k] in BLOCKS or tree.name[k] == "a" else solid[tree.parent[k]]
    above = [-1] + [solid[p] for p in tree.parent[1:]]
    nodes = [k for k in range(n) if solid[k] == k and not gone[k]]
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for k, text in parts:
        chars[solid[k]] += len("".join(text.split()))
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = tree.name[k] == "a" or in_link[tree.parent[k]]
        if in_link[k]:
            links[k] = chars[k]
    for k in reversed(nodes):
        if k:
            up = above[k]
            chars[up] += chars[k]
            links[up] += links[k]
            tags[up] += tags[k] + 1
            link_tags[up] += link_tags[k] + (tree.name[k] == "a")
    body = next((k for k in range(n) if tree.name[k] == "body"), 0)
    if chars[body] == 0:
        body = 0
    ratio = links[body] / max(chars[body], 1)
    if not chars[body]:
        return "", body
    density = [0.0] * n
    for k in nodes:
        if chars[k]:
            density[k] = _density(chars[k], links[k], tags[k], link_tags[k], ratio)
    inside = [k == body for k in range(n)]
    sums = [0.0] * n
    for k in nodes:
        if k and inside[above[k]]:
            inside[k] = True
            sums[above[k]] += density[k]
    best = max((k for k in nodes if inside[k]), key=lambda k: (sums[k], density[k], -k))
    path = [best]
    while path[-1] != body:
        path.append(above[path[-1]])
    threshold = min(density[k] for k in path)
    on_path = set(path)
    # within the article or main element around it, headings beside the path belong to it
    scope, within = set(), False
    for k in reversed(path):
        within = within or tree.name[k] in ("article", "main")
        if within:
            scope.add(k)
    titles = _titles(tree, nodes, above, chars, path)
    furniture = _furniture(tree, parts, solid, above, nodes, chars, best, path, body)
    keep = [False] * n
    for k in nodes:
        up = above[k]
        if k == best or (up >= 0 and keep[up]):
            keep[k] = k not in furniture
        elif inside[k] and up in on_path and k not in on_path:
            keep[k] = k in titles or k not in furniture and (
                density[k] >= threshold or (up in scope and tree.name[k] in HEADINGS | {"header"}))
    block = [0] * n
    for k in range(n):
        block[k] = k if k == 0 or tree.name[k] in BLOCKS else block[tree.parent[k]]
    # a block's text is cut where another block stands inside it
    out: list[list[str]] = []
    last = None
    for k, text in parts:
        if text.strip() and block[k] != last:
            out.append([])
            last = block[k]
        if keep[solid[k]] and out:
            out[-1].append(text)
    texts = (" ".join("".join(p).split()) for p in out)
    return "\n\n".join(t for t in texts if t), best


def _titles(tree: Tree, nodes: list[int], above: list[int], chars: list[int], path: list[int]) -> set[int]:
    """The heading directly before a node of the path, where the chosen subtree
    has none as high of its own: the page's title."""
    held, below, on_path = set(), {path[0]}, set(path[:-1])
    last: dict[int, int] = {}  # by parent: its child with text before this place
    before = []
    for k in nodes:  # in page order: parents come first
        if above[k] in below:
            below.add(k)
            if tree.name[k] in HEADINGS:
                held.add(tree.name[k])
        if k in on_path and above[k] in last:
            before.append(last[above[k]])
        if chars[k]:
            last[above[k]] = k
    return {k for k in before if tree.name[k] in ("h1", "h2") and not any(h <= tree.name[k] for h in held)}


def _furniture(tree: Tree, parts: list[tuple[int, str]], solid: list[int], above: list[int], nodes: list[int], chars: list[int],
               best: int, path: list[int], body: int) -> set[int]:
    """Unnamed notices and footers: beside the path, or as first or last child of
    a chosen body, a div or the like with under a tenth of the chosen text that
    is bare (no block in it) or speaks of cookies or rights."""
    on_path = set(path)
    children = [k for k in nodes if above[k] == body and chars[k]]
    ends = {children[0], children[-1]} if best == body and len(children) > 2 else set()
    beside = {k for k in nodes if k not in on_path and above[k] in on_path and above[k] != best} | ends
    small = {k for k in beside if tree.name[k] not in HEADINGS and 10 * chars[k] < chars[best]}
    owner: dict[int, int] = {}
    bare, texts = set(small), {k: [] for k in small}
    for k in nodes:
        owner[k] = k if k in small else owner.get(above[k], -1)
        if owner[k] not in (-1, k) and tree.name[k] in BLOCKS:
            bare.discard(owner[k])
    for k, text in parts:
        if owner.get(solid[k], -1) >= 0:
            texts[owner[solid[k]]].append(text)
    return {k for k in small if k in bare and k not in ends and tree.name[k] in ("div", "section", "a") or NOTICE.search("".join(texts[k]))}


def _density(c: int, lc: int, t: int, lt: int, body_ratio: float) -> float:
    """Composite text density; zero counts of tags and links count as one."""
    t, lt_, lc_ = max(t, 1), max(lt, 1), max(lc, 1)
    plain = max(c - lc, 1)
    base = math.log(c / plain * lc + body_ratio * c + math.e)
    value = c / lc_ * t / lt_
    return c / t * max(math.log(max(value, 1.0 + 1e-9)) / base, 0.0)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text in place of the html.

    White space inside a block is one space and blocks are joined by two line
    feeds in page order. A null, empty or textless page gives the empty
    string; broken or truncated markup is read as browsers do, as far as it
    goes; repeated rows and nulls in other columns pass through, and so do
    all other columns (one named like ``text_col`` is replaced).
    """
    rest = [c for c in pages.columns if c not in (html_col, text_col)]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            text = pa.array([main_text(h.as_py() or "") for h in batch.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], text], names=[*rest, text_col])

    schema = StructType([*(pages.schema[c] for c in rest), StructField(text_col, StringType())])
    return pages.select(*rest, F.col(html_col).cast("string")).mapInArrow(batches, schema)
