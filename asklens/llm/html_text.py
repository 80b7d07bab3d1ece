"""Main text of raw web pages by composite text density.

Every page is read into a tree of its elements.  What is never article text goes first: scripts, styles, forms,
navigation, footers, side columns, hidden elements, the page's own header (not the one inside an article), and
elements whose class, id or role names them as an advert, a notice, a menu, a share bar or reader comments; an element
that holds the page's article is kept whatever its name.  Then, for every node of the remaining tree:

* C characters, T tags, LC characters and LT tags of links in its subtree (a zero counts as one below a fraction line);
* density = C / T * log(C / LC * T / LT) to the base ln(C / (C - LC) * LC + LCb / C b * C + e), where b is the
  body; without any link on the page the logarithm is left out, for all nodes alike;
* density sum = the densities of its children, each run of text among them counting as a child with one tag.

The node of the largest sum is the core of the main text.  The smallest density on the path from the body to it is the
threshold: from the body down, each node that reaches the threshold gives the largest-sum node of its subtree.  So an
article cut into sections is found whole.  A found paragraph or inline node stands for the container around it, and a
node inside an ``article`` or ``main`` element for that element.  All text of the selected subtrees is kept, also short
paragraphs.  If the rules above would leave a page without any text, nothing but scripts, styles and the like is taken out.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined by one space.

Defined cases: a null, empty or textless page gives an empty text; unclosed and stray tags are read as browsers read
them (a paragraph ends where the next block begins); an unfinished tag, comment or script reaches to the end of the page; pages of any
length are read whole, without recursion; elements nested deeper than ``MAX_DEPTH`` give their text to the one at that
depth, so the work stays in proportion to the page; repeated rows give repeated rows; extra columns are not looked at; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import map_batches

# Element names of HTML, by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split())
#: a container: it may be selected by itself
CONTAINER = frozenset("article body center details div dl html main ol section table tbody td tr ul blockquote figure".split())
CLOSES_PARAGRAPH = BLOCK - frozenset("body html td th tr tbody thead tfoot".split())
#: an opening tag ends an open element of these, unless one of the second kind stands between
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot tr td th", "table"),
    "tfoot": ("tbody thead tfoot tr td th", "table"), "body": ("head", "html")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
NEVER = frozenset("head script style noscript template iframe object embed svg canvas audio video textarea xmp title".split())
ASIDE = frozenset("nav footer aside form button select dialog menu input datalist label fieldset".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: words in a class or id that name something beside the article
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promotion "
    "banner cookie cookies consent gdpr notice notices notification notifications popup modal overlay interstitial "
    "newsletter subscribe subscription signup signin login paywall nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "pagination pager sidebar sidebars rail widget widgets related recommended recommendations teaser teasers share sharing social "
    "comment comments commentlist commentary disqus discussion respond reply replies footer masthead topbar toolbar "
    "skiplink searchbox hidden".split())
REMARKS = frozenset("comment comments reply replies".split())

MAX_DEPTH = 2048

_TAG = re.compile(
    r"<(?:!--(?:>|->|(.*?)(?:--!?>|\Z))"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>|)"
    r"|[!?/][^>]*(?:>|\Z))", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.IGNORECASE) for t in RAW}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|>|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Page:
    """The elements of a page in page order: a node's parent always comes before it."""

    def __init__(self, html: str):
        self.tags, self.parents, self.attributes, self.items = ["#root"], [-1], [""], [[]]
        stack, at, end = [0], 0, len(html)
        while at < end:
            found = _TAG.search(html, at)
            self._text(stack[-1], html[at:found.start()] if found else html[at:])
            if not found:
                break
            at = found.end()
            name = found.group(3)
            if name is None:
                continue  # a comment or a declaration
            if not found.group(4):
                break  # an unfinished tag
            name = name.lower()
            if found.group(2):
                self._close(stack, name)
                continue
            node = self._open(stack, name, found.group(4))
            if name in RAW:
                until = _RAW_END[name].search(html, at)
                if name != "title":
                    at = until.start() if until else end
                    continue
                self._text(node, html[at:until.start() if until else end])
                at = until.start() if until else end

    def _text(self, node: int, text: str) -> None:
        if text:
            self.items[node].append(unescape(text) if "&" in text else text)

    def _open(self, stack: list[int], name: str, attributes: str) -> int:
        tags = self.tags
        if name in CLOSES_PARAGRAPH:
            for place in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[place]]
                if open_tag == "p":
                    del stack[place:]
                if open_tag in BLOCK:
                    break
        if name in ENDS:
            ended, fence = ENDS[name]
            first = 0
            for place in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[place]]
                if open_tag in fence:
                    break
                if open_tag in ended:
                    first = place
            if first:
                del stack[first:]
        node = len(tags)
        tags.append(name)
        self.parents.append(stack[-1])
        self.attributes.append(attributes)
        self.items.append([])
        self.items[stack[-1]].append(node)
        if name not in VOID and len(stack) < MAX_DEPTH and not (
                attributes.endswith("/>") and name not in BLOCK and name not in RAW):
            stack.append(node)
        return node

    def _close(self, stack: list[int], name: str) -> None:
        if name in ("body", "html"):
            return  # what follows still belongs to the page
        for place in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[place]]
            if open_tag == name:
                del stack[place:]
                return
            if name not in BLOCK and open_tag in BLOCK:
                return  # an inline end tag does not end a block


def _named_aside(tag: str, attributes: str) -> bool:
    if _HIDDEN.search(attributes):
        return True
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id"):
            words = {w.lower() for w in _WORDS.findall("".join(values))}
            if words & (REMARKS if tag in ("article", "main") else NAMES):
                return not (tag == "article" and "post" in words)
        elif name == "role" and "".join(values).strip().lower() in ROLES:
            return True
    return False


def kept_nodes(page: Page, strict: bool = True) -> list[bool]:
    """Whether a node may hold article text; a dropped node's whole subtree is dropped."""
    tags, parents = page.tags, page.parents
    n = len(tags)
    holds = [False] * n  # holds the article or its headline
    named = [False] * n
    for i in range(1, n):
        if page.attributes[i] and len(page.attributes[i]) > 1 and tags[i] not in ("html", "body"):
            named[i] = _named_aside(tags[i], page.attributes[i])
    for i in range(n - 1, 0, -1):
        if holds[i] or (tags[i] in ("article", "main", "h1") and not named[i]):
            holds[parents[i]] = True
    kept, inside = [True] * n, [False] * n
    for i in range(1, n):
        up, tag = parents[i], tags[i]
        inside[i] = inside[up] or tag in ("article", "main")
        drop = tag in NEVER
        if strict and not drop:
            drop = (tag in ASIDE and not (tag in ("form", "fieldset") and holds[i])) or (
                tag == "header" and not inside[up]) or (named[i] and not holds[i])
        kept[i] = kept[up] and not drop
    return kept


def densities(page: Page, kept: list[bool]) -> tuple[list[float], list[float], list[int]]:
    """Composite text density, density sum and characters of every node."""
    tags, parents = page.tags, page.parents
    n = len(tags)
    chars, count, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    runs: list[list[int]] = [[] for _ in range(n)]
    in_link = [False] * n
    for i in range(n):
        if kept[i]:
            in_link[i] = tags[i] == "a" or (i > 0 and in_link[parents[i]])
            for item in page.items[i]:
                if isinstance(item, str):
                    size = len("".join(item.split()))
                    if size:
                        runs[i].append(size)
            chars[i] = sum(runs[i])
            link_chars[i] = chars[i] if in_link[i] else 0
    for i in range(n - 1, 0, -1):
        if kept[i]:
            up = parents[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            count[up] += count[i] + 1
            link_tags[up] += link_tags[i] + (tags[i] == "a")
    body = next((i for i in range(n) if tags[i] == "body"), 0)
    share = link_chars[body] / max(chars[body], 1)

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        plain = c / max(t, 1)
        if not share:
            return plain
        base = log(log(c / max(c - lc, 1) * lc + share * c + e))
        return plain * log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1.0)) / base if base > 0 else plain

    dense = [density(chars[i], count[i], link_chars[i], link_tags[i]) if kept[i] else 0.0 for i in range(n)]
    sums = [sum(density(r, 1, r if in_link[i] else 0, 1 if in_link[i] else 0) for r in runs[i]) for i in range(n)]
    for i in range(n - 1, 0, -1):
        sums[parents[i]] += dense[i]
    return dense, sums, chars


def select(page: Page, kept: list[bool]) -> list[int]:
    """The nodes whose subtrees are the main text, in page order; none lies inside another."""
    tags, parents = page.tags, page.parents
    n = len(tags)
    dense, sums, chars = densities(page, kept)
    body = next((i for i in range(n) if tags[i] == "body" and kept[i]), 0)
    under = [False] * n  # in the body
    best = list(range(n))  # the largest-sum node of each subtree, the first one if tied
    for i in range(n):
        under[i] = i == body or (i > 0 and under[parents[i]])
    for i in range(n - 1, 0, -1):
        up = parents[i]
        if kept[i] and sums[best[i]] >= sums[best[up]] and (best[up] != up or sums[best[i]] > sums[up]):
            best[up] = best[i]
    core = best[body]
    if not chars[core]:
        return []
    threshold, node = dense[core], core
    while node != body:
        node = parents[node]
        threshold = min(threshold, dense[node])
    reached, picked = [False] * n, set()
    for i in range(n):
        if kept[i] and under[i] and chars[i] and (i == body or reached[parents[i]]) and dense[i] >= threshold:
            reached[i] = True
            picked.add(_container(page, best[i], body))
    out = []
    for i in sorted(picked):
        node = parents[i]
        while node >= 0 and node not in picked:
            node = parents[node]
        if node < 0:
            out.append(i)
    return out


def _container(page: Page, node: int, body: int) -> int:
    """The nearest article or main element around a node, else the nearest container, else the body."""
    up = node
    while up not in (body, 0):
        if page.tags[up] in ("article", "main"):
            return up
        up = page.parents[up]
    while node not in (body, 0) and page.tags[node] not in CONTAINER:
        node = page.parents[node]
    return node


def blocks(page: Page, kept: list[bool], node: int) -> list[str]:
    """The text of each block of a subtree, white space collapsed, in page order."""
    out, held, todo = [], [], [iter(page.items[node])]
    ends = [True]

    def flush():
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    while todo:
        for item in todo[-1]:
            if isinstance(item, str):
                held.append(item)
            elif page.tags[item] == "br":
                held.append("\n")
            elif kept[item]:
                block = page.tags[item] in BLOCK
                if block:
                    flush()
                todo.append(iter(page.items[item]))
                ends.append(block)
                break
        else:
            todo.pop()
            if ends.pop():
                flush()
    return out


def main_text(html: str | None) -> tuple[str, str, int]:
    """(text, path of the first selected element, blocks) of one page."""
    if not html:
        return "", "", 0
    page = Page(html)
    for strict in (True, False):
        kept = kept_nodes(page, strict)
        nodes = select(page, kept)
        if nodes:
            break
    else:
        return "", "", 0
    found = [b for node in nodes for b in blocks(page, kept, node)]
    path, node = [], nodes[0]
    while node > 0:
        path.append(page.tags[node])
        node = page.parents[node]
    return " ".join(found), "/".join(reversed(path)), len(found)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points), n_blocks, main_path (names of the elements from the
    root to the first selected one)."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                done = [main_text(html) for html in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array([d[0] for d in done], pa.string()),
                     pa.array([len(d[0]) for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
                     pa.array([d[1] for d in done], pa.string())],
                    ["page_id", "url", "text", "n_chars", "n_blocks", "main_path"])

    kinds = dict(slim.dtypes)
    return map_batches(slim, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint, "
                                  "n_blocks bigint, main_path string")
