"""Main text of web pages by tag-path ratios.

A page is cut into text blocks; each has a path of block elements (name, class and id) from the root. Per path, the text
length, the punctuation and the text in links are added up over its nodes; the lengths and punctuation per node are
smoothed over neighbouring paths in page order and fused, and paths above a share of the best are content. Blocks on
content paths are the content nodes. The last element around all of them, and the last ``article`` or ``main`` if there is
one, is the article; all its blocks are the result, the short ones too. Where it is neither ``article`` nor ``main``, parts
of it without a content node are left out if links make up most of their text (menus between the parts of a text).

What elements are decides before paths do: menus, sidebars, footers, dialogs, hidden elements, and headers outside an
article hold no main text. Elements whose class, id or role has a token made up of words for such parts ("ad",
"cookie-notice", "related-posts") are marked, and forms are. Tokens with any other word ("has-sidebar",
"notice-period", "social-policy") mark nothing. Reader comments are found by what they are: a list of two or more alike
elements that each name an author and a time, a part under a heading such as "3 Comments", or an element named after
comments, unless the name says that there are none or how many ("no-comments", "comment-count"). Text below a mark is left out, but marks do not count around the page's
largest text in ``article`` or ``main`` (of the texts not much shorter, the one below the fewest marks), or, on pages
without these, around most of the text. Paths inside ``article`` or ``main`` weigh more than others.

The parser is a tolerant scanner: optional end tags are implied, stray end tags are ignored, and unknown elements are
inline, as in a browser. Elements without text of their own (scripts, styles, buttons, drawings) are skipped up to their
end tag or, where there is none, to the next block or (scripts and the like) the end of the element they are in.
Attributes are read name by name, and the time for a page is in proportion to its length. Defined cases: null, empty or text-free pages give
an empty text; an unclosed tag at the end of the page is dropped; broken character references stay as they are; pages of
any length and depth are used whole; repeated rows are treated alike. Other columns pass through, but for ``html``,
``text`` and ``n_chars``, which are replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Share of the best path's fused score from which on a path is content; of the largest text in article or main elements
#: from which on one below fewer marked elements is preferred.
THRESHOLD = 0.25
#: Weight of paths inside article or main elements.
BOOST = 50.0
#: On pages without article or main: share of the text from which on the marks around it do not count.
MOST = 0.6
#: Share of text in links from which on a part without content nodes is a menu.
LINKS = 0.5

# Elements by their role in HTML.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol p plaintext pre search section summary table tbody td tfoot th thead tr ul".split()
)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th tr dd dt ul ol table tbody".split())
CELLS = frozenset("td th li dd blockquote".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe textarea title svg select button xmp noframes noembed datalist".split())
RAW = frozenset("script style textarea title iframe xmp noframes noembed".split())
DROP = frozenset("nav aside footer dialog menu head".split())
FORMS = frozenset("form fieldset search".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "thead": ("tr", "td", "th", "thead", "tbody"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody")}
FENCE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}
# Words for parts that are no main text, and words that may stand beside them in a class, id or role.
NOISE = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices
alert popup modal overlay newsletter subscribe subscription signup login menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar
widget widgets related recommended recommendations share sharing social comment comments commentlist disqus reply replies respond responses footer toolbar
skip search form complementary contentinfo dialog toc tags masthead topbar paywall disclaimer copyright""".split())
BESIDE = frozenset("area bar block bottom box buttons container content fixed global header inner item items left link links list main media page post posts primary right row secondary section site sticky thread top unit wrap wrapper".split())

# Words of names of reader comments, and words that say that a name is no such part; words of bylines.
COMMENTS = frozenset("comment comments commentlist disqus discussion replies respond responses".split())
NO_PART = frozenset("no not non without with has have hide hidden show enable enabled disable disabled open closed off on count counter number total link icon toggle js allow allowed policy rules article main page".split())
AUTHOR = frozenset("author avatar byline commenter nick nickname user username vcard".split())
TIME = frozenset("ago date datetime posted published time timestamp".split())

#: An attribute: its name and its value in double, single or no quotes. Possessive, so that no text is read twice.
_ATTRIBUTE = r"""[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
_SCAN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/=]++|{_ATTRIBUTE})*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_BLOCKS = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})[\s/>]", re.I)
_WORDS = re.compile(r"[a-z]+")
_TITLE = re.compile(r"\W*(?:\d+\s+|(?:reader|user|your|all|latest|recent)\s+){0,3}(?:comments?|replies|responses|discussion|kommentare?|leserkommentare|commentaires?|comentarios?|commenti)\W*(?:\d+\W*)?\Z", re.I)
_AGO = re.compile(r"\b\d+\s+(?:second|minute|hour|day|week|month|year)s?\s+ago\b|\b\d{4}-\d\d-\d\d\b|\b\d{1,2}:\d\d\b|\b\d{1,2}[./]\d{1,2}[./]\d{2,4}\b", re.I)
_HEADINGS = frozenset("h2 h3 h4 h5 h6 legend summary".split())
_PUNCT = re.compile(r"[.,;:!?…。，、！？]")


def _marks(token: str) -> bool:
    """Whether a token of a class, id or role is made up of words for a part that is no main text."""
    words = _WORDS.findall(token)
    return not NOISE.isdisjoint(words) and all(w in NOISE or w in BESIDE for w in words)


@dataclass
class Attributes:
    """The element's name in paths, whether it is no main text, whether it is marked, and whether it names an author or a time."""

    name: str
    noise: bool
    marked: bool
    author: bool
    time: bool


def _attributes(tag: str, raw: str) -> Attributes:
    out = Attributes(tag, tag in DROP, tag in FORMS, tag == "cite", tag == "time")
    for m in _ATTR.finditer(raw):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            out.noise = True
        elif kind in ("class", "id", "role", "rel", "itemprop") and value:
            tokens = value.split()
            words = [set(_WORDS.findall(t)) for t in tokens]
            out.author |= any(not AUTHOR.isdisjoint(w) for w in words)
            out.time |= any(not TIME.isdisjoint(w) for w in words)
            if kind in ("rel", "itemprop"):
                continue
            if kind != "role":
                out.name += (".#"[kind == "id"]).join(["", *tokens])
            if tag not in ("html", "body", "main"):
                out.marked |= any(map(_marks, tokens)) or tag != "article" and any(not COMMENTS.isdisjoint(w) and NO_PART.isdisjoint(w) for w in words)
    return out


@dataclass
class Node:
    """An element; its number is its place in page order, ``last`` that of its last descendant.

    ``mark`` is the nearest marked element on or around it, -1 for none. ``author`` and ``time``: what it or its inline parts name.
    """

    tag: str
    parent: int
    path: int
    noise: bool
    article: bool
    marked: bool = False
    author: bool = False
    time: bool = False
    last: int = 0
    mark: int = -1


@dataclass
class Block:
    node: int
    text: str
    links: int


def scan(page: str) -> tuple[list[Node], list[Block]]:
    """All elements that are blocks, and all blocks of text, in page order."""
    nodes = [Node("", -1, 0, False, False)]
    out: list[Block] = []
    stack = [0]
    open_at: dict[str, list[int]] = {}  # by name: the open elements' places in the stack
    ends: dict[str, int] = {}  # by name: where the next end tag of a skipped element begins
    paths: dict[tuple[int, str], int] = {}
    held: list[str] = []
    links, in_link = 0, False
    unclosed: set[str] = set()
    pos, n = 0, len(page)

    def flush() -> None:
        nonlocal links
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            if text:
                out.append(Block(stack[-1], text, min(links, len(text))))
            held.clear()
        links = 0

    def pop_to(at: int) -> None:
        for node in stack[at:]:
            nodes[node].last = len(nodes) - 1
            if node:
                open_at[nodes[node].tag].pop()
        del stack[at:]

    def innermost(tags: Iterable[str]) -> int:
        """The place in the stack of the innermost open element of these names, 0 for none."""
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    def skipped(tag: str) -> int:
        """Where the skipped element ends that begins before ``pos``."""
        if tag not in unclosed and ends.get(tag, -1) < pos:
            found = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, pos)
            if found:
                ends[tag] = found.start()
            else:
                unclosed.add(tag)  # no later one is closed either
        closed = tag not in unclosed
        if tag == "svg" or not closed and tag not in RAW:  # a block ends a drawing, as in a browser, and what is never closed
            inner = _BLOCKS.search(page, pos, ends[tag] if closed else n)
            if inner:
                return inner.start()
        if closed:
            end = page.find(">", ends[tag])
            return end + 1 if end >= 0 else n
        around = "|".join(re.escape(t) for t, at in open_at.items() if at)
        end = re.compile(rf"</(?:{around})\b", re.I).search(page, pos) if around else None
        return end.start() if end else n

    while pos < n:
        m = _SCAN.search(page, pos)
        if m is None:
            held.append(page[pos:])
            break
        if m.start() > pos:
            part = page[pos : m.start()]
            held.append(part)
            if in_link:
                links += len(part.strip())
        pos = m.end()
        if m[1] is not None:
            held.append(_html.escape(m[1]))
            continue
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "a":
                in_link = False
            if tag == "br":
                held.append(" ")
            elif tag in BLOCK:
                flush()
                if at := innermost((tag,)):
                    pop_to(at)
            continue
        if tag in SKIPPED:
            if not m[4].endswith("/"):
                pos = skipped(tag)
            continue
        if tag not in BLOCK or tag in VOID:
            if tag == "a":
                in_link = True
            elif tag == "br":
                held.append(" ")
            elif tag == "hr":
                flush()
            if m[4]:
                inline = _attributes(tag, m[4])
                nodes[stack[-1]].author |= inline.author
                nodes[stack[-1]].time |= inline.time
            nodes[stack[-1]].time |= tag == "time"
            continue
        flush()
        if tag in CLOSES_P:
            for at in range(len(stack) - 1, 0, -1):
                if nodes[stack[at]].tag == "p":
                    pop_to(at)
                    break
                if nodes[stack[at]].tag not in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    break
        if tag in SAME:
            fence = innermost(FENCE[tag])
            while (at := innermost(SAME[tag])) > fence:
                pop_to(at)
                if tag not in ("tr", "thead", "tbody", "tfoot"):
                    break
        own = _attributes(tag, m[4] or "")
        up = nodes[stack[-1]]
        noise = own.noise or tag == "header" and not up.article
        marked = own.marked and (tag != "article" or bool(open_at.get("article")))
        path = paths.setdefault((up.path, own.name), len(paths) + 1)
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes))
        nodes.append(Node(tag, stack[-2], path, up.noise or noise, up.article or tag in ("article", "main"), marked, own.author, own.time))
    flush()
    pop_to(0)
    return nodes, out


def _comments(nodes: list[Node], found: list[Block]) -> None:
    """Marks the elements that hold reader comments, by their structure or heading."""
    author, time = [x.author for x in nodes], [x.time for x in nodes]
    first: dict[int, int] = {}  # by node: its first block
    for n, b in enumerate(found):
        time[b.node] |= bool(_AGO.search(b.text))
        x = b.node
        while x >= 0 and x not in first:
            first[x] = n
            x = nodes[x].parent
    for x in range(len(nodes) - 1, 0, -1):
        if nodes[x].tag not in ("article", "main") or nodes[x].marked:
            author[nodes[x].parent] |= author[x]
            time[nodes[x].parent] |= time[x]
    alike: dict[tuple[int, int], int] = {}
    children: dict[int, int] = {}
    for x in range(1, len(nodes)):
        if x in first:
            up = nodes[x].parent
            children[up] = children.get(up, 0) + 1
            if author[x] and time[x] and nodes[x].tag not in ("p", "td", "th", "h1", *_HEADINGS):
                alike[up, nodes[x].path] = alike.get((up, nodes[x].path), 0) + 1
    for (up, path), n in alike.items():
        if n >= 2:
            whole = 2 * n >= children[up] and nodes[up].tag not in ("", "html", "body", "article", "main")
            for x in [up] if whole else [x for x in range(up + 1, nodes[up].last + 1) if nodes[x].parent == up and nodes[x].path == path]:
                nodes[x].marked = True
    for b in found:
        h, up = nodes[b.node], nodes[b.node].parent
        if h.tag in _HEADINGS and _TITLE.match(b.text):
            if found[first[up]] is b and nodes[up].tag not in ("", "html", "body", "article", "main"):
                nodes[up].marked = True
                continue
            x = h.last + 1
            while x <= nodes[up].last and not (nodes[x].tag in _HEADINGS and nodes[x].tag <= h.tag):  # siblings up to the next heading of its rank
                nodes[x].marked = True
                x = nodes[x].last + 1
            h.marked = True


def _around(nodes: list[Node], mark: int) -> Iterator[int]:
    """A marked element and the marked ones around it."""
    while mark >= 0:
        yield mark
        mark = nodes[nodes[mark].parent].mark


def _free(nodes: list[Node], found: list[Block]) -> set[int]:
    """The marked elements whose marks do not count."""
    depth = {-1: 0}
    for i, node in enumerate(nodes):
        node.mark = i if node.marked else nodes[node.parent].mark if i else -1
        if node.mark == i:
            depth[i] = depth[nodes[node.parent].mark] + 1
    texts: dict[int, list[int]] = {}  # by mark
    within = [b for b in found if nodes[b.node].article]
    for b in within or found:
        t = texts.setdefault(nodes[b.node].mark, [0, 0])
        t[0], t[1] = t[0] + len(b.text), t[1] + 1
    if within:
        # marks below an article or main element count, those around it may not
        around = {-1}
        for node in nodes:
            if node.tag in ("article", "main") and not node.noise:
                x = nodes[max(node.parent, 0)].mark
                while x not in around:
                    around.add(x)
                    x = nodes[nodes[x].parent].mark
        texts = {k: v for k, v in texts.items() if k in around}
        large = [k for k, v in texts.items() if v[0] >= THRESHOLD * max(x[0] for x in texts.values())]
        return set(_around(nodes, min(large, key=lambda k: (depth[k], -texts[k][0]), default=-1)))
    total = sum(v[0] for v in texts.values())
    return set(_around(nodes, next((k for k, v in texts.items() if v[0] >= MOST * total and v[1] > 1), -1)))


def content(page: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of a page: its blocks joined by newlines."""
    if not page:
        return ""
    nodes, found = scan(page)
    found = [b for b in found if not nodes[b.node].noise]
    _comments(nodes, found)
    free = _free(nodes, found) | {-1}
    found = [b for b in found if nodes[b.node].mark in free]
    if not found:
        return ""
    stats: dict[int, list[float]] = {}
    for b in found:
        s = stats.setdefault(nodes[b.node].path, [0, 0, 0, 0, nodes[b.node].article])
        s[0] += len(b.text)
        s[1] += len(_PUNCT.findall(b.text))
        s[2] += b.links
        s[3] += 1

    def smooth(v: list[float]) -> list[float]:
        return [0.25 * (v[i - 1] if i else v[i]) + 0.5 * v[i] + 0.25 * (v[i + 1] if i + 1 < len(v) else v[i]) for i in range(len(v))]

    length = smooth([s[0] / s[3] for s in stats.values()])
    punct = smooth([s[1] / s[3] for s in stats.values()])
    score = {p: length[i] * (1 + punct[i]) * max(0.0, 1 - s[2] / s[0]) * (BOOST if s[4] else 1) for i, (p, s) in enumerate(stats.items())}
    best = max(score.values())
    if best <= 0:
        return ""
    chosen = [b.node for b in found if score[nodes[b.node].path] >= threshold * best]
    if any(nodes[x].article for x in chosen):
        chosen = [x for x in chosen if nodes[x].article]
    root = chosen[0]
    for x in chosen:  # the last element that holds all content nodes
        while not root <= x <= nodes[root].last:
            root = nodes[root].parent
    up = root
    while up and nodes[up].tag not in ("article", "main"):
        up = nodes[up].parent
    if up:
        return "\n".join(b.text for b in found if up <= b.node <= nodes[up].last)
    direct = set(chosen)
    while nodes[root].tag in LEAVES and (nodes[root].tag not in CELLS or root in direct):  # out of paragraphs, lists and tables of text
        root = nodes[root].parent
    parts: dict[int, list[int]] = {}

    below: dict[int, int] = {root: root}

    def part(x: int) -> int:
        way = []
        while x not in below and nodes[x].parent != root:
            way.append(x)
            x = nodes[x].parent
        at = below.setdefault(x, x)
        below.update(dict.fromkeys(way, at))
        return at

    kept = []
    for b in found:
        if root <= b.node <= nodes[root].last:
            at = part(b.node)
            kept.append((at, b))
            p = parts.setdefault(at, [0, 0, 0])
            p[0], p[1], p[2] = p[0] + len(b.text), p[1] + b.links, p[2] + (b.node in direct)
    return "\n".join(b.text for at, b in kept if parts[at][2] or parts[at][1] < LINKS * parts[at][0])


def extract(pages: DataFrame, html: str = "html", *, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` without ``html``, with text and n_chars (its code points) added (replacing columns of those names)."""
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    slim = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(html).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [content(x, threshold) for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*rest, "text", "n_chars"])

    return slim.mapInArrow(run, T.StructType([*slim.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
