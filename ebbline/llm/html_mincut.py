"""Main text of HTML pages by a minimum cut.

A page is read into blocks: text between tags that open or close a block. A classifier gives
each block a cost for each label, content or boilerplate, from its place in the page (elements
and names of its ancestors, the innermost that says something), its share of link text, its length
and its sentence ends. Class and id names say less than elements and roles: a layout's wrapper may be named for the sidebar or the notice it
has, so the main part within a wrapper that only such names call boilerplate is the page's main part if nothing outside it outweighs it. The costs are the capacities to the two terminals. Blocks that follow each
other, and blocks that are the next child of the same element, are joined by smoothness edges, the
stronger the nearer they stand in the tree. The minimum cut is the cheapest labelling; the text of
the blocks on the content side, in page order, is the page's main text.

Blocks whose own costs outweigh all their edges are labelled at once, which no minimum cut contradicts,
and their edges become costs of their neighbours; the maximum flow runs over what is left.

Costs are fixed parameters (``Costs``). Pages are row-wise work: nothing is shuffled.

Defined results: html NULL, empty or without content blocks gives an empty text and 0 characters; tags that are never
closed end with the page; repeated rows are treated alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import slices

# HTML element names by their part in a page.
HIDDEN = frozenset("script style noscript template svg annotation annotation-xml head title iframe object canvas audio video".split())
RAW = frozenset("script style textarea title xmp noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
ASIDE_TAGS = frozenset("nav footer aside form header dialog menu button select fieldset".split())
MAIN_TAGS = frozenset("article main".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "caption", "summary", "figcaption"}
SELF_CLOSING = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
# Names in class, id and role that pages give to their parts.
ASIDE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies "
    "dialog disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notification pager "
    "pagination popup promo promoted related reply replies search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe teaser toolbar widget".split()
)
MAIN_NAMES = frozenset("article content main story post entry body text".split())

# Words of a name that make it tell of the page's state, not of the element's part; and parts that hold texts of their own, which no layout is named for.
STATE_WORDS = frozenset("has have no not with without is".split())
LISTED_NAMES = frozenset("comment comments commentlist disqus reply replies related teaser promo promoted sponsor sponsored".split())
# A name that also holds a word of MAIN_NAMES is boilerplate only if it ends in one of these (``post-comments``, ``main-nav``).
HEAD_NAMES = LISTED_NAMES | frozenset("ad ads breadcrumb breadcrumbs menu nav navbar navigation newsletter pagination pager share sharing social".split())
HEADER_NAMES = frozenset(["header"])

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*>?", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s/>"'=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>][^\s>]*+))?""")  # each in turn, so values aren't read as names
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # of a name: news-letter, newsLetter
_SENTENCE = re.compile(r"[.!?…](?:[\"'”’)\]]*)(?:\s|$)")


@dataclass(frozen=True)
class Costs:
    """What the labels cost, in thousandths; greater means surer."""

    inside_aside: int = 6000  # an ancestor is a menu, footer, sidebar, notice, advert, form or comment
    inside_main: int = 6000  # an ancestor is the article or main part; more than links, shortness and all edges together
    links: int = 2500  # all of the text is links
    per_word: int = 60  # up to ``words`` words
    words: int = 30
    sentence: int = 300  # it has a sentence end
    short: int = 1200  # it has no words to speak of, by the share of its text that is links: other short text goes with its neighbours
    heading: int = 300  # a heading that is a link, instead of links and shortness: it goes with its neighbours
    adjacent: int = 500  # neighbours in the page, with the same parent; halved for each step of distance
    sibling: int = 300  # next child of the same element


@dataclass
class Node:
    tag: str
    number: int
    depth: int
    parent: Node | None
    verdict: int  # 1 main, -1 aside, 0 nothing said
    hidden: bool
    link: bool
    wrappers: int = 0  # elements around it that class names alone call boilerplate; -1 if an element or role does
    claim: Node | None = None  # the main part within such wrappers that it belongs to


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _said_by(name: str) -> int:
    """What one name of a class or id says: 1 main, -1 aside, 0 nothing."""
    words = [w.lower() for w in _WORD.findall(name)]
    aside, main = not ASIDE_NAMES.isdisjoint(words), not MAIN_NAMES.isdisjoint(words)
    if not (aside or main) or not STATE_WORDS.isdisjoint(words):
        return 0
    if aside and main:
        return -1 if words[-1] in HEAD_NAMES else 0
    return -1 if aside else 1


def _element(tag: str, attributes: str, number: int, above: Node, link: bool) -> Node:
    """The element with what it says about its text, and whether it hides it."""
    hidden, roles, names = above.hidden or tag in HIDDEN, [], []
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif key == "role":
                roles += value.lower().split()
            elif key in ("class", "id"):
                names += value.split()
    node = Node(tag, number, above.depth + 1, above, above.verdict, hidden, link, above.wrappers, above.claim)
    if tag in ("html", "body"):
        return node
    says = {n: _said_by(n) for n in names}
    named = [n for n in names if says[n] < 0]
    within = above.verdict > 0 or above.claim is not None
    main_tag = tag in MAIN_TAGS or not MAIN_TAGS.isdisjoint(roles)
    if tag in ASIDE_TAGS or not main_tag and not ASIDE_NAMES.isdisjoint(roles):
        # A header within the article holds its title.
        if tag != "header" or not within:
            node.verdict, node.wrappers, node.claim = -1, -1, None
    elif named and not main_tag:
        words = {w.lower() for n in named for w in _WORD.findall(n)}
        if not (within and words & ASIDE_NAMES <= HEADER_NAMES):
            node.verdict, node.claim = -1, None
            if node.wrappers >= 0:
                node.wrappers += 1 if words.isdisjoint(LISTED_NAMES) else 2
    elif main_tag or 1 in says.values():
        if above.verdict >= 0:
            node.verdict = 1
        elif above.wrappers > 0 and above.claim is None:
            node.claim = node  # else an article within a menu or footer belongs to it
    return node


def _settle(found: list[Block]) -> None:
    """Make the claims good that nothing outside of their wrappers outweighs, those in the fewest wrappers first."""
    claims: dict[int, tuple[Node, int]] = {}
    main = neutral = 0
    for block in found:
        node = block.node
        if node.verdict < 0 and node.claim is None:
            continue
        size = sum(len(p) for p in block.parts) - block.link_chars
        if node.claim is not None:
            claims[node.claim.number] = node.claim, claims.get(node.claim.number, (None, 0))[1] + size
        elif node.verdict > 0:
            main += size
        else:
            neutral += size
    good: set[int] = set()
    for level in sorted({c.wrappers for c, _ in claims.values()}):
        own = [(c, n) for c, n in claims.values() if c.wrappers == level]
        # An element that is a main part stands against other main parts only, one that is named so against all text.
        taken = [(c, n) for c, n in own if c.tag == "main" or n > main + (0 if c.tag in MAIN_TAGS else neutral)]
        good.update(c.number for c, _ in taken)
        main += sum(n for _, n in taken)
    for block in found:
        if block.node.claim is not None and block.node.claim.number in good:
            block.node.verdict = 1


def blocks(html: str | None) -> list[Block]:
    """The page's blocks of text in page order, white space as it stands, character references decoded."""
    html = html or ""
    root = Node("", 0, 0, None, 0, False, False)
    stack, found, current, number, at = [root], [], None, 0, 0

    def text(raw: str) -> None:
        nonlocal current
        top = stack[-1]
        if not raw or top.hidden:
            return
        if current is None:
            owner = top
            while owner.parent is not None and owner.tag not in BLOCKS:
                owner = owner.parent
            current = Block(owner)
            found.append(current)
        raw = unescape(raw) if "&" in raw else raw
        current.parts.append(raw)
        if top.link:
            current.link_chars += len(raw.strip())

    def close(tags) -> None:
        """Leave the innermost open element of these names, and all within it."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return

    size = len(html)
    while at < size:
        match = _TAG.search(html, at)
        if not match:
            text(html[at:])
            break
        text(html[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            current = None
        if match[1]:
            if tag == "p" or tag not in VOID:
                close({tag})
            continue
        attributes = match[3]
        if tag in CLOSES_P:
            # A block ends an open paragraph that nothing but inline elements stands between.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in SELF_CLOSING and tag != "p":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SELF_CLOSING[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table", "menu", "select", "article", "div", "body"):
                    break
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in HIDDEN:
            continue
        number += 1
        above = stack[-1]
        stack.append(_element(tag, attributes, number, above, above.link or tag == "a"))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            if tag == "textarea":
                text(html[at : end.start() if end else size])
            stack.pop()
            at = end.end() if end else size
    found = [b for b in found if not all(p.isspace() for p in b.parts)]
    _settle(found)
    return found


def block_cost(block: Block, text: str, costs: Costs) -> int:
    """Cost of calling it boilerplate less cost of calling it content."""
    words = len(text.split())
    linked = min(1.0, block.link_chars / max(1, len(text)))
    own = costs.per_word * min(words, costs.words) + costs.sentence * bool(_SENTENCE.search(text))
    if block.node.tag in HEADINGS:
        gain = int(own * (1 - linked)) - int(costs.heading * linked)
    else:
        gain = own - int((costs.short + costs.links) * linked)
    return gain + (costs.inside_main if block.node.verdict > 0 else -costs.inside_aside if block.node.verdict < 0 else 0)


def distance(a: Node, b: Node, most: int = 12) -> int:
    """Steps between two elements in the tree, cut off at ``most``."""
    steps = 0
    while a is not b and steps < most:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(found: list[Block], costs: Costs) -> dict[tuple[int, int], int]:
    """Capacity of each edge between blocks i < j."""
    edges: dict[tuple[int, int], int] = defaultdict(int)
    last: dict[int, int] = {}
    for j, block in enumerate(found):
        if j:
            edges[j - 1, j] += costs.adjacent >> min(distance(found[j - 1].node, block.node), 12)
        parent = block.node.parent.number if block.node.parent else -1
        if parent in last:
            edges[last[parent], j] += costs.sibling
        last[parent] = j
    return {e: c for e, c in edges.items() if c > 0}


def min_cut(gains: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut; of equal cuts the one with fewest content nodes.

    A node's gain is its capacity from the content terminal if positive, else to the other one.
    """
    near: dict[int, dict[int, int]] = defaultdict(dict)
    for (i, j), c in edges.items():
        near[i][j] = near[j][i] = c
    gains, label = list(gains), [None] * len(gains)
    queue = deque(range(len(gains)))
    while queue:  # sure nodes first; each makes its neighbours' costs surer
        i = queue.popleft()
        if label[i] is not None:
            continue
        open_edges = sum(c for j, c in near[i].items() if label[j] is None)
        if gains[i] > open_edges or gains[i] <= -open_edges:
            label[i] = gains[i] > open_edges
            for j, c in near[i].items():
                if label[j] is None:
                    gains[j] += c if label[i] else -c
                    queue.append(j)
    rest = [i for i, known in enumerate(label) if known is None]
    if rest:
        content = _max_flow(rest, gains, near)
        for i in rest:
            label[i] = i in content
    return label


def _max_flow(rest: list[int], gains: list[int], near: dict[int, dict[int, int]]) -> set[int]:
    """Nodes that the content terminal still reaches after a maximum flow, by shortest augmenting paths in layers."""
    inside, source, sink = set(rest), -1, -2
    left: dict[int, dict[int, int]] = defaultdict(dict)
    for i in rest:
        if gains[i] > 0:
            left[source][i], left[i][source] = gains[i], 0
        else:
            left[i][sink], left[sink][i] = -gains[i], 0
        for j, c in near[i].items():
            if j in inside:
                left[i][j] = c
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in left[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return {v for v in level if v >= 0}
        untried = {u: iter(list(left[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(left[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    left[a][b] -= flow
                    left[b][a] += flow
                # Go on from the first edge that is used up.
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if left[a][b] == 0)
                del path[cut + 1 :]
                untried[path[-1]] = iter(list(left[path[-1]]))
                continue
            for v in untried[u]:
                if left[u][v] > 0 and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
                level[u] = -1


def main_text(html: str | None, costs: Costs = Costs()) -> str:
    """The texts of the blocks on the content side, in page order, joined by one blank."""
    found = blocks(html)
    texts = [b.text for b in found]
    gains = [block_cost(b, t, costs) for b, t in zip(found, texts)]
    kept = min_cut(gains, smoothness(found, costs))
    return " ".join(t for t, k in zip(texts, kept) if k)


def extract(pages: DataFrame, costs: Costs = Costs(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(h, costs) for h in part.column("html").to_pylist()]
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    sent = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return sent.mapInArrow(run, "page_id long, url string, text string, n_chars long")
