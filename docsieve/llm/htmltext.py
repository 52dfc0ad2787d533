"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML's element kinds and the names that pages give to parts beside the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption dd dt html legend li option optgroup tbody td tfoot th thead tr".split())
CLOSED_BY_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
BESIDE_TAGS = frozenset(
    "head script style noscript template iframe noembed noframes object embed svg canvas audio video map nav aside footer form "
    "button select textarea input label dialog menu title".split()
)
NEVER_SHOWN = frozenset("head script style noscript template title".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BESIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adsense sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets footer footers foot notice notices cookie cookies "
    "consent gdpr privacy popup modal overlay alert toast newsletter subscribe subscription signup login comment comments commentlist "
    "disqus respond reply replies discussion share sharing social related recommended recommendations pagination pager toolbar masthead "
    "topbar search form skip".split()
)
#: Names of readers' comments; they count wherever they stand in a token.
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond".split())
#: Names that are also what an article may be about; inside one, headings and paragraphs of such a name stay.
SINGLE_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6".split())
AMBIGUOUS_NAMES = frozenset(
    "promotion notice notices cookie cookies consent gdpr privacy alert subscription discussion reply replies share sharing social related "
    "recommended recommendations search form foot rail comment comments overlay sponsor sponsored skip banner".split()
)
#: Words that only say where or how a part stands, and those that make a name a mark of state: "has-sidebar".
PLACE_WORDS = frozenset(
    "wrapper wrap container area list box left right top bottom slot unit bar block section inner outer panel primary secondary main "
    "mobile desktop sticky fixed links link item items group row column col".split()
)
STATE_ENDS = frozenset("open opened closed on off enabled disabled allowed count counter".split())
STATE_WORDS = frozenset("has have no not non with without is are hide hidden show enable enabled disable disabled".split())
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<loose>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """A page as lists in document order: elements with their parents, and texts between them."""

    def __init__(self, source: str):
        self.tags: list[str] = ["#root"]
        self.parents: list[int] = [-1]
        self.attrs: list[str] = [""]
        #: ``(element, text)``; a None text is a break that ends a block, a space one that does not.
        self.pieces: list[tuple[int, str | None]] = []
        stack = [0]
        #: The depths at which the open elements of each tag lie, so that an end tag without a start costs nothing.
        open_at: dict[str, list[int]] = {}
        at = 0

        def text(raw: str) -> None:
            if raw:
                self.pieces.append((stack[-1], html.unescape(raw)))

        def deepest(names: set[str] | frozenset[str]) -> int:
            return max((open_at[name][-1] for name in names if open_at.get(name)), default=0)

        def pop_to(names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
            depth = deepest(names)
            if not depth or deepest(stops) > depth:
                return
            if any(self.tags[node] in BLOCKS for node in stack[depth:]):
                self.pieces.append((stack[depth], None))
            for node in stack[depth:]:
                open_at[self.tags[node]].pop()
            del stack[depth:]

        while match := TOKEN.search(source, at):
            text(source[at : match.start()])
            at = match.end()
            if match["close"]:
                pop_to({match["close"].lower()}, frozenset())
                continue
            name = match["open"] or match["loose"]
            if not name:
                continue
            name = name.lower()
            if name in CLOSES_P:
                pop_to({"p"}, {"article", "section", "div", "td", "th", "table", "li", "button", "body"})
            if name in CLOSED_BY_SAME:
                same, stops = CLOSED_BY_SAME[name]
                for _ in range(3):
                    pop_to(same, stops)
            node = len(self.tags)
            self.tags.append(name)
            self.parents.append(stack[-1])
            self.attrs.append(match["attrs"] or "")
            if name in BLOCKS:
                self.pieces.append((stack[-1], None))
            elif name == "br":
                self.pieces.append((stack[-1], " "))
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif name not in VOID:
                open_at.setdefault(name, []).append(len(stack))
                stack.append(node)
        text(source[at:])


def head_word(token: str) -> str:
    """What a class or id token names: its last word but for those of place; empty for marks of state."""
    if token.lower() in BESIDE_NAMES:
        return token.lower()
    parts = [part.lower() for part in NAME_PART.findall(token)]
    if not parts or parts[0] in STATE_WORDS:
        return ""
    while len(parts) > 1 and parts[-1] in PLACE_WORDS:
        parts.pop()
    return parts[-1]


def beside_names(attrs: str) -> set[str]:
    """The names of parts beside the article that an element's class and id tokens give."""
    found = set()
    for key, a, b, c in ATTRIBUTE.findall(attrs):
        if key.lower() in ("class", "id"):
            for token in html.unescape(a or b or c).split():
                found.add(head_word(token))
                parts = [part.lower() for part in NAME_PART.findall(token)]
                if parts and parts[0] not in STATE_WORDS and parts[-1] not in STATE_ENDS:
                    found.update(COMMENT_NAMES.intersection(parts))
    return found & BESIDE_NAMES


def beside(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is by its kind, role or style a part beside the article."""
    if tag in BESIDE_TAGS or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for key, a, b, c in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "role":
            if value.lower() in BESIDE_ROLES:
                return True
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def drop_named(page: Page, kept: list[bool], in_article: list[bool]) -> None:
    """Take the parts that class or id names as beside the article out of ``kept``.

    An element stays if it holds every article, main or h1 element of the page, or, but for comments, most of the
    text outside links of the article around it, or of the page if that has no such element: an advert may be longer
    than the article.  Inside an article headings and paragraphs of ambiguous names stay.  An article element is
    looked at for comments only, and stays if the page has no other article, main or h1 element.
    """
    count = len(page.tags)
    named = {
        node: names
        for node in range(1, count)
        if kept[node] and page.attrs[node] and page.tags[node] not in ("html", "body", "main")
        and (names := beside_names(page.attrs[node])) and (page.tags[node] != "article" or names & COMMENT_NAMES)
    }
    if not named:
        return
    kinds = ("article", "main", "h1")
    free, in_link = [0] * count, [False] * count
    holds = {kind: [0] * count for kind in kinds}
    for node in range(1, count):
        in_link[node] = page.tags[node] == "a" or in_link[page.parents[node]]
        # A comment is not an article of the page.
        if kept[node] and page.tags[node] in kinds and not named.get(node, set()) & COMMENT_NAMES:
            holds[page.tags[node]][node] = 1
    for node, piece in page.pieces:
        if piece and kept[node] and not in_link[node]:
            free[node] += len("".join(piece.split()))
    for node in range(count - 1, 0, -1):
        if kept[node]:
            parent = page.parents[node]
            free[parent] += free[node]
            for counts in holds.values():
                counts[parent] += counts[node]
    article = [0] * count
    for node in range(1, count):
        parent = page.parents[node]
        article[node] = node if page.tags[node] in ("article", "main") else article[parent]
        if not kept[parent]:
            kept[node] = False
        elif kept[node] and node in named:
            around, comments = article[parent], named[node] & COMMENT_NAMES
            if page.tags[node] == "article" and not around and not any(counts[0] for counts in holds.values()):
                continue
            whole = any(counts[0] and counts[node] == counts[0] for counts in holds.values())
            if not comments and (around or not any(counts[0] for counts in holds.values())):
                whole = whole or 2 * free[node] > free[around]
            single = in_article[parent] and page.tags[node] in SINGLE_BLOCKS and not comments
            kept[node] = whole or (single and named[node] <= AMBIGUOUS_NAMES)


def densities(page: Page, kept: list[bool], body: int) -> tuple[list[float], list[float]]:
    """Composite text density of every element, and the sum of its children's.

    Characters per tag, adjusted for links: the logarithm of characters and tags
    over those in links, to a base that grows with the element's share of link
    characters against the body's.  Zero divisors count as 1.
    """
    count = len(page.tags)
    chars, link_chars, tags, link_tags = [0] * count, [0] * count, [0] * count, [0] * count
    in_link = [False] * count
    for node in range(1, count):
        in_link[node] = page.tags[node] == "a" or in_link[page.parents[node]]
    for node, piece in page.pieces:
        if piece and kept[node]:
            size = len("".join(piece.split()))
            chars[node] += size
            if in_link[node]:
                link_chars[node] += size
    for node in range(count - 1, 0, -1):
        if kept[node]:
            parent = page.parents[node]
            chars[parent] += chars[node]
            link_chars[parent] += link_chars[node]
            tags[parent] += tags[node] + 1
            link_tags[parent] += link_tags[node] + (page.tags[node] == "a")
    shared = link_chars[body] / max(1, chars[body])
    density, total = [0.0] * count, [0.0] * count
    for node in range(count - 1, -1, -1):
        if not kept[node] or not chars[node]:
            continue
        c, lc, t, lt = chars[node], max(1, link_chars[node]), max(1, tags[node]), max(1, link_tags[node])
        base = math.log(c / max(1, c - link_chars[node]) * link_chars[node] + shared * c + math.e)
        density[node] = c / t * max(0.0, math.log(max(1.0, c / lc * t / lt)) / base)
        if node:
            total[page.parents[node]] += density[node]
    return density, total


def article_root(page: Page, kept: list[bool], path: list[int]) -> int:
    """The element on a path (from its lowest node up) all of which, but for its beside parts, is the article.

    The outermost article, else the outermost main element; without either the
    highest node to which no beside part is added: neither an element that was
    left out, but for those never shown, nor a block most of whose text is links.
    """
    for tag in ("article", "main"):
        found = [node for node in path if page.tags[node] == tag]
        if found:
            return found[-1]
    count = len(page.tags)
    chars, link_chars, in_link = [0] * count, [0] * count, [False] * count
    for node in range(1, count):
        in_link[node] = page.tags[node] == "a" or in_link[page.parents[node]]
    for node, piece in page.pieces:
        if piece and kept[node]:
            size = len("".join(piece.split()))
            chars[node] += size
            link_chars[node] += size * in_link[node]
    on_path, holds = set(path), [False] * count
    for node in range(count - 1, 0, -1):
        parent = page.parents[node]
        chars[parent] += chars[node]
        link_chars[parent] += link_chars[node]
        if kept[node]:
            part = holds[node] or (page.tags[node] in BLOCKS and 2 * link_chars[node] > chars[node])
        else:
            part = page.tags[node] not in NEVER_SHOWN
        if part and node not in on_path:
            holds[parent] = True
    root = path[0]
    for node in path[1:]:
        if holds[node]:
            break
        root = node
    return root


def main_text(source: str | None) -> str:
    """The article of a page, one line per block; empty if there is none.

    Parts that their element, role, class or id name as menus, headers, footers,
    sidebars, notices, adverts, forms, comments or scripts are left out first;
    class and id tokens count by their head word (see ``drop_named``).
    The subtree whose children's densities have the largest sum is the article.
    All of the element that ``article_root`` finds around it belongs to it, text
    between elements too.  The smallest density on the path from there to the
    body is the threshold: beside that path, subtrees at least as dense belong to
    it too, and so do first headings before it.
    """
    if not source:
        return ""
    page = Page(source)
    count = len(page.tags)
    kept, in_article = [True] * count, [False] * count
    for node in range(1, count):
        parent = page.parents[node]
        kept[node] = kept[parent] and not beside(page.tags[node], page.attrs[node], in_article[parent])
        in_article[node] = in_article[parent] or page.tags[node] in ("article", "main")
    drop_named(page, kept, in_article)
    body = next((node for node in range(count) if page.tags[node] == "body"), 0)
    density, total = densities(page, kept, body)
    inside = [False] * count
    inside[body] = True
    for node in range(body + 1, count):
        inside[node] = inside[page.parents[node]]
    best = max((node for node in range(count) if inside[node] and kept[node]), key=lambda node: (total[node], -node))
    if total[best] <= 0:
        best = body
    path, node = [], best
    while node != body:
        path.append(node)
        node = page.parents[node]
    path.append(body)
    threshold = min(density[node] for node in path)
    best = article_root(page, kept, path)
    path = path[path.index(best) :]
    on_path, chosen = set(path), [False] * count
    for node in range(count):
        if not kept[node] or not inside[node]:
            continue
        parent = page.parents[node]
        if node == best or (parent >= 0 and chosen[parent]):
            chosen[node] = True
        elif parent in on_path and node not in on_path and page.tags[node] in BLOCKS:
            heading = page.tags[node] == "h1" and node < best
            chosen[node] = heading or (density[node] >= threshold > 0)
    blocks, current = [], []
    for node, piece in page.pieces:
        if piece is None:
            blocks.append("".join(current))
            current = []
        elif chosen[node]:
            current.append(piece)
    blocks.append("".join(current))
    return "\n".join(block for block in (" ".join(block.split()) for block in blocks) if block)


def extract_main_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(id, url, text, n_chars)``: the main text of every page.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed and joined by a line feed in page order.  Pages
    that are null, empty or hold no article give an empty text; rows that repeat
    are returned as often; an empty table gives no rows; other columns are ignored.
    """
    chosen = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py()) for source in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, url string, text string, n_chars bigint")
