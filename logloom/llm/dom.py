"""Block trees of HTML pages: a tolerant reader, and simple tree matching between two trees.

A tree has a node for each block element and a leaf for each run of text between block borders.
Inline elements belong to the text around them. Elements left open end where HTML says so.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCKS - frozenset("body html caption dd dt legend li optgroup option tbody td tfoot th thead tr".split())
#: What an opening tag ends, and the elements beyond which it ends nothing.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
WALLS = frozenset("table td th caption button object template".split())
#: Their content is not text of the page.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg canvas "
                "audio video object".split())
IN_HEAD = RAW | VOID

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)"""
    r"""((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=|["'])*+)(>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

#: Words in class or id that mark what is not the article. Fixed values.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
                    "promotion".split())
BESIDE = ADVERTS | frozenset(
    "aside banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus "
    "foot footer form login menu modal nav navbar navigation newsletter notice notification overlay pager "
    "pagination popup recommended related replies respond share sharing sidebar signup skip social subscribe "
    "toolbar widget".split())
TOPS = frozenset("head header masthead topbar".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                  "search toolbar".split())
HARD = frozenset("nav aside footer form menu select dialog head fieldset button frameset".split())
ATTACHED = frozenset("has with no without is not".split())
STATES = frozenset("open closed enabled disabled on off".split())

DEPTH = 150


class Node:
    __slots__ = ("label", "tag", "kids", "text", "links", "mark", "holds", "words", "slot")

    def __init__(self, tag: str, label: str, mark: str = "", words: frozenset = frozenset(),
                 text: str | None = None, links: int = 0):
        self.tag, self.label, self.mark, self.words = tag, label, mark, words
        self.kids, self.text, self.links = [], text, links
        self.holds, self.slot = False, -1


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}


def class_words(found: dict[str, str]) -> frozenset:
    """Words of class and id names; `has-sidebar` and `comments-open` speak of something else."""
    words = set()
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [p.lower() for p in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)]
        if parts and parts[0] not in ATTACHED and parts[-1] not in STATES:
            words.update(parts)
    return frozenset(words)


def mark_of(tag: str, found: dict[str, str], words: frozenset) -> str:
    """`hard` for what is never the article, `beside` or `top` for what its names say, or nothing."""
    if tag in HARD or found.get("role", "").lower() in ROLES or "hidden" in found or (
            found.get("aria-hidden") == "true"):
        return "hard"
    if words & BESIDE:
        return "beside"
    return "top" if tag == "header" or words & TOPS else ""


def tree(page: str) -> Node:
    """The block tree of `page`."""
    root = Node("#root", "#root")
    #: Open elements: tag, block node, whether text in it counts, whether it is within a link.
    stack = [("#root", root, True, False)]
    buffer: list[str] = []
    links = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal links
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                stack[-1][1].kids.append(Node("#", "#", text=text, links=links))
            buffer.clear()
        links = 0

    def close(place: int) -> None:
        """End the open elements from `place` on."""
        while len(stack) > place:
            if stack[-1][0] in BLOCKS:
                flush()
            stack.pop()

    def say(raw: str) -> None:
        nonlocal links
        tag, _, counts, linked = stack[-1]
        if tag == "head" and raw.strip():
            close(len(stack) - 1)
            _, _, counts, linked = stack[-1]
        if counts:
            text = html.unescape(raw) if "&" in raw else raw
            buffer.append(text)
            if linked:
                links += len(text)

    while at < end:
        found = TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None or not found[4]:  # comment, declaration, or a tag that the page's end cut off
            continue
        tag = name.lower()
        if found[1]:
            if tag == "br":
                buffer.append(" ")
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] == tag:
                    close(place)
                    break
                if tag not in BLOCKS and stack[place][0] in BLOCKS or (
                        stack[place][0] in WALLS and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")):
                    break
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            if not found[3].endswith("/"):
                at = closing.end() if closing else end
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in ("html", "body") and any(s[0] == tag for s in stack):
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in ENDS_P:
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] == "p":
                    close(place)
                    break
                if stack[place][0] in WALLS:
                    break
        if tag in ENDS:
            ended, walls = ENDS[tag]
            first = None
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] in walls:
                    break
                if stack[place][0] in ended:
                    first = place
                    if tag in ("li", "dt", "dd", "option"):
                        break
            if first is not None:
                close(first)
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6"):
            close(len(stack) - 1)
        given = attributes(found[3])
        words = class_words(given) if given else frozenset()
        _, parent, counts, linked = stack[-1]
        if tag in BLOCKS or tag == "head":
            flush()
            node = parent
            if len(stack) < DEPTH:
                # a class names the kind of a node unless it is numbered
                kind = re.sub(r"\d+", "", given.get("class", "")) if given else ""
                node = Node(tag, f"{tag}.{kind}" if kind else tag, mark_of(tag, given, words), words)
                if given.get("role") == "main" or given.get("itemprop") == "articleBody":
                    node.tag = "main"
                parent.kids.append(node)
            if tag == "hr":
                continue
            if tag in ("article", "main") or node.tag == "main":
                for _, above, _, _ in stack:
                    above.holds = True
            stack.append((tag, node, counts, linked))
        else:
            shown = not (words & ADVERTS or "hidden" in given or tag == "button")
            if not found[3].endswith("/"):
                stack.append((tag, parent, counts and shown, linked or tag == "a"))
    flush()
    return root


def skipped(node: Node, inside: bool) -> bool:
    """Whether the node is no part of an article; `inside` tells if one has begun above it."""
    if node.tag in ("html", "body", "main", "#root", "#") or not node.mark:
        return False
    if node.mark == "hard":
        return not (node.tag == "form" and node.holds)
    return not node.holds and (node.mark == "beside" or not inside)


def roots(tree: Node) -> tuple[list[Node], bool]:
    """The nodes that hold the article, and whether the page says so itself."""
    articles, mains, named = [], [], []

    def visit(node: Node) -> None:
        for kid in node.kids:
            if kid.text is not None:
                continue
            if kid.tag == "article":
                articles.append(kid)
                continue
            if skipped(kid, False):
                continue
            if kid.tag == "main":
                mains.append(kid)
            elif kid.words and ("article" in kid.words or kid.words & {"content", "body", "text"} and (
                    kid.words <= {"content"} or kid.words & {"post", "entry", "story", "main", "page"})):
                named.append(kid)
            visit(kid)

    visit(tree)
    plain = [a for a in articles if a.mark != "beside"] or articles
    for some in (plain, mains[:1], named[:1]):
        if some and any(leaves(n, True) for n in some):
            return some, True
    return [tree], False


def leaves(node: Node, inside: bool) -> list[Node]:
    """Text leaves of a node that are part of the article, in page order."""
    out = []
    for kid in node.kids:
        if kid.text is not None:
            out.append(kid)
        elif not skipped(kid, inside):
            out += leaves(kid, inside)
    return out


def article(tree: Node) -> tuple[list[Node], bool]:
    """Leaves of the article, and whether the page marks it. Unmarked, link lists are menus."""
    found, marked = roots(tree)
    texts = [x for n in found for x in leaves(n, marked)]
    if not marked:
        texts = [x for x in texts if 10 * x.links < 8 * len(x.text)]
    return texts, marked


def numbered(tree: Node) -> int:
    """Give every leaf its slot number."""
    count, todo = 0, [tree]
    while todo:
        node = todo.pop()
        if node.text is not None:
            node.slot, count = count, count + 1
        todo.extend(reversed(node.kids))
    return count


#: Sibling lists with more pairs than this are aligned in bounded memory, with equal results.
CELLS = 250_000


def signature(node: Node) -> tuple | None:
    """Label and text of a leaf or of an element with one leaf."""
    if node.text is not None:
        return node.label, node.text
    if len(node.kids) == 1 and node.kids[0].text is not None:
        return node.label, node.kids[0].text
    return None


def collapsed(kids: list[Node], shared: set) -> list[Node | list[Node]]:
    """Siblings with runs of simple ones of a kind, whose texts the other side lacks, as one item."""
    out: list[Node | list[Node]] = []
    for kid in kids:
        own = signature(kid)
        if own is None or own in shared:
            out.append(kid)
        elif out and isinstance(out[-1], list) and out[-1][0].label == kid.label:
            out[-1].append(kid)
        else:
            out.append([kid])
    return out


def match(a: Node, b: Node) -> tuple[int, list]:
    """Simple tree matching: size of the largest ordered match, and its pairs of leaves.

    Roots must have the same label. Leaves count twice if their texts agree.
    """
    if a.label != b.label:
        return 0, []
    if a.text is not None:
        return 1 + (a.text == b.text), [(a, b)]
    if not a.kids or not b.kids:
        return 1, []
    shared = {signature(k) for k in a.kids} & {signature(k) for k in b.kids}
    left, right = collapsed(a.kids, shared), collapsed(b.kids, shared)
    if len(left) * len(right) > CELLS:
        return aligned(left, right)

    table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    found = {}
    for i, x in enumerate(left):
        row, above = table[i + 1], table[i]
        for j, y in enumerate(right):
            score, pairs = pair(x, y)
            if score:
                found[i, j] = score, pairs
            row[j + 1] = max(above[j] + score, above[j + 1], row[j])
    i, j, out = len(left), len(right), []
    while i and j:
        score, pairs = found.get((i - 1, j - 1), (0, []))
        if score and table[i][j] == table[i - 1][j - 1] + score:
            out += pairs
            i, j = i - 1, j - 1
        elif table[i][j] == table[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + table[-1][-1], out


def pair(x: Node | list[Node], y: Node | list[Node]) -> tuple[int, list]:
    """Match of two siblings; a run of simple ones matches a run of its kind."""
    if isinstance(x, list) or isinstance(y, list):
        simple = isinstance(x, list) and isinstance(y, list) and x[0].label == y[0].label
        return (1, []) if simple else (0, [])
    return match(x, y)


def aligned(left: list, right: list) -> tuple[int, list]:
    """The match of two long lists of siblings, as the full table gives it.

    Only every so many rows of the table are kept; those between are made again on the way back.
    """
    scores = Scores(left, right)
    step = math.isqrt(len(left)) + 1

    def below(above: np.ndarray, found: np.ndarray) -> np.ndarray:
        row = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[:-1] + found, above[1:]), out=row[1:])
        return row

    row, kept = np.zeros(len(right) + 1, dtype=np.int64), []
    for i, x in enumerate(left):
        if i % step == 0:
            kept.append(row)
        row = below(row, scores.row(x))
    best = int(row[-1])
    j, out = len(right), []
    for first in range((len(kept) - 1) * step, -1, -step):
        some = left[first : first + step]
        block, own = [kept[first // step]], [scores.row(x) for x in some]
        for found in own:
            block.append(below(block[-1], found))
        i = len(some)
        while i and j:
            here, above = block[i], block[i - 1]
            score = own[i - 1][j - 1]
            if score and here[j] == above[j - 1] + score:
                out += pair(some[i - 1], right[j - 1])[1]
                i, j = i - 1, j - 1
            elif here[j] == above[j]:
                i -= 1
            else:
                j -= 1
    return 1 + best, out


def described(x: Node | list[Node], kinds: dict) -> tuple:
    """Label (and if it is a run), number of the shape, and texts of a sibling."""
    if isinstance(x, list):
        return (x[0].label, True), -1, frozenset()
    texts = set()

    def shape(node: Node) -> int:
        if node.text is not None:
            texts.add(node.text)
            return kinds.setdefault((node.label, None), len(kinds))
        return kinds.setdefault((node.label, tuple(map(shape, node.kids))), len(kinds))

    return (x.label, False), shape(x), frozenset(texts)


def strange(node: Node) -> Node:
    """The node with texts that equal no others."""
    copy = Node(node.tag, node.label)
    copy.text = None if node.text is None else object()
    copy.kids = [strange(k) for k in node.kids]
    return copy


class Scores:
    """Scores of `pair` for each of `left` against all of `right`.

    Where two siblings have no text in common, the score depends on their shapes alone and is computed
    one time. What is remembered is bounded; the rest is computed again.
    """

    def __init__(self, left: list, right: list):
        kinds: dict = {}
        self.right, self.kept, self.known, self.rows = right, 0, {}, {}
        self.left = {id(x): described(x, kinds) for x in left}
        self.of_right = [described(y, kinds) for y in right]
        self.holding: dict = {}
        first: dict = {}
        for j, (kind, shape, texts) in enumerate(self.of_right):
            first.setdefault((kind, shape), j)
            for text in texts:
                self.holding.setdefault((kind, text), []).append(j)
        self.shapes = {key: n for n, key in enumerate(first)}
        self.examples = [(key, right[j]) for key, j in first.items()]
        self.shape_of = np.array([self.shapes[d[:2]] for d in self.of_right])

    def remember(self, where: dict, key, value, size: int):
        if self.kept + size <= 16 * CELLS:
            where[key] = value
            self.kept += size
        return value

    def by_shape(self, x: Node | list[Node]) -> np.ndarray:
        kind, shape, _ = self.left[id(x)]
        if (kind, shape) in self.known:
            return self.known[kind, shape]
        bare = x if kind[1] else strange(x)
        found = np.array([0 if key[0] != kind else 1 if kind[1] else match(bare, strange(y))[0]
                          for key, y in self.examples], dtype=np.int64)
        return self.remember(self.known, (kind, shape), found, len(found))

    def by_text(self, x: Node | list[Node]) -> tuple[np.ndarray, np.ndarray]:
        if id(x) in self.rows:
            return self.rows[id(x)]
        kind, _, texts = self.left[id(x)]
        met = sorted({j for t in texts for j in self.holding.get((kind, t), ())})
        found = np.array(met, dtype=np.int32), np.array([match(x, self.right[j])[0] for j in met], dtype=np.int64)
        return self.remember(self.rows, id(x), found, len(met))

    def row(self, x: Node | list[Node]) -> np.ndarray:
        out = self.by_shape(x)[self.shape_of]
        met, found = self.by_text(x)
        out[met] = found
        return out
