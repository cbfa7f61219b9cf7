"""HTML extraction by minimum cut.

A page becomes a sequence of text blocks with their places in the element
tree. A classifier, trained on blocks whose elements say what they are
(article and main against nav, footer, aside and the like), gives each block a
cost for either label; the costs become its terminal capacities. Blocks next
to each other, and blocks below one parent, are joined by smoothness edges
that weaken with their distance in the tree. The minimum cut is the cheapest
labelling. Blocks whose own cost outweighs all their edges are settled first,
which keeps the minimum; a max-flow settles the rest.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import small_batches, utf8

#: The classifier is fitted on at most so many pages (smallest hashes of the id).
MAX_PAGES = 1500
#: Cost of contradicting an element that names its role, in the classifier's log-odds.
ROLE_COST = 8.0
#: Cost of contradicting a class or id word, for an element with little of its surroundings' text; less, the more it has.
#: The classifier (4 at most) and the edges of a block (3 at most) can outvote it.
WORD_COST = 6.0
#: An element with such a share of its surroundings' text keeps their role, whatever its class and id say.
MOSTLY = 0.75
#: Capacity of the edge between neighbouring blocks of one parent, and of blocks of one parent that are not neighbours.
NEXT, SIBLING = 1.2, 0.3
SCALE = 1 << 16

# Element names of the HTML standard, by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noframes".split())
# Elements whose text is no text of the page. Their tags count, as end tags may be missing.
UNSHOWN = frozenset("noscript template object svg select datalist optgroup option".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input "
    "math mi mo mn ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction semantics".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# What cannot stand in a form's list or a drawing: it ends one that was not closed.
ENDS_LISTS = CLOSES_P - {"div", "hr"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT_TAGS, BOILER_TAGS = frozenset("article main".split()), frozenset("nav footer aside form menu dialog header button fieldset head".split())
CONTENT_ROLES, BOILER_ROLES = frozenset("main article".split()), frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar toolbar status alertdialog".split())
# Words of class and id attributes that name boilerplate.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login sidebar sidebars widget widgets related recommended recommendations share sharing social comment comments disqus reply replies respond nav navbar navigation menu menus "
    "breadcrumb breadcrumbs footer header masthead pagination pager toolbar search skip".split()
)

# First words of class and id names that name reader comments, and words behind them that tell a state of the page instead.
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
COMMENT_STATES = frozenset("open closed enabled disabled on off page template".split())

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)|=)*+)>|[!?/][^>]*>)""", re.S)
_ATTR = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Tree:
    """Block-level elements by number: the parent and the depth of each. Element 0 is the page."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def distance(self, a: int, b: int) -> int:
        """Steps from one element to the other. Over blocks in page order they sum to no more than the page's tags."""
        steps = 0
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            steps += 1
        return steps


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    element: int  # number of the innermost block-level element around it
    tree: Tree
    role: int  # 1: inside content elements, -1: inside boilerplate elements, 0: neither says
    features: np.ndarray = field(default_factory=lambda: np.empty(0))
    mark: int = -1  # number of the innermost element around it whose class or id names boilerplate, of those inside the same content element
    scope: int = 0  # number of the innermost content element around it, 0: the page
    cost: float = 0.0  # of keeping the block, by class and id words


def _names_comments(value: str) -> bool:
    names = [_WORDS.findall(name) for name in value.split()]
    return any(n and n[0] in COMMENT_WORDS and not COMMENT_STATES & set(n[1:]) for n in names)


def _role(name: str, attrs: str, outer: int, parent: str, in_comments: bool) -> tuple[int, bool, bool, bool]:
    """The role that an element gives its blocks (its own, else that of the elements around it), whether its class or id names boilerplate, whether it is a content element, and whether it holds reader comments.

    What stands inside comments is a comment, an article too. A content element that is in no other is never taken for
    comments by its class or id.
    """
    if in_comments:
        return -1, False, False, True
    if name in BOILER_TAGS and not (name == "header" and outer > 0):
        return -1, False, False, False
    found, worded = 0, False
    if attrs.strip():
        for key, *values in _ATTR.findall(attrs):
            key, value = key.lower(), "".join(values).lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return -1, False, False, False
            if key == "role" and (roles := set(value.split())):
                found = -1 if roles & BOILER_ROLES else 1 if roles & CONTENT_ROLES else found
            if key in ("class", "id") and name not in ("html", "body"):
                if _names_comments(value) and (outer > 0 or name not in CONTENT_TAGS):
                    return -1, False, False, True
                worded = worded or bool(set(_WORDS.findall(value)) & BOILER_WORDS)
    if name in CONTENT_TAGS:
        found = -1 if found < 0 or outer < 0 and parent in ("aside", "nav", "footer") else 1
    return found or outer, worded and not found, found > 0, False


def _weigh_words(out: list[Block], marks: list[tuple[int, int]], holds: list[bool], scopes: list[int]) -> None:
    """Turn class and id words into costs of their blocks; ``marks``: (mark around it, scope) of each worded element, ``scopes``: the scope around each.

    An element that holds a content element costs nothing. Text of boilerplate elements does not count towards shares.
    """
    in_mark, in_scope = [0] * len(marks), [0] * len(scopes)
    for b in out:
        if b.role >= 0:
            in_scope[b.scope] += len(b.text)
            if b.mark >= 0:
                in_mark[b.mark] += len(b.text)
    for m in range(len(marks) - 1, -1, -1):
        if marks[m][0] >= 0:
            in_mark[marks[m][0]] += in_mark[m]
    for k in range(len(scopes) - 1, 0, -1):
        in_scope[scopes[k]] += in_scope[k]
    costs: list[tuple[float, bool]] = []  # of each mark with those around it: the greatest cost, and whether all have most of the text
    for m, (outer, scope) in enumerate(marks):
        cost, mostly = costs[outer] if outer >= 0 else (0.0, True)
        if not holds[m]:
            share = in_mark[m] / max(1, in_scope[scope])
            cost, mostly = max(cost, WORD_COST * (1 - share)), mostly and share >= MOSTLY
        costs.append((cost, mostly))
    for b in out:
        if b.mark >= 0 and b.role >= 0:
            b.cost, mostly = costs[b.mark]
            b.role = b.role if mostly else 0


def _stays_unshown(name: str, closing: bool, attrs: str, unshown: list[str], opened: Counter) -> bool:
    """Whether a tag inside an unshown element concerns that element alone; else the element ends before it."""
    if closing:
        for k in range(len(unshown) - 1, -1, -1):
            if unshown[k] == name:
                del unshown[k:]
                return True
        # the end tag of an element around it
        if not opened[name]:
            return True
    elif name == "body" and not opened["body"]:
        pass
    elif name in ENDS_LISTS and not {"template", "noscript", "object", "foreignobject"} & set(unshown):
        pass
    else:
        if name in ("option", "optgroup") and unshown[-1] in ("option", name):
            unshown.pop()
        if name not in VOID and not attrs.endswith("/"):
            unshown.append(name)
        return True
    unshown.clear()
    return False


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order. White space inside a block is one space, character references are decoded."""
    out: list[Block] = []
    tree = Tree()
    # of each open block-level element: name, role, number, mark, scope, whether it holds reader comments
    stack: list[tuple[str, int, int, int, int, bool]] = [("", 0, 0, -1, 0, False)]
    opened: Counter[str] = Counter()
    marks: list[tuple[int, int]] = []
    holds: list[bool] = []  # of each mark: whether a content element is inside
    scopes = [-1]
    text: list[str] = []
    linked, in_link = 0, 0
    # an unshown element that is open and the elements opened inside it
    unshown: list[str] = []

    def flush() -> None:
        nonlocal text, linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append(Block(joined, min(linked, len(joined)), stack[-1][0], stack[-1][2], tree, stack[-1][1], mark=stack[-1][3], scope=stack[-1][4]))
        text, linked = [], 0

    def leave(k: int) -> None:
        for s in stack[k:]:
            opened[s[0]] -= 1
        del stack[k:]

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not unshown:
            piece = html_lib.unescape(raw)
            text.append(piece)
            if in_link:
                linked += len(piece.strip())

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        say(page[at:lt])
        m = _TAG.match(page, lt)
        if m is None:
            if page[lt + 1 : lt + 2].isalpha() or page[lt + 1 : lt + 2] in ("/", "!", "?"):
                if page.find(">", lt) < 0:  # the page ends inside a tag
                    break
            say("<")
            at = lt + 1
            continue
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"])
        if unshown and name not in RAW and _stays_unshown(name, closing, m["attrs"], unshown, opened):
            continue
        if name in ("br", "mtd", "annotation", "annotation-xml"):
            text.append(" ")
        elif name in UNSHOWN:
            if not closing and not (name == "svg" and m["attrs"].endswith("/")):
                unshown.append(name)
        elif name in RAW:
            if not closing and not m["attrs"].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end
        elif name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
        elif closing:
            flush()
            in_link = 0
            if opened[name]:
                leave(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
        else:
            flush()
            in_link = 0
            if name == "body":  # what stands in the head ends here
                leave(1)
            while len(stack) > 1 and (name in CLOSES_P and stack[-1][0] == "p" or name == stack[-1][0] and name in ("li", "p", "dt", "dd", "tr", "td", "th")):
                leave(len(stack) - 1)
            if name not in VOID:
                mark, scope, in_comments = stack[-1][3:]
                role, worded, content, in_comments = _role(name, m["attrs"], stack[-1][1], stack[-1][0], in_comments)
                if content:
                    held = mark
                    while held >= 0 and not holds[held]:
                        holds[held], held = True, marks[held][0]
                    scopes.append(scope)
                    mark, scope = -1, len(scopes) - 1
                elif worded:
                    marks.append((mark, scope))
                    holds.append(False)
                    mark = len(marks) - 1
                if name in HEADINGS and not in_comments and stack[-1][0] == "header" and any(opened[c] for c in CONTENT_TAGS):
                    role, mark = 1, -1
                stack.append((name, role, tree.add(stack[-1][2]), mark, scope, in_comments))
                opened[name] += 1
    flush()
    _weigh_words(out, marks, holds, scopes)
    return out


FEATURES = 10


def features_of(found: list[Block]) -> np.ndarray:
    """What the classifier sees of each block: lengths, links, punctuation, element, neighbours; not its role."""
    if not found:
        return np.zeros((0, FEATURES))
    n = np.array([len(b.text) for b in found], float)
    link = np.array([b.linked for b in found]) / n
    stops = np.array([sum(b.text.count(c) for c in ".!?,;:") for b in found]) / n
    words = np.array([b.text.count(" ") + 1 for b in found], float)
    log = np.log1p(words)
    beside = np.concatenate(([0.0], log, [0.0]))
    around = 0.5 * (beside[:-2] + beside[2:])
    return np.column_stack(
        (
            np.ones(len(found)),
            log,
            link,
            np.minimum(20 * stops, 2),
            [b.tag == "p" for b in found],
            [b.tag in HEADINGS for b in found],
            [b.tag in ("li", "td", "dd", "dt") for b in found],
            around,
            np.arange(len(found)) / len(found),
            words < 6,
        )
    ).astype(float)


def fit(rows: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, both labels weighing alike. With one label only: all weights zero."""
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(FEATURES)
    weight = 0.5 * counts / np.where(labels > 0, counts[labels > 0].sum(), counts[labels == 0].sum())
    w = np.zeros(FEATURES)
    for _ in range(30):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        grad = rows.T @ (weight * (p - labels)) + 1e-3 * w
        hess = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(FEATURES)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def edges_of(found: list[Block]) -> list[tuple[int, int, float]]:
    if not found:
        return []
    tree = found[0].tree
    out = [(k, k + 1, 2 * NEXT / (1 + max(1, tree.distance(found[k].element, found[k + 1].element)))) for k in range(len(found) - 1)]
    last: dict[int, int] = {}
    for k, b in enumerate(found):
        parent = tree.parent[b.element]
        if parent in last and last[parent] < k - 1:
            out.append((last[parent], k, SIBLING))
        last[parent] = k
    return out


def minimum_cut(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling that maximises the gains of the True nodes minus the capacities of edges between different labels.

    Of several such labellings, the one with the fewest True nodes.
    """
    n = len(gains)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b and c > 0:
            near[a][b] = near[a].get(b, 0) + c
            near[b][a] = near[b].get(a, 0) + c
    gains = list(gains)
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # nodes that outweigh their edges
        k = todo.popleft()
        if label[k] is not None:
            continue
        bound = sum(near[k].values())
        if gains[k] > bound or -gains[k] >= bound:
            label[k] = gains[k] > bound
            for j, c in near[k].items():
                gains[j] += c if label[k] else -c
                del near[j][k]
                todo.append(j)
            near[k] = {}
    open_nodes = [k for k in range(n) if label[k] is None]
    if open_nodes:
        inside = _source_side(open_nodes, gains, near)
        for k in open_nodes:
            label[k] = k in inside
    return [bool(x) for x in label]


def _source_side(nodes: list[int], gains: list[int], near: list[dict[int, int]]) -> set[int]:
    """Nodes on the source's side of a minimum cut: shortest augmenting paths in levels (Dinic)."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {k: dict(near[k]) for k in nodes}
    room[source], room[sink] = {}, {}
    for k in nodes:
        if gains[k] > 0:
            room[source][k] = gains[k]
            room[k][source] = 0
        elif gains[k] < 0:
            room[k][sink] = -gains[k]
            room[sink][k] = 0

    def levels() -> dict[int, int]:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for b, c in room[a].items():
                if c > 0 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    while sink in (level := levels()):
        tries = {k: iter(list(room[k])) for k in room}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(room[x][y] for x, y in zip(path, path[1:], strict=False))
                cut = 0
                for i, (x, y) in enumerate(zip(path, path[1:], strict=False)):
                    room[x][y] -= flow
                    room[y][x] = room[y].get(x, 0) + flow
                    if not room[x][y] and not cut:
                        cut = i + 1
                del path[cut:]
                # the node before the cut edge goes on where it was
                if path:
                    tries[path[-1]] = iter([y for y in list(room[path[-1]]) if room[path[-1]][y] > 0 and level.get(y) == level[path[-1]] + 1])
                continue
            for b in tries[a]:
                if room[a].get(b, 0) > 0 and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                level[a] = -9  # a dead end in this round
                path.pop()
    return set(levels()) - {source}


def extract_text(page: str, weights: np.ndarray) -> str:
    found = blocks_of(page)
    if not found:
        return ""
    gains = np.clip(features_of(found) @ weights, -4, 4) + ROLE_COST * np.array([b.role for b in found]) - np.array([b.cost for b in found])
    labels = minimum_cut([int(g * SCALE) for g in gains], [(a, b, int(c * SCALE)) for a, b, c in edges_of(found)])
    return "\n\n".join(b.text for b, keep in zip(found, labels, strict=True) if keep)


def train(pages: DataFrame, max_pages: int = MAX_PAGES) -> np.ndarray:
    """Classifier weights from a bounded sample of (page_id, html). Blocks are read on the executors; the driver gets their numbers."""
    small_batches(pages.sparkSession)
    sample = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)

    def read_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page_id, page in zip(batch["page_key"], batch["html"], strict=True):
                found = blocks_of(utf8(page).decode("utf-8", "replace"))
                rows = [(page_id, b.role, f.tolist()) for b, f in zip(found, features_of(found), strict=True) if b.role]
                yield pd.DataFrame({"page_key": [r[0] for r in rows], "role": [r[1] for r in rows], "row": [r[2] for r in rows]}, dtype=object)

    own = pages.select("page_id", "html").join(F.broadcast(sample), "page_id").select(F.col("page_id").cast("string").alias("page_key"), "html")
    # each distinct (role, rounded features) once with its count, so pages of many blocks stay small here
    rows = own.mapInPandas(read_blocks, "page_key string, role int, row array<double>")
    rounded = rows.select("role", F.transform("row", lambda x: F.round(x, 1)).alias("row")).groupBy("role", "row").agg(F.count("*").alias("n"))
    got = rounded.toPandas()
    if not len(got):
        return np.zeros(FEATURES)
    got["key"] = got["row"].map(lambda r: tuple(map(float, r)))
    got = got.sort_values(["role", "key"], kind="stable")
    return fit(np.array(got["key"].tolist()), (got["role"].to_numpy() > 0).astype(float), got["n"].to_numpy(float))


def main_text(page: Column, weights: np.ndarray) -> Column:
    """Main text of an html column; '' where a page is null, empty, or has no main text. Repeated pages get equal texts."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(weights)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([extract_text(utf8(p).decode("utf-8", "replace"), shared.value) for p in pages], dtype=object)

    return text(page)
