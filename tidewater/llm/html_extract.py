"""Main text of web pages by wrapper induction.

Pages of one host share a template. A few pages per host (``SAMPLES``, those
with the smallest hashes) are parsed into DOM trees and aligned by simple tree
matching: two nodes match if their keys (tag, first class or id) are equal, and
the children of matched nodes are matched in order for the largest common tree.
Runs of equal siblings count as one repeated node. A template node whose text
is the same on all pages it matches is constant, others are slots. The wrapper
of the host is the path to the lowest container that holds all the slots' text
(all in article and main elements, if these hold a quarter);
menus, adverts, forms and the like hold none of it. Blocks whose text stands on
all of at least ``EVIDENCE`` different pages are constant too and are left out,
wherever they are; headings are not, nor is anything if over half the container's text
would go (then the pages are near copies). A wrapper is a few hundred bytes and its constants.

Every page is then read with its host's wrapper: the container is followed by
its path, or by aligning the page with the template where the path fails, and
all its text is taken in page order. A page with more text beside the container
than in it has another layout and is read by itself. Wrappers are joined to the pages, so
Spark chooses by size whether to broadcast them; a host with a third of the
pages is split like any hot join key.
"""

from __future__ import annotations

import html
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

SAMPLES = 5                     # pages per host that its wrapper is induced from
EVIDENCE = 3                    # different pages that have to show a constant
DEPTH = 100                     # levels of a tree that are aligned; what is deeper counts as text of the last one
PIECES = 100                    # nodes and texts in a constant, at most; larger ones are left out by their parts

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>?|[^<]+|<", re.S)
MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACE = re.compile(r"[ \t\n\r\f\v]+")
NAME = re.compile(r"[a-z]+|[0-9]+")
# HTML's element sets: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body main article section div center table tbody tr td form".split())
#: An opening tag of the left closes an open element of the right (up to the nearest container).
P_CLOSERS = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                      "h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
SCOPE = frozenset("html body main article section div table ul ol dl td th form nav aside header footer blockquote".split())
#: Elements, and words in class, id or role, that are not the article.
ASIDE_TAGS = frozenset("nav aside footer form script style noscript template iframe svg button select textarea title head dialog menu "
                       "object embed canvas audio video map datalist noembed noframes".split())
ASIDE_NAMES = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent "
                        "disqus footer masthead menu modal nav navbar navigation newsletter notice notices notification pagination "
                        "popup promo promoted related replies reply search share sharing sidebar signup social sponsor sponsored "
                        "subscribe toolbar widget complementary contentinfo alert gdpr".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
STATES = frozenset("no has with without is".split())


class Node:
    __slots__ = ("tag", "key", "aside", "children", "doubt")

    def __init__(self, tag: str, key: str, aside: bool, doubt: bool = False):
        self.tag, self.key, self.aside, self.children = tag, key, aside, []
        self.doubt = doubt              # aside only by its name or as a form: may still hold the article


def _open(tag: str, attrs: str, in_article: bool) -> Node:
    key, aside = tag, tag in ASIDE_TAGS
    sure = aside and tag != "form"
    if attrs and "=" in attrs:
        for m in MARK.finditer(attrs):
            value = (m[2] or m[3] or m[4] or "").lower()
            tokens = [parts for parts in map(NAME.findall, value.split()) if parts]
            # "comment-list", "left-sidebar", but not "no-sidebar" or "post-comments-open".
            aside = aside or any((t[0] in ASIDE_NAMES or t[-1] in ASIDE_NAMES) and t[0] not in STATES for t in tokens)
            if key == tag and tokens and m[1].lower() != "role":
                key = f"{tag}.{tokens[0][0]}"
    if tag == "header" and not in_article:
        aside = sure = True
    if tag in ("body", "html", "article", "main"):
        aside = False
    return Node(tag, key, aside, aside and not sure)


def _settle(root: Node) -> None:
    """Doubtful nodes around the article are not aside.

    The article is the page's first article or main element. Without one it is
    in the nodes with an h1; without those, in the nodes with over half the text.
    """
    doubts, marks, total = [], {}, 0            # (node, its text); tag -> chains (doubtful node, chain around it)
    frames = [[root, None, 0, 0]]               # node, doubtful nodes around its children, next child, text so far
    while frames:
        frame = frames[-1]
        x, around, at, size = frame
        if at == len(x.children):
            frames.pop()
            if x.doubt:
                doubts.append((x, size))
            if frames:
                frames[-1][3] += size
            else:
                total = size
            continue
        frame[2] += 1
        c = x.children[at]
        if isinstance(c, str):
            frame[3] += len(SPACE.sub(" ", c).strip())
        elif not c.aside or c.doubt:
            inner = (c, around) if c.doubt else around
            if c.tag in ("article", "main", "h1"):
                marks.setdefault("h1" if c.tag == "h1" else "article", []).append(inner)
            frames.append([c, inner, 0, 0])
    if not marks:
        for c, n in doubts:
            c.aside = c.aside and n * 2 <= total
    for chain in marks["article"][:1] if "article" in marks else marks.get("h1", ()):
        while chain and chain[0].aside:         # nodes around one that is settled are settled
            chain[0].aside = False
            chain = chain[1]


def parse(source: str) -> Node:
    """A DOM tree; tolerant of missing and stray end tags."""
    root = Node("#root", "#root", False)
    stack, at, n = [root], 0, len(source)
    open_: dict = {}                            # open elements by tag

    def close(k: int) -> None:
        for x in stack[k:]:
            open_[x.tag] -= 1
        del stack[k:]

    while at < n:
        m = TOKEN.match(source, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if text[0] != "<" or len(text) == 1:
                stack[-1].children.append(html.unescape(text) if "&" in text else text)
            continue
        tag = tag.lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if open_.get(tag) else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in SCOPE and tag in INLINE:
                    break
            continue
        closed = CLOSES.get(tag) or ({"p"} if tag in P_CLOSERS else ())
        if any(open_.get(t) for t in closed):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closed:
                    close(k)
                    break
                if stack[k].tag in SCOPE:
                    break
        node = _open(tag, m[3], bool(open_.get("article") or open_.get("main")))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = end.end() if end else n        # raw text is never the article
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(node)
            open_[tag] = open_.get(tag, 0) + 1
    _settle(root)
    return root


def node_text(node: Node, constants: dict | None = None) -> str:
    """All text below ``node`` that is neither aside nor constant: blocks and breaks become one space, white space runs too."""
    out: list = []
    todo = node.children[::-1]
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            out.append(c)
        elif not c.aside and not (constants and is_constant(c, constants)):
            if c.tag not in INLINE:
                out.append(" ")
                todo.append(" ")                # comes after the children
            todo += c.children[::-1]
    return SPACE.sub(" ", "".join(out)).strip(" ")


def block_text(node: Node) -> str | None:
    """The node's text if it is a block of few pieces that may be a constant."""
    if node.tag in INLINE or node.tag in HEADINGS:
        return None
    if len(node.children) > PIECES:
        return None
    out, todo, seen = [], node.children[::-1], 0
    while todo:
        c = todo.pop()
        seen += 1
        if seen > PIECES:
            return None
        if isinstance(c, str):
            out.append(c)
        elif c.tag in HEADINGS:
            return None
        elif not c.aside:
            if len(c.children) > PIECES:
                return None
            if c.tag not in INLINE:
                out.append(" ")
                todo.append(" ")
            todo += c.children[::-1]
    text = SPACE.sub(" ", "".join(out)).strip(" ")
    return text if any(map(str.isalnum, text)) else None


def is_constant(node: Node, constants: dict) -> bool:
    known = constants.get(node.key)
    return bool(known) and block_text(node) in known


class Shape:
    """A node for alignment: key, repeated siblings folded into one, members in the page."""

    __slots__ = ("key", "tag", "children", "members", "texts")

    def __init__(self, members: list, depth: int = 0):
        self.members, self.key, self.tag = members, members[0].key, members[0].tag
        if depth == DEPTH:
            self.texts, self.children = [" ".join(map(node_text, members))], []
            return
        self.texts = [SPACE.sub(" ", "".join(c for m in members for c in m.children if isinstance(c, str))).strip()]
        inner = [c for m in members for c in m.children if not isinstance(c, str) and not c.aside]
        runs: list = []
        for c in inner:
            if runs and runs[-1][0].key == c.key:
                runs[-1].append(c)
            else:
                runs.append([c])
        self.children = [Shape(r, depth + 1) for r in (runs if len(members) == 1 else self._fold(runs))]

    @staticmethod
    def _fold(runs: list) -> list:
        """Children of repeated siblings: one run per key."""
        by: dict = {}
        for r in runs:
            by.setdefault(r[0].key, []).extend(r)
        return list(by.values())


def match(a: Shape, b: Shape) -> tuple[int, list]:
    """Simple tree matching: size of the largest common top-down ordered tree, and its node pairs."""
    if a.key != b.key:
        return 0, []
    rows, cols = a.children, b.children
    best = [[(0, None)] * (len(cols) + 1) for _ in range(len(rows) + 1)]
    for i, x in enumerate(rows, 1):
        for j, y in enumerate(cols, 1):
            up, left = best[i - 1][j][0], best[i][j - 1][0]
            cell = (up, "up") if up >= left else (left, "left")
            if x.key == y.key:
                size, pairs = match(x, y)
                if best[i - 1][j - 1][0] + size > cell[0]:
                    cell = (best[i - 1][j - 1][0] + size, pairs)
            best[i][j] = cell
    pairs, i, j = [(a, b)], len(rows), len(cols)
    while i and j:
        how = best[i][j][1]
        if how == "up":
            i -= 1
        elif how == "left":
            j -= 1
        else:
            pairs += how or []
            i, j = i - 1, j - 1
    return best[-1][-1][0] + 1, pairs


def _weight(shape: Shape, slots_only: bool) -> float:
    """Text in the slots below a template node (or in all nodes)."""
    varies = not slots_only or len(shape.texts) < 2 or len(set(shape.texts)) > 1
    own = sum(map(len, shape.texts)) / len(shape.texts) if varies else 0.0
    return own + sum(_weight(c, slots_only) for c in shape.children)


def _landmarks(shape: Shape) -> list[Shape]:
    """The topmost article and main elements."""
    return [shape] if shape.tag in ("article", "main") else [x for c in shape.children for x in _landmarks(c)]


def container(top: Shape) -> list[Shape]:
    """The way from the top to the lowest container of all slot text, or of all in article and main elements if they hold a quarter."""
    slots = _weight(top, True) > 0              # if nothing varies (copies of one page), all text counts
    total = _weight(top, slots)
    marked = _landmarks(top)
    held = sum(_weight(x, slots) for x in marked)
    only = bool(marked) and held * 4 >= total

    def goal(x: Shape) -> float:
        return sum(_weight(m, slots) for m in _landmarks(x)) if only else _weight(x, slots)

    way = [top]
    while way[-1].tag not in ("article", "main"):
        whole = goal(way[-1])
        inner = [c for c in way[-1].children if c.tag in CONTAINERS
                 and (c.tag in ("html", "body") or whole > 0 and goal(c) >= whole * (1 - 1e-9))]
        if not inner:
            break
        way.append(max(inner, key=lambda x: (x.tag in ("html", "body"), goal(x))))
    return way


def induce(pages: list[str]) -> str:
    """The wrapper of pages of one host, as JSON: the keys down to the container, the template's skeleton, constants."""
    shapes = [Shape([parse(p)]) for p in dict.fromkeys(pages)]
    template = max(shapes, key=lambda s: sum(1 for _ in _walk(s)))
    peers: dict = {}                            # template node -> its members on each page that has it
    for s in shapes:
        for t, x in match(template, s)[1]:
            peers.setdefault(id(t), []).append(x.members)
            if x is not t:
                t.texts += x.texts
    way = container(template)
    marked = any(s.tag in ("article", "main") for s in _walk(template))
    return json.dumps({"path": [s.key for s in way[1:]], "skeleton": _skeleton(template, way[-1]), "marked": marked,
                       "constants": _constants(template, way[-1], peers)}, separators=(",", ":"))


def _constants(template: Shape, goal: Shape, peers: dict) -> dict[str, list[str]]:
    """Key -> texts of the blocks that stand on all pages with their place in the template, at least EVIDENCE of them."""
    found: dict = {}
    todo = list(template.children)
    while todo:
        t = todo.pop()
        pages = peers.get(id(t), [])
        if len(pages) >= EVIDENCE and t.tag not in INLINE:
            same = set.intersection(*[{block_text(x) for x in members} for members in pages]) - {None}
            if same:
                found.setdefault(t.key, set()).update(same)
            if all(block_text(x) in same for x in t.members):
                continue
        todo += t.children
    whole, left = (sum(len(node_text(x, c)) for x in goal.members if not (c and is_constant(x, c))) for c in (None, found))
    return {k: sorted(v) for k, v in sorted(found.items())} if left * 2 >= whole else {}


def _walk(s: Shape):
    yield s
    for c in s.children:
        yield from _walk(c)


def _skeleton(s: Shape, goal: Shape) -> list:
    return [s.key, int(s is goal), [_skeleton(c, goal) for c in s.children]]


class Wrapper:
    """A wrapper read back from JSON."""

    def __init__(self, text: str):
        d = json.loads(text)
        self.path, self.goal, self.marked = d["path"], None, d["marked"]
        self.constants = {k: set(v) for k, v in d["constants"].items()}
        self.template = self._shape(d["skeleton"])

    def _shape(self, d) -> Shape:
        key, goal, children = d
        s = Shape([Node(key, key, False)])
        s.children = [self._shape(c) for c in children]
        if goal:
            self.goal = s
        return s

    def extract(self, source: str) -> str:
        """The page's main text."""
        root, fixed = parse(source), self.constants
        nodes = [root]
        for key in self.path:
            nodes = [c for x in nodes for c in x.children
                     if not isinstance(c, str) and not c.aside and c.key == key and not is_constant(c, fixed)]
        if not nodes:
            own = Shape([root])
            nodes = next((b.members for a, b in match(self.template, own)[1] if a is self.goal), None) or container(own)[-1].members
        text = SPACE.sub(" ", " ".join(node_text(x, fixed) for x in nodes)).strip(" ")
        if not self.marked and nodes != [root] and len(node_text(root, fixed)) > 2 * len(text):
            own = container(Shape([root]))[-1].members          # another layout
            text = SPACE.sub(" ", " ".join(node_text(x, fixed) for x in own)).strip(" ")
        return text


def host(url) -> "F.Column":
    """Lower-case host of a URL without user and port; null or odd URLs share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """(_host, wrapper) per host of (url, html). At most SAMPLES pages per host leave each task."""
    small_batches(pages.sparkSession, 200)
    rank = Window.partitionBy("_host").orderBy("_k")
    chosen = (pages.select(host(F.col("url")).alias("_host"), F.xxhash64("url", F.length("html")).alias("_k"), F.coalesce("html", F.lit("")).alias("html"))
              .withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= SAMPLES)
              .sortWithinPartitions("_host", "_r").select("_host", "html"))

    def work(batches):
        name, held = None, []
        for batch in batches:
            done = []
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if h != name and held:
                    done.append((name, induce(held)))
                    held = []
                name = h
                held.append(page)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["_host", "wrapper"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([induce(held)], pa.string())], names=["_host", "wrapper"])

    return chosen.mapInArrow(work, "_host string, wrapper string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for (page_id, url, html): the main text of every page, from its whole html.

    Null or empty html gives the empty text; repeated pages are read alike; an
    empty table gives an empty result; other columns are left out.
    """
    spark = pages.sparkSession
    wrappers = written(spark, induce_wrappers(pages), "wrappers")

    def work(batches):
        known: dict = {}
        for batch in batches:
            out = []
            for source, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if wrapper not in known:
                    if len(known) > 200:
                        known.clear()
                    known[wrapper] = Wrapper(wrapper)
                out.append(known[wrapper].extract(source))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    small_batches(spark, 200)
    joined = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("_host"))
              .join(wrappers, "_host").select("page_id", "url", "html", "wrapper"))
    return joined.mapInArrow(work, "page_id long, url string, text string")
