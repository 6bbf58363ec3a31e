"""HTML extraction by wrappers inferred from all pages of one host.

A page is read as a stream of tokens, nested by its block tags: tags with their class, and the
texts between them. A wrapper is a union-free regular expression over such streams. It grows
page by page: where the next tokens agree they stay, and a text that differs becomes a slot; a
run that repeats the tokens before it becomes a repeated group; tokens that one side lacks
become optional, up to the nearest place, however far, where both sides agree again.

Wrappers are made in levels, so that no html is shuffled for them: every task aligns its own
pages, then wrappers are aligned with wrappers, in salted groups and at last per host and
layout. All pages take part. A host has one wrapper for each *layout*: the set of tags and
classes of the sections in the two outer levels of the body.

The wrapper tells where the article is: the innermost section that is not repeated and holds
most of the varying text of the host's pages (its outermost article or main element, if it lies
in one). It also tells the template's texts: those that every page has equally often at the same
place, if the pages hold ``DIFFERENT`` different articles at least (near copies of one article
are no evidence). Each page is then matched against its wrapper, and the texts at the slots
and repeated groups of the article are given out in page order. Menus, headers and footers of
the page, sidebars, notices, adverts, forms and comments are known by tag, role, id or class,
and stand in the wrapper as tokens without content. ``by_wrapper`` says whether the page met the
article of its wrapper; if not, it is read by the expression of the page alone.

Rules: a null or empty page has an empty text; white space in a block is one space; blocks
are joined by two line feeds; character references are decoded; unclosed tags close with
what holds them; block tags nested deeper than ``DEPTH`` only separate blocks; pages of no host
share one; copies of a page change no text that the wrapper leaves out.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_right
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import arrow_schema, prepare, stored, texts

#: A text is the template's only if it is the same on pages with so many different articles.
DIFFERENT = 4
#: A section that holds this share of the varying text holds the article.
MOST = 0.6
DEPTH = 100
#: Hashes of blocks by which articles are told apart; tokens a task keeps before it hands on.
SKETCH = 64
TOKENS_KEPT = 500_000
SALTS = 64
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[a-zA-Z][^\s>/]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(id|class|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul caption".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav aside footer form head button select menu dialog object canvas audio video fieldset".split())
CONTAINERS = frozenset("article main section div body td".split())
#: Words of an id, class or role that mark what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus "
    "footer gdpr menu menubar modal nav navbar navigation newsletter notice notices overlay pagination popup promo promoted related "
    "reader readers replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo "
    "search".split()
)
WORDS = re.compile(r"[a-z]+")


SPACE = re.compile(r"\s+")


def block(text: str) -> str:
    return SPACE.sub(" ", html.unescape(text)).strip()


class Node:
    """A tag with what it holds, or a text ("#"); in a wrapper also a repeated group ("+")."""

    __slots__ = ("tag", "mark", "out", "rep", "opt", "n", "mass", "common", "kids", "text")

    def __init__(self, tag, mark="", out=False, rep=False, opt=False, n=1, mass=0, common=None, kids=None, text=""):
        self.tag, self.mark, self.out, self.rep, self.opt = tag, mark, out, rep, opt
        self.n, self.mass, self.common, self.kids, self.text = n, mass, common or {}, kids if kids is not None else [], text

    @property
    def key(self):
        return self.tag, self.mark


def parse(page: str) -> Node:
    """The page's block tags and texts. Inline tags are part of a text; what lies in a tag that
    is no part of an article is left out, the tag itself stays."""
    root = Node("body")
    stack: list[tuple[str, Node | None]] = []  # open tags; those of nodes with them
    nodes = [root]
    outside = 0  # length of the stack when the outermost left-out tag is open; 0: none is
    held: list[str] = []

    def flush() -> None:
        if held:
            made = block("".join(held))
            held.clear()
            if made:
                nodes[-1].kids.append(Node("#", text=made, mass=len(made)))

    def cut(i: int) -> None:
        nonlocal outside
        for _, node in stack[i:]:
            if node is not None and nodes[-1] is node:
                nodes.pop()
        del stack[i:]
        if outside > i:
            outside = 0

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            if not outside:
                held.append(text)
            continue
        if (tag := m["tag"]) is None:
            continue
        name = tag.lower()
        if name[0] == "/":
            name = name[1:]
            if name in BLOCKS and not outside:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    cut(i)
                    break
            continue
        if name in BLOCKS:
            if not outside:
                flush()
        elif name == "br" and not outside:
            held.append(" ")
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") or stack and stack[-1][0] == "p" and name in BLOCKS:
            closes = ("p", name) if name in ("li", "tr", "td", "th", "dt", "dd", "option") else ("p",)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closes:
                    cut(i)
                    break
                if stack[i][0] in CONTAINERS or stack[i][0] in ("ul", "ol", "table", "dl"):
                    break
        if name in EMPTY:
            continue
        node = None
        if not outside:
            found = {k.lower(): a or b or c for k, a, b, c in NAMES.findall(m["rest"])} if m["rest"] else {}
            named = " ".join(v.lower() for k, v in found.items() if k in ("id", "class", "role"))
            off = name in OUTSIDE or "hidden" in found or found.get("aria-hidden") == "true"
            off = off or bool(named) and not NOT_ARTICLE.isdisjoint(WORDS.findall(named))
            if name in BLOCKS and name not in ("html", "head", "body") and len(nodes) < DEPTH:
                node = Node(name, " ".join(sorted(found.get("class", "").lower().split())), out=off)
                nodes[-1].kids.append(node)
                nodes.append(node)
            if off:
                outside = len(stack) + 1
        stack.append((name, node))
    flush()
    return root


def layout(root: Node) -> str:
    """Hash of the sections in the two outer levels of the body."""
    found = set()
    for a in root.kids:
        if a.tag in CONTAINERS and not a.out:
            found.add((a.key,))
            found.update((a.key, b.key) for b in a.kids if b.tag in CONTAINERS and not b.out)
    return xxhash.xxh64_hexdigest(repr(sorted(found)))


# --- the wrapper ------------------------------------------------------------------------------


def digest(text: str) -> str:
    return xxhash.xxh64_hexdigest(text)


def folded(node: Node) -> Node:
    """A page's tokens as an expression: what repeats becomes a repeated group."""
    if node.tag == "#":
        return Node("#", mass=node.mass, common={digest(node.text): [1, node.mass]})
    return Node(node.tag, node.mark, node.out, kids=fold([folded(k) for k in node.kids]))


def fold(kids: list[Node]) -> list[Node]:
    single: list[Node] = []
    for k in kids:
        if single and single[-1].key == k.key:
            join(single[-1], k, True).rep = True
        else:
            single.append(k)
    keys = [k.key for k in single]
    following: dict = {}
    ahead = [0] * len(keys)  # how far the next token of the same key is; 0: there is none
    for i in range(len(keys) - 1, -1, -1):
        ahead[i] = following.get(keys[i], i) - i
        following[keys[i]] = i
    out, i = [], 0
    while i < len(single):
        n = ahead[i]
        if n and keys[i : i + n] == keys[i + n : i + 2 * n]:
            made = group(single[i : i + n])
            i += n
            while keys[i : i + n] == keys[i - n : i]:
                join(made, group(single[i : i + n]), True)
                i += n
            out.append(made)
        else:
            out.append(single[i])
            i += 1
    return out


def group(kids: list[Node]) -> Node:
    return Node("+", repr([k.key for k in kids]), rep=True, n=max(k.n for k in kids), kids=kids)


def join(a: Node, b: Node, page: bool) -> Node:
    """``a``, changed as little as needed to match what ``b`` matches too. ``page``: both are
    places of one page, so counts of texts add up; else only equal ones stay."""
    a.rep, a.opt, a.mass = a.rep or b.rep, a.opt or b.opt, a.mass + b.mass
    a.n = max(a.n, b.n) if page else a.n + b.n
    if page:
        for h, (n, size) in b.common.items():
            a.common[h] = [a.common[h][0] + n, size] if h in a.common else [n, size]
    elif a.common:
        a.common = {h: c for h, c in a.common.items() if b.common.get(h) == c}
    if a.kids or b.kids:
        a.kids = align(a.kids, b.kids, page)
    return a


def places(kids: list[Node]) -> dict:
    found: dict = {}
    for i, k in enumerate(kids):
        found.setdefault(k.key, []).append(i)
    return found


def after(found: list[int] | None, i: int) -> int | None:
    """The first of these places behind ``i``."""
    at = bisect_right(found, i) if found else 0
    return found[at] if found and at < len(found) else None


def align(a: list[Node], b: list[Node], page: bool) -> list[Node]:
    if [x.key for x in a] == [x.key for x in b]:
        return [join(x, y, page) for x, y in zip(a, b)]
    in_a, in_b = places(a), places(b)
    out: list[Node] = []
    i = j = 0

    def skip(nodes: list[Node]) -> None:
        for x in nodes:
            x.opt = x.opt or page
        out.extend(nodes)

    while i < len(a) and j < len(b):
        x, y = a[i], b[j]
        if x.key == y.key:
            out.append(join(x, y, page))
            i, j = i + 1, j + 1
        elif x.tag == "+" and [k.key for k in b[j : j + len(x.kids)]] == [k.key for k in x.kids]:
            out.append(join(x, group(b[j : j + len(x.kids)]), page))
            i, j = i + 1, j + len(x.kids)
        elif y.tag == "+" and [k.key for k in a[i : i + len(y.kids)]] == [k.key for k in y.kids]:
            out.append(join(group(a[i : i + len(y.kids)]), y, page))
            i, j = i + len(y.kids), j + 1
        else:
            to_a, to_b = after(in_a.get(y.key), i), after(in_b.get(x.key), j)
            if to_b is not None and (to_a is None or to_b - j <= to_a - i):
                skip(b[j:to_b])
                j = to_b
            elif to_a is not None:
                skip(a[i:to_a])
                i = to_a
            else:
                skip([x, y])
                i, j = i + 1, j + 1
    skip(a[i:])
    skip(b[j:])
    return out


class Wrapper:
    """The expression of the pages seen, and sketches of at most DIFFERENT different articles."""

    def __init__(self, root: Node, articles: list[list[str]]):
        self.root, self.articles = root, articles

    @classmethod
    def of(cls, page: Node) -> "Wrapper":
        found: set[str] = set()
        todo = [page]
        while todo:
            node = todo.pop()
            if node.tag == "#":
                found.add(digest(node.text))
            todo.extend(node.kids)
        return cls(folded(page), [sorted(found)[:SKETCH]])

    def add(self, other: "Wrapper") -> "Wrapper":
        join(self.root, other.root, False)
        for new in other.articles:
            if len(self.articles) < DIFFERENT and all(2 * len(set(new) & set(x)) <= min(len(new), len(x)) for x in self.articles):
                self.articles.append(new)
        return self

    def dumps(self) -> str:
        def plain(x: Node):
            return [x.tag, x.mark, int(x.out), int(x.rep), int(x.opt), x.n, x.mass, x.common, [plain(k) for k in x.kids]]

        return json.dumps([plain(self.root), self.articles], separators=(",", ":"))

    @classmethod
    def loads(cls, text: str) -> "Wrapper":
        def node(x):
            return Node(x[0], x[1], bool(x[2]), bool(x[3]), bool(x[4]), x[5], x[6], x[7], [node(k) for k in x[8]])

        root, articles = json.loads(text)
        return cls(node(root), articles)

    def region(self) -> list[Node]:
        """The nodes from the body to the article's section."""
        varied = len(self.articles) > 1
        sums: dict[int, float] = {}

        def total(x: Node, within: bool) -> float:
            if x.out or x.tag == "header" and not within:
                return 0
            own = x.mass - (varied and x.n * sum(n * size for n, size in x.common.values()))
            inner = within or x.tag in ("article", "main")
            sums[id(x)] = max(0, own) + sum(total(k, inner) for k in x.kids)
            return sums[id(x)]

        whole = total(self.root, False)
        path = [self.root]
        while whole:
            path_on = [k for k in path[-1].kids if k.tag in CONTAINERS and not k.rep and sums.get(id(k), 0) >= MOST * whole]
            if not path_on:
                break
            path.append(path_on[0])
        for name in ("article", "main"):
            for i, x in enumerate(path):
                if x.tag == name:
                    return path[: i + 1]
        return path

    def is_template(self, place: Node, text: str, n: int) -> bool:
        """Whether every page has the text ``n`` times at this place."""
        if len(self.articles) < DIFFERENT or place.n < self.root.n or place.opt or not place.common:
            return False
        return place.common.get(digest(text), (0,))[0] == n

    def expression(self) -> str:
        """The wrapper as text: # is a slot, = a text that all pages share."""

        def show(x: Node, of: int) -> str:
            if x.tag == "#":
                made = "=" if x.common and not x.rep and sum(n * s for n, s in x.common.values()) * x.n == x.mass else "#"
            elif x.tag == "+":
                made = "".join(show(k, x.n) for k in x.kids)
            else:
                made = f"<{x.tag}>" + "".join(show(k, x.n) for k in x.kids) + f"</{x.tag}>"
            made = f"({made})+" if x.rep else made
            return f"({made})?" if x.opt or x.n < of else made

        return "".join(show(k, self.root.n) for k in self.root.kids)


def matched(kids: list[Node], pattern: list[Node]):
    """(token, its place in the expression or None), in order."""
    found: dict = {}
    for i, w in enumerate(pattern):
        for inner in w.kids if w.tag == "+" else (w,):
            found.setdefault(inner.key, []).append((i, inner))
    at = 0
    for k in kids:
        own = found.get(k.key, ())
        hit = next((h for h in own if h[0] >= at), None)
        if hit is None:
            yield k, None
        else:
            step, place = hit
            at = step if pattern[step].rep else step + 1
            yield k, place


def read(page: Node, wrapper: Wrapper, path: list[Node]) -> list[str] | None:
    """The article's blocks by the wrapper; None if the page never meets the article's section."""
    section = path[-1]
    found: list[tuple[str, Node | None]] = []
    met = section is wrapper.root

    def walk(node: Node, place: Node | None, inside: bool, keep: bool) -> None:
        nonlocal met
        for k, w in matched(node.kids, place.kids if place is not None else []):
            if k.tag == "#":
                if inside:
                    found.append((k.text, w))
            elif not k.out and (k.tag != "header" or keep):
                here = inside or w is section
                met = met or here
                walk(k, w, here, keep or w is section or k.tag in ("article", "main"))

    walk(page, wrapper.root, met, False)
    if not met:
        return None
    often = Counter((id(w), text) for text, w in found)
    return [t for t, w in found if w is None or not wrapper.is_template(w, t, often[id(w), t])]


def article(page: str, wrapper: Wrapper | None, path: list[Node] | None = None) -> tuple[str, bool]:
    """The article's text, read from the whole page, and whether the wrapper gave it."""
    root = parse(page) if page else Node("body")
    blocks = read(root, wrapper, path or wrapper.region()) if wrapper is not None else None
    if blocks is not None:
        return "\n\n".join(blocks), True
    own = Wrapper.of(root)
    return "\n\n".join(read(root, own, own.region()) or ()), False


def infer(pages: list[str]) -> Wrapper:
    """The wrapper of pages of one layout."""
    made = [Wrapper.of(parse(p)) for p in dict.fromkeys(pages)]
    for other in made[1:]:
        made[0].add(other)
    return made[0]


def host_of(url):
    """Lower-case host name of a URL; empty if it has none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def host_wrappers(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(_host, _layout, _wrapper) of all pages: per task, per salted group, per host and layout."""
    rows = pages.where(F.length(html_col) > 0).select(host_of(F.col(url_col)).alias("_host"), F.col(html_col).alias("_html"))
    schema = "_host string, _layout string, _wrapper string"
    kinds = arrow_schema(schema)

    def partial(batches):
        known: dict[tuple[str, str], Wrapper] = {}
        seen: set[tuple[str, int]] = set()
        size = 0

        def out():
            made = [(h, k, w.dumps()) for (h, k), w in sorted(known.items())]
            known.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*made)], schema=kinds)

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                copy = host, xxhash.xxh3_64_intdigest(page)
                if copy in seen:
                    continue
                seen.add(copy)
                root = parse(page)
                key, new = (host, layout(root)), Wrapper.of(root)
                if key in known:
                    known[key].add(new)
                    size += 1
                else:
                    known[key] = new
                    size += page.count("<")
                if size > TOKENS_KEPT:
                    yield out()
                    size = 0
        if known:
            yield out()

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        own = sorted(found["_wrapper"])
        wrapper = Wrapper.loads(own[0])
        for other in own[1:]:
            wrapper.add(Wrapper.loads(other))
        return pd.DataFrame({"_host": [found["_host"].iloc[0]], "_layout": [found["_layout"].iloc[0]], "_wrapper": [wrapper.dumps()]})

    made = rows.mapInArrow(partial, schema)
    made = made.groupBy("_host", "_layout", F.pmod(F.xxhash64("_wrapper"), F.lit(SALTS)).alias("_salt")).applyInPandas(merge, schema)
    return made.groupBy("_host", "_layout").applyInPandas(merge, schema)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, the article's text, its number of code points and ``by_wrapper``, for every page."""
    prepare(pages.sparkSession)
    made = stored(host_wrappers(pages, url_col, html_col), "wrappers")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), host_of(F.col(url_col)).alias("_h"))
    laid = f"_id {dict(pages.dtypes)[id_col]}, _url string, _html string, _h string, _l string"
    laid_kinds = arrow_schema(laid)

    def lay(batches):
        for batch in batches:
            if batch.num_rows:
                found = [layout(parse(p)) if p else "" for p in texts(batch.column(2))]
                columns = [*batch.columns, pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, laid_kinds)], schema=laid_kinds)

    rows = rows.mapInArrow(lay, laid)
    joined = rows.join(made, (F.col("_h") == F.col("_host")) & (F.col("_l") == F.col("_layout")), "left").select("_id", "_url", "_html", "_wrapper")
    schema = f"`{id_col}` {dict(pages.dtypes)[id_col]}, `{url_col}` string, text string, n_chars long, by_wrapper boolean"
    kinds = arrow_schema(schema)

    def run(batches):
        known: dict[str, tuple[Wrapper, list[Node]]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            out, through = [], []
            for page, own in zip(texts(batch.column(2)), batch.column(3).to_pylist()):
                if own is not None and own not in known:
                    if len(known) > 200:
                        known.clear()
                    wrapper = Wrapper.loads(own)
                    known[own] = wrapper, wrapper.region()
                text, by = article(page, *known.get(own, (None,)))
                out.append(text)
                through.append(by)
            columns = [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()), pa.array(through)]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, kinds.types)], schema=kinds)

    return joined.mapInArrow(run, schema)
