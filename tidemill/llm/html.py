"""Main text of web pages by wrapper induction."""

from __future__ import annotations

import hashlib
import html
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import kept, narrow

#: A text at one place of the template on this share of a host's pages, and on so many, belongs to the template.
CONSTANT, LEAST_PAGES = 0.6, 5
#: Hosts up to which their templates are sent to every executor.
HOSTS = 20_000

# One way to read a quote, without going back: an unclosed tag costs no more than its length, and the end of the page closes it.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)|([^<]+|<)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var
math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mspace mpadded semantics""".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg object select".split())
APART = frozenset("nav footer aside form button dialog menu fieldset input head header".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
ITEMS = frozenset("li dt dd".split())
FENCE = frozenset("article body div section main table ul ol dl td th aside nav footer header form html blockquote figure".split())
ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|sign-?up|paywall|sidebar|side|rail|widget|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|masthead|topbar|toolbar|site-header|page-header|shar(?:e|ing)|social|related|recommend\w*|trending|comments?|replies|respond|disqus|login|search|skip|toc|tags?|copyright|disclaimer|navigation|contentinfo|complementary|form)(?=$|[\s_-])",
    re.I,
)
LAYOUT = re.compile(r"(?:has|with|no|without|is|not)[-_]", re.I)
MAIN = re.compile(r"(?:^|[\s_-])(?:main|article-?body|post-?(?:body|content)|entry-?content|story-?body|content|article)(?=$|[\s_-])", re.I)


class Node:
    __slots__ = ("tag", "label", "kids", "at")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.kids, self.at = tag, label, [], 0


def label(tag: str, attributes: str) -> str:
    """Tag and first class or id; marked `!` if apart from the main text by its name, `*` if it is a place of main text."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        found.setdefault(name.lower(), value.strip("\"'"))
    # A name that tells what its element has, or is laid out with, says nothing about what it is.
    names = " ".join(n for a in ("class", "id", "role") for n in found.get(a, "").split() if not LAYOUT.match(n))
    first = re.sub(r"[^A-Za-z_-]", "", (found.get("class") or found.get("id") or "").split(" ")[0])[:24]
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    if tag in ("html", "body"):
        return tag
    if tag in ("article", "main") and not (names and re.search(r"comment|repl|related|teaser|promo|sponsor|\bads?\b", names, re.I)):
        return f"{tag}.{first}*"
    if hidden or tag in APART or (names and ASIDE.search(names)):
        return f"{tag}.{first}!"
    return f"{tag}.{first}*" if names and MAIN.search(names) else f"{tag}.{first}"


def tokens(page: str):
    """The page's tokens without what raw elements hold: from a start tag of one it goes on behind its own end tag, or nowhere if there is none."""
    at = 0
    while at < len(page):
        for m in TOKEN.finditer(page, at):
            ending, tag, attributes, _ = m.groups()
            if tag and not ending and tag.lower() in RAW and not attributes.endswith("/"):
                end = _end_of(tag.lower()).search(page, m.end())
                at = end.end() if end else len(page)
                break
            yield m
        else:
            return


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?:[\s/][^>]*)?>", re.I)


def parse(page: str) -> tuple[str, list[int], list[str], list[int]]:
    """The shape of a page's tree, and its text blocks in page order: node, text, letters in links.

    Unclosed and misnested elements are closed as browsers do for the cases
    that matter to blocks.  Siblings in a row with the same label are folded
    into one node of the shape, so lists of any length have one shape.
    """
    root = Node("html", "html")
    stack, blocks, run, linked, links = [root], [], [], 0, 0
    hidden = 0

    def flush():
        nonlocal run, linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                blocks.append((stack[-1], text, linked))
            run, linked = [], 0

    def close(depth: int):
        nonlocal stack
        flush()
        del stack[depth:]

    for m in tokens(page):
        ending, tag, attributes, text = m.groups()
        if text is not None:
            if not hidden:
                run.append(text)
                linked += len(text) if links else 0
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                run.append(" " if tag != "wbr" else "")
            continue
        if tag in INLINE:
            links = max(0, links + (-1 if ending else 1)) if tag == "a" else links
            if hidden:
                hidden += (-1 if ending else 1) if tag == hidden_tag else 0
            elif not ending and label(tag, attributes).endswith("!"):
                hidden, hidden_tag = 1, tag
            continue
        hidden = links = 0
        if ending:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at:
                close(at)
            else:
                flush()
            continue
        flush()
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        ends = ENDS_SAME.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    if tag != "tr":
                        break
                elif stack[i].tag in FENCE:
                    break
        name = label(tag, attributes)
        if tag == "header" and any(n.label.endswith("*") for n in stack):
            name = "header."
        kids = stack[-1].kids
        if kids and kids[-1].label == name:
            node = kids[-1]
        else:
            node = Node(tag, name)
            kids.append(node)
        stack.append(node)
    flush()

    count = 0

    def spell(node: Node) -> str:
        nonlocal count
        node.at, count = count, count + 1
        return node.label + ("(" + ",".join(map(spell, node.kids)) + ")" if node.kids else "")

    shape = spell(root) if _depth(root) < 200 else _spell_deep(root)
    return shape, [b[0].at for b in blocks], [b[1] for b in blocks], [b[2] for b in blocks]


def _depth(node: Node) -> int:
    deepest, todo = 0, [(node, 1)]
    while todo:
        n, d = todo.pop()
        deepest = max(deepest, d)
        todo += [(k, d + 1) for k in n.kids]
    return deepest


def _spell_deep(root: Node) -> str:
    """A tree too deep to walk recursively: its nodes as children of the root, in order, each with the marks above it."""
    names, todo, count = [], [(root, "")], 0
    while todo:
        node, mark = todo.pop()
        mark = "!" if "!" in (mark, node.label[-1]) else mark or node.label[-1:].strip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._-")
        node.at, count = count, count + 1
        names.append(node.label.rstrip("!*") + mark)
        todo += [(k, mark) for k in reversed(node.kids)]
    return names[0] + ("(" + ",".join(names[1:]) + ")" if len(names) > 1 else "")


@lru_cache(maxsize=4096)
def tree(shape: str) -> tuple:
    """(label, number, parent, kids) of every node, in order."""
    nodes, stack = [], []
    for part in re.findall(r"[^(),]+|[(),]", shape):
        if part == "(":
            stack.append(len(nodes) - 1)
        elif part == ")":
            stack.pop()
        elif part != ",":
            parent = stack[-1] if stack else -1
            nodes.append((part, len(nodes), parent, []))
            if parent >= 0:
                nodes[parent][3].append(len(nodes) - 1)
    return tuple(nodes)


@lru_cache(maxsize=4096)
def align(shape: str, reference: str) -> tuple:
    """Simple tree matching: for each node of `shape` the node of `reference` it is matched with, or -1.

    The largest order-preserving matching of equal labels that maps children
    of matched nodes onto each other.
    """
    a, b = tree(shape), tree(reference)
    sizes: dict[tuple[int, int], int] = {}
    steps: dict[tuple[int, int], list] = {}

    def grid(x: int, y: int) -> int:
        kx, ky = a[x][3], b[y][3]
        m = [[0] * (len(ky) + 1) for _ in range(len(kx) + 1)]
        for i, p in enumerate(kx, 1):
            for j, q in enumerate(ky, 1):
                here = sizes.get((p, q), 0)
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + here)
        steps[x, y] = m
        return m[-1][-1] + 1

    by_label: dict[str, list[int]] = {}
    for name, y, _, _ in b:
        by_label.setdefault(name, []).append(y)
    for x in range(len(a) - 1, -1, -1):  # children have larger numbers
        for y in reversed(by_label.get(a[x][0], ())):
            sizes[x, y] = grid(x, y)
    out, todo = [-1] * len(a), [(0, 0)] if a and b and a[0][0] == b[0][0] else []
    while todo:
        x, y = todo.pop()
        out[x] = y
        kx, ky, m = a[x][3], b[y][3], steps[x, y]
        i, j = len(kx), len(ky)
        while i and j:
            if m[i][j] == m[i - 1][j]:
                i -= 1
            elif m[i][j] == m[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((kx[i], ky[j]))
    return tuple(out)


@lru_cache(maxsize=4096)
def places(shape: str) -> tuple[tuple[bool, ...], tuple[int, ...], tuple[bool, ...]]:
    """For each node: whether it lies apart from the main text, the place of main text around it (-1: none), and whether it belongs to a list item outside any place.

    A marked place inside another belongs to the outer one.  A place inside a
    list item (a teaser) is part of the item; paragraphs are not.
    """
    apart, inside, item = [], [], []
    for name, at, parent, _ in tree(shape):
        apart.append(name.endswith("!") or (parent >= 0 and apart[parent]))
        outer = inside[parent] if parent >= 0 else -1
        inside.append(outer if outer >= 0 else (at if name.endswith("*") else -1))
        item.append((parent >= 0 and item[parent]) or (outer < 0 and name.split(".")[0] in ITEMS))
    return tuple(apart), tuple(inside), tuple(i and name.split(".")[0] != "p" for i, (name, *_) in zip(item, tree(shape), strict=True))


def content(shape: str, nodes: list[int], texts: list[str], links: list[int], reference: str, constant: set[tuple[int, str]]) -> str:
    """The blocks left when template and parts beside the main text are gone.

    If the page has places of main text, all of them are taken; else all
    varying slots are.  List items outside a place go if they are mostly links.
    """
    match = align(shape, reference)
    apart, inside, item = places(shape)
    own, theirs = tree(shape), tree(reference)
    # A node that the reference lacks, or has elsewhere, still bears the name of the place its text belongs to.
    named = {(theirs[n][0], d) for n, d in constant}

    def template(n: int, text: str) -> bool:
        d = digest(text)
        return (match[n], d) in constant or (match[n] < 0 and (own[n][0], d) in named)

    left = [(n, t) for n, t, k in zip(nodes, texts, links, strict=True) if not apart[n] and not template(n, t) and not (item[n] and 2 * k > len(t))]
    marked = any(inside[n] >= 0 for n, _ in left)
    return "\n\n".join(t for n, t in left if not marked or inside[n] >= 0)


def digest(text: str) -> int:
    """64 bits; digests are only compared within a host."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def parsed(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    """(page_id, url, host, shape, nodes, texts, links, page): every page read once; `page` names its text.

    Blocks apart from the main text are never part of it and left out here.
    """
    id_type = dict(pages.dtypes)[key]

    def run(batches):
        for batch in batches:
            cols = [[], [], [], [], []]
            for page in batch.column(3).to_pylist():
                shape, nodes, texts, links = parse(page or "")
                name, apart = digest("\n".join(texts)), places(shape)[0]
                blocks = [b for b in zip(nodes, texts, links, strict=True) if not apart[b[0]]]
                for c, x in zip(cols, (shape, *([b[i] for b in blocks] for i in range(3)), name), strict=True):
                    c.append(x)
            kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names=["page_id", "url", "host", "shape", "nodes", "texts", "links", "page"])

    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(body).alias("html"))
    return rows.mapInArrow(run, f"page_id {id_type}, url string, host string, shape string, nodes array<int>, texts array<string>, links array<int>, page long")


def wrappers(pages: DataFrame, constant: float = CONSTANT, least: int = LEAST_PAGES) -> DataFrame:
    """(host, reference, template): the tree pages of a host are aligned to, and its constant texts as (node, text digest).

    Every page of the host counts, pages with the very same text once; the
    counts are combined before the shuffle, a host of a third of all pages
    included.  A host's constants are at most 1 / constant per text slot.
    """
    refs = pages.groupBy("host").agg(F.min(F.struct(F.xxhash64("page", F.lit("reference")).alias("h"), "shape")).alias("r"), F.count_distinct("page").alias("pages"))
    refs = kept(refs.select(F.col("host").alias("_host"), F.col("r.shape").alias("reference"), "pages"), "references")

    def run(batches):
        for batch in batches:
            hosts, at, name, page = [], [], [], []
            for h, shape, ref, nodes, texts, p in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                match = align(shape, ref)
                for n, d in {(match[n], digest(t)) for n, t in zip(nodes, texts, strict=True) if match[n] >= 0}:
                    hosts.append(h)
                    at.append(n)
                    name.append(d)
                    page.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(at, pa.int32()), pa.array(name, pa.int64()), pa.array(page, pa.int64())], names=["host", "node", "name", "page"])

    big = narrow(refs.where(F.col("pages") >= least), HOSTS)
    held = pages.join(big, F.col("host") == F.col("_host")).select("host", "shape", "reference", "nodes", "texts", "page")
    slots = held.mapInArrow(run, "host string, node int, name long, page long").groupBy("host", "node", "name").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= least)
    found = slots.join(big, F.col("host") == F.col("_host")).where(F.col("n") >= constant * F.col("pages"))
    templates = found.groupBy(F.col("host").alias("h")).agg(F.collect_list(F.struct("node", "name")).alias("template"))
    return refs.join(templates, F.col("_host") == F.col("h"), "left").select("_host", "reference", "template")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", constant: float = CONSTANT, least: int = LEAST_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null html is empty; a page without main text has an empty one.  A null
    url has the host ''.  Hosts of fewer than `least` different pages have no
    constants, so only names of elements tell there.  Repeated rows are
    repeated; other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    read = kept(parsed(pages, key, url, body), "parsed-pages")
    host = narrow(kept(wrappers(read, constant, least), "wrappers"), HOSTS)
    id_type = dict(read.dtypes)["page_id"]

    def run(batches):
        for batch in batches:
            out = []
            for shape, nodes, texts, links, ref, template in zip(*[batch.column(i).to_pylist() for i in range(2, 8)], strict=True):
                fixed = {(s["node"], s["name"]) for s in template or ()}
                out.append(content(shape, nodes, texts, links, ref, fixed))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    both = read.join(host, F.col("host") == F.col("_host")).select("page_id", "url", "shape", "nodes", "texts", "links", "reference", "template")
    return both.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
