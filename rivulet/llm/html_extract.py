"""Main text of web pages by a site style tree.

The pages of a host are merged into one style tree: a node is a path of tags
with their classes and ids, merged over pages.  Each node has an importance
(after Yi, Liu and Li): of a leaf, how varied its content is over the host's
pages, as the entropy of its texts over the entropy that all-different texts
would have; of an inner node, the variety of its presentation (the sequences of
child tags that pages show there) and the importance of the leaves below it,
weighted by their text.  What a site repeats on every page, in place and
wording, scores near 0; branches under ``LEAST_IMPORTANCE`` or made of links are
removed from every page of the host.  Hosts with few distinct pages have nothing
to compare, so nothing is removed there by importance.

Presentation also says what a branch is for: tags and class names of menus,
headers, footers, sidebars, notices, adverts, forms and comments have importance
0 (``NOISE_TAGS``, ``NOISE_WORDS``), and on a page that marks its article only
branches inside the mark count.

Two scans: the first sends a row for each node of a page and its content hash,
which Spark counts for each (host, path) - equal contents add up before the
shuffle, so a host with a third of all pages costs no task more than its
distinct contents; the second parses each page again and drops the branches
listed for it.  Text never travels with the counts.  A node's row names its parent only;
what hangs below a node is summed up over the tree in log(depth) rounds.

Defined results: null html is empty; an empty page has an empty text; a null url
is a host of its own; character references are decoded, white space inside a
block becomes one space, blocks join in page order by one space; unclosed tags,
comments, scripts and quotes run as browsers do; pages of equal content count
once in their host's tree; repeated rows are returned each; pages
of one page_id are each cut by their own host's tree; a null page_id is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import shared_table, table

LEAST_IMPORTANCE, LINK_SHARE, LEAST_PAGES, DECAY = 0.2, 0.7, 6, 0.9

# What tags and names mean, from the HTML standard and common use (own choice, fixed values).
NOISE_TAGS = frozenset("head nav header footer aside form button select option input label fieldset dialog menu noscript template "
                       "iframe object embed applet canvas svg math audio video figcaption script style title textarea".split())
RAW_TAGS = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "noembed", "noframes", "xmp")
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
                       "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
                       "section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK_TAGS - frozenset("br body head html option optgroup legend caption tbody td tfoot th thead tr".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
          "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
                        "cookie cookies consent disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation "
                        "newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond search share "
                        "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split())
ARTICLE_WORDS = frozenset(("articlebody", "maincontent"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW_TAGS) + r")\b[^>]*+>.*?(?:</(?P=raw)\b[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>?|<[a-z][^>]*+>?", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PART = re.compile(r"[a-z]+|\d+", re.I)


def path_hash(parent: int, label: str) -> int:
    """Identifier of a path: the same on every machine (FNV-1a over the label's bytes)."""
    value = parent ^ 0xCBF29CE484222325
    for byte in label.encode():
        value = (value ^ byte) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return value


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Node:
    __slots__ = ("tag", "path", "noise", "article", "link", "parent", "children", "block")

    def __init__(self, tag, path, noise, article, link, parent):
        self.tag, self.path, self.noise, self.article, self.link, self.parent = tag, path, noise, article, link, parent
        self.children: list[str] = []
        self.block = self if parent is None or tag in BLOCK_TAGS else parent.block  # the innermost block around


_LABELS: dict[tuple[str, str], tuple[str, bool, bool]] = {}


def _label(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """(label, noise, article) of a start tag."""
    key = (tag, attrs) if len(attrs) < 200 else None
    if key in _LABELS:
        return _LABELS[key]
    label, noise, article = tag, tag in NOISE_TAGS, tag in ("article", "main")
    if attrs:
        names = []
        for name, value in _NAMES.findall(attrs):
            value = value.strip("\"'").lower()
            parts = set(_PART.findall(value))
            if name.lower() in ("role", "itemprop"):
                article |= value in ("main", "article") or value in ARTICLE_WORDS
                noise |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "menu", "dialog", "comment", "comments")
            else:
                names += sorted(x for x in value.split() if not any(c.isdigit() for c in x))
                noise |= bool(parts & NOISE_WORDS) and tag not in ("html", "body", "article", "main")
                noise |= "comment" in parts or "comments" in parts
        noise |= bool(_HIDDEN.search(attrs))
        label = ".".join([tag, *names])
    if tag == "label":
        noise = True
    if key:
        if len(_LABELS) > 20_000:
            _LABELS.clear()
        _LABELS[key] = label, noise, article
    return label, noise, article


def parse(text: str) -> tuple[list[tuple[str, Node, int]], list[Node]]:
    """Blocks (text, node, characters inside links), and nodes with children, without noise.

    On a page that marks its article only what is inside the mark remains.  Nodes know
    their parent, so a page takes memory by its tags, however deep they are.
    """
    root = Node("", 0, False, False, False, None)
    stack, nodes, opened = [root], [root], Counter()
    blocks: list[tuple[str, Node, int, bool]] = []
    pieces: list[str] = []
    owner, linked = root, 0

    def flush():
        nonlocal pieces, linked
        if pieces:
            words = " ".join("".join(pieces).split())
            if words:
                blocks.append((words, owner, min(linked, len(words)), owner.article))
            pieces, linked = [], 0

    at = 0
    for token in _TOKEN.finditer(text):
        top = stack[-1]
        if token.start() > at and not top.noise:
            piece = html_lib.unescape(text[at:token.start()])
            if not pieces:
                owner = stack[-1].block
            pieces.append(piece)
            if top.link:
                linked += len(piece)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS:
            flush()
        if token["end"]:
            if opened[tag]:
                _cut(stack, next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), opened)
            continue
        if tag in CLOSES_P:
            _close(stack, opened, ("p",), ("table", "td", "th", "button", "div", "section", "article", "body", "li", "blockquote"))
        if tag in CLOSED_BY:
            _close(stack, opened, CLOSED_BY[tag], SCOPES[tag])
        parent = stack[-1]
        label, noise, article = _label(tag, token["attrs"] or "")
        parent.children.append(tag)
        if tag in VOID_TAGS or (token["attrs"] or "").endswith("/") and tag not in BLOCK_TAGS:
            continue
        # A heading block inside an article is the article's own.
        if tag == "header" and parent.article and not parent.noise:
            noise = False
        node = Node(tag, path_hash(parent.path, label), parent.noise or noise, parent.article or article, parent.link or tag == "a", parent)
        if not node.noise:
            nodes.append(node)
        stack.append(node)
        opened[tag] += 1
    if at < len(text) and not stack[-1].noise:
        if not pieces:
            owner = stack[-1].block
        pieces.append(html_lib.unescape(text[at:]))
    flush()
    if any(marked for *_, marked in blocks):
        blocks = [b for b in blocks if b[3]]
    return [b[:3] for b in blocks], [n for n in nodes if n.children]


def _cut(stack: list[Node], k: int, opened: Counter) -> None:
    """Close the tags from the k-th on."""
    for node in stack[k:]:
        opened[node.tag] -= 1
    del stack[k:]


def _close(stack: list[Node], opened: Counter, tags: tuple[str, ...], scopes: tuple[str, ...]) -> None:
    """Close the innermost of ``tags`` that is open inside the nearest of ``scopes``."""
    if not any(opened[t] for t in tags):
        return
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            _cut(stack, k, opened)
            return
        if stack[k].tag in scopes:
            return


def _runs(tags: list[str]) -> list[str]:
    """Child tags with repetitions taken together."""
    return [t for i, t in enumerate(tags) if not i or tags[i - 1] != t]


def _hash(text: str) -> int:
    import xxhash

    return signed(xxhash.xxh3_64_intdigest(text))


#: kind 0: content of a leaf; 1: presentation of a node.
NODES = "page long, host string, kind byte, path long, parent long, content long, chars long, links long"


def _nodes(batches):
    """Scan side: the nodes of each page; ``page`` is a hash of all its content."""
    names = [x.split()[0] for x in NODES.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            blocks, nodes = parse(batch.column("html")[i].as_py())
            host = batch.column("host")[i].as_py()
            page = _hash("\0".join(b for b, *_ in blocks))
            by_leaf: dict[int, list] = {}
            for words, node, links in blocks:
                leaf = by_leaf.setdefault(node.path, [node, [], 0, 0])
                leaf[1].append(words)
                leaf[2] += len(words)
                leaf[3] += links
            rows += [(page, host, 0, signed(path), _parent(node), _hash("\0".join(words)), chars, links)
                     for path, (node, words, chars, links) in by_leaf.items()]
            looks = {(n.path, " ".join(_runs(n.children))): n for n in nodes}
            rows += [(page, host, 1, signed(path), _parent(node), _hash(tags), 0, 0) for (path, tags), node in looks.items()]
            if len(rows) > 50_000:
                yield _batch(rows, names, kinds)
                rows = []
        yield _batch(rows, names, kinds)


def _parent(node: Node) -> int | None:
    return None if node.parent is None else signed(node.parent.path)


def _batch(rows, names, kinds):
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def style_tree(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, path, importance, link_share, n_pages) of every node; pages: (host, html)."""
    nodes = pages.mapInArrow(_nodes, NODES)
    # Pages of equal content count once.
    once = nodes.groupBy("host", "kind", "path", "content", "page").agg(
        F.min("parent").alias("parent"), F.max("chars").alias("chars"), F.max("links").alias("links"))
    contents = once.groupBy("host", "kind", "path", "content").agg(
        F.count("*").alias("n"), F.min("parent").alias("parent"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    # Entropy of n_i / N over log N, from sums: log N - sum(n log n) / N.
    variety = contents.groupBy("host", "kind", "path").agg(
        F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.min("parent").alias("parent"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links")).withColumn(
        "variety", F.when(F.col("pages") <= 1, F.lit(1.0)).otherwise(1 - F.col("nlogn") / (F.col("pages") * F.log("pages"))))
    leaf = F.col("kind") == 0
    own = variety.groupBy("host", "path").agg(
        F.min("parent").alias("jump"), F.max(F.when(~leaf, F.col("variety"))).alias("presentation"),
        *(F.sum(F.when(leaf, value).otherwise(F.lit(0))).alias(name) for name, value in (
            ("weighed", F.col("variety") * F.col("chars")), ("chars", F.col("chars")), ("links", F.col("links")), ("leaves", F.lit(1)))),
        F.max(F.when(leaf, F.col("pages")).otherwise(F.lit(0))).alias("n_pages"))
    weight = F.pow(F.lit(DECAY), F.col("leaves"))
    content = F.col("weighed") / F.col("chars")
    # A leaf, and a node that looks the same everywhere, is as important as its content.
    return _summed_up(spark, own).filter("leaves > 0").select(
        "host", "path", (F.col("links") / F.col("chars")).alias("link_share"), "n_pages",
        F.greatest(content, (1 - weight) * F.coalesce("presentation", F.lit(0.0)) + weight * content).alias("importance"))


def _summed_up(spark: SparkSession, own: DataFrame) -> DataFrame:
    """Sums of each node and all below it.

    Before the k-th round a node holds the sums of what is less than 2 ** k levels below
    it, and ``jump`` names its ancestor that many levels up; it sends its sums there.  A
    tree of depth d takes log d rounds, each linear in its nodes.
    """
    sums = ("weighed", "chars", "links", "leaves")
    nodes = shared_table(spark, own, "sums")
    while not (going := nodes.filter("jump IS NOT NULL")).isEmpty():
        sent = going.groupBy("host", F.col("jump").alias("path")).agg(
            *(F.sum(c).alias(f"{c}_sent") for c in sums), F.max("n_pages").alias("n_pages_sent"))
        above = nodes.select("host", F.col("path").alias("jump"), F.col("jump").alias("next"))
        nodes = shared_table(spark, (
            nodes.join(sent, ["host", "path"], "left").join(above, ["host", "jump"], "left").select(
                "host", "path", F.col("next").alias("jump"), "presentation",
                *((F.col(c) + F.coalesce(f"{c}_sent", F.lit(0))).alias(c) for c in sums),
                F.greatest("n_pages", "n_pages_sent").alias("n_pages"))), "sums", free=False)
    return nodes


def _paths(batches):
    """Page rows to (page_id, print, host, paths of its blocks)."""
    for batch in batches:
        found = []
        for text in batch.column("html").to_pylist():
            paths: set[int] = set()
            for _, node, _ in parse(text)[0]:
                while node is not None and node.path not in paths:
                    paths.add(node.path)
                    node = node.parent
            found.append(sorted(map(signed, paths)))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("print"), batch.column("host"), pa.array(found, pa.list_(pa.int64()))],
                                         names=["page_id", "print", "host", "paths"])


def _is_cut(node: Node, cut: dict[int, bool]) -> bool:
    """Whether a node or one around it is removed; ``cut`` holds what is known of paths."""
    way = []
    while node is not None and node.path not in cut:
        way.append(node.path)
        node = node.parent
    known = node is not None and cut[node.path]
    cut.update(dict.fromkeys(way, known))
    return known


def _text(batches):
    for batch in batches:
        texts = []
        for page, removed in zip(batch.column("html").to_pylist(), batch.column("removed").to_pylist(), strict=True):
            gone = set(removed or ())
            blocks, _ = parse(page)
            cut = {path % (1 << 64): True for path in gone}
            texts.append(" ".join(words for words, node, _ in blocks if not (gone and _is_cut(node, cut))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(spark: SparkSession, pages: DataFrame, least_importance: float = LEAST_IMPORTANCE, link_share: float = LINK_SHARE,
            least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    # Pages that share a page_id, or have none, are told apart by host and content.
    given = given.withColumn("print", F.xxhash64("host", "html"))
    low = shared_table(spark, (
        style_tree(spark, given.select("host", "html"))
        .filter((F.col("n_pages") >= least_pages) & ((F.col("importance") < least_importance) | (F.col("link_share") > link_share)))
        .select("host", "path")), "tree")
    # Pages that hold a low branch; on most sites few paths are low, so few rows meet.
    hosts = low.select("host").distinct()
    on_page = (given.join(hosts, "host", "left_semi").select("page_id", "print", "host", "html")
               .mapInArrow(_paths, "page_id long, print long, host string, paths array<long>")
               .select("page_id", "print", "host", F.explode("paths").alias("path")))
    removed = (on_page.join(low, ["host", "path"]).groupBy("page_id", "print").agg(F.collect_set("path").alias("removed")))
    return (given.join(removed, given["page_id"].eqNullSafe(removed["page_id"]) & (given["print"] == removed["print"]), "left")
            .select(given["page_id"], "url", "html", "removed").mapInArrow(_text, "page_id long, url string, text string, n_chars long"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"))
