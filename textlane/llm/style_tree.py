"""HTML extraction with a site style tree.

All pages of a host are merged: a node of the tree is a path of elements (tag, classes and id without digits), whatever its
markup is called.  Pages that are equal outside noise count as one, so that copies don't make their text common.
Spark counts, per host and node, the pages that have it, the styles (sequences of child elements) it takes, and the
clauses (text up to a punctuation mark) and link targets that stand in it.  Its importance combines presentation and content, after the published style tree:
with m pages, l styles and g = 0.9,

    presentation  entropy of the styles, in units of log m
    content       1 - mean of log(pages with the feature in its element) / log m over the features in and below the node,
                  weighted by their occurrences and characters
    importance    (1 - g^l) * presentation + g^l * content

A branch is low if its importance is (the same on most pages), or if it says less than the articles of its host:
its content is under ``RELATIVE`` times theirs (that of all text, where a host marks no article).  A footer
with a changing sentence beside its fixed words is told by this comparison and not by a fixed limit.

Low branches are removed from each page, and besides those that the markup itself names as menus, headers, footers,
sidebars, notices, adverts, forms or comments: menus and adverts may differ on every page, which no entropy tells from
content.  A low branch that holds most of the page's text is kept whole: there the host repeats the text itself.  Where a
page marks its article, text flow inside it (paragraphs, headings, lists) is never removed, so that copied
articles keep their text, and other branches inside it only by their importance, not by the comparison.  The comparison
never removes a heading by itself.

Counting is by partial aggregation of hashes; no page, host or node is gathered into one task.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Set
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlane.llm.common import spread
from textlane.llm.url_rules import host_of

GAMMA = 0.9
LOW_IMPORTANCE = 0.2
#: A branch with less content than this share of its host's articles is low, too.
RELATIVE = 0.9
#: Hosts with fewer pages with a node say nothing about it.
MIN_PAGES = 10
#: Elements nested deeper share the path of the element at this depth.
MAX_PATH = 64

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
#: A start tag of the key ends an open element of these names (up to the next enclosing block of another kind).
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tr td th b i em strong a span code".split())
#: Elements that are never part of the article.
NOISE_TAGS = frozenset("head nav footer aside form button select option optgroup input textarea script style noscript template iframe "
                       "object embed svg canvas audio video menu dialog title".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs masthead footer sidebar aside widget cookie cookies consent gdpr notice notification alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "reply replies respond discussion disqus form search pagination pager toolbar skip".split())
#: Those that make an article element a reader's comment; other noise words don't count there.
COMMENT_WORDS = frozenset("comment comments reply replies respond discussion disqus".split())
HEADER_WORDS = frozenset(("header", "topbar"))
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: What no reader sees, also where names decide nothing.
HIDDEN_TAGS = frozenset("head script style noscript template iframe object svg title".split())
MAIN_WORDS = frozenset("article story post entry articlebody postbody".split())
_WORDS = re.compile(r"[a-z]+")
#: Clauses of a text end at white space behind a character that is no letter, digit or underscore.
_CLAUSE = re.compile(r"(?<=[^\w\s]) ")
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_UNCLOSED = re.compile(r"<!--|<!\[CDATA\[")
#: Longer attributes are read each time they come.
_KNOWN_ATTRS = 1000


@lru_cache(maxsize=1 << 16)
def _known_element(name: str, attrs: str) -> tuple[int, bool, bool, int]:
    return element(name, attrs)


def element(name: str, attrs: str) -> tuple[int, bool, bool, int]:
    """(hash of its key, noise anywhere, noise outside an article, rank) of an element by its name and attributes."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
    words = set(_WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
    role = found.get("role", "").lower()
    plain = name in ("html", "body", "article", "main") or name[0] == "h" and name[1:].isdigit()
    noise = (name in NOISE_TAGS or role in NOISE_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
             or "display:none" in found.get("style", "").replace(" ", "").lower() or not plain and bool(words & NOISE_WORDS)
             or name == "article" and bool(words & COMMENT_WORDS))
    rank = 3 if name == "article" else 2 if name == "main" or role == "main" else 0
    if not rank and name in ("div", "section") and (words & MAIN_WORDS or found.get("itemprop", "").lower() == "articlebody"):
        rank = 1
    key = xxhash.xxh3_64_intdigest(f"{name}.{'.'.join(sorted(words))}") - (1 << 63)
    return key, noise, name == "header" or not plain and bool(words & HEADER_WORDS), rank


class Page:
    """Elements and text blocks of one page.

    ``parent``, ``tag``, ``path`` (hash of the chain of elements), ``style`` (hash of the child elements), ``noise`` (by the
    markup) and ``rank`` (3 article, 2 main, 1 marked by class, 0) describe the elements; a block is a list of (element, text).
    ``links`` are the targets of links, as (element, address).  Hashes are those of tuples of integers, which are the same in every process.
    """

    def __init__(self, source: str | None) -> None:
        self.parent, self.tag, self.path, self.style, self.noise, self.rank = [-1], [""], [0], [0], [False], [0]
        self.blocks: list[list[tuple[int, str]]] = []
        self.links: list[tuple[int, str]] = []
        self._depth, self._open, self._parts, self._inside = [0], [0], [], [False]
        # Places in the stack of open elements, by name and of those that are blocks; the deepest ancestor with a path of its own.
        self._places: dict[str, list[int]] = {}
        self._open_blocks, self._own_path = [0], [0]
        self._last_paths: tuple[int, set[int]] = (0, set())
        self._parse(source or "")

    def _flush(self) -> None:
        if self._parts:
            if any(not t.isspace() for _, t in self._parts):
                self.blocks.append(self._parts)
            self._parts = []

    def _text(self, text: str) -> None:
        if text:
            self._parts.append((self._open[-1], entities.unescape(text) if "&" in text else text))

    def _close(self, name: str, among: tuple[str, ...] | None = None) -> None:
        """Ends the innermost open element of that name (or among those); inline ends don't reach beyond their block."""
        k = max((self._places[x][-1] for x in among or (name,) if self._places.get(x)), default=0)
        if not k or (among or name not in BLOCK) and k < self._open_blocks[-1]:
            return
        if self._open_blocks[-1] >= k:
            self._flush()
        for x in self._open[k:]:
            self._places[self.tag[x]].pop()
        while self._open_blocks[-1] >= k:
            self._open_blocks.pop()
        del self._open[k:]

    def _start(self, name: str, attrs: str) -> None:
        if name in BLOCK:
            self._flush()
            self._close("p")
        if name in SIBLINGS:
            self._close(name, SIBLINGS[name])
        up = self._open[-1]
        if name == "a" and (link := _HREF.search(attrs)):
            self.links.append((len(self.tag), link[1] or link[2] or link[3] or ""))
        attrs = attrs if attrs and _TELLING.search(attrs) else ""
        key, noise, noise_outside, rank = (_known_element if len(attrs) <= _KNOWN_ATTRS else element)(name, attrs)
        self.style[up] = hash((self.style[up], key))
        if name in VOID:
            if name == "br":
                self._parts.append((up, " "))
            return
        inside = self._inside[up]
        depth = self._depth[up] + 1
        self.parent.append(up)
        self.tag.append(name)
        self.path.append(self.path[up] if depth > MAX_PATH else hash((self.path[up], key)))
        self.style.append(0)
        self.noise.append(self.noise[up] or noise or noise_outside and not inside)
        self.rank.append(rank)
        self._depth.append(depth)
        self._inside.append(inside or rank >= 2)
        self._own_path.append(self._own_path[up] if depth > MAX_PATH else len(self.tag) - 1)
        self._places.setdefault(name, []).append(len(self._open))
        if name in BLOCK:
            self._open_blocks.append(len(self._open))
        self._open.append(len(self.tag) - 1)

    def _parse(self, source: str) -> None:
        # Nothing behind the last ">" can end a tag, a comment or a raw text: no search goes further.
        at, n, last = 0, len(source), source.rfind(">") + 1
        while at < n:
            m = _TAG.search(source, at, last) if at < last else None
            if m is None:
                end = _UNCLOSED.search(source, max(at, last - 8))
                self._text(source[at:end.start() if end else n])
                break
            self._text(source[at:m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                open_end = "-->" if m[0].startswith("<!--") else "]]>" if m[0].startswith("<![CDATA[") else ""
                if not m[0].endswith(open_end):
                    break       # never closed: the rest is not shown
                continue
            if m["end"] or m["end2"]:
                self._close(name)
                continue
            attrs = m["attrs"] or m["attrs2"] or ""
            self._start(name, attrs)
            if name in _RAW_END and not attrs.endswith("/"):
                end = _RAW_END[name].search(source, at, last)
                at = end.end() if end else n   # raw text is never shown
                self._close(name)
        self._flush()

    def paths(self, node: int) -> set[int]:
        """The paths of an element and all that it stands in."""
        node = self._own_path[node]
        if node != self._last_paths[0]:
            out, k = set(), node
            while k > 0:
                out.add(self.path[k])
                k = self.parent[k]
            self._last_paths = node, out
        return self._last_paths[1]

    def within(self, nodes: set[int]) -> list[bool]:
        """For each element whether it is one of the nodes or stands in one."""
        out = [False]
        for k in range(1, len(self.tag)):
            out.append(k in nodes or out[self.parent[k]])
        return out

    def ranked(self, rank: int) -> set[int]:
        """The elements of that rank outside noise."""
        return {k for k, r in enumerate(self.rank) if r == rank and not self.noise[k]}

    def features(self) -> dict[int, Counter[str]]:
        """Characters of each clause and link target that stands directly in a path (link targets follow a line break)."""
        own: dict[int, Counter[str]] = {}
        for block in self.blocks:
            for k, t in block:
                mine = own.setdefault(self.path[k], Counter())
                for clause in _CLAUSE.split(" ".join(t.split())):
                    if clause:
                        mine[clause] += len(clause)
        for k, target in self.links:
            own.setdefault(self.path[k], Counter())["\n" + target] += len(target) + 1
        return own

    def text(self, low: set[int], thin: Set[int] = frozenset(), by_names: bool = True) -> str:
        """The article: its blocks without noise and without branches of low importance.

        Articles count if they hold at least half of what the page's main elements would give, or its body if it has none;
        the headings of a main before its first article belong to it.  Otherwise the main elements are read.  Without
        those, containers that only their class marks count if they hold at least half of what the body would give.
        Branches of ``thin`` are low where a main or the body is read.  Without names only the tree decides: the body is
        read without its low branches.
        """
        if thin:    # near copies share their headings: those go only with the branch that they stand in
            inside = self.within({k for k, t in enumerate(self.tag) if t in HEADINGS})
            thin = thin - {self.path[k] for k, heading in enumerate(inside) if heading}
        if not by_names:
            return self._blocks_of(set(), low | thin, False)
        articles, mains = self.ranked(3), self.ranked(2)
        whole = self._blocks_of(mains, low | thin)
        if articles:
            found = self._blocks_of(articles, low)
            if 2 * len(found) >= len(whole):
                first = min(articles)
                inside = self.within(mains)
                titles = {k for k in range(first) if self.tag[k] in HEADINGS and not self.noise[k] and inside[k]}
                return self._blocks_of(articles | titles, low) if titles else found
        if mains:
            return whole
        marked = self.ranked(1)
        if marked:
            found = self._blocks_of(marked, low)
            return found if 2 * len(found) >= len(whole) else whole
        return whole

    def _sizes(self, noise: list[bool]) -> list[int]:
        """Characters of text outside noise in and below each element."""
        sizes = [0] * len(self.tag)
        for block in self.blocks:
            for k, t in block:
                if not noise[k]:
                    sizes[k] += len(t.strip())
        for k in range(len(sizes) - 1, 0, -1):
            sizes[self.parent[k]] += sizes[k]
        return sizes

    def _blocks_of(self, main: set[int], low: set[int], by_names: bool = True) -> str:
        out = []
        noise = self.noise if by_names else self.within({k for k, t in enumerate(self.tag) if t in HIDDEN_TAGS})
        # element -> (inside the article, removed, in a low branch with most of the text)
        state: dict[int, tuple[bool, bool, bool]] = {0: (not main, False, False)}
        sizes = self._sizes(noise) if low else []
        total = 0
        if low:
            inner = self.within(main)
            total = sum(sizes[k] for k in main if not inner[self.parent[k]]) if main else sizes[0]

        def look(node: int) -> tuple[bool, bool, bool]:
            todo = []
            while node not in state:
                todo.append(node)
                node = self.parent[node]
            for k in reversed(todo):
                inside, gone, whole = state[self.parent[k]]
                gone = gone or noise[k]
                inside = inside or k in main
                if inside and not gone and not whole and self.path[k] in low:
                    whole = 2 * sizes[k] > total
                    # Inside a marked article only containers can be low.
                    if not whole and k not in main and self.tag[k] not in ("html", "body"):
                        gone = not main or self.tag[k] not in FLOW
                state[k] = (inside, gone, whole)
            return state[todo[0]] if todo else state[node]

        for block in self.blocks:
            words = "".join(t for k, t in block if look(k)[:2] == (True, False)).split()
            if words:
                out.append(" ".join(words))
        return "\n".join(out)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host_key, content, seen) of each page: what is seen as rows (node, kind, value, uses), and the hash of what is outside noise.

    Kind 0 is the node itself (value: whether it marks an article), 1 its styles, 2 the features that stand directly in it
    (uses: their characters), 3 the nodes that it stands in if it has features, itself included.
    """
    for batch in batches:
        contents, rows = [], []
        for source in batch.column("html").to_pylist():
            page = Page(source)
            shown = [k for k in range(1, len(page.tag)) if not page.noise[k]]
            seen = {(page.path[k], 0, page.style[k]) for k in shown}
            for block in page.blocks:
                if not page.noise[block[-1][0]]:
                    seen.add((page.path[block[-1][0]], 1, _hash(" ".join("".join(t for _, t in block).split()))))
            contents.append(xxhash.xxh3_64_intdigest(np.array(sorted(seen), dtype=np.int64).tobytes()) - (1 << 63))
            marks: dict[int, int] = {}
            for k in range(1, len(page.tag)):
                marks[page.path[k]] = marks.get(page.path[k], 0) | (page.rank[k] >= 2 and not page.noise[k])
            out = [(path, 0, int(m), 1) for path, m in marks.items()]
            out += [(path, 1, style, 1) for path, style in {(page.path[k], page.style[k]): 0 for k in range(1, len(page.tag))}]
            own = page.features()
            out += [(path, 2, _hash(x), n) for path, found in own.items() if path for x, n in found.items()]
            leaves = {page.path[k]: k for block in page.blocks for k, _ in block} | {page.path[k]: k for k, _ in page.links}
            out += [(path, 3, up, 1) for path, k in leaves.items() if path and own[path] for up in sorted(page.paths(k))]
            rows.append(np.array(out, dtype=np.int64).reshape(-1, 4).T.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("host_key"), pa.array(contents, pa.int64()), pa.array(rows, pa.binary())],
                                         names=["host_key", "content", "seen"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = [np.frombuffer(x, dtype=np.int64).reshape(4, -1) for x in batch.column("seen").to_pylist()]
        node, kind, value, uses = np.concatenate([np.empty((4, 0), dtype=np.int64), *seen], axis=1)
        hosts = np.repeat(np.array(batch.column("host_key").to_pylist(), dtype=np.int64), [x.shape[1] for x in seen])
        yield pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(node), pa.array(kind.astype(np.int32)), pa.array(value), pa.array(uses)],
                                         names=["host_key", "node", "kind", "value", "uses"])


def importance(pages: DataFrame) -> DataFrame:
    """host_key, node, pages, content, importance, reference of the merged tree's nodes (pages: host_key, html).

    Equal contents are one page.  content is null for a node without words and links (its importance takes it as 1);
    reference is the content of the host's articles, or of all its text if it marks none.
    """
    contents = (pages.select("host_key", "html").mapInArrow(_observe, "host_key long, content long, seen binary")
                .groupBy("host_key", "content").agg(F.min("seen").alias("seen")))
    counts = (contents.select("host_key", "seen").mapInArrow(_unpack, "host_key long, node long, kind int, value long, uses long")
              .groupBy("host_key", "node", "kind", "value").agg(F.count("*").alias("n"), F.sum("uses").alias("uses")))
    # A few rows per node: itself (with or without the mark), its styles, its features, each node that it stands in.
    kept = F.when(F.col("kind").isin(0, 3), F.col("value"))
    parts = spread(counts.groupBy("host_key", "node", "kind", kept.alias("value")).agg(
        F.count("*").alias("values"), F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("n_logs"),
        F.sum("uses").alias("uses"), F.sum(F.col("uses") * F.log("n")).alias("use_logs")), "tree-parts")
    of = lambda kind, c: F.sum(F.when(F.col("kind") == kind, F.col(c)))
    nodes = parts.filter("kind < 3").groupBy("host_key", "node").agg(
        of(0, "n").alias("pages"), F.max(F.when(F.col("kind") == 0, F.col("value"))).alias("marks"), of(1, "n").alias("looks_n"),
        of(1, "n_logs").alias("look_logs"), of(1, "values").alias("styles"), of(2, "uses").alias("uses"), of(2, "use_logs").alias("use_logs"))
    texts = parts.filter("kind = 2").select("host_key", "node", "uses", "use_logs")
    below = (parts.filter("kind = 3").select("host_key", "node", F.col("value").alias("up")).join(texts, ["host_key", "node"])
             .groupBy("host_key", F.col("up").alias("node")).agg(F.sum("uses").alias("all_uses"), F.sum("use_logs").alias("all_logs")))
    unit = F.log("pages")
    looks = (F.log("looks_n") - F.col("look_logs") / F.col("looks_n")) / unit
    share = F.pow(F.lit(GAMMA), "styles")
    says = F.when(F.col("pages") > 1, F.lit(1.0) - F.col("all_logs") / F.col("all_uses") / unit).otherwise(F.lit(1.0))
    tree = nodes.join(below, ["host_key", "node"], "left").withColumn("content", F.when(F.col("all_uses") > 0, says))
    tree = tree.withColumn("importance", F.when(
        F.col("pages") > 1, (1 - share) * looks + share * F.coalesce("content", F.lit(1.0))).otherwise(F.lit(1.0)))
    mean = lambda rows: F.sum(F.when(rows, F.col("content") * F.col("all_uses"))) / F.sum(F.when(rows, F.col("all_uses")))
    hosts = tree.groupBy("host_key").agg(F.coalesce(mean(F.col("marks") == 1), mean(F.col("uses") > 0)).alias("reference"))
    return tree.join(hosts, "host_key").select("host_key", "node", "pages", "content", "importance", "reference")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[int, tuple[set[int], set[int]]] = {}
        texts = []
        for host, low, thin, by_names, source in zip(*(batch.column(c).to_pylist() for c in ("host_key", "low", "thin", "by_names", "html")),
                                                     strict=True):
            if host not in known:
                known[host] = set(low or ()), set(thin or ())
            texts.append(Page(source).text(*known[host], by_names))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def extract(pages: DataFrame, low_importance: float = LOW_IMPORTANCE, min_pages: int = MIN_PAGES, relative: float = RELATIVE,
            by_names: bool = True) -> DataFrame:
    """page_id, url, text of every page row.  Without ``by_names`` the tree alone decides what is removed from the body.

    pages: page_id, url, html; other columns are not read.  A null or empty html gives an empty text; a null url belongs to
    the empty host.  Blocks are block-level elements; their white space is one space, blocks are joined by a newline in
    page order.  Without article, main or a container marked as one, or where articles hold less than
    half of the text, the main or body is read.  Elements nested more than ``MAX_PATH`` deep count in the tree
    as part of the element at that depth; their text is read like any other.  Time and memory follow the length of a page,
    however deep or broken its markup is.  Repeated rows give a row each; rows of a host that are equal outside noise count as one page.  An empty table gives an empty one.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host_key", F.xxhash64(host_of(F.col("url"))))
    tree = importance(rows)
    is_low, is_thin = F.col("importance") < low_importance, F.col("content") < relative * F.col("reference")
    low = tree.filter((F.col("pages") >= min_pages) & (is_low | is_thin))
    low = spread(low.groupBy("host_key").agg(F.collect_set(F.when(is_low, F.col("node"))).alias("low"),
                                             F.collect_set(F.when(is_thin, F.col("node"))).alias("thin")), "low-branches")
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.join(low, "host_key", "left").select(
        "page_id", "url", "html", "host_key", "low", "thin", F.lit(by_names).alias("by_names")).mapInArrow(
        _extract, f"page_id {kind}, url string, text string")
