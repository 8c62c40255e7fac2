"""Main text of web pages, with templates found by counting element subtrees per host.

Repetition decides first. Each subtree of a page is hashed with its tags, names and text, and Spark counts per
host on how many distinct pages a hash occurs. What a template repeats is furniture: subtrees that are links for
the most part, or short text outside paragraphs and headings. Furniture on at least `min_pages` distinct pages of
a host is deleted, whatever the size of the host, and inside an article too if it is links or a label. A
subtree with paragraphs or headings is prose, which articles share as well: it goes only where it is on
`prose_pages` pages and `prose_share` of all distinct pages of the host, as a notice on every page is, and never
inside an explicit article. Pages with the same paragraphs and headings are one page, so copies of a page,
whatever surrounds them, do not make its text a template.

Structure settles the rest: what lies in navigation, headers, footers, asides, forms, scripts and the like, by
element, role or class name, is not text of the article; an article or main element, where there is one,
bounds it.

Templates stay rows of (host, hash), and a page gets those that it holds, so nothing grows with a host.

Edge cases: NULL or empty html gives an empty text; unclosed, misnested and truncated markup is closed
where the page ends, in time linear in the page however deep it nests; pages without a host have no template.
NULL ids and repeated rows are kept; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

MIN_PAGES = 4
PROSE_PAGES, PROSE_SHARE = 8, 0.8
SHORT, LABEL = 300, 40
# Names of elements, roles and classes by what they are for.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
OUTSIDE = frozenset("head nav footer aside form script style noscript template iframe object embed svg math canvas "
                    "audio video select button textarea input dialog menu".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu "
                          "menubar toolbar".split())
OUTSIDE_NAMES = frozenset("header footer nav navigation navbar menu sidebar side-bar masthead site-header site-footer "
                          "page-header page-footer notice notices alert alerts disclaimer breadcrumb breadcrumbs share "
                          "sharing social related related-posts subscribe subscription respond pagination pager toolbar "
                          "skip-link banner widget widgets advertisement advertising".split())
OUTSIDE_PARTS = frozenset("ad ads advert adverts adsense sponsor sponsored promo cookie cookies consent gdpr sidebar "
                          "comment comments disqus newsletter popup modal navbar menu breadcrumbs".split())
MAIN = frozenset("article main".split())
KEPT = frozenset("html body article main".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
HIDDEN = frozenset("head script style noscript template title".split())
STRAY = frozenset("p div span li b i a".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
                     "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {tag: (old.split(), within.split()) for tag, old, within in (
    ("li", "li", "ul ol menu"), ("dt", "dt dd", "dl"), ("dd", "dt dd", "dl"), ("tr", "tr td th", "table"),
    ("td", "td th", "tr table"), ("th", "td th", "tr table"), ("option", "option", "select"))}
P_CLOSING = (["p"], ["table", "button", "object", "article", "main"])
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class _Stack:
    """Open elements, with the places of each tag among them: closing asks for places and pops what it closes."""

    def __init__(self):
        self.nodes, self.tags, self.places, self.top = [0], [""], {}, 0

    def push(self, node: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(node)
        self.tags.append(tag)
        self.top = node

    def _last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags, within) -> None:
        """Close the innermost open element of these tags, unless one of within is further inside."""
        at = self._last(tags)
        if at > self._last(within):
            while len(self.nodes) > at:
                self.nodes.pop()
                self.places[self.tags.pop()].pop()
            self.top = self.nodes[-1]


class Page:
    """Elements of a page in order, with what structure says of them, and its texts and breaks."""

    def __init__(self, source: str):
        self.tag: list[str] = [""]
        self.parent: list[int] = [-1]
        self.names: list[str] = [""]
        self.out: list[bool] = [False]
        self.inner: list[bool] = [False]
        self.runs: list[tuple[int, str | None]] = []  # (element, text); a text of None is a block's edge
        self._read(source)
        self.has_main = any(self.inner)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        names, out = "", tag in OUTSIDE
        inner = self.inner[parent] or (tag in MAIN and not self.out[parent])
        if attributes and "=" in attributes:
            found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes)}
            names = f"{found.get('class', '')} {found.get('id', '')}"
            if tag not in KEPT or "comment" in names:
                whole = names.split()
                out = out or found.get("role") in OUTSIDE_ROLES or not OUTSIDE_NAMES.isdisjoint(whole) or any(
                    not OUTSIDE_PARTS.isdisjoint(re.split(r"[-_]+", n)) for n in whole)
            if found.get("role") == "main" and not self.out[parent]:
                inner = True
        if tag == "header" and not self.inner[parent]:
            out = True
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.out.append(out or self.out[parent])
        self.inner.append(inner)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack, at, end = _Stack(), 0, len(source)
        runs = self.runs
        while at < end:
            m = TAG.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                runs.append((stack.top, source[at:stop]))
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            closing, attributes = m[1] or m[4], m[3] or m[6] or ""
            if closing:
                # a stray end tag does not close the article around it
                stack.close((tag,), MAIN if tag in STRAY else ())
                if tag not in INLINE:
                    runs.append((stack.top, None))
                continue
            if tag in CLOSES_P:
                stack.close(*P_CLOSING)
            elif tag in SELF_CLOSING:
                stack.close(*SELF_CLOSING[tag])
            if tag not in INLINE:
                runs.append((stack.top, None))
            node = self._open(stack.top, tag, attributes)
            if tag in RAW:
                found = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
                if not self.out[node]:
                    runs.append((node, source[at:found.start() if found else end]))
                at = found.end() if found else end
            elif tag not in VOID and not attributes.endswith("/"):
                stack.push(node, tag)

    def candidates(self) -> dict[int, tuple[int, bool]]:
        """Subtrees that repetition may delete, by element: their hash, and whether they are prose."""
        n = len(self.tag)
        body = [hashlib.blake2b(f"{self.tag[i]} {self.names[i]}".encode("utf-8", "surrogatepass"), digest_size=8) for i in range(n)]
        size, linked, prose = [0] * n, [0] * n, [0] * n
        in_link, in_prose, hidden = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            p, tag = self.parent[i], self.tag[i]
            in_link[i] = in_link[p] or tag == "a"
            in_prose[i] = in_prose[p] or tag in PROSE
            hidden[i] = hidden[p] or tag in HIDDEN
        for i, text in self.runs:
            if text and (flat := " ".join(text.split())):
                body[i].update(flat.encode("utf-8", "surrogatepass"))
                size[i] += len(flat)
                linked[i] += len(flat) if in_link[i] else 0
                prose[i] += len(flat) if in_prose[i] and not in_link[i] else 0
        out = {}
        for i in range(n - 1, 0, -1):  # children come after their parents
            p, digest = self.parent[i], body[i].digest()
            body[p].update(digest)
            for counts in (size, linked, prose):
                counts[p] += counts[i]
            if not size[i] or hidden[i] or self.tag[i] in KEPT or self.tag[i] in INLINE:
                continue
            links = 2 * linked[i] > size[i]
            furniture = links or (not prose[i] and size[i] <= (LABEL if self.inner[i] else SHORT))
            if furniture or not self.inner[i]:
                out[i] = int.from_bytes(digest, "little", signed=True), not furniture
        return out

    def identity(self) -> bytes:
        """Digest of the paragraphs and headings, or of all text by structure if there are none."""
        held, in_prose = [], [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            in_prose[i] = in_prose[self.parent[i]] or self.tag[i] in PROSE
        for i, text in self.runs:
            if text and in_prose[i] and not self.out[i]:
                held += text.split()
        whole = " ".join(held) or self.text()
        return hashlib.blake2b(whole.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def text(self, recurring: frozenset[int] | set[int] = frozenset()) -> str:
        gone = list(self.out)
        if recurring:
            dropped = {i for i, (h, _) in self.candidates().items() if h in recurring}
            for i in range(1, len(gone)):
                gone[i] = gone[i] or i in dropped or gone[self.parent[i]]
        blocks, held = [], []
        for i, text in self.runs:
            if text is None:
                if held:
                    blocks.append(" ".join(html.unescape("".join(held)).split()))
                    held = []
            elif not gone[i] and (self.inner[i] or not self.has_main):
                held.append(text)
        blocks.append(" ".join(html.unescape("".join(held)).split()))
        return "\n".join(b for b in blocks if b)


def host(url):
    """The host of a URL in lower case, or NULL."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def _subtrees(pages: DataFrame) -> DataFrame:
    """(host, row, page, hash, prose): the candidates of each page, and a row without a hash for the page itself.

    row is a digest of the html, page one of what makes the page distinct.
    """
    known = pages.select(F.col("host"), F.col("row"), F.col("html")).where("host is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, rows, digests, hashes, proses = [], [], [], [], []
            for name, row, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = Page(source)
                own = [(None, None), *set(page.candidates().values())]
                hosts += [name] * len(own)
                rows += [row] * len(own)
                digests += [page.identity()] * len(own)
                hashes += [h for h, _ in own]
                proses += [p for _, p in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(rows, pa.binary()), pa.array(digests, pa.binary()),
                 pa.array(hashes, pa.int64()), pa.array(proses, pa.bool_())], names=["host", "row", "page", "hash", "prose"])

    return known.mapInArrow(run, "host string, row binary, page binary, hash long, prose boolean")


def _placed(pages: DataFrame) -> DataFrame:
    text = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", text.alias("html"), host(F.col("url")).alias("host"), F.unhex(F.md5(text)).alias("row"))


def recurring_subtrees(
    subtrees: DataFrame, min_pages: int = MIN_PAGES, prose_pages: int = PROSE_PAGES, prose_share: float = PROSE_SHARE
) -> DataFrame:
    """(host, hash): the subtrees that make up the template of each host."""
    counted = stored(subtrees.select("host", "page", "hash", "prose").distinct().groupBy("host", "hash").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("prose").alias("prose")).where(F.col("hash").isNull() | (F.col("n") >= min_pages)), "subtree-counts")
    furniture = counted.where("hash is not null and not prose").select("host", "hash")
    sites = counted.where("hash is null").select(F.col("host").alias("site"), F.col("n").alias("pages"))
    prose = counted.where((F.col("n") >= prose_pages) & F.col("hash").isNotNull() & F.col("prose"))
    everywhere = prose.join(sites, F.col("host") == F.col("site")).where(F.col("n") >= prose_share * F.col("pages"))
    return furniture.unionByName(everywhere.select("host", "hash"))


def extract_text(
    pages: DataFrame, min_pages: int = MIN_PAGES, prose_pages: int = PROSE_PAGES, prose_share: float = PROSE_SHARE
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    placed = _placed(pages)
    subtrees = stored(_subtrees(placed), "subtrees")
    templates = stored(recurring_subtrees(subtrees, min_pages, prose_pages, prose_share), "templates")
    held = subtrees.where("hash is not null").join(templates, ["host", "hash"])
    # a page holds at most one hash for each of its elements
    own = stored(held.groupBy(F.col("host").alias("site"), F.col("row").alias("of_row")).agg(F.collect_set("hash").alias("hashes")), "page-templates")
    rows = placed.join(own, (F.col("host") == F.col("site")) & (F.col("row") == F.col("of_row")), "left").select("page_id", "url", "html", "hashes")
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source).text(frozenset(hashes or ())) for source, hashes in zip(
                *(batch.column(i).to_pylist() for i in (2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
