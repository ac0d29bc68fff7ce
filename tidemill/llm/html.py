"""Main text of web pages by consensus paths of their hosts.

Each page's containers are scored by the text they hold outside links and boilerplate. A page's
votes, shares of its score by generalised tag-class path, are summed by host in Spark; the path with most
votes is the host's. Pages are then extracted anew along their host's path; a page without such a container, or
without a host, goes by its own best one. From there extraction climbs to the outermost article or main, or else to the
highest container with text of its own next to the way up: headings, paragraphs, lists, tables, quotes, sections. The
page itself is a container, with path "/".
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

# a quote opens a value only after "="; quoted values may hold "<" and ">", unquoted ones quotes. A quote that nothing closes counts as any other character
TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>|<[/!?a-zA-Z][^<>]*+>|[^<]++|<")
#: For a page in which some tag never ends: no value holds a bracket, so what is behind is not read again for each tag.
PLAIN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>|<[/!?a-zA-Z][^<>]*+>|[^<]++|<")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
RAW = {t: re.compile(f"</{t}", re.IGNORECASE) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINER = frozenset("body div section article main aside nav header footer form table ul ol dl blockquote".split())
BLOCK = CONTAINER | frozenset("html head p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre figure figcaption fieldset address hr details summary hgroup center option".split())
#: Tags, whole classes (and whole ids of blocks), and roles of what is not the article.
SKIP_TAG = frozenset("head title nav aside header footer form button select menu dialog svg object audio video canvas noscript script style template iframe textarea".split())
SKIP_WORD = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar header masthead footer social share sharing related recommended newsletter subscribe signup login search"
    " comment comments commentlist disqus reply replies respond widget skip".split()
)
SKIP_WORD |= {f"{a}-{b}" for a in ("site", "page") for b in SKIP_WORD}
SKIP_WORD |= frozenset("ad-slot ad-container cookie-banner cookie-notice cookie-consent share-buttons social-share related-posts related-articles newsletter-signup main-menu main-nav nav-menu comment-list comments-area comment-form reader-comments user-comments disqus_thread".split())
#: Ids that leave out a section too; other ids of sections are anchors of the text.
SECTION_ID = frozenset("comments comment-list comments-area reader-comments respond disqus_thread sidebar footer nav navigation menu".split())
#: What neither classes nor ids leave out; and how many times the text that stays they may leave out of a page.
EXEMPT = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
MOST = 4
SKIP_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: What of a container's score its parent has too, and so on upwards.
UP = 0.5
#: Containers that are parts of a text, not the whole of it.
PART = frozenset("section table ul ol dl blockquote".split())
#: Hosts whose paths may be broadcast, and votes that a task combines.
HOSTS = 100_000


class Page:
    """nodes: (path, parent), and their tags; blocks: (node, pieces of raw text, characters in links) outside boilerplate, in page order."""

    __slots__ = ("blocks", "nodes", "tags")

    def __init__(self, text: str) -> None:
        kept, lost = self._read(text, words=True)
        if lost > MOST * kept:
            self._read(text, words=False)

    def _read(self, text: str, words: bool) -> tuple[int, int]:
        """Characters that stay, and those that are left out by classes and ids alone, which count only if `words`."""
        self.nodes: list[tuple[str, int]] = [("/", -1)]
        self.tags: list[str] = [""]
        self.blocks: list[tuple[int, list[str], int]] = []
        kept = lost = 0
        # of an open element: tag, node, whether it is left out (1, or 2 by its class or id), whether it is in a link
        stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        pieces: list[str] = []
        links = at = 0

        def flush() -> None:
            nonlocal pieces, links
            if pieces:
                self.blocks.append((stack[-1][1], pieces, links))
                pieces, links = [], 0

        n = len(text)
        tokens = TOKEN
        while at < n:
            m = tokens.match(text, at)
            if tokens is TOKEN and m[2] is None and m[0][0] == "<" and text[at + 1 : at + 2].isalpha():
                tokens = PLAIN  # this tag never ends
                m = tokens.match(text, at)
            at = m.end()
            name = m[2]
            if name is None:
                raw = m[0]
                if raw == "<!--":
                    end = text.find("-->", at)
                    at = n if end < 0 else end + 3
                elif raw[0] != "<" or raw == "<":
                    if not stack[-1][2]:
                        pieces.append(raw)
                        kept += len(raw.strip())
                        if stack[-1][3]:
                            links += len(raw)
                    elif stack[-1][2] == 2:
                        lost += len(raw.strip())
                continue
            tag = name.lower()
            if m[1]:
                if any(s[0] == tag for s in reversed(stack)):
                    if tag in BLOCK:
                        flush()
                    while stack.pop()[0] != tag:
                        pass
                elif tag in ("p", "br"):
                    flush() if tag == "p" else pieces.append(" ")
                continue
            if tag == "br":
                if not stack[-1][2]:
                    pieces.append(" ")
                continue
            if tag in BLOCK:
                flush()
                self._close_implied(stack, tag)
            if tag in VOID:
                continue
            _, node, skip, link = stack[-1]
            attributes = m[3]
            classes: list[str] = []
            if attributes and skip != 1:
                by, classes = self._skips(tag, attributes)
                skip = 1 if by == 1 else skip or (by if words else 0)
            if tag in SKIP_TAG:
                skip = 1
            if tag in RAW:
                end = RAW[tag].search(text, at)
                at = n if end is None else end.start()
                skip = 1
            if tag in CONTAINER and not skip:
                self.nodes.append((f"{self.nodes[node][0].rstrip('/')}/{'.'.join([tag, *classes])}", node))
                self.tags.append(tag)
                node = len(self.nodes) - 1
            if tag in BLOCK or tag in RAW or not CLOSED.search(attributes):
                stack.append((tag, node, skip, link or tag == "a"))
        flush()
        return kept, lost

    @staticmethod
    def _close_implied(stack: list, tag: str) -> None:
        """A block ends an open paragraph, an item the open item of its list, a cell or row the one before it."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(tag, ())
        walls = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            t = stack[i][0]
            if t in ends or t == "p":
                del stack[i:]
                if t == "p" and ends:
                    continue
                if tag != "tr":
                    return
            elif t in walls or t in CONTAINER and not ends:
                return

    @staticmethod
    def _skips(tag: str, attributes: str) -> tuple[int, list[str]]:
        """Whether an element is boilerplate by its attributes (2: by its class or id alone), and its generalised classes."""
        skip, word, classes = 0, False, []
        for k, a, b, c in ATTRIBUTE.findall(attributes):
            k, v = k.lower(), entities.unescape(a or b or c).lower()  # noqa: PLW2901
            if k == "class":
                word = word or not SKIP_WORD.isdisjoint(v.split())
                classes = sorted({re.sub("[0-9]+", "N", w) for w in v.split()})
            elif k == "id":
                word = word or tag in BLOCK and v.strip() in (SECTION_ID if tag == "section" else SKIP_WORD)
            elif k == "hidden" or k == "role" and v.strip() in SKIP_ROLE or k == "aria-hidden" and v.strip() == "true" or k == "style" and re.search(r"display\s*:\s*none", v):
                skip = 1
        return skip or (2 if word and tag not in EXEMPT else 0), classes

    def scores(self) -> list[float]:
        """Of each node: characters outside links that it holds itself, and UP of what its containers have."""
        out = [0.0] * len(self.nodes)
        for node, pieces, links in self.blocks:
            out[node] += max(0, sum(len(p.strip()) for p in pieces) - 2 * links)
        for i in range(len(out) - 1, 0, -1):  # a node comes after its parent
            out[self.nodes[i][1]] += UP * out[i]
        return out

    def votes(self) -> list[tuple[str, int]]:
        """(path, millionths of the page's score)."""
        by: dict[str, float] = {}
        for (path, _), s in zip(self.nodes, self.scores()):  # noqa: B905
            if s > 0:
                by[path] = by.get(path, 0.0) + s
        total = sum(by.values())
        return [(p, round(1e6 * s / total)) for p, s in by.items()]

    def _climb(self, node: int) -> int:
        """The ancestor of a node, or the node itself, that holds the text next to it."""
        scores = self.scores()
        direct, beside = [False] * len(self.nodes), [[] for _ in self.nodes]
        for i, pieces, links in self.blocks:
            direct[i] = direct[i] or sum(len(p.strip()) for p in pieces) > 2 * links
        for i in range(1, len(self.nodes)):
            if scores[i] > 0 and self.tags[i] in PART:
                beside[self.nodes[i][1]].append(i)
        top, way = node, [node]
        while (up := self.nodes[way[-1]][1]) >= 0:
            if direct[up] or self.tags[way[-1]] in PART or any(i != way[-1] for i in beside[up]):
                top = up
            way.append(up)
        articles = [i for i in way if self.tags[i] in ("article", "main")]
        return articles[-1] if articles else top

    def text(self, path: str | None) -> tuple[str, str | None]:
        """The page's text along a path, and the path that was used."""
        paths = {p for p, _ in self.nodes}
        if not path or path not in paths:
            path = min(self.votes(), key=lambda x: (-x[1], x[0]), default=(None, 0))[0]
        chosen = [i for i, (p, _) in enumerate(self.nodes) if p == path]
        parents = {self.nodes[i][1] for i in chosen}
        if len(chosen) > 1 and len(parents) == 1:  # parts of one article, with what stands between them
            chosen = [*parents]
        chosen = {self._climb(i) for i in chosen}
        inside = [False] * len(self.nodes)
        for i, (_, parent) in enumerate(self.nodes):
            inside[i] = path is None or i in chosen or parent >= 0 and inside[parent]
        out = []
        for node, pieces, _ in self.blocks:
            if inside[node] and (block := " ".join("".join([entities.unescape(p) for p in pieces]).split())):
                out.append(block)
        return "\n".join(out), path


def host_of(url_col: str):  # noqa: ANN201
    """The lower-case host of a URL; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes, pages): the winning path of each host. Ties go to the path that sorts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[int]] = {}

        def out() -> pa.RecordBatch:
            rows = [(*k, *v) for k, v in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.string(), pa.string(), pa.int64(), pa.int64()])], ["host", "path", "votes", "pages"])

        for b in batches:
            for host, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):  # noqa: B905
                for path, n in Page(text or "").votes():
                    got = held.setdefault((host, path), [0, 0])
                    got[0] += n
                    got[1] += 1
                if len(held) >= HOSTS:
                    yield out()
        yield out()

    x = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html")).filter("host <> ''").mapInArrow(run, "host string, path string, votes bigint, pages bigint")
    x = x.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages"))
    best = F.min(F.struct((-F.col("votes")).alias("v"), "path", "pages"))
    return x.groupBy("host").agg(best.alias("b")).select("host", F.col("b.path").alias("path"), (-F.col("b.v")).alias("votes"), F.col("b.pages").alias("pages"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_hosts: int = HOSTS) -> DataFrame:
    """One row for each row of `pages`: id, url, text, n_chars, path.

    Null html counts as empty: empty text. Null ids and urls are carried, repeated rows give a row each, other
    columns are not read, whatever their names, an empty table gives an empty result. Of containers of equal votes, of a host or
    of one page, the path that sorts first counts. The hosts' paths are broadcast only up to `broadcast_hosts`
    hosts; beyond, pages are joined by host, which adaptive execution splits where one host has many.
    """
    paths = cut(host_paths(pages, url_col, html_col).select(F.col("host").alias("h_"), "path"))
    few = paths.limit(broadcast_hosts + 1).count() <= broadcast_hosts
    x = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"), F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("host"))
    x = x.join(F.broadcast(paths) if few else paths, F.col("host") == F.col("h_"), "left")
    types = pages.schema
    schema = f"id {types[id_col].dataType.simpleString()}, u {types[url_col].dataType.simpleString()}, text string, n_chars bigint, path string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [Page(t or "").text(p) for t, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]  # noqa: B905
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([t for t, _ in got], pa.string()), pa.array([len(t) for t, _ in got], pa.int64()), pa.array([p for _, p in got], pa.string())], ["id", "u", "text", "n_chars", "path"])

    return x.select("id", "u", "html", "path").mapInArrow(run, schema).select(F.col("id").alias(id_col), F.col("u").alias(url_col), "text", "n_chars", "path")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of all `pages`."""
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op8_html_extraction": op8_html_extraction}
ORACLE_SQL: dict[str, str] = {}
