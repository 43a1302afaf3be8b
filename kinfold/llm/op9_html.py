"""HTML extraction by consensus host paths.

Each page's containers are scored by the running text in them; a page's best container votes, with its score, for its
generalised path (tags and classes from the root, digits made alike). Spark adds the votes by host and path. Pages of a
host that have text on the same container paths are one layout; each layout takes the path of most votes among its own.
Pages are then extracted again: the text of the containers on their layout's path, else of the page's own best container.

In a container, text below menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments is
left out, and what is hidden by attribute. A `header` inside an article is a header, too; the title beside it is text. Character references are decoded, white space inside a block becomes one space, blocks are joined in page
order by one space. Null or empty html gives an empty text; a null url is a host of its own. Repeated rows give
repeated rows, each with a vote; an empty table gives none; only the named columns are read. Every voted
path counts, and no table holds a host in one row. Votes and layouts are combined map-side, so that a host with a third
of all pages is a few rows; the layouts' paths are broadcast only when they are few (`BROADCAST_LAYOUTS`), else joined by
host and layout, where Spark splits large ones.
"""

from __future__ import annotations

import hashlib
import html as html_
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import kept, table, trimmed

BROADCAST_LAYOUTS = 2_000
#: Fixed values of the HTML standard: elements without content, with raw text, and of block level.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article body center div main section td blockquote root".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements and class words of what is not the article.
ASIDE_TAGS = frozenset("nav header footer aside form head button select option menu dialog template svg object canvas audio video".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo nav navbar navigation menu header masthead footer sidebar aside notice cookie cookies consent gdpr alert popup modal overlay "
    "comment comments reply replies disqus share sharing social related recommended newsletter subscribe signup login breadcrumb breadcrumbs pagination pager widget toolbar hidden".split()
)
_MAIN_WORDS = frozenset("article content main post entry story body text".split())
_TAG = re.compile(r"""<(?:!--(.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?][^>]*>)""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_QUOTED, _HIDDEN = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')"""), re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.I)
_HEADING = re.compile(r"h[1-6]$")


def _besides(tag: str, names: list[str]) -> bool:
    if tag in ASIDE_TAGS:
        return True
    if tag in ("html", "body", "main", "root"):
        return False
    for name in names:
        parts = [x for x in re.split(r"[-_\s]+", name.lower()) if x]
        if parts and parts[0] not in ("no", "without", "has", "with") and parts[-1] not in ("free", "off", "less", "none") and (parts[0] in ASIDE_WORDS or parts[-1] in ASIDE_WORDS):
            return True
    return False


class Page:
    """The nodes of a page (parent, tag, path, whether beside the article) and its blocks of text."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.beside, self.good = [-1], ["root"], ["root"], [False], [1.0]
        self.blocks: list[tuple[int, str, int]] = []
        stack, text, linked, at, links = [0], [], 0, 0, 0

        def put(x: str) -> None:
            nonlocal linked
            if x:
                x = html_.unescape(x)
                text.append(x)
                linked += len(x) if links else 0

        def end_block() -> None:
            nonlocal linked
            if text:
                if whole := " ".join("".join(text).split()):
                    self.blocks.append((stack[-1], whole, linked))
                text.clear()
                linked = 0

        def pop_to(i: int) -> None:
            nonlocal links
            for k in stack[i:]:
                links -= self.tag[k] == "a"
            del stack[i:]

        while m := _TAG.search(source, at):
            put(source[at : m.start()])
            at = m.end()
            tag = (m[3] or m[6] or "").lower()
            if not tag:
                continue
            if m[2] or m[5]:
                if tag in BLOCK:
                    end_block()
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] == tag:
                        if tag not in ("body", "html"):
                            pop_to(i)
                        break
                    if tag not in BLOCK and self.tag[stack[i]] in BLOCK:
                        break
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in VOID:
                if tag in BLOCK:
                    end_block()
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                at = close.end() if close else len(source)
                continue
            if tag in BLOCK:
                end_block()
                for i in range(len(stack) - 1, 0, -1):
                    held = self.tag[stack[i]]
                    if held == "p" or held in CLOSES.get(tag, ()):
                        pop_to(i)
                        break
                    if held in CONTAINER or held in ("ul", "ol", "dl", "table"):
                        break
            names, role, own = [], "", m[4] or m[7] or ""
            hidden = "hidden" in own.lower() and bool(_HIDDEN.search(_QUOTED.sub("=x", own)))
            for a in _ATTRIBUTE.finditer(own):
                value = a[2] or a[3] or a[4] or ""
                if a[1].lower() == "class":
                    names = value.split()
                elif a[1].lower() == "role":
                    role = value.lower()
                elif a[1].lower() == "aria-hidden":
                    hidden |= value.lower() == "true"
            up = stack[-1]
            self.parent.append(up)
            self.tag.append(tag)
            self.path.append(f"{self.path[up]}/" + re.sub(r"\d+", "#", ".".join([tag, *names])))
            self.beside.append(hidden or _besides(tag, names) or role in ("navigation", "banner", "contentinfo", "complementary", "search"))
            words = {w for n in names for w in re.split(r"[-_]+", n.lower())}
            self.good.append((2.0 if tag in ("article", "main") or role == "main" else 1.0) * (1.5 if words & _MAIN_WORDS else 1.0))
            stack.append(len(self.tag) - 1)
            links += tag == "a"
        put(source[at:])
        end_block()

    def scores(self) -> dict[int, float]:
        """Of each container outside of what is besides the article: its blocks' text without links, halved a level up."""
        out: dict[int, float] = {}
        for node, text, linked in self.blocks:
            up, share, besides = node, max(0.0, len(text) - 1.5 * linked) * (0.3 if _HEADING.match(self.tag[node]) else 1.0), []
            while up >= 0:
                if self.beside[up]:
                    besides = []
                    break
                if self.tag[up] in CONTAINER:
                    besides.append(up)
                up = self.parent[up]
            for c in besides:
                out[c] = out.get(c, 0.0) + share * self.good[c]
                share /= 2
        return out

    def best(self) -> tuple[str, float] | None:
        held = self.scores()
        if not held:
            return None
        node = min(held, key=lambda c: (-held[c], c))
        return self.path[node], held[node]

    def layout(self) -> list[str]:
        """The paths of containers that have text outside of what is besides the article, sorted."""
        out: set[str] = set()
        for node in {node for node, _, _ in self.blocks}:
            up, held = node, []
            while up >= 0 and not self.beside[up]:
                held += [self.path[up]] if self.tag[up] in CONTAINER else []
                up = self.parent[up]
            if up < 0:
                out.update(held)
        return sorted(out)

    def text_of(self, path: str) -> str:
        """The blocks in the outermost containers on this path."""
        out = []
        for node, text, _ in self.blocks:
            up = node
            while up >= 0 and not self.beside[up] and self.path[up] != path:
                up = self.parent[up]
            found = up >= 0 and not self.beside[up]
            while found and up >= 0:  # the container itself must not be besides the article
                found, up = not self.beside[up], self.parent[up]
            if found:
                out.append(text)
        return " ".join(out)

    def main_text(self, paths: list[str]) -> str:
        for path in paths:
            if text := self.text_of(path):
                return text
        own = self.best()
        return self.text_of(own[0]) if own else ""


def _host(url) -> object:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _key(layout: list[str]) -> str:
    return hashlib.md5("\n".join(layout).encode()).hexdigest()


def _seen(pages: DataFrame, html: str, url: str) -> DataFrame:
    """host, layout, paths, path, score: of each batch's hosts and layouts, the paths with text, and the votes for the pages' best."""

    def run(batches):
        for batch in batches:
            votes: dict[tuple, int] = {}
            held: dict[str, list[str]] = {}
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = Page(source.as_py() or "")
                if (best := page.best()) is not None:
                    paths = page.layout()
                    held[key := _key(paths)] = paths
                    votes[host, key, best[0]] = votes.get((host, key, best[0]), 0) + round(best[1])
            hosts, keys, paths = ([k[i] for k in votes] for i in range(3))
            columns = [pa.array(hosts, pa.string()), pa.array(keys, pa.string()), pa.array([held[k] for k in keys], pa.list_(pa.string())), pa.array(paths, pa.string()), pa.array(list(votes.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "layout", "paths", "path", "score"])

    return pages.select(_host(F.col(url)).alias("host"), F.col(html).alias("html")).mapInArrow(trimmed(run), "host string, layout string, paths array<string>, path string, score long")


def _voted(seen: DataFrame) -> DataFrame:
    """host, path, less: every voted path; the least of (less, path) is the first of its host."""
    return seen.groupBy("host", "path").agg((-F.sum("score")).alias("less"))


def host_paths(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """host, paths: all its generalised container paths by votes."""
    ordered = F.array_sort(F.collect_list(F.struct("less", "path")))
    return _voted(_seen(pages, html, url)).groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, paths: DataFrame | None = None, *, html: str = "html", url: str = "url") -> DataFrame:
    """page_id, url, text, n_chars of each row of pages, by the hosts' paths (voted by these pages unless given)."""
    seen = kept(_seen(pages, html, url), "host-paths")
    voted = _voted(seen) if paths is None else paths.select("host", F.posexplode("paths").alias("less", "path"))
    each = seen.groupBy("host", "layout").agg(F.first("paths").alias("paths")).select("host", "layout", F.explode("paths").alias("path"))
    best = each.join(voted, ["host", "path"]).groupBy("host", "layout").agg(F.min(F.struct("less", "path"))["path"].alias("path"))
    best = kept(best, "layouts")
    few = best.limit(BROADCAST_LAYOUTS + 1).count() <= BROADCAST_LAYOUTS

    def laid(batches):
        for batch in batches:
            yield batch.append_column("layout", pa.array([_key(Page(source.as_py() or "").layout()) for source in batch.column(3)], pa.string()))

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), _host(F.col(url)).alias("host"), F.col(html).alias("html"))
    rows = rows.mapInArrow(trimmed(laid), "page_id long, url string, host string, html string, layout string")
    joined = rows.join(F.broadcast(best) if few else best, ["host", "layout"], "left").select("page_id", "url", "html", "path")

    def run(batches):
        for batch in batches:
            texts = [Page(source.as_py() or "").main_text([path.as_py()] if path.is_valid else []) for source, path in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(trimmed(run), "page_id long, url string, text string, n_chars long")


def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
