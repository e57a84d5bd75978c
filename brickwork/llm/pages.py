"""Main text of web pages by a site style tree.

Pages of one host are merged into a style tree, whose nodes are paths of elements with their classes.
A node's importance joins two entropies over the host's pages: of the styles in which its children
appear, and of the texts that it holds; what stands alike on many pages weighs little. A text has an
importance too, by the share of pages that have it at its path. A block goes if its own text or a branch
above it is below a threshold. Where the block stands is the prior, which sets the threshold: `held`
inside an article or main element, `beside` next to one (for the text and its own node), `least` on pages
without any. Inside, a low branch takes along only texts that are repeated themselves (below `common`),
and the tree never takes all. On a host without evidence, what stands beside goes if the article or main
element holds most of the text.

Noise goes by element (navigation, scripts) and by whole class words. Comments, adverts and the like vary
from page to page, so entropy can't tell them, and their word alone decides. Words of what a site repeats
(menus, notices, shares) and forms are taken for noise only if the tree confirms it (below `beside`);
without evidence a word decides outside of article and main only, and if it doesn't mark most of the text,
a form everywhere, and neither if nothing would be left. Ids say nothing of noise. An article or main element starts anew without the
noise around it; an article inside what is noise for sure counts only if the page has no other text.

Defined results: null and empty pages have an empty text; a host with fewer than `pages` pages of
different content has no evidence and removes nothing by entropy; a null url is the host ""; repeated
rows count as one page and are each returned; white space is what str.split takes for it; `br` is
white space; further columns are ignored; an empty table gives no rows; rows without page_id are each
returned. A host lists at most (blocks a page) * pages ** (1 - common) repeated texts, and its branches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C


@dataclass(frozen=True)
class StyleConfig:
    least: float = 0.2
    held: float = 0.1
    beside: float = 0.5
    #: Texts at least as important are not listed; a host lists at most (blocks a page) * pages ** (1 - common).
    common: float = 0.5
    pages: int = 5
    #: Share of the styles' entropy; the rest is the texts'.
    styles: float = 0.1
    #: Rows of unimportant branches that are small enough to broadcast (about 50 bytes each).
    broadcast_rows: int = 100_000


#: A quote opens a value only after "=", and only if the one that closes it ends the value; any other is a plain character, which ">" ends with the tag.
_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>=]+|=\s*"[^"]*"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|=)*+)>|<[!?][^>]*>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption option select".split())
_NOISE = frozenset("nav header footer aside form head menu select button dialog label fieldset input option object canvas audio video".split()) | _RAW
_MAIN = frozenset(("article", "main"))
_CLOSES_P = _BLOCK - {"body", "html"}
_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_COMMENT = frozenset("comment comments comment-list comments-area comment-respond".split())
_VARIED = _COMMENT | frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo disqus reply replies related related-posts recommended".split())
_ALIKE = frozenset("banner cookie cookies consent gdpr notice alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer header masthead share sharing social newsletter subscribe signup login search pagination pager tags widget toolbar copyright cookie-banner site-header site-footer share-buttons".split())
#: How sure noise is: by a word or a form the tree must confirm it.
WORD, FORM, SURE = 1, 2, 3
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)")
_DIGITS = re.compile(r"\d+")


def host(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


class Page:
    """The blocks of a page as (path, text, noise, main), and the child styles of its nodes.

    main is 1 inside an article or main element, 2 inside an article that stands in sure noise.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, str, int, int]] = []
        self.styles: list[tuple[str, str]] = []
        self.stack: list[tuple[str, str, int, int, list[str]]] = [("", "", 0, 0, [])]
        self.text: list[str] = []
        at, raw = 0, ""
        for m in _TOKEN.finditer(html):
            if raw:
                if not (m[2] and m[1] and m[2].lower() == raw):
                    continue
                at, raw = m.start(), ""
            if m.start() > at:
                self.text.append(html[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                self.close(name)
            else:
                self.open(name, m[3])
                if name in _RAW and not m[3].rstrip().endswith("/"):
                    raw = name
        if not raw and at < len(html):
            self.text.append(html[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()

    def flush(self) -> None:
        if self.text:
            text = " ".join(unescape("".join(self.text)).split())
            if text:
                _, path, noise, main, _ = self.stack[-1]
                self.blocks.append((path, text, noise, main))
            self.text = []

    def pop(self) -> None:
        name, path, _, _, children = self.stack[-1]
        if name in _BLOCK or name in _NOISE:
            self.flush()
        self.stack.pop()
        if children:
            self.styles.append((path, " ".join(children)))

    def open(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text.append(" ")
            return
        if name in _BLOCK or name in _NOISE:
            self.flush()
        if name in _CLOSES_P:
            self.close_to(("p",), _MAIN | {"div", "td", "li", "section", "body", "blockquote"})
        if name in _SELF:
            self.close_to(_SELF[name], frozenset(("ul", "ol", "dl", "table", "select")))
        if name in _VOID:
            return
        _, path, noise, main, children = self.stack[-1]
        found = [(x[0].lower(), x[1] or x[2] or x[3]) for x in _NAMES.findall(attributes)] if attributes else []
        words = {w for kind, x in found if kind != "id" for w in x.lower().split()}
        # ids inside an article are mostly slugs of their own, which would part the pages' paths
        names = " ".join(x for kind, x in found if kind != "id" or not (main or name in _MAIN))
        style = name
        if names:
            style += "." + _DIGITS.sub("0", names)
        if not (children and children[-1] == style):
            children.append(style)
        if name in _MAIN:
            main = 1 if name == "main" else 2 if noise == SURE or main == 2 else 1
            noise = SURE if name == "article" and words & _COMMENT else 0
        elif name not in ("body", "html"):
            own = SURE if words & _VARIED or (name in _NOISE and name != "form") else FORM if name == "form" else WORD if words & _ALIKE else 0
            noise = max(noise, own)
        self.stack.append((name, f"{path}/{style}" if name in _BLOCK or name in _NOISE else path, noise, main, []))

    def close_to(self, names: tuple[str, ...], stop: frozenset[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in names:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in stop:
                return

    def close(self, name: str) -> None:
        if name == "br":
            self.text.append(" ")
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                while len(self.stack) > i:
                    self.pop()
                return


def _id(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def _text_id(path: str, text: str) -> int:
    return _id(f"{path}\0{text}")


def style_tree(pages: DataFrame, cfg: StyleConfig) -> DataFrame:
    """(host, path, importance) of the nodes of every host's tree, and of its repeated texts by `_text_id`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.slices(batches, "html"):
            names, whole, features = [], [], []
            for url, html in zip(b.column("url").to_pylist(), b.column("html").to_pylist(), strict=True):
                page = Page(html or "")
                found = sorted({(_id(x[0]), 0, _text_id(x[0], x[1])) for x in page.blocks} | {(_id(path), 1, _id(style)) for path, style in page.styles})
                names.append(host(url))
                whole.append(xxhash.xxh3_128_digest(np.array(found, np.int64).tobytes()))
                features.append([{"path": p, "kind": k, "feature": f} for p, k, f in [(0, 2, 0), *found]])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(whole, pa.binary()), pa.array(features, pa.list_(pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64())])))], names=["host", "whole", "features"])

    each = C.bounded(pages).select("url", "html").mapInArrow(run, "host string, whole binary, features array<struct<path:long,kind:int,feature:long>>").dropDuplicates(["host", "whole"])
    rows = each.select("host", F.inline("features"))
    # written, so that pages are parsed once for all that follows
    counted = C.written(rows.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).cast("double").alias("c")), "styles-counted")
    node = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 2, F.col("c"))).alias("m"),
        F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("texts"),
        F.sum(F.when(F.col("kind") == 0, F.col("c") * F.log("c"))).alias("same"),
        F.sum(F.when(F.col("kind") == 1, F.col("c"))).alias("n"),
        F.sum(F.when(F.col("kind") == 1, F.col("c") * F.log("c"))).alias("alike"),
    )
    size = node.where("m IS NOT NULL").select("host", F.col("m").alias("pages"))
    logs = F.log(F.col("pages"))
    content = 1 - F.col("same") / F.col("texts") / logs
    # entropy of the styles: log n - (sum of c log c) / n, on the scale of log pages
    style = (F.log("n") - F.col("alike") / F.col("n")) / logs
    # a node without text of its own is as important as what its branches hold, so those are judged
    both = F.when(F.col("texts").isNull(), F.lit(1.0)).when(F.col("n").isNull(), content).otherwise(cfg.styles * style + (1 - cfg.styles) * content)
    size = size.where(F.col("pages") >= cfg.pages)
    nodes = node.where("m IS NULL").drop("m").join(size, "host").select("host", "path", both.alias("importance"))
    texts = counted.where("kind = 0 AND c > 1").join(size, "host").select("host", F.col("feature").alias("path"), (1 - F.log("c") / logs).alias("importance")).where(F.col("importance") < cfg.common)
    return nodes.unionByName(texts).unionByName(size.select("host", F.lit(0).cast("long").alias("path"), F.lit(1.0).alias("importance")))


def main_text(html: str, low: Mapping[int, float], cfg: StyleConfig | None = None) -> str:
    """The page's text. low: importances of the host's less important paths and texts; empty if there is no evidence."""
    cfg = cfg or StyleConfig()
    found = [b for b in Page(html).blocks if b[2] < SURE]
    chosen = _chosen([b for b in found if b[3] < 2], low, cfg) or _chosen([b for b in found if b[3] == 2], low, cfg)
    return "\n".join(b[1] for b in chosen)


def _chosen(blocks: list[tuple[str, str, int, int]], low: Mapping[int, float], cfg: StyleConfig) -> list[tuple[str, str, int, int]]:
    if not low:
        sound = [b for b in blocks if not b[2] or (b[2] == WORD and b[3])]
        by_word = [b for b in blocks if not b[2] or b[2] == WORD]
        # boilerplate seldom is most of a page: then the word is no sign of it
        held = 2 * sum(len(b[1]) for b in sound) >= sum(len(b[1]) for b in by_word)
        blocks = (sound if held else by_word) or blocks
        inside = [b for b in blocks if b[3]]
        most = 2 * sum(len(b[1]) for b in inside) >= sum(len(b[1]) for b in blocks)
        return inside if inside and most else blocks
    inside = [b for b in blocks if b[3]]
    kept = [b for b in blocks if _important(b, bool(inside), low, cfg)]
    if inside and not any(b[3] for b in kept):
        kept = [b for b in blocks if (b[3] and not b[2]) or _important(b, True, low, cfg)]
    return kept


def _important(block: tuple[str, str, int, int], split: bool, low: Mapping[int, float], cfg: StyleConfig) -> bool:
    """Whether the tree keeps a block of a page that is split by an article or main element or not."""
    path, text, noise, main = block
    own = low.get(_text_id(path, text), 1.0)
    if noise or (split and not main):
        return min(own, low.get(_id(path), 1.0)) >= cfg.beside
    least = cfg.held if main else cfg.least
    branch = min((low.get(_id(p), 1.0) for p in _above(path)), default=1.0)
    return own >= least and (branch >= least or (main and own >= cfg.common))


def _above(path: str) -> Iterator[str]:
    at = len(path)
    while at > 0:
        yield path[:at]
        at = path.rfind("/", 0, at)


def extract(pages: DataFrame, cfg: StyleConfig | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    cfg = cfg or StyleConfig()
    tree = style_tree(pages, cfg)
    # the host's less important branches and texts, and the 0 that tells that there is evidence
    low = C.checkpoint(tree.where((F.col("importance") < max(cfg.least, cfg.held, cfg.beside)) | (F.col("path") == 0)))
    lists = low.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("path", "importance"))).alias("low"))
    # else written, so that the join is of two tables and can be split at a large host
    lists = F.broadcast(lists) if low.count() <= cfg.broadcast_rows else C.written(lists, "styles")
    rows = pages.select("page_id", "url", "html").withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, float]] = {}
        for b in C.slices(batches, "html"):
            texts = []
            for name, html, low in zip(b.column("host").to_pylist(), C.strings(b.column("html")), b.column("low"), strict=True):
                if name not in known:
                    known[name] = {x["path"]: x["importance"] for x in low.as_py() or ()}
                texts.append(main_text(html, known[name], cfg))
            yield pa.RecordBatch.from_arrays([b.column("page_id").cast(pa.int64()), b.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array(np.array([len(x) for x in texts], np.int64))], names=["page_id", "url", "text", "n_chars"])

    return rows.join(lists, "host", "left").select("page_id", "url", "html", "host", "low").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.table(spark, sf_dir, "pages"))
