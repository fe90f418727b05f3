"""Main text of web pages by nearest-URL page differencing, with the markup as its guard.

A page is parsed once, into text blocks in page order. What the markup itself marks as no part of an article (menus, forms, scripts, notices ...) is left
out. Then every page is compared with its neighbours in URL order within its host: their blocks are aligned by longest
common subsequence, and what they share is deleted as the site's furniture. Blocks inside an ``article`` are guarded: there, shared text is a copy and not furniture.
Pages of a host with equal blocks count as one page, so a copy is compared with the nearest page that is none. What no rule deletes stays, inside and outside landmarks.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Collection, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, textvec
from .linededup import rising

# Elements whose content is never shown, or no part of an article.
SKIPPED = set("head script style noscript template svg math iframe object embed canvas audio video map select datalist button input textarea form fieldset nav aside footer dialog menu".split())
UNSEEN = set("head template svg math iframe object embed canvas audio video map datalist".split())
RAW = set("script style textarea title noscript iframe noframes xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# Words of class, id, role and the like which mark furniture.
FURNITURE = set(
    "ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notification outbrain pager pagination paywall popup promo promoted promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar topbar widget".split()
)
LANDMARK = {"article", "main"}
# Words that name the content itself: a header of theirs holds its title.
CONTENT = set("article content entry page post recipe story title".split())
# An element that ends the open ones of the same kind where its end tag was left out.
CLOSES = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_MARKS = re.compile(r"""(?:^|\s)(class|id|role|aria-label|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
_URL = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)")
_LAYOUT = re.compile(r"\b(?:with|without|has|no)[-_]\w+")


def _furniture(attributes: str, inside: bool) -> bool:
    """Whether the attributes mark furniture. Inside a landmark, and where it is the content's, a header holds a title."""
    for name, value in _MARKS.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name in ("class", "id", "role", "aria-label"):
            words = _SPLIT.split(_LAYOUT.sub(" ", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
            if any(w in FURNITURE and not (w == "header" and (inside or not CONTENT.isdisjoint(words))) for w in words):
                return True
    return False


def tags(source: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, name, attributes, whether it ends) of the tags, in one pass; comments and declarations have the name "".

    A quote counts only after an equals sign, and only if it is closed. The receiver may send a place to go on from.
    """
    at, n = 0, len(source)
    unclosed: dict[str, int] = {}  # places from which on a quote is not found any more
    while True:
        at = source.find("<", at)
        if at < 0:
            return
        after = source[at + 1 : at + 2]
        if after in ("!", "?"):
            mark = next((m for m in ("<!--", "<![CDATA[") if source.startswith(m, at)), None)
            close = {"<!--": "-->", "<![CDATA[": "]]>", None: ">"}[mark]
            end = source.find(close, at + len(mark or "<!"))
            end = n if end < 0 else end + len(close)
            yield at, end, "", "", False
            at = end
            continue
        ends = after == "/"
        name = _NAME.match(source, at + 1 + ends)
        if not name:
            at += 1
            continue
        end = name.end()
        while True:
            stop = _STOP.search(source, end)
            if not stop:
                end = close_at = n
                break
            end = stop.end()
            if stop[0] == ">":
                close_at = end - 1
                break
            if source[max(name.end(), end - 40) : end - 1].rstrip().endswith("=") and end < unclosed.get(stop[0], n + 1):
                other = source.find(stop[0], end)
                if other < 0:
                    unclosed[stop[0]] = min(end, unclosed.get(stop[0], end))
                else:
                    end = other + 1
        go_on = yield at, end, name[0].lower(), source[name.end() : close_at], ends
        at = end if go_on is None else go_on


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I)


class _Open:
    """The open elements. Each step takes constant time, however deep they are nested."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int]] = []  # name, skipped, depth of landmarks: 2 in an article, 1 in main
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, skipped: bool, level: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, skipped, level))

    def close(self, name: str, through_blocks: bool) -> None:
        """End the last open element of that name and all in it; not across a block element, unless it may."""
        at = self.places.get(name)
        if not at or not through_blocks and self.blocks and self.blocks[-1] > at[-1]:
            return
        for _ in range(len(self.stack) - at[-1]):
            self.places[self.stack.pop()[0]].pop()
        while self.blocks and self.blocks[-1] >= len(self.stack):
            self.blocks.pop()

    def top(self) -> tuple[str, bool, int]:
        return self.stack[-1] if self.stack else ("", False, 0)


def blocks(page: str | None, marks: bool = True) -> list[tuple[str, int]]:
    """(text, level) of a page's blocks, without what the markup marks as furniture (unless not ``marks``); level is 2 in an article, 1 in a main element, else 0."""
    out: list[tuple[str, int]] = []
    open_ = _Open()
    text: list[str] = []
    source, at = page or "", 0

    def flush() -> None:
        if text:
            joined = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
            text.clear()
            if joined:
                out.append((joined, open_.top()[2]))

    found = tags(source)
    tag = next(found, None)
    while tag is not None:
        start, end, name, attributes, ends = tag
        skipped, go_on = open_.top()[1], None
        if start > at and not skipped:
            text.append(source[at:start])
        at = end
        if not name:
            pass
        elif ends:
            if name in BLOCKS and not skipped:
                flush()
            open_.close(name, name in BLOCKS or name in SKIPPED)
        elif name in VOID:
            if not skipped and name in ("br", "hr"):
                text.append(" ")
                if name == "hr":
                    flush()
        else:
            if name in BLOCKS and not skipped:
                flush()
            for ended, by in CLOSES.items():
                if name in by:
                    open_.close(ended, False)
            _, above, level = open_.top()
            level = 2 if name == "article" else max(1, level) if name == "main" else level
            drop = above or name in SKIPPED and (marks or name in RAW or name in UNSEEN)
            drop = drop or marks and (name == "header" and level == 0 or name not in ("html", "body", *LANDMARK) and _furniture(attributes, level > 0))
            if name in RAW:
                close = _raw_end(name).search(source, at)
                stop = source.find(">", close.end()) if close else -1
                at = go_on = len(source) if stop < 0 else stop + 1
            elif not (attributes.endswith("/") and name not in BLOCKS):
                open_.push(name, drop, level)
        try:
            tag = found.send(go_on)
        except StopIteration:
            tag = None
    if at < len(source) and not open_.top()[1]:
        text.append(source[at:])
    flush()
    return out


def main_text(texts: Iterable[str], gone: Collection[int] = ()) -> str:
    """The blocks without the numbers in ``gone``."""
    return "\n\n".join(t for i, t in enumerate(texts) if i not in gone)


def place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, without user, port, query and fragment; what has no host is all path."""
    m = _URL.match(url or "")
    if not m:
        return "", url or ""
    return m[1].rpartition("@")[2].partition(":")[0].lower(), m[2] or "/"


def shared_blocks(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Places of the blocks that a longest common subsequence with a neighbour has. Equal blocks of a page are told apart by their ordinal."""
    at = {key: i for i, key in enumerate(_ordinals(other))}
    pairs = [(i, at[key]) for i, key in enumerate(_ordinals(mine)) if key in at]
    if not pairs:
        return np.zeros(0, np.int64)
    return np.array([pairs[i][0] for i in rising(np.array([b for _, b in pairs]))], np.int64)


def _ordinals(hashes: np.ndarray) -> list[tuple[int, int]]:
    seen: dict[int, int] = {}
    out = []
    for h in hashes.tolist():
        seen[h] = seen.get(h, 0) + 1
        out.append((h, seen[h]))
    return out


PARSED = "page_id bigint, url string, host string, path string, content bigint, texts array<string>, hashes array<bigint>, guarded array<int>"


def parsed(pages: DataFrame, marks: bool = True) -> DataFrame:
    """``PARSED``: each page's place and blocks, their 64-bit hashes, the places of those in an article, and a hash of all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            where = [place(u.as_py()) for u in b.column(2)]
            found = [blocks(h.as_py(), marks) for h in b.column(0)]
            hashes = [[xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in f] for f in found]
            guarded = [[i for i, (_, level) in enumerate(f) if level == 2] for f in found]
            content = [xxhash.xxh64_intdigest(repr(x).encode()) - (1 << 63) for x in zip(hashes, guarded)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(1), b.column(2), pa.array([h for h, _ in where], pa.string()), pa.array([p for _, p in where], pa.string()), pa.array(content, pa.int64()),
                    pa.array([[t.encode("utf-8", "replace").decode() for t, _ in f] for f in found], pa.list_(pa.string())),
                    pa.array(hashes, pa.list_(pa.int64())), pa.array(guarded, pa.list_(pa.int32())),
                ],
                names=["page_id", "url", "host", "path", "content", "texts", "hashes", "guarded"],
            )

    picked = pages.select(F.col("html").cast("string").alias("html"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return picked.mapInArrow(run, PARSED)


def furniture(found: DataFrame, guard: bool = True) -> DataFrame:
    """``(host, content, gone)``: places of blocks that pages share with a neighbour in URL order within their host, outside articles if ``guard``.

    The order is over all distinct pages: they are dealt to ranges of (host, path), so a host with very many pages spans many ranges. A range
    also gets the last page before it and the first one after it.
    """
    order = ["host", "path", "content"]
    one = found.where("host <> ''").groupBy("host", "content").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes"), F.first("guarded").alias("guarded"))
    dealt, _ = scratch.table(one.select(*order, "hashes", "guarded").repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "page-order")
    row = F.struct(*order, "hashes", "guarded")
    ends = dealt.groupBy("range").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    by_range = Window.orderBy("range")  # over one row for each range
    near = ends.select("range", F.lag("last").over(by_range).alias("before"), F.lead("first").over(by_range).alias("after"))
    guests = near.select("range", F.explode(F.array("before", "after")).alias("g")).where("g IS NOT NULL").select("range", "g.*", F.lit(True).alias("guest"))
    rows = dealt.withColumn("guest", F.lit(False)).unionByName(guests)
    window = Window.partitionBy("range").orderBy(*order)
    beside = lambda f: F.when(f("host").over(window) == F.col("host"), f("hashes").over(window))
    paired = rows.withColumn("before", beside(F.lag)).withColumn("after", beside(F.lead)).where("NOT guest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            gone = []
            for mine, kept, *sides in zip(*b.columns[2:]):
                mine, kept = (x.values.to_numpy(zero_copy_only=False) for x in (mine, kept))
                shared = [shared_blocks(mine, x.values.to_numpy(zero_copy_only=False)) for x in sides if x.is_valid]
                lost = np.unique(np.concatenate(shared)) if shared else np.zeros(0, np.int64)
                gone.append((np.setdiff1d(lost, kept) if guard else lost).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.list_(pa.int32()))], names=["host", "content", "gone"])

    return paired.select("host", "content", "hashes", "guarded", "before", "after").mapInArrow(run, "host string, content bigint, gone array<int>").where("size(gone) > 0")


def extract(pages: DataFrame, marks: bool = True, guard: bool = True) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``. Null html is an empty page; a page without a host has no neighbours; rows that repeat are each
    returned; pages of any length are read whole.

    Pages are parsed once and written; differencing reads the hashes of their blocks alone. What it deletes is written too: its size then tells Spark
    whether it can be broadcast, or both sides are to be shuffled.
    """
    found, _ = scratch.table(parsed(pages, marks), "page-blocks")
    gone, _ = scratch.table(furniture(found, guard), "page-furniture")
    joined = found.select("texts", "page_id", "url", "host", "content").join(gone, ["host", "content"], "left").select("texts", "gone", "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            texts = [main_text(t.as_py(), frozenset(g.as_py() or ())) for t, g in zip(b.column(0), b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(3), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
