"""Main text of web pages by nearest-URL page differencing (operator 11).

A page is cut into lines, one for each block of text, and each line gets a zone from the elements around it:
dropped (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, hidden parts), article,
main part, or open. Pages of a host are ordered by URL path, and each is paired with the neighbour that
shares more of its path. The longest common subsequence of both pages' lines outside articles is what the
site adds to every page: a page's lines in it are deleted.

Differencing cannot judge lines inside an article element, since articles quote passages that other
articles hold too, and copies of an article may stand side by side: those lines are always kept. Nor does it
see menus and adverts that differ from page to page: those go by their elements.

Pages of equal lines on a host are one page for the pairing, the one with the smallest path. What is
shuffled are hashes of lines; html is shuffled only for pages without an article that lose a line.
"""

import html as references
import re
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions.numbering import numbered, place
from logquarry.llm.common import bitmap, filter_bits, maybe_in, stored
from logquarry.llm.urls import split_url

DROPPED, OPEN, MAIN, ARTICLE = range(4)
LINE_BITS = 1 << 27  # of one table of an alignment; larger pairs are halved first

# Element names of HTML, and words by which sites name the parts that are not the article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_TEXT = frozenset(
    "aside audio button canvas datalist dialog footer form head map menu nav noscript object search select svg template video".split()
)
NO_TEXT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar".split()
)
PARTS = frozenset(
    "ad adbox ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies copyright disclaimer discussion disqus feedback footer form gdpr header legal login masthead menu modal nav navbar"
    " navigation newsletter notice notices notification outbrain overlay pager pagination popup promo promotion recommendations"
    " recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription taboola toolbar topbar widget widgets".split()
)
BODIES = frozenset(
    "article article-body article-content article-text articlebody content entry entry-content main main-content page-content"
    " post post-body post-content story story-body".split()
)
STATES = frozenset("has is no not with without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|iframe|noembed|noframes|xmp)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|</?([a-z][^\s/>]*+)((?>\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*+>)"
    r"|<[!?][^>]*+>"
    r"|<(?=/?[a-z])[^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s>]++))?")
_WORDS = re.compile(r"[a-z0-9]+|[A-Z]+(?![a-z])|[A-Z][a-z0-9]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Line(NamedTuple):
    zone: int
    text: str


def _names_a_part(name: str, leading: bool) -> bool:
    """Whether a class or id names a part such as a menu; with ``leading`` only by its first word."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[0] in STATES:
        return False
    return words[0] in PARTS if leading else any(w in PARTS for w in words)


def _zone(tag: str, attributes: str, around: int) -> int:
    """Zone of an element inside one of zone ``around``."""
    if around == DROPPED or tag in NO_TEXT or tag == "header":
        return DROPPED
    zone = max(around, {"article": ARTICLE, "main": MAIN}.get(tag, OPEN))
    if "=" in attributes or "hidden" in attributes:
        found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        role = found.get("role", "").lower()
        if role in NO_TEXT_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
            return DROPPED
        if _HIDDEN.search(found.get("style", "")):
            return DROPPED
        names = found.get("class", "").split() + found.get("id", "").split()
        if tag not in HEADINGS and tag not in ("html", "body", "main"):
            if any(_names_a_part(n, tag == "article") for n in names):
                return DROPPED
        if role == "article" or found.get("itemprop", "").lower() == "articlebody":
            zone = ARTICLE
        elif role == "main" or (tag in ("div", "section", "td") and any(n.lower() in BODIES for n in names)):
            zone = max(zone, MAIN)
    return zone


def lines(page: str) -> list[Line]:
    """The text blocks of a page in order, white space inside a block as one blank, empty ones left out."""
    out: list[Line] = []
    parts: list[str] = []
    zone = OPEN
    stack: list[tuple[str, int, int]] = []  # element, its zone, and the zone of headings in it where the rest is dropped

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(Line(zone, text))

    def leave(size: int) -> None:
        nonlocal zone
        if any(e[0] in BLOCKS or e[1] != zone for e in stack[size:]):
            flush()
        del stack[size:]
        zone = stack[-1][1] if stack else OPEN

    def add(text: str) -> None:
        if text:
            parts.append(references.unescape(text) if "&" in text else text)

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        tag = token.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SPACES:
            parts.append(" ")
        if page[token.start() + 1] == "/":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    leave(i)
                    break
                if tag not in BLOCKS and stack[i][0] in BLOCKS:
                    break
            continue
        if tag in BLOCKS:
            flush()
            for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph, an item ends an open item
                open_tag = stack[i][0]
                if open_tag == "p" or (open_tag == tag and tag in ("li", "dt", "dd", "tr", "option")):
                    leave(i)
                    break
                if open_tag in BLOCKS:
                    break
        if tag in VOID or token.group(3).endswith("/>") and tag not in BLOCKS:
            continue
        headings = stack[-1][2] if stack and tag not in NO_TEXT else DROPPED
        if tag == "header" and zone >= MAIN:
            headings = zone  # an article's own header holds its title
        inner = _zone(tag, token.group(3), headings if zone == DROPPED and tag in HEADINGS else zone)
        if inner != zone:
            flush()
        stack.append((tag, inner, headings))
        zone = inner
    add(page[at:])
    flush()
    return out


def candidates(found: list[Line]) -> list[bool]:
    """Which lines are in the innermost zone that the page has: its articles, else its main part, else all open ones."""
    best = max((line.zone for line in found), default=DROPPED)
    return [line.zone == best and best > DROPPED for line in found]


def _last_row(one: list[int], masks: dict[int, int], width: int) -> int:
    """Bit-parallel row of the table of common subsequences of all of ``one``; a zero bit is a step up."""
    row = full = (1 << width) - 1
    for x in one:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return row


def _masks(other: list[int]) -> dict[int, int]:
    places: dict[int, list[int]] = {}
    for j, x in enumerate(other):
        places.setdefault(x, []).append(j)
    out = {}
    for x, at in places.items():
        table = np.zeros(len(other), np.uint8)
        table[at] = 1
        out[x] = int.from_bytes(np.packbits(table, bitorder="little").tobytes(), "little")
    return out


def _steps(row: int, width: int) -> np.ndarray:
    """Length of the common subsequence with each prefix of the other side."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-width // 8), "little"), np.uint8), bitorder="little")[:width]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(one: list[int], other: list[int]) -> list[int]:
    """Positions in ``one`` of a longest common subsequence with ``other``; memory stays bounded for any lengths."""
    shared = set(one) & set(other)
    keep = [i for i, x in enumerate(one) if x in shared]
    a, b = [one[i] for i in keep], [x for x in other if x in shared]
    out: list[int] = []

    def align(lo: int, hi: int, low: int, high: int) -> None:
        while lo < hi and low < high and a[lo] == b[low]:
            out.append(keep[lo])
            lo, low = lo + 1, low + 1
        tail = []
        while lo < hi and low < high and a[hi - 1] == b[high - 1]:
            tail.append(keep[hi - 1])
            hi, high = hi - 1, high - 1
        if lo < hi and low < high:
            width = high - low
            masks = _masks(b[low:high])
            if hi - lo == 1:
                if a[lo] in masks:
                    out.append(keep[lo])
            elif (hi - lo) * width <= LINE_BITS:
                row = full = (1 << width) - 1
                rows = [row]
                for x in a[lo:hi]:
                    hit = row & masks.get(x, 0)
                    row = ((row + hit) | (row - hit)) & full
                    rows.append(row)
                found, i, j = [], hi - lo, width
                while i and j:
                    if rows[i] >> (j - 1) & 1:
                        j -= 1  # no step at j: the last line of the other side is not needed
                    elif rows[i - 1] >> (j - 1) & 1:
                        found.append(keep[lo + i - 1])  # the step is new in row i: a match of i and j
                        i, j = i - 1, j - 1
                    else:
                        i -= 1
                out.extend(reversed(found))
            else:
                middle = (lo + hi) // 2
                front = _steps(_last_row(a[lo:middle], masks, width), width)
                back = _steps(_last_row(a[middle:hi][::-1], _masks(b[low:high][::-1]), width), width)[::-1]
                cut = low + int(np.argmax(front + back))
                align(lo, middle, low, cut)
                align(middle, hi, cut, high)
        out.extend(reversed(tail))

    align(0, len(a), 0, len(b))
    return out


def _hash(text: str) -> int:
    """A 64-bit hash that is the same in every process."""
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _page_keys(found: list[Line]) -> tuple[int, int]:
    """Two 64-bit hashes of all lines and their zones."""
    digest = blake2b(digest_size=16)
    for line in found:
        digest.update(bytes([line.zone]) + line.text.encode("utf-8", "replace") + b"\0")
    whole = digest.digest()
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(url, html) to (host, path, k1, k2, open, hashes) of pages that have a host and lines outside articles."""
    for batch in batches:
        rows = []
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host, path = split_url(url)
            found = lines(page or "") if host else []
            outside = [line for line in found if line.zone != ARTICLE]
            if outside:
                judged = len(outside) == len(found) and any(line.zone != DROPPED for line in found)
                rows.append((host, path, *_page_keys(found), judged, [_hash(line.text) for line in outside]))
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "k1", "k2", "open", "hashes"])


def nearness(path: str, other: str) -> tuple[int, int]:
    """How near two paths are: whole leading segments in common, then leading characters."""
    one, two = path.split("/"), other.split("/")
    segments = next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))
    characters = next((i for i, (x, y) in enumerate(zip(path, other)) if x != y), min(len(path), len(other)))
    return segments, characters


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, k1, k2, path, hashes, before, after) to (host, k1, k2, gone): places of lines that the nearest page shares."""
    for batch in batches:
        rows = []
        for host, k1, k2, path, hashes, before, after in zip(*(c.to_pylist() for c in batch.columns)):
            near = [n for n in (before, after) if n is not None and n["host"] == host]
            if near:
                best = max(near, key=lambda n: nearness(path, n["path"]))  # the one before at a tie
                gone = common_lines(hashes, best["hashes"])
                if gone:
                    rows.append((host, k1, k2, gone))
        types = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["host", "k1", "k2", "gone"])


def shared_lines(pages: DataFrame) -> DataFrame:
    """(host, k1, k2, gone) for pages (url, html) without an article: places of the lines that the nearest page has too."""
    outlines = pages.mapInArrow(_outline, "host string, path string, k1 bigint, k2 bigint, open boolean, hashes array<bigint>")
    firsts = outlines.groupBy("host", "k1", "k2").agg(F.min_by(F.struct("path", "open", "hashes"), "path").alias("page"))
    ordered = firsts.select("host", "k1", "k2", "page.*").orderBy("host", "path", "k1", "k2").withColumn("place", place())
    rows = stored(numbered(stored(ordered), "n"))
    near = F.struct("host", "path", "hashes")
    before = rows.select((F.col("n") + 1).alias("n"), near.alias("before"))
    after = rows.select((F.col("n") - 1).alias("n"), near.alias("after"))
    paired = rows.where("open").join(before, "n", "left").join(after, "n", "left")
    columns = paired.select("host", "k1", "k2", "path", "hashes", "before", "after")
    return columns.mapInArrow(_shared, "host string, k1 bigint, k2 bigint, gone array<int>")


def _texts(batches: Iterator[pa.RecordBatch], table: np.ndarray, losing: bool) -> Iterator[pa.RecordBatch]:
    """(id, url, html) to (id, url, host, k1, k2, lines) of the pages that may lose lines, or of all others.

    A page that may lose lines keeps its places: lines that are not to be returned are null.
    """
    for batch in batches:
        at, rows = [], []
        for i, (url, page) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            found, host = lines(page or ""), split_url(url)[0]
            chosen = candidates(found)
            keys, may_lose = (0, 0), False
            if host and any(c and line.zone != ARTICLE for c, line in zip(chosen, found)):
                keys = _page_keys(found)
                may_lose = bool(maybe_in(table, np.array([keys[0]], np.int64).view(np.uint64))[0])
            if may_lose == losing:
                at.append(i)
                texts = [line.text if c else None for c, line in zip(chosen, found)]
                rows.append((host, *keys, texts if losing else [t for t in texts if t is not None]))
        take = pa.array(at, pa.int64())
        types = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), *columns], names=["page_id", "url", "host", "k1", "k2", "lines"]
        )


def _without_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, url, lines, gone) to (id, url, lines) without the places in ``gone`` and the nulls."""
    for batch in batches:
        kept = []
        for texts, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            places = set(gone or ())
            kept.append([t for i, t in enumerate(texts) if t is not None and i not in places])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.list_(pa.string()))], names=["page_id", "url", "lines"])


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``: the article's blocks joined by two line ends.

    A null or empty html has an empty text. A page without a host (null url too) is not paired, nor is the
    only page of a host: nothing is deleted from it. Repeated rows give a row each with the same text, ids
    may be null; other columns are ignored; no rows, no result. Truncated pages and unclosed elements are
    read to their end. A page of which every line is shared has an empty text.
    """
    source = pages.select(*(F.col(f"`{c}`") for c in (id_column, url_column)), F.col(f"`{html_column}`").cast("string").alias("html"))
    source = source.toDF("page_id", "url", "html").withColumn("url", F.col("url").cast("string"))
    deleted = stored(shared_lines(source.select("url", "html")))
    table = source.sparkSession.sparkContext.broadcast(bitmap(deleted, "k1", filter_bits(deleted.count(), 4)))
    kind = source.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, host string, k1 bigint, k2 bigint, lines array<string>"
    text = F.array_join("lines", "\n\n").alias("text")
    whole = source.mapInArrow(lambda batches: _texts(batches, table.value, False), schema).select("page_id", "url", text)
    if not deleted.isEmpty():
        losing = source.mapInArrow(lambda batches: _texts(batches, table.value, True), schema)
        less = losing.join(deleted, ["host", "k1", "k2"], "left").select("page_id", "url", "lines", "gone")
        less = less.mapInArrow(_without_shared, f"page_id {kind}, url string, lines array<string>")
        whole = whole.unionByName(less.select("page_id", "url", text))
    return whole.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_extract_text(spark, sf_dir) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
