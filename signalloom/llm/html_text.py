"""Main text of web pages: markup rules, and lines shared with the page of the nearest URL."""

from __future__ import annotations

import bisect
import html
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from signalloom.llm.common import shuffle_partitions, slices, whole_text
from signalloom.operators.staging import staged

#: Elements whose text is read by no visitor, or isn't text.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "button", "object", "canvas", "audio", "video")
#: Elements that aren't part of an article.
ASIDE = ("head", "nav", "header", "footer", "aside", "form", "menu", "dialog")
MAIN = ("article", "main")
#: Words in class or id that name something other than the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice pagination "
    "popup promo promoted related replies reply search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget widgets".split()
)
#: Words that say which part or place of such an element is meant: ``comments-section``, ``footerInner``.
PART_WORDS = frozenset(
    "area bar block body bottom box btn button buttons col column container content entry first form group head inner item "
    "items last left link links list main outer page panel popup right row section site slot text thread title top unit "
    "wrap wrapper".split()
)
#: Before one of them these say that an element has something beside it, not what it is: ``has-sidebar``.
BESIDE_WORDS = frozenset("has hide no non not with without".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Headers inside an article belong to it.
IN_ARTICLE = frozenset(("header",))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul".split()
)
CELLS = frozenset(("td", "th", "br"))
#: Blocks that may hold blocks; a tag that closes one closes what is open inside.
NESTED = BLOCKS - frozenset("p h1 h2 h3 h4 h5 h6 hr li dt dd html body".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|\]\]>|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")
#: Words of a class or id, also where only a capital begins one.
NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\d_A-Z]+|\d+")
CLOSING = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}


@dataclass
class Line:
    text: str
    #: Markup says that it is no part of the article.
    aside: bool
    #: It stands in an article or main element.
    main: bool


def _is_aside(name: str, attributes: str, in_main: bool) -> bool:
    if name in ASIDE:
        return not (in_main and name in IN_ARTICLE)
    if not attributes or attributes.isspace():
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in ASIDE_ROLES or found.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", found.get("style", "")) or re.search(r"(?:^|\s)hidden(?:\s|=|$)", ATTRIBUTE.sub("", attributes)):
        return True
    words = ASIDE_WORDS - IN_ARTICLE if in_main else ASIDE_WORDS
    return any(_names_aside(x, words) for x in f"{found.get('class', '')} {found.get('id', '')}".split())


def _names_aside(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id says, as a whole, that its element is one of ``words``.

    Its last word does (``site-footer``, ``siteFooter``), or its first one, if only parts and numbers follow.
    """
    own = [w.lower() for w in NAME_WORD.findall(name)]
    if not own or BESIDE_WORDS & set(own[:-1]):
        return False
    return own[-1] in words or (own[0] in words and all(w in words or w in PART_WORDS or w.isdigit() for w in own[1:]))


def lines_of(page: str) -> list[Line]:
    """The page's blocks of text in order, character references decoded, white space inside them made one space.

    Tags that are never closed, and closing tags that close nothing, do no harm: only elements that may hold
    blocks are tracked. A script, style or the like that is never closed takes the rest of the page.
    """
    out: list[Line] = []
    parts: list[str] = []
    open_: list[tuple[str, bool, bool]] = []
    aside = main = False

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append(Line(text, aside, main))

    at, size = 0, len(page)
    while at < size:
        token = TOKEN.search(page, at)
        if token is None:
            parts.append(page[at:])
            break
        if token.start() > at:
            parts.append(page[at : token.start()])
        at = token.end()
        closing, name, attributes = token.group(1, 2, 3) if token[2] else token.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if name in CLOSING and not closing:
            if not attributes.endswith("/"):
                end = CLOSING[name].search(page, at)
                at = end.end() if end else size
            parts.append(" ")
        elif name in CELLS:
            parts.append(" ")
        elif name in BLOCKS or (not closing and attributes and _is_aside(name, attributes, main)):
            flush()
            if name not in BLOCKS:
                # An inline element that is an advert or the like: tracked as a block of its own.
                open_.append((name, aside, main))
                aside = True
            elif name not in NESTED:
                # A paragraph that is a notice: only as far as the next block goes, as paragraphs needn't be closed.
                if open_ and open_[-1][0] == "p-aside":
                    _, aside, main = open_.pop()
                if not closing and attributes and _is_aside(name, attributes, main):
                    open_.append(("p-aside", aside, main))
                    aside = True
            elif closing:
                names = [x[0] for x in open_]
                if name in names:
                    while open_:
                        was, aside, main = open_.pop()
                        if was == name:
                            break
            else:
                if open_ and open_[-1][0] == "p-aside":
                    _, aside, main = open_.pop()
                open_.append((name, aside, main))
                aside = aside or _is_aside(name, attributes, main)
                main = (main or name in MAIN) and not aside
        elif closing and open_ and open_[-1][0] == name:
            flush()
            _, aside, main = open_.pop()
    flush()
    return out


#: Equal pairs of lines per line up to which they are threaded one by one.
PAIRS_A_LINE = 64


def shared_lines(own: np.ndarray, other: np.ndarray) -> list[int]:
    """Positions in ``own`` of a longest common subsequence with ``other``.

    What both begin and end with is shared. Between, equal pairs of lines are threaded if they are few. Pages of the same
    few lines over and over have a pair for almost any two lines; there the page is halved where the lengths of the
    halves' subsequences add up to most, and these lengths come from bit vectors, 64 lines at once and more.
    """
    n = min(len(own), len(other))
    differ = np.flatnonzero(own[:n] != other[:n])
    head = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(own[len(own) - n + head :][::-1] != other[len(other) - n + head :][::-1])
    tail = int(differ[0]) if len(differ) else n - head
    middle = _between(own[head : len(own) - tail], other[head : len(other) - tail])
    return [*range(head), *(head + i for i in middle), *range(len(own) - tail, len(own))]


def _between(own: np.ndarray, other: np.ndarray) -> list[int]:
    if not len(own) or not len(other):
        return []
    values, counts = np.unique(other, return_counts=True)
    at = np.minimum(np.searchsorted(values, own), len(values) - 1)
    met = values[at] == own
    pairs = int(counts[at[met]].sum())
    if pairs <= PAIRS_A_LINE * (len(own) + len(other)):
        return _threaded(own, other)
    if len(own) == 1:
        return [0]
    half = len(own) // 2
    before, after = _lengths(own[:half], other), _lengths(own[half:][::-1], other[::-1])[::-1]
    cut = int(np.argmax(before + after))
    return _between(own[:half], other[:cut]) + [half + i for i in _between(own[half:], other[cut:])]


def _lengths(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``own`` and each beginning of ``other``, the empty one first."""
    masks = {}
    for h in np.unique(other).tolist():
        masks[h] = int.from_bytes(np.packbits(other == h, bitorder="little").tobytes(), "little")
    full = (1 << len(other)) - 1
    v = full
    for h in own.tolist():
        same = v & masks.get(h, 0)
        v = ((v + same) | (v - same)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(other) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[: len(other)].astype(np.int64))])


def _threaded(own: np.ndarray, other: np.ndarray) -> list[int]:
    """Matching pairs in the order of ``own``, and downwards in ``other``, threaded through the smallest ends of common
    subsequences of each length, so the work follows the number of equal pairs of lines."""
    places: dict[int, list[int]] = {}
    for j in range(len(other) - 1, -1, -1):
        places.setdefault(int(other[j]), []).append(j)
    ends: list[int] = []
    links: list[tuple[int, tuple | None]] = []
    for i, h in enumerate(own.tolist()):
        for j in places.get(h, ()):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[k]:
                ends[k], links[k] = j, link
    out, link = [], links[-1] if links else None
    while link is not None:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def closeness(a: str, b: str) -> int:
    """Code points that two paths start with in common."""
    return sum(1 for _ in itertools.takewhile(lambda x: x[0] == x[1], zip(a, b)))


#: What markup says of a line, one byte each.
ASIDE_LINE, MAIN_LINE = 1, 2


def said_of(lines: list[Line]) -> bytes:
    return bytes(ASIDE_LINE if x.aside else MAIN_LINE * x.main for x in lines)


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, lines, said, hashes, digest): every page's lines, what markup says of each, and its hash.

    Pages of one digest have the same lines, of which markup says the same. Each page is read here and nowhere else.
    ``lines`` are packed, those put aside by markup as empty ones.
    """
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1), F.lit("")).alias("path"),
        whole_text("html").alias("html"),
    )

    def run(batches):
        pack = zstandard.ZstdCompressor().compress
        for batch in slices(batches, "html"):
            found = [lines_of(x) for x in batch.column("html").to_pylist()]
            said = [said_of(page) for page in found]
            hashes = [b"".join(xxhash.xxh64_digest(x.text.encode("utf-8", "surrogatepass")) for x in page) for page in found]
            yield pa.record_batch(
                {
                    **{c: batch.column(c) for c in ("page_id", "url", "host", "path")},
                    "lines": pa.array([pack("\n".join("" if x.aside else x.text for x in page).encode()) for page in found], pa.binary()),
                    "said": pa.array(said, pa.binary()),
                    "hashes": pa.array(hashes, pa.binary()),
                    "digest": pa.array([xxhash.xxh3_128_digest(h + b) for h, b in zip(hashes, said)], pa.binary()),
                }
            )

    kinds = "page_id long, url string, host string, path string, lines binary, said binary, hashes binary, digest binary"
    return rows.mapInArrow(run, kinds)


def learned_from_neighbours(rows: DataFrame) -> DataFrame:
    """(host, digest, shared): positions of the lines that each page of ``parsed`` shares with the page of the nearest URL.

    Pages of the same lines are one, under their first path. Only hashes of lines travel. They are sorted by host and
    path into ranges, which cuts a hot host into as many as it needs; the first and last page of each range are copied to
    the range beside it, so that every page stands next to its neighbours. The nearer by path of the two is compared, and
    the other one where nothing of the page would be left. A page without a host has no neighbour, and neither has a
    page alone on its host.
    """
    parts = shuffle_partitions(rows.sparkSession)
    light = rows.where("host <> ''").groupBy("host", "digest").agg(
        F.min("path").alias("path"), F.first("hashes").alias("hashes"), F.first("said").alias("said")
    )
    order = ["host", "path", "digest"]
    sorted_ = staged(
        light.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumns({"range": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}),
        "lines",
    )
    ends = sorted_.groupBy("range").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    # One row per range.
    beside = W.orderBy("range")
    ends = ends.withColumns({"before": F.lag("range").over(beside), "after": F.lead("range").over(beside)})
    copies = ends.select(F.col("first").alias("seq"), F.col("before").alias("to")).union(ends.select("last", "after")).where("to is not null")
    every = (
        sorted_.withColumn("ghost", F.lit(False))
        .unionByName(sorted_.join(F.broadcast(copies), "seq").withColumn("range", F.col("to")).withColumn("ghost", F.lit(True)).drop("to"))
    )
    columns = ("range", "ghost", "host", "path", "digest", "hashes", "said")

    def batch_of(out):
        shapes = (pa.string(), pa.binary(), pa.list_(pa.int32()))
        return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(("host", "digest", "shared"), zip(*out), shapes)})

    def compare(batches):
        def rows():
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    yield from zip(*[part.column(c).to_pylist() for c in columns])

        out = []
        triple = [None, None, None]
        for row in itertools.chain(rows(), [None]):
            triple = [triple[1], triple[2], row]
            own = triple[1]
            if own is None or own[1]:
                continue
            near = [x for x in (triple[0], triple[2]) if x is not None and x[0] == own[0] and x[2] == own[2]]
            near.sort(key=lambda x: -closeness(x[3], own[3]))
            lines = np.frombuffer(own[5], np.int64)
            for x in near:
                shared = shared_lines(lines, np.frombuffer(x[5], np.int64))
                if kept(own[6], shared):
                    out.append((own[2], own[4], shared))
                    break
            if len(out) >= 1024:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    placed = every.repartitionById(parts, F.col("range")).sortWithinPartitions("range", "seq")
    return placed.mapInArrow(compare, "host string, digest binary, shared array<int>")


def kept(said: bytes, shared=()) -> list[int]:
    """Positions of the lines that are the article's, from what markup says of each line and which ones a neighbour has.

    A line that markup puts aside is none, and neither is a shared one, unless it stands in an article or main element:
    articles quote each other, and copies of one under two URLs would else delete each other.
    """
    dropped = set(shared)
    return [i for i, x in enumerate(said) if x == MAIN_LINE or (not x and i not in dropped)]


def main_lines(lines: list[Line], shared=()) -> list[str]:
    return [lines[i].text for i in kept(said_of(lines), shared)]


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``: the article's blocks, one to a line.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments go by their markup. Every page
    is aligned with the page of the nearest URL on its host, and lines that both have go too, repeated ones included, but for
    those in an article or main element. Where both neighbours have all that is left of a page, it is a copy and stays as it
    is; so does a page without a host. Null or empty html gives an empty text. Repeated rows are extracted alike.
    """
    rows = staged(parsed(pages), "parsed")
    shared = staged(learned_from_neighbours(rows), "shared")
    own = rows.select("page_id", "url", "host", "digest", "lines", "said")
    # Of pages that markup alone decides, the text isn't moved.
    open_ = (F.col("host") != "") & (F.locate("\0", F.col("said").cast("string")) > 0)
    joined = own.where(open_).join(shared, ["host", "digest"], "left")
    joined = joined.unionByName(own.where(~open_), allowMissingColumns=True)

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            # A few pages at a time: their lines become Python strings.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                columns = zip(*[part.column(c).to_pylist() for c in ("lines", "said", "shared")])
                texts = []
                for packed, said, drop in columns:
                    lines = unpack(packed).decode().split("\n")
                    texts.append("\n".join(lines[i] for i in kept(said, drop or ())))
                yield pa.record_batch(
                    {
                        "page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    wanted = joined.select("page_id", "url", "lines", "said", "shared")
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_chars long")
