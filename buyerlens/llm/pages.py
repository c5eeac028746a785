"""Main text of web pages: markup first, then a host's repeated runs of words.

Markup rules out menus, page headers, footers, sidebars, notices, adverts,
forms, scripts and reader comments, and where a page has an article (or main
part) all outside it. The words of the blocks that are left are concatenated
for a host's pages, shard by shard, and their suffixes sorted to a fixed depth:
suffixes that agree to it begin the same long run of words. A run may go over
the borders of blocks that it covers whole, and a shorter block is a run by
itself. Copies are told from boilerplate by their pages: a run counts on pages
that have a passage of their own, and an article only if enough of it is. Runs
on enough such pages of the host, whichever shards hold them, are boilerplate;
what they do not cover is the text. An article loses whole blocks of a run's
length at its beginning and end alone: its headings, short lines, list items
and what it quotes between passages of its own stay, however many pages repeat
them. Runs meet across shards by 64 bits of hash, of which the first ones go
around for all runs and the others for those that may be repeated.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare


@dataclass(frozen=True)
class PageParams:
    depth: int = 8  # words of a run, a power of two
    min_pages: int = 2  # distinct pages that hold a boilerplate run
    own_share: float = 0.2  # of an article's words that no other page repeats, where it is no copy
    shard_pages: int = 256  # pages of a host whose words are sorted together


_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[a-z]+")
RAW = frozenset("script style noscript template iframe textarea title svg math object xmp".split())
DROPPED = frozenset("nav footer aside form button select dialog menu figure-ad head".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
                  " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TRACKED = (BLOCK | {"span", "button", "select"}) - {"html", "body", "hr"}
# What a part of a class, id or role says about an element.
SIGNS = frozenset("ad ads aside side disclaimer notification notifications feedback discussion advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb"
                  " breadcrumbs sidebar widget widgets footer topbar masthead cookie cookies consent gdpr notice notices alert popup modal overlay"
                  " newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments"
                  " commentlist respond disqus reply replies copyright pagination pager contentinfo complementary search dialog".split())


# Names of lists that can hold articles of others.
OTHERS = frozenset("comment comments commentlist respond disqus reply replies discussion feedback related recommended recommendations widget widgets".split())
OTHER, OUT = 1 << 10, 1 << 20  # signs: more than other names, and than all names, can add up to
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TITLED = HEADINGS | {"section"}  # whose ids, in an article, name its parts
# What says that it holds the main part, on pages without such an element.
CONTENT = frozenset("article story entry post".split())


def _names(attrs: str, which: tuple[str, ...]) -> set[str]:
    """The words of an element's class, id, role or the like."""
    out: set[str] = set()
    for name, a, b, c in _ATTR.findall(attrs):
        if name.lower() in which:
            out |= set(_NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()))
    return out


def _main(tag: str, attrs: str) -> bool:
    if tag == "main" or not attrs:
        return tag == "main"
    names = _names(attrs, ("class", "id", "role", "itemprop"))
    return tag in ("div", "section") and bool(names & CONTENT or {"main", "content"} <= names) or _names(attrs, ("role",)) == {"main"}


def _sign(tag: str, attrs: str, in_article: bool) -> int:
    """Whether an element is no part of a main text: OUT with all inside it, OTHER or 1 by its names alone, which a
    main part inside it can outweigh, or 0."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return OUT
    if not attrs or tag in ("body", "html", "main"):
        return 0
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none", attrs):
        return OUT
    named = ("class", "role") if in_article and tag in TITLED else ("class", "id", "role")
    parts = _names(attrs, named)
    if tag == "article" and parts & CONTENT:
        return 0
    return OTHER if parts & OTHERS else int(bool(parts & SIGNS or ("header" in parts and not in_article)))


def blocks(page: str) -> tuple[list[str], bool, list[bool]]:
    """The page's blocks that markup does not rule out, whether they are an article's (or main part's), and which are headings.

    Articles or main parts stay with as few names against them as the page has; beside one with some, blocks outside
    it that nothing speaks against stay too.
    """
    found: list[tuple[str, int, bool, bool, bool]] = []  # text, signs against it, in an article, in a main part, a heading
    stack: list[tuple[str, int, bool, bool]] = []  # tag, signs, article, main
    parts: list[str] = []
    state = (0, False, False)

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and state[0] < OUT:
                found.append((text, *state, any(e[0] in HEADINGS for e in stack)))
            parts.clear()

    def now() -> tuple[int, bool, bool]:
        return stack[-1][1:] if stack else (0, False, False)

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag in RAW and not m["end"]:
            if not m["attrs"].endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            close()
        if tag not in TRACKED or tag in VOID:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag not in BLOCK and stack[k][1]:
                        close()
                    del stack[k:]
                    break
        else:
            if tag in BLOCK and stack and stack[-1][0] == "p":
                stack.pop()
            if tag in ("li", "dd", "dt", "tr", "td", "th"):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ("ul", "ol", "dl", "table"):
                        break
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            state = now()
            attrs = m["attrs"] or ""
            sign = _sign(tag, attrs, state[1] or state[2])
            out = state[0] + sign
            article = state[1] or (tag == "article" and out < OUT)
            main = state[2] or (out < OUT and not sign and _main(tag, attrs))
            if sign and tag not in BLOCK:
                close()
            if not attrs.endswith("/"):
                stack.append((tag, out, article, main))
        state = now()
    close()
    signs = [min((b[1] for b in found if b[k]), default=OUT) for k in (2, 3)]
    k = 2 if signs[0] < OTHER or signs[0] <= signs[1] else 3
    if (least := signs[k - 2]) < OUT:
        kept = [b for b in found if (b[k] and b[1] == least) or (least and not b[1])]
    else:
        kept = [b for b in found if not b[1]]
    return [b[0] for b in kept], least < OUT, [b[4] for b in kept]


# --- suffixes --------------------------------------------------------------

def run_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """For every position the rank of its suffix, sorted to ``depth`` (a power of two) tokens: by doubling, equal
    ranks mean equal runs. Separators are negative and all different, so no run goes over one."""
    _, rank = np.unique(tokens, return_inverse=True)
    size = 1
    while size < depth:
        nxt = np.zeros(len(rank), np.int64)
        nxt[:-size] = rank[size:] + 1 if size < len(rank) else nxt[:-size]
        _, rank = np.unique(rank * (len(rank) + 1) + nxt, return_inverse=True)
        size *= 2
    return rank


_TABLE = np.random.default_rng(0x70616765).integers(0, 1 << 64, 64 << 8, np.uint64)  # by a byte's place in its word (to 64) and the byte
_MIX, _MIX_ALONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SHORT = 28  # bits of a run's hash that shards show one another first


def _word_hashes(data: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of hash for each of the words ``data[first:end]``, each of which one byte follows."""
    place = np.arange(len(data)) - np.repeat(first, ends - first + 1)
    each = _TABLE[((place & 63) << 8) + data]
    if len(data) and place.max() > 64:
        each *= (place >> 6).astype(np.uint64) * _MIX_ALONE | np.uint64(1)
    each[ends] = 0
    return np.add.reduceat(each, first) if len(first) else np.zeros(0, np.uint64)


def _among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which values are among the chosen ones."""
    if not len(chosen):
        return np.zeros(len(values), bool)
    chosen = np.sort(chosen)
    return chosen[np.minimum(np.searchsorted(chosen, values), len(chosen) - 1)] == values


class Shard:
    """The words of some pages of a host in one stream, and the runs in it: ``(start, length, page, hash)``, and
    whether a run stays inside a block. ``texts``: the pages' blocks in UTF-8, one a line; ``marks``: see :func:`_parsed`."""

    def __init__(self, texts: list[bytes], marks: list[bytes], depth: int):
        self.depth, self.n_pages = depth, len(texts)
        # An empty word stands behind each page, in a block of its own.
        self.data = np.frombuffer(b"".join(t + b"\n\n" if t else b"\n" for t in texts), np.uint8)
        self.ends = np.flatnonzero((self.data == 0x20) | (self.data == 0x0A))
        self.first = np.r_[0, self.ends + 1][:-1]
        self.real = self.ends > self.first
        line = self.data[self.ends] == 0x0A
        self.block, self.page = np.cumsum(line) - line, np.cumsum(~self.real) - ~self.real
        self.heading = np.frombuffer(b"".join(m[1:] + b"\0" for m in marks), bool)
        self.article = np.array([m[0] for m in marks], bool)
        self.word = _word_hashes(self.data, self.first, self.ends)
        n = len(self.word)
        starts = np.arange(max(0, n - depth + 1))
        gaps = np.cumsum(~self.real)
        starts = starts[self.real[starts] & (gaps[starts + depth - 1] == gaps[starts])] if n >= depth else starts[:0]
        run = np.zeros(len(starts), np.uint64)
        for j in range(depth):
            run = run * _MIX + self.word[starts + j]
        sizes = np.bincount(self.block, self.real, minlength=len(self.heading)).astype(np.int64)
        first = np.flatnonzero(np.diff(self.block, prepend=-1))
        short = np.flatnonzero((sizes > 0) & (sizes < depth))
        alone = sizes[short].astype(np.uint64)
        for j in range(depth - 1):
            more = j < sizes[short]
            alone[more] = alone[more] * _MIX_ALONE + self.word[first[short[more]] + j]
        self.start = np.r_[starts, first[short]]
        self.length = np.r_[np.full(len(starts), depth), sizes[short]]
        self.hash = np.r_[run, alone].view(np.int64)
        self.inside = self.block[self.start] == self.block[self.start + self.length - 1]
        self.run_page = self.page[self.start]

    def all_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all runs, from the sorted suffixes, and the number of distinct pages that hold each."""
        _, tokens = np.unique(self.word, return_inverse=True)
        tokens[~self.real] = -1 - self.page[~self.real]
        full = self.length == self.depth
        _, alone = np.unique(self.hash[~full], return_inverse=True)
        at = np.r_[run_ranks(tokens, self.depth)[self.start[full]], len(tokens) + alone].astype(np.int64)
        size = len(tokens) + len(alone)
        hashes = np.zeros(size, np.int64)
        hashes[at] = self.hash
        counts = self._pages(at, self.run_page, size)
        return hashes[counts > 0], counts[counts > 0]

    def counts(self, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of some of the runs and the number of distinct pages that hold each of these."""
        hashes, at = np.unique(self.hash[take], return_inverse=True)
        return hashes, self._pages(at, self.run_page[take], len(hashes))

    def _pages(self, runs: np.ndarray, pages: np.ndarray, size: int) -> np.ndarray:
        pairs = np.unique(runs * max(1, self.n_pages) + pages)
        return np.bincount(pairs // max(1, self.n_pages), minlength=size)

    def covered(self, runs: np.ndarray) -> np.ndarray:
        """Which words the chosen runs cover: within a block, or with all of the block."""
        def cover(which: np.ndarray) -> np.ndarray:
            n = len(self.word) + 1
            edge = np.bincount(self.start[which], minlength=n) - np.bincount(self.start[which] + self.length[which], minlength=n)
            return np.cumsum(edge)[:-1] > 0

        bare = np.bincount(self.block, ~cover(runs) & self.real, minlength=len(self.heading))
        return (cover(runs & self.inside) | (bare == 0)[self.block]) & self.real

    def own(self, repeated: np.ndarray, share: float) -> np.ndarray:
        """The pages with a passage (a block, or a run's length of words) that no repeated run touches, and of an
        article's words at least ``share``."""
        free = self.real & ~self.covered(_among(self.hash, repeated))
        words = np.bincount(self.page, self.real, minlength=self.n_pages)
        bare = np.bincount(self.page, free, minlength=self.n_pages)
        size = np.bincount(self.block, self.real, minlength=len(self.heading))
        whole = (np.bincount(self.block, free, minlength=len(self.heading)) == size)[self.block] & self.real
        sums = np.r_[0, np.cumsum(free)]
        long = np.flatnonzero(sums[self.depth:] - sums[:-self.depth] == self.depth) if len(free) >= self.depth else np.zeros(0, np.int64)
        has = np.bincount(self.page[whole], minlength=self.n_pages) > 0
        has[self.page[long]] = True
        return has & (~self.article | (bare >= share * words))

    def edges(self, runs: np.ndarray) -> np.ndarray:
        """Which blocks of articles are boilerplate by the host's ``runs`` of full length: those they cover whole at
        an article's beginning (its headings aside) or end. Shorter blocks, and what stands between passages of the
        article's own, stay."""
        size = np.bincount(self.block, self.real, minlength=len(self.heading))
        long = _among(self.hash, runs) & (self.length == self.depth)
        gone = (np.bincount(self.block, self.covered(long) & self.real, minlength=len(size)) == size) & (size >= self.depth)
        out = np.zeros(len(size), bool)
        of = np.zeros(len(size), np.int64)
        of[self.block] = self.page
        body = np.flatnonzero((size > 0) & ~self.heading & self.article[of])
        for mine in np.split(body, np.flatnonzero(np.diff(of[body])) + 1):
            for order in (mine, mine[::-1]):
                stop = np.flatnonzero(~gone[order])
                out[order[:stop[0] if len(stop) else len(order)]] = True
        return out

    def texts(self, runs: np.ndarray) -> list[str]:
        """Per page, the blocks without the words that boilerplate covers."""
        gone = np.where(self.article[self.page], self.edges(runs)[self.block], self.covered(_among(self.hash, runs)))
        keep = np.flatnonzero(self.real & ~gone)
        data = self.data.copy()
        data[self.ends[keep]] = np.where(np.diff(self.block[keep], append=-1) != 0, 0x0A, 0x20)
        bytes_ = self.ends - self.first + 1
        kept = np.zeros(len(bytes_), bool)
        kept[keep] = True
        out = data[np.repeat(kept, bytes_)].tobytes()
        stops = np.cumsum(np.bincount(self.page[keep], bytes_[keep], minlength=self.n_pages).astype(np.int64)).tolist()
        return [out[a:max(a, b - 1)].decode("utf-8", "surrogatepass") for a, b in zip([0, *stops], stops)]


# --- Spark -----------------------------------------------------------------

def _objects(values) -> pd.Series:
    """Texts as plain objects, whatever string type the pandas version prefers."""
    return pd.Series([v if isinstance(v, str) else None for v in values], dtype=object)


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """The pages and what :func:`blocks` finds in them: the blocks, one a line, packed; and in a byte each whether
    they are an article's, and which are headings."""
    def pack(page: str) -> tuple[bytes, bytes]:
        texts, known, heads = blocks(page)
        return zlib.compress("\n".join(texts).encode("utf-8", "surrogatepass"), PACK), bytes([known, *heads])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, u, *pack(h or "")) for i, u, h in zip(*(b.column(k).to_pylist() for k in range(3)))]
            cols = list(zip(*rows)) if rows else [()] * 4
            types = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], ["page_id", "url", "blocks", "marks"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return src.mapInArrow(run, "page_id long, url string, blocks binary, marks binary")


def main_text(pages: DataFrame, p: PageParams = PageParams(), id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """One row per page: ``(page_id, url, text, n_chars)``.

    A null or empty page has an empty text; a null url is a host of its own;
    null ids and repeated rows each come out (repeated rows count as distinct
    pages of their host). Other columns are not read.
    """
    prepare(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    hosts = pages.select(F.col(url_col).alias("url")).groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"))
    sized = hosts.where(F.col("n") > p.shard_pages).select(F.col("host").alias("s_host"), F.ceil(F.col("n") / p.shard_pages).cast("int").alias("n_shards"))
    parsed = _parsed(pages, id_col, url_col, html_col).withColumn("host", host)
    # The broadcast, of hosts of several shards alone, leaves a host's rows to be dealt by shard.
    of = parsed.join(F.broadcast(sized), F.col("host") == F.col("s_host"), "left").withColumn("shards", F.coalesce("n_shards", F.lit(1)))
    texts = _unique_runs(of.withColumn("shard", F.pmod(F.xxhash64("page_id", "url", "blocks"), F.col("shards")).cast("int")), p)
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


PACK = 6  # zlib's level for what goes through the shuffle
PARTS = "host string, part int, shard int, runs binary, pages binary, asks binary"
NONE = pd.DataFrame({"host": _objects([]), "part": [], "shard": [], "runs": [], "pages": [], "asks": []})


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers by planes of bytes, of which those that are the same throughout nearly vanish."""
    z = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return z.compress(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()) + z.flush()


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _packed_runs(runs: np.ndarray) -> bytes:
    """Sorted numbers by their differences, which wrap around."""
    return _packed(np.diff(runs, prepend=0))


def _unpacked_runs(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(packed))


def _unique_runs(dealt: DataFrame, p: PageParams) -> DataFrame:
    """The texts. Each step reads the same shuffle of ``dealt``; only hosts of several shards exchange runs.

    Shards first show one another some bits of all their runs' hashes, sorted and as differences, and then the whole
    hashes of those runs alone whose bits stand on enough pages of the host. For runs that are on none of its pages
    with passages of their own, a shard asks by these bits, too.
    """
    dealt = dealt.select(F.col("page_id").cast("string").alias("page_id"), "url", "blocks", "marks", "host", "shard", "shards")
    by_shard = lambda: dealt.groupBy("host", "shard")

    def read(rows: pd.DataFrame) -> Shard:
        return Shard([zlib.decompress(b) for b in rows["blocks"]], rows["marks"].tolist(), p.depth)

    def several(rows: pd.DataFrame) -> bool:
        return bool(len(rows)) and rows["shards"].iloc[0] > 1

    def n_parts(rows: pd.DataFrame) -> int:
        return -(-int(rows["shards"].iloc[0]) // 16)

    def part_of(hashes: np.ndarray, n: int) -> np.ndarray:
        return (hashes.view(np.uint64) % np.uint64(n)).astype(np.int64)

    def bits(hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(64 - SHORT)).astype(np.int64)

    def short(hashes: np.ndarray, n: int) -> np.ndarray:
        """The part of a hash, and its first bits."""
        return part_of(hashes, n) << SHORT | bits(hashes)

    def parts(key: tuple, n: int, part: np.ndarray, runs: np.ndarray, counts: np.ndarray,
              asks: np.ndarray = np.zeros(0, np.int64)) -> pd.DataFrame:
        """The counts of a shard's sorted runs, and the bits of runs it asks for, dealt to the parts of its host."""
        counts, of = np.minimum(counts, p.min_pages), part_of(asks, n)
        cols = list(zip(*((key[0], i, key[1], _packed_runs(runs[part == i]), _packed(counts[part == i]),
                           _packed_runs(np.unique(bits(asks[of == i])))) for i in range(n))))
        return pd.DataFrame({"host": _objects(cols[0]), "part": cols[1], "shard": cols[2], "runs": cols[3], "pages": cols[4], "asks": cols[5]})

    def exact(key: tuple, n: int, hashes: np.ndarray, counts: np.ndarray, *asks: np.ndarray) -> pd.DataFrame:
        return parts(key, n, part_of(hashes, n), hashes, counts, *asks)

    def known(got: pd.DataFrame) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *map(_unpacked_runs, got["runs"])])

    def short_runs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if not several(rows):
            return NONE
        n = n_parts(rows)
        hashes, counts = read(rows).all_counts()
        runs, at = np.unique(short(hashes, n), return_inverse=True)
        counts = np.bincount(at, counts, minlength=len(runs))
        return parts(key, n, runs >> SHORT, runs & ((1 << SHORT) - 1), counts)

    def all_runs(key: tuple, rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not several(rows):
            return NONE
        n, shard = n_parts(rows), read(rows)
        likely = np.concatenate([np.zeros(0, np.int64), *(i << SHORT | _unpacked_runs(r) for i, r in zip(got["part"].tolist(), got["runs"]))])
        return exact(key, n, *shard.counts(_among(short(shard.hash, n), likely)))

    def own_runs(key: tuple, rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not several(rows):
            return NONE
        shard, repeated = read(rows), known(got)
        on = shard.own(repeated, p.own_share)
        hashes, counts = shard.counts(on[shard.run_page] & _among(shard.hash, repeated))
        return exact(key, n_parts(rows), hashes, counts, np.setdiff1d(repeated, hashes))

    def often(counted: DataFrame) -> DataFrame:
        """For each shard those of its runs that stand on enough pages of the host, and any with the bits it asks for."""
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            own = [_unpacked_runs(r) for r in rows["runs"]]
            counts = np.concatenate([_unpacked(c) for c in rows["pages"]])
            hashes, at = np.unique(np.concatenate(own), return_inverse=True)
            enough = np.bincount(at, counts, minlength=len(hashes)) >= p.min_pages
            found, enough = hashes[enough], enough[at]
            stops = np.cumsum([len(r) for r in own]).tolist()
            asked = [found[_among(bits(found), _unpacked_runs(r))] for r in rows["asks"]]
            kept = [_packed_runs(np.union1d(r[enough[a:b]], more)) for r, more, a, b in zip(own, asked, [0, *stops], stops)]
            return pd.DataFrame({"host": _objects([key[0]] * len(rows)), "part": key[1], "shard": rows["shard"].to_numpy(), "runs": kept})

        return (counted.groupBy("host", "part").applyInPandas(run, "host string, part int, shard int, runs binary")
                .select(F.col("host").alias("r_host"), F.col("shard").alias("r_shard"), "part", "runs").groupBy("r_host", "r_shard"))

    def texts(key: tuple, rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        shard, often_ = read(rows), known(got)
        if len(rows) and not several(rows):
            hashes, counts = shard.all_counts()
            repeated = hashes[counts >= p.min_pages]
            hashes, counts = shard.counts(shard.own(repeated, p.own_share)[shard.run_page] & _among(shard.hash, repeated))
            often_ = hashes[counts >= p.min_pages]
        return pd.DataFrame({"page_id": _objects(rows["page_id"]), "url": _objects(rows["url"]), "text": _objects(shard.texts(often_))})

    likely = often(by_shard().applyInPandas(short_runs, PARTS))
    repeated = often(by_shard().cogroup(likely).applyInPandas(all_runs, PARTS))
    boiler = often(by_shard().cogroup(repeated).applyInPandas(own_runs, PARTS))
    return (by_shard().cogroup(boiler).applyInPandas(texts, "page_id string, url string, text string")
            .select(F.col("page_id").cast("long").alias("page_id"), "url", "text"))
