"""Main text of web pages: structure first, then what repeats over the pages of a host."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import BLOCK_CHARS, keep, mixed, ship, text_blocks
from arborflow.llm.neardup import word_hashes

#: Neighbours in a host's suffix array that share so many tokens belong to a repeated run.
REPEAT = 8
#: A repeated run goes where it fills a block or has so many tokens.
LONG = 16
#: Share of a host's distinct pages (two at least) that a run must stand on: blocks as a whole and runs of pages that mark their
#: content, and runs of pages that mark nothing.
BLOCK_SHARE = 0.5
RUN_SHARE = 0.25
#: Bits of the table in which the pages of a host tell their suffixes before any is stored.
TOLD = 1 << 13
# Element names of the HTML standard by their part here, and words that sites use in class, id and role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head title script style noscript template svg math iframe object canvas audio video select textarea button datalist".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
FURNITURE_WORDS = frozenset(
    "ad ads adbox adunit advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr "
    "notice notices alert sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer comment comments commentlist disqus "
    "reply replies respond share sharing social related recommended newsletter subscribe subscription popup modal overlay login signin signup "
    "register widget widgets pagination pager toolbar skip contentinfo complementary search searchbox".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Words that only say where a part stands or what holds it; with them a compound name still names furniture.
PLACES = frozenset("site page post posts blog entry main top bottom left right inner outer primary secondary area box block bar list item items wrap wrapper container section links text form".split())
ROOTS = frozenset(["article", "main"])
#: An open p ends where these start; a list item, row or term where the next one starts.
_ENDS_P = BLOCKS - {"body", "html"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}


def _named(names: set[str], words: frozenset[str]) -> bool:
    """Whether a class, id or role is one of the words, or a compound of them and words of place only."""
    for name in names:
        parts = name.replace("_", "-").split("-")
        if not words.isdisjoint(parts) and all(part in words or part in PLACES for part in parts):
            return True
    return False


class _Reader(HTMLParser):
    """Blocks of a page as (text, furniture, inside a root). Furniture is 2, or 1 where only a form or a name outside any root says so."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool]] = []  # name, furniture, skipped, root
        self.parts: list[str] = []
        self.blocks: list[tuple[str, int, bool]] = []

    def _state(self) -> tuple[int, bool, bool]:
        return self.open[-1][1:] if self.open else (0, False, False)

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            furniture, skipped, root = self._state()
            if not skipped:
                self.blocks.append((text, furniture, root))
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._flush()
            if tag in _ENDS_P:
                self._close_to("p", stop={"article", "div", "section", "td", "th", "li", "blockquote", "body", "main", "form", "nav", "footer", "aside"})
            if tag in _SIBLINGS:
                for name in _SIBLINGS[tag]:
                    self._close_to(name, stop={"ul", "ol", "dl", "table", "select", "menu"})
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        if tag in VOID:
            return
        named = dict(attrs)
        furniture, skipped, root = self._state()
        names = set(" ".join(str(named.get(k) or "") for k in ("class", "id", "role")).lower().split())
        becomes_root = tag in ROOTS or named.get("role") == "main" or named.get("itemprop") == "articleBody"
        weak = tag == "form" or tag not in ("html", "body", "main") and _named(names, FURNITURE_WORDS)
        sure = tag in FURNITURE and tag != "form"
        if not root and not becomes_root:
            sure = sure or tag == "header"
            weak = weak or tag not in ("html", "body") and _named(names, HEADER_WORDS)
        own = 2 if sure or weak and (root or becomes_root) else int(weak)
        self._enter(tag, max(furniture, own), skipped or tag in SKIPPED, root or becomes_root)

    def _enter(self, tag: str, furniture: int, skipped: bool, root: bool) -> None:
        if (furniture, skipped, root) != self._state():
            self._flush()
        self.open.append((tag, furniture, skipped, root))

    def _close_to(self, tag: str, stop: set[str]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                self._flush()
                # formatting that stays open does not reach over the end of its block
                del self.open[k:]
                return
            if name in stop:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if tag in BLOCKS or self.open[k][1:] != (self.open[k - 1][1:] if k else (0, False, False)):
                    self._flush()
                del self.open[k:]
                return
            if self.open[k][0] in BLOCKS and tag not in BLOCKS:
                return  # the end of formatting that began outside this block
        if tag == "p":
            self._flush()

    def handle_data(self, data: str) -> None:
        self.parts.append(data)

    def finish(self) -> list[tuple[str, int, bool]]:
        self.close()
        self._flush()
        return self.blocks


def read(html: str) -> list[tuple[str, int, bool]]:
    """(text, furniture, inside a root) of each block of a page."""
    reader = _Reader()
    reader.feed(html)
    return reader.finish()


def content(html: str | None) -> tuple[list[str], list[bool]]:
    """Blocks of a page that are no furniture, and which of them stand in marked content.

    Content inside a wrapper that only a name or a form makes furniture counts where the page marks no other.
    """
    blocks = read(html) if isinstance(html, str) else []
    allowed = 0 if any(root and not furniture for _, furniture, root in blocks) else 1
    own = [(text, root) for text, furniture, root in blocks if not furniture or root and furniture <= allowed]
    return [text for text, _ in own], [root for _, root in own]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in text_blocks(frames, "html"):
        read_pages = [content(html) for html in frame.html]
        main = [[t for t, r in zip(blocks, roots, strict=True) if r] or blocks for blocks, roots in read_pages]
        yield pd.DataFrame({
            "page_id": frame.page_id, "url": frame.url, "blocks": [blocks for blocks, _ in read_pages], "roots": [roots for _, roots in read_pages],
            "content": np.array([_hash("\n\n".join(blocks)) for blocks in main], np.int64),
        })


def _page_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into runs of pages with about BLOCK_CHARS characters of content."""
    for frame in frames:
        if not len(frame):
            continue
        block = (np.cumsum([sum(map(len, blocks)) for blocks in frame.blocks]) - 1).clip(0) // BLOCK_CHARS
        for rows in np.split(np.arange(len(frame)), np.flatnonzero(np.diff(block)) + 1):
            yield frame.iloc[rows]


def _starts(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, token and first REPEAT tokens (a hash) of each suffix of the pages' streams: all blocks in page order."""
    words, sizes = word_hashes([" ".join(blocks).encode("utf-8", "surrogatepass") for blocks in frame.blocks])
    row = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = max(0, len(words) - REPEAT + 1)
    value = np.zeros(n, np.uint64)
    for k in range(REPEAT):
        value = mixed(value + words[k : n + k])
    fits = row[:n] == row[REPEAT - 1 :] if n else np.zeros(0, bool)
    return row[:n][fits], nth[:n][fits], value[fits]


def _told(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each host of a task, on how many of its pages each place of a table of TOLD is hit by a suffix; places without a hit are left out."""
    held: dict[str, np.ndarray] = {}

    def flush() -> pd.DataFrame:
        places = [np.flatnonzero(x) for x in held.values()]
        hits = [x[at].astype(np.uint32).tobytes() for x, at in zip(held.values(), places, strict=True)]
        return pd.DataFrame({"host": list(held), "places": [at.astype(np.uint16).tobytes() for at in places], "hits": hits})

    for frame in _page_blocks(frames):
        row, _, value = _starts(frame)
        hit = np.unique(row * TOLD + (value % np.uint64(TOLD)).astype(np.int64))
        cuts = np.searchsorted(hit // TOLD, np.arange(len(frame) + 1))
        for host, lo, hi in zip(frame.host, cuts, cuts[1:], strict=False):
            if host not in held:
                if len(held) == 256:
                    yield flush()
                    held.clear()
                held[host] = np.zeros(TOLD, np.uint32)
            held[host][hit[lo:hi] % TOLD] += 1
    yield flush()


def _often(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Places of a host's table that enough pages hit: equal pages count each, so no suffix on a share of distinct ones is missed."""
    hits = np.zeros(TOLD, np.int64)
    for at, n in zip(frame.places, frame.hits, strict=True):
        hits[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint32)
    return pd.DataFrame({"host": [key[0]], **{
        name: [np.packbits((hits > 1) & (hits >= share * frame["size"].iat[0])).tobytes()] for name, share in (("some", RUN_SHARE), ("many", BLOCK_SHARE))}})


def _suffixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First tokens of the suffixes of each page's stream: REPEAT tokens of each suffix that its host's table does not rule out
    (place: its token), and of each suffix that starts a block the whole block (place: -1 less the block's number)."""
    for frame in _page_blocks(frames):
        row, nth, value = _starts(frame)
        # pages that mark nothing ask for less, so what they look for is counted on all pages of a host that has such pages
        tables = [many if strict else some for some, many, strict in zip(frame.some, frame.many, frame.strict, strict=True)]
        bits = np.unpackbits(np.frombuffer(b"".join(tables), np.uint8)).reshape(len(frame), TOLD)
        wanted = bits[row, (value % np.uint64(TOLD)).astype(np.int64)] > 0
        row, nth, value = row[wanted], nth[wanted], value[wanted]
        counts = [len(blocks) for blocks in frame.blocks]
        at = np.concatenate([row, np.repeat(np.arange(len(counts)), counts)])
        prefix = np.concatenate([value.view(np.int64), np.array([_hash(t) for blocks in frame.blocks for t in blocks], np.int64)])
        place = np.concatenate([nth, np.array([-1 - k for c in counts for k in range(c)], np.int64)])
        yield pd.DataFrame({
            "host": frame.host.to_numpy()[at], "prefix": prefix, "content": frame.content.to_numpy()[at], "row": frame.row.to_numpy()[at],
            "marked": frame.marked.to_numpy()[at], "place": place,
        })


def unique(blocks: list[str], roots: list[bool], places: list[int]) -> tuple[str, int]:
    """Text of a page without its repeated runs, and the tokens that went; `places` as `_suffixes` gives them."""
    tokens = [t.encode("utf-8", "surrogatepass").split() for t in blocks]
    marked = any(roots)
    whole = {-1 - p for p in places if p < 0}
    size = sum(map(len, tokens))
    covered = np.zeros(size + 2, bool)  # an uncovered token at either end
    for p in places:
        if p >= 0:
            covered[p + 1 : p + 1 + REPEAT] = True
    ends = np.flatnonzero(np.diff(covered))
    long = np.zeros(size, bool)
    for start, end in zip(ends[::2], ends[1::2], strict=True):
        long[start:end] = end - start >= LONG
    kept, own_text, at, gone, all_tokens = [], [], 0, 0, 0
    for k, (text, own, root) in enumerate(zip(blocks, tokens, roots, strict=True)):
        here, covered_here = long[at : at + len(own)], covered[at + 1 : at + 1 + len(own)]
        at += len(own)
        if marked and not root:
            continue
        own_text.append(text)
        all_tokens += len(own)
        if k in whole or covered_here.all():
            gone += len(own)
            continue
        if here.any():
            text = b" ".join(t for t, goes in zip(own, here, strict=True) if not goes).decode("utf-8", "surrogatepass")
            gone += int(here.sum())
        kept.append(text)
    if marked and 2 * gone > all_tokens:
        return "\n\n".join(own_text), 0  # what agrees for the most part is another version of the page
    return "\n\n".join(kept), gone


def _unique(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [
            unique(list(blocks), list(roots), [] if places is None else list(places))
            for blocks, roots, places in zip(frame.blocks, frame.roots, frame.places, strict=True)
        ]
        yield pd.DataFrame({"page_id": frame.page_id, "url": frame.url, "text": [t for t, _ in found], "n_repeated": np.array([n for _, n in found], np.int64)})


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars, n_repeated.

    Structure leaves out what is never text or surely furniture: scripts and styles, menus, headers, footers, asides,
    forms, and what class, id or role call adverts, notices, comments and so on (whole names, or compounds of such words
    and words of place). What is left of a host's pages forms its token streams. Suffixes of these streams that agree in
    their first tokens are neighbours in the host's suffix array; they meet by (host, first tokens) in pre-aggregated
    counts of distinct pages, so a large host is no group of its own. Pages with the same content count once.

    - A block that stands on at least BLOCK_SHARE of the host's distinct pages (and on two) goes, inside content that the
      page marks (article, main) as well as outside.
    - So do runs, chains of neighbours with REPEAT tokens in common, if they fill a block or have LONG tokens: those on
      BLOCK_SHARE of the pages, and where a page marks nothing those on RUN_SHARE of them.
    - Marked content that would lose over half of its tokens is another version of a page and stays whole.

    Most suffixes stand on one page and are not stored: pages first count, in a table a host of TOLD places by hash, how many
    of them hit each place, and only suffixes at places hit by enough pages are counted for themselves, exactly.

    n_repeated counts the tokens that went this way. Where a page marks content, the text is that, else all that is left.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by two line feeds in
    page order. A null page is empty; a null url has a host of its own, shared by all null urls. Rows that repeat and
    copies under other addresses are pages each, with the same text. An empty table gives an empty result. Other columns
    are not looked at.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    parsed = rows.mapInPandas(_parse, f"page_id {id_type}, url string, blocks array<string>, roots array<boolean>, content long")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    parsed = parsed.withColumn("host", host).withColumn("row", F.monotonically_increasing_id()).withColumn("marked", F.array_contains("roots", True))
    parsed = keep(parsed, "pages", "zstd")
    sizes = keep(parsed.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("size")), "sizes")
    told = parsed.select("host", "blocks").mapInPandas(_told, "host string, places binary, hits binary").join(sizes, "host")
    often = told.groupBy("host").applyInPandas(_often, "host string, some binary, many binary")
    strict = parsed.groupBy("host").agg(F.min(F.col("marked").cast("int")).alias("strict"))
    often = keep(often.join(strict.select("host", (F.col("strict") == 1).alias("strict")), "host"), "often")
    listed = parsed.select("host", "row", "content", "marked", "blocks").join(often, "host")
    suffixes = listed.mapInPandas(_suffixes, "host string, prefix long, content long, row long, marked boolean, place long")
    suffixes = keep(suffixes.withColumn("whole", F.col("place") < 0), "suffixes")
    key = ["host", "prefix", "whole"]
    counts = suffixes.groupBy(*key, "content").agg(F.lit(1)).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    shared = counts.join(sizes, "host").where(F.col("n") >= F.when(F.col("whole"), BLOCK_SHARE).otherwise(RUN_SHARE) * F.col("size"))
    shared = shared.select(*key, (F.col("n") >= BLOCK_SHARE * F.col("size")).alias("most"))
    found = suffixes.join(shared, key).where(F.col("most") | ~F.col("marked"))
    places = keep(found.groupBy("row").agg(F.collect_list("place").alias("places")), "places")
    out = parsed.join(places, "row", "left").select("page_id", "url", "blocks", "roots", "places").mapInPandas(
        _unique, f"page_id {id_type}, url string, text string, n_repeated long")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
