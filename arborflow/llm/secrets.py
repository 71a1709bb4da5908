"""Secrets in texts and in what texts carry encoded: a worklist of decoded layers, rescanned and mapped back to the text."""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import ship, text_blocks

#: Kinds in the order that breaks ties of their spans.
KINDS = ("assign", "access", "hex")
#: The three patterns, and the least length of group 2 or of the match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Base64 runs shorter than this are left alone: what they hold cannot be a secret.
RUN_LEAST = 16
#: Guard against decompression bombs: a layer ends after so many bytes, and the row says so in `cut_layers`.
LAYER_BYTES = 64 << 20
#: Compressed bytes given to an engine at once: what is read before a fault is kept in such steps.
FEED_BYTES = 256
REPLACEMENT = "[secret]"
SPANS = "array<struct<kind:string,start:bigint,end:bigint,depth:int>>"

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
# runs go on over single line breaks, with what indents the next line
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++|(?<=[A-Za-z0-9+/_-]{16}))")
_PART = re.compile(r"[A-Za-z0-9]{16,}")
#: Base64 of the first bytes of compressed data, the bytes themselves, and what hints at them in escaped bytes.
_PACKED_RUN = re.compile(r"H4sI|e[AFJN]|Qlpo|/Td6WFo|_Td6WFo|KLUv")
_PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9](?=1AY&SY)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_URL_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|([\x00-\xff])")
_ESCAPED_BYTE = re.compile(r"\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\([abfnrtv0\\'\"])|([\x00-\xff])")
_SHORT = dict(zip("abfnrtv0\\'\"", b"\a\b\f\n\r\t\v\0\\'\"", strict=True))
# compressed data has bytes from 128 on, which are escaped
_URL_HINT = re.compile(r"%[89A-Fa-f][0-9A-Fa-f]|BZh")
_ESCAPED_HINT = re.compile(r"\\(?:x|u00)[0-9A-Fa-f]{2}")
_NO_BYTE = re.compile(r"[\r\nĀ-\U0010ffff]")
# two-byte characters, low or high byte first
_WIDE = re.compile(r"(?<!\x00)(?:[\x01-\xff]\x00){4,}|(?<![\x01-\xff])(?:\x00[\x01-\xff]){4,}")
# bytes that are no clean text are looked at if they hold the beginning of a pattern or of another layer
_WORTH = re.compile(rb"(?i)akia|passw|secret|token|api_?key|[a-z0-9+/_-]{16}|[a-z0-9+/_-]{4}[ \t]*\r?\n[ \t]*[a-z0-9+/_-]{4}|%[0-9a-f]{2}|\\[ux]|(?:[^\x00]\x00){4}|(?:\x00[^\x00]){4}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain patterns: leftmost, non-overlapping per kind, short matches dropped."""
    found = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append((m.start(), m.end(), "access"))
    found.extend((m.start(), m.end(), "hex") for m in HEX.finditer(text))
    return found


def _engine(data: bytes):
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=256 << 20)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=128 << 20).decompressobj()
    return None


def _unpacked(data: bytes) -> tuple[bytes | None, bool, bytes]:
    """What compressed bytes hold (None if they are not), whether the guard ended it, and the bytes after it.

    Members that follow each other are one text. Of broken data, what could be read up to the fault counts.
    """
    out, size, some = [], 0, False
    while (engine := _engine(data)) is not None:
        at, before, zstd = 0, size, data[:4] == b"\x28\xb5\x2f\xfd"
        try:
            while at < len(data) and not engine.eof:
                piece = data[at : at + FEED_BYTES]
                at += len(piece)
                while True:
                    new = engine.decompress(piece) if zstd else engine.decompress(piece, LAYER_BYTES - size + 1)
                    out.append(new)
                    size += len(new)
                    if size > LAYER_BYTES:
                        return b"".join(out)[:LAYER_BYTES], True, b""
                    piece = getattr(engine, "unconsumed_tail", b"")
                    if not piece and (engine.eof or getattr(engine, "needs_input", True)):
                        break
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError, zstandard.ZstdError):
            if size > before:
                some = True
            break
        if not engine.eof:  # cut off
            some = some or size > before
            data = b""
            break
        some = True
        data = engine.unused_data + data[at:]
        if _engine(data.lstrip(b"\0")) is not None:
            data = data.lstrip(b"\0")
    return (b"".join(out), False, data) if some else (None, False, data)


def _inner(data: bytes) -> tuple[bytes | None, bool]:
    """What bytes hold that are compressed once or more (None if they are not), with what follows them."""
    inner, over, rest = _unpacked(data)
    if inner is None:
        return None, False
    while (again := _unpacked(inner))[0] is not None:
        inner, over = again[0] + again[2], over or again[1]
    return inner + (b"\n" + rest if rest else b""), over


def _bytes_of(run: str) -> bytes:
    """What a run holds; a last character that belongs to no byte is left out."""
    body = run.replace("-", "+").replace("_", "/")
    body = body[:-1] if len(body) % 4 == 1 else body
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _readable(data: bytes) -> str | None:
    """The text that bytes hold, if they are UTF-8 without control characters."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if any(c < 32 and c not in (9, 10, 13) for c in data):
        return None
    return text


class _Layer:
    """A decoded text; start[i] and end[i] are the places in the document that character i came from (None: the same)."""

    __slots__ = ("depth", "end", "start", "text")

    def __init__(self, text: str, start: np.ndarray | None, end: np.ndarray | None, depth: int) -> None:
        self.text, self.start, self.end, self.depth = text, start, end, depth

    def place(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.start is None else (int(self.start[start]), int(self.end[end - 1]))

    def maps(self) -> tuple[np.ndarray, np.ndarray]:
        if self.start is None:
            return np.arange(len(self.text)), np.arange(1, len(self.text) + 1)
        return self.start, self.end


def _rewritten(layer: _Layer, pieces: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> _Layer:
    """The layer with pieces (start, end, text, first and last source character of each new one) in place of its own."""
    start, end = layer.maps()
    text, starts, ends, at = [], [], [], 0
    for a, b, new, first, last in pieces:
        text += [layer.text[at:a], new]
        starts += [start[at:a], start[first]]
        ends += [end[at:a], end[last]]
        at = b
    text.append(layer.text[at:])
    starts.append(start[at:])
    ends.append(end[at:])
    return _Layer("".join(text), np.concatenate(starts), np.concatenate(ends), layer.depth + 1)


def _from_url(layer: _Layer) -> _Layer | None:
    pieces = []
    for m in _URL.finditer(layer.text):
        data = bytes.fromhex(m.group().replace("%", ""))
        new = data.decode("utf-8", "replace") if _is_utf8(data) else data.decode("latin-1")
        width = np.array([len(c.encode("utf-8")) for c in new]) if _is_utf8(data) else np.ones(len(data), np.int64)
        first = m.start() + 3 * (np.cumsum(width) - width)
        pieces.append((m.start(), m.end(), new, first, first + 3 * width - 1))
    return _rewritten(layer, pieces) if pieces else None


def _is_utf8(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _from_escapes(layer: _Layer) -> _Layer | None:
    pieces = []
    for m in _ESCAPE.finditer(layer.text):
        point = int(next(g for g in m.groups() if g), 16)
        if point <= 0x10FFFF and not 0xD800 <= point < 0xE000:
            pieces.append((m.start(), m.end(), chr(point), np.array([m.start()]), np.array([m.end() - 1])))
    return _rewritten(layer, pieces) if pieces else None


def _from_wide(layer: _Layer) -> _Layer | None:
    """Two-byte characters (UTF-16) whose other bytes are zero, as characters."""
    pieces = []
    for m in _WIDE.finditer(layer.text):
        first = np.arange(m.start(), m.end(), 2)
        pieces.append((m.start(), m.end(), m.group().replace("\0", ""), first, first + 1))
    return _rewritten(layer, pieces) if pieces else None


def _from_bytes(layer: _Layer, byte: re.Pattern) -> tuple[list[_Layer], int]:
    """A layer for each piece of compressed data that is written as escaped bytes; and how many the guard ended."""
    found, cut, text = [], 0, layer.text
    ends = [m.start() for m in _NO_BYTE.finditer(text)] + [len(text)]
    at = 0
    for end in ends:
        if end - at > 8 and ("%" in text[at:end] or "\\" in text[at:end]):
            data, place = bytearray(), []
            for m in byte.finditer(text, at, end):
                *codes, plain = m.groups()
                code = next((g for g in codes if g), None)
                data.append(ord(plain) if plain else _SHORT[code] if len(code) == 1 else int(code, 16))
                place.append((m.start(), m.end()))
            data, done = bytes(data), 0
            for m in _PACKED.finditer(data):
                if m.start() < done:
                    continue
                inner, over, rest = _unpacked(data[m.start() :])
                if not inner:
                    continue
                done = max(m.end(), len(data) - len(rest))
                while (again := _unpacked(inner))[0] is not None:
                    inner, over = again[0] + again[2], over or again[1]
                new, (a, b) = inner.decode("utf-8", "replace"), (place[m.start()][0], place[done - 1][1])
                start, last = layer.maps()
                cut += over
                found.append(_Layer(new, np.full(len(new), start[a]), np.full(len(new), last[b - 1]), layer.depth + 1))
        at = end + 1
    return found, cut


def _from_run(layer: _Layer, lines: list[tuple[int, str]], clean: bool) -> tuple[_Layer | None, bool, bool]:
    """The layer that lines (place, characters) of one run hold, whether it is compressed or clean text, and whether the guard ended it.

    With `clean`, nothing else is taken; else bytes that are no clean text are read as UTF-8 or, byte by byte, as Latin-1.
    """
    run = "".join(t for _, t in lines)
    data = _bytes_of(run) if len(run) >= RUN_LEAST else b""
    if not data:
        return None, False, False
    inner, over = _inner(data)
    text = _readable(data) if inner is None else inner.decode("utf-8", "replace")
    good = bool(text)
    if not good and not clean and _WORTH.search(data):
        text = data.decode("utf-8" if _is_utf8(data) else "latin-1")
    if not text:
        return None, False, False
    start, end = layer.maps()
    place = np.concatenate([np.arange(at, at + len(t)) for at, t in lines])
    if inner is not None:
        return _Layer(text, np.full(len(text), start[place[0]]), np.full(len(text), end[place[-1]]), layer.depth + 1), True, over
    if len(text) == len(data):
        width = np.ones(len(text), np.int64)
    else:
        width = np.array([len(c.encode("utf-8")) for c in text])
    byte = np.cumsum(width) - width
    first = start[place[byte * 4 // 3]]
    last = end[place[np.minimum(((byte + width) * 8 + 5) // 6 - 1, len(place) - 1)]]
    return _Layer(text, first, last, layer.depth + 1), good, over


def _from_base64(layer: _Layer) -> tuple[list[_Layer], int]:
    """Layers of the runs, those over several lines as wholes and by line; and how many the guard ended."""
    found, cut = [], 0

    def took(lines: list[tuple[int, str]], clean: bool = False) -> bool:
        nonlocal cut
        new, good, over = _from_run(layer, lines, clean)
        cut += over
        if new is not None:
            found.append(new)
        return good

    for m in _RUN.finditer(layer.text):
        lines = [(x.start(), x.group()) for x in _LINE.finditer(layer.text, m.start(), m.end())]
        left = set(range(len(lines)))
        k = 0
        while k < len(lines) - 1:  # lines of one length and a shorter last one
            n, last = len(lines[k][1]), k
            while last + 1 < len(lines) and len(lines[last + 1][1]) == n:
                last += 1
            stop = last + 1 < len(lines) and len(lines[last + 1][1]) < n
            for to in [last + 1, last] if stop else [last]:
                if to > k and took(lines[k : to + 1], clean=True):
                    left -= set(range(k, to + 1))
                    last = to
                    break
            k = max(last, k + 1)
        if len(lines) > 1 and left:  # other breaks: from the first line of each remainder of four, and where something compressed begins
            at, seen = 0, set()
            for k, (_, t) in enumerate(lines):
                if k in left and (at % 4 not in seen or _PACKED_RUN.match(t)):
                    fresh = at % 4 not in seen
                    seen.add(at % 4)
                    if k < len(lines) - 1 and took(lines[k:], clean=not fresh):
                        left -= set(range(k, len(lines)))
                        break
                at += len(t)
        for k in sorted(left):
            at, whole = lines[k]
            if len(whole) < RUN_LEAST or took([(at, whole)]) or whole.isalnum():
                continue
            for p in _PART.finditer(whole):
                took([(at + p.start(), p.group())])
    return found, cut


def scan_text(text: str) -> tuple[list[tuple[int, int, str, int]], int]:
    """All spans (start, end, kind, depth) in places of `text`, those at depth 0 from the text itself; layers cut short.

    A layer that was seen before at the same place is not unwrapped again, so encodings that yield themselves end.
    """
    spans = {(s, e, k): 0 for s, e, k in base_spans(text)}
    work, seen, cut = [_Layer(text, None, None, 0)], {(hash(text), 0, len(text))}, 0
    while work:
        layer = work.pop()
        if layer.depth:
            for s, e, kind in base_spans(layer.text):
                key = (*layer.place(s, e), kind)
                spans[key] = min(spans.get(key, layer.depth), layer.depth)
        inner = []
        if "%" in layer.text:
            inner.append(_from_url(layer))
            if _URL_HINT.search(layer.text):
                more, over = _from_bytes(layer, _URL_BYTE)
                inner += more
                cut += over
        if "\\" in layer.text:
            inner.append(_from_escapes(layer))
            if _ESCAPED_HINT.search(layer.text):
                more, over = _from_bytes(layer, _ESCAPED_BYTE)
                inner += more
                cut += over
        if "\0" in layer.text:
            inner.append(_from_wide(layer))
        more, over = _from_base64(layer)
        cut += over
        for new in [*inner, *more]:
            if new is None or not new.text:
                continue
            mark = (hash(new.text), *new.place(0, len(new.text)))
            if mark not in seen:
                seen.add(mark)
                work.append(new)
    order = {k: n for n, k in enumerate(KINDS)}
    return sorted(((s, e, k, d) for (s, e, k), d in spans.items()), key=lambda x: (x[0], order[x[2]], x[1])), cut


def redacted(text: str, spans: list[tuple[int, int, str, int]]) -> str:
    """The text with each maximal covered stretch replaced."""
    out, at = [], 0
    for s, e, *_ in spans:
        if e <= at:
            continue
        if s > at or not out:
            out += [text[at:s], REPLACEMENT]
        at = e
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text: str = "text", spans: str = "secret_spans", clean: str = "clean_text", cut: str = "cut_layers") -> DataFrame:
    """Every row of `docs` with its secret spans, its text without them, and the number of layers the bomb guard ended.

    Spans are sorted by start, then kind in the order of KINDS, then end; code points, end exclusive; depth 0 is the text
    itself, greater depths are decoded layers, mapped to the stretch of the text that they came from. URL escapes and
    Unicode escapes and two-byte characters are decoded within the whole layer, base64 runs (also URL-safe, unpadded and
    over single line breaks) and compressed data (gzip, zlib, bzip2, xz, zstandard; in base64 or as escaped bytes, with
    all members, broken data as far as it can be read) as layers of their own, until nothing new appears. Bytes that are
    no UTF-8 are read as Latin-1.
    A null text counts as empty: no spans, and its clean text stays null. Rows, ties and repeats stay as they are; columns
    of `docs` with the three new names are replaced.
    """
    kept = docs.drop(spans, clean, cut)
    rows = kept.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept.columns)), F.col(f"`{text}`").cast("string").alias("text"))
    schema = ", ".join([*(f"c{k} {kept.schema[c].dataType.simpleString()}" for k, c in enumerate(kept.columns)), f"spans {SPANS}, clean string, cut int"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in text_blocks(frames, "text"):
            found, texts, cuts = [], [], []
            for value in frame.text:
                if not isinstance(value, str):
                    found.append([])
                    texts.append(None)
                    cuts.append(0)
                    continue
                here, over = scan_text(value)
                found.append([{"kind": k, "start": s, "end": e, "depth": d} for s, e, k, d in here])
                texts.append(redacted(value, here) if here else value)
                cuts.append(over)
            yield frame.drop(columns="text").assign(spans=found, clean=texts, cut=cuts)

    ship(docs.sparkSession)
    out = rows.mapInPandas(run, schema)
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(kept.columns)), F.col("spans").alias(spans), F.col("clean").alias(clean), F.col("cut").alias(cut))
