"""Exact substring dedup: what a document with a smaller id holds too is cut out, found by suffix arrays of shared runs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import keep, mixed, text_blocks

#: Length of the shortest match, and of the grams whose least hash anchors it, in bytes.
LEAST, GRAM = 50, 16
#: Bytes of text about that a chunk of documents holds, that anchors are gathered over, and that a bucket stands for.
CHUNK_BYTES, FLUSH_BYTES, BUCKET_BYTES = 1 << 18, 1 << 22, 1 << 22
_rng = np.random.default_rng(20250211)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _squeeze(*arrays: np.ndarray) -> bytes:
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array([len(p) for p in parts], np.int64).tobytes(), *parts]))


def _spread(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = np.cumsum(sizes) + 8 * len(kinds)
    return [np.frombuffer(raw[e - s : e], k) for s, e, k in zip(sizes, ends, kinds, strict=True)]


def gram_hashes(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """64-bit hashes of all substrings of each length, from one prefix sum of weighted bytes."""
    powers = np.full(len(data) + 1, np.uint64(_BASE), np.uint64)
    inverse = np.full(len(data) + 1, np.uint64(_INVERSE), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_BYTE[data] * powers[:-1])])
    return [mixed((total[k:] - total[: len(data) - k + 1]) * inverse[: len(data) - k + 1]) for k in lengths]


def _argmin_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every window, by doubling."""
    best, at, length = values, np.arange(len(values)), 1
    while length < width:
        step = min(length, width - length)
        right = best[step:] < best[:-step]
        at = np.where(right, at[step:], at[:-step])
        best = np.where(right, best[step:], best[:-step])
        length += step
    return at


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, identity, first start, starts) of the runs of LEAST-byte strings that share an anchor.

    A string's anchor is its gram of least hash: equal strings have equal anchors, wherever they stand. identity hashes
    the bytes of a run of strings from its first to its last.
    """
    if len(data) < LEAST:
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, strings = gram_hashes(data, (GRAM, LEAST))
    at = _argmin_of_windows(grams, LEAST - GRAM + 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    last = np.concatenate([first[1:], [len(at)]]) - 1
    place = at[first]
    identity = mixed(strings[first] ^ mixed(strings[last] + (last - first).astype(np.uint64)) ^ (place - first).astype(np.uint64))
    return grams[place], identity, first, last - first + 1


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, n = TaskContext.get().partitionId(), 0
    for frame in text_blocks(frames, "text", CHUNK_BYTES):
        texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in frame.text]
        yield pd.DataFrame({
            "chunk": [(part << 33) + n], "ids": [frame.doc_id.tolist()], "sizes": [[len(t) for t in texts]],
            "data": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))],
        })
        n += 1


def _texts(data: bytes, sizes: np.ndarray) -> list[np.ndarray]:
    whole = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.split(whole, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _ids(ids: list | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which are given."""
    given = np.array([x is not None and x == x for x in ids], bool)
    return np.array([int(x) if g else 0 for x, g in zip(ids, given, strict=True)], np.int64), given


def _least_of(anchor: np.ndarray, identity: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (anchor, identity, doc), and for each of that order whether its doc is the least of its identity."""
    order = np.lexsort((doc, identity, anchor))
    a, i, d = anchor[order], identity[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (i[1:] != i[:-1])
    least = d[new][np.cumsum(new) - 1]
    return order, d == least


_SENT = "chunk long, bucket int, kind int, payload binary"
#: Answers and requests of a bucket are a row a run: messages of each bucket to each chunk would grow with the square of the input.
_REPLY = "chunk long, bucket int, kind int, row int, first int, count int, payload binary"
_RUN = ["row", "first", "count"]


def _anchors(buckets: int):
    """Runs of each chunk to their anchor's bucket; a run that a smaller document gathered here has too is answered at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def flush() -> pd.DataFrame:
            anchor, identity, doc, chunk, row, first, count = (np.concatenate(x) for x in zip(*held, strict=True))
            order, least = _least_of(anchor, identity, doc)
            answers = _answers(chunk[order[~least]], row[order[~least]], first[order[~least]], count[order[~least]])
            out = [(c, c % buckets, kind, payload) for c, _, kind, payload in answers]
            rest = np.sort(order[least])
            anchor, identity, doc, chunk, row, first, count = (x[rest] for x in (anchor, identity, doc, chunk, row, first, count))
            bucket = (anchor >> np.uint64(20)) % np.uint64(buckets)
            by = np.argsort(bucket, kind="stable")
            for some in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
                start = np.concatenate([[0], np.flatnonzero(np.diff(chunk[some]) | np.diff(row[some])) + 1])
                owner = np.zeros(len(some), np.uint8)
                owner[start] = 1
                # (document, place) rise within a blob: differences are small and compress
                payload = _squeeze(
                    anchor[some], identity[some] >> np.uint64(16), owner, doc[some][start], chunk[some][start], row[some][start].astype(np.int32),
                    first[some].astype(np.int32), count[some].astype(np.uint8),
                )
                out.append((0, int(bucket[some[0]]), 1, payload))
            return pd.DataFrame(out, columns=["chunk", "bucket", "kind", "payload"])

        for frame in frames:
            for chunk, ids, sizes, data in zip(frame.chunk, frame.ids, frame.sizes, frame.data, strict=True):
                doc_ids, given = _ids(ids)
                for k, text in enumerate(_texts(data, np.asarray(sizes))):
                    size += len(text)
                    if given[k] and len(text) >= LEAST:
                        anchor, identity, first, count = runs(text)
                        held.append((anchor, identity, *(np.full(len(anchor), x, np.int64) for x in (doc_ids[k], chunk, k)), first, count))
                if size >= FLUSH_BYTES and held:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _answers(chunk: np.ndarray, row: np.ndarray, first: np.ndarray, count: np.ndarray, kind: int = 0, bucket: int = 0) -> list[tuple]:
    """One message for each chunk: starts that are covered."""
    by = np.lexsort((first, row, chunk))
    chunk, row, first, count = chunk[by], row[by], first[by], count[by]
    out = []
    for some in np.split(np.arange(len(by)), np.flatnonzero(np.diff(chunk)) + 1) if len(by) else []:
        out.append((int(chunk[some[0]]), bucket, kind, _squeeze(row[some].astype(np.int32), first[some].astype(np.int32), count[some].astype(np.int32))))
    return out


def _replies(chunk: np.ndarray, row: np.ndarray, first: np.ndarray, count: np.ndarray, kind: int = 0, bucket: int = 0) -> pd.DataFrame:
    """Starts that are covered, or runs whose bytes are wanted, by chunk."""
    by = np.lexsort((first, row, chunk))
    runs = {c: x[by].astype(np.int32) for c, x in zip(_RUN, (row, first, count), strict=True)}
    return pd.DataFrame({"chunk": chunk[by], "bucket": np.int32(bucket), "kind": np.int32(kind), **runs, "payload": None})


def _compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Runs that meet in a bucket: equal ones are answered; ones that share only the anchor have their bytes asked for.

    Answers that were found before travel through the same shuffle.
    """
    parts = []
    ready = frame[frame.kind == 0].assign(row=0, first=0, count=0)
    if len(ready) == len(frame):
        return ready
    for payload in frame.payload[frame.kind == 1]:
        anchor, identity, owner, doc, chunk, row, first, count = _spread(payload, np.uint64, np.uint64, np.uint8, np.int64, np.int64, np.int32, np.int32, np.uint8)
        at = np.cumsum(owner) - 1
        parts.append((anchor, identity, doc[at], chunk[at], row[at].astype(np.int64), first.astype(np.int64), count.astype(np.int64)))
    anchor, identity, doc, chunk, row, first, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order, least = _least_of(anchor, identity, doc)
    out = [ready, _replies(*(x[order[~least]] for x in (chunk, row, first, count)))]
    a, i, d = anchor[order], identity[order], doc[order]
    new = np.concatenate([[True], a[1:] != a[:-1]])
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    docs_differ = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)
    kinds_differ = np.minimum.reduceat(i, starts) != np.maximum.reduceat(i, starts)
    wanted = least & (docs_differ & kinds_differ)[group]
    out.append(_replies(*(x[order[wanted]] for x in (chunk, row, first, count)), kind=2, bucket=key[0]))
    return pd.concat([x for x in out if len(x)] or [ready])[["chunk", "bucket", "kind", *_RUN, "payload"]]


_EXCERPT = "bucket int, chunk long, row int, first int, count int, doc_id long, text binary"


def _excerpts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the runs that buckets asked for."""
    for frame in frames:
        for chunk, ids, sizes, data, *asked in zip(*(frame[c] for c in ("chunk", "ids", "sizes", "data", "bucket", *_RUN)), strict=True):
            sizes = np.asarray(sizes, np.int64)
            base, doc_ids = np.cumsum(sizes) - sizes, _ids(ids)[0]
            bucket, row, first, count = (np.asarray(x, np.int32) for x in asked)
            whole = zstandard.ZstdDecompressor().decompress(data)
            start = base[row] + first
            text = [whole[s:e] for s, e in zip(start.tolist(), (start + count + LEAST - 1).tolist(), strict=True)]
            yield pd.DataFrame({"bucket": bucket, "chunk": chunk, "row": row, "first": first, "count": count, "doc_id": doc_ids[row], "text": text})


def _sorted(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` bytes: by 8 bytes, and of those that agree with a neighbour by their next 8, and so on."""
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    order = order.copy()
    # places of `order` that are still tied, and the number of the tie that each is in
    tied, tie = np.arange(len(order)), np.zeros(len(order), np.int64)
    for k in range(0, depth, 8):
        own = order[tied]
        value = np.ascontiguousarray(words[own + k]).view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((value, tie)) if k else np.argsort(value, kind="stable")
        order[tied] = own[by]
        value, tie = value[by], tie[by]
        same = (value[1:] == value[:-1]) & (tie[1:] == tie[:-1])
        alike = np.zeros(len(tied), bool)
        alike[1:] = same
        group = np.cumsum(~alike)
        alike[:-1] |= same
        tied, tie = tied[alike], group[alike]
        if not len(tied):
            break
    return order


def suffix_array(text: np.ndarray, depth: int = LEAST, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of the suffixes of a byte array (0 ends a part), of all or of those in the mask `wanted`, sorted by their first `depth` bytes at least.

    Two stages: suffixes smaller than their successors are sorted directly, by their first bytes; each other one is its
    first byte before a smaller suffix. First bytes are taken in rising order: those before suffixes of smaller first bytes come
    in the order of these, then those before one of these of the same byte, and so on, then the directly sorted ones.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    after = np.concatenate([text[1:], np.zeros(1, np.uint8)])
    # a suffix is smaller than the next one if the first byte that differs from its own is larger
    change = np.flatnonzero(text != after)
    where = np.searchsorted(change, np.arange(n))
    rises = np.zeros(n, bool)
    known = where < len(change)
    rises[known] = text[change[where[known]]] < after[change[where[known]]]
    falls, needed = ~rises, np.ones(n, bool)
    if wanted is not None:  # and what these follow from: the next ones up to a directly sorted one
        seen = np.concatenate([[0], np.cumsum(wanted)])
        start = np.concatenate([[0], np.maximum.accumulate(np.where(rises, np.arange(1, n + 1), 0))])[:-1]
        needed = wanted | (seen[:-1] > seen[start])
        falls &= needed
    direct = _sorted(text, np.flatnonzero(rises & needed), depth)
    first = np.searchsorted(text[direct], np.arange(257))
    heads: list[list[np.ndarray]] = [[] for _ in range(256)]
    if falls[-1]:  # the last suffix is larger than the empty one that follows it
        heads[text[-1]].append(np.array([n - 1]))
    out = []
    for letter in np.unique(text).tolist():
        level = np.concatenate(heads[letter]) if heads[letter] else np.zeros(0, np.int64)
        parts = []
        while len(level):
            parts.append(level)
            level = level[level > 0] - 1
            level = level[falls[level] & (text[level] == letter)]
        own = np.concatenate([*parts, direct[first[letter] : first[letter + 1]]])
        out.append(own)
        before = own[own > 0] - 1
        before = before[falls[before] & (text[before] > letter)]
        before = before[np.argsort(text[before], kind="stable")]
        for some in np.split(before, np.flatnonzero(np.diff(text[before])) + 1) if len(before) else []:
            heads[text[some[0]]].append(some)
    found = np.concatenate(out)
    return found if wanted is None else found[wanted[found]]


def _resolve(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Which strings of the runs of a bucket a smaller document has too: neighbours in their suffix array with a long common prefix."""
    chunk, row, first, count, doc = (frame[c].to_numpy(np.int64) for c in ("chunk", *_RUN, "doc_id"))
    width = count + LEAST
    ends = np.cumsum(width)
    owner = np.repeat(np.arange(len(width)), width)
    nth = np.arange(len(owner)) - (ends - width)[owner]
    text = np.zeros(len(owner), np.uint8)
    text[nth < width[owner] - 1] = np.frombuffer(b"".join(frame.text), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255; 0 parts the runs
    order = suffix_array(text, wanted=nth < count[owner])
    windows = np.lib.stride_tricks.sliding_window_view(text, LEAST)
    same = np.zeros(len(order), bool)
    for at in range(1, len(order), 1 << 16):
        some = np.arange(at, min(at + (1 << 16), len(order)))
        same[some] = (windows[order[some]] == windows[order[some - 1]]).all(axis=1)
    starts = np.flatnonzero(~same)
    owners = doc[owner[order]]
    least = np.minimum.reduceat(owners, starts)[np.cumsum(~same) - 1] if len(order) else owners
    covered = np.sort(order[owners > least])
    new = np.ones(len(covered), bool)
    new[1:] = (np.diff(covered) != 1) | (owner[covered[1:]] != owner[covered[:-1]])
    heads = covered[new]
    lengths = np.diff(np.concatenate([np.flatnonzero(new), [len(covered)]]))
    of = owner[heads]
    return _replies(chunk[of], row[of], first[of] + nth[heads], lengths)[["chunk", *_RUN]]


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for ids, sizes, data, told, *runs in zip(*(frame[c] for c in ("ids", "sizes", "data", "told", *_RUN)), strict=True):
            sizes = np.asarray(sizes, np.int64)
            texts = _texts(data, sizes)
            steps = np.zeros(int((sizes + 1).sum()), np.int32)
            base = np.cumsum(sizes + 1) - sizes - 1
            messages = [_spread(message, np.int32, np.int32, np.int32) for message in told] if told is not None else []
            if runs[0] is not None:
                messages.append([np.asarray(x, np.int32) for x in runs])
            for row, first, count in messages:
                start = base[row] + first
                np.add.at(steps, start, 1)
                np.add.at(steps, start + count + LEAST - 1, -1)
            removed, out = np.cumsum(steps) > 0, []
            for k, (doc, text) in enumerate(zip(ids, texts, strict=True)):
                gone = removed[base[k] : base[k] + len(text)]
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                kept = text[~gone].tobytes()
                out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's bytes without what is covered by a LEAST-byte string that starts in a document of smaller id too.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept (the bytes that stay), a row
    per row of `docs`. Strings are judged on the input, and never cross documents. A null text is empty. A row with null id has
    no smaller and is no smaller one: nothing is removed from it or because of it; rows of equal id do not count against
    each other. An empty table gives an empty result. Other columns are not looked at.

    Strings meet by their anchor, the gram of least hash: runs of strings with one anchor go to buckets as hashes, after those
    that repeat within a task have been answered there. Runs that only share the anchor have their bytes fetched, and a
    suffix array of each bucket's excerpts tells which strings are shared. Texts travel in compressed chunks.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    chunks = keep(rows.mapInPandas(_chunks, "chunk long, ids array<long>, sizes array<int>, data binary"), "chunks")
    total = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")).first().n or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    sent = chunks.select("chunk", "ids", "sizes", "data").mapInPandas(_anchors(buckets), _SENT)
    met = keep(sent.groupBy("bucket").applyInPandas(_compare, _REPLY), "met", "zstd")
    asked = met.where("kind = 2").groupBy("chunk").agg(F.collect_list(F.struct("bucket", *_RUN)).alias("asked"))
    asked = chunks.join(asked, "chunk").select("chunk", "ids", "sizes", "data", "asked.bucket", *(f"asked.{c}" for c in _RUN))
    excerpts = asked.mapInPandas(_excerpts, _EXCERPT)
    resolved = keep(excerpts.groupBy("bucket").applyInPandas(_resolve, "chunk long, row int, first int, count int"), "resolved", "zstd")
    answers = met.where("kind = 0").select("chunk", *_RUN, "payload").unionByName(resolved, allowMissingColumns=True)
    own = F.when(F.col("payload").isNull(), F.struct(*_RUN))
    told = answers.groupBy("chunk").agg(F.collect_list("payload").alias("told"), F.collect_list(own).alias("own"))
    out = chunks.join(told, "chunk", "left").select("ids", "sizes", "data", "told", *(f"own.{c}" for c in _RUN))
    return out.mapInPandas(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
