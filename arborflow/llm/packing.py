"""Packing documents into token windows: combinations of lengths by non-negative least squares, the rest end to end."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.common import keep, mixed, text_blocks

WINDOW = 4096
#: Lengths are seen in units of so many tokens; a document's last, shorter stretch of tokens is packed end to end.
UNIT = 64
UNITS = WINDOW // UNIT
#: A combination fills a window with so many pieces at most.
DEPTH = 5
#: Words, and bytes of words, that a worker remembers the ids of; it starts anew beyond. A word takes about 40 bytes.
MEMORY, MEMORY_BYTES = 1_000_000, 1 << 24
#: Bytes of text that are looked up at once; longer texts are cut between words.
PIECE = 1 << 19
#: Bits of a hash that give the place where a known word is looked for first.
SLOT_BITS = 20
#: Words that are encoded in one call.
BATCH = 500
#: Rows (one per task and length) up to which counts travel to the pieces, and not the pieces to the counts.
SMALL_COUNTS = 1_000_000
#: Stands between words when many are encoded at once; words that hold it are encoded one by one.
_MARK = "\x01"


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.held, self.size = np.zeros(1 << 12, kind), 0

    def append(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.zeros(max(len(self.held), len(values)), self.held.dtype)])
        self.held[self.size : self.size + len(values)] = values
        self.size += len(values)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all members of runs that begin at `starts`."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class WordTokenizer:
    """Ids of whole texts by a tokenizer that never joins anything across spaces and line feeds.

    Texts are cut there, each different word is encoded once, and ids are put together again: the same ids as encoding
    the text as a whole, since the tokenizer drops white space and treats what stands between as if alone. Known
    words are found by their hash in a sorted array, for a block of text at once, and then compared byte by byte.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._ids(_MARK)
        assert len(self.mark) == 1
        rng = np.random.default_rng(17)
        self.code = rng.integers(1, 1 << 63, 256, np.uint64)
        base = int(rng.integers(1, 1 << 62)) * 2 + 1
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.power, self.back = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.clear()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted, and the word of each
        self.slots, self.slot_hashes = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, np.uint64)  # 0: none
        self.bytes, self.starts, self.sizes = _Grown(np.uint8), _Grown(np.int32), _Grown(np.int32)
        self.pool, self.id_starts, self.id_sizes = _Grown(np.uint16), _Grown(np.int32), _Grown(np.int32)

    def _hash(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Polynomial of each word's bytes: one running sum over the block, differences moved to a common power."""
        while len(self.power) <= len(data):
            n = len(self.power)
            self.power = np.concatenate([self.power, self.power * (self.power[-1:] * self.base)])
            self.back = np.concatenate([self.back, self.back * (self.back[-1:] * self.inverse)])
            assert len(self.power) == 2 * n
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.code[data] * self.power[: len(data)], dtype=np.uint64)])
        return mixed((total[starts + sizes] - total[starts]) * self.back[starts] + sizes.astype(np.uint64))

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        odd = np.array([_MARK.encode() in w for w in words], bool)
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        words, hashes, plain = [words[k] for k in order], hashes[order], int((~odd).sum())
        ids, id_sizes = [], []
        for first in range(0, plain, BATCH):
            some = words[first : min(first + BATCH, plain)]
            joined = f" {_MARK} ".encode().join(some).decode("utf-8")
            flat = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(flat == self.mark[0])
            assert len(cuts) == len(some) - 1
            id_sizes.append(np.diff(np.concatenate([[-1], cuts, [len(flat)]])) - 1)
            ids.append(flat[flat != self.mark[0]])
        for word in words[plain:]:
            ids.append(np.array(self._ids(word.decode("utf-8")), np.int64))
            id_sizes.append(np.array([len(ids[-1])]))
        sizes, id_sizes = np.array([len(w) for w in words], np.int64), np.concatenate(id_sizes)
        n = self.starts.size
        self.starts.append(self.bytes.size + np.cumsum(sizes) - sizes)
        self.sizes.append(sizes)
        self.bytes.append(np.frombuffer(b"".join(words), np.uint8))
        self.id_starts.append(self.pool.size + np.cumsum(id_sizes) - id_sizes)
        self.id_sizes.append(id_sizes)
        self.pool.append(np.concatenate(ids).astype(np.uint16))
        by_hash = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[by_hash])
        self.hashes, self.number = np.insert(self.hashes, at, hashes[by_hash]), np.insert(self.number, at, n + by_hash)
        place = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        free = np.flatnonzero(self.slot_hashes[place] == 0)  # frequent words come early and keep their slots
        free = free[np.unique(place[free], return_index=True)[1]]
        self.slots[place[free]], self.slot_hashes[place[free]] = n + free, hashes[free]

    def _words(self, raw: bytes, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The word of each hash, learnt where it is new: by its slot, and where another word has taken that, by the sorted hashes."""
        place = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        word = self.slots[place]
        left = np.flatnonzero((self.slot_hashes[place] != hashes) | (hashes == 0))
        if not len(left):
            return word
        hashes, first, which = np.unique(hashes[left], return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        new = np.flatnonzero(at == len(self.hashes)) if not len(self.hashes) else np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes)
        if len(new):
            self._learn(hashes[new], [raw[starts[k] : starts[k] + sizes[k]] for k in left[first[new]]])
        word[left] = self.number[np.searchsorted(self.hashes, hashes)][which]
        return word

    def _block(self, pieces: list[bytes]) -> list[np.ndarray]:
        if self.starts.size > MEMORY or self.bytes.size > MEMORY_BYTES:
            self.clear()
        raw = b"\n".join(pieces)
        data = np.frombuffer(raw, np.uint8)
        cuts = np.concatenate([[-1], np.flatnonzero((data == 32) | (data == 10)), [len(data)]])
        starts, sizes = cuts[:-1] + 1, np.diff(cuts) - 1
        starts, sizes = starts[sizes > 0], sizes[sizes > 0]
        word = self._words(raw, starts, sizes, self._hash(data, starts, sizes))
        same = self.sizes.held[word] == sizes
        own, known = _spread(starts[same], sizes[same]), _spread(self.starts.held[word[same]], sizes[same])
        differ = np.flatnonzero(data[own] != self.bytes.held[known])
        id_sizes = self.id_sizes.held[word]
        flat = self.pool.held[_spread(self.id_starts.held[word], id_sizes)]
        ends = np.cumsum([len(p) + 1 for p in pieces])
        last = np.concatenate([[0], np.cumsum(id_sizes)])[np.searchsorted(starts, ends)]
        out = np.split(flat, last[:-1])
        # other words of the same hash: their texts are encoded as they are
        for k in np.unique(np.searchsorted(ends, np.concatenate([own[differ], starts[~same]]), side="right")):
            out[k] = np.array(self._ids(pieces[k].decode("utf-8")), np.uint16)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces, owner = [], []
        for k, text in enumerate(texts):
            data = text.encode("utf-8")
            while len(data) > PIECE and (cut := max(data.rfind(b" ", 0, PIECE), data.rfind(b"\n", 0, PIECE))) > 0:
                pieces.append(data[:cut])
                owner.append(k)
                data = data[cut + 1 :]
            pieces.append(data)
            owner.append(k)
        found: list[list[np.ndarray]] = [[] for _ in texts]
        block = np.cumsum([len(p) for p in pieces]) // PIECE if pieces else np.zeros(0, np.int64)
        for some in np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(block)) + 1) if pieces else []:
            for k, ids in zip(some, self._block([pieces[k] for k in some]), strict=True):
                found[owner[k]].append(ids)
        return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in found]


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _tokens(path: str, end: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen, seen_full, tails = TaskContext.get().partitionId(), np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64), 0
        words = tokenizer(path)
        for frame in text_blocks(frames, "text", PIECE):
            ids = words.encode(frame.text.fillna("").tolist())
            size = np.array([len(x) + 1 for x in ids], np.int64)
            full, units, tail = size // WINDOW, size % WINDOW // UNIT, size % UNIT
            nth, full_at = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            for unit in np.unique(units):
                rows = np.flatnonzero(units == unit)
                nth[rows] = seen[unit] + np.arange(len(rows))
                seen[unit] += len(rows)
                full_at[rows] = seen_full[unit] + np.cumsum(full[rows]) - full[rows]
                seen_full[unit] += full[rows].sum()
            tail_at = tails + np.cumsum(tail) - tail
            tails += int(tail.sum())
            yield pd.DataFrame({
                "doc_id": frame.doc_id, "part": part, "full": full, "full_at": full_at, "units": units, "nth": nth, "tail": tail, "tail_at": tail_at,
                "ids": [np.append(x, np.uint16(end)).astype("<u2").tobytes() for x in ids],
            })

    return run


def combinations() -> np.ndarray:
    """All ways to fill a window with at most DEPTH lengths in whole units: a row each, the number of each length in columns."""
    found = []

    def extend(left: int, least: int, taken: tuple[int, ...]) -> None:
        if left >= least and len(taken) < DEPTH:
            found.append((*taken, left))
        if len(taken) < DEPTH - 1:
            for unit in range(least, left // 2 + 1):
                extend(left - unit, unit, (*taken, unit))

    for unit in range(1, UNITS // 2 + 1):
        extend(UNITS - unit, unit, (unit,))
    out = np.zeros((len(found), UNITS), np.int64)
    for row, units in enumerate(found):
        for unit in units:
            out[row, unit % UNITS] += 1
    return out


def least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with a' x near b: projected gradient steps with momentum, restarted when they turn back."""
    a = a.astype(np.float64)
    x = y = np.zeros(len(a))
    step, t = 1 / np.linalg.eigvalsh(a.T @ a)[-1], 1.0
    for _ in range(rounds):
        slope = a @ (a.T @ y - b)
        new = np.maximum(y - step * slope, 0)
        if slope @ (new - x) > 0:
            t = 1.0
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / grown * (new - x), new, grown
    return x


def plan(histogram: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Slots for pieces by length: (units, first, slots, each, sequence, offset).

    The pieces of a length are numbered; those from `first` on, `slots` of them, go `each` to a sequence, from sequence
    `sequence` on, at `offset` and following. Repeat counts are the rounded-down solution for the histogram, and never
    take more pieces than there are; counted sequences start at 0.
    """
    combos = combinations()
    wanted = histogram[:UNITS].astype(np.float64)
    wanted[0] = 0
    weights = np.floor(least_squares(combos, wanted)).astype(np.int64)
    left, used = histogram.astype(np.int64).copy(), np.zeros(UNITS, np.int64)
    rows, sequence = [], 0
    for row in np.argsort(-weights, kind="stable"):
        units = np.flatnonzero(combos[row])
        times = int(min([weights[row], *(left[u] // combos[row, u] for u in units)]))
        if times <= 0:
            continue
        offset = 0
        for u in units:
            each = int(combos[row, u])
            rows.append((int(u), int(used[u]), each * times, each, sequence, offset))
            used[u] += each * times
            left[u] -= each * times
            offset += each * int(u) * UNIT
        sequence += times
    return rows


def pack(docs: DataFrame, path: str, end: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of WINDOW tokens: doc_id, start, length, ids (little-endian 16 bit), doc_tokens, sequence_id, offset.

    A document is its text's ids and then `end`; a null or empty text has that one id. Stretches of a whole window are
    sequences of their own. What is left is cut into a piece of whole units and a tail below a unit. Pieces take the slots
    of combinations that fill a window, chosen by non-negative least squares against the histogram of lengths; pieces
    without a slot and all tails follow each other end to end and are cut where a window ends, so that only the very last
    sequence can be short. Ranks and positions come from counts per task and length, which are broadcast up to SMALL_COUNTS
    rows, so no row is sorted or moved.
    Rows that repeat are packed as often. An empty table gives an empty result. Other columns are not looked at.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    # ids travel as text: pandas has no null integers and would round large ones
    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "doc_id string, part long, full long, full_at long, units long, nth long, tail long, tail_at long, ids binary"
    tokens = keep(rows.mapInPandas(_tokens(path, end), schema), "tokens")
    counted = tokens.groupBy("part", "units").agg(F.count("*").alias("n"), F.sum("full").alias("full"), F.sum("tail").alias("tails"))
    counted = keep(counted, "counts")
    histogram = np.zeros(UNITS, np.int64)
    for row in counted.groupBy("units").agg(F.sum("n").alias("n")).collect():  # at most UNITS rows
        histogram[row.units] = row.n
    slots = plan(histogram)
    matched = max([s + n // each for _, _, n, each, s, _ in slots], default=0)
    taken = np.zeros(UNITS, np.int64)
    for u, _, n, *_ in slots:
        taken[u] += n
    # the end-to-end stream: pieces without a slot by length, then tails by partition
    rest = (histogram - taken) * np.arange(UNITS) * UNIT
    base = np.cumsum(rest) - rest
    per_length = Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("part").agg(F.sum("full").alias("full"), F.sum("tails").alias("tails"))  # a row per task
    totals = totals.select("part", *(F.coalesce(F.sum(c).over(per_part), F.lit(0)).alias(f"{c}_before") for c in ("full", "tails")))
    lower = Window.partitionBy("part").orderBy("units").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        "part", "units", F.coalesce(F.sum("n").over(per_length), F.lit(0)).alias("n_before"), F.coalesce(F.sum("full").over(lower), F.lit(0)).alias("full_lower"),
    ).join(totals, "part")
    placed = tokens.join(F.broadcast(before) if counted.count() <= SMALL_COUNTS else before, ["part", "units"])
    full_total = F.lit(int(sum(r.full for r in counted.agg(F.sum("full").alias("full")).collect() if r.full)))
    slots_of = np.array(slots, np.int64).reshape(-1, 6)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield _pieces(frame, slots_of, taken, base, int(rest.sum()), matched)

    wanted = placed.select(
        "doc_id", "full", "units", "tail", "ids", (F.col("n_before") + F.col("nth")).alias("rank"),
        (F.col("tails_before") + F.col("tail_at")).alias("tail_at"), (F.col("full_before") + F.col("full_lower") + F.col("full_at")).alias("full_at"), full_total.alias("full_total"),
    )
    out = "doc_id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return wanted.mapInPandas(cut, out).withColumn("doc_id", F.col("doc_id").cast(id_type))


def _pieces(frame: pd.DataFrame, slots: np.ndarray, taken: np.ndarray, base: np.ndarray, rest: int, matched: int) -> pd.DataFrame:
    """Sequences: matched ones, then whole windows, then the end-to-end stream."""
    rows = []
    by_unit = {int(u): slots[slots[:, 0] == u] for u in np.unique(slots[:, 0])} if len(slots) else {}

    def stream(doc: int, ids: bytes, start: int, size: int, at: int, after: int) -> None:
        while size:
            inside = at % WINDOW
            some = min(size, WINDOW - inside)
            rows.append((doc, start, some, ids[2 * start : 2 * (start + some)], len(ids) // 2, after + at // WINDOW, inside))
            start, size, at = start + some, size - some, at + some

    for doc, full, unit, tail, ids, rank, tail_at, full_at, full_total in frame.itertuples(index=False, name=None):
        n, start = len(ids) // 2, 0
        for k in range(full):
            rows.append((doc, start, WINDOW, ids[2 * start : 2 * (start + WINDOW)], n, matched + full_at + k, 0))
            start += WINDOW
        if unit:
            size = unit * UNIT
            if rank < taken[unit]:
                own = by_unit[unit]
                _, first, _, each, sequence, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
                nth = rank - first
                rows.append((doc, start, size, ids[2 * start : 2 * (start + size)], n, int(sequence + nth // each), int(offset + nth % each * size)))
            else:
                stream(doc, ids, start, size, int(base[unit] + (rank - taken[unit]) * size), matched + full_total)
            start += size
        if tail:
            stream(doc, ids, start, tail, rest + tail_at, matched + full_total)
    return pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def crc32_of(ids: Column) -> Column:
    """crc32 of 16-bit ids written as 32-bit ones, little-endian."""

    @F.pandas_udf("long")
    def crc(values: pd.Series) -> pd.Series:
        return values.map(lambda v: zlib.crc32(np.frombuffer(v, "<u2").astype("<u4").tobytes()))

    return crc(ids)
