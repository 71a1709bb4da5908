"""Near-duplicate documents by b-bit MinHash: band candidates, collision-corrected estimates, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.common import components, keep, mixed, text_blocks

#: 28 bands of 4 minima: a pair of similarity 0.8 shares no band once in two million times, one of 0.3 a band once in five.
BANDS, ROWS = 28, 4
#: Low bits kept of each minimum.
BITS = 2
#: Standard deviations of the estimate below the threshold at which a candidate is still confirmed exactly.
SLACK = 4.5
#: Minima of the finer signature, one bit of each, that members of buckets get which one star could not settle.
FINE = 2048
#: A bucket of so many members is compared whole in one round; a larger one by a star, then by 8 stars, then in blocks.
SMALL = 8
#: Members of a block: what is left of a bucket after its stars is compared block against block.
BLOCK = 2048
_rng = np.random.default_rng(20250107)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_FACTOR = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_FINE_FACTOR = _rng.integers(1, 1 << 63, FINE, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of bytes other than \\x20 and \\x09-\\x0D), and the words of each text."""
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # the last byte is a space
    powers = np.full(len(data), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    # a word's value is divided by its first power: the base is odd, so it has an inverse modulo 2^64
    inverse = np.full(len(data), np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_BYTE[data] * powers)])
    word = mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return word, np.diff(np.searchsorted(start, ends), prepend=0)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; with fewer words the whole sequence is one shingle."""
    word, n = word_hashes(texts)
    held = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        held += word[k : len(held) + k] * _STEP[k]
    held = mixed(held)
    sets, at = [], 0
    for size in n:
        if size >= words:
            sets.append(np.unique(held[at : at + size - words + 1]))
        elif size:
            short = (word[at : at + size] * _STEP[:size]).sum(dtype=np.uint64, keepdims=True) + np.uint64(size)
            sets.append(mixed(short))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += size
    return sets


def minima(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """Row per set, column per hash function: the least 32-bit hash value (sets must not be empty)."""
    out = np.empty((len(sets), len(factors)), np.uint32)
    for first in range(0, len(sets), 64):
        some = sets[first : first + 64]
        flat, starts = np.concatenate(some), np.cumsum([0, *(len(s) for s in some[:-1])])
        for k, factor in enumerate(factors):
            value = flat * factor
            value >>= np.uint64(32)
            out[first : first + 64, k] = np.minimum.reduceat(value.astype(np.uint32), starts)
    return out


def identity(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits that tell sets apart: two sums over mixed members."""
    out = np.zeros((len(sets), 2), np.uint64)
    for k, s in enumerate(sets):
        out[k] = s.sum(dtype=np.uint64), (s * mixed(s)).sum(dtype=np.uint64)
    return out.view(np.int64)


def _fine(words: int):
    """The finer signature of each text with words."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in text_blocks(frames, "text"):
            sets = [s for s in shingle_sets(_lower(frame.text), words) if len(s)]
            same = identity(sets)
            bits = np.packbits((minima(sets, _FINE_FACTOR) & 1).astype(np.uint8), axis=1).view(np.int64) if sets else []
            yield pd.DataFrame({"n_shingles": [len(s) for s in sets], "same_a": same[:, 0], "same_b": same[:, 1], "fine": list(bits)})

    return build


def planes(least: np.ndarray) -> np.ndarray:
    """The lowest bits of each minimum, packed: two 64-bit words for the first bits of all minima, two for the second, ..."""
    out = np.zeros((len(least), 2 * BITS), np.uint64)
    for k in range(least.shape[1]):
        for bit in range(BITS):
            out[:, 2 * bit + k // 64] |= ((least[:, k].astype(np.uint64) >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k % 64)
    return out.view(np.int64)


def _lower(texts: pd.Series) -> list[bytes]:
    """UTF-8 bytes with A-Z in lower case; other letters stay."""
    return [t.encode("utf-8", "surrogatepass").lower() if isinstance(t, str) else b"" for t in texts]


def _signatures(words: int):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in text_blocks(frames, "text"):
            sets = shingle_sets(_lower(frame.text), words)
            size = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(size)
            band = np.zeros((len(sets), BANDS), np.int64)
            bits = np.zeros((len(sets), 2 * BITS), np.int64)
            same = identity(sets)
            if len(some):
                least = minima([sets[k] for k in some], _FACTOR)
                grouped = least.reshape(len(some), BANDS, ROWS).astype(np.uint64)
                band[some] = mixed((grouped * _STEP[:ROWS]).sum(axis=2, dtype=np.uint64)).view(np.int64)
                bits[some] = planes(least)
            yield pd.DataFrame({
                "doc_id": frame.doc_id, "n_shingles": size, "same_a": same[:, 0], "same_b": same[:, 1],
                "bands": list(band), **{f"s{k}": bits[:, k] for k in range(2 * BITS)},
            })

    return sign


def _sets(words: int):
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in text_blocks(frames, "text"):
            sets = shingle_sets(_lower(frame.text), words)
            same = identity(sets)
            yield pd.DataFrame({
                "n_shingles": [len(s) for s in sets], "same_a": same[:, 0], "same_b": same[:, 1], "shingles": [s.view(np.int64) for s in sets],
            })

    return build


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of the rows aliased a and b, estimated by bit counts and freed of chance agreement of low bits."""
    differ = F.lit(0)
    for half in range(2):
        bits = [F.col(f"{a}.s{2 * bit + half}").bitwiseXOR(F.col(f"{b}.s{2 * bit + half}")) for bit in range(BITS)]
        either = bits[0]
        for more in bits[1:]:
            either = either.bitwiseOR(more)
        differ = differ + F.bit_count(either)
    chance = 0.5**BITS
    return (1 - differ / F.lit(float(BANDS * ROWS)) - chance) / (1 - chance)


def _block_pairs(percent: int):
    """Pairs of one block, or between two, that the finer signature does not rule out.

    Documents of one component are not compared, and a pair is told only by the first open bucket that it shares."""
    least = percent / 100 - threshold_slack(percent, FINE, 1)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows[rows.left]
        right = rows[~rows.left] if rows.other.iat[0] != rows.block.iat[0] else left
        first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        fine = np.stack(right.fine.to_list()).view(np.uint64) if len(right) else None
        bucket = rows.bucket.iat[0]
        shared = [np.stack([np.asarray(x, np.int64) for x in side.mine]) for side in (left, right) if len(side)]
        for at in range(len(left) if len(right) else 0):
            here = left.iloc[at]
            some = np.flatnonzero((right.component.values != here.component) & (100 * np.minimum(right.n.values, here.n) >= percent * np.maximum(right.n.values, here.n)))
            differ = np.bitwise_count(fine[some] ^ np.asarray(here.fine).view(np.uint64)).sum(axis=1, dtype=np.int64)
            some = some[1 - 2 * differ / FINE >= least]
            if len(some):
                same = (shared[1][some] == shared[0][at]) & (shared[0][at] != 0)
                some = some[shared[0][at][same.argmax(axis=1)] == bucket]
                first[0].append(np.full(len(some), here.id, np.int64))
                first[1].append(right.id.values[some])
        a, b = np.concatenate(first[0]), np.concatenate(first[1])
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return compare


def in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components among all members of each bucket.

    `rows` hold bucket, band, id, component, n and fine. The largest component of a bucket is never compared with itself;
    the others meet it and each other in blocks of about BLOCK members, one task's group being two blocks at most."""
    counts = rows.groupBy("bucket", "component").agg(F.count("*").alias("m"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("m"))
    main = main.select(
        "bucket", F.col("top.component").alias("main"),
        F.ceil(F.col("top.m") / BLOCK).alias("main_blocks"), F.ceil((F.col("m") - F.col("top.m")) / BLOCK).alias("blocks"),
    )
    slots = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.coalesce(F.element_at("held", k), F.lit(0).cast("long")))
    mine = rows.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("band", "bucket"))).alias("held")).select("id", slots.alias("mine"))
    # blocks of the main component are numbered below 0, the others from 0
    in_main = F.col("component") == F.col("main")
    block = F.when(in_main, -1 - F.pmod(F.xxhash64("id"), "main_blocks")).otherwise(F.pmod(F.xxhash64("id"), F.col("blocks")))
    placed = rows.select("bucket", "id", "component", "n", "fine").join(main, "bucket").withColumn("at", block).join(mine, "id")

    def pair(block: Column, other: Column, left: bool) -> Column:
        return F.struct(block.alias("block"), other.alias("other"), F.lit(left).alias("left"))

    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    as_left = F.transform(F.sequence(-F.col("main_blocks"), F.col("blocks") - 1), lambda o: pair(F.col("at"), o, True))
    as_left = F.filter(as_left, lambda p: (p["other"] < 0) | (p["other"] >= p["block"]))
    as_right = F.filter(F.transform(others, lambda b: pair(b, F.col("at"), False)), lambda p: (p["other"] < 0) | (p["other"] > p["block"]))
    dealt = placed.withColumn("pair", F.explode(F.when(in_main, as_right).otherwise(F.concat(as_left, as_right))))
    dealt = dealt.select("bucket", "pair.*", "id", "component", "n", "fine", "mine")
    return dealt.groupBy("bucket", "block", "other").applyInPandas(_block_pairs(percent), "a long, b long").distinct()


def link(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Near-duplicate classes: rows (doc_id, n_shingles, component_id, kept), one per row of `docs`.

    Words are runs of characters other than \\x20 and \\x09-\\x0D, with A-Z in lower case; a document's set holds its
    distinct shingles of `words` words, or its whole word sequence if that is shorter. Documents are linked when
    100 * |a & b| >= percent * |a | b|, always confirmed on the full sets; component_id is the smallest doc_id that links
    reach. Null, empty and wordless texts have no set and are linked with nothing. Rows that repeat a doc_id are judged
    one by one as documents of equal id, so they share the component of the smallest. Rows with null doc_id take no part
    in links: n_shingles is theirs, component_id null and kept false. An empty table gives an empty result. Other
    columns are not looked at.

    Equal sets collapse to one representative first, so groups of copies never meet as pairs. Bands of minima give
    buckets of representatives; b-bit estimates drop pairs far below the threshold, the rest is confirmed. Large buckets
    are compared by stars around their best-connected members in two rounds; what is left of a bucket in more than one
    component is compared in blocks, so no pair of different components goes unchecked. From the second round on, a finer
    signature of the few documents left in open buckets keeps pairs just below the threshold from being made.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, same_a long, same_b long, bands array<long>, " + ", ".join(f"s{k} long" for k in range(2 * BITS))
    signed = keep(rows.mapInPandas(_signatures(words), schema), "signatures")
    same = ["n_shingles", "same_a", "same_b"]
    # a set is known by its key from here on, so that repeated ids do no harm
    keyed = signed.withColumn("id", F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.xxhash64(*same)))
    light = keep(keyed.where("id is not null").groupBy("id").agg(F.min("doc_id").alias("doc_id")), "light")
    first = keyed.join(light, ["id", "doc_id"], "left_semi").dropDuplicates(["id"])
    first = keep(first.select("id", "n_shingles", "bands", *(f"s{k}" for k in range(2 * BITS))), "representatives")
    facts = first.select("id", F.col("n_shingles").alias("n"), *(f"s{k}" for k in range(2 * BITS)))
    banded = first.select("id", F.posexplode("bands").alias("band", "key")).select("id", "band", F.xxhash64("band", "key").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("m"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("h")).where("m > 1")
    # bands of equal membership ask the same question: one of them is enough
    buckets = buckets.groupBy("m", "h").agg(F.min("bucket").alias("bucket"), F.count("*").alias("times"))
    members = keep(banded.join(buckets.select("bucket", "m", "times"), "bucket"), "members")
    popular = members.groupBy("id").agg(F.sum(F.col("m") * F.col("times")).alias("popular"))
    active = members.select("bucket", "band", "id").join(popular, "id").join(facts, "id").withColumn("component", F.col("id"))
    active = keep(active, "active")
    sets = edges = links = fine = None
    # the whole texts travel once; rounds look among those that share a bucket with another
    shared = light.join(members.select("id").distinct(), "id", "left_semi").select("doc_id")
    shared_texts = keep(rows.join(shared, "doc_id", "left_semi"), "texts", "zstd")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """A text for each wanted set, and perhaps others of the same id."""
        return shared_texts.join(light.join(wanted, "id", "left_semi"), "doc_id", "left_semi")

    centres_now = 1
    while True:
        size = active.groupBy("bucket").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        size = size.where("m > 1 and lo <> hi").select("bucket", "m")
        open_rows = keep(active.join(size, "bucket"), "open")
        if open_rows.isEmpty():
            break
        if centres_now > 1:
            if fine is None:
                wanted = open_rows.select("id").distinct()
                fine = texts_of(wanted).mapInPandas(_fine(words), "n_shingles long, same_a long, same_b long, fine array<long>")
                fine = keep(fine.select(F.xxhash64(*same).alias("id"), "fine").dropDuplicates(["id"]), "fine")
            open_rows = open_rows.join(fine, "id")
        last = centres_now > SMALL
        if last:
            pairs = in_blocks(open_rows, percent)
        else:
            alike = likeness("c", "o") >= percent / 100 - threshold_slack(percent, BANDS * ROWS, BITS)
            if fine is not None:
                differ = F.lit(0)
                for k in range(FINE // 64):
                    differ = differ + F.bit_count(F.get("c.fine", F.lit(k)).bitwiseXOR(F.get("o.fine", F.lit(k))))
                alike = alike & (1 - 2 * differ / F.lit(float(FINE)) >= percent / 100 - threshold_slack(percent, FINE, 1))
            order = Window.partitionBy("bucket").orderBy(F.desc("popular"), "id")
            ranked = open_rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(SMALL, centres_now))
            centres = keep(ranked.where((F.col("m") <= SMALL) | (F.col("place") <= centres_now)).drop("m"), "centres")
            pairs = centres.alias("c").join(open_rows.alias("o"), "bucket").where(
                "c.id <> o.id and c.component <> o.component and 100 * least(c.n, o.n) >= {0} * greatest(c.n, o.n)".format(percent)
            ).where(alike)
            pairs = pairs.select(F.least("c.id", "o.id").alias("a"), F.greatest("c.id", "o.id").alias("b")).distinct()
        if edges is not None:
            pairs = pairs.join(edges.select("a", "b"), ["a", "b"], "left_anti")
        pairs = keep(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("id"), "id", "left_anti")
        wanted = keep(wanted, "wanted")
        if not wanted.isEmpty():
            built = texts_of(wanted).mapInPandas(_sets(words), "n_shingles long, same_a long, same_b long, shingles array<long>")
            built = built.select(F.xxhash64(*same).alias("id"), "shingles").join(wanted, "id", "left_semi")
            built = keep(built.dropDuplicates(["id"]), "sets")
            sets = built if sets is None else sets.union(built)
        if sets is not None:
            judged = (
                pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
                .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
                .withColumn("both", F.size(F.array_intersect("sa", "sb")))
                .select("a", "b", (100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).alias("linked"))
            )
            judged = keep(judged, "judged")
            edges = judged if edges is None else edges.union(judged)
            links = components(edges.where("linked").select("a", "b"))
        if last:
            break
        rest = open_rows.drop("m", "fine").join(centres.select("bucket", "id"), ["bucket", "id"], "left_anti")
        if links is not None:
            rest = rest.drop("component").join(links, "id", "left").withColumn("component", F.coalesce("component", "id"))
        active = keep(rest.select(*active.columns), "active")
        centres_now *= 8
    if links is None:
        links = spark.createDataFrame([], "id long, component long")
    named = light.join(links, "id", "left").withColumn("component", F.coalesce("component", "id"))
    tops = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = keyed.select("id", "doc_id", "n_shingles").join(named.join(tops, "component").select("id", "component_id"), "id", "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(False)).alias("kept"),
    )


def threshold_slack(percent: int, hashes: int, bits: int) -> float:
    """Distance below the threshold that an estimate of a linked pair stays within, by SLACK standard deviations."""
    chance = 0.5**bits
    agree = chance + (1 - chance) * percent / 100
    return SLACK * (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)
