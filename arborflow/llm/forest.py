"""Nearest vectors by hash-prefix forests: sorted arrays of hash strings, searched by longest prefix, ascended in step."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Trees of a forest, bits of a hash string (one sign of a random projection each).
TREES, BITS = 32, 32
#: Vectors of one forest: the table is dealt into forests of about this size, all of which a query searches.
FOREST_ROWS = 8192
#: A query ascends until so large a share of a forest's vectors are its candidates.
SHARE = 0.5
#: Queries that one search holds.
QUERY_BLOCK = 4096


def _planes(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, TREES * BITS))


def hash_strings(vectors: np.ndarray, seed: int) -> np.ndarray:
    """TREES words for each vector; the highest bit is a string's first."""
    out = np.empty((len(vectors), TREES), np.uint32)
    planes = _planes(vectors.shape[1], seed)
    weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.uint64)
    for first in range(0, len(vectors), 1024):
        some = vectors[first : first + 1024]
        some = some / np.abs(some).max(axis=1, keepdims=True)
        signs = (some @ planes > 0).reshape(len(some), TREES, BITS)
        out[first : first + 1024] = (signs * weights).sum(axis=2).astype(np.uint32)
    return out


def cosines(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows in double precision; equal pairs give equal numbers wherever they stand."""
    a, b = queries / np.abs(queries).max(axis=-1, keepdims=True), others / np.abs(others).max(axis=-1, keepdims=True)
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


class Forest:
    def __init__(self, vectors: np.ndarray, seed: int) -> None:
        self.vectors = vectors
        strings = hash_strings(vectors, seed)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def candidates(self, strings: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """For each query's strings the rows that share its longest prefixes, all trees giving up one bit at a time."""
        for query in strings:
            low, high, ends = 0, BITS, {}

            def matches(depth: int, query: np.ndarray = query, ends: dict = ends) -> np.ndarray:
                """Bounds in every tree of the strings that share `depth` bits."""
                if depth not in ends:
                    mask = np.uint32(((1 << depth) - 1) << (BITS - depth) & 0xFFFFFFFF)
                    ends[depth] = np.array([
                        (np.searchsorted(self.sorted[:, t], query[t] & mask), np.searchsorted(self.sorted[:, t], query[t] | ~mask, side="right"))
                        for t in range(TREES)
                    ])
                return ends[depth]

            # the deepest level at which all trees together have enough; levels only lose rows, so halving finds it
            found = None
            while low < high:
                depth = (low + high + 1) // 2
                bounds = matches(depth)
                enough = int((bounds[:, 1] - bounds[:, 0]).sum()) >= wanted
                rows = self._rows(bounds) if enough else None
                if rows is not None and len(rows) >= wanted:
                    low, found = depth, rows
                else:
                    high = depth - 1
            yield found if low else np.arange(len(self.vectors))

    def _rows(self, bounds: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(self.vectors), bool)
        for t, (a, b) in enumerate(bounds):
            seen[self.order[a:b, t]] = True
        return np.flatnonzero(seen)


def _search(top: int, seed: int, share: float):
    def run(key: tuple, items: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, own in items.groupby("dim"):
            asked = queries[queries.dim == dim]
            if not len(asked):
                continue
            ids = own.vec_id.to_numpy(np.int64)
            by_id = np.argsort(ids, kind="stable")
            ids, vectors = ids[by_id], np.stack(own.vector.to_numpy()[by_id]).astype(np.float64)
            forest = Forest(vectors, seed)
            wanted = min(len(ids), max(top + 1, int(share * len(ids))))
            vectors_of = np.stack(asked.vector.to_numpy()).astype(np.float64)
            for q, query, rows in zip(asked.vec_id, vectors_of, forest.candidates(hash_strings(vectors_of, seed), wanted), strict=True):
                rows = rows[ids[rows] != q]
                scores = cosines(query[None, :], vectors[rows])
                if len(rows) > top:
                    least = np.partition(scores, len(rows) - top)[len(rows) - top]
                    some = scores >= least
                    rows, scores = rows[some], scores[some]
                best = np.lexsort((ids[rows], -scores))[:top]
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[rows[best]], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, top: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 11, share: float = SHARE,
) -> DataFrame:
    """The `top` rows of `vectors` nearest to each row of `queries` among those its forests give: query_id, rank, vec_id, score.

    Both tables have an id and an array. Nearness is the cosine in double precision, ties go to the smaller id; rows with
    the query's own id are no candidates. Null, empty and zero arrays, and arrays with null or non-finite components take no
    part, and only arrays of equal length meet. With fewer candidates all are returned. Rows that repeat are candidates
    each; a query that repeats is asked once. An empty table gives an empty result. Other columns are not looked at.

    `vectors` is dealt by id into forests of bounded size, `queries` go to every forest in blocks, and each forest gives
    its best few: what is shuffled is the vectors once, the queries once a forest, and `top` rows a query and forest.
    A forest keeps one sorted array of hash strings per tree; a query starts at the longest prefixes it shares and all
    trees give up bits in step until a share of the forest has been gathered. Equal vectors have equal strings, so a
    common vector's copies are found together and compared by id.
    """

    def usable(df: DataFrame) -> DataFrame:
        array = F.col(f"`{embedding}`").cast("array<double>")
        sound = F.forall(array, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(array, lambda x: x != 0)
        rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("vector"), F.size(embedding).alias("dim"), sound.alias("sound"))
        return rows.where("sound and vec_id is not null").drop("sound")

    items = usable(vectors)
    n = items.count()
    forests = max(1, -(-n // FOREST_ROWS))
    items = items.withColumn("forest", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(forests)).cast("int"))
    asked = usable(queries).dropDuplicates(["vec_id"])
    m = asked.count()
    blocks = max(1, -(-m // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("forest", F.explode(F.sequence(F.lit(0), F.lit(forests - 1))))
    items = items.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = items.groupBy("forest", "block").cogroup(asked.groupBy("forest", "block")).applyInPandas(
        _search(top, seed, share), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
