"""Helpers the operators share: table access, shared-storage tables, text blocks for numpy work."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborflow.session import keep, ship

__all__ = ["components", "keep", "mixed", "numbered", "ship", "table", "text_blocks"]

#: Characters a numpy block holds about; a longer document is a block of its own.
BLOCK_CHARS = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_blocks(frames: Iterator[pd.DataFrame], column: str, limit: int = BLOCK_CHARS) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into runs of rows of about `limit` characters, so that arrays stay small whatever a batch holds."""
    for frame in frames:
        sizes = np.array([len(t) if isinstance(t, str) else 0 for t in frame[column]], np.int64)
        if not len(sizes):
            continue
        block = (np.cumsum(sizes) - 1).clip(0) // limit
        for rows in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(block)) + 1):
            yield frame.iloc[rows]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit words (the finaliser of splitmix64): every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` with `place`, counted from 1 over the whole table in `order`; split by ranges, so no key is one task."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    held = keep(sorted_rows, name, "zstd")
    part = F.shiftright("at", 33)
    # one row per partition of the sort, so they travel to the rows and the rows stay
    sizes = held.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return held.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("at") - F.shiftleft(F.col("part"), 33) + 1).drop("part", "start", "at")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges (a long, b long): rows (id, component) for every id with an edge, component the smallest id.

    Alternating large-star and small-star steps: each round is two grouped minima, and the number of
    rounds grows with the logarithm of a component's diameter. Each round is cut by a table in shared storage.
    """
    now = keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    digest = None
    while True:
        # large star: every neighbour above v moves to the smallest of v and its neighbours
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, both.a == least.v).where("b > v").select(F.col("m").alias("a"), "b").distinct()
        # small star: v and its smaller neighbours move to the smallest of them
        low = large.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("m"))
        small = large.join(low, large.b == low.v).select(F.col("m").alias("x"), F.col("a").alias("y"))
        small = small.union(low.select("m", "v")).where("x <> y")
        now = keep(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), name)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == digest:
            break
        digest = seen
    tops = now.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
    return tops.union(now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
