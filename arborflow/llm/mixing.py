"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.common import keep, numbered

#: Random offsets tried for each source; the one whose mix is nearest the target is taken.
OFFSETS = 32


def words(text: Column) -> Column:
    """Runs of characters other than \\x20 and \\x09-\\x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """`sources` (source, source_size, first) with `target` and `ratio` = target / source_size.

    Weights repeat over the sources by code point, null last. All sizes together are shared by weight; a source takes
    at most `most` times its size, and what that leaves is shared again by weight among the others. In order of
    size/weight the capped sources come first, and the level of the others follows from sums over that order: no
    iteration. Works on one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    rows = rows.withColumn("turn", F.col("limit") / F.col("weight"))
    order = Window.orderBy("turn", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    whole = Window.partitionBy()
    # the level rises while capped sources are set aside and falls beyond: its maximum is where the others share
    rows = rows.withColumn("level", (F.sum("source_size").over(whole) - before) / after)
    rows = rows.withColumn("target", F.least("limit", F.max("level").over(whole) * F.col("weight")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return rows.select("source", "source_size", "first", "target", ratio.alias("ratio"))


def offset(source: Column, seed: int, k: int) -> Column:
    """A random number in [0, 1) fixed by source, seed and k: 32 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:{k}:"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: tuple[str, ...] = (),
) -> DataFrame:
    """Copies of each document in a mix that meets the sources' target weights.

    Returns per row of `docs`: doc_id, the columns of `carry`, source, size (words), source_size, target (its source's
    words in the mix) and copies. Every document of a source is expected target / source_size times. Documents are laid
    out by size within the source, their expectations are prefix-summed, one random offset is added, and a document is
    taken once for each integer crossed: neighbours in size replace each other, so the words taken stay near the target
    within the size of one document, and no document is taken more than ceil(expected) times. Reruns agree.

    Null texts have size 0; null sources are one source, which sorts last. Ties of size are laid out by doc_id, then
    text hash; rows that repeat are separate documents. An empty table gives an empty result. Other columns are dropped
    unless carried.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), words(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.col(f"`{text}`")).alias("tie"), *(F.col(f"`{c}`").alias(f"carried_{c}") for c in carry),
    )
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("doc_id").asc(), F.col("tie").asc()]
    placed = numbered(rows, order, "mix")
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("place").alias("first"))
    aims = targets(sources, weights, most)
    aims = keep(aims, "targets")
    nth = F.col("place") - F.col("first")
    each = placed.alias("d").join(aims.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")

    def copies(k: int) -> Column:
        start = offset(F.col("source"), seed, k)
        return (F.floor((nth + 1) * F.col("ratio") + start) - F.floor(nth * F.col("ratio") + start)).cast("long")

    sums = each.groupBy("source").agg(*(F.sum(F.col("size") * copies(k)).alias(f"t{k}") for k in range(OFFSETS)))
    misses = F.array(*(F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("miss"), F.lit(k).alias("k")) for k in range(OFFSETS)))
    best = sums.join(aims.select(F.col("source").alias("name"), "target"), F.col("source").eqNullSafe(F.col("name")))
    best = keep(best.select(F.col("source").alias("name"), F.array_min(misses)["k"].alias("k")), "offsets")
    out = each.join(best, F.col("source").eqNullSafe(F.col("name")))
    start = F.element_at(F.array(*(offset(F.col("source"), seed, k) for k in range(OFFSETS))), F.col("k") + 1)
    out = out.withColumn("u", start)
    taken = (F.floor((nth + 1) * F.col("ratio") + F.col("u")) - F.floor(nth * F.col("ratio") + F.col("u"))).cast("long")
    return out.select("doc_id", *(F.col(f"carried_{c}").alias(c) for c in carry), "source", "size", "source_size", "target", taken.alias("copies"))
