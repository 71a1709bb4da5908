"""Hard negatives by exact inner-product search in STR-packed R-trees."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborflow.llm.common import keep, numbered

#: Rows of a leaf, children of an inner node.
LEAF, FAN = 128, 16
#: Rows of a tree: a share of the table between these two.
LEAST_TREE, MOST_TREE, SHARE = 4096, 1 << 16, 64
#: Requests that a task answers on one tree, and trees and requests whose roots one task compares.
REQUESTS, PAGE = 8192, 4096
#: Inner products below this are exact in doubles.
EXACT = 1 << 53


def integers(embedding: Column, dim: Column) -> Column:
    """floor(256 * c) of every entry, saturated so that an inner product of two such rows fits a long."""
    most = F.least(F.floor(F.sqrt(F.lit(float((1 << 63) - 1)) / F.greatest(dim, F.lit(1)))) - 1, F.lit(float((1 << 31) - 1)))
    return F.transform(embedding, lambda c: F.floor(F.least(F.greatest(c.cast("double") * 256, -most), most)).cast("int"))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b as longs."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def intervals(requests: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each request with any point of each box: every coordinate gives its own interval."""
    up, down = np.maximum(requests, 0), np.minimum(requests, 0)
    return inner(up, low) + inner(down, high), inner(up, high) + inner(down, low)


def packed(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Order of the rows by sort-tile-recursive packing: label first, then the coordinates that differ most; every LEAF rows are a leaf."""
    order = np.argsort(labels, kind="stable")
    by_spread = np.argsort(-x.std(axis=0), kind="stable")
    of_label = np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)
    return np.concatenate([_tiled(x, rows, by_spread[:3]) for rows in of_label])


def _tiled(x: np.ndarray, rows: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
    """Rows in slabs of the first coordinate, each slab tiled by the other ones."""
    if not len(coordinates) or len(rows) <= LEAF:
        return rows
    rows = rows[np.argsort(x[rows, coordinates[0]], kind="stable")]
    leaves = -(-len(rows) // LEAF)
    slabs = int(np.ceil(leaves ** (1 / len(coordinates))))
    size = LEAF * -(-leaves // slabs)
    return np.concatenate([_tiled(x, rows[a : a + size], coordinates[1:]) for a in range(0, len(rows), size)])


class Tree:
    """Boxes of an R-tree, level by level from the leaves; a box knows its labels' range and smallest id."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        order = packed(x, labels)
        self.keys, self.ids, self.labels, self.x = keys[order], ids[order], labels[order], x[order]
        self.levels, self.marks = [], []
        low = high = self.x
        first = last = self.labels
        least, step = self.ids, LEAF
        while not self.levels or len(low) > 1:
            at = np.arange(0, len(low), step)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            first, last, least = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at), np.minimum.reduceat(least, at)
            self.levels.append((low, high))
            self.marks.append((first.tolist(), last.tolist(), least.tolist()))
            step = FAN

    def search(self, x: np.ndarray, asked: list[tuple], top: int, same: bool) -> list[list[list[tuple]]]:
        """For each request its best `top` rows (negative score, id, key) of every window, best first.

        A request is (own key, label number, lows, highs, kth scores, kth ids): of each window rows with low <= score <= high
        that rank before its kth are wanted, of the own label or of any other. One queue a request holds
        boxes by the greatest score they may have. A box goes if no window can still use it: it lies outside, or strictly
        below the kth found so far, or level with it and without smaller ids.
        """
        bounds = [intervals(x, low, high) for low, high in self.levels]
        return [self._one(x[q], asked[q], [(a[q].tolist(), b[q].tolist()) for a, b in bounds], top, same) for q in range(len(asked))]

    def _one(self, x: np.ndarray, asked: tuple, bounds: list, top: int, same: bool) -> list[list[tuple]]:
        own, label, lows, highs, kth, kth_id = (v.tolist() if isinstance(v, np.ndarray) else v for v in asked)
        best: list[list[tuple]] = [[] for _ in lows]  # sorted lists of at most `top` (negative score, id, key)
        worst = [(-s, i) for s, i in zip(kth, kth_id, strict=True)]  # what a row must rank before

        def useful(level: int, k: int) -> bool:
            least_score, most_score = bounds[level][0][k], bounds[level][1][k]
            first, last, least_id = self.marks[level]
            if same and not first[k] <= label <= last[k] or not same and first[k] == last[k] == label:
                return False
            for w in range(len(lows)):
                if most_score >= lows[w] and least_score <= highs[w] and (-min(most_score, highs[w]), least_id[k]) < worst[w]:
                    return True
            return False

        root = len(self.levels) - 1
        queue = [(-bounds[root][1][k], root, k) for k in range(len(self.levels[root][0])) if useful(root, k)]
        heapq.heapify(queue)
        while queue:
            _, level, k = heapq.heappop(queue)
            if not useful(level, k):  # the kth has grown since it was put in
                continue
            if level:
                for child in range(k * FAN, min((k + 1) * FAN, len(self.levels[level - 1][0]))):
                    if useful(level - 1, child):
                        heapq.heappush(queue, (-bounds[level - 1][1][child], level - 1, child))
                continue
            rows = slice(k * LEAF, (k + 1) * LEAF)
            scores = inner(x[None, :], self.x[rows])[0]
            allowed = (self.labels[rows] == label) == same
            if same:
                allowed &= self.keys[rows] != own
            for w in range(len(lows)):
                fits = allowed & (scores >= lows[w]) & (scores <= highs[w]) & (scores >= -worst[w][0])
                some = np.flatnonzero(fits)
                if not len(some):
                    continue
                fresh = sorted(zip((-scores[some]).tolist(), self.ids[rows][some].tolist(), self.keys[rows][some].tolist(), strict=True))
                best[w] = sorted(best[w] + [r for r in fresh[:top] if r[:2] < worst[w]])[:top]
                if len(best[w]) == top:
                    worst[w] = min(worst[w], best[w][-1][:2])
        return best


def _answers(top: int, same: bool) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, rows: pd.DataFrame, requests: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(requests):
            names, labels = np.unique(np.concatenate([rows.label.to_numpy(), requests.label.to_numpy()]).astype(str), return_inverse=True)
            x = np.stack(rows.x.to_numpy())
            tree = Tree(rows.key.to_numpy(np.int64), rows.vec_id.to_numpy(np.int64), labels[: len(rows)], x)
            wanted = np.stack(requests.x.to_numpy())
            asked = list(zip(requests.own, labels[len(rows) :], requests.lows, requests.highs, requests.kth, requests.kth_id, strict=True))
            for first in range(0, len(asked), 256):
                found = tree.search(wanted[first : first + 256], asked[first : first + 256], top, same)
                for anchor, windows in zip(requests.anchor.to_numpy()[first:], found, strict=False):
                    out += [(anchor, w, -score, vec_id, at) for w, some in enumerate(windows) for score, vec_id, at in some]
        return pd.DataFrame(out, columns=["anchor", "window", "score", "vec_id", "key"])

    return run


def _routes(same: bool) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, roots: pd.DataFrame, requests: pd.DataFrame) -> pd.DataFrame:
        if not len(roots) or not len(requests):
            return pd.DataFrame({"anchor": [], "tree": [], "most": []})
        least, most = intervals(np.stack(requests.x.to_numpy()), np.stack(roots.low.to_numpy()), np.stack(roots.high.to_numpy()))
        names = requests.label.to_numpy().astype(str)[:, None]
        first, last = roots["first"].to_numpy().astype(str), roots["last"].to_numpy().astype(str)
        fits = (first <= names) & (names <= last) if same else ~((first == names) & (last == names))
        reached = np.zeros_like(fits)
        for w in range(len(requests.lows.iloc[0])):
            low, high = (np.array([v[w] for v in requests[c]])[:, None] for c in ("lows", "highs"))
            reached |= (most >= low) & (least <= high)
        q, t = np.nonzero(fits & reached)
        return pd.DataFrame({"anchor": requests.anchor.to_numpy()[q], "tree": roots.tree.to_numpy()[t], "most": most[q, t]})

    return run


def _dealt(rows: DataFrame, by: str, size: int) -> tuple[DataFrame, int]:
    """`rows` with a block number so that a block has about `size` rows."""
    blocks = max(1, -(-rows.count() // size))
    return rows.withColumn("block", F.pmod(F.xxhash64(by), F.lit(blocks)).cast("int")), blocks


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _visit(trees: DataFrame, requests: DataFrame, routes: DataFrame, top: int, same: bool) -> DataFrame:
    """Answers of every tree on the routes: a task holds one tree and a block of its requests."""
    blocks = routes.groupBy("tree").agg(F.ceil(F.count("*") / REQUESTS).cast("int").alias("blocks"))
    asked = requests.join(routes.join(blocks, "tree").select("anchor", "tree", F.pmod(F.xxhash64("anchor"), F.col("blocks")).cast("int").alias("block")), "anchor")
    rows = trees.join(blocks, "tree").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    some = rows.groupBy("tree", "block").cogroup(asked.groupBy("tree", "block"))
    return some.applyInPandas(_answers(top, same), "anchor long, window int, score long, vec_id long, key long")


def _search(trees: DataFrame, roots: DataFrame, requests: DataFrame, top: int, same: bool, name: str) -> DataFrame:
    """Rows (anchor, window, score, vec_id, key, rank) of the best `top` of every window of every request.

    The queue's first step is taken for all trees at once: the tree whose root may hold the greatest score is searched
    first, and what it finds keeps out the other trees that lie below.
    """
    asked, blocks = _dealt(requests, "anchor", PAGE)
    pages, n = _dealt(roots, "tree", PAGE)
    pages = pages.withColumnRenamed("block", "page").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    routes = pages.groupBy("page", "block").cogroup(asked.groupBy("page", "block")).applyInPandas(_routes(same), "anchor long, tree long, most long")
    routes = keep(routes, f"{name}_routes")
    home = routes.groupBy("anchor").agg(F.max_by("tree", F.struct("most", "tree")).alias("tree"))
    first = keep(_best(_visit(trees, requests, home, top, same), top), f"{name}_first")

    kth = first.where(F.col("rank") == top).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", F.struct("score", "vec_id")))).alias("found"))

    def reached(part: str, none: str) -> Column:
        return F.transform(none, lambda n, w: F.coalesce(F.try_element_at("found", w.cast("int"))[part], n))

    told = requests.join(kth, "anchor", "left").withColumns({"kth": reached("score", "kth"), "kth_id": reached("vec_id", "kth_id")}).drop("found")
    rest = routes.join(home, ["anchor", "tree"], "left_anti").join(told.select("anchor", F.array_min("kth").alias("least")), "anchor")
    rest = rest.where("most >= least").select("anchor", "tree")
    return _best(first.drop("rank").unionByName(_visit(trees, told, rest, top, same)), top)


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, top: int = 5, low: int = 80, high: int = 100,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` is a condition on the columns of `rows`. A component c counts as floor(256 * c); a score is the inner product
    with the anchor, higher first, ties by smaller id. Positives are an anchor's first other rows of its label, negatives the
    first rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score; with fewer, all.

    Rows without an id or label, with a null or empty vector or null or non-finite entries take no part, nor do vectors of
    another length than the most common one (the smaller on a tie). Components saturate where an inner product would
    not fit a long. Rows that repeat an id are rows each: anchors each, and positives of one another. An
    anchor or positive without partners has no rows; an empty table gives an empty result. Other columns are not looked at.

    The rows are packed by label and two coordinates into trees of bounded size, each one built in a task; anchors go to the
    trees whose root boxes reach their windows, in blocks.
    """
    spark = rows.sparkSession
    array = F.col(f"`{embedding}`").cast("array<double>")
    sound = (F.size(array) > 0) & F.forall(array, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = rows.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"), F.size(array).alias("dim"),
        integers(array, F.size(array)).alias("x"), anchors.alias("is_anchor"), sound.alias("sound"),
    )
    some = keep(some.where("sound and vec_id is not null and label is not null").drop("sound"), "integers")
    sizes = some.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if sizes is None:
        return spark.createDataFrame([], result)
    dim, n = sizes.dim, sizes.n
    some = some.where(F.col("dim") == dim).drop("dim")
    # two rounds of packing over the whole table: slabs of a label by one coordinate, trees of a slab by another
    spread = some.agg(F.array(*[F.var_pop(F.col("x")[k]) for k in range(dim)]).alias("v")).first().v
    first, second = [int(k) for k in np.argsort([-v for v in spread], kind="stable")[:2]] if dim > 1 else (0, 0)
    tree_rows = min(max(n // SHARE, LEAST_TREE), MOST_TREE)
    slab_rows = tree_rows * max(1, isqrt(-(-n // tree_rows)))
    tie = [F.xxhash64("vec_id", "x"), F.col("vec_id")]
    slabs = numbered(some, [F.col("label"), F.col("x")[first], *tie], "slabs")
    slabs = slabs.withColumn("slab", F.floor((F.col("place") - 1) / slab_rows)).drop("place")
    trees = numbered(slabs, [F.col("slab"), F.col("label"), F.col("x")[second], *tie], "packed")
    trees = keep(trees.select(F.col("place").alias("key"), F.floor((F.col("place") - 1) / tree_rows).alias("tree"), "vec_id", "label", "x", "is_anchor"), "trees")
    boxes = trees.groupBy("tree").agg(
        F.min("label").alias("first"), F.max("label").alias("last"),
        F.array(*[F.min(F.col("x")[k]) for k in range(dim)]).alias("low"), F.array(*[F.max(F.col("x")[k]) for k in range(dim)]).alias("high"),
    )
    roots, held = keep(boxes, "roots"), trees.select("tree", "key", "vec_id", "label", "x")
    whole, least = (1 << 63) - 1, -(1 << 62)

    def longs(value: Column) -> Column:
        return F.array(value.cast("long"))

    asked = trees.where("is_anchor").select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "x")
    asked = keep(asked, "anchors")
    none = F.lit(-(1 << 63) + 1)
    wanted = asked.select(
        "anchor", F.col("anchor").alias("own"), "label", "x", longs(F.lit(-whole)).alias("lows"), longs(F.lit(whole)).alias("highs"),
        longs(none).alias("kth"), longs(F.lit(whole)).alias("kth_id"),
    )
    near = keep(_search(held, roots, wanted, positives, True, "positives"), "positives")

    # windows of an anchor: one for each distinct positive score, as equal scores have equal negatives
    scores = near.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("scores"))  # at most `positives`
    bounded = scores.select("anchor", F.concat("scores", F.array_repeat(F.lit(None).cast("long"), F.lit(positives) - F.size("scores"))).alias("scores"))

    def edge(percent: int, up: bool) -> Callable[[Column], Column]:
        """percent / 100 of a score in integers, rounded up or down; an unused window is one that nothing fits."""
        def one(s: Column) -> Column:
            exact = s.cast("decimal(20,0)") * percent / 100
            return F.coalesce((F.ceil(exact) if up else F.floor(exact)).cast("long"), F.lit(whole if up else -whole))
        return one

    again = asked.join(bounded, "anchor").select(
        "anchor", F.col("anchor").alias("own"), "label", "x", F.transform("scores", edge(low, True)).alias("lows"), F.transform("scores", edge(high, False)).alias("highs"),
        F.transform("scores", lambda s: none.cast("long")).alias("kth"), F.transform("scores", lambda s: F.lit(whole).cast("long")).alias("kth_id"),
    )
    far = _search(held, roots, keep(again, "windows"), top, False, "negatives")
    windows = scores.select("anchor", F.posexplode("scores").alias("window", "positive_score"))
    pairs = near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(windows, ["anchor", "positive_score"])
    found = far.select("anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(found, ["anchor", "window"]).join(asked.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
