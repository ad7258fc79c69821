"""Oversampling of a minority class between near neighbours."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.operators.order_stats import values_at_ranks
from lossgrid.operators.splits import hash_order
from lossgrid.session import materialise

#: Points of a leaf, parts of a cut, and the leaves beyond which leaves grow instead: the tree is sent to every task.
LEAF_ROWS, WAYS, MAX_LEAVES = 1024, 8, 1 << 16
BLOCK_ROWS = 4096
NEIGHBOURS = "array<struct<distance:double,id:string>>"


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.sqrt(sum((left[:, f, None] - right[None, :, f]) ** 2 for f in range(left.shape[1])))


class BoxTree:
    """A partition of space into leaves of about ``LEAF_ROWS`` points, each node with the box around its points.

    Nodes are numbered level by level. A node with too many points is cut into up to ``WAYS`` parts along its longest side at
    approximate percentiles, or in the middle where these do not cut. So the leaves grow in number with the points; past
    ``MAX_LEAVES`` they grow in size, which bounds what every task is sent.
    """

    def __init__(self, dims: int) -> None:
        self.low, self.high = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)
        self.side, self.cuts = np.zeros(1, np.int64), np.full((1, WAYS - 1), np.inf)
        self.first, self.parts = np.full(1, -1), np.zeros(1, np.int64)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The deepest node of each point."""
        node = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.first[node] >= 0)
        while len(moving):
            at = node[moving]
            values = x[moving, self.side[at]]
            node[moving] = self.first[at] + (values[:, None] >= self.cuts[at]).sum(axis=1)
            moving = moving[self.first[node[moving]] >= 0]
        return node

    def split(self, node: int, side: int, cuts: list[float]) -> None:
        self.side[node], self.first[node], self.parts[node] = side, len(self.low), len(cuts) + 1
        self.cuts[node, : len(cuts)] = cuts
        more = len(cuts) + 1
        dims = self.low.shape[1]
        self.low, self.high = np.vstack([self.low, np.full((more, dims), np.inf)]), np.vstack([self.high, np.full((more, dims), -np.inf)])
        self.side, self.cuts = np.append(self.side, np.zeros(more, np.int64)), np.vstack([self.cuts, np.full((more, WAYS - 1), np.inf)])
        self.first, self.parts = np.append(self.first, np.full(more, -1)), np.append(self.parts, np.zeros(more, np.int64))

    def within(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) pairs of all leaves whose box comes within the reach of a point."""
        point, node, found = np.arange(len(x)), np.zeros(len(x), np.int64), []
        while len(point):
            gap = np.maximum(np.maximum(self.low[node] - x[point], x[point] - self.high[node]), 0)
            near = np.sqrt((gap * gap).sum(axis=1)) <= reach[point]
            point, node = point[near], node[near]
            leaf = self.first[node] < 0
            found.append((point[leaf], node[leaf]))
            point, node = point[~leaf], node[~leaf]
            parts = self.parts[node]
            offset = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            point, node = np.repeat(point, parts), np.repeat(self.first[node], parts) + offset
        return np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]), np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])


def _placed(points: DataFrame, features: list[str], tree: BoxTree) -> DataFrame:
    @F.pandas_udf("int")
    def place(vectors: pd.Series) -> pd.Series:
        return pd.Series(tree.place(np.stack(vectors.to_numpy())))

    return points.withColumn("_cell", place(F.array(*[F.col(c).cast("double") for c in features])))


def box_tree(points: DataFrame, features: list[str], rows: int) -> BoxTree:
    """The tree over all points: one aggregation over them per level, a row per node of the level."""
    tree, leaf_rows, new = BoxTree(len(features)), max(LEAF_ROWS, -(-rows // MAX_LEAVES)), {0}
    steps = F.array(*[F.lit(i / WAYS) for i in range(1, WAYS)])
    while new:
        sides = [[F.min(c).alias(f"_low{i}"), F.max(c).alias(f"_high{i}"), F.percentile_approx(F.col(c).cast("double"), steps, F.lit(1000)).alias(f"_cut{i}")] for i, c in enumerate(features)]
        known = len(tree.low)
        level = _placed(points, features, tree).where(F.col("_cell") >= min(new)).groupBy("_cell").agg(F.count("*").alias("_rows"), *[c for side in sides for c in side]).orderBy("_cell")
        for row in level.collect():  # one row per new node
            node = row["_cell"]
            tree.low[node] = [row[f"_low{i}"] for i in range(len(features))]
            tree.high[node] = [row[f"_high{i}"] for i in range(len(features))]
            spread = tree.high[node] - tree.low[node]
            side = int(spread.argmax())
            if row["_rows"] > leaf_rows and spread[side] > 0:
                cuts = sorted({c for c in row[f"_cut{side}"] if c > tree.low[node, side]}) or [float(tree.low[node, side] + spread[side] / 2)]
                if cuts[0] > tree.low[node, side]:  # no number may lie between the two ends
                    tree.split(node, side, cuts)
        new = set(range(known, len(tree.low)))
    return tree


def _block_neighbours(features: list[str], k: int):
    """Nearest k members of one block for every point visiting it; a point is the only one at distance zero to itself."""

    def run(visitors: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("_id")
        x, y = visitors[features].to_numpy(float), members[features].to_numpy(float)
        ids, near = members["_id"].to_numpy(), []
        for start in range(0, len(x), 512):
            distance = _distances(x[start : start + 512], y)
            distance[distance == 0] = np.inf
            order = np.argsort(distance, axis=1, kind="stable")[:, :k]
            for row, best in zip(distance, order):
                near.append([{"distance": float(row[j]), "id": ids[j]} for j in best if np.isfinite(row[j])])
        return pd.DataFrame({"_id": visitors["_id"].to_numpy(), "near": near})

    return run


def _merge_nearest(df: DataFrame, k: int) -> DataFrame:
    """The k nearest over all blocks a point has visited; a block sends k entries at most."""
    every = F.array_sort(F.flatten(F.collect_list("near")))
    return df.groupBy("_id").agg(F.slice(every, 1, k).alias("near"))


def _visit(visits: DataFrame, members: DataFrame, blocks: DataFrame, features: list[str], k: int) -> DataFrame:
    """Nearest members of every (point, cell) visit.

    A cell is cut into member blocks, and the visitors of a block into parts, so neither a popular cell nor a crowd of
    visitors meets in one task.
    """
    keyed = visits.join(blocks, "_cell").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    keyed = keyed.withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int"))
    housed = members.join(blocks, "_cell").withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int"))
    housed = housed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    keys, shown = ["_cell", "_block", "_part"], ["_id", *features]
    # both sides may stem from the same points: fresh names keep their columns apart
    left, right = (df.select(*[F.col(c).alias(c) for c in [*keys, *shown]]).groupBy(*keys) for df in (keyed, housed))
    return left.cogroup(right).applyInPandas(_block_neighbours(features, k), f"_id string, near {NEIGHBOURS}")


def _blocks(visits: DataFrame, members: DataFrame) -> DataFrame:
    """Member blocks and visitor parts per cell, from their counts."""
    inside = members.groupBy("_cell").agg(F.count("*").alias("m"))
    coming = visits.groupBy("_cell").agg(F.count("*").alias("v"))
    return inside.join(coming, "_cell").select(
        "_cell", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("_blocks"), F.ceil(F.col("v") / (4 * BLOCK_ROWS)).cast("int").alias("_parts")
    )


def nearest_neighbours(points: DataFrame, features: list[str], k: int, seed: int = 0) -> DataFrame:
    """Exact k nearest other points of distinct points (_id, features): rows (_id, near).

    First every point asks its own leaf of a tree of boxes. The k-th distance found bounds the search: of the other leaves
    it visits those whose box comes that close, found by descending the tree. With leaves of bounded size, what a
    point costs does not grow with the number of points.
    """
    placed, tree = _housed(points, features)
    own = placed.select("_id", *features, "_cell")
    first = materialise(_merge_nearest(_visit(own, own, _blocks(own, own), features, k), k))
    visits = _visits(placed, first, features, k, tree)
    rest = _visit(visits, own, _blocks(visits, own), features, k)
    return _merge_nearest(first.unionByName(rest), k)


def _housed(points: DataFrame, features: list[str]) -> tuple[DataFrame, BoxTree]:
    tree = box_tree(points, features, points.count())
    return materialise(_placed(points, features, tree)), tree


def _visits(placed: DataFrame, first: DataFrame, features: list[str], k: int, tree: BoxTree) -> DataFrame:
    """(_id, features, _cell) of every leaf besides its own that may hold a point nearer than the k-th found."""
    bound = F.when(F.size("near") == k, F.element_at("near", -1)["distance"])
    searching = placed.join(first, "_id", "left").select("_id", *features, "_cell", F.coalesce(bound, F.lit(float("inf"))).alias("_bound"))

    @F.pandas_udf("array<int>")
    def reached(vectors: pd.Series, bounds: pd.Series, cells: pd.Series) -> pd.Series:
        # a hair of slack keeps members whose distance equals the bound up to rounding
        point, leaf = tree.within(np.stack(vectors.to_numpy()), bounds.to_numpy(float) * (1 + 1e-9) + 1e-12)
        other = leaf != cells.to_numpy()[point]
        point, leaf = point[other], leaf[other]
        order = np.argsort(point, kind="stable")
        return pd.Series(np.split(leaf[order], np.cumsum(np.bincount(point, minlength=len(vectors)))[:-1]))

    leaves = reached(F.array(*[F.col(c).cast("double") for c in features]), "_bound", "_cell")
    return searching.select("_id", *features, F.explode(leaves).alias("_cell"))


def smote(df: DataFrame, features: list[str], label: str, minority, keys: list[str], k: int = 5, seed: int = 0) -> DataFrame:
    """Synthetic minority rows until both classes are equally large: (features, label).

    Row i of the extra rows starts at a minority row, picks one of its k nearest neighbours and lies at a random point between.
    Copies of a point count as neighbours at distance zero. All choices are hashes of the row's keys, so a replay gives the same rows.
    """
    numbers = [F.col(c).cast("double") for c in features]
    unknown = reduce(lambda a, b: a | b, [x.isNull() | F.isnan(x) for x in numbers])
    few_rows = F.col(label) == minority
    sizes = df.agg(F.count_if(few_rows).alias("few"), F.count_if(~few_rows).alias("many"), F.count_if(few_rows & unknown).alias("unknown")).first()
    if sizes["unknown"]:
        raise ValueError(f"{sizes['unknown']} minority rows have a missing feature: impute first")
    missing = sizes["many"] - sizes["few"]
    if sizes["few"] <= k:
        raise ValueError(f"{k} neighbours need more than {k} minority rows")
    few = df.where(F.col(label) == minority).select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    # equal points become one point with a weight, so a crowd of copies is one row of the search
    few = few.withColumn("_id", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in features])))
    points = materialise(few.groupBy("_id", *features).agg(F.count("*").alias("copies")))
    near = nearest_neighbours(points.select("_id", *features), features, k, seed)
    choices = _choices(points, near, k)
    target = points.select(F.col("_id").alias("_near"), *[F.col(c).alias(f"_to_{c}") for c in features])

    def draw(salt: str) -> Column:
        place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}{salt}"), *[F.col(c).cast("string") for c in [*keys, "_copy"]])), 1, 13), 16, 10)
        return place.cast("double") / float(16**13)

    whole, left_over = divmod(max(missing, 0), sizes["few"])
    ranked = few.withColumn("_hash", hash_order(keys, seed))
    cut = _hash_cut(ranked, left_over)
    extra = F.when(F.col("_hash") <= F.lit(cut), whole + 1).otherwise(whole) if cut else F.lit(whole)
    starts = ranked.withColumn("_extra", extra).where("_extra > 0")
    starts = starts.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_extra").cast("int"))))
    picked = F.element_at("_choices", F.floor(draw("pick") * k).cast("int") + 1)
    chosen = starts.join(choices, "_id").withColumns({"_near": picked, "_gap": draw("gap")})
    joined = chosen.join(target, "_near")
    values = [(F.col(c) + (F.col(f"_to_{c}") - F.col(c)) * F.col("_gap")).alias(c) for c in features]
    return joined.select(*values, F.lit(minority).alias(label))


def _choices(points: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of each point as point ids: its other copies first, then its neighbours with their copies."""
    listed = near.select("_id", F.posexplode("near").alias("_rank", "_n")).select("_id", "_rank", F.col("_n.id").alias("_other"))
    weights = points.select(F.col("_id").alias("_other"), F.least("copies", F.lit(k)).cast("int").alias("_times"))
    weighted = listed.join(weights, "_other").groupBy("_id").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_other", "_times"))).alias("_list")
    )  # at most k entries per point
    own = F.array_repeat("_id", F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("_list", lambda n: F.array_repeat(n["_other"], n["_times"])))
    all_rows = F.concat(own, F.coalesce(others, F.array().cast("array<string>")))
    return points.join(weighted, "_id", "left").select("_id", F.slice(all_rows, 1, k).alias("_choices"))


def _hash_cut(ranked: DataFrame, count: int) -> str | None:
    """Largest hash among the first ``count`` rows in hash order."""
    if count <= 0:
        return None
    return values_at_ranks(ranked.select("_hash"), "_hash", [count - 1]).first()["_hash"]
