"""Approximate nearest neighbours in a hierarchical k-means tree (operator 6).

The top of the tree is fitted on a bounded sample and sent to all tasks; every row descends to a leaf of it. Leaves with too many
rows are split again by trees of their own, fitted in the tasks, level by level until leaves are small. A query opens leaves best
bin first: a priority queue holds the branches passed by, by their distance from the query, and from level to level a query keeps
the nearest branches of all that it has met. How many leaves a query opens is widened until a sample of queries, held against brute
force over the whole table, reaches the wanted recall.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, join_sized, partitions

#: Rows that a tree is fitted on, about; the children of a node; the rows of a group of a leaf, about; the leaves of one tree, at most.
SAMPLE, BRANCH, GROUP, FAN = 20_000, 8, 4096, 4095
#: The rows of a bucket of leaves, about, that a task compares queries with.
BUCKET = 20_000
#: A leaf of more rows than this is split; levels of trees below the top, at most; queries that calibrate; leaves opened at first.
LEAF, LEVELS, CALIBRATED, WIDTH = 256, 4, 200, 16


@dataclass
class Tree:
    """Node i has centroids[i] and its children's numbers (none: a leaf, numbered leaf[i])."""

    centroids: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest child at each node, ties to the first."""
        node = np.zeros(len(x), np.int64)
        todo = np.arange(len(x)) if len(self.children[0]) else np.zeros(0, np.int64)
        while len(todo):
            for n in np.unique(node[todo]):
                rows = todo[node[todo] == n]
                node[rows] = self.children[n][_distances(x[rows], self.centroids[self.children[n]]).argmin(axis=1)]
            todo = todo[[len(self.children[n]) > 0 for n in node[todo]]]
        return self.leaf[node]

    def open(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """Leaves, with the squared distance of their centres, in the order of a best-bin-first traversal."""
        queue = [(0.0, 0)]
        while queue:
            d, node = heapq.heappop(queue)
            if not len(self.children[node]):
                yield d, int(self.leaf[node])
                continue
            kids = self.children[node]
            for d, k in zip(_distances(q[None], self.centroids[kids])[0].tolist(), kids.tolist(), strict=True):
                heapq.heappush(queue, (d, k))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from the differences."""
    return np.sqrt(((x - q) ** 2).sum(axis=1))


def fit(sample: np.ndarray, leaf_rows: int, branch: int = BRANCH, rounds: int = 12, seed: int = 1) -> Tree:
    """Split the sample by k-means until a node has ``leaf_rows`` or fewer, or only equal rows."""
    rng = np.random.default_rng(seed)
    leaves = 1
    centroids, children, parts = [sample.mean(axis=0) if len(sample) else np.zeros(1)], [np.zeros(0, np.int64)], [sample]
    i = 0
    while i < len(parts):
        x = parts[i]
        if len(x) > leaf_rows and leaves + branch <= FAN and (x != x[0]).any():
            distinct = np.unique(x, axis=0)
            c = distinct[rng.choice(len(distinct), min(branch, len(distinct)), replace=False)]
            for _ in range(rounds):
                near = _distances(x, c).argmin(axis=1)
                c = np.stack([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
            near = _distances(x, c).argmin(axis=1)
            used = [k for k in range(len(c)) if (near == k).any()]
            if len(used) > 1:
                leaves += len(used) - 1
                children[i] = np.arange(len(parts), len(parts) + len(used))
                for k in used:
                    centroids.append(c[k])
                    children.append(np.zeros(0, np.int64))
                    parts.append(x[near == k])
        parts[i] = x[:0]
        i += 1
    ends = np.array([not len(c) for c in children])
    return Tree(np.stack(centroids), children, np.where(ends, np.cumsum(ends) - 1, -1))


def _valid(vector: Column) -> Column:
    """Not null or empty, all components finite, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def _first_copies(rows: DataFrame, most: int) -> DataFrame:
    """Of equal vectors the rows with the smallest ids: no more of them can be among a query's nearest."""
    order = Window.partitionBy(F.xxhash64("v"), F.col("v")).orderBy("vec_id")
    return rows.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= most).drop("copy")


def _dealt(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """rows with part: the group of their leaf that a hash of key deals them to."""
    return join_sized(rows, sizes, ["leaf"], "inner").withColumn("part", F.pmod(F.xxhash64(key), F.col("groups")).cast("int")).drop("n", "groups")


def _sizes(placed: DataFrame) -> DataFrame:
    return checkpoint(placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).withColumn("groups", F.ceil(F.col("n") / GROUP).cast("int")))


def _in_parts(trees: DataFrame) -> DataFrame:
    return trees.select("leaf", "tree", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))


def _bucket(buckets: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _split(placed: DataFrame, sizes: DataFrame, sample: int, leaf_rows: int) -> tuple[DataFrame, DataFrame]:
    """The trees of leaves with too many rows, and all rows with the leaves that these give: 4096 times the leaf, plus 1 and the tree's leaf if it was split."""

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"leaf": group["leaf"].iloc[:1], "tree": [pickle.dumps(fit(_matrix(group.sort_values("vec_id")["v"]), leaf_rows))]})

    big = sizes.where(F.col("n") > LEAF)
    # sampled evenly, so that a tree's own leaves hold about LEAF rows of all
    near = join_sized(placed, big, ["leaf"], "inner").where(F.pmod(F.xxhash64(F.lit("split"), "vec_id"), F.lit(1 << 20)) < F.least(F.lit(1.0), sample / F.col("n")) * (1 << 20))
    trees = near.select("leaf", "vec_id", "v").groupBy("leaf").applyInPandas(fitted, "leaf long, tree binary")
    trees = checkpoint(trees.join(big.select("leaf", "groups"), "leaf"))

    def descend(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        below = pickle.loads(tree["tree"].iloc[0]).place(_matrix(rows["v"])) + 1 if len(tree) and len(rows) else 0
        return rows[["vec_id", "v"]].assign(leaf=rows["leaf"] * (FAN + 1) + below)

    deep = _dealt(placed, big, "vec_id").groupBy("leaf", "part").cogroup(_in_parts(trees).groupBy("leaf", "part")).applyInPandas(descend, "vec_id long, v array<double>, leaf long")
    small = join_sized(placed, big.select("leaf"), ["leaf"], "left_anti").select("vec_id", "v", (F.col("leaf") * (FAN + 1)).alias("leaf"))
    return trees, checkpoint(deep.unionByName(small))


def _routes(asked: DataFrame, top: Tree, levels: list[DataFrame], width: int) -> DataFrame:
    """(query_id, leaves): for each row of asked (query_id, q) the nearest ``width`` leaves met, in order, as structs of distance and leaf.

    From level to level queries and leaves travel without their vectors; a query's vector goes once to each bucket of trees that it opens.
    """
    sent = asked.sparkSession.sparkContext.broadcast(top)
    n = partitions(asked.sparkSession)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[{"d": d, "leaf": leaf} for (d, leaf), _ in zip(sent.value.open(np.asarray(q, np.float64)), range(width), strict=False)] for q in b["q"]]
            yield pd.DataFrame({"query_id": b["query_id"], "leaves": found})

    def deeper(asked: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        known = {leaf: pickle.loads(tree) for leaf, tree in zip(trees["leaf"], trees["tree"], strict=True)}
        out: list[tuple] = []
        for query_id, q, at in asked[["query_id", "q", "at"]].itertuples(index=False):
            q, found = np.asarray(q, np.float64), []
            for x in at:
                if x["leaf"] in known:
                    found += [(d, x["leaf"] * (FAN + 1) + k + 1) for (d, k), _ in zip(known[x["leaf"]].open(q), range(width), strict=False)]
                else:
                    found.append((x["d"], x["leaf"] * (FAN + 1)))
            out += [(query_id, d, leaf) for d, leaf in sorted(found)[:width]]
        return pd.DataFrame(out, columns=["query_id", "d", "leaf"])

    routed = asked.mapInPandas(plan, "query_id long, leaves array<struct<d: double, leaf: long>>")
    for trees in levels:
        opened = routed.select("query_id", F.explode("leaves").alias("at")).groupBy("query_id", _bucket(n, "at.leaf").alias("bucket")).agg(F.collect_list("at").alias("at"))
        opened = opened.join(asked, "query_id").groupBy("bucket")
        met = opened.cogroup(trees.select("leaf", "tree", _bucket(n, "leaf").alias("bucket")).groupBy("bucket")).applyInPandas(deeper, "query_id long, d double, leaf long")
        routed = met.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "leaf"))), 1, width).alias("leaves"))
    return routed


def _nearest(rows: DataFrame, asked: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """(query_id, vec_id): the k nearest of all rows for a bounded number of queries, by brute force in blocks."""
    sent = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, x = b["vec_id"].to_numpy(), _matrix(b["v"])
            for query_id, q in sent.value:
                d = np.where(ids == query_id, np.inf, _exact(np.asarray(q), x) if len(x) else np.zeros(0))
                best = np.lexsort((ids, d))[:k]
                best = best[np.isfinite(d[best])]
                yield pd.DataFrame({"query_id": query_id, "vec_id": ids[best], "score": d[best]})

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return rows.mapInPandas(run, "query_id long, vec_id long, score double").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrate(placed: DataFrame, top: Tree, levels: list[DataFrame], k: int, recall: float, queries: int = CALIBRATED) -> int:
    """How many leaves to open so that this share of the k nearest of a sample of rows, among all rows, lies in them."""
    spark = placed.sparkSession
    chosen = placed.orderBy(F.xxhash64(F.lit("calibrate"), "vec_id"), "vec_id").select("vec_id", "v").limit(queries).collect()
    if not chosen:
        return 1
    asked = [(r["vec_id"], r["v"]) for r in chosen]
    true = _nearest(placed.select("vec_id", "v"), asked, k).select("query_id", "vec_id")
    true = checkpoint(join_sized(placed.select("vec_id", "leaf"), checkpoint(true), ["vec_id"], "inner").select("query_id", "leaf"))
    width = WIDTH
    while True:
        routes = _routes(spark.createDataFrame(asked, "query_id long, q array<double>"), top, levels, width)
        place = F.array_position(F.transform("leaves", lambda x: x.leaf), F.col("leaf"))
        ranks = sorted(r[0] or width * 2 for r in true.join(routes, "query_id").select(place).collect())
        if not ranks:
            return 1
        needed = ranks[max(0, int(np.ceil(recall * len(ranks))) - 1)]
        if needed <= width:
            return needed
        width *= 2


def search(rows: DataFrame, query: Column, k: int = 10, recall: float = 0.95, sample: int = SAMPLE, leaf_rows: int = 64, calibrated: int = CALIBRATED) -> DataFrame:
    """For each row for which ``query`` holds, its k nearest other rows found: query_id, rank, vec_id, score.

    rows has vec_id and embedding. Vectors that are null, empty, zero, of another length than most or hold a null or
    non-finite component take no part, neither do rows with a null vec_id. Nearness is the Euclidean distance in double precision;
    ties go to the smaller vec_id. Rows of one vec_id are candidates each, but not for the query of their own id,
    and such queries are one. Samples are what a hash of vec_id puts first. An empty table gives an empty result.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & _valid(F.col("v")))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (size["n"] if size else 0))
    n = size["count"] if size else 0
    picked = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 20)) < int(min(1.0, sample / max(n, 1)) * (1 << 20)))
    top = fit(_matrix([r["v"] for r in picked.select("v", "vec_id").orderBy("vec_id").limit(2 * sample).toLocalIterator()]), leaf_rows)
    sent = rows.sparkSession.sparkContext.broadcast(top)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaf=sent.value.place(_matrix(b["v"])) if len(b) else np.zeros(0, np.int64))

    placed = checkpoint(_first_copies(rows, k + 1).mapInPandas(index, "vec_id long, v array<double>, leaf long"))
    sizes = _sizes(placed)
    levels: list[DataFrame] = []
    while len(levels) < LEVELS and sizes.where(F.col("n") > LEAF).limit(1).count():
        trees, placed = _split(placed, sizes, sample, leaf_rows)
        levels.append(trees)
        sizes = _sizes(placed)
    opened = calibrate(placed, top, levels, k, recall, calibrated)
    buckets = max(partitions(rows.sparkSession), -(-n // BUCKET))
    candidates = _dealt(placed, sizes, "vec_id").withColumn("bucket", _bucket(buckets, "leaf", "part"))
    asked = checkpoint(rows.where(query).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")))
    # as every leaf has a row, so many more leaves have k other rows, if there are any
    routes = _routes(asked, top, levels, opened + k + 1).select("query_id", F.posexplode("leaves.leaf").alias("pos", "leaf"))
    before = F.sum("n").over(Window.partitionBy("query_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    routes = join_sized(routes, sizes, ["leaf"], "inner").withColumn("before", F.coalesce(before, F.lit(0))).where((F.col("pos") < opened) | (F.col("before") <= k))
    routes = routes.select("query_id", "leaf", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    routes = routes.groupBy("query_id", _bucket(buckets, "leaf", "part").alias("bucket")).agg(F.collect_set("leaf").alias("leaves")).join(asked, "query_id")

    def compare(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(found):
            found = found.sort_values(["leaf", "vec_id"], kind="stable")
            leaf, ids, x = found["leaf"].to_numpy(), found["vec_id"].to_numpy(), _matrix(found["v"])
            for query_id, q, leaves in zip(asked["query_id"], asked["q"], asked["leaves"], strict=True):
                low, high = np.searchsorted(leaf, np.asarray(leaves)), np.searchsorted(leaf, np.asarray(leaves), side="right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)])
                at = at[ids[at] != query_id]
                d = _exact(np.asarray(q, np.float64), x[at])
                best = np.lexsort((ids[at], d))[:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[at[best]], "score": d[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    near = routes.groupBy("bucket").cogroup(candidates.groupBy("bucket")).applyInPandas(compare, "query_id long, vec_id long, score double")
    best = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best"))
    best = best.select("query_id", F.posexplode("best").alias("pos", "hit"))
    return best.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
