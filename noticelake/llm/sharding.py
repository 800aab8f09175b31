"""Sharding by a hierarchical weighted hash tree (operator 9), Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A region is (weight, racks), a rack (weight, shards), a shard (weight, id).
Tree = list[tuple[float, list[tuple[float, list[tuple[float, int]]]]]]


def hash_tree(regions: int = 3, racks: int = 2, shards: int = 4, grown: int = 0) -> Tree:
    """A regular tree of unit-weight shards; every grown shard stands in a new region of weight 1.

    A node weighs what its shards weigh. A new region leaves all other weights as they are, so rows move
    only into it: the subtrees whose weights do not change keep every row that the new one does not draw.
    """
    tree: Tree = []
    n = 0
    for _ in range(regions):
        region = []
        for _ in range(racks):
            region.append((float(shards), [(1.0, n + i) for i in range(shards)]))
            n += shards
        tree.append((float(racks * shards), region))
    return tree + [(1.0, [(1.0, [(1.0, n + i)])]) for i in range(grown)]


def _draw(key: Column, node: str, weight: float, seed: str) -> Column:
    """Exponential arrival time of a node: the earliest child wins with a chance in proportion to its weight."""
    bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws("|", F.lit(seed), F.lit(node), key)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _pick(key: Column, path: str, weights: list[float], seed: str) -> Column:
    """Index of the child with the earliest draw."""
    if len(weights) == 1:
        return F.lit(0)
    return F.array_min(F.array(*[F.struct(_draw(key, f"{path}/{i}", w, seed).alias("d"), F.lit(i).alias("i")) for i, w in enumerate(weights)]))["i"]


def _branch(index: Column, results: list[Column]) -> Column:
    out = results[-1]
    for i in range(len(results) - 2, -1, -1):
        out = F.when(index == i, results[i]).otherwise(out)
    return out


def tree_shard(key: Column, tree: Tree, seed: str = "shards-1") -> Column:
    """Descend region, rack and shard; draws hang on key, node path and weight alone. A null key is the text ``\\0``."""
    key = F.coalesce(key.cast("string"), F.lit("\0"))

    def rack(path: str, shards) -> Column:
        return _branch(_pick(key, path, [w for w, _ in shards], seed), [F.lit(s) for _, s in shards])

    def region(path: str, racks) -> Column:
        return _branch(_pick(key, path, [w for w, _ in racks], seed), [rack(f"{path}/{i}", s) for i, (_, s) in enumerate(racks)])

    return _branch(_pick(key, "", [w for w, _ in tree], seed), [region(f"/{i}", r) for i, (_, r) in enumerate(tree)]).cast("int")


def with_slots(df: DataFrame, shard: str, key: str, order: list[str], buckets: int = 256) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard, with no shard gathered in one task.

    A shard is cut into hash buckets of its keys; a bucket starts where the counts of those before it end.
    The table of starts has at most shards x buckets rows, which bounds its broadcast. Equal rows take
    neighbouring slots in any order.
    """
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(buckets)).cast("int"))
    counts = df.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(shard, "_bucket").orderBy(key, *order)
    ranked = df.withColumn("_rank", F.row_number().over(within))
    return ranked.join(F.broadcast(starts), [shard, "_bucket"]).withColumn("slot", F.col("_start") + F.col("_rank") - 1).drop("_bucket", "_start", "_rank")


def shard_documents(docs: DataFrame, tree: Tree | None = None, grown: Tree | None = None, buckets: int = 256) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A null text has no bytes (size 8, checksum 0); rows with a null doc_id share one key and so one shard;
    repeated rows stay rows, in the same shard, each with its own slot; an empty table gives an empty
    result; other columns of docs are not read.
    """
    tree, grown = tree or hash_tree(), grown or hash_tree(grown=1)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.col("doc_id")
    rows = docs.select(
        key.cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        tree_shard(key, tree).alias("shard"),
        tree_shard(key, grown).alias("grown_shard"),
    )
    return with_slots(rows, "shard", "doc_id", ["text_crc32", "size"], buckets).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
