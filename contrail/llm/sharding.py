"""Hierarchical weighted hash tree: rows go to shards by draws at region, rack and shard level.

At each level a child's draw is -ln(u) / weight for a uniform hash u of (key, child); the smallest draw wins,
so children get keys in proportion to their weights and a changed weight moves keys only between that child
and its siblings. A further shard is a region of its own: at the top level only its draw is new, so keys move
into it or stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import written


@dataclass(frozen=True)
class Node:
    """A shard if it has no children. name: unique in the tree; it salts the draws."""

    name: str
    weight: float
    shard: int = -1
    children: tuple[Node, ...] = ()


def topology(shards: int, base: int = 24, racks: int = 2, per_rack: int = 4) -> Node:
    """base shards in regions of `racks` racks of `per_rack` shards, each weighing the shards below it;
    every shard beyond base is a region of its own, so each such shard takes keys only into itself."""
    regions, shard = [], 0
    while shard < min(shards, base):
        inner = []
        for k in range(racks):
            leaves = tuple(Node(f"shard{x}", 1.0, x) for x in range(shard, min(shard + per_rack, shards, base)))
            if leaves:
                inner.append(Node(f"rack{len(regions)}.{k}", float(len(leaves)), children=leaves))
                shard += len(leaves)
        regions.append(Node(f"region{len(regions)}", sum(x.weight for x in inner), children=tuple(inner)))
    for x in range(base, shards):
        leaf = Node(f"shard{x}", 1.0, x)
        regions.append(Node(f"own{x}", 1.0, children=(Node(f"rack.own{x}", 1.0, children=(leaf,)),)))
    return Node("all", float(shards), children=tuple(regions))


def draw(key: Column, child: Node) -> Column:
    """-ln(u) / weight; u in (0, 1) from 52 bits of the key's hash with the child's name."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(child.weight)


def descend(key: Column, node: Node) -> Column:
    """The shard that key's draws lead to; branches not taken are not evaluated."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return descend(key, node.children[0])
    best = F.array_min(F.array(*[F.struct(draw(key, x).alias("d"), F.lit(k).alias("k")) for k, x in enumerate(node.children)]))["k"]
    if not any(x.children for x in node.children):
        return F.element_at(F.array(*[F.lit(x.shard) for x in node.children]), best + 1)
    return reduce(lambda out, k: out.when(best == k, descend(key, node.children[k])), range(len(node.children)), F).cast("int")


def assign(docs: DataFrame, shards: int = 24, base: int = 24, spread: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard
    (with one shard more).

    The id and the shard count alone decide the shard, so repeated ids and all null ids share one. Null and empty
    texts have 8 bytes and crc32 0; long ones count in full; equal rows get a slot each; no rows, no rows. Other columns are not read. Slots: rows are dealt over `spread` parts of
    each shard by a hash, those of equal ids too, numbered within a part, and moved by the rows of the parts before;
    so no task numbers a whole shard.
    """
    key = F.col("doc_id")
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        descend(key, topology(shards, base)).alias("shard"),
        descend(key, topology(shards + 1, base)).alias("grown_shard"),
        F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.lit(spread)).cast("int").alias("part"),
    )
    rows = written(rows, "shards")  # the parts are read twice and must be the same both times
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))  # shards * spread rows at most
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("n", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), (F.col("first") + F.col("n")).alias("slot"), F.col("grown_shard").cast("int")
    )
