"""Merkle dataset manifest: cogrouped subtree exchange.

Every row is a leaf; leaves of a group (``lang``) ascend by id, and the nodes of
a level are hashed in twos (the last alone if their number is odd) until one is
left, the group's subroot. The subroots, ordered by group, give the root in the
same way. Each row gets the siblings on its way to the root (its proof) and the
root that its leaf, perhaps tampered with, folds to.

1. Leaves are native SHA-256 columns, staged thin: no text moves after that.
2. Ranks: a range shuffle by (group, id) sorts the leaves; a rank is the offset of
   (partition, group) plus the place in the partition. A group with most of the
   rows is spread over many partitions.
3. Up: ``2^height`` leaves of a group are a *superblock*. ``applyInPandas``
   reduces each to one node, and nodes of superblocks likewise, tier by tier, until
   every group has one node; the groups' subroots then do the same.
4. Down: a tier's nodes are cogrouped by superblock with the one row that holds the
   siblings above that superblock. The function reduces the superblock again, joins
   local siblings and outer ones to whole proofs and, at the leaves, folds them.

No task holds more than a superblock, whatever a group's size; tiers shrink by
``2^height`` each, so there are two or three of them for any table.

Defined cases: null fields hash as ``-``; a null id sorts first and is never tampered
with; a null group is a group of its own and comes first; rows with equal ids
stand in the order of their leaves, and equal rows share one leaf value and take
neighbouring places; a lone leaf is its group's subroot, a lone group's subroot the
root; a proof without siblings is the hash of nothing. An empty table gives an empty
table. Texts are hashed whole by Spark, however long. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import Optional, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

#: A superblock has 2^HEIGHT leaves.
HEIGHT = 12


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(c: Column) -> Column:
    """A value as the leaf hashes it: ``-`` for null, else byte count, ``:``, value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def reduce_level(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]


def levels(nodes: list[str], height: int, last_tier: bool) -> list[list[str]]:
    """The levels of one superblock from its nodes upwards: ``height`` reductions, or
    until one node is left where the superblock is all that its group has."""
    out = [nodes]
    while len(out) <= height and not (last_tier and len(out[-1]) == 1):
        out.append(reduce_level(out[-1]))
    return out


def siblings(tree: list[list[str]], i: int) -> list[str]:
    """What place ``i`` is hashed with, level by level: ``L``/``R`` and the sibling
    on that side, or ``-`` where the node is alone."""
    out = []
    for level in tree[:-1]:
        j = i ^ 1
        out.append("-" if j >= len(level) else ("L" if j < i else "R") + level[j])
        i >>= 1
    return out


def fold_up(node: str, steps: Sequence[str]) -> str:
    for s in steps:
        node = digest(s[1:] + node if s[0] == "L" else node + s[1:] if s[0] == "R" else node)
    return node


def proof_digest(steps: Sequence[str]) -> str:
    return digest("".join(s[1:] for s in steps))


def ranked(df: DataFrame, key: str, order: list) -> DataFrame:
    """``df`` with ``rank``, each row's place among those of its ``key`` (null-safe), from 0, and ``n``, their number.

    A range shuffle sorts the rows; ``order`` follows the key and should tell
    most rows apart. Places come from the sorted partitions' row numbers."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.asc_nulls_first(key), *[F.asc_nulls_first(c) for c in order]]
    rows = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    at = F.monotonically_increasing_id()
    rows = stage(rows.withColumn("part", F.shiftright(at, 33)).withColumn("at", at % F.lit(1 << 33)), "merkle-sorted")
    known = F.to_json(F.struct(F.col(key).alias("k")))  # a null key must meet itself
    counts = rows.groupBy("part", known.alias("known")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    before = W.partitionBy("known").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0)))
    counts = counts.withColumn("n", F.sum("c").over(W.partitionBy("known")))
    rows = rows.withColumn("known", known).join(counts.drop("c"), ["part", "known"])
    return rows.withColumn("rank", (F.col("offset") + F.col("at") - F.col("first")).cast("long")).drop("part", "at", "first", "offset")


def _reduce(height: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, n = pdf.sort_values("rank"), int(pdf["n"].iloc[0])
        tree = levels(list(pdf["node"]), height, n <= 1 << height)
        return pd.DataFrame({"known": [pdf["known"].iloc[0]], "rank": [pdf["block"].iloc[0]], "n": [-(-n >> height)], "node": [tree[-1][0]]})

    return run


def climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Tables ``known, rank, n, node`` from the given nodes upwards: a key is in every
    table up to the one where it has a single node, and at least in two."""
    out = [nodes.select("known", "rank", "n", "node")]
    while len(out) == 1 or not out[-1].where("n > 1").isEmpty():
        below = (out[-1] if len(out) == 1 else out[-1].where("n > 1")).withColumn("block", F.shiftright("rank", height))
        up = below.groupBy("known", "block").applyInPandas(_reduce(height), "known string, rank long, n long, node string")
        out.append(stage(up, "merkle-tier"))
    return out


def tops(tiers: list[DataFrame]) -> DataFrame:
    """The last node of every key: ``known, node``."""
    return reduce(DataFrame.unionByName, [t.where("n = 1") for t in tiers[1:]]).select("known", "node")


def _down(height: int):
    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        tree = levels(list(nodes["node"]), height, int(nodes["n"].iloc[0]) <= 1 << height)
        above = list(outer["steps"].iloc[0])
        return pd.DataFrame({"known": nodes["known"], "rank": nodes["rank"], "steps": [siblings(tree, i) + above for i in range(len(nodes))]})

    return run


def _finish(height: int):
    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("rank")
        tree = levels(list(leaves["node"]), height, int(leaves["n"].iloc[0]) <= 1 << height)
        above = list(outer["steps"].iloc[0])
        proofs, folded, known = [], [], {}
        for i, claimed in enumerate(leaves["claimed"]):
            local = siblings(tree, i)
            proofs.append(proof_digest(local + above))
            top = fold_up(claimed, local)
            if top not in known:  # what leads to one node goes on alike
                known[top] = fold_up(top, above)
            folded.append(known[top])
        return pd.DataFrame({
            "kept": leaves["kept"], "leaf": leaves["node"], "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0],
            "proof_sha256": proofs, "folded_root": folded,
        })

    return run


def extend(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """``known, rank, steps`` of the nodes, given those of their superblocks (``rank`` is the superblock)."""
    nodes = nodes.withColumn("block", F.shiftright("rank", height))
    outer = outer.select("known", F.col("rank").alias("block"), "steps")
    both = nodes.groupBy("known", "block").cogroup(outer.groupBy("known", "block"))
    return both.applyInPandas(_down(height), "known string, rank long, steps array<string>")


def descend(tiers: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """``known, rank, steps`` over every superblock of the lowest table, given
    ``known, steps`` over every key's last node."""
    steps = None
    for tier in reversed(tiers[1:]):
        ended = tier.where("n = 1").join(above.select("known", "steps"), "known").select("known", "rank", "steps")
        steps = ended if steps is None else stage(ended.unionByName(extend(tier.where("n > 1"), steps, height)), "merkle-steps")
    return steps


def manifest(df: DataFrame, group: str, order: Sequence[str], fields: Sequence[str], claimed: Optional[Sequence[Column]] = None,
             keep: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """The columns ``keep`` of every row with ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``fields`` make the leaf; ``claimed`` (the same fields as someone presents them)
    makes the leaf that is folded. ``order`` sorts the leaves of a ``group``."""
    true = leaf([F.col(c) for c in fields])
    false = leaf(list(claimed)) if claimed is not None else true
    kept = F.struct(*[F.col(c) for c in keep])
    sort = [f"o{i}" for i in range(len(order))]
    # kept columns pass Python as one JSON text, which changes no integer
    thin = stage(df.select(F.to_json(kept).alias("kept"), F.col(group).alias("g"), *[F.col(c).alias(o) for c, o in zip(order, sort)], true.alias("node"), false.alias("claimed")), "merkle-thin")
    leaves = stage(ranked(thin, "g", [*sort, "node"]).select("kept", "g", "known", "rank", "n", "node", "claimed"), "merkle-leaves")

    tiers = climb(leaves, height)
    subroots = tops(tiers).join(leaves.where("rank = 0").select("known", "g"), "known")
    subroots = ranked(subroots.select(F.col("known").alias("member"), "g", "node", F.lit(0).alias("all")), "all", ["g"])
    subroots = stage(subroots.select("member", "known", "rank", "n", "node"), "merkle-subroots")
    crown = climb(subroots, height)
    root = tops(crown).withColumnRenamed("node", "root")
    over = descend(crown, root.select("known", F.array().cast("array<string>").alias("steps")), height)
    over = extend(crown[0], over, height).join(subroots.select("known", "rank", "member", F.col("node").alias("subroot")), ["known", "rank"]).join(root, "known")
    over = stage(over.select(F.col("member").alias("known"), "steps", "subroot", "root"), "merkle-over")

    outer = descend(tiers, over, height).join(over.select("known", "subroot", "root"), "known").withColumnRenamed("rank", "block")
    rows = leaves.drop("g").withColumn("block", F.shiftright("rank", height))
    out = rows.groupBy("known", "block").cogroup(outer.groupBy("known", "block")).applyInPandas(
        _finish(height), "kept string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    out = out.withColumn("kept", F.from_json("kept", df.select(*keep).schema))
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
