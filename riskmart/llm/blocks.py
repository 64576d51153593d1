"""Exact overlap of token sets, block by block.

Candidate pairs say which sets may be alike. Sets are gathered in blocks of
bounded size, so that sets that share candidates share a block, and every pair of
blocks that holds a candidate is compared inside one task. A large group of alike
sets is many blocks; no task holds more than two. Within a pair of blocks the
overlaps of all sets come from their common tokens, and only a linear number of
rows leaves the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 17                          # weight of a block: tokens, and 256 for each set
RARE = 32                                # tokens of more sets are counted by a matrix product


def placed(nodes: DataFrame, hints: DataFrame) -> DataFrame:
    """``nodes`` (h, n) with ``block``, by two rounds of least labels over ``hints`` (a, b), both directions.

    Equal labels share a block; a label that is too heavy is spread over as many blocks as it
    needs, light labels are packed together. Any placement is right; a good one ships less.
    """
    both = hints.select("a", "b").unionByName(hints.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    label = nodes.select("h", "n", F.col("h").alias("label"))
    for _ in range(2):
        least = (both.join(label.select(F.col("h").alias("b"), "label"), "b")
                 .groupBy("a").agg(F.min("label").alias("near")))
        label = (label.join(least, F.col("h") == F.col("a"), "left")
                 .select("h", "n", F.least("label", "near").alias("label")))
    weight = F.col("n") + 256
    heavy = (label.groupBy("label").agg(F.sum(weight).alias("weight")).where(F.col("weight") > BLOCK // 2)
             .select(F.col("label").alias("_label"), F.ceil(F.col("weight") / BLOCK).cast("long").alias("parts")))
    total = label.agg(F.sum(weight)).head()[0] or 0
    packs = int(total // BLOCK) + 1
    return (label.join(heavy, F.col("label") == F.col("_label"), "left")
            .select("h", "n", F.when(F.col("parts").isNull(), F.xxhash64(F.lit("pack"), F.pmod(F.xxhash64("label"), F.lit(packs))))
                    .otherwise(F.xxhash64(F.lit("part"), "label", F.pmod(F.xxhash64("h"), F.col("parts")))).alias("block")))


def gathered(pairs: DataFrame, crowds: DataFrame, blocks: DataFrame) -> DataFrame:
    """(x, y, h): the sets to compare in each pair of blocks x <= y.

    ``pairs`` (a, b) are candidates; ``crowds`` (token, h) are tokens of very many sets, all of
    whose members are candidates of each other.
    """
    at = blocks.select("h", "block")
    pair = (pairs.join(at.withColumnsRenamed({"h": "a", "block": "x"}), "a")
            .join(at.withColumnsRenamed({"h": "b", "block": "y"}), "b"))
    sorted_pair = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")]
    light = pair.select(*sorted_pair, F.explode(F.array("a", "b")).alias("h")).distinct()
    crowd = crowds.join(at, "h")
    spans = crowd.select("token", "block").distinct()
    meet = (spans.withColumnRenamed("block", "x").join(spans.withColumnRenamed("block", "y"), "token")
            .where("x <= y").select("x", "y").distinct())
    members = crowd.select("h", "block").distinct()
    heavy = (meet.withColumn("block", F.explode(F.array_distinct(F.array("x", "y")))).join(members, "block")
             .select("x", "y", "h"))
    return light.unionByName(heavy).distinct()


def overlaps(doc: np.ndarray, token: np.ndarray, docs: int) -> np.ndarray:
    """Matrix of common tokens; (doc, token) pairs are distinct."""
    out = np.zeros(docs * docs, dtype=np.int64)
    order = np.argsort(token, kind="stable")
    doc, token = doc[order], token[order]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(token)))
    for c in range(2, RARE + 1):
        rows = first[count == c]
        if len(rows):
            i, j = np.triu_indices(c, 1)
            for part in np.array_split(rows, 1 + len(rows) * len(i) // (1 << 20)):
                sets = doc[part[:, None] + np.arange(c)]
                out += np.bincount((sets[:, i] * docs + sets[:, j]).ravel(), minlength=docs * docs)
    out = out.reshape(docs, docs)
    many = np.flatnonzero(count > RARE)
    for lo in range(0, len(many), 2048):
        some = many[lo:lo + 2048]
        has = np.zeros((docs, len(some)), dtype=np.float32)
        for k, t in enumerate(some):
            has[doc[first[t]:first[t] + count[t]], k] = 1
        out += np.triu(has @ has.T, 1).astype(np.int64)      # exact: counts are far below 2**24
    return out + out.T


def linked(sets: pa.Table, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """h of every set of a block pair, and the matrix of links: overlap / union >= num / den."""
    h = sets["h"].to_numpy()
    lists = sets["tokens"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    token = lists.flatten().to_numpy()
    both = overlaps(np.repeat(np.arange(len(h)), sizes), token, len(h))
    union = sizes[:, None] + sizes[None, :] - both
    link = (den * both >= num * union) & (both > 0)
    np.fill_diagonal(link, False)
    return h, link


def forest(link: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every linked set to the least one of its component within the block pair."""
    nodes = np.flatnonzero(link.any(axis=1))
    if not len(nodes):
        return h[:0], h[:0]
    sub, root = link[np.ix_(nodes, nodes)], h[nodes].copy()
    big = np.iinfo(np.int64).max
    while True:
        near = np.minimum(np.where(sub, root[None, :], big).min(axis=1), root)
        if (near == root).all():
            break
        root = near
    keep = root != h[nodes]
    return h[nodes][keep], root[keep]


def edges_and_links(num: int, den: int):
    """A function for applyInArrow over (x, y): edges (a, b) that span the links of a block pair, and
    (a, links), the copies of the sets that a is linked to.

    Every link is counted in the pair of its own two blocks only: (x, x) for two sets of one block.
    """
    def run(sets: pa.Table) -> pa.Table:
        h, link = linked(sets, num, den)
        a, b = forest(link, h)
        x, y, block = (sets[c].to_numpy() for c in ("x", "y", "block"))
        own = link if x[0] == y[0] else link & (block[:, None] != block[None, :])
        links = np.where(own, sets["copies"].to_numpy()[None, :], 0).sum(axis=1)
        some = np.flatnonzero(links)
        return pa.table({"a": pa.array(np.append(a, h[some]), pa.int64()),
                         "b": pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(len(some), pa.int64())]),
                         "links": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(links[some], pa.int64())])})
    return run


def similar_enough(a: Column, b: Column, num: int, den: int) -> Column:
    """Length filter on set sizes."""
    return F.least(a, b) * den >= F.greatest(a, b) * num
