"""An equi-join whose hot keys are spread on both sides.

A key that fills a share of both inputs fans out to the product of its rows, in one task
if the rows are only dealt by key. Here a frequent-items sketch of each side (bounded,
merged from the tasks) names the keys above ``share`` of its rows. A hot key's rows are
cut in S parts on the left and T on the right by a row hash; each left part is sent to
the T cells of its row, each right part to the S cells of its column, and every pair of
rows meets in exactly one of the S x T cells. All other keys join as ever.

The sketch's counts are estimates and only decide where rows travel; the result is the
plain inner join's. Null keys join nothing. Equal rows share a part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1 / 64                           # of a side's rows that make a key hot: 64 hot keys a side at most
TRACKED = 4096                           # keys that the sketch holds
HELD = 4096                              # rows of a key that a sort-merge join holds as they are; beyond, it goes through a spillable sorter


def _counts(df: DataFrame, key: str, share: float) -> tuple[int, dict]:
    """The rows that have a key, and the keys that hold more than ``share`` of them with their counts."""
    known = df.where(F.col(key).isNotNull())
    most = int(1 / share)
    row = known.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top")).head()
    return row.rows, {t.item: t["count"] for t in row.top or [] if t["count"] > row.rows * share}


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> dict:
    """The keys that hold more than ``share`` of the rows, and the number of parts for each."""
    rows, counts = _counts(df, key, share)
    return _parts(rows, counts, share)


def _parts(rows: int, counts: dict, share: float, held: int | None = None) -> dict:
    """The number of parts of each hot key: of ``share`` of the rows each, and of ``held`` rows at most."""
    return {k: max(-int(-n // (rows * share)), -(-n // held) if held else 1) for k, n in counts.items()}


def _parts_of(key: Column, hot: dict) -> Column:
    """The number of parts of each row's key."""
    return reduce(lambda rest, kv: F.when(key == F.lit(kv[0]), F.lit(kv[1])).otherwise(rest), hot.items(), F.lit(1))


def _cells(df: DataFrame, key: str, own: dict, other: dict, part: str, copy: str) -> DataFrame:
    """``df`` with its part by row hash, once for each part of the other side."""
    parts, copies = _parts_of(F.col(key), own), _parts_of(F.col(key), other)
    return (df.withColumn(part, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), parts).cast("int"))
            .withColumn(copy, F.explode(F.sequence(F.lit(0), copies - 1))))


def spread_join(left: DataFrame, right: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """``left.join(right, key)``, hot keys spread: the key once and first, then left's columns, then right's.

    The join goes through the cells' rows of one side for each row of the other. That is the
    side with fewer rows of hot keys; its parts are small enough to be held as they are.
    """
    sides = [_counts(df, key, share) for df in (left, right)]
    if not any(counts for _, counts in sides):
        return left.join(right, key)
    swap = sum(sides[0][1].values()) < sum(sides[1][1].values())           # the join holds its right side
    hot = [_parts(*side, share, HELD if held else None) for side, held in zip(sides, (swap, not swap))]
    names = [[(c, f"_{side}{i}") for i, c in enumerate(df.columns) if c != key] for side, df in (("l", left), ("r", right))]
    cells = [_cells(df.select(F.col(key).alias("_key"), *[F.col(f"`{c}`").alias(n) for c, n in own]), "_key", *ways)
             for df, own, ways in zip((left, right), names, ((hot[0], hot[1], "_i", "_j"), (hot[1], hot[0], "_j", "_i")))]
    streamed, held = reversed(cells) if swap else cells
    pairs = streamed.join(held.hint("merge"), ["_key", "_i", "_j"])
    return pairs.select(F.col("_key").alias(key), *[F.col(n).alias(c) for c, n in names[0] + names[1]])
