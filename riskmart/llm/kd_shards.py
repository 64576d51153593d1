"""K-d tree sharding: split at distributed weighted medians along the widest metadata dimension.

Every row has a size and a level (0..65535) in each metadata dimension: a numeric
column by its place between the column's minimum and maximum (``log`` for
lengths), any other column by a hash code that keeps equal values together. A
node holds some of the leaves; it is split along the dimension whose levels are
widest in it, at the key where its bytes divide in proportion to the leaves on
either side, until every node is one leaf, i.e. has about the target bytes.

Equal texts are a group. All rows of a group take the metadata of its least row and one
key, (level, content code), so they share a shard. A group of more than ``whole`` of a
shard's target is no unit: its rows are keyed by (level, content code, row code), so
no value is too frequent to be cut. A cut is found
exactly by four passes over 16-bit digits of the key for all nodes of a level at
once; the driver sees one row per node.

Defined results: null or empty text has size 1; null metadata has level 0; a
repeated row is a row of its own; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import Scratch
from .running import running_sum

LEVELS = 1 << 16
DIGITS = (48, 32, 16, 0)                 # shifts of the key's 16-bit digits


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _numeric_level(value: Column, low: float, high: float) -> Column:
    if low is None or high <= low:
        return F.lit(0)
    part = (value.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.coalesce(F.floor(part * (LEVELS - 1)).cast("int"), F.lit(0))


def _coded_level(value: Column) -> Column:
    return F.coalesce(F.shiftrightunsigned(F.xxhash64(value), 48).cast("int"), F.lit(0))


def _splits(base: DataFrame, dims: int) -> list[dict]:
    """One row per open node: dimension, cut key, and the leaves on either side."""
    spark = base.sparkSession
    wide = [F.max(F.col("levels")[i]) - F.min(F.col("levels")[i]) for i in range(dims)]
    nodes = (base.where("leaves > 1").groupBy("node", "leaves")
             .agg(F.sum("size").alias("bytes"), F.array(*wide).alias("wide")).collect())
    todo = {}
    for n in nodes:
        left = n.leaves // 2
        todo[n.node] = {"node": n.node, "leaves": n.leaves, "dim": max(range(dims), key=lambda i: (n.wide[i], -i)),
                        "want": n.bytes * left // n.leaves, "before": 0, "prefix": 0, "left": left}
    for shift in DIGITS:
        if not todo:
            break
        state = spark.createDataFrame([(t["node"], t["dim"], t["want"], t["before"], t["prefix"])
                                       for t in todo.values()],
                                      "node int, dim int, want long, before long, prefix long")
        digit = F.shiftrightunsigned("key", shift)
        rows = (_keyed(base.join(F.broadcast(state), "node"))
                .where(F.lit(shift == 48) | (F.shiftrightunsigned("key", min(shift + 16, 63)) == F.col("prefix")))
                .groupBy("node", "want", "before", digit.alias("digit")).agg(F.sum("size").alias("bytes")))
        upto = Window.partitionBy("node").orderBy("digit")
        found = (rows.withColumn("upto", F.col("before") + F.sum("bytes").over(upto))
                 .where(F.col("upto") >= F.col("want"))
                 .groupBy("node").agg(F.min_by(F.struct("digit", "upto", "bytes"), "digit").alias("at")))
        for r in found.collect():
            todo[r.node] |= {"prefix": r["at"].digit, "before": r["at"].upto - r["at"].bytes, "last": r["at"].bytes}
    for t in todo.values():              # the cut key goes to the side that it unbalances less
        t["cut"] = t["prefix"] + (2 * (t["want"] - t["before"]) > t["last"])
    return list(todo.values())


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("key", F.shiftleft(F.expr("levels[dim]").cast("long"), 47) + F.col("tie"))


def _grouped(narrow: DataFrame, dims: list[str]) -> DataFrame:
    """Rows with their group's bytes and the dimensions of the group's least row; hot groups are spread."""
    groups = (narrow.groupBy("g").agg(F.sum("size").alias("g_bytes"), F.min(F.struct("id", *dims)).alias("least"))
              .select("g", "g_bytes", *[F.col(f"least.{d}").alias(d) for d in dims]))
    return spread_join(narrow.drop(*dims), groups, "g")


def kd_shards(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
              numeric: dict[str, bool] | None = None, coded: list[str] | None = None,
              n_shards: int | None = None, target_bytes: int | None = None, whole: float = 0.25,
              scratch: Scratch | None = None) -> DataFrame:
    """Per row: id_col, size, text_crc32, shard, slot (gapless from 0 within the shard).

    ``numeric`` maps dimension columns to whether they count by logarithm,
    ``coded`` lists the other dimensions. Give either the number of shards or
    the target bytes of one. A cut misses its place by half a row or group at most (a group
    of more than ``whole`` of the target bytes counts as rows), or by one of 2**23 cells of its rows.
    """
    if (n_shards is None) == (target_bytes is None):
        raise ValueError("give n_shards or target_bytes")
    numeric = {"n_chars": True, id_col: False} if numeric is None else numeric
    coded = ["source", "lang"] if coded is None else coded
    scratch = scratch or Scratch(docs.sparkSession, "kd", until_exit=True)
    value = {c: F.log2(F.greatest(F.col(c).cast("double"), F.lit(0.0)) + 1) if log else F.col(c).cast("double")
             for c, log in numeric.items()}
    narrow = scratch.store(docs.select(
        F.col(id_col).alias("id"), _size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("g"),
        *[v.alias(f"n{i}") for i, v in enumerate(value.values())],
        *[_coded_level(F.col(c)).alias(f"c{i}") for i, c in enumerate(coded)]), "narrow")
    stats = narrow.agg(F.sum("size").alias("bytes"),
                       *[f(f"n{i}").alias(f"{f.__name__}{i}") for i in range(len(value)) for f in (F.min, F.max)]).head()
    if n_shards is None:
        n_shards = max(1, -(-(stats.bytes or 0) // target_bytes))
    row_code = F.xxhash64(F.lit("row"), "id")
    levels = [*[F.col(f"c{i}") for i in range(len(coded))],
              *[_numeric_level(F.col(f"n{i}"), stats[f"min{i}"], stats[f"max{i}"]) for i in range(len(value))]]
    code = F.xxhash64(F.lit("group"), "g")
    unit = F.col("g_bytes") <= F.lit(whole * (stats.bytes or 0) / n_shards)
    dims = [*[f"c{i}" for i in range(len(coded))], *[f"n{i}" for i in range(len(value))]]
    base = scratch.store(_grouped(narrow, dims).select(
        "id", "size", "text_crc32", F.array(*levels).alias("levels"),
        F.when(unit, F.shiftrightunsigned(code, 17))
        .otherwise(F.shiftleft(F.shiftrightunsigned(code, 40), 23) + F.shiftrightunsigned(row_code, 41)).alias("tie"),
        F.lit(0).alias("node"), F.lit(n_shards).alias("leaves")), "placed")
    widest = n_shards
    while widest > 1:
        splits = _splits(base, len(levels))
        cuts = docs.sparkSession.createDataFrame(
            [(s["node"], s["dim"], s["cut"], s["left"]) for s in splits], "node int, dim int, cut long, left int")
        right = F.col("key") >= F.col("cut")
        # a node is named by its first leaf: the right side starts after the left side's leaves
        base = _keyed(base.join(F.broadcast(cuts), "node", "left")).select(
            "id", "size", "text_crc32", "levels", "tie",
            F.when(F.col("dim").isNull() | ~right, F.col("node")).otherwise(F.col("node") + F.col("left")).alias("node"),
            F.when(F.col("dim").isNull(), F.col("leaves")).when(right, F.col("leaves") - F.col("left"))
            .otherwise(F.col("left")).alias("leaves"))
        base = scratch.store(base, "level")
        widest = max((s["leaves"] - s["left"] for s in splits), default=0)
    leaf = base.select("id", "size", "text_crc32", F.col("node").alias("shard"),
                       F.xxhash64(F.lit("slot"), "id", "text_crc32").alias("h"))
    out = running_sum(leaf, ["shard"], "h", ["id", "size"], F.lit(1), "slot")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
