"""Global ``rank()`` over a whole table without sending every row to one task.

``rank() OVER (ORDER BY k DESC)`` with no PARTITION BY makes Spark move all rows
into one partition. Here the table is cut into range buckets, as many as its rows
call for:

1. The rows are stored once with a row hash (unless the caller has stored them), so
   what made them runs once.
2. A sample of the stored keys gives the cut points: rows fall into a fixed number
   of hash cells and each cell keeps one row (a partial aggregate, so a task sends at
   most one row per cell). Cuts are on (order keys, tie columns, row hash), so a key
   that holds a third of the rows is itself cut; they are one literal from then on,
   and a row's bucket is a pure function of the row, stable on task retry.
3. A count of the stored keys per bucket gives every bucket's offset, and the rank of a
   run of equal keys that a cut goes through: two numbers for each bucket, a literal too.
4. The rows are shuffled once by bucket, sorted and ranked inside it.

Finding a bucket is a binary search over the cuts, one projected column for each of
its steps, all in generated code. (No join on the bucket: the optimizer would write its
expression out through all steps.) Store, sample and counts run before the caller's
action. ``position`` asks for the row's place in (order keys, tie columns,
row hash), which no two rows share: paging reads it.

Null and NaN follow Spark's ordering: NaN is the largest value, ``desc`` puts
nulls last, ``asc`` puts nulls first. Ranks are BIGINT (Spark's own ``rank()`` is
INT and would overflow past 2^31 rows). ``plain`` is Spark's single-task window,
for comparison.
"""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.session import Scratch

OrderSpec = Sequence[tuple[str, bool]]   # (column, descending)

CELLS_PER_BUCKET = 32
MOST_CELLS = 1 << 16                     # sampled rows that reach the driver, at most
BUCKET_ROWS = 1 << 17                    # rows that are worth a bucket of their own


def desc(*names: str) -> list[tuple[str, bool]]:
    return [(n, True) for n in names]


def asc(*names: str) -> list[tuple[str, bool]]:
    return [(n, False) for n in names]


def _sort_cols(order: OrderSpec) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in order]


def plain_rank(df: DataFrame, order: OrderSpec, name: str = "rank") -> DataFrame:
    """Spark's window rank: exact, but the whole table goes through one task."""
    return df.withColumn(name, F.rank().over(Window.orderBy(*_sort_cols(order))).cast("long"))


def _cut_key(name: str, data_type: T.DataType) -> Column:
    """A key as it is compared with cuts, in the key's own order; text is compared whole."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(F.col(name))            # no time-zone round trip through Python
    return F.col(name)


def _cuts(keyed: DataFrame, order: OrderSpec, buckets: int) -> list[str]:
    """At most ``buckets - 1`` ascending cut tuples over the columns of ``order``, as JSON objects.

    What JSON cannot hold exactly (parts of a millisecond) is cut off the same way for all cuts,
    which keeps their order; a cut need not be a value that occurs.
    """
    names = [c for c, _ in order]
    cells = min(buckets * CELLS_PER_BUCKET, MOST_CELLS)
    sample = (keyed.groupBy(F.pmod(F.col("_tie"), F.lit(cells)).alias("_cell"))
              .agg(F.min_by(F.struct(*names), F.xxhash64(F.lit("cut"), "_tie")).alias("_row"))
              .select("_row", "_row.*").repartition(1).sortWithinPartitions(*_sort_cols(order))
              .select(F.to_json("_row").alias("cut")).collect())
    chosen = [sample[i * len(sample) // buckets].cut for i in range(1, buckets)] if sample else []
    return list(dict.fromkeys(chosen))


def _before(order: OrderSpec, cut: Sequence[Column]) -> Column:
    """True when the row's tuple sorts strictly before the tuple ``cut``."""
    def step(rest: Column, part: tuple) -> Column:
        (name, descending), value = part
        col = F.col(name)
        first = (col > value) | (col.isNotNull() & value.isNull()) if descending else \
            (col < value) | (col.isNull() & value.isNotNull())
        return F.coalesce(first, F.lit(False)) | (col.eqNullSafe(value) & rest)
    return reduce(step, reversed(list(zip(order, cut))), F.lit(False))


class _Buckets:
    """The cuts of a stored table, and what follows from them for its rows."""

    def __init__(self, stored: DataFrame, order: OrderSpec, ties: Sequence[str], buckets: int):
        types = {f.name: f.dataType for f in stored.schema}
        full = [*order, *[(t, False) for t in ties]]
        self.keys = len(order)
        self.order = [(f"_k{i}", d) for i, (_, d) in enumerate(full)] + [("_tie", False)]
        self.columns = {f"_k{i}": _cut_key(c, types[c]) for i, (c, _) in enumerate(full)}
        self.stored = stored
        keyed = stored.select(*[col.alias(k) for k, col in self.columns.items()], "_tie")
        self.cuts = _cuts(keyed, self.order, buckets) if buckets > 1 else []
        kind = T.ArrayType(T.StructType([keyed.schema[c] for c, _ in self.order]))
        self.table = F.from_json(F.lit("[" + ",".join(self.cuts) + "]"), kind)        # folded to one literal

    def number(self, df: DataFrame) -> DataFrame:
        """``df`` with the key columns and ``_b``: the number of cuts at or before the row."""
        df = df.withColumns({**self.columns, "_b": F.lit(0)})
        for size in [1 << i for i in reversed(range(len(self.cuts).bit_length()))]:
            cut = F.get(self.table, F.col("_b") + (size - 1))
            past = (F.col("_b") + size <= len(self.cuts)) & ~_before(self.order, [cut[c] for c, _ in self.order])
            df = df.withColumn("_b", F.when(past, F.col("_b") + size).otherwise(F.col("_b")))
        return df

    def _at_cut(self, number: Column) -> Column:
        """Whether the row's order keys are those of the cut of that number (from 1)."""
        cut = F.get(self.table, number - 1)
        same = [F.col(c).eqNullSafe(cut[c]) for c, _ in self.order[:self.keys]]
        return number.between(1, len(self.cuts)) & reduce(lambda a, b: a & b, same)

    def offsets(self) -> tuple[list[int], list[int]]:
        """For each bucket the rows before it, and the rank of its first row. One row a bucket reaches the driver."""
        if not self.cuts:
            return [0], [1]
        b = F.col("_b")
        # whether a bucket's cut has another key than the cut before
        cuts = [json.loads(c, parse_float=Decimal) for c in self.cuts]
        keys = [tuple(c.get(k) for k, _ in self.order[:self.keys]) for c in cuts]
        new = [True, *[i == 0 or k != keys[i - 1] for i, k in enumerate(keys)]]
        each = (self.number(self.stored).select("_b", self._at_cut(b).alias("low"), self._at_cut(b + 1).alias("high"))
                .groupBy("_b").agg(F.count("*").alias("rows"), F.max("low").alias("goes_on"), F.count_if("high").alias("next")))
        found = {r["_b"]: r for r in each.collect()}
        before_rows, first, rows, below, ahead = [], [], 0, 0, 0
        for i, starts in enumerate(new):
            if starts:                   # rows before the cut's key: that key may begin in the bucket before
                below = rows - ahead
            here = found.get(i)
            before_rows.append(rows)
            first.append((below if here and here.goes_on else rows) + 1)
            rows, ahead = rows + (here.rows if here else 0), here.next if here else 0
        return before_rows, first


def _listed(values: list[int]) -> Column:
    return F.from_json(F.lit(str(values)), "array<bigint>")              # folded to one literal


def _with_tie(df: DataFrame) -> DataFrame:
    return df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def with_bucket(df: DataFrame, order: OrderSpec, ties: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with ``_tie`` (row hash) and ``_b``: its range bucket."""
    df = _with_tie(df)
    return _Buckets(df, order, ties, buckets).number(df).select(*df.columns, "_b")


def global_rank(df: DataFrame, order: OrderSpec, name: str = "rank", strategy: str = "buckets",
                ties: Sequence[str] | None = None, position: str | None = None,
                buckets: int | None = None, stored: bool = False) -> DataFrame:
    """Append ``name`` = ``rank()`` over the whole table in ``order``.

    ``ties`` (``id`` if there is such a column) only spread rows of equal keys and
    order them for ``position``, an optional unique place from 1 on. ``buckets``
    defaults to one for every ``BUCKET_ROWS`` rows, up to the session's number of shuffle
    partitions. ``stored`` says that ``df`` is a projection of stored files: it is read
    three times instead of being stored here. With ``position`` each partition is in its order.
    """
    if strategy not in ("plain", "buckets"):
        raise ValueError(f"unknown rank strategy {strategy!r}")
    df = df.drop(name, *([position] if position else []))    # re-ranking replaces the old columns
    if strategy == "plain" and position is None:
        return plain_rank(df, order, name)
    columns = df.columns
    keys = [c for c, _ in order]
    ties = [t for t in (("id",) if ties is None else ties) if t in columns and t not in keys]
    df = _with_tie(df)
    rows = None
    if not stored:
        counted = Observation()
        df = Scratch(df.sparkSession, "rank", until_exit=True).store(df.observe(counted, F.count(F.lit(1)).alias("rows")), "rows")
        rows = counted.get["rows"]
    if strategy == "plain":
        buckets = 1
    elif buckets is None:                # sizes the plan only: the rank is the same with any number
        rows = df.count() if rows is None else rows
        buckets = min(-(-rows // BUCKET_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = _Buckets(df, order, ties, max(1, buckets))
    by_key = Window.partitionBy("_b").orderBy(*_sort_cols(order))
    by_row = Window.partitionBy("_b").orderBy(*_sort_cols(order), *_sort_cols(asc(*ties)), "_tie")
    rows = cut.number(df)
    if position:
        rows = rows.withColumn("_p", F.row_number().over(by_row))
    rows = rows.withColumn("_r", F.rank().over(by_key))
    if position:                         # by bucket, then in its order: what the windows leave, so no sort of its own
        rows = rows.sortWithinPartitions("_b", *_sort_cols(order), *_sort_cols(asc(*ties)), "_tie")
    before, first = (F.get(_listed(values), F.col("_b")) for values in cut.offsets())
    rank = F.when(F.col("_r") == 1, first).otherwise(before + F.col("_r")).cast("long")
    more = [(before + F.col("_p")).cast("long").alias(position)] if position else []
    return rows.select(*[F.col(f"`{c}`") for c in columns], rank.alias(name), *more)
