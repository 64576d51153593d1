"""Row counts without extra passes (K5, A1) and the duplicate-key check.

``observe`` attaches aggregate metrics to a plan; they are filled in by the
action that runs it (the write), so counting costs no second scan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass
class StageMetrics:
    """Counts gathered by observed writes: (stage, table, metric) → value."""

    records: list[tuple[str, str, str, int]] = field(default_factory=list)
    _pending: list[tuple[str, str, Observation]] = field(default_factory=list)

    def observe(self, df: DataFrame, stage: str, table: str, **metrics: Column) -> DataFrame:
        """Return ``df`` with metrics attached (default: ``rows`` = row count)."""
        metrics = metrics or {"rows": F.count(F.lit(1))}
        obs = Observation(f"{stage}:{table}:{uuid.uuid4().hex[:12]}")   # unique across threads
        self._pending.append((stage, table, obs))
        return df.observe(obs, *[c.alias(k) for k, c in metrics.items()])

    def collect(self) -> list[tuple[str, str, str, int]]:
        """Read the observations of the actions that have run (blocks until filled)."""
        for stage, table, obs in self._pending:
            for k, v in obs.get.items():
                self.records.append((stage, table, k, int(v)))
        self._pending.clear()
        return self.records

    def value(self, stage: str, table: str, metric: str = "rows") -> int:
        """One observed value (collects pending observations first)."""
        for s, t, m, v in reversed(self.collect()):
            if (s, t, m) == (stage, table, metric):
                return v
        raise KeyError((stage, table, metric))

    def settle(self, stage: str, table: str, rows: int) -> None:
        """Put an exact row count, taken from the stored files, in place of the observed one.

        For writes with a shuffle after the observed node, whose map tasks may have run twice.
        """
        self.collect()
        at = max(i for i, (s, t, m, _) in enumerate(self.records) if (s, t, m) == (stage, table, "rows"))
        self.records[at] = (stage, table, "rows", rows)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per counted metric (a handful of rows: metadata, not data)."""
        return spark.createDataFrame(self.collect(),
                                     "stage string, table_name string, metric string, value bigint")


def row_count(df: DataFrame) -> int:
    """Whole-table row count (A1): Spark answers it from Parquet footers when it can."""
    return df.count()


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once (an inner join on them would fan out)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
