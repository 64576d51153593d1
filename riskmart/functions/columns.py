"""Column-level building blocks: typed projection, locale numbers, scores.

All of these return Column expressions or single projections, so Catalyst
collapses them into one Project inside whole-stage code generation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_locale_double(c: ColumnLike) -> Column:
    """Number text with a decimal comma (``1,06957E+11``) or point → double.

    Text that is not a number gives null instead of failing the job (Spark 4
    runs with ANSI casts, where a plain cast would throw).
    """
    text = F.trim(_col(c).cast("string"))
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def typed_null(data_type: str | T.DataType) -> Column:
    """A null of a fixed type, so a union never widens a void column."""
    return F.lit(None).cast(data_type)


@dataclass(frozen=True)
class ColumnSpec:
    """One output column of a curation step: source name → target name and type.

    ``kind`` is a Spark SQL type name, or ``locale_double`` for numbers that may
    use a decimal comma, or ``keep`` to pass the value through untouched.
    """

    source: str
    target: str
    kind: str = "keep"

    def to_column(self) -> Column:
        src = F.col(f"`{self.source}`")
        if self.kind == "keep":
            value = src
        elif self.kind == "locale_double":
            value = parse_locale_double(src)
        else:
            value = src.try_cast(self.kind)
        return value.alias(self.target)


def project(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Rename and type columns in one ``select``; output order = spec order."""
    return df.select(*[s.to_column() for s in specs])


def delta(after: ColumnLike, before: ColumnLike) -> Column:
    """Before/after change, ``after - before`` (null if either is null)."""
    return _col(after) - _col(before)


def weighted_score(terms: Iterable[tuple[ColumnLike, float]]) -> Column:
    """Σ column·weight, added strictly left to right (floating-point order matters)."""
    parts = [_col(c) * F.lit(float(w)) for c, w in terms]
    return reduce(add, parts)


def sanitize_floats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NaN, +inf and -inf by null in float/double columns (all by default)."""
    float_cols = {f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = float_cols if columns is None else set(columns) & float_cols
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in targets:
            bad = F.isnan(c) | c.isin(F.lit(math.inf), F.lit(-math.inf))
            c = F.when(bad, typed_null(f.dataType)).otherwise(c).alias(f.name)
        out.append(c)
    return df.select(*out)
