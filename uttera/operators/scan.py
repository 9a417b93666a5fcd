"""Ordered computations within keys that need no task for a whole key.

Rows are range-partitioned by (keys, order), so that the rows of a key lie in consecutive *pieces* and a key of any size is spread over as
many as it fills. They are written once with their place, as ranges must not be drawn twice. A scan then has two levels: one row
for each key and piece says what the piece adds up to, a window over these rows says what comes before each piece, and inside a
piece a window of its own does the rest. No window spans more rows than a piece has, or pieces a key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uttera.storage import written

_AT, _PIECE = "__at", "__piece"
_BITS = 33  # of a row's number within its partition


class Ordered:
    """Rows of a table in ``order`` within ``keys``. ``order`` should tell all rows of a key apart; what is equal stays in one piece."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None):
        self.keys, self.columns = list(keys), rows.columns
        by = [*keys, *order]
        dealt = (rows.repartitionByRange(pieces, *by) if pieces else rows.repartitionByRange(*by)).sortWithinPartitions(*by)
        self.rows = written(dealt.withColumn(_AT, F.monotonically_increasing_id()), "ordered").withColumn(_PIECE, F.shiftright(_AT, _BITS))

    def scan(self, place: str | None = None, total: str | None = None, sums: Mapping[str, Column] | None = None, before: Mapping[str, Column] | None = None, last: Mapping[str, Column] | None = None) -> DataFrame:
        """The rows with further columns, each over the rows of the same key.

        place: the row's number from 1. total: how many rows the key has. sums: running sums, the row's own value included.
        before: values of the row before, null for the first. last: the latest value that isn't null up to the row.
        """
        sums, before, last = dict(sums or {}), dict(before or {}), dict(last or {})
        inner = Window.partitionBy(*self.keys, _PIECE).orderBy(_AT)
        found = [F.count(F.lit(1)).alias("__n"), F.min(_AT).alias("__first")]
        found += [F.sum(c).alias(f"__s_{k}") for k, c in sums.items()]
        found += [F.max_by(F.struct(c.alias("v")), _AT).alias(f"__b_{k}") for k, c in before.items()]
        found += [F.max_by(c, F.when(c.isNotNull(), F.col(_AT))).alias(f"__l_{k}") for k, c in last.items()]
        piece = self.rows.groupBy(*self.keys, _PIECE).agg(*found)
        earlier = Window.partitionBy(*self.keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*self.keys)
        ahead = [F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__total"), "__first"]
        ahead += [F.sum(f"__s_{k}").over(earlier).alias(f"__s_{k}") for k in sums]
        ahead += [F.lag(f"__b_{k}").over(Window.partitionBy(*self.keys).orderBy(_PIECE)).alias(f"__b_{k}") for k in before]
        ahead += [F.last(f"__l_{k}", True).over(earlier).alias(f"__l_{k}") for k in last]
        offsets = piece.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], F.col(_PIECE).alias("__p"), *ahead)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)], F.col(_PIECE) == F.col("__p"))
        rows = self.rows
        for k, c in sums.items():
            rows = rows.withColumn(f"__i_s_{k}", F.sum(c).over(inner))
        for k, c in before.items():
            rows = rows.withColumn(f"__i_b_{k}", F.lag(F.struct(c.alias("v"))).over(inner))
        for k, c in last.items():
            rows = rows.withColumn(f"__i_l_{k}", F.last(c, True).over(inner))
        out = rows.join(offsets, same)
        columns = [F.col(c) for c in self.columns]
        if place:
            columns.append((F.col(_AT) - F.col("__first") + F.col("__before") + 1).alias(place))
        if total:
            columns.append(F.col("__total").alias(total))
        columns += [F.when(F.col(f"__s_{k}").isNull(), F.col(f"__i_s_{k}")).when(F.col(f"__i_s_{k}").isNull(), F.col(f"__s_{k}")).otherwise(F.col(f"__s_{k}") + F.col(f"__i_s_{k}")).alias(k) for k in sums]
        columns += [F.coalesce(f"__i_b_{k}", f"__b_{k}")["v"].alias(k) for k in before]
        columns += [F.coalesce(f"__i_l_{k}", f"__l_{k}").alias(k) for k in last]
        return out.select(*columns)
