"""Embedding outliers within a group: distances to the other members, rejection, and its effects."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.config import Params

PAIR_ROWS = 2000
CANCELS = 1e-4  # squares below this share of the norms come from differences


def _l2(a, b):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def member_scores(members: DataFrame, group: str, member: str, embedding: str, combine: str = "mean") -> DataFrame:
    """(group, member, score): combined L2 distance to the group's other members.

    ``mean`` and ``max`` compare members with blocks of ``PAIR_ROWS`` others, so a group of any size is
    spread over tasks of bounded size; ``centroid`` is one aggregation and a join. A member alone has score 0. Rows without
    an embedding have no score; of rows repeated under one member the least embedding counts, once.
    """
    typed = members.where(F.col(embedding).isNotNull()).select(group, member, F.transform(embedding, lambda x: x.cast("double")).alias("e"))
    rows = typed.groupBy(group, member).agg(F.min("e").alias("e"))
    if combine == "centroid":
        sums = rows.select(group, F.posexplode("e").alias("k", "v")).groupBy(group, "k").agg(F.avg("v").alias("v"))
        centre = sums.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("c"))
        return rows.join(centre, group).select(group, member, _l2(F.col("e"), F.col("c")).alias("score"))
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / PAIR_ROWS).cast("int").alias("blocks"))
    own = rows.join(sizes, group).withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    sides = own.select(group, member, "e", F.col("block").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), F.lit(True).alias("asks")).unionByName(
        own.select(group, member, "e", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"), F.col("block").alias("b"), F.lit(False).alias("asks"))
    )

    def distances(_, table):
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        flat = table.column("e").combine_chunks()
        e = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)
        x, y = e[asks], e[~asks]
        d = pairwise(x, y)
        mine = table.filter(pa.array(asks))
        return pa.table({group: mine.column(group), member: mine.column(member), "total": d.sum(1), "most": d.max(1), "n": np.full(len(x), len(y), np.int64)})

    kinds = f"`{group}` {dict(rows.dtypes)[group]}, `{member}` {dict(rows.dtypes)[member]}, total double, most double, n bigint"
    parts = sides.groupBy(group, "a", "b").applyInArrow(distances, kinds)
    score = F.sum("total") / F.greatest(F.sum("n") - 1, F.lit(1)) if combine == "mean" else F.max("most")
    return parts.groupBy(group, member).agg(score.alias("score"))


def pairwise(x: np.ndarray, y: np.ndarray, step: int = 1_000_000) -> np.ndarray:
    """Distances of all rows of x to all of y: squares from one matrix product a block, and from differences where these cancel out."""
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    rows = max(1, step // max(1, len(y)))
    out = []
    for k in range(0, len(x), rows):
        size = xx[k : k + rows, None] + yy[None, :]
        square = size - 2 * (x[k : k + rows] @ y.T)
        i, j = np.nonzero(square < CANCELS * size)
        for a in range(0, len(i), step // max(1, x.shape[1]) + 1):
            some = slice(a, a + step // max(1, x.shape[1]) + 1)
            square[i[some], j[some]] = ((x[k + i[some]] - y[j[some]]) ** 2).sum(1)
        out.append(np.sqrt(square))
    return np.concatenate(out) if out else np.zeros((0, len(y)))


def rejected(scores: DataFrame, tolerance: float = Params().l2_tolerance) -> DataFrame:
    return scores.where(F.col("score") > tolerance)


def report_lines(rejects: DataFrame, member: str) -> DataFrame:
    return rejects.select(F.format_string("%.2f - %s", F.col("score"), F.col(member).cast("string")).alias("line"))


def without_rejected(rows: DataFrame, rejects: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key was not rejected; numbering given before stays as it is."""
    return rows.join(rejects.select(*on), on, "left_anti")


def unmatched_rejects(rows: DataFrame, rejects: DataFrame, on: list[str]) -> DataFrame:
    """Rejected keys without a row: must be empty."""
    return rejects.join(rows.select(*on), on, "left_anti")
