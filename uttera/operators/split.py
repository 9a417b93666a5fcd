"""Train and test split by position within a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.config import Params
from uttera.operators.scan import Ordered

P = Params()


def positional_split(rows: DataFrame, keys: list[str], order: list[str], share: float = P.train_share, min_test: int = P.min_test) -> DataFrame:
    """Adds ``split``: the first int(n * share) rows of a directory train, the rest test; all train if the test is below ``min_test``.

    Places come from a scan over pieces, so a directory of any size is spread.
    """
    placed = Ordered(rows, keys, order).scan(place="__place", total="__total")
    train = F.floor(F.col("__total") * F.lit(share))
    to_train = (F.col("__place") <= train) | (F.col("__total") - train < min_test)
    return placed.withColumn("split", F.when(to_train, "train").otherwise("test")).drop("__place", "__total")


def split_counts(rows: DataFrame) -> DataFrame:
    """(split, n) of rows that have been split."""
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def count_split(rows: DataFrame, keys: list[str], share: float = P.train_share, min_test: int = P.min_test) -> DataFrame:
    """(split, n) that ``positional_split`` would give, from the sizes of the directories alone: no row is numbered."""
    size = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__train", F.floor(F.col("__n") * F.lit(share)))
    train = F.when(F.col("__n") - F.col("__train") < min_test, F.col("__n")).otherwise(F.col("__train"))
    parts = size.select(F.explode(F.array(F.struct(F.lit("train").alias("split"), train.alias("n")), F.struct(F.lit("test").alias("split"), (F.col("__n") - train).alias("n")))).alias("p")).select("p.*")
    return parts.where("n > 0").groupBy("split").agg(F.sum("n").alias("n"))


def split_paths(rows: DataFrame, path: str = "path", root: str = "full") -> DataFrame:
    """The path of each clip in its split's tree."""
    return rows.withColumn("new_path", F.regexp_replace(path, f"(^|/){root}/", F.concat(F.lit("$1"), F.col("split"), F.lit("/"))))


def write_split(rows: DataFrame, folder: str, keys: list[str]) -> None:
    rows.write.partitionBy("split", *keys).mode("overwrite").parquet(folder)
