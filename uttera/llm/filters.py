"""Key filters of bounded size: rows whose key may be in a table of keys, told apart without moving the rows.

The keys become a blocked Bloom filter: a table of at most ``WORDS`` rows (word, 64 bits), three bits a key. Only that
table is broadcast, so its bound holds at every size; with more keys than it was made for it lets more rows
through, which costs time and never a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20


def _word(key: str) -> Column:
    return F.expr(f"cast(pmod(xxhash64(`{key}`), {WORDS}) as int)")


def _bits(key: str) -> Column:
    h = f"xxhash64(`{key}`, 7)"
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftright({h}, {k}) & 63 as int))" for k in (0, 6, 12)))


def bloom(keys: DataFrame, key: str) -> DataFrame:
    """The filter of a key column; null keys are not in it."""
    words = keys.where(F.col(key).isNotNull()).select(_word(key).alias("__word"), _bits(key).alias("__bits"))
    return words.groupBy("__word").agg(F.bit_or("__bits").alias("__has"))


def perhaps(rows: DataFrame, key: str, filter_: DataFrame, flag: str = "__perhaps") -> DataFrame:
    """The rows with a flag: false for those whose key is surely not in the filter."""
    joined = rows.withColumn("__word", _word(key)).join(F.broadcast(filter_), "__word", "left")  # at most WORDS rows
    has = F.coalesce(F.col(key).isNotNull() & ((F.col("__has").bitwiseAND(_bits(key))) == _bits(key)), F.lit(False))
    return joined.withColumn(flag, has).drop("__word", "__has")


def among(rows: DataFrame, key: str, filter_: DataFrame) -> DataFrame:
    """Every row whose key is in the filter's keys, and few others."""
    return perhaps(rows, key, filter_).where("__perhaps").drop("__perhaps")


def without(rows: DataFrame, key: str, gone: DataFrame, filter_: DataFrame) -> DataFrame:
    """The rows whose key is not in ``gone``: only those that the filter lets through take part in the join."""
    flagged = perhaps(rows, key, filter_)
    rest = flagged.where("__perhaps").join(gone.select(key), key, "left_anti")
    return flagged.where("not __perhaps").unionByName(rest).select(*rows.columns)
