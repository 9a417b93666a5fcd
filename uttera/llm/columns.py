"""Keeps a table's own columns apart from those that an operator adds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shielded(docs: DataFrame, operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``operate`` returns, with the columns of ``docs`` whatever their names; it sees doc_id and text by name."""
    names = {c: c if c in ("doc_id", "text") else f"__own_{k}" for k, c in enumerate(docs.columns)}
    out = operate(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
