"""Payloads from many senders to many receivers, with as many rows as the bytes need and not one a pair.

A sender makes one row for each receiver that it has something for. With up to ``FAN`` receivers these rows are exchanged as
they are. Beyond that they travel in two steps: a sender's rows for neighbouring receivers are packed into one of ``FAN`` rows,
the parts that arrive together (about ``PART`` bytes) are sorted by receiver and go on as one row for each. So a sender
makes at most ``FAN`` rows a batch, whatever the number of receivers, and receivers get a row from each part, not from each sender.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 1024
PART = 128 << 20


def gathered(rows: pa.Table | pa.RecordBatch, key: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Distinct keys, ascending, and a list of the rows of each as structs."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))[: len(k)]
    sorted_ = rows.take(pa.array(order))
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in sorted_.columns]
    columns = [pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    items = pa.StructArray.from_arrays(columns, fields=list(sorted_.schema))
    return k[cut], pa.ListArray.from_arrays(pa.array(np.append(cut, len(k)), pa.int32()), items)


def scattered(items: pa.Array | pa.ChunkedArray) -> pa.Table:
    """The rows of lists of structs."""
    chunks = items.chunks if isinstance(items, pa.ChunkedArray) else [items]
    tables = [pa.Table.from_batches([pa.RecordBatch.from_struct_array(c.flatten())]) for c in chunks]
    kind = items.type.value_type
    return pa.concat_tables(tables) if tables else pa.schema([kind.field(k) for k in range(kind.num_fields)]).empty_table()


def rows_again(table: pa.Table) -> pa.Table:
    """A table as its sender made it, whether it was exchanged in one step or two."""
    return scattered(table.column("items")) if "items" in table.column_names else table


def flat(f: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``f`` of rows that were exchanged."""
    return lambda table: f(rows_again(table))


def flat_second(f: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``f`` of two tables, the second of rows that were exchanged."""
    return lambda first, second: f(first, rows_again(second))


def exchanged(rows: DataFrame, to: str, receivers: int, size: int) -> DataFrame:
    """The rows, to be grouped by ``to`` (integers below ``receivers``) and given to ``flat`` functions. Their last column is bytes; ``size`` is about what they weigh."""
    if receivers <= FAN:
        return rows
    width = -(-receivers // FAN)
    item = f"array<{rows.schema.simpleString()}>"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                coarse, items = gathered(batch, batch.column(batch.schema.get_field_index(to)).to_numpy() // width)
                salt = zlib.crc32(b"".join(x.as_py()[:64] for x in batch.column(batch.num_columns - 1)[:64]))  # the last column is bytes
                yield pa.RecordBatch.from_arrays([pa.array(coarse.astype(np.int64)), pa.array([salt] * len(coarse), pa.int64()), items], ["coarse", "salt", "items"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        weight = 0
        for batch in batches:
            if batch.num_rows:
                held.append(scattered(batch.column(batch.schema.get_field_index("items"))))
                weight += batch.nbytes
            if weight >= PART:
                yield out(held)
                held, weight = [], 0
        if held:
            yield out(held)

    def out(held: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(held)
        key, items = gathered(table, table.column(to).to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(key).cast(table.schema.field(to).type), items], [to, "items"])

    kind = rows.schema[to].dataType.simpleString()
    parts = max(FAN, -(-size // PART))
    packed = rows.mapInArrow(pack, f"coarse long, salt long, items {item}")
    return packed.repartition(parts, "coarse", F.pmod("salt", F.lit(-(-parts // FAN)))).select("items").mapInArrow(merge, f"`{to}` {kind}, items {item}")
