"""Periodic runs: maximal stretches of words with a smallest period that they hold at least four times.

All runs of a text come from its Lempel-Ziv blocks, which come from longest previous factors:

1. Word numbers are sorted into a suffix array by prefix doubling. The rank of every doubling is kept: equal ranks mean equal
   stretches of that many words, so common extensions of two places to the right or left are read off exactly in one step a doubling.
2. The previous and the next smaller place in suffix order give the longest previous factor of every place and where it stands;
   factors laid end to end are the Lempel-Ziv blocks.
3. A run that touches a block's edge is found there by extending in both directions for each period up to the block's length. That is enough
   for runs of three periods or more: behind its first period at most one block begins inside a run, as such a block reaches
   the run's end; so a run that isn't strictly inside one block has an edge with a block as long as the period beside it.
4. A run strictly inside a block stands in the block's earlier copy too: runs are put in buckets by their start, and blocks copy
   what their source holds, from left to right.

Texts of a batch are worked on together as one sequence in which no two texts share a symbol. A text whose windows of ``WINDOW`` words all differ
can't hold a run (six equal words, or four periods, repeat such a window) and takes part in none of this. Every text is
judged alone and whole, in a map: no shuffle, and hot groups play no part.

Defined results: null or wordless texts have no runs and an empty collapsed text; repeated rows give equal results. Words are told apart by 64-bit
hashes. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B

TIMES = 4
LEAST = 6
WINDOW = LEAST - 1
SHARE = 10  # one document in so many is made periodic by the query

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RESULT = f"doc_id long, runs {RUNS}, start long, length long, period long, collapsed string"


class Extensions:
    """Suffix array of a sequence of numbers, and common extensions of any two of its places."""

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        s = symbols[order]
        head = np.concatenate([[True], s[1:] != s[:-1]])[:n]
        start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank = np.empty(n, np.int32)
        rank[order] = start
        self.levels, self.group = [rank], start
        depth = 1
        while True:
            size = np.diff(np.append(np.flatnonzero(head), n))
            at = np.flatnonzero(np.repeat(size > 1, size))
            if not len(at):
                break
            some = order[at]
            nxt = np.where(some + depth < n, rank[np.minimum(some + depth, n - 1)], -1)
            again = np.lexsort((nxt, start[at]))
            order[at] = some[again]
            b, x = start[at], nxt[again]
            new = np.concatenate([[True], (b[1:] != b[:-1]) | (x[1:] != x[:-1])])
            head[at] = new
            start = start.copy()
            start[at] = np.maximum.accumulate(np.where(new, at, 0))
            rank = rank.copy()
            rank[order[at]] = start[at]
            self.levels.append(rank)
            depth *= 2
        self.order = order

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from places i and j on are equal (i and j differ; places up to n)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i + out, j + out
            ok = np.maximum(a, b) < self.n
            rank = self.levels[k]
            out[ok & (rank[np.minimum(a, self.n - 1)] == rank[np.minimum(b, self.n - 1)])] += 1 << k
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before places i and j are equal."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i - out - (1 << k), j - out - (1 << k)
            ok = np.minimum(a, b) >= 0
            rank = self.levels[k]
            out[ok & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)])] += 1 << k
        return out

    def smaller(self, step: int) -> np.ndarray:
        """For each place in suffix order, the nearest one before (step -1) or behind (1) that stands earlier in the text and begins with the same symbol; -1 if none."""
        a, n = self.order[::-step], self.n
        group = self.group if step < 0 else (n - 1 - self._last())[::-1]  # first place of the group in this direction
        sizes = np.arange(n) - group
        least = [a]
        while 1 << len(least) <= int(sizes.max(initial=0)):
            half = 1 << (len(least) - 1)
            m = least[-1].copy()
            m[half:] = np.minimum(m[half:], least[-1][:-half])
            least.append(m)
        at = np.arange(n) - 1
        for k in range(len(least) - 1, -1, -1):
            ok = at - (1 << k) + 1 >= group
            ok &= least[k][np.maximum(at, 0)] > a
            at[ok] -= 1 << k
        found = np.where(at >= group, at, -1)
        return found if step < 0 else np.where(found >= 0, n - 1 - found, -1)[::-1]

    def _last(self) -> np.ndarray:
        """Last place in suffix order with the same first symbol."""
        edge = np.append(np.flatnonzero(np.diff(self.group)), self.n - 1)
        return edge[np.searchsorted(edge, np.arange(self.n))]

    def previous_factors(self) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest factor at each place that also begins earlier, and where; 0 and -1 if there is none."""
        length, source = np.zeros(self.n, np.int64), np.full(self.n, -1, np.int64)
        for step in (-1, 1):
            near = self.smaller(step)
            some = np.flatnonzero(near >= 0)
            i, j = self.order[some], self.order[near[some]]
            size = self.right(i, j)
            better = size > length[i]
            length[i[better]], source[i[better]] = size[better], j[better]
        return length, source


def blocks(length: np.ndarray) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks."""
    steps, out, i = np.maximum(length, 1).tolist(), [], 0
    while i < len(steps):
        out.append(i)
        i += steps[i]
    return np.array(out, np.int64)


def runs_of(symbols: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs of a sequence, by start and end."""
    none = np.zeros((0, 3), np.int64)
    if len(symbols) < LEAST:
        return none
    ext = Extensions(symbols)
    factor, source = ext.previous_factors()
    first = blocks(factor)
    size = np.maximum(factor[first], 1)
    period = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + 1
    found = []
    # at a block's start the first period lies behind the edge, at its end before it
    edge = np.repeat(first, size)
    some = np.flatnonzero(edge + period < ext.n)
    some = some[symbols[edge[some]] == symbols[edge[some] + period[some]]]
    b, p = edge[some], period[some]
    found.append((b - ext.left(b, b + p), b + p + ext.right(b, b + p), p))
    edge = np.repeat(first + size, size)
    some = np.flatnonzero(edge - 1 - period >= 0)
    some = some[symbols[edge[some] - 1] == symbols[edge[some] - 1 - period[some]]]
    b, p = edge[some], period[some]
    found.append((b - p - ext.left(b - p, b), b + ext.right(b - p, b), p))
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    long = end - start >= np.maximum(LEAST, TIMES * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[: len(start)]  # a multiple of the period has the same bounds
    bucket: dict[int, dict[int, int]] = {}
    for s, e, p in zip(start[least].tolist(), end[least].tolist(), period[least].tolist(), strict=True):
        bucket.setdefault(s, {})[e] = p
    if not bucket:
        return none
    wide = np.flatnonzero(size >= LEAST + 2)
    for f, n, at in zip(first[wide].tolist(), size[wide].tolist(), source[first[wide]].tolist(), strict=True):
        for s in range(at + 1, at + n - LEAST):
            if s in bucket:
                for e, p in list(bucket[s].items()):
                    if e < at + n:
                        bucket.setdefault(s + f - at, {})[e + f - at] = p
    return np.array(sorted((s, e, p) for s, ends in bucket.items() for e, p in ends.items()), np.int64)


def rows_with_repeats(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows in which some window of ``WINDOW`` words occurs twice."""
    grams, edges = B.grams(hashes, bounds, WINDOW)
    rows = B.rows_of(edges)
    key = B.mix(grams + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    again = order[1:][key[order[1:]] == key[order[:-1]]]
    return np.unique(rows[again])


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    B.keep_heap()
    for batch, data, off in B.blocks(batches):
        starts, ends, bounds = B.words(data, off, B.SPACE_WORD)
        hashes = B.range_hash(B.prefix_hash(data), starts, ends)
        some = rows_with_repeats(hashes, bounds)
        runs: dict[int, list[tuple[int, int, int]]] = {}
        if len(some):
            size = np.diff(bounds)[some]
            edge = np.concatenate([[0], np.cumsum(size)])
            row = np.repeat(np.arange(len(some)), size)
            word = hashes[np.repeat(bounds[some] - edge[:-1], size) + np.arange(edge[-1])]
            symbols = np.unique(B.mix(word + (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)), return_inverse=True)[1]
            for s, e, p in runs_of(symbols).tolist():
                k = int(row[s])
                runs.setdefault(int(some[k]), []).append((s - int(edge[k]), e - s, p))
        top, listed, collapsed = [], [], []
        text = bytes(data)
        for k in range(batch.num_rows):
            own = sorted(runs.get(k, ()), key=lambda r: (r[0], r[2]))
            words = text[off[k] : off[k + 1]].split()  # at the same bytes as SPACE_WORD
            best = (None, None, None)
            if own:
                best = own[0]
                keep = np.ones(len(words), bool)
                for r in own:
                    keep[r[0] + r[2] : r[0] + r[1]] = False
                    if r[1] * best[2] > best[1] * r[2]:
                        best = r
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            top.append(best)
            listed.append([{"start": s, "length": n, "period": p} for s, n, p in own])
            collapsed.append(b" ".join(words))
        columns = [pa.array([t[j] for t in top], pa.int64()) for j in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, RUNS_ARROW), *columns, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "start", "length", "period", "collapsed"])


def repetitions(docs: DataFrame) -> DataFrame:
    """RESULT of every row: runs by start and period, the one of the greatest exponent, and the text without repeated periods."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, RESULT)


def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One document in ``SHARE``, by the checksum of its doc_id, from some word on repeats the words that stand there."""
    for batch in batches:
        texts = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            h = 1 if i is None else zlib.crc32(str(i).encode())
            text = t.as_py()
            if h % SHARE == 0 and text and (w := text.encode().split()):
                n, g = len(w), h // SHARE
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = b" ".join(w[:a] + [w[a + k % p] for k in range(n - a)]).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, batch.schema.field(1).type)], ["doc_id", "text"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = repetitions(docs.mapInArrow(stretched, "doc_id long, text string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
