"""Benchmark decontamination: an FM-index per shard, searched backwards with the test windows.

The words of the test items make the alphabet. A shard is about ``SHARD`` bytes of documents; its
sequence holds the maximal runs of alphabet words that are at least as long as the shortest
window (no occurrence can lie elsewhere), each ended by a separator. Suffixes are sorted by prefix
doubling and end at their separator; the transform of that order is stored in a wavelet matrix
with one bit plane per bit of the alphabet. All windows are searched together, last word first,
by rank queries; occurrences are located by walking back to the next sampled suffix position, and
the spans they cover are merged per document.

Items are dealt to blocks of about ``ITEM_BLOCK`` bytes (or one longer item); tasks make the windows of each and write them
to the scratch folder. A task opens the blocks one after the other for every shard and marks what any of them hits, so a
document is read once, a row is judged alone and neither the driver nor a worker holds more than a block.

Defined results: null or wordless texts have no words and no hits; null or wordless items have no
windows; an item repeated under one item_id counts once, equal texts under two ids count as two
items. Items with a null item_id still mark words but are not listed. A document is judged by row:
repeated rows give equal results. Columns other than doc_id, text, item_id are not looked at.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm.columns import shielded
from uttera.llm.scratch import Scratch, open_file
from uttera.llm.wavelet import WaveletMatrix

WINDOW = 13
SHARD = 4 << 20
ITEM_BLOCK = 16 << 20
SAMPLE = 16


class Windows:
    """Test windows over an alphabet of word hashes; the same window of several items is kept once."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        data, off = B.column(pa.array([t for _, t in items], pa.large_string()))
        low = B.LOWER[data]
        starts, ends, bounds = B.words(low, off, B.ALNUM_WORD)
        self.alphabet, symbols = np.unique(B.range_hash(B.prefix_hash(low), starts, ends), return_inverse=True)
        symbols = symbols.astype(np.int32) + 1  # 0 separates
        found: dict[bytes, list[int]] = {}
        for k in range(len(items)):
            s = symbols[bounds[k] : bounds[k + 1]]
            size = min(window, len(s))
            for i in range(len(s) - size + 1 if size else 0):
                owners = found.setdefault(s[i : i + size].tobytes(), [])
                if not owners or owners[-1] != k:
                    owners.append(k)
        self.names = [None if i is None else str(i) for i, _ in items]
        self.owners = list(found.values())
        self.lengths = np.array([len(w) // 4 for w in found], np.int64)
        self.patterns = np.zeros((len(found), window), np.int32)  # aligned right
        for row, w in zip(self.patterns, found, strict=True):
            row[window - len(w) // 4 :] = np.frombuffer(w, np.int32)
        self.shortest = int(self.lengths.min()) if len(found) else 0

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, alphabet=self.alphabet, lengths=self.lengths, patterns=self.patterns, owners=np.array([k for o in self.owners for k in o], np.int32), sizes=np.array([len(o) for o in self.owners], np.int32), names=np.frombuffer(json.dumps(self.names).encode(), np.uint8))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Windows:
        self, a = cls.__new__(cls), np.load(io.BytesIO(raw))
        self.alphabet, self.lengths, self.patterns, self.names = a["alphabet"], a["lengths"], a["patterns"], json.loads(a["names"].tobytes())
        cut = np.cumsum(a["sizes"])[:-1]
        self.owners = [x.tolist() for x in np.split(a["owners"], cut)] if len(a["sizes"]) else []
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0
        return self

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Alphabet numbers of word hashes, 0 for words outside it."""
        if not hasattr(self, "slots"):  # an open hash table with room; colliding words go to a sorted rest
            bits = max(12, int(len(self.alphabet)).bit_length() + 3)
            self.shift = np.uint64(64 - bits)
            slot = (self.alphabet >> self.shift).astype(np.int64)
            self.slots = np.zeros(1 << bits, np.int32)
            self.slots[slot[::-1]] = np.arange(len(slot), 0, -1)
            self.rest = np.flatnonzero(self.slots[slot] != np.arange(1, len(slot) + 1))
        guess = self.slots[(hashes >> self.shift).astype(np.int64)]
        out = np.where((guess > 0) & (self.alphabet[np.maximum(guess, 1) - 1] == hashes), guess, 0).astype(np.int32)
        if len(self.rest):
            left = np.flatnonzero((guess > 0) & (out == 0))
            at = np.minimum(np.searchsorted(self.alphabet[self.rest], hashes[left]), len(self.rest) - 1)
            ok = self.alphabet[self.rest][at] == hashes[left]
            out[left[ok]] = self.rest[at[ok]] + 1
        return out


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Suffix array of a sequence of separated strings: a suffix ends at its separator (0), equal ones stand by position.

    Prefix doubling in which every separator is a symbol of its own, so only unfinished groups are sorted again.
    """
    n = len(text)
    per = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for d in range(per):
        part = np.zeros(n, np.int64)
        part[: max(n - d, 0)] = text[d:]  # a sequence can be shorter than a key
        ended |= part == 0
        part[ended] = 0
        key = key << bits | part
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    depth = per
    head = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    done = ended[order]  # those of equal keys differ only by position, as the stable sort left them
    while True:
        start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        start[done] = np.flatnonzero(done)
        rank[order] = start
        size = np.diff(np.append(np.flatnonzero(head), n))
        open_ = np.repeat(size > 1, size) & ~done
        if not open_.any():
            return order
        at = np.flatnonzero(open_)
        some = order[at]
        nxt = np.where(some + depth < n, rank[np.minimum(some + depth, n - 1)], -1)
        again = np.lexsort((some, nxt, start[at]))
        order[at] = some[again]
        s, x = start[at], nxt[again]
        head[at] = np.concatenate([[True], (s[1:] != s[:-1]) | (x[1:] != x[:-1])])
        depth *= 2


class FmIndex:
    """Backward search and location over one shard."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.n, bits = len(text), max(1, int(symbols).bit_length())
        order = suffix_order(text, bits)
        last = text[order - 1]
        last[order == 0] = 0
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.bwt = WaveletMatrix(last, bits)
        self.sampled = (order % SAMPLE == 0) | (last == 0)  # a string's first position always is
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of all patterns (aligned right), empty where one does not occur."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for step in range(patterns.shape[1]):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = patterns[live, patterns.shape[1] - 1 - step]
            lo[live] = self.first[c] + self.bwt.rank(c, lo[live])
            hi[live] = self.first[c] + self.bwt.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.sampled[rows])
        while len(todo):
            c = self.bwt.access(rows[todo])
            rows[todo] = self.first[c] + self.bwt.rank(c, rows[todo])
            steps[todo] += 1
            todo = todo[~self.sampled[rows[todo]]]
        return self.samples[self.sample_rank[rows]] + steps


def occurrences(hashes: np.ndarray, rows: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence in a shard of words, given their hashes and rows."""
    none = np.zeros(0, np.int64)
    if not len(hashes) or not len(windows.lengths):
        return none, none
    sym = windows.symbols(hashes)
    known = sym > 0
    cut = np.concatenate([[True], ~known[1:] | ~known[:-1] | (rows[1:] != rows[:-1])])
    begin = np.flatnonzero(cut)
    size = np.diff(np.append(begin, len(sym)))
    good = known[begin] & (size >= windows.shortest)
    begin, size = begin[good], size[good]
    if not len(begin):
        return none, none
    where = np.repeat(begin - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
    text = np.zeros(len(where) + len(size), np.int32)
    place = np.arange(len(where)) + np.repeat(np.arange(len(size)), size)  # one separator after each run
    text[place] = sym[where]
    back = np.zeros(len(text), np.int64)
    back[place] = where
    index = FmIndex(text, len(windows.alphabet))
    lo, hi = index.search(windows.patterns, windows.lengths)
    count = np.maximum(hi - lo, 0)
    pattern = np.repeat(np.arange(len(count)), count)
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())
    return back[index.locate(at)], pattern


_open: dict[tuple[str, int], Windows] = {}


def blocks_of(paths: list[str]) -> Iterator[Windows]:
    """Every block of windows in the files, one in memory at a time; a worker keeps the last."""
    for path in paths:
        rows = None
        for k in range(int(path.rsplit("#", 1)[1])):
            if (path, k) not in _open:
                if rows is None:
                    with open_file(path.rsplit("#", 1)[0]) as file:
                        rows = pq.read_table(file, columns=["windows"]).column(0)
                _open.clear()
                _open[path, k] = Windows.from_bytes(rows[k].as_py())
            yield _open[path, k]


def write_windows(benchmark: DataFrame, scratch: Scratch, item_block: int) -> list[str]:
    """Blocks of windows as files of the scratch folder: their paths, each with its number of blocks behind a ``#``."""
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // item_block) or 1

    def make(table: pa.Table) -> pa.Table:
        order = table.sort_by([("item_id", "ascending"), ("text", "ascending")])
        windows = Windows(list(zip(order.column("item_id").to_pylist(), order.column("text").to_pylist(), strict=True)))
        return pa.table({"windows": pa.array([windows.to_bytes()], pa.binary())})

    dealt = items.groupBy(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")).applyInArrow(make, "windows binary")
    written = scratch.save(dealt, "windows")
    counts = written.groupBy(F.input_file_name().alias("path")).count().collect()  # one number a block at most
    return sorted(f"{r[0]}#{r[1]}" for r in counts)


def find(paths: list[str]):
    """mapInArrow function: appends n_words, merged word and byte spans, and the items found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap()
        for batch, data, off in B.blocks(batches, limit=SHARD):
            low = B.LOWER[data]
            starts, ends, bounds = B.words(low, off, B.ALNUM_WORD)
            rows, hashes = B.rows_of(bounds), B.range_hash(B.prefix_hash(low), starts, ends)
            edge = np.zeros(len(starts) + 1, np.int64)
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for windows in blocks_of(paths):
                first, pattern = occurrences(hashes, rows, windows)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + windows.lengths[pattern], -1)
                for r, p in set(zip(rows[first].tolist(), pattern.tolist(), strict=True)):
                    items[r].update(windows.names[k] for k in windows.owners[p])
            hit = np.cumsum(edge[:-1]) > 0
            begin = hit & np.concatenate([[True], ~hit[:-1] | (rows[1:] != rows[:-1])])[: len(hit)]
            stop = hit & np.concatenate([~hit[1:] | (rows[1:] != rows[:-1]), [True]])[: len(hit)]
            b, e = np.flatnonzero(begin), np.flatnonzero(stop)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, j in zip(b.tolist(), e.tolist(), strict=True):
                r = int(rows[i])
                spans[r].append({"first": i - int(bounds[r]), "last": j - int(bounds[r]), "byte_start": int(starts[i] - off[r]), "byte_end": int(ends[j] - off[r])})
            listed = [sorted(i for i in x if i is not None) for x in items]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(bounds)), pa.array(spans, SPANS_ARROW), pa.array(listed, pa.list_(pa.string()))], [*batch.schema.names, "n_words", "spans", "items"])

    return run


SPANS_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("byte_start", pa.int64()), ("byte_end", pa.int64())]))
SPANS = "array<struct<first:bigint,last:bigint,byte_start:bigint,byte_end:bigint>>"
FOUND = f", n_words long, spans {SPANS}, items array<string>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, item_block: int = ITEM_BLOCK) -> DataFrame:
    """Columns of ``docs`` and n_words, spans (merged, in words and bytes), items, n_hit, contaminated."""
    paths = write_windows(benchmark, scratch, item_block)
    left = docs.select(*[c for c in docs.columns if c not in {"n_words", "spans", "items", "n_hit", "contaminated"}])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields)
    found = left.mapInArrow(find(paths), kinds + FOUND)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return found.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark, "contamination"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are not contaminated."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return shielded(docs, lambda d: decontaminate(d, items, Scratch(spark, "contamination")).where(~F.col("contaminated")))
