"""Hierarchical multi-length packing of token ids.

A document's ids (with the end id) are cut at full windows of ``TIERS[0]``; the rest is routed to
the shortest context-size tier that holds it. Each tier's pieces open windows of that size, longest
first; the gap is filled with the longest fitting pieces of shorter tiers, and what is then left of
it with a cut from the next longer one. So windows are full, and their sizes are powers of two.
At the end of a task the few ids that fill no window become sequences of descending powers of two,
so nothing is padded at all. Sequences are dealt to step groups of about ``STEP`` tokens, longest
first to the lightest group, so that groups weigh the same and mix the tiers.

Packing is local to a task and reads each text once: no shuffle, and only pieces that still wait
for a window (at most ``WAIT`` tokens) are held. Sequence numbers carry the task's partition number.

Defined results: null or empty text is the end id alone; repeated rows are packed once each; a
very long text is many full windows and one rest; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from uttera.llm import bytesops as B
from uttera.llm.tokens import Encoder, with_end

TIERS = (2048, 1024, 512, 256)
WAIT = 4 << 20
STEP = 16 * 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, step_group long"


class Packer:
    """Windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, wait: int = WAIT, step: int = STEP):
        self.base, self.tiers, self.wait, self.step = task << 32, tiers, wait, step
        self.shelf: list[list] = [[] for _ in range(tiers[0])]  # pieces by length
        self.lengths, self.waiting = 0, 0  # bit n: a piece of n ids waits
        self.sequences = self.groups = 0
        self.full: list[list] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, top = len(ids), self.tiers[0]
        for a in range(0, n - n % top, top):
            self.full.append([(doc_id, a, ids[a : a + top], n)])
        if n % top:
            self._put((doc_id, n - n % top, ids[n - n % top :].copy(), n))

    def ready(self) -> bool:
        return self.waiting + sum(len(p[2]) for s in self.full[:1] for p in s) * len(self.full) > self.wait

    def _put(self, piece) -> None:
        n = len(piece[2])
        self.shelf[n].append(piece)
        self.lengths |= 1 << n
        self.waiting += n

    def _take(self, n: int):
        piece = self.shelf[n].pop()
        if not self.shelf[n]:
            self.lengths &= ~(1 << n)
        self.waiting -= n
        return piece

    def _cut(self, n: int, size: int):
        doc_id, start, ids, total = self._take(n)
        self._put((doc_id, start + size, ids[size:], total))
        return doc_id, start, ids[:size], total

    def _fill(self) -> list[list]:
        """Full windows of the waiting pieces, tier by tier; unfilled openings come back as rests."""
        rests = []
        for k, tier in enumerate(self.tiers):
            shorter = self.tiers[k + 1] if k + 1 < len(self.tiers) else 0
            while (n := (self.lengths & ((1 << (tier + 1)) - 1)).bit_length() - 1) > shorter:
                window, gap = [self._take(n)], tier - n
                while gap:
                    fit = self.lengths & ((1 << (gap + 1)) - 1)
                    if fit:
                        m = fit.bit_length() - 1
                        window.append(self._take(m))
                    else:
                        longer = self.lengths >> (gap + 1) & ((1 << max(tier - gap - 1, 0)) - 1)
                        if not longer:
                            break
                        m = gap
                        window.append(self._cut(gap + 1 + (longer & -longer).bit_length() - 1, gap))
                    gap -= m
                (rests if gap else self.full).append(window)
        return rests

    def flush(self, last: bool) -> Iterator[tuple]:
        """Rows of every full window; with ``last`` of everything."""
        rests = self._fill()
        loose = [p for w in rests for p in w]
        if not last:
            for p in loose:
                self._put(p)
        while last and loose:
            total = sum(len(p[2]) for p in loose)
            size = min(self.tiers[0], 1 << (total.bit_length() - 1))
            window = []
            while size:
                doc_id, start, ids, n = loose.pop(0)
                if len(ids) > size:
                    loose.insert(0, (doc_id, start + size, ids[size:], n))
                    ids = ids[:size]
                window.append((doc_id, start, ids, n))
                size -= len(ids)
            self.full.append(window)
        sized = sorted(((sum(len(p[2]) for p in w), w) for w in self.full), key=lambda x: -x[0])
        self.full = []
        count = max(1, -(-sum(s for s, _ in sized) // self.step))
        heap = [(0, self.groups + g) for g in range(count)] if sized else []
        self.groups += len(heap)
        for size, window in sized:
            load, group = heapq.heappop(heap)
            heapq.heappush(heap, (load + size, group))
            offset, sequence = 0, self.base + self.sequences
            self.sequences += 1
            for doc_id, start, ids, total in window:
                yield doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset, size, self.base + group
                offset += len(ids)


def pack_rows(path: str):
    names = [c.split()[0] for c in PIECES.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap(encoders=True)
        encoder, packer = Encoder.of(path), Packer(TaskContext.get().partitionId())
        for rows, data, off in B.blocks(batches):
            ids, bounds = with_end(*encoder.encode(data, off))
            for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                packer.add(doc_id, ids[a:b])
            if packer.ready():
                yield batch(list(packer.flush(False)))
        yield batch(list(packer.flush(True)))

    return run


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of all documents; ``window`` is the sequence's length, ``step_group`` its step."""
    return docs.select("doc_id", "text").mapInArrow(pack_rows(tokenizer), PIECES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
