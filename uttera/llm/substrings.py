"""Suffix-array dedup: bytes that an earlier document already has in a 50-byte string are removed.

Two equal strings of ``LENGTH`` bytes choose the same anchor: the least hash among their
``GRAM``-byte substrings, the leftmost of equals. So equal strings always meet where their anchor
is sent, and the work is spread by anchors without loss:

A. Documents are dealt to blocks of about ``BLOCK_BYTES``. A block sends 40 bits of each of its distinct anchors
   once to hash buckets, however many documents have it; a bucket answers with one bit for each: whether another
   document may have the same anchor.
B. For the anchors that repeat, a block sends the bytes of all strings that chose it (their
   *context*, under 2 * LENGTH bytes), equal contexts once with the least doc_id that has them, to the bucket, however often the block has them. There the contexts are
   sorted into a suffix array (prefix doubling from packed 8-byte keys), and their
   longest-previous-factor array is read off it: the common prefix with the previous or next smaller
   document in suffix order, whichever is longer. A string with a factor of ``LENGTH`` or more repeats an earlier document.
C. The answers, a bit for each string of a context, go back to the blocks, which know where their contexts stand and mark, count and cut the bytes.

Contexts are told apart by 64-bit hashes. Hot groups: what a block sends of an anchor or context does not grow with the documents or places that have it, so
one that a third of all documents share comes to its bucket once a block. Payloads travel through ``exchange``, so rows grow with the bytes, not with
blocks times buckets. Nothing is collected on the driver.

Defined results: null text is empty; texts shorter than ``LENGTH`` are kept whole; rows with equal
doc_id don't remove each other's bytes; rows with a null doc_id lose nothing and remove nothing.
Matches never cross documents. Strings are judged on the input, not on what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm.exchange import exchanged, flat, flat_second
from uttera.llm.scratch import Scratch

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20
LEAST = 32
DEPTH = 2 * LENGTH - GRAM  # the longest context
PARTS = 8  # context buckets for one of anchors: contexts weigh more
_U = np.uint64
_POSITION = _U((1 << 24) - 1)


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, first and last start of the strings that chose it) of a slice of texts."""
    none = np.zeros(0, np.int64)
    n, width = len(data), LENGTH - GRAM + 1
    long = np.flatnonzero(np.diff(off) >= LENGTH)
    if not len(long):
        return none.astype(_U), none, none
    if n > int(_POSITION):  # one very long text: its strings in overlapping pieces
        parts, step = [], 8 << 20
        for a in range(0, n - LENGTH + 1, step):
            h, s, e = anchors(data[a : min(n, a + step + LENGTH - 1)], np.array([0, min(n, a + step + LENGTH - 1) - a]))
            parts.append((h, s + a, e + a))
        return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))
    prefix = B.prefix_hash(data)
    m = n - GRAM + 1
    down = B.powers(n + 1)[1][:m]
    h = (prefix[GRAM:] - prefix[:m]) * down
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    least = (h & ~_POSITION) | np.arange(m, dtype=_U)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    at = (least & _POSITION).astype(np.int64)  # anchor of the string that starts at each position
    valid = np.zeros(n + 1, np.int32)
    np.add.at(valid, off[:-1][long], 1)
    np.add.at(valid, off[1:][long] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[: len(at)]))
    chosen = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.append(new[1:], len(starts)) - 1
    return h[chosen[new]], starts[new], starts[last]


class Block:
    """The rows of a block in an order that does not depend on how they arrive."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.data, self.off = B.column(self.table.column("text"))
        ids = self.table.column("doc_id")
        self.named = ~ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, -(1 << 63)).to_numpy()

    def slices(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        a, n = 0, len(self.off) - 1
        while a < n:
            b = min(n, max(a + 1, int(np.searchsorted(self.off, self.off[a] + B.BLOCK, "right")) - 1))
            yield a, b, self.data[self.off[a] : self.off[b]], self.off[a : b + 1] - self.off[a]
            a = b

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """hash, row, first and last start (in the block's bytes) of every anchor of the named rows."""
        parts = []
        for a, _, data, off in self.slices():
            h, s, e = anchors(data, off)
            row = np.searchsorted(off, s, "right") - 1 + a
            keep = self.named[row]
            parts.append((h[keep], row[keep], s[keep] + self.off[a], e[keep] + self.off[a]))
        if not parts:
            return np.zeros(0, _U), *(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate([p[k] for p in parts]) for k in range(4))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h & _U(0xFFFFFF)) % _U(buckets)).astype(np.int64)


def distinct_anchors(h: np.ndarray, doc: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, 40 bits) in order: buckets, tokens, whether several documents have it, and each anchor's place among them."""
    bucket = bucket_of(h, buckets)
    key = (bucket.astype(_U) << _U(40)) | (h >> _U(24))
    order = np.argsort(key)
    k = key[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])[: len(k)]
    edge = np.flatnonzero(new)
    d = doc[order]
    several = np.minimum.reduceat(d, edge) != np.maximum.reduceat(d, edge) if len(edge) else np.zeros(0, bool)
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(new) - 1
    return (k[edge] >> _U(40)).astype(np.int64), k[edge] & _U((1 << 40) - 1), several, place


def send_anchors(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        B.keep_heap()
        block = Block(table)
        h, row, _, _ = block.anchors()
        bucket, token, several, _ = distinct_anchors(h, block.ids[row], buckets)
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(edge)).tolist()
        body = token.view(np.uint8).reshape(-1, 8)[:, :5]
        out = [np.int64(edge[b + 1] - edge[b]).tobytes() + body[edge[b] : edge[b + 1]].tobytes() + np.packbits(several[edge[b] : edge[b + 1]]).tobytes() for b in some]
        return pa.table({"bucket": pa.array(some, pa.int32()), "block": pa.array([table.column("block")[0].as_py()] * len(some), pa.int64()), "payload": pa.array(out, pa.binary())})

    return run


def answer_anchors(table: pa.Table) -> pa.Table:
    """For each block's anchors in this bucket, a bit: it repeats in another document, here or elsewhere."""
    tokens, several, sizes = [], [], []
    for x in table.column("payload"):
        raw = x.as_buffer()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :5] = np.frombuffer(raw, np.uint8, 5 * n, 8).reshape(n, 5)
        tokens.append(wide.view(_U).ravel())
        several.append(np.unpackbits(np.frombuffer(raw, np.uint8, offset=8 + 5 * n), count=n))
        sizes.append(n)
    token, many = np.concatenate(tokens), np.concatenate(several).astype(bool)
    order = np.argsort(token)
    t = token[order]
    same = t[1:] == t[:-1]
    repeated = many.copy()
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edge = np.concatenate([[0], np.cumsum(sizes)])
    bits = [np.packbits(repeated[a:b]).tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def send_contexts(buckets: int, parts: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        B.keep_heap()
        empty = pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
        if not docs.num_rows or not answers.num_rows:
            return empty
        block = Block(docs)
        h, row, first, last = block.anchors()
        bucket, _, _, place = distinct_anchors(h, block.ids[row], buckets)
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        repeated = np.zeros(len(bucket), bool)
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True):
            repeated[edge[b] : edge[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=edge[b + 1] - edge[b])
        some = np.flatnonzero(repeated[place])
        row, first, size, owner = row[some], first[some], (last - first)[some] + LENGTH, bucket_of(h[some], buckets * parts)
        key = np.empty(len(some), _U)
        for a, b, data, _ in block.slices():
            lo, hi = np.searchsorted(row, [a, b])
            s = first[lo:hi] - block.off[a]
            key[lo:hi] = B.range_hash(B.prefix_hash(data), s, s + size[lo:hi])
        order = np.lexsort((block.ids[row], key, owner))
        k, o = key[order], owner[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])[: len(k)]
        number = np.cumsum(new) - 1
        lead = order[new]  # of each context the occurrence in the least document
        out_bucket, out, first_of = [], [], np.zeros(buckets * parts + 1, np.int64)
        cut = np.searchsorted(o, np.arange(buckets * parts + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            first_of[b] = number[cut[b]]
            heads = lead[number[cut[b]] : number[cut[b + 1] - 1] + 1]
            sizes = size[heads]
            at = np.repeat(first[heads] - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes) + np.arange(sizes.sum())
            head = np.array([len(heads), len(at)], np.int64)
            out.append(b"".join(x.tobytes() for x in (head, block.ids[row[heads]], sizes.astype(np.uint8), block.data[at])))
            out_bucket.append(b)
        me = docs.column("block")[0].as_py()
        if len(order):  # where the contexts stand comes back to this block as it is, past the buckets
            ids = block.ids[row[order]]
            least = ids == ids[np.flatnonzero(new)][number]
            own = (o.astype(np.uint32), ((number - first_of[o]).astype(np.uint32) << np.uint32(1)) | least.astype(np.uint32), row[order].astype(np.uint32), (first[order] - block.off[row[order]]).astype(np.uint32))
            out.append(b"".join(x.tobytes() for x in own))
            out_bucket.append(buckets * parts + me)
        return pa.table({"bucket": pa.array(out_bucket, pa.int32()), "block": pa.array([me] * len(out), pa.int64()), "payload": pa.array(out, pa.binary())})

    return run


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 0 of keys, equal for equal ones."""
    order = np.argsort(keys)
    k = keys[order]
    out = np.empty(len(k), _U)
    out[order] = np.cumsum(np.concatenate([[False], k[1:] != k[:-1]])).astype(_U)
    return out


def suffix_array(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the given starts by their first ``DEPTH`` bytes, ties by start, and whether each equals its predecessor for ``LENGTH``."""
    n = len(text)
    wide = np.zeros(n + DEPTH + 8, _U)
    wide[:n] = text
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        wide[:-step] = (wide[:-step] << _U(bits)) | wide[step:]
    rank, depth = dense(wide[: n + DEPTH]), 8
    while 2 * depth <= LENGTH:
        rank = dense((rank[: len(rank) - depth] << _U(32)) | rank[depth:])
        depth *= 2
    key = (rank[starts] << _U(32)) | rank[starts + (LENGTH - depth)]
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.concatenate([[False], k[1:] == k[:-1]])[: len(k)]
    beside = same.copy()
    beside[:-1] |= same[1:]
    at = np.flatnonzero(beside)  # equal for LENGTH: what follows decides
    some = order[at]
    order[at] = some[np.lexsort((some, rank[np.minimum(starts[some] + (DEPTH - depth), len(rank) - 1)], key[some]))]
    return order, same


def smaller_neighbours(docs: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the previous and next suffix, in suffix order, of a smaller document that shares ``LENGTH`` bytes; -1 if there is none.

    ``same`` says that a suffix equals its predecessor to that length. Pointers are followed in both directions
    until they meet a smaller document or a shorter common prefix.
    """
    n = len(docs)
    group = np.cumsum(~same)
    found = []
    for step in (-1, 1):
        out = np.full(n, -1, np.int64)
        at = np.arange(n)
        todo = np.arange(n)
        hop = np.full(n, step)
        while len(todo):
            nxt = at[todo] + hop[todo]
            inside = (nxt >= 0) & (nxt < n)
            todo, nxt = todo[inside], nxt[inside]
            inside = group[nxt] == group[todo]
            todo, nxt = todo[inside], nxt[inside]
            smaller = docs[nxt] < docs[todo]
            out[todo[smaller]] = nxt[smaller]
            todo, nxt = todo[~smaller], nxt[~smaller]
            # what stands between a place and its pointer is not smaller than it: jump over it
            at[todo] = nxt
            hop[todo] = step
            if len(todo):
                far = at[nxt]
                ok = docs[nxt] >= docs[todo]
                at[todo[ok]] = np.where((far[ok] - nxt[ok]) * step > 0, far[ok], nxt[ok])
        found.append(out)
    return found[0], found[1]


def previous_factors(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Longest-previous-factor array: for the string at each start, how many bytes up to its context's end an earlier document has.

    The longer common prefix with the previous and with the next smaller document in suffix order, from ``LENGTH`` on; 0 if shorter.
    """
    order, same = suffix_array(text, starts)
    out = np.zeros(len(starts), np.int64)
    for near in smaller_neighbours(docs[order], same):
        at = np.flatnonzero(near >= 0)
        mine, other = order[at], order[near[at]]
        length = np.full(len(at), LENGTH)
        room = np.minimum(ends[mine] - starts[mine], ends[other] - starts[other])
        todo = np.flatnonzero(room > LENGTH)
        while len(todo):
            todo = todo[text[starts[mine[todo]] + length[todo]] == text[starts[other[todo]] + length[todo]]]
            length[todo] += 1
            todo = todo[length[todo] < room[todo]]
        out[mine] = np.maximum(out[mine], length)
    return out


LEAST_BIT = np.uint32(1 << 31)


def answer_contexts(buckets: int):
    """For each block, what of its contexts repeats an earlier document: for each a bit a string, and how many strings there are.

    The bits hold for the least document with the context, if the block has it (``LEAST_BIT``); every other one repeats the whole of it.
    What a block sends to itself goes back as it is.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= buckets:
            return pa.table({"block": table.column("block"), "bucket": pa.array([-1] * table.num_rows, pa.int32()), "payload": table.column("payload")})
        sizes, texts, docs = [], [], []
        for x in table.column("payload"):
            raw = x.as_buffer()
            heads, total = np.frombuffer(raw, np.int64, 2).tolist()
            docs.append(np.frombuffer(raw, np.int64, heads, 16))
            sizes.append(np.frombuffer(raw, np.uint8, heads, 16 + 8 * heads))
            texts.append(np.frombuffer(raw, np.uint8, total, 16 + 9 * heads))
        size, text, doc = np.concatenate(sizes).astype(np.int64), np.concatenate(texts), np.concatenate(docs)
        begin = np.concatenate([[0], np.cumsum(size)])
        which = dense(B.range_hash(B.prefix_hash(text), begin[:-1], begin[1:])).astype(np.int64)  # the same context of several blocks
        distinct = int(which.max()) + 1
        least = np.full(distinct, np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        seen = np.empty(distinct, np.int64)
        seen[which[::-1]] = np.arange(len(which))[::-1]
        by_doc = np.argsort(least, kind="stable")
        lead = seen[by_doc]
        strings = size[lead] - LENGTH + 1
        new = np.concatenate([[0], np.cumsum(size[lead])])
        text = text[np.repeat(begin[:-1][lead] - new[:-1], size[lead]) + np.arange(new[-1])]
        edge = np.concatenate([[0], np.cumsum(strings)])
        starts = np.repeat(new[:-1] - edge[:-1], strings) + np.arange(edge[-1])
        factor = previous_factors(text, starts, np.repeat(new[1:], strings), np.repeat(least[by_doc], strings))
        hit = factor >= LENGTH
        mask = np.zeros(distinct, np.uint32)
        offset = np.arange(edge[-1]) - np.repeat(edge[:-1], strings)
        np.bitwise_or.at(mask, np.repeat(by_doc, strings)[hit], np.uint32(1) << offset[hit].astype(np.uint32))
        answer = np.where(doc == least[which], mask[which] | LEAST_BIT, np.uint32(0)).astype(np.uint32)
        cut = np.cumsum([0, *map(len, docs)])
        out = [answer[a:b].tobytes() + (size[a:b] - LENGTH + 1).astype(np.uint8).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "payload": pa.array(out, pa.binary())})

    return run


def repeats_of(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place of the first string and bits of the strings that repeat an earlier document, for each place of a context in a block."""
    none = np.zeros(0, np.uint32)
    bucket = answers.column("bucket").to_numpy()
    own = np.flatnonzero(bucket < 0)
    if not len(own):
        return none, none, none
    o, number, row, place = np.frombuffer(answers.column("payload")[int(own[0])].as_buffer(), np.uint32).reshape(4, -1)
    found = np.zeros(len(o), np.uint32)
    for b, x in zip(bucket.tolist(), answers.column("payload"), strict=True):
        if b >= 0:
            raw = x.as_buffer()
            n = len(raw) // 5
            answer, strings = np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.uint8, n, 4 * n)
            mine = slice(*np.searchsorted(o, [b, b + 1]).tolist())  # ascending by bucket
            at, least = number[mine] >> np.uint32(1), (number[mine] & np.uint32(1)).astype(bool)
            whole = ((np.int64(1) << strings.astype(np.int64)) - 1).astype(np.uint32)
            found[mine] = np.where(least & ((answer[at] & LEAST_BIT) != 0), answer[at] & ~LEAST_BIT, whole[at])
    some = found != 0
    return row[some], place[some], found[some]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut_bytes(with_bytes: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(docs)
        found = np.zeros(len(block.data) + 1, bool)
        row, place, mask = repeats_of(answers)
        at = block.off[row] + place
        for j in range(LENGTH - GRAM + 1):
            found[at[(mask >> np.uint32(j)) & np.uint32(1) != 0] + j] = True
        n = docs.num_rows
        removed, spans, digests, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
        for a, b, data, off in block.slices():
            win = found[block.off[a] : block.off[b]].astype(np.int32)
            depth = np.cumsum(win)
            depth[LENGTH:] -= depth[:-LENGTH].copy()
            gone = depth > 0
            removed[a:b] = B.sum_rows(gone, off)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            first = off[:-1][off[:-1] < off[1:]]
            begins[first] = gone[first]
            spans[a:b] = B.sum_rows(begins, off)
            rest = data[~gone]
            at = np.concatenate([[0], np.cumsum(np.diff(off) - removed[a:b])])
            raw = memoryview(np.ascontiguousarray(rest))
            digests += [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            if with_bytes:
                kept += [bytes(raw[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return pa.table({"doc_id": block.table.column("doc_id"), "n_bytes": np.diff(block.off), "n_removed": removed, "n_spans": spans, "kept_sha256": digests, "kept": pa.array(kept if with_bytes else [None] * n, pa.binary())})

    return run


def deduplicate(docs: DataFrame, scratch: Scratch, with_bytes: bool = False) -> DataFrame:
    """RESULT of every row; ``kept`` has the remaining bytes if asked for."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(LEAST, -(-size // BLOCK_BYTES)), max(LEAST, -(-size // BUCKET_BYTES))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(blocks)))  # rows without a doc_id may lie anywhere
    block = texts.groupBy("block")
    sent = block.applyInArrow(send_anchors(buckets), "bucket int, block long, payload binary")
    answers = exchanged(sent, "bucket", buckets, size).groupBy("bucket").applyInArrow(flat(answer_anchors), "block long, bucket int, bits binary")
    answers = scratch.save(exchanged(answers, "block", blocks, size // 8), "anchors")
    contexts = block.cogroup(answers.groupBy("block")).applyInArrow(flat_second(send_contexts(buckets, PARTS)), "bucket int, block long, payload binary")
    receivers = buckets * PARTS
    repeats = exchanged(contexts, "bucket", receivers + blocks, size).groupBy("bucket").applyInArrow(flat(answer_contexts(receivers)), "block long, bucket int, payload binary")
    repeats = scratch.save(exchanged(repeats, "block", blocks, size), "repeats")
    scratch.keep("repeats")
    return block.cogroup(repeats.groupBy("block")).applyInArrow(flat_second(cut_bytes(with_bytes)), RESULT)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "substrings")).drop("kept")
