"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased UTF-8 bytes and an end mark (0xFF, which UTF-8 never has). Each byte is eight binary decisions, each with its
prefix of bits; a decision has one tree of contexts, which grow by the byte before, up to ``DEPTH`` of them. Every node holds the zeros and ones that followed
its context in the texts learned from, estimated as Krichevsky and Trofimov do, and a node's weighted probability is half its own estimate plus half
the product of its children's: a mixture over all depths. The chance of the next bit given all that was learned follows along one path.

The probability of a byte depends on its last ``DEPTH`` bytes only, so the work is done on distinct strings of ``DEPTH`` + 1 bytes:

1. Documents are dealt to blocks of about ``BLOCK_BYTES``; a block counts its distinct strings (with 0 for those of held-out documents
   alone) and sends them to buckets by the three bytes nearest to the coded one.
2. A bucket has all contexts of three bytes and more for its strings; it sums up what the nodes of two bytes need. These are merged in buckets of
   their own; nodes of one byte and none, at most ``65,535``, are weighed on the driver.
3. On the way back each node of two bytes tells the buckets how its and its parents' estimates mix with the deeper ones, and a bucket answers each block
   with the probability of each string (as 32-bit logarithms).
4. Blocks add up their documents.

Word counts for the base score go the same way. All counts cover all documents learned from; nothing is cut. Blocks send each
distinct string once, so hot strings weigh no more than rare ones.

Defined results: null text is empty and has the end mark and the end token alone; a null doc_id is hashed as the empty string; repeated
rows are counted each and get equal scores; columns other than doc_id and text are not looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm.exchange import exchanged, flat, flat_second
from uttera.llm.scratch import Scratch

DEPTH = 7
LOW = 3  # contexts of so many bytes lie in one bucket
END = 0xFF
FOLDS = 5
HELD_FOLD = 1
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 32
MIDDLES = 64
_U = np.uint64
_ZSTD = pa.Codec("zstd", 1)
_TABLE = 4096
_HALF = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_TABLE) + 0.5))])
_WHOLE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_TABLE) + 1.0))])


def _rising(n: np.ndarray, table: np.ndarray, start: float) -> np.ndarray:
    """log of start * (start + 1) * ... * (start + n - 1)."""
    out = table[np.minimum(n, _TABLE).astype(np.int64)]
    big = n > _TABLE
    if big.any():
        x = n[big] + start
        out[big] = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - (0.5 * np.log(np.pi) if start == 0.5 else 0.0)
    return out


def log_estimate(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _rising(total - ones, _HALF, 0.5) + _rising(ones, _HALF, 0.5) - _rising(total, _WHOLE, 1.0)


class Nodes:
    """The nodes of one decision (its first ``j`` bits known) in the contexts of one depth. keys: sorted (context, next byte), counts of each."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, j: int):
        part = keys >> _U(8 - j)
        new = np.concatenate([[True], part[1:] != part[:-1]])[: len(keys)]
        self.first = np.flatnonzero(new)
        self.of_row = np.cumsum(new) - 1
        bit = (keys >> _U(7 - j)) & _U(1)
        self.total = np.add.reduceat(counts, self.first) if len(keys) else counts
        self.ones = np.add.reduceat(np.where(bit == 1, counts, 0), self.first) if len(keys) else counts
        self.own = log_estimate(self.total, self.ones)
        self.weighted = self.own
        head = keys[self.first]
        self.names = (head >> _U(8)) << _U(8) | _U(1 << j) | (head & _U(255)) >> _U(8 - j)

    def mix(self, children: np.ndarray) -> None:
        """children: the sum of the logs of the children's weighted probabilities, for each node."""
        self.weighted = np.logaddexp(self.own, children) - np.log(2)

    @property
    def stop(self) -> np.ndarray:
        """How much the node's own estimate weighs against the deeper ones."""
        return np.minimum(np.exp(self.own - self.weighted - np.log(2)), 1.0)

    @property
    def one(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.total + 1.0)


def shortened(keys: np.ndarray) -> np.ndarray:
    """Keys of the contexts without their farthest byte."""
    return (keys >> _U(16)) << _U(8) | keys & _U(255)


class Tree:
    """Contexts of ``LOW`` to ``DEPTH`` bytes of a bucket's strings, and the keys of those one byte shorter."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts, self.up = [keys], [counts], []
        for _ in range(DEPTH - LOW + 1):
            short, up = np.unique(shortened(self.keys[-1]), return_inverse=True)
            self.up.append(up)
            self.counts.append(np.bincount(up, self.counts[-1], len(short)).astype(np.int64))
            self.keys.append(short)

    def weigh(self, j: int) -> tuple[list[Nodes], Nodes, np.ndarray]:
        """Nodes from the deepest contexts to those of ``LOW`` bytes, those one byte shorter, and what these need of their children."""
        levels: list[Nodes] = []
        for k in range(len(self.keys)):
            nodes = Nodes(self.keys[k], self.counts[k], j)
            if not levels:
                levels.append(nodes)
                continue
            below = levels[-1]
            parent = nodes.of_row[self.up[k - 1][below.first]]
            children = np.bincount(parent, below.weighted, len(nodes.first))
            if k == len(self.keys) - 1:
                return levels, nodes, children
            nodes.mix(children)
            levels.append(nodes)
        raise AssertionError

    def log_probabilities(self, names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """log of each string's last byte given the others; ``names`` (sorted) of the nodes above, with the a and b of p = a + b * deeper."""
        out = np.zeros(len(self.keys[0]))
        for j in range(8):
            levels, above, _ = self.weigh(j)
            p = levels[0].one[levels[0].of_row]
            row = np.arange(len(p))
            for k, nodes in enumerate(levels[1:]):
                row = self.up[k][row]
                at = nodes.of_row[row]
                stop = nodes.stop[at]
                p = stop * nodes.one[at] + (1 - stop) * p
            at = np.searchsorted(names, above.names)[above.of_row[self.up[-1][row]]]
            p = a[at] + b[at] * p
            bit = (self.keys[0] >> _U(7 - j)) & _U(1)
            out += np.log(np.where(bit == 1, p, 1 - p))
        return out


# Payloads: arrays in byte planes, compressed


def pack(*arrays: np.ndarray) -> bytes:
    parts = []
    for x in arrays:
        wide = np.ascontiguousarray(x)
        planes = np.ascontiguousarray(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T) if len(wide) else np.zeros(0, np.uint8)
        body = _ZSTD.compress(planes.tobytes(), asbytes=True)
        parts.append(np.array([len(wide), len(body), wide.itemsize], np.int64).tobytes() + wide.dtype.str.encode().ljust(8) + body)
    return b"".join(parts)


def unpack(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        n, size, width = np.frombuffer(raw, np.int64, 3, at).tolist()
        kind = raw[at + 24 : at + 32].decode().strip()
        body = _ZSTD.decompress(raw[at + 32 : at + 32 + size], n * width, asbytes=True)
        out.append(np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(width, n).T).view(kind).ravel())
        at += 32 + size
    return out


def steps(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted keys: small numbers."""
    return np.diff(keys, prepend=keys.dtype.type(0))


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, the sum of their values, and where each list's keys are among them."""
    k = np.concatenate(keys)
    distinct, at = np.unique(k, return_inverse=True)
    v = np.concatenate(values)
    total = np.bincount(at, v, len(distinct)).astype(v.dtype)
    return distinct, total, np.split(at, np.cumsum([len(x) for x in keys])[:-1])


# Blocks


def strings(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The string of every byte and end mark of a slice of texts, nearest context byte first and the coded byte last, and len+1 bounds of each text's."""
    n, size = len(off) - 1, np.diff(off)
    begin = off[:-1] + np.arange(n) * (DEPTH + 1)  # each text has DEPTH marks before it and one behind it
    marks = (begin[:, None] + np.arange(DEPTH)).ravel()
    wide = np.empty(len(data) + n * (DEPTH + 1), np.uint8)
    own = np.ones(len(wide), bool)
    own[marks] = own[begin + DEPTH + size] = False
    wide[own] = data
    wide[~own] = END
    window = np.ndarray((len(wide) - DEPTH,), "<u8", wide, strides=(1,)) if n else np.zeros(0, _U)
    coded = np.ones(len(window), bool)  # each ends in a byte or the mark behind a text
    coded[marks[marks >= DEPTH] - DEPTH] = False
    w = window[coded]
    return w << _U(8) | w >> _U(56), np.concatenate([[0], np.cumsum(size + 1)])


def slices(table: pa.Table, limit: int = B.BLOCK) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Whole rows with about ``limit`` bytes of text: rows, lower-cased bytes and len+1 offsets."""
    data, off = B.column(table.column("text"))
    a, n = 0, table.num_rows
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1))
        yield table.slice(a, b - a), B.LOWER[data[off[a] : off[b]]], off[a : b + 1] - off[a]
        a = b


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often they occur."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


def tallied(keys: np.ndarray, learned: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct keys of learned and of other places, with their counts, which are 0 for the latter."""
    a, n = counted(keys[learned])
    b, _ = counted(keys[~learned])
    return [a, b], [n, np.zeros(len(b), np.int64)]


def words_in(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice, and len+1 bounds of each row's."""
    starts, ends, bounds = B.words(low, off, B.SPACE_WORD)
    return B.range_hash(B.prefix_hash(low), starts, ends), bounds


def inverse(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, at.astype(np.int32)


def bucket_of_strings(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (B.mix(keys >> _U(64 - 8 * LOW)) % _U(buckets)).astype(np.int64)


def bucket_of_words(words: np.ndarray, buckets: int) -> np.ndarray:
    return (words % _U(buckets)).astype(np.int64)


def by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket that keeps the order inside, and len+1 bounds."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def ask(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        B.give_back()
        keys, counts, words, word_counts = [], [], [], []
        for rows, low, off in slices(table, 4 * B.BLOCK):
            learned = ~rows.column("held_out").to_numpy(zero_copy_only=False)
            for (found, bounds), into, number in ((strings(low, off), keys, counts), (words_in(low, off), words, word_counts)):
                a, n = tallied(found, np.repeat(learned, np.diff(bounds)))
                into += a
                number += n
        keys, counts, _ = summed(keys, counts)
        words, word_counts, _ = summed(words, word_counts)
        order, edge = by_bucket(bucket_of_strings(keys, buckets), buckets)
        w_order, w_edge = by_bucket(bucket_of_words(words, buckets), buckets)
        some, out = [], []
        for b in np.flatnonzero(np.diff(edge) + np.diff(w_edge)).tolist():
            mine, own = order[edge[b] : edge[b + 1]], w_order[w_edge[b] : w_edge[b + 1]]
            some.append(b)
            out.append(pack(steps(keys[mine]), counts[mine], words[own], word_counts[own]))
        return pa.table({"bucket": pa.array(some, pa.int32()), "block": pa.array([table.column("block")[0].as_py()] * len(some), pa.int64()), "payload": pa.array(out, pa.binary())})

    return run


# Buckets


def gather(table: pa.Table) -> pa.Table:
    """All that blocks ask of a bucket as one row: distinct strings and words with their counts, and for each block which of them it has."""
    B.give_back()
    asks = [unpack(x.as_py()) for x in table.column("payload")]
    keys, counts, at = summed([np.cumsum(x[0], dtype=_U) for x in asks], [x[1] for x in asks])
    words, word_counts, word_at = summed([x[2] for x in asks], [x[3] for x in asks])
    which = [pack(steps(i.astype(np.uint32)), steps(k.astype(np.uint32))) for i, k in zip(at, word_at, strict=True)]  # ascending, as the blocks' lists are
    shape = pa.array([{"block": b, "which": w} for b, w in zip(table.column("block").to_pylist(), which, strict=True)], pa.struct([("block", pa.int64()), ("which", pa.binary())]))
    lists = pa.ListArray.from_arrays(pa.array([0, len(asks)], pa.int32()), shape)
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "blocks": lists, "tokens": pa.array([int(word_counts.sum())]), "distinct": pa.array([int((word_counts > 0).sum())]), "payload": pa.array([pack(steps(keys), counts, word_counts)], pa.binary())})


GATHERED = "bucket int, blocks array<struct<block:bigint,which:binary>>, tokens long, distinct long, payload binary"


def bucket_of(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings and their counts, and counts of the words, of a gathered bucket."""
    keys, counts, word_counts = unpack(raw)
    return np.cumsum(keys, dtype=_U), counts, word_counts


def upward(middles: int):
    """What the nodes of ``LOW`` - 1 bytes need from each bucket: rows (bucket, middle, payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, counts, _ = bucket_of(raw.as_py())
                tree = Tree(keys, counts)
                each = [tree.weigh(j)[1:] for j in range(8)]
                names, sums = np.concatenate([above.names for above, _ in each]), np.concatenate([s for _, s in each])
                short, n = tree.keys[-1], tree.counts[-1]
                order, edge = by_bucket((B.mix(short >> _U(8)) % _U(middles)).astype(np.int64), middles)
                m_order, m_edge = by_bucket((B.mix(names >> _U(8)) % _U(middles)).astype(np.int64), middles)
                some, out = np.flatnonzero(np.diff(edge)).tolist(), []
                for m in some:
                    mine, own = order[edge[m] : edge[m + 1]], m_order[m_edge[m] : m_edge[m + 1]]
                    own = own[np.argsort(names[own])]
                    out.append(pack(short[mine], n[mine], names[own], sums[own]))
                yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array(out, pa.binary())], ["bucket", "middle", "payload"])

    return run


def merged(table: pa.Table) -> tuple[list[list[np.ndarray]], list[Nodes], np.ndarray]:
    """The parts that came to a middle, its weighed nodes for each decision, and its keys."""
    parts = [unpack(x.as_py()) for x in table.column("payload")]
    keys, counts, _ = summed([x[0] for x in parts], [x[1] for x in parts])
    names, sums, _ = summed([x[2] for x in parts], [x[3] for x in parts])
    return parts, weighed(keys, counts, names, sums), keys


def weighed(keys: np.ndarray, counts: np.ndarray, names: np.ndarray, sums: np.ndarray) -> list[Nodes]:
    out = []
    for j in range(8):
        nodes = Nodes(keys, counts, j)
        nodes.mix(sums[np.searchsorted(names, nodes.names)])
        out.append(nodes)
    return out


def to_top(table: pa.Table) -> pa.Table:
    """What the nodes of one byte need from a middle: rows (name, counts, sum); a name of a node (below 2^16) or, above that, of a context and byte."""
    _, levels, _ = merged(table)
    names, counts, sums = [], [], []
    rows = levels[7]  # (context, seven bits): both values of the last bit are counted
    for bit, n in ((0, rows.total - rows.ones), (1, rows.ones)):
        heap = rows.names & _U(255)
        byte = (heap & _U(127)) << _U(1) | _U(bit)
        names.append((_U(1) << _U(16)) | (rows.names >> _U(16)) << _U(8) | byte)
        counts.append(n)
        sums.append(np.zeros(len(n)))
    for nodes in levels:
        names.append((nodes.names >> _U(16)) << _U(8) | nodes.names & _U(255))
        counts.append(np.zeros(len(nodes.names), np.int64))
        sums.append(nodes.weighted)
    name, at = np.unique(np.concatenate(names), return_inverse=True)
    return pa.table({"name": pa.array(name.astype(np.int64)), "n": pa.array(np.bincount(at, np.concatenate(counts), len(name)).astype(np.int64)), "s": pa.array(np.bincount(at, np.concatenate(sums), len(name)))})


def top_of(names: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one byte by name, and the a and b of p = a + b * deeper of each, its parent included."""
    is_row = names >= 1 << 16
    keys = (names[is_row] - (1 << 16)).astype(_U)
    order = np.argsort(keys)
    keys, counts = keys[order], n[is_row][order]
    order = np.argsort(names[~is_row])
    node, sums = names[~is_row][order].astype(_U), s[~is_row][order]
    one = weighed(keys, counts, node, sums)
    byte, at = np.unique(keys & _U(255), return_inverse=True)
    root_counts = np.bincount(at, counts, len(byte)).astype(np.int64)
    out = []
    for j, nodes in enumerate(one):
        root = Nodes(byte, root_counts, j)
        to = np.searchsorted(root.names, nodes.names & _U(255))
        root.mix(np.bincount(to, nodes.weighted, len(root.names)))
        out.append((nodes.names, *chained(nodes, (root.stop * root.one)[to], (1 - root.stop)[to])))
    return sorted_by_name(out)


def chained(nodes: Nodes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a + b * nodes.stop * nodes.one, b * (1 - nodes.stop)


def sorted_by_name(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    name, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(name)
    return name[order], a[order], b[order]


def downward(top: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """For each bucket, the a and b of the nodes that it sent to a middle."""

    def run(table: pa.Table) -> pa.Table:
        parts, levels, _ = merged(table)
        found = []
        for nodes in levels:
            at = np.searchsorted(top[0], (nodes.names >> _U(16)) << _U(8) | nodes.names & _U(255))
            found.append((nodes.names, *chained(nodes, top[1][at], top[2][at])))
        name, a, b = sorted_by_name(found)
        out = []
        for x in parts:
            at = np.searchsorted(name, x[2])
            out.append(pack(x[2], a[at], b[at]))
        return pa.table({"bucket": table.column("bucket"), "payload": pa.array(out, pa.binary())})

    return run


def answer(gathered: pa.Table, above: pa.Table) -> pa.Table:
    """For each block, the log probability of the strings it asked for and the counts of its words."""
    B.give_back()
    blocks, buckets, out = [], [], []
    for bucket, lists, raw in zip(gathered.column("bucket").to_pylist(), gathered.column("blocks"), gathered.column("payload"), strict=True):
        keys, counts, word_counts = bucket_of(raw.as_py())
        p = np.zeros(0, np.float32)
        if len(keys):
            p = Tree(keys, counts).log_probabilities(*sorted_by_name([tuple(unpack(x.as_py())) for x in above.column("payload")])).astype(np.float32)
        for x in lists:
            i, k = (np.cumsum(d, dtype=np.int64) for d in unpack(x["which"].as_py()))
            blocks.append(x["block"].as_py())
            buckets.append(bucket)
            out.append(pack(p[i], word_counts[k]))
    return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array(buckets, pa.int32()), "payload": pa.array(out, pa.binary())})


RESULT = "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def add_up(buckets: int, tokens: int, distinct: int, ends: int):
    unit = np.log10(tokens + 0.5 * (distinct + 1))
    end = np.log10(ends + 0.5) - unit

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        B.give_back()
        rows, keys, at, bounds, words, word_at, word_bounds = ([] for _ in range(7))
        for r, low, off in slices(docs):
            rows.append(r)
            for (found, edges), into, place, limits in ((strings(low, off), keys, at, bounds), (words_in(low, off), words, word_at, word_bounds)):
                distinct, i = inverse(found)
                into.append(distinct)
                place.append(i)
                limits.append(edges)
        keys, among = placed(keys)
        words, word_among = placed(words)
        order, edge = by_bucket(bucket_of_strings(keys, buckets), buckets)
        w_order, w_edge = by_bucket(bucket_of_words(words, buckets), buckets)
        p, c = np.zeros(len(keys), np.float32), np.zeros(len(words), np.int64)
        for b, raw in zip(answers.column("bucket").to_pylist(), answers.column("payload"), strict=True):
            p[order[edge[b] : edge[b + 1]]], c[w_order[w_edge[b] : w_edge[b + 1]]] = unpack(raw.as_py())
        base = np.log10(c + 0.5) - unit
        out = []
        for k, r in enumerate(rows):
            n = np.diff(word_bounds[k])
            out.append(pa.table({
                "doc_id": r.column("doc_id"), "held_out": r.column("held_out"), "n_bytes": np.diff(bounds[k]) - 1, "n_tokens": n + 1,
                "n_known": B.sum_rows((c > 0)[word_among[k]][word_at[k]], word_bounds[k]) + int(ends > 0), "train_tokens": np.full(len(n), tokens, np.int64),
                "base_score": by_row(base[word_among[k]][word_at[k]], word_bounds[k]) + end, "score": by_row(p[among[k]][at[k]], bounds[k]) / np.log(10),
            }))
        return pa.concat_tables(out)

    return run


def placed(lists: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys of several lists, and where each list's keys are among them."""
    distinct = np.concatenate(lists)
    distinct.sort()
    distinct = distinct[np.concatenate([[True], distinct[1:] != distinct[:-1]])[: len(distinct)]]
    return distinct, [np.searchsorted(distinct, x).astype(np.int32) for x in lists]


def by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the items of each row by themselves, so that they don't depend on other rows."""
    return np.bincount(B.rows_of(bounds), values, len(bounds) - 1)


def score(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """RESULT of every row; n_bytes is without the end mark. Learns from the rows outside fold ``HELD_FOLD``."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), (fold == HELD_FOLD).alias("held_out"))
    size, ends = rows.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    size = size or 0
    blocks, buckets = max(LEAST_BUCKETS, -(-size // BLOCK_BYTES)), max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    block = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).groupBy("block")
    sent = exchanged(block.applyInArrow(ask(buckets), "bucket int, block long, payload binary"), "bucket", buckets, size)
    gathered = scratch.save(sent.groupBy("bucket").applyInArrow(flat(gather), GATHERED), "gathered")
    tokens, distinct = gathered.agg(F.sum("tokens"), F.sum("distinct")).first()
    up = scratch.save(gathered.select("bucket", "payload").mapInArrow(upward(MIDDLES), "bucket int, middle int, payload binary"), "up")
    middle = up.groupBy("middle")
    # nodes of one byte and their bytes: at most 2 * 65,536 rows, whatever the input
    top = middle.applyInArrow(to_top, "name long, n long, s double").groupBy("name").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    names, n, s = (top.column(c).to_numpy() for c in ("name", "n", "s"))
    above = scratch.save(middle.applyInArrow(downward(top_of(names, n, s)), "bucket int, payload binary"), "above")
    scratch.drop("up")
    answers = gathered.select("bucket", "blocks", "payload").groupBy("bucket").cogroup(above.groupBy("bucket")).applyInArrow(answer, "block long, bucket int, payload binary")
    answers = exchanged(answers, "block", blocks, size)  # read once, by the blocks: not worth a table
    scratch.keep("gathered", "above")
    total = (tokens or 0) + ends
    return block.cogroup(answers.groupBy("block")).applyInArrow(flat_second(add_up(buckets, total, (distinct or 0) + int(ends > 0), ends)), RESULT)


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "context-tree"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", (-F.col("score") / F.log10(F.lit(2.0)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))
