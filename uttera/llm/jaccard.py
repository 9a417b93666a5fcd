"""N-gram Jaccard join: exact links between shingle sets, found with a prefix tree.

A document's set holds 64-bit hashes of its distinct five-word shingles. Two sets link when
100 * intersection >= 80 * union. Documents of equal sets form a class at once; classes are linked:

1. Every class sends the smallest hashes of its set, enough that two linked classes must share
   ``need`` of them (overlap bound plus ``1 + alpha // 5``), to hash buckets. What classes of one task share is counted there, and only
   witnesses of it are sent, so a passage that very many have does not fill a bucket. A class survives if as
   many of its hashes occur in another class of fitting size (copies in several tasks may be counted more than once, which only lets more through). This drops all but near duplicates and texts
   that are mostly shared passages, without building a pair.
2. Survivors learn from the buckets how many of them have each of their hashes. In the global order
   (rare first, then by hash) the first ``n - alpha + 1`` hashes of two linked sets share one; survivors
   that share such a hash and fit in size are joined to candidate clusters. Every link lies within one.
3. A cluster's sets, in one order (the cluster's frequent hashes first), are put into a path-compressed trie one
   after the other. Before that, each looks for partners: the traversal shares the overlap of common
   paths, and leaves a subtree when the remaining lengths cannot reach the bound or when all of it is
   already connected with the set. Only links that connect something new are kept.
   A cluster beyond ``CLUSTER_DOCS`` or ``CLUSTER_TOKENS`` is first compared with a few members as
   pivots; what the best of them leaves over is then compared in blocks of bounded size.
4. Components of the links, named by their smallest doc_id.

Texts are never joined by a key: a filter of bounded size (``filters``) picks the rows to read again or to
take out, at every size of the input.

Defined results: null, empty or wordless text has an empty set and is its own component; fewer
than five words are one shingle; repeated rows are one class; a null doc_id never names a class
unless all of its doc_ids are null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm import filters
from uttera.llm.columns import shielded
from uttera.llm.components import connected_components
from uttera.llm.exchange import exchanged, flat, flat_second
from uttera.llm.scratch import Scratch

SHINGLE = 5
MOST = 255
SEND = 8 << 20
BUCKET_BYTES = 32 << 20
LEAST_BUCKETS = 32
CLUSTER_DOCS = 400
CLUSTER_TOKENS = 400_000
BLOCK_DOCS = 200
BLOCK_TOKENS = 200_000
PIVOTS = 8
_U = np.uint64


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and their len+1 bounds."""
    low = B.LOWER[data]
    starts, ends, bounds = B.words(low, off, B.SPACE_WORD)
    h = B.range_hash(B.prefix_hash(low), starts, ends)
    g, gb = B.grams(h, bounds, SHINGLE)
    rows = B.rows_of(gb)
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < SHINGLE))
    if len(short):
        whole = []
        for r in short.tolist():
            w = h[bounds[r] : bounds[r + 1]]
            whole.append((w * B._GRAM[8 : 8 + len(w)]).sum(dtype=_U) + _U(len(w)))
        g, rows = np.concatenate([g, B.mix(np.array(whole, _U))]), np.concatenate([rows, short])
    width = _U(max(1, int(len(off) - 1).bit_length()))
    key = (rows.astype(_U) << (_U(64) - width)) | (g >> width)
    order = np.argsort(key)
    g, rows = g[order], rows[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (rows[1:] != rows[:-1])
    g, rows = g[new], rows[new]
    return g, np.searchsorted(rows, np.arange(len(off)))


def keys_of(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set, whatever the order of its members."""
    n = np.diff(bounds).astype(_U)
    return B.mix(B.sum_rows(B.mix(tokens + _U(1)), bounds) + n), B.mix(B.sum_rows(B.mix(tokens ^ _U(0x5851F42D4C957F2D)), bounds) ^ n)


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    B.keep_heap()
    for rows, data, off in B.blocks(batches):
        tokens, bounds = shingle_sets(data, off)
        k1, k2 = keys_of(tokens, bounds)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))], ["doc_id", "n_shingles", "k1", "k2"])


def sent_length(n: np.ndarray) -> np.ndarray:
    """How many of its smallest hashes a set of n sends: n - alpha + 1 + alpha // 5, alpha the least overlap."""
    alpha = (4 * n + 4) // 5
    return np.minimum(n, n - alpha + 1 + alpha // 5)


def to_buckets(sets: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packs (key, size, tokens, bounds, bytes) of sets to one row a bucket for about ``SEND`` bytes of text.

    A payload holds key, size and number of tokens of each set, then 40 bits of each token.
    """
    held: list[tuple] = []
    weight = 0

    def out() -> pa.RecordBatch:
        key = np.concatenate([x[0] for x in held])
        size = np.concatenate([x[1] for x in held])
        tokens = np.concatenate([x[2] for x in held])
        count = np.concatenate([np.diff(x[3]) for x in held])
        _, first = np.unique(key, return_index=True)  # copies are sent once
        once = np.zeros(len(key), bool)
        once[first] = True
        owner = np.repeat(np.arange(len(key)), count)
        keep = once[owner]
        tokens, owner = tokens[keep], owner[keep]
        bucket = ((tokens & _U(0xFFFFFF)) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        tokens, owner = tokens[order], owner[order]
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        ids, payloads = [], []
        for b in np.flatnonzero(np.diff(edge)).tolist():
            o = owner[edge[b] : edge[b + 1]]
            cut = np.flatnonzero(np.diff(o, prepend=-1))
            head = np.empty((len(cut), 3), np.int64)
            head[:, 0], head[:, 1], head[:, 2] = key[o[cut]].view(np.int64), size[o[cut]], np.diff(np.append(cut, len(o)))
            body = (tokens[edge[b] : edge[b + 1]] >> _U(24)).view(np.uint8).reshape(-1, 8)[:, :5]
            ids.append(b)
            payloads.append(np.int64(len(cut)).tobytes() + head.tobytes() + body.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(payloads, pa.binary())], ["bucket", "payload"])

    for key, size, tokens, bounds, n in sets:
        held.append((key, size, tokens, bounds))
        weight += n
        if weight >= SEND:
            yield out()
            held, weight = [], 0
    if held:
        yield out()


def heads(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that each set sends."""
    count = sent_length(np.diff(bounds))
    new = np.concatenate([[0], np.cumsum(count)])
    return tokens[np.repeat(bounds[:-1] - new[:-1], count) + np.arange(new[-1])], new


def fitting(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (token, size), and which of the ordered stand beside one with the same token and a fitting size."""
    order = np.lexsort((sizes, tokens))
    t, s = tokens[order], sizes[order]
    joined = (t[1:] == t[:-1]) & (5 * s[:-1] >= 4 * s[1:])
    hit = np.zeros(len(order), bool)
    hit[1:] |= joined
    hit[:-1] |= joined
    return order, hit


def witnesses(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places, of (token, size) in order, of enough that whatever size fits one of a token fits one of these.

    The least and greatest of each token's sizes within a factor of 1.2: the sizes that fit either leave none out that fits one between.
    """
    step = np.floor(np.log(np.maximum(sizes, 1)) / np.log(1.2)).astype(np.int64)
    edge = (tokens[1:] != tokens[:-1]) | (step[1:] != step[:-1])
    return np.flatnonzero(np.concatenate([[True], edge]) | np.concatenate([edge, [True]]))[: 2 * len(tokens)]


def forty(tokens: np.ndarray) -> np.ndarray:
    """The upper 40 bits of tokens as bytes; the lower ones choose the bucket."""
    return (tokens >> _U(24)).view(np.uint8).reshape(-1, 8)[:, :5]


def from_forty(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = raw.reshape(-1, 5)
    return wide.view(_U).ravel()


def send_documents(buckets: int):
    """What the classes of about ``SEND`` bytes of text need to know of others, one row a bucket.

    Classes that share a hash among themselves count it at once and send the count, to a receiver by their key; of these the buckets get only
    ``witnesses`` of the hash, which other tasks' classes can meet. The rest, a few sizes far apart, ask for the hash. So however
    many classes have a hash, a bucket gets a bounded number of rows of it from each task.
    """

    def out(held: list[tuple]) -> pa.RecordBatch:
        key, size = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]).astype(np.int64)
        count = np.concatenate([np.diff(x[3]) for x in held])
        _, first = np.unique(key, return_index=True)  # copies are sent once
        once = np.zeros(len(key), bool)
        once[first] = True
        owner = np.repeat(np.arange(len(key)), count)
        tokens, owner = np.concatenate([x[2] for x in held])[once[owner]], owner[once[owner]]
        order, hit = fitting(tokens, size[owner])
        tokens, owner = tokens[order], owner[order]
        credit = np.bincount(owner[hit], minlength=len(key))
        seen = np.flatnonzero(hit)
        seen = seen[witnesses(tokens[seen], size[owner[seen]])] if len(seen) else seen
        ask = np.flatnonzero(~hit)
        ask = ask[np.argsort(owner[ask], kind="stable")]
        bucket = lambda t: ((t & _U(0xFFFFFF)) % _U(buckets)).astype(np.int64)
        ids, payloads = [], []
        a_bucket, w_bucket = bucket(tokens[ask]), bucket(tokens[seen])
        ask, seen = ask[np.argsort(a_bucket, kind="stable")], seen[np.argsort(w_bucket, kind="stable")]
        a_edge, w_edge = np.searchsorted(np.sort(a_bucket), np.arange(buckets + 1)), np.searchsorted(np.sort(w_bucket), np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(a_edge) + np.diff(w_edge)).tolist():
            mine, theirs = ask[a_edge[b] : a_edge[b + 1]], seen[w_edge[b] : w_edge[b + 1]]
            o = owner[mine]
            cut = np.flatnonzero(np.diff(o, prepend=-1))
            head = np.empty((len(cut), 3), np.int64)
            head[:, 0], head[:, 1], head[:, 2] = key[o[cut]].view(np.int64), size[o[cut]], np.diff(np.append(cut, len(o)))
            ids.append(b)
            payloads.append(np.array([len(cut), len(mine), len(theirs)], np.int64).tobytes() + head.tobytes() + forty(tokens[mine]).tobytes() + forty(tokens[theirs]).tobytes() + size[owner[theirs]].astype(np.uint32).tobytes())
        known = np.flatnonzero(credit)
        to = (B.mix(key[known]) % _U(buckets)).astype(np.int64)
        for r in np.unique(to).tolist():
            some = known[to == r]
            ids.append(buckets + r)
            payloads.append(np.stack([key[some].view(np.int64), size[some], credit[some]]).astype(np.int64).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(payloads, pa.binary())], ["bucket", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap()
        held: list[tuple] = []
        weight = 0
        for _, data, off in B.blocks(batches):
            tokens, bounds = shingle_sets(data, off)
            held.append((keys_of(tokens, bounds)[0], np.diff(bounds), *heads(tokens, bounds)))
            weight += len(data)
            if weight >= SEND:
                yield out(held)
                held, weight = [], 0
        if held:
            yield out(held)

    return run


def send_sets(buckets: int):
    """All hashes of the surviving sets to the buckets."""

    def sets(batches):
        B.keep_heap()
        for batch in batches:
            if batch.num_rows:
                tokens = [np.frombuffer(x, _U) for x in batch.column("tokens").to_pylist()]
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
                yield (batch.column("k1").to_numpy().view(_U), np.diff(bounds), np.concatenate(tokens), bounds, 8 * int(bounds[-1]))

    return lambda batches: to_buckets(sets(batches), buckets)


def received(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """key and size of each distinct set in a bucket, and its tokens with their owners."""
    heads_, bodies = [], []
    for x in table.column("payload"):
        raw = x.as_buffer()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        heads_.append(np.frombuffer(raw, np.int64, 3 * n, 8).reshape(n, 3))
        bodies.append(np.frombuffer(raw, np.uint8, offset=8 + 24 * n).reshape(-1, 5))
    head, body = np.concatenate(heads_), np.concatenate(bodies)
    wide = np.zeros((len(body), 8), np.uint8)
    wide[:, :5] = body
    tokens = wide.view(_U).ravel()
    owner = np.repeat(np.arange(len(head)), head[:, 2])
    _, first = np.unique(head[:, 0], return_index=True)
    once = np.zeros(len(head), bool)
    once[first] = True
    number = np.cumsum(once) - 1
    keep = once[owner]
    return head[once, 0], head[once, 1], tokens[keep], number[owner[keep]]


def by_token(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (token, size), and whether each stands beside its successor within a token and a fitting size."""
    order = np.argsort(tokens << _U(24) | np.minimum(sizes, (1 << 24) - 1).astype(_U))
    t, s = tokens[order], sizes[order]
    return order, (t[1:] == t[:-1]) & (5 * s[:-1] >= 4 * s[1:])


def count_shared(buckets: int):
    """Per bucket: for each class that asks, how many of its hashes another class of fitting size has; and the counts that tasks made themselves."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            k1, n, shared = np.concatenate([np.frombuffer(x.as_buffer(), np.int64).reshape(3, -1) for x in table.column("payload")], axis=1)
            return pa.table({"k1": k1, "n": n, "shared": shared})
        heads_, asked, seen, seen_size = [], [], [], []
        for x in table.column("payload"):
            raw = x.as_buffer()
            n, m, w = np.frombuffer(raw, np.int64, 3).tolist()
            heads_.append(np.frombuffer(raw, np.int64, 3 * n, 24).reshape(n, 3))
            at = 24 + 24 * n
            asked.append(np.frombuffer(raw, np.uint8, 5 * m, at))
            seen.append(np.frombuffer(raw, np.uint8, 5 * w, at + 5 * m))
            seen_size.append(np.frombuffer(bytes(raw[at + 5 * m + 5 * w :]), np.uint32))
        head = np.concatenate(heads_)
        _, first = np.unique(head[:, 0], return_index=True)  # a class of several tasks asks once
        once = np.zeros(len(head), bool)
        once[first] = True
        owner = np.repeat(np.arange(len(head)), head[:, 2])
        keep = once[owner]
        tokens, owner = from_forty(np.concatenate(asked))[keep], owner[keep]
        every = np.concatenate([tokens, from_forty(np.concatenate(seen))])
        sizes = np.concatenate([head[owner, 1], np.concatenate(seen_size).astype(np.int64)])
        order, hit = fitting(every, sizes)
        place = order[hit]
        shared = np.bincount(owner[place[place < len(owner)]], minlength=len(head))
        some = np.flatnonzero(shared)
        return pa.table({"k1": head[some, 0], "n": head[some, 1], "shared": shared[some]})

    return run


def frequencies(groups: int):
    """Per bucket: how many sets (at most ``MOST``) have each hash, sent back to the group of each set, in its order of hashes."""

    def run(table: pa.Table) -> pa.Table:
        key, _, tokens, owner = received(table)
        order = np.argsort(tokens)
        edge = np.flatnonzero(np.concatenate([[True], tokens[order][1:] != tokens[order][:-1]]))
        often = np.empty(len(tokens), np.uint8)
        often[order] = np.repeat(np.minimum(np.diff(np.append(edge, len(tokens))), MOST), np.diff(np.append(edge, len(tokens)))).astype(np.uint8)
        count = np.bincount(owner, minlength=len(key))
        at = np.concatenate([[0], np.cumsum(count)])
        group = key % groups
        by_group = np.argsort(group, kind="stable")
        cut = np.searchsorted(group[by_group], np.arange(groups + 1))
        out, ids = [], []
        for g in np.flatnonzero(np.diff(cut)).tolist():
            mine = by_group[cut[g] : cut[g + 1]]
            n = count[mine]
            places = np.repeat(at[mine] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
            ids.append(g)
            out.append(np.int64(len(mine)).tobytes() + key[mine].tobytes() + n.astype(np.int64).tobytes() + often[places].tobytes())
        return pa.table({"grp": pa.array(ids, pa.int64()), "bucket": pa.array([table.column("bucket")[0].as_py()] * len(ids), pa.int32()), "payload": pa.array(out, pa.binary())})

    return run


def rare_heads(buckets: int):
    """The hashes by which each set of a group is a candidate: the first ``n - alpha + 1``, rare first, that another set has as well."""

    def run(sets: pa.Table, answers: pa.Table) -> pa.Table:
        empty = pa.table({"bucket": pa.array([], pa.int32()), "payload": pa.array([], pa.binary())})
        if not sets.num_rows or not answers.num_rows:
            return empty
        sets = sets.sort_by("k1")
        key = sets.column("k1").to_numpy()
        once = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, raw = key[once], sets.column("tokens").take(pa.array(once)).to_pylist()
        size = np.array([len(x) // 8 for x in raw], np.int64)
        bounds = np.concatenate([[0], np.cumsum(size)])
        tokens, owner = np.frombuffer(b"".join(raw), _U), np.repeat(np.arange(len(key)), size)
        bucket = ((tokens & _U(0xFFFFFF)) % _U(buckets)).astype(np.int64)
        place = np.lexsort((bucket, owner))
        theirs, where, often = [], [], []
        for b, x in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist(), strict=True):
            n = int(np.frombuffer(x, np.int64, 1)[0])
            count = np.frombuffer(x, np.int64, n, 8 + 8 * n)
            theirs.append(np.repeat(np.searchsorted(key, np.frombuffer(x, np.int64, n, 8)), count))
            where.append(np.full(len(theirs[-1]), b, np.int64))
            often.append(np.frombuffer(x, np.uint8, offset=8 + 16 * n))
        df = np.empty(len(tokens), np.uint8)
        df[place] = np.concatenate(often)[np.lexsort((np.concatenate(where), np.concatenate(theirs)))]
        order = np.lexsort((tokens, df, owner))
        first = np.arange(len(tokens)) - bounds[owner] < (size - (4 * size + 4) // 5 + 1)[owner]  # owner is ascending in both orders
        chosen = order[first & (df[order] > 1)]
        n = np.bincount(owner[chosen], minlength=len(key))
        rows = list(to_buckets(iter([(key.view(_U), size, tokens[chosen], np.concatenate([[0], np.cumsum(n)]), 0)]), buckets))
        return pa.Table.from_batches(rows) if rows else empty

    return run


def candidate_edges(table: pa.Table) -> pa.Table:
    """Pairs (least key of a run of fitting sizes with one hash, other member)."""
    key, size, tokens, owner = received(table)
    order, joined = by_token(tokens, size[owner])
    o = owner[order]
    cut = np.flatnonzero(np.concatenate([[True], ~joined]))[: len(o)]
    least = np.minimum.reduceat(key[o], cut) if len(o) else np.zeros(0, np.int64)
    a, b = np.repeat(least, np.diff(np.append(cut, len(o)))), key[o]
    both = np.unique(np.stack([a[a != b], b[a != b]], 1), axis=0)
    return pa.table({"a": both[:, 0], "b": both[:, 1]})


def kept_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the documents that stand for surviving classes."""
    B.keep_heap()
    for _, data, off in B.blocks(batches):
        tokens, bounds = shingle_sets(data, off)
        k1 = keys_of(tokens, bounds)[0].view(np.int64)
        some = np.flatnonzero(np.diff(bounds))
        raw = tokens.view(np.uint8)
        out = [raw[8 * bounds[r] : 8 * bounds[r + 1]].tobytes() for r in some.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(k1[some]), pa.array(np.diff(bounds)[some]), pa.array(out, pa.binary())], ["k1", "n", "tokens"])


class _Node:
    __slots__ = ("children", "comp", "ends", "longest", "shortest", "tokens")

    def __init__(self, tokens, size, comp):
        self.tokens, self.children, self.ends = tokens, {}, []
        self.shortest = self.longest = size
        self.comp = comp  # a member if all below are connected, else -1


class PrefixTree:
    """Sets over ranks 0..width-1, added one by one; ``add`` returns the new connections of a set."""

    def __init__(self, width: int):
        self.mark = np.zeros(width, bool)
        self.root = _Node(np.zeros(0, np.int64), 0, -1)
        self.parent: list[int] = []
        self.sizes: list[int] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def add(self, ranks: np.ndarray, search: bool = True, same: int = -1) -> list[int]:
        """``same`` is an earlier set that this one is known to be connected with."""
        me = len(self.parent)
        self.parent.append(me if same < 0 else self.find(same))
        self.sizes.append(len(ranks))
        links = self._search(ranks, me) if search else []
        self._insert(ranks, me)
        return links

    def _search(self, ranks: np.ndarray, me: int) -> list[int]:
        n, mark, links = len(ranks), self.mark, []
        mark[ranks] = True
        todo = [(c, 0, 0) for c in self.root.children.values()]
        while todo:
            node, overlap, depth = todo.pop()
            if 5 * node.longest < 4 * n or 4 * node.shortest > 5 * n:
                continue
            if node.comp >= 0 and self.find(node.comp) == self.find(me):
                continue
            depth += len(node.tokens)
            overlap += int(np.count_nonzero(mark[node.tokens]))
            left = n - int(np.searchsorted(ranks, node.tokens[-1], "right"))
            size = min(max(depth + left, node.shortest), node.longest)
            if 9 * (overlap + min(left, size - depth)) < 4 * (n + size):
                continue
            if node.ends and 9 * overlap >= 4 * (n + depth):
                for other in node.ends:
                    a, b = self.find(other), self.find(me)
                    if a != b:
                        self.parent[max(a, b)] = min(a, b)
                        links.append(other)
            todo += [(c, overlap, depth) for c in node.children.values()]
        mark[ranks] = False
        return links

    def _insert(self, ranks: np.ndarray, me: int) -> None:
        node, at, n, root = self.root, 0, len(ranks), self.find(me)
        while at < n:
            child = node.children.get(int(ranks[at]))
            if child is None:
                child = node.children[int(ranks[at])] = _Node(ranks[at:], n, me)
                child.ends.append(me)
                return
            m = min(len(child.tokens), n - at)
            differ = child.tokens[:m] != ranks[at : at + m]
            same = int(differ.argmax()) if differ.any() else m
            if same < len(child.tokens):  # split the path
                upper = _Node(child.tokens[:same], child.shortest, child.comp)
                upper.longest = child.longest
                upper.children[int(child.tokens[same])] = child
                child.tokens = child.tokens[same:]
                node.children[int(ranks[at])] = upper
                child = upper
            child.shortest, child.longest = min(child.shortest, n), max(child.longest, n)
            if child.comp >= 0 and self.find(child.comp) != root:
                child.comp = -1
            node, at = child, at + same
        node.ends.append(me)


def tree_links(keys: np.ndarray, sets: list[np.ndarray], asking: np.ndarray | None = None, groups: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Connecting links among sets; with ``asking``, sets that do not ask stand in the tree but are compared with asking ones only.

    Sets of one of the ``groups`` are known to be connected.
    """
    tokens = np.concatenate(sets)
    _, which, often = np.unique(tokens, return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
    rank = rank[which]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    tree, links, seen = PrefixTree(len(often)), [], {}
    order = np.arange(len(sets)) if asking is None else np.argsort(asking, kind="stable")
    for k in order.tolist():
        same = -1 if groups is None else seen.setdefault(int(groups[k]), len(tree.parent))
        for other in tree.add(np.sort(rank[bounds[k] : bounds[k + 1]]), asking is None or bool(asking[k]), same if same < len(tree.parent) else -1):
            links.append((int(keys[k]), int(keys[order[other]])))
    return links


def join_clusters(table: pa.Table) -> pa.Table:
    """Links within each cluster of a group of clusters."""
    table = table.sort_by([("root", "ascending"), ("n", "ascending"), ("k1", "ascending")])
    root, keys = table.column("root").to_numpy(), table.column("k1").to_numpy()
    raw = table.column("tokens").to_pylist()
    edge = np.append(np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]])), len(root))
    links: list[tuple[int, int]] = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        some = [k for k in range(a, b) if k == a or keys[k] != keys[k - 1]]
        if len(some) > 1:
            links += tree_links(keys[some], [np.frombuffer(raw[k], _U) for k in some])
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def join_blocks(table: pa.Table) -> pa.Table:
    """Links between the asking members of a pair of blocks and all of its members."""
    table = table.sort_by([("n", "ascending"), ("k1", "ascending")])
    keys = table.column("k1").to_numpy()
    some = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    raw = table.column("tokens").to_pylist()
    links = tree_links(keys[some], [np.frombuffer(raw[k], _U) for k in some.tolist()], table.column("asks").to_numpy(zero_copy_only=False).astype(bool)[some], table.column("known").to_numpy()[some])
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def measured(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    """The rows with two bit masks over the pivots of their cluster: linked to it, and near enough (distance at most 0.4) to link to what it is linked to."""
    pivots = pivots.sort_by("k1")
    tokens = [np.frombuffer(x, _U) for x in rows.column("tokens").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    flat, n = (np.concatenate(tokens) if tokens else np.zeros(0, _U)), np.diff(bounds)
    linked, near = np.zeros(len(n), np.int32), np.zeros(len(n), np.int32)
    for k, raw in enumerate(pivots.column("tokens").to_pylist()):
        pivot = np.sort(np.frombuffer(raw, _U))
        shared = B.sum_rows(pivot[np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)] == flat, bounds)
        linked |= (9 * shared >= 4 * (n + len(pivot))).astype(np.int32) << k
        near |= (16 * shared >= 6 * (n + len(pivot))).astype(np.int32) << k
    return rows.select(["root", "salt", "k1", "n", "tokens"]).append_column("linked", pa.array(linked)).append_column("near", pa.array(near))


def oversized_links(salted: DataFrame, of: DataFrame, scratch: Scratch) -> DataFrame:
    """Links of clusters too large for one task; ``of`` has their docs and salts, ``salted`` their members.

    All members meet ``PIVOTS`` of them; those linked to the best pivot are connected. The others are compared with each
    other, and with the connected ones where the triangle inequality allows a link, in pairs of blocks. What all members
    need is repeated for each salt, so no task holds a whole cluster.
    """
    dealt = of.select("root", "docs", "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    least = salted.groupBy("root", "salt").agg(F.min_by(F.struct("k1", "tokens"), F.xxhash64("k1")).alias("m"))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("m.k1")))
    pivots = scratch.save(least.withColumn("rank", rank).where(F.col("rank") <= PIVOTS).select("root", "m.k1", "m.tokens"), "pivots")
    everywhere = pivots.join(dealt.select("root", "salt"), "root")
    marked = scratch.save(salted.groupBy("root", "salt").cogroup(everywhere.groupBy("root", "salt")).applyInArrow(measured, "root long, salt int, k1 long, n long, tokens binary, linked int, near int"), "marked")
    every = range(PIVOTS)
    bit = lambda c, k: F.expr(f"shiftright({c}, {k}) & 1")
    count = marked.groupBy("root").agg(*[F.sum(bit(c, k)).alias(f"{c}{k}") for c in ("linked", "near") for k in every])
    linked, near = (F.array(*[f"{c}{k}" for k in every]) for c in ("linked", "near"))
    best = (F.array_position(linked, F.array_max(linked)) - 1).cast("int")
    of_best = lambda a: F.element_at(a, F.col("best") + 1)
    tasks = lambda c: F.ceil(c * F.col("salts") / F.col("docs")).cast("int")
    keys = pivots.groupBy("root").agg(F.sort_array(F.collect_list("k1")).alias("keys"))
    plan = dealt.join(count.withColumn("best", best), "root").join(keys, "root")
    plan = plan.select("root", "salt", "keys", "best", tasks(of_best(linked)).alias("c"), tasks(F.col("docs") - of_best(linked)).alias("r"), tasks(of_best(near) - of_best(linked)).alias("m"))
    own = marked.join(scratch.save(plan, "plan"), ["root", "salt"])
    own = own.withColumns({"is_linked": F.expr("shiftright(linked, best) & 1 = 1"), "is_near": F.expr("shiftright(near, best) & 1 = 1"), "h": F.xxhash64("k1")})
    first = F.expr("if(is_linked, keys[best], get(filter(transform(keys, (x, i) -> if(shiftright(linked, i) & 1 = 1, x, null)), x -> x is not null), 0))")
    own = own.withColumn("known", F.coalesce(first, "k1"))  # a pivot that it is linked to, the best if possible
    block = lambda n: F.pmod("h", F.greatest(F.col(n), F.lit(1))).cast("int")
    seq = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    cols = ("root", "k1", "n", "tokens", "known")
    with_c = own.where("is_linked").select(*cols, F.lit(False).alias("asks"), F.explode(seq("m")).alias("i"), block("c").alias("j"), F.lit("c").alias("kind"))
    rest = own.where("not is_linked")
    to_c = rest.where("is_near").select(*cols, F.lit(True).alias("asks"), block("m").alias("i"), F.explode(seq("c")).alias("j"), F.lit("c").alias("kind"))
    to_r = rest.select(*cols, F.lit(True).alias("asks"), block("r").alias("b"), F.explode(seq("r")).alias("o"))
    to_r = to_r.select(*cols, "asks", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), F.lit("r").alias("kind"))
    blocks = with_c.unionByName(to_c).unionByName(to_r).groupBy("root", "kind", "i", "j").applyInArrow(join_blocks, "a long, b long")
    among = own.where("array_contains(keys, k1)").select(F.col("k1").alias("a"), F.posexplode("keys").alias("k", "b"), "linked").where("shiftright(linked, k) & 1 = 1 and a <> b").select("a", "b")
    to_pivots = own.where("known <> k1").select(F.col("k1").alias("a"), F.col("known").alias("b"))
    return to_pivots.unionByName(among).unionByName(blocks)


def components(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.save(texts.mapInArrow(signatures, "doc_id long, n_shingles long, k1 long, k2 long"), "signatures")
    classes = scratch.save(signed.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("least")), "classes")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    need = F.expr("1 + ((4 * ((4 * n + 4) div 5) + 4) div 5) div 5")
    sent = exchanged(texts.mapInArrow(send_documents(buckets), "bucket int, payload binary"), "bucket", 2 * buckets, size)
    shared = sent.groupBy("bucket").applyInArrow(flat(count_shared(buckets)), "k1 long, n long, shared long")
    alive = shared.groupBy("k1", "n").agg(F.sum("shared").alias("shared")).where(F.col("shared") >= need).select("k1")
    alive = scratch.save(alive.join(classes.select("k1", "least"), "k1").where("least is not null"), "alive")
    # a document that the filter lets through by chance is one more set to compare
    picked = filters.among(texts, "doc_id", filters.bloom(alive, "least"))
    sets = scratch.save(picked.select("text").mapInArrow(kept_sets, "k1 long, n long, tokens binary"), "sets")
    asked = exchanged(sets.mapInArrow(send_sets(buckets), "bucket int, payload binary"), "bucket", buckets, size)
    answers = asked.groupBy("bucket").applyInArrow(flat(frequencies(buckets)), "grp long, bucket int, payload binary")
    answers = exchanged(answers, "grp", buckets, size)
    group = F.pmod("k1", F.lit(buckets))
    heads_ = sets.withColumn("grp", group).groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(flat_second(rare_heads(buckets)), "bucket int, payload binary")
    edges = exchanged(heads_, "bucket", buckets, size).groupBy("bucket").applyInArrow(flat(candidate_edges), "a long, b long")
    clusters = connected_components(edges, scratch, "clusters").withColumnRenamed("node", "k1")
    members = scratch.save(clusters.join(sets.groupBy("k1").agg(F.first("n").alias("n")), "k1"), "members")
    of = members.groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))
    large = (F.col("docs") > CLUSTER_DOCS) | (F.col("total") > CLUSTER_TOKENS)
    salts = F.when(large, F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.least(F.col("docs"), F.ceil(F.col("total") / BLOCK_TOKENS)))).otherwise(0).cast("int")
    of = scratch.save(of.withColumn("salts", salts), "cluster-sizes")
    placed = members.join(of.select("root", "salts"), "root").select("k1", "root", F.when(F.col("salts") > 0, F.pmod(F.xxhash64("k1"), "salts")).cast("int").alias("salt"))
    sized = filters.among(sets, "k1", filters.bloom(clusters, "k1")).join(placed, "k1")
    sized = scratch.save(sized.select("root", "salt", "k1", "n", "tokens"), "clustered")
    groups = max(LEAST_BUCKETS, -(-(of.agg(F.sum("total")).first()[0] or 0) // 1_000_000))
    links = sized.where("salt is null").groupBy(F.pmod(F.xxhash64("root"), F.lit(groups)).alias("g")).applyInArrow(join_clusters, "a long, b long")
    oversized = of.where("salts > 0")
    if not oversized.isEmpty():
        links = links.unionByName(oversized_links(sized.where("salt is not null"), oversized, scratch))
    roots = connected_components(scratch.save(links, "links"), scratch, "components")
    named = roots.withColumnRenamed("node", "k1").join(classes, "k1")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = named.join(least, "root").select("k1", "k2", "n_shingles", "component_id")
    alone = classes.join(roots.select(F.col("node").alias("k1")), "k1", "left_anti").select("k1", "k2", "n_shingles", F.col("least").alias("component_id"))
    table = scratch.save(linked.unionByName(alone), "table")
    scratch.keep("signatures", "table")
    return signed.join(table, ["k1", "k2", "n_shingles"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "jaccard"))


def stage_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest doc_id stays; rows without a doc_id stay.

    A doc_id given to several rows stays once if it stays at all.
    """
    scratch = Scratch(spark, "jaccard")
    found = scratch.save(components(docs, scratch), "found")
    gone = scratch.save(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__doc_id")).distinct(), "gone")
    repeated = scratch.save(found.where("doc_id is not null").groupBy(F.col("doc_id").alias("__doc_id")).count().where("count > 1").select("__doc_id"), "repeated")

    def least(rows: DataFrame) -> DataFrame:
        kept = filters.without(rows.withColumn("__doc_id", F.col("doc_id").cast("long")), "__doc_id", gone, scratch.save(filters.bloom(gone, "__doc_id"), "gone-filter"))
        if not repeated.isEmpty():
            flagged = filters.perhaps(kept, "__doc_id", scratch.save(filters.bloom(repeated, "__doc_id"), "repeated-filter"))
            kept = flagged.where("not __perhaps").unionByName(flagged.where("__perhaps").dropDuplicates(["__doc_id"]))
        return kept.select(*rows.columns)

    return shielded(docs, least)
