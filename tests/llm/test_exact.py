"""Operators with exact results, against brute force on small fixtures with nulls, ties, empties and clashing columns."""

import base64
import collections
import hashlib
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm import contamination, exchange, filters, jaccard, packing, quality, substrings, token_shards, tokens, urls, warc
from uttera.llm.scratch import Scratch
from uttera.llm.wavelet import WaveletMatrix

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOC)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(2)
    parts = ["".join(rng.choices("abé ", k=rng.randint(20, 120))) for _ in range(20)] + ["a" * 130, "ab" * 90]
    rows = [(i, "".join(rng.choice(parts) if rng.random() < 0.5 else "".join(rng.choices("abc \n", k=rng.randint(0, 80))) for _ in range(rng.randint(0, 6)))) for i in range(150)]
    return [*rows, (None, parts[0] * 2), (1000, None), (1001, ""), (1002, parts[0] * 3), (1002, parts[0] * 3), (1002, parts[1] * 2), (1003, " \n\t"), (1004, "word " * 20000)]


def kept_by_brute_force(rows, size=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for s in range(len(b) - size + 1):
                first[b[s : s + size]] = min(i, first.get(b[s : s + size], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        if i is not None:
            for s in range(len(b) - size + 1):
                if first[b[s : s + size]] < i:
                    gone[s : s + size] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]).sum())
        out.append((-1 if i is None else i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


def test_suffix_dedup(spark, awkward, monkeypatch):
    monkeypatch.setattr(substrings, "LEAST", 5)
    got = substrings.deduplicate(documents(spark, awkward), Scratch(spark, "t"), True).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got) == kept_by_brute_force(awkward)
    assert substrings.deduplicate(documents(spark, []), Scratch(spark, "t")).count() == 0
    monkeypatch.setattr(exchange, "FAN", 2)
    two = substrings.deduplicate(documents(spark, awkward), Scratch(spark, "t"), True).collect()
    assert sorted(map(str, two)) == sorted(map(str, got))


def test_suffix_dedup_query(spark):
    """The registered query over a whole table, against brute force."""
    got = substrings.op1_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [r[:5] for r in kept_by_brute_force(rows)]


def test_shared_lines_do_not_fill_a_bucket():
    """What a block sends of a line does not grow with the documents that have it, nor with the places in a document of one letter."""

    def sent(texts):
        table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "block": pa.array([0] * len(texts), pa.int64())})
        anchors = substrings.send_anchors(3)(table)
        answers = [substrings.answer_anchors(anchors.slice(k, 1)) for k in range(anchors.num_rows)]
        rows = substrings.send_contexts(3, 2)(table, pa.concat_tables(answers))
        sizes = [len(x) for x in rows.column("payload").to_pylist()]
        return sum(n for b, n in zip(rows.column("bucket").to_pylist(), sizes, strict=True) if b < 6), sum(sizes)

    line = "a line of boilerplate that very many documents have in common, word by word"
    few, many = (sent([line] * n) for n in (100, 1000))
    assert many[0] == few[0] < 1_000 < many[1]
    assert sent(["x" * 100_000] * 2)[0] < 200


def test_filters_lose_no_row(spark, monkeypatch):
    rows = spark.range(2000).selectExpr("if(id % 50 = 7, null, id) as key", "id as own")
    keys = spark.range(0, 2000, 3).selectExpr("id as key")
    for words in (1 << 20, 4):  # the second is full: everything passes it
        monkeypatch.setattr(filters, "WORDS", words)
        bloom = filters.bloom(keys, "key")
        assert bloom.count() <= words
        got = {r.own for r in filters.among(rows, "key", bloom).collect()}
        want = {k for k in range(0, 2000, 3) if k % 50 != 7}
        assert want <= got and (words == 4 or len(got) < len(want) + 20)
        assert sorted(r.own for r in filters.without(rows, "key", keys, bloom).collect()) == [k for k in range(2000) if k not in want]


def test_exchange_rows_do_not_grow_with_pairs(spark, monkeypatch):
    monkeypatch.setattr(exchange, "FAN", 8)
    monkeypatch.setattr(exchange, "PART", 1 << 14)
    for senders in (4, 16):
        rows = spark.range(senders, numPartitions=senders).selectExpr("id as origin", "explode(sequence(0, 499)) as to").selectExpr("int(to) as to", "origin", "binary(concat(origin, ':', to)) as payload")
        sent = exchange.exchanged(rows, "to", 500, 10)
        assert sent.count() <= 500 * 8 and sent.selectExpr("inline(items)").count() == 500 * senders
        seen = sent.groupBy("to").applyInArrow(exchange.flat(lambda t: pa.table({"to": t.column("to"), "payload": t.column("payload")})), "to int, payload binary").collect()
        assert sorted(bytes(r.payload).decode() for r in seen) == sorted(f"{k}:{i}" for k in range(senders) for i in range(500))
        assert all(bytes(r.payload).decode().split(":")[1] == str(r.to) for r in seen)


def test_previous_factors():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(0, 350)
    order, same = substrings.suffix_array(text, starts)
    key = lambda s, n: bytes(text[s : s + n])
    assert [int(x) for x in order] == sorted(range(350), key=lambda s: (key(s, substrings.DEPTH), s))
    assert same.tolist() == [False, *[key(a, 50) == key(b, 50) for a, b in zip(order[:-1], order[1:], strict=True)]]
    docs = rng.integers(0, 6, 500)
    group = np.sort(rng.integers(0, 40, 500))
    same = np.concatenate([[False], group[1:] == group[:-1]])
    before, after = substrings.smaller_neighbours(docs, same)
    for k in range(500):
        smaller = [j for j in range(500) if group[j] == group[k] and docs[j] < docs[k]]
        assert before[k] == max((j for j in smaller if j < k), default=-1) and after[k] == min((j for j in smaller if j > k), default=-1)
    # contexts of one length, so that a common prefix is cut at the same place whatever it is compared with
    parts = [bytes(rng.integers(97, 99, 12).astype(np.uint8)) for _ in range(3)]
    contexts = [b"".join(parts[k] for k in rng.integers(0, 3, 6))[:70] for _ in range(60)]
    owner = rng.integers(0, 9, 60)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.concatenate([np.arange(70 * k, 70 * k + 21) for k in range(60)])
    docs = np.repeat(owner, 21)
    got = substrings.previous_factors(text, starts, 70 * (starts // 70 + 1), docs)
    for k in range(0, len(starts), 7):
        a = contexts[starts[k] // 70][starts[k] % 70 :]
        best = 0
        for j in np.flatnonzero(docs < docs[k]).tolist():
            b = contexts[starts[j] // 70][starts[j] % 70 :]
            n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            best = max(best, n)
        assert (got[k] >= 50) == (best >= 50) and (got[k] == 0 or 50 <= got[k] <= best)


def test_very_long_text_anchors(monkeypatch):
    data = np.random.default_rng(3).integers(97, 123, 3000).astype(np.uint8)
    whole = substrings.anchors(data, np.array([0, 3000]))
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(whole[1], whole[2], strict=True)])
    assert starts.tolist() == list(range(2951))


def components_by_brute_force(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdef", k=3)) for _ in range(60)]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 3) if len(base) > 3 else 0):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[rng.choice(words)], [], [w[k], "zz"]])
            rows.append((len(rows), " ".join(w)))
    return [*rows, (5000, None), (5001, ""), (5002, "\n "), (5003, "One"), (5004, "one ")]


@pytest.mark.parametrize(("most", "docs", "block"), [(255, 4000, 1500), (3, 4000, 1500), (255, 4, 3), (255, 1, 1)])
def test_jaccard(spark, near_copies, monkeypatch, most, docs, block):
    for k, v in (("MOST", most), ("CLUSTER_DOCS", docs), ("BLOCK_DOCS", block), ("LEAST_BUCKETS", 4)):
        monkeypatch.setattr(jaccard, k, v)
    monkeypatch.setattr(exchange, "FAN", 2 if docs == 1 else 1024)
    monkeypatch.setattr(jaccard, "SEND", 600 if docs == 4 else 8 << 20)  # many tasks' worth of classes
    monkeypatch.setattr(B, "BLOCK", 300 if docs == 4 else B.BLOCK)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(documents(spark, near_copies), Scratch(spark, "t")).collect()}
    assert got == components_by_brute_force(near_copies)


def shared_by_tasks(texts, buckets, tasks):
    """(size, shared) of every class from what tasks send, and the bytes that each bucket gets."""
    counts, sent = collections.Counter(), collections.defaultdict(list)
    for part in np.array_split(np.arange(len(texts)), tasks):
        batch = pa.RecordBatch.from_arrays([pa.array([texts[i] for i in part], pa.string())], ["text"])
        for rows in jaccard.send_documents(buckets)(iter([batch])):
            for b, x in zip(rows.column("bucket").to_pylist(), rows.column("payload").to_pylist(), strict=True):
                sent[b].append(x)
    sizes = {}
    for b, payloads in sent.items():
        out = jaccard.count_shared(buckets)(pa.table({"bucket": pa.array([b] * len(payloads), pa.int32()), "payload": payloads}))
        for k, n, c in zip(*(out.column(x).to_pylist() for x in ("k1", "n", "shared")), strict=True):
            counts[k] += c
            sizes[k] = n
    return {k: (sizes[k], c) for k, c in counts.items()}, {b: sum(map(len, x)) for b, x in sent.items() if b < buckets}


@pytest.mark.parametrize("tasks", [1, 3, 12])
def test_counts_of_shared_hashes(monkeypatch, tasks):
    """Counted in tasks or buckets, by witnesses or asked for: as by comparing all classes, and never less where copies lie in several tasks."""
    monkeypatch.setattr(jaccard, "SEND", 4000)
    rng = random.Random(8)
    common = " ".join(f"w{k}" for k in range(40))
    texts = [common[: rng.randint(30, 160)] + " " + " ".join(f"v{rng.randrange(90)}" for _ in range(rng.choice([0, 3, 12, 60, 300]))) for _ in range(150)]
    key_of = lambda t: int(jaccard.keys_of(*jaccard.shingle_sets(*B.column(pa.array([t]))))[0][0])
    texts = list({key_of(t): t for t in texts}.values())
    data, off = B.column(pa.array(texts))
    tokens, bounds = jaccard.shingle_sets(data, off)
    keys, n = jaccard.keys_of(tokens, bounds)[0].view(np.int64), np.diff(bounds)
    sent, edges = jaccard.heads(tokens, bounds)
    have = collections.defaultdict(set)
    for i in range(len(texts)):
        for t in sent[edges[i] : edges[i + 1]].tolist():
            have[t].add((int(keys[i]), int(n[i])))
    want = collections.Counter()
    for i in range(len(texts)):
        for t in sent[edges[i] : edges[i + 1]].tolist():
            if any(k != keys[i] and 5 * min(m, n[i]) >= 4 * max(m, n[i]) for k, m in have[t]):
                want[int(keys[i])] += 1
    got, _ = shared_by_tasks(texts, 5, tasks)
    assert {k: c for k, (_, c) in got.items()} == dict(want)
    more, _ = shared_by_tasks(texts + texts[::3], 5, tasks)
    assert all(more[k][1] >= c for k, c in want.items())


def test_common_passages_do_not_fill_a_bucket():
    passage = "a passage of twelve words that a great many documents have in common"
    texts = [f"{passage} " + " ".join(f"{k}x{j}" for j in range(9)) for k in range(5000)]
    few, many = (shared_by_tasks(texts[:n], 7919, 1)[1] for n in (500, 5000))
    assert max(many.values()) < 3 * max(few.values()) < 1500


def test_prefix_tree():
    rng = np.random.default_rng(8)
    base = rng.choice(2**60, 40, replace=False).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(40) < 0.08, rng.integers(0, 2**60, 40).astype(np.uint64), base)) for _ in range(60)]
    links = jaccard.tree_links(np.arange(60), sets)
    assert all(5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])) for a, b in links)
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(60):
        for b in range(a):
            if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])):
                root[find(a)] = find(b)
    assert len(links) == 60 - len({find(x) for x in range(60)})


def test_jaccard_stage(spark, near_copies, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_BUCKETS", 4)
    rows = [*near_copies, (5003, "One"), (None, "alone " * 9)]
    want = sorted(i for i, (_, c) in components_by_brute_force(near_copies).items() if c == i)
    got = jaccard.stage_jaccard(spark, documents(spark, rows), "")
    assert got.columns == [c.split()[0] for c in DOC.split(", ")]
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == want


def test_decontamination(spark, monkeypatch):
    rng = random.Random(3)
    voc = [f"w{k}" for k in range(9)] + ["É", "x9"]
    items = [(k, " ".join(rng.choice(voc) for _ in range(rng.choice([0, 3, 12, 13, 14, 30])))) for k in range(25)]
    items += [(7, items[7][1]), (100, items[3][1]), (101, None), (102, "...")]
    docs = [(i, " ".join((rng.choice(items)[1] or "") if rng.random() < 0.3 else rng.choice(voc).upper() + "," for _ in range(rng.randint(0, 12)))) for i in range(60)] + [(90, None), (91, ""), (92, "- -"), (92, "- -")]
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = find(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    want = []
    for i, t in docs:
        w, hit, found = find(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if s := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= s
        want.append((i, len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for block in (contamination.ITEM_BLOCK, 300):
        got = contamination.decontaminate(documents(spark, docs).withColumn("spans", F.lit(1)), bench, Scratch(spark, "t"), block).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=repr) == sorted(want, key=repr)
    assert contamination.decontaminate(documents(spark, docs), bench.limit(0), Scratch(spark, "t")).where("n_hit > 0").isEmpty()
    twice = spark.createDataFrame([(1, items[5][1], "en"), (1, items[5][1], "de"), (None, items[5][1], None)], "doc_id long, text string, lang string")
    kept = contamination.decontaminate(twice, bench, Scratch(spark, "t"), 300).collect()
    assert collections.Counter((r.doc_id, r.lang) for r in kept) == {(1, "en"): 1, (1, "de"): 1, (None, None): 1} and len({tuple(r["items"]) for r in kept}) == 1
    monkeypatch.setattr(contamination, "SAMPLE", 3)
    stage = contamination.decontaminate(documents(spark, docs), bench, Scratch(spark, "t"))
    text = dict(docs)
    for r in stage.where("n_hit > 0").collect():
        raw = text[r.doc_id].encode()
        assert sum(len(find(raw[s.byte_start : s.byte_end].decode())) for s in r.spans) == r.n_hit


def test_tiny_shards():
    """Shards and items of 1 to 5 words over alphabets of 1 to 40 words: shorter than one packed key."""
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 7, 40):
        for _ in range(60):
            item, doc = ([f"w{k}" for k in rng.integers(0, size, rng.integers(1, 6))] for _ in range(2))
            windows = contamination.Windows([(1, " ".join(item)), (2, " ".join(f"w{k}" for k in range(size)))])
            data, off = B.column(pa.array([" ".join(doc)]))
            starts, ends, bounds = B.words(data, off, B.ALNUM_WORD)
            first, pattern = contamination.occurrences(B.range_hash(B.prefix_hash(data), starts, ends), B.rows_of(bounds), windows)
            every = [f"w{k}" for k in range(size)]
            wanted = {tuple(item)} | {tuple(every[k : k + min(13, size)]) for k in range(max(size - 12, 1))}
            assert sorted((int(a), int(windows.lengths[p])) for a, p in zip(first, pattern, strict=True)) == sorted((k, len(w)) for w in wanted for k in range(len(doc) - len(w) + 1) if tuple(doc[k : k + len(w)]) == w)


def test_suffix_order_with_separators():
    t = np.random.default_rng(0).integers(0, 4, 2000).astype(np.int32)
    t[-1] = 0

    def suffix(i):
        j = i
        while t[j]:
            j += 1
        return (*t[i:j], 0), i

    assert [suffix(i) for i in contamination.suffix_order(t, 3)] == sorted(suffix(i) for i in range(len(t)))


def test_wavelet_matrix():
    a = np.random.default_rng(0).integers(0, 37, 1000).astype(np.int32)
    w = WaveletMatrix.of_planes(WaveletMatrix(a, 6).planes, len(a))
    assert (w.decode() == a).all() and (w.access(np.arange(1000)) == a).all()
    for s in (0, 5, 36):
        assert (w.positions(s) == np.flatnonzero(a == s)).all() and w.count(s) == (a == s).sum()
        assert all(w.rank(np.array([s]), np.array([i]))[0] == (a[:i] == s).sum() for i in (0, 1, 63, 64, 65, 999, 1000))
    assert WaveletMatrix(np.zeros(0, np.uint32), 1).decode().size == 0
    wide = np.array([1 << 19, 5, 1 << 19, 0])
    assert WaveletMatrix(wide, 20).decode().tolist() == wide.tolist()


def test_shard_file_answers_from_chunks(monkeypatch, tmp_path):
    monkeypatch.setattr(token_shards, "CHUNK", 512)
    rng = np.random.default_rng(4)
    path = tmp_path / "shards"
    shards = []
    with open(path, "wb") as file:
        for n in (1, 511, 512, 5000):
            ids = rng.integers(0, 90, n).astype(np.uint32)
            sizes = np.array([n // 3, n - n // 3])
            shards.append((ids, sizes))
            file.write(token_shards.shard_bytes(np.array([7, 8]), sizes, ids) + b"\n")
    with open(path, "rb") as file:
        for (ids, sizes), shard in zip(shards, token_shards.shards_of(file), strict=True):
            assert shard.doc_ids.tolist() == [7, 8] and shard.sizes.tolist() == sizes.tolist()
            at = rng.integers(0, len(ids), 60)
            assert (shard.access(at) == ids[at]).all()
            assert len(shard.kept) <= shard.bits * shard.chunks
            for s in (0, 33, 89, 5000):
                assert shard.count(s) == (ids == s).sum() and (shard.positions(s) == np.flatnonzero(ids == s)).all()
            ends = rng.integers(0, len(ids) + 1, 40)
            assert shard.rank(np.full(40, 33), ends).tolist() == [int((ids[:e] == 33).sum()) for e in ends]
            assert (shard.decode() == ids).all()
    with open(path, "rb") as file:  # one lookup reads one chunk a level
        last = list(token_shards.shards_of(file))[-1]
        last.access(np.array([4321]))
        assert len(last.kept) <= 2 * last.bits


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(1)
    chars = [*"ab'sTé ßÀ0.,!?;:\n\n  \t  \u0301-|<$中\u0085\xa0\u2003\u3000", "'s", "'S", "J\u030c", "E\u0301", "I\u0307", "İ", " The", "<|endoftext|>", " the", " la", "\r\n", ""]
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 40))) for _ in range(3000)] + ["", "x" * 5000]
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    encoder = tokens.Encoder(public_tokenizers.path(name), fold=name.startswith("word"))
    monkeypatch.setattr(tokens, "CACHE", 700)
    data, off = B.column(pa.array(texts))
    ids, bounds = encoder.encode(data, off)
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == plain.encode(t, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_shards(spark, awkward, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_shards, "SHARD", 500)
    monkeypatch.setattr(token_shards, "PER_FILE", 2)
    path = public_tokenizers.path("word_bpe_49k.json")
    scratch = Scratch(spark, "t")
    rows = sorted(awkward, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    token_shards.write_shards(documents(spark, awkward), path, scratch.path("s"))
    got = [tuple(r) for r in token_shards.read_documents(spark, scratch.path("s"), scratch).orderBy("start").collect()]
    plain = Tokenizer.from_file(path)
    ids = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows]
    assert [g[0] for g in got] == [i for i, _ in rows]
    assert sorted((g[0] or -1, g[2], g[3]) for g in got) == sorted((i or -1, len(x), crc(x)) for (i, _), x in zip(rows, ids, strict=True))
    assert [g[1] for g in got] == np.concatenate([[0], np.cumsum([g[2] for g in got])])[:-1].tolist()
    word = ids[-1][0]
    total = sum(x.count(word) for x in ids)
    assert {r.token: r.n for r in token_shards.token_counts(spark, scratch.path("s"), [word, 1, 40000]).collect()} == {word: total, 1: len(rows), 40000: 0}
    where = [(r.doc_id, r.position) for r in token_shards.occurrences(spark, scratch.path("s"), word).collect()]
    assert collections.Counter(where) == collections.Counter((i, k) for (i, _), x in zip(rows, ids, strict=True) for k, y in enumerate(x) if y == word)
    empty = scratch.path("e")
    token_shards.write_shards(documents(spark, []), path, empty)
    assert token_shards.read_documents(spark, empty, Scratch(spark, "t")).count() == 0


def test_packing(spark, awkward, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(k, t) for k, (_, t) in enumerate(awkward)]
    got = packing.pack(documents(spark, rows), path).collect()
    plain = Tokenizer.from_file(path)
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length, r.window))
    for i, x in ids.items():
        at = 0
        for start, n in sorted(pieces[i]):
            assert start == at
            at += n
        assert at == len(x)
    for s in sequences.values():
        at = 0
        for offset, n, _ in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at == s[0][2] <= 2048 and at & (at - 1) == 0


def test_packer_memory_and_steps():
    rng = np.random.default_rng(4)
    p, out, total, most = packing.Packer(3, wait=20_000), [], 0, 0
    for d in range(400):
        n = int(rng.integers(1, 5000))
        total += n
        p.add(d, np.arange(n, dtype=np.uint32))
        most = max(most, p.waiting)
        if p.ready():
            out += list(p.flush(False))
    out += list(p.flush(True))
    assert sum(r[2] for r in out) == total and most < 40_000 and not p.waiting
    loads = collections.Counter()
    for r in out:
        loads[r[8]] += r[2]
    assert max(loads.values()) <= packing.STEP + 2048


def test_warc(spark):
    rng = random.Random(6)
    page = lambda k: "<p>" + "".join(rng.choices("abc \x1f\x8b\x08é", k=rng.randint(0, 3000)))
    bodies = [page(k) for k in range(30)] + [None, ""]
    rows = [(k, f"http://h/{k}\n" if k % 9 else None, rng.choice(bodies)) for k in range(200)] + [(None, "u", "only"), (None, "u", bodies[0]), (500, "u", "x" * (17 << 20))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("top", F.lit(1)).repartition(3)
    scratch = Scratch(spark, "t")
    warc.write_archives(df, scratch.path("a"), scratch)
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, u, h in rows:
        b = (h or "").encode()
        t = top[h or ""]
        again = t >= 0 and i != t
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", t if again else None, None if u is None else u.replace("\n", "%0A")))
    for size in (warc.RANGE, 1000):
        got = [tuple(r) for r in warc.read_archives(spark, scratch.path("a"), size).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_text_writer_keeps_bytes(spark, tmp_path):
    """Archives and shards pass binary through the text writer as strings: what is on disk is byte for byte what was made."""
    rng = np.random.default_rng(0)
    rows = [(k, f"http://h/{k}", "".join(chr(c) for c in rng.integers(32, 500, 400)), None, False) for k in range(50)]
    made = [warc.member(*r) for r in rows]
    assert all(any(b >= 0x80 for b in m) for m in made)
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, f"{tmp_path}/a", Scratch(spark, "t"))
    written = b"".join(p.read_bytes() for p in sorted((tmp_path / "a").glob("part-*")))
    assert len(written) == sum(len(m) + 1 for m in made) and all(m + b"\0" in written for m in made)
    raw = [bytes(rng.integers(0, 256, 1000).astype(np.uint8)).replace(b"\0", b"\1") for _ in range(20)] + [bytes(range(1, 256)), b"\xff\xfe\x80", b"\xc3"]
    spark.createDataFrame([(x,) for x in raw], "b binary").coalesce(1).select(F.col("b").cast("string").alias("value")).write.option("lineSep", "\0").text(f"{tmp_path}/b")
    assert b"".join(p.read_bytes() for p in (tmp_path / "b").glob("part-*")) == b"".join(x + b"\0" for x in raw)


def test_url_rules(spark):
    cases = [
        ("https://EXAMPLE.com/en/1?x", "example.com", "/en/1", "example.com/en/", "block"), ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"), ("http://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
        ("x://a.b.net/fr/#t", "a.b.net", "/fr/", "net/fr/", "block"), ("http://notnet/es/", "notnet", "/es/", None, "allow"), ("http://a.com", "a.com", "", None, "allow"), ("a.com/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("http://q?a://b/c", "q", "", None, "allow"), ("a\nb://ÄB.com/x", "Äb.com", "/x", "com/", "allow"),
    ]
    df = spark.createDataFrame([(k, c[0], None) for k, c in enumerate(cases)], "page_id long, url string, html string")
    got = urls.judge(df, Scratch(spark, "t")).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [c[1:] for c in cases]


def test_propagation(spark):
    edges = [("a", "b", 1), ("a", "c", 3), ("b", "c", 1), ("c", "a", 2), ("d", "c", 1)]
    seeds = {("a", "t"): 1.0, ("c", "d"): 0.5}
    got = urls.propagate(spark.createDataFrame([(h, k, v) for (h, k), v in seeds.items()], "host string, kind string, seed double"), spark.createDataFrame(edges, "src string, dst string, weight long"), Scratch(spark, "t")).collect()
    want = collections.Counter()
    for kind in "td":
        start = {h: 0.15 * v for (h, k), v in seeds.items() if k == kind}
        now = dict(start)
        for _ in range(300):
            new = collections.Counter(start)
            for a, b, w in edges:
                share = w / sum(x for s, _, x in edges if s == a)
                to, of = (b, a) if kind == "t" else (a, b)
                new[to] += 0.85 * now.get(of, 0) * share
            now = new
        want.update({(h, kind): v for h, v in now.items()})
    assert {(r.host, r.kind) for r in got} == {k for k, v in want.items() if v}
    assert all(abs(r.score - want[r.host, r.kind]) < 6 * urls.TOLERANCE * 0.15 for r in got)
    long = [(f"h{k:02}", f"h{k + 1:02}", 1) for k in range(20)]  # a chain beyond a dozen hops
    chain = urls.propagate(spark.createDataFrame([("h00", "t", 1.0)], "host string, kind string, seed double"), spark.createDataFrame(long, "src string, dst string, weight long"), Scratch(spark, "t"))
    assert {r.host: r.score for r in chain.collect()} == {f"h{k:02}": pytest.approx(0.15 * 0.85**k) for k in range(21)}
    spam = [(k, f"http://spam{k}.org/", '<a href="http://bad.net/x">') for k in range(5)] + [(9, "http://bad.net/es/", None), (10, "http://mixed.org/", '<a href="//bad.net"><a href="//fine.org">'), (10, "http://mixed.org/", '<a href="//bad.net"><a href="//fine.org">'), (None, None, None)]
    got = urls.judge(spark.createDataFrame(spam, "page_id long, url string, html string").withColumn("rule", F.lit(1)).withColumn("trust", F.lit("x")), Scratch(spark, "t")).collect()
    assert {r.page_id: r.verdict for r in got} == {**{k: "block" for k in range(5)}, 9: "block", 10: "allow", None: "allow"} and len(got) == 9
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string"), Scratch(spark, "t")).count() == 0
    linked = spark.createDataFrame([(0, "http://bad.net/es/", '<a href="http://x/">'), (1, "http://spam.org/", "<a HREF='//BAD.net/q'>"), (2, "http://spam.org/2", '<a href="http://bad.net">'), (3, "http://good.org/", None)], "page_id long, url string, html string")
    assert [r.verdict for r in urls.judge(linked, Scratch(spark, "t")).orderBy("page_id").collect()] == ["block", "block", "block", "allow"]


def test_base_counts():
    rng = random.Random(9)
    texts = ["".join(rng.choices(["a", "bé", " ", "\n", "\t", "#", "<", "a a a ", "b\n"], k=rng.randint(0, 40))) for _ in range(400)] + ["", "\n\n", "x y z x y z"]
    data, off = B.column(pa.array(texts))
    got = quality.base_counts(data, off)
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        often, seen, again, covered = collections.Counter(zip(w, w[1:], w[2:])), set(), 0, set()  # noqa: B905
        for i in range(len(w) - 2):
            if often[tuple(w[i : i + 3])] > 1:
                covered |= {i, i + 1, i + 2}
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        assert [int(got[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), again, len(covered)], t
