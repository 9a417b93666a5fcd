"""Language-model scores, periodic runs and spelling variants against plain versions, and their defined results on awkward rows."""

import collections
import hashlib
import math
import random
import re
import string
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from uttera.llm import context_tree, exchange, periodic, spelling
from uttera.llm.queries import queries
from uttera.llm.scratch import Scratch

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def small_documents():
    t = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"], strict=True))


# Context trees


def weighted_tree(docs, depth=context_tree.DEPTH):
    """Scores by the textbook recursion over a dictionary of all nodes."""
    texts = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1, (t or "").translate(LOWER).encode()) for i, t in docs]

    def coded(b):
        s = b"\xff" * depth + b + b"\xff"
        for t in range(depth, len(s)):
            for j in range(8):
                yield s[t - depth : t][::-1], (1 << j) | (s[t] >> (8 - j)), (s[t] >> (7 - j)) & 1

    count = collections.defaultdict(lambda: [0, 0])
    for _, held, b in texts:
        for context, node, bit in () if held else coded(b):
            for d in range(depth + 1):
                count[context[:d], node][bit] += 1
    children = collections.defaultdict(float)
    own, weight = {}, {}
    for key in sorted(count, key=lambda k: -len(k[0])):
        a, b = count[key]
        own[key] = weight[key] = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
        if len(key[0]) < depth:
            weight[key] = float(np.logaddexp(own[key], children[key])) - math.log(2)
        children[key[0][:-1], key[1]] += weight[key] if key[0] else 0
    out = []
    for i, held, b in texts:
        total = 0.0
        for context, node, bit in coded(b):
            p = 0.5
            for d in range(depth, -1, -1):
                key = context[:d], node
                c = count.get(key, (0, 0))
                estimate = (c[bit] + 0.5) / (sum(c) + 1)
                stop = 1.0 if d == depth else math.exp(own.get(key, 0.0) - weight.get(key, 0.0)) / 2
                p = stop * estimate + (1 - stop) * p
            total += math.log10(p)
        out.append((i, held, total))
    tokens = lambda b: [*re.findall(rb"[^\x20\x09-\x0d]+", b), None]
    c = collections.Counter(w for _, held, b in texts if not held for w in tokens(b))
    n, v = sum(c.values()), len(c)
    return [(i, held, len(tokens(b)), sum(c[w] > 0 for w in tokens(b)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(b)), s) for (i, held, b), (_, _, s) in zip(texts, out, strict=True)]


def assert_scores(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, round(r[-1], 3))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=order)
    want = sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9) and [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=1e-5, abs=1e-5)


@pytest.fixture(scope="module")
def worded():
    rng = random.Random(3)
    words = ["Über", "the", "cat", "sat", "on", "ma\nt", "zürich", "Tomorrow", "☃"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(None, "the cat"), (7, None), (8, ""), (9, "the cat"), (9, "the cat"), (10, " \n\t")]


def test_scores(spark, worded):
    docs = spark.createDataFrame(worded, "doc_id long, text string").selectExpr("*", "1 as score", "true as held_out", "2 as block")
    got = context_tree.score(docs, Scratch(spark, "t")).collect()
    assert_scores(got, weighted_tree(worded))
    twice = [r.score for r in got if r.doc_id == 9 and r.n_tokens == 3]
    assert len(twice) >= 2 and len(set(twice)) == 1


def test_scores_by_the_longer_way(spark, worded, monkeypatch):
    """Payloads in two steps, as for very many blocks and buckets, and slices of a few rows."""
    monkeypatch.setattr(exchange, "FAN", 2)
    monkeypatch.setattr(context_tree, "LEAST_BUCKETS", 5)
    monkeypatch.setattr(context_tree, "MIDDLES", 3)
    got = context_tree.score(spark.createDataFrame(worded, "doc_id long, text string"), Scratch(spark, "t")).collect()
    assert_scores(got, weighted_tree(worded))


def test_scores_of_a_whole_table(spark):
    rows = queries()["op11_lm_scoring"](spark, SMALL).collect()
    docs = small_documents()
    few = sorted(docs, key=lambda d: len(d[1] or ""))[:40]
    every = {r.doc_id: r for r in rows}
    tokens = {i: [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = every[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
    assert_scores(context_tree.score(spark.createDataFrame(few, "doc_id long, text string"), Scratch(spark, "t")).collect(), weighted_tree(few))
    bits = {h: [(-r.score / math.log10(2), r.n_bytes) for r in rows if r.held_out == h] for h in (True, False)}
    assert all(sum(b for b, _ in x) / sum(n for _, n in x) < 2.6 for x in bits.values())  # a byte alone takes about 4.3


def test_scores_when_nothing_is_learned(spark):
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    rows = [(k, t) for k, t in zip(held, ("", "ab", None), strict=True)]
    got = {r.doc_id: r for r in context_tree.score(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert [got[k].score for k in held] == pytest.approx([8 * n * math.log10(0.5) for n in (1, 3, 1)], rel=1e-6)
    assert got[held[1]].base_score == 0 and got[held[1]].n_known == 0 and got[held[1]].train_tokens == 0


def test_probabilities_add_up(spark, worded):
    """One byte behind each context: the chances of its 256 values add up to one."""
    keys, counts = [], []
    for _, t in worded:
        k, _ = context_tree.strings(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))
        keys.append(k), counts.append(np.ones(len(k), np.int64))
    keys, counts, _ = context_tree.summed(keys, counts)
    contexts = np.unique(keys >> np.uint64(8))[::7]
    every = (contexts[:, None] << np.uint64(8) | np.arange(256, dtype=np.uint64)).ravel()
    keys, counts, at = context_tree.summed([keys, every], [counts, np.zeros(len(every), np.int64)])
    names = np.unique(np.concatenate([context_tree.Tree(keys, counts).weigh(j)[1].names for j in range(8)]))
    p = context_tree.Tree(keys, counts).log_probabilities(names, np.full(len(names), 0.05), np.full(len(names), 0.9))
    assert np.exp(p[at[1]]).reshape(-1, 256).sum(1) == pytest.approx(np.ones(len(contexts)), abs=1e-9)


def test_payloads():
    for arrays in ([np.zeros(0, np.uint64)], [np.arange(5, dtype=np.int64), np.array([1.5, -2.0]), np.zeros(0, np.float32)]):
        back = context_tree.unpack(context_tree.pack(*arrays))
        assert len(back) == len(arrays) and all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, back, strict=True))


def test_estimates_of_large_counts():
    total, ones = np.array([3, 5000, 10_000_000]), np.array([1, 4990, 3_000_000])
    want = [math.lgamma(t - o + 0.5) + math.lgamma(o + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(t + 1) for t, o in zip(total.tolist(), ones.tolist(), strict=True)]
    assert context_tree.log_estimate(total, ones) == pytest.approx(want, rel=1e-12)


# Periodic runs


def runs_by_brute_force(x):
    out = {}
    for p in range(1, len(x) // 4 + 1):
        i = 0
        while i + p < len(x):
            if x[i] == x[i + p]:
                j = i
                while j + p < len(x) and x[j] == x[j + p]:
                    j += 1
                if j + p - i >= max(6, 4 * p):
                    out.setdefault((i, j + p), p)
                i = j
            i += 1
    return sorted((s, p, e) for (s, e), p in out.items())


def test_runs_of_random_sequences():
    rng = random.Random(1)
    for _ in range(700):
        k = rng.randint(1, 4)
        x = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(x))
            x[at:at] = [rng.randrange(k) for _ in range(rng.randint(1, 5))] * rng.randint(2, 7)
        if rng.random() < 0.4:  # copies, so that runs stand inside one block
            x = x + x[: rng.randint(0, len(x))] + [9] + x
        symbols = np.unique(np.array(x, np.int64), return_inverse=True)[1]
        assert sorted((s, p, e) for s, e, p in periodic.runs_of(symbols).tolist()) == runs_by_brute_force(x)


def test_previous_factors_of_words():
    x = np.random.default_rng(2).integers(0, 3, 200)
    length, source = periodic.Extensions(x).previous_factors()
    common = lambda i, j: next((n for n in range(len(x) - i) if x[i + n] != x[j + n]), len(x) - i)
    assert length.tolist() == [max((common(i, j) for j in range(i)), default=0) for i in range(len(x))]
    assert all(n == 0 or (j < i and common(i, j) == n) for i, (n, j) in enumerate(zip(length.tolist(), source.tolist(), strict=True)))
    assert periodic.runs_of(np.zeros(50_000, np.int64)).tolist() == [[0, 50_000, 1]]


def digests(doc_id, text, stretch):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if stretch and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs, keep, best = runs_by_brute_force(w), [True] * n, None
    for s, p, e in runs:
        keep[s + p : e] = [False] * (e - s - p)
        if best is None or (e - s) * best[1] > (best[2] - best[0]) * p:
            best = (s, p, e)
    top = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha("".join(f"{s},{e - s},{p}\n" for s, p, e in runs)), sha(" ".join(x for x, k in zip(w, keep, strict=True) if k)))


def test_runs_of_a_whole_table(spark):
    got = [tuple(r) for r in queries()["op12_periodic_runs"](spark, SMALL).collect()]
    want = [digests(i, t, True) for i, t in small_documents() if len((t or "").split()) < 4000]
    assert sorted(r for r in got if r[0] in {x[0] for x in want}) == sorted(want) and any(r[1] > 1 for r in got) and any(r[1] == 0 for r in got)


def test_runs_of_awkward_texts(spark):
    texts = [None, "", " \t\n", "a a a a a", "a a a a a a", "a\ta\na a\x0ba a a", "a b " * 4, "a b " * 3 + "a", "É é " * 5, "x " * 30_000, "to be or " * 9 + "not " + "to be or " * 9, "a a a a a a b b b b b b"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(4, texts[4]), (None, texts[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as start")
    got = {}
    for r in periodic.repetitions(docs).collect():
        got.setdefault((r.doc_id, len(r.runs)), (r.start, r.length, r.period, [(x.start, x.period, x.start + x.length) for x in r.runs], r.collapsed))
    for i, t in rows:
        if i != 9:
            n = digests(i, t, False)
            found = got[i, n[1]]
            assert found[:3] == n[2:5] and hashlib.sha256(found[4].encode()).hexdigest() == n[7] and found[3] == runs_by_brute_force(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert got[9, 1][:3] == (0, 30_000, 1) and got[9, 1][4] == "x" and got[11, 2][:3] == (0, 6, 1)


# Spelling variants


def variants_by_brute_force(docs):
    c = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            c[run] += 1
    words = {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}
    gaps = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            gaps[w[:k] + "\0" + w[k + 1 :]].add(w)
    near = collections.defaultdict(set)
    for same in gaps.values():
        for a in same:
            near[a] |= same - {a}
    for w in words:
        for k in range(len(w)):
            if (d := w[:k] + w[k + 1 :]) in words:
                near[w].add(d), near[d].add(w)
    form = {}
    for w, n in words.items():
        f = min(near[w], key=lambda x: (-words[x], x), default=None)
        if f and words[f] >= 2 * n:
            form[w] = f

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def test_variants_of_a_whole_table(spark):
    got = [tuple(r) for r in queries()["op13_spelling_variants"](spark, SMALL).collect()]
    assert len(got) == len(set(got)) and set(got) == variants_by_brute_force(small_documents())


def test_variants_of_small_alphabets(spark, monkeypatch):
    """Few letters, so that anagrams, double letters, ties and chains abound."""
    monkeypatch.setattr(spelling, "HELD", 50)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcÿ", k=rng.randint(4, 7))) for _ in range(260)] + ["aaaaa", "aaaaaa", "a" * 9_000, "a" * 9_001, "ab" * 4_000]
    docs = [(k, " ".join(w for w in words for _ in range(rng.choice([1, 1, 2, 4, 9, 40]))) + "! ×÷ Ünder") for k in range(4)] + [(None, "ABABA abaaa"), (None, "ABABA"), (3, "ababa"), (3, "ababa"), (5, None), (6, ""), (7, "- 12")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as root")
    got = [tuple(r) for r in spelling.variants(df, Scratch(spark, "t")).collect()]
    assert len(got) == len(set(got)) and set(got) == variants_by_brute_force(docs)


def test_variants_of_chains(spark):
    """Each word is near the next only, with twice its count: roots are many forms away."""
    chain = ["abcde" + "x" * k for k in range(7)]
    docs = [(1000 + k, " ".join([w] * (3 << k))) for k, w in enumerate(chain)]
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert {r[0]: r[2] for r in variants_by_brute_force(docs)} == got and len(set(got.values())) < len(got)


def test_spelling_builds_no_side_in_the_driver(spark, monkeypatch):
    plans = []
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or save(self, df, name))
    docs = [(i, f"{w} {w} {w}") for i, w in enumerate(("recieve recieve receive", "receive receive receive", "received"))]
    got = spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark, "t"))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)
