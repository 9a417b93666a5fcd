"""Registered queries on whole small tables against brute force, and on empty and awkward tables."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_exact import LOWER, components_by_brute_force, kept_by_brute_force

from uttera.llm import jaccard, privacy, quality, substrings
from uttera.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
TABLES = {
    "documents": pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]),
    "pages": pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]),
    "benchmark": pa.schema([("item_id", pa.int64()), ("text", pa.string())]),
    "labels": pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]),
}
CLASH = ("n_words", "kept", "spans", "k1", "block", "bucket", "root", "host", "rule", "verdict", "hit", "items", "start", "length", "size", "sha", "score", "tie", "__word", "tokens", "n")


def folder(path, rows, clash=False):
    for name, schema in TABLES.items():
        columns = list(zip(*rows.get(name, []), strict=True)) or [[]] * len(schema)
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        for c in CLASH if clash else ():
            table = table.append_column(c, pa.array([f"{c}!"] * table.num_rows, pa.string()))
        pq.write_table(table, path / f"{name}.parquet")
    return str(path)


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_BUCKETS", 4)
    monkeypatch.setattr(substrings, "LEAST", 4)


@pytest.mark.parametrize("name", sorted(queries()))
def test_empty_tables(spark, tmp_path, name):
    assert queries()[name](spark, folder(tmp_path, {})).collect() == []


@pytest.fixture(scope="module")
def awkward_folder(tmp_path_factory):
    long = " ".join(f"word{k % 977} and {k}." for k in range(12_000)) + " jo.smith77@mail.example.org é" * 3
    texts = [None, "", " \n\t", "One", "one ", "ab " * 30, long, long, long[:-5], "é\u0301ü " * 80, "plain words of a text " * 20, "plain words of a text " * 20]
    docs = [(k, t, "en" if k % 2 else None, "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    docs += [(3, "One", "en", "s", 3), (3, "Other words here", "de", "s", 16), (None, "plain words of a text " * 20, None, None, None), (None, None, None, None, None)]
    pages = [(k, u, h) for k, (u, h) in enumerate([(None, None), ("", ""), ("x://a.net/es/", "<p>"), ("http://b.org/", '<a href="//a.net/">' * 3), ("http://b.org/", "<p>"), ("no scheme", "x" * 3_000_000)])]
    pages += [(2, "x://a.net/es/", "<p>"), (None, "http://c.com", "<p>")]
    benchmark = [(1, "plain words of a text plain words of a text plain words of a text"), (1, "plain words of a text plain words of a text plain words of a text"), (2, None), (None, "one"), (3, "")]
    labels = [(k, k % 2, 0) for k in range(12)] + [(3, None, 1), (None, 1, 1)]
    path = tmp_path_factory.mktemp("awkward")
    return folder(path, {"documents": docs, "pages": pages, "benchmark": benchmark, "labels": labels}, clash=True), docs, pages


@pytest.mark.parametrize("name", sorted(n for n in queries() if n != "pipeline"))
def test_awkward_tables(spark, awkward_folder, name):
    path, docs, pages = awkward_folder
    rows = queries()[name](spark, path).collect()
    key, source = ("page_id", pages) if name.startswith(("op5", "op10")) else ("doc_id", docs)
    want = collections.Counter(r[0] for r in source)
    if name == "op2_packing":
        assert {r.doc_id for r in rows} == set(want)
        texts = collections.Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
        assert sum(texts.values()) == len(docs)
    elif name == "op13_spelling_variants":
        assert len({r.word for r in rows}) == len(rows) and {"plain", "words"} <= {r.word for r in rows}
    else:
        assert collections.Counter(r[key] for r in rows) == want
    if name == "op1_suffix_dedup":
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows if r.n_bytes < 10_000)
        assert got == [r[:5] for r in kept_by_brute_force([d[:2] for d in docs if len(d[1] or "") < 5_000])]
    if name == "op3_ngram_jaccard":
        assert {r.doc_id: r.component_id for r in rows if r.doc_id in (6, 7, 8, 10, 11)} == {6: 6, 7: 6, 8: 6, 10: 10, 11: 10}


def test_pipeline_on_awkward_tables(spark, awkward_folder):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, awkward_folder[0]).columns[:4] == ["doc_id", "start", "length", "ids_crc32"]


def encoded(name, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    return {i: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}


def small_documents():
    t = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(t["doc_id"], t["text"], strict=True))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def assert_packed(rows, ids):
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, parts in pieces.items():
        at = 0
        for start, length, check, total in sorted(parts):
            assert start == at and total == len(ids[i]) and check == crc(ids[i][start : start + length])
            at += length
        assert at == len(ids[i])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_query(spark):
    assert_packed(queries()["op2_packing"](spark, SMALL).collect(), encoded("byte_bpe_50k.json", small_documents()))


def test_token_shards_query(spark):
    ids, at = encoded("word_bpe_49k.json", small_documents()), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries()["op8_token_shards"](spark, SMALL).collect()}
    for i in sorted(ids):
        assert got.pop(i) == (at, len(ids[i]), crc(ids[i]))
        at += len(ids[i])
    assert not got


def test_pipeline_by_brute_force(spark):
    """run() against the stages one document at a time; the two models are those that the stages train on the same rows."""
    import corpus_pipeline

    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r.doc_id: r.text for r in quality.score(docs, labels).where("kept").select("doc_id", "text").collect()}
    first = components_by_brute_force(kept.items())
    kept = {i: t for i, t in kept.items() if first[i][1] == i}
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = set()
    for t in pq.read_table(f"{SMALL}/benchmark.parquet").column("text").to_pylist():
        w = words(t)
        windows |= {tuple(w[k : k + min(13, len(w))]) for k in range(max(1, len(w) - 12) if w else 0)}
    for i in list(kept):
        w, hit = words(kept[i]), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
        if hit and 20 * len(hit) >= len(w):
            del kept[i]
    model = privacy.fit(spark.createDataFrame(list(kept.items()), "doc_id long, text string"))
    for i, t in kept.items():
        (found,), (added,) = privacy.spans_of([t], model)
        spans = [(k, a, b) for k in privacy.KINDS for a, b in found[k]] + added
        kept[i] = privacy.replaced(t, spans) if spans else t
    assert_packed(corpus_pipeline.run(spark, SMALL).collect(), encoded("byte_bpe_50k.json", kept))
