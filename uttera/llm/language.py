"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the character 3- and 4-grams of the lower-cased bytes of each word with its edges.
Each hashes to one of ``BUCKETS`` embeddings; a text is their mean over the whole text, and a
linear softmax gives the languages. Embeddings and softmax are trained together by mini-batch
stochastic gradient descent in numpy on a bounded sample (``TRAIN_ROWS`` documents with the
smallest hashes of doc_id). For scoring, embedding and softmax are multiplied out, which is the
same function. The temperature is fitted on a held-back fifth of the sample, and the rejection
threshold is the score below which only ``REJECT`` of that fifth's right answers fall.

Held out are the documents whose crc32(doc_id as text) mod 4 is 2; they teach nothing. A null
doc_id is not held out and teaches nothing. Predictions use the text alone. Null text, and text without any
letter, gives ``und`` with score 0 and is ``rejected``; so does everything if nothing was learnt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B

TRAIN_ROWS = 3000
BUCKETS = 1 << 16
DIM = 16
REJECT = 0.005
_SHIFT = np.uint32(16)


def spelled(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """The bytes in lower case with a space for all that is no letter, three spaces behind them, their number, and the ends of rows."""
    low = B.LOWER[data]
    padded = np.full(len(low) + 3, 0x20, np.uint32)
    padded[: len(low)] = np.where(B.ALNUM_WORD[low] & ((low < 0x30) | (low > 0x39)), low, np.uint8(0x20))
    return padded, len(low), off[1:][off[:-1] < off[1:]]


def subwords(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed subwords of each row and their len+1 bounds. Digits and punctuation count as word edges."""
    padded, n, ends = spelled(data, off)
    three = padded[:n] | padded[1 : n + 1] << 8 | padded[2 : n + 2] << 16
    four = three | padded[3 : n + 3] << 24
    good3, good4 = (padded[1 : n + 1] != 0x20), (padded[1 : n + 1] != 0x20) & (padded[2 : n + 2] != 0x20)
    for back in (1, 2):
        at = ends - back
        good3[at[at >= 0]] = False  # a gram that would run into the next row
    for back in (1, 2, 3):
        at = ends - back
        good4[at[at >= 0]] = False
    i3, i4 = np.flatnonzero(good3), np.flatnonzero(good4)
    at = np.concatenate([i3, i4])
    idx = np.concatenate([(three[i3] * np.uint32(0x9E3779B1)) >> _SHIFT, (four[i4] * np.uint32(0x85EBCA6B)) >> _SHIFT]).astype(np.int32)
    rows = np.searchsorted(off, at, "right") - 1
    order = np.argsort(rows, kind="stable")
    return idx[order], np.searchsorted(rows[order], np.arange(len(off)))


def table_scores(data: np.ndarray, off: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logits of each row: the mean over its subwords of rows of ``table``, plus ``bias``."""
    padded, n, ends = spelled(data, off)
    three = padded[:n] | padded[1 : n + 1] << 8 | padded[2 : n + 2] << 16
    total, count = np.zeros((len(off) - 1, table.shape[1])), np.zeros(len(off) - 1, np.int64)
    good = padded[1 : n + 1] != 0x20
    for size, code, salt in ((3, three, 0x9E3779B1), (4, three | padded[3 : n + 3] << 24, 0x85EBCA6B)):
        if size == 4:
            good = good & (padded[2 : n + 2] != 0x20)
        for back in range(1, size):
            at = ends - back
            good[at[at >= 0]] = False
        at = np.flatnonzero(good)
        bounds = np.searchsorted(at, off)
        idx = (code[at] * np.uint32(salt)) >> _SHIFT
        for k in range(table.shape[1]):
            total[:, k] += B.sum_rows(table[:, k][idx].astype(np.float64), bounds)
        count += np.diff(bounds)
    return total / np.maximum(count, 1)[:, None] + bias


def packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct subwords and their shares of each training text, packed."""
    for rows, data, off in B.blocks(batches):
        idx, bounds = subwords(data, off)
        out = []
        for r in range(rows.num_rows):
            u, c = np.unique(idx[bounds[r] : bounds[r + 1]], return_counts=True)
            out.append(u.astype(np.uint16).tobytes() + (c / max(c.sum(), 1) * 64).astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("lang"), pa.array(out, pa.binary())], ["doc_id", "lang", "packed"])


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 6, batch: int = 32, rate: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings (BUCKETS, DIM), softmax weights and biases by stochastic gradient descent."""
    rng = np.random.default_rng(11)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, b = rng.normal(0, 0.3, (DIM, classes)).astype(np.float32), np.zeros(classes, np.float32)
    steps, done = epochs * -(-len(rows) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), batch):
            some = order[a : a + batch]
            idx, val = np.concatenate([rows[i][0] for i in some]), np.concatenate([rows[i][1] for i in some])
            at = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in some])])[:-1]
            mean = np.add.reduceat(emb[idx] * val[:, None], at, axis=0)
            z = mean @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p /= len(some)
            lr = rate * (1 - done / steps)
            pull = (p @ w.T)[np.repeat(np.arange(len(some)), np.diff(np.append(at, len(idx))))] * val[:, None]
            w -= lr * mean.T @ p
            b -= lr * p.sum(0)
            order2 = np.argsort(idx, kind="stable")
            u, first = np.unique(idx[order2], return_index=True)
            emb[u] -= lr * 20 * np.add.reduceat(pull[order2], first, axis=0)
            done += 1
    return emb, w, b


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits, of a fixed grid, with the least log loss."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.1, 10, 41):
        s = z / t
        s = s - s.max(1, keepdims=True)
        loss = (np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean()
        best = min(best, (loss, t))
    return float(best[1])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """(languages, table, bias, rejection threshold) learnt from the documents that are not held out."""
    able = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("doc_id", "lang")
    sample = able.orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(train_rows)
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"], "left_semi")  # train_rows bounds the broadcast
    one = texts.mapInArrow(packed_rows, "doc_id long, lang string, packed binary").groupBy("doc_id", "lang").agg(F.min("packed").alias("packed"))  # one of several texts, always the same
    got = one.toPandas().sort_values(["doc_id", "lang"])
    rows, langs = [], []
    for lang, p in zip(got["lang"], got["packed"], strict=True):
        n = len(p) // 4
        if n:
            rows.append((np.frombuffer(p, np.uint16, n).astype(np.int32), np.frombuffer(p, np.float16, n, 2 * n).astype(np.float32) / 64))
            langs.append(lang)
    names = sorted(set(langs))
    if not names:
        return [], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 1.0
    y = np.array([names.index(x) for x in langs])
    back = np.arange(len(rows)) % 5 == 4
    if back.all() or not back.any():
        back[:] = False
    fitted = np.flatnonzero(~back)
    emb, w, b = train([rows[i] for i in fitted], y[fitted], len(names))
    table, bias, threshold = emb @ w, b.astype(np.float64), 0.0
    if back.any():
        z = np.array([(table[rows[i][0]] * rows[i][1][:, None]).sum(0) for i in np.flatnonzero(back)]) + bias
        t = temperature(z, y[back])
        table, bias, z = table / t, bias / t, z / t
        p = np.exp(z - z.max(1, keepdims=True))
        p = p.max(1) / p.sum(1)
        right = z.argmax(1) == y[back]
        threshold = float(np.quantile(p[right], REJECT)) if right.any() else 1.0
    return names, table.astype(np.float32), bias, threshold


def predict(names: list[str], table: np.ndarray, bias: np.ndarray, threshold: float):
    """mapInArrow function: appends lang_pred, score and rejected. The last input column, has_letter, is taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap()
        for rows, data, off in B.blocks(batches):
            z = table_scores(data, off, table, bias)
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            able = rows.column(rows.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool) & bool(names)
            score = np.where(able, p[np.arange(len(best)), best], 0.0)
            lang = [names[k] if ok else "und" for k, ok in zip(best, able, strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(score < threshold)], [*rows.schema.names[:-1], "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, held_out, lang_pred, score and rejected (the score is below the calibrated threshold)."""
    model = fit(docs, train_rows)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"), F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("has_letter"))
    return rows.mapInArrow(predict(*model), "doc_id long, text string, held_out boolean, lang_pred string, score double, rejected boolean")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")).drop("text")
