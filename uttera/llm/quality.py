"""Quality rules: base counts plus hashed n-gram logistic regressions, scored in Arrow batches.

Two linear models share one hashed feature space of word unigrams, word bigrams, character
4-grams and the first ``PREFIX`` bytes of words (inflected families of words have no frequent member, but a common beginning): one is trained on the label ``quality``, one on ``toxic``. Both are fitted by full-batch
adaptive gradient steps on a bounded sample of labelled rows (``TRAIN_ROWS``, the smallest hashes
of doc_id, so the choice does not depend on input order). How much evidence a feature needs is
chosen for each model by cross-validation (``CAUTIONS``), a task a fold, whose scores of left-out rows also give
the Platt calibration. A document is kept if it passes the base rules, its calibrated quality is
at least ``MIN_QUALITY`` and its calibrated toxicity below ``MAX_TOXIC``.

Defined results: null or empty text has no words, so it fails the base rules. Labels that are
null, or whose document is missing, teach nothing; several labels of one document are averaged.
Without labelled rows of both classes a model stays neutral and rejects nothing. Repeated
documents are judged alike, once per row. Columns of the input other than doc_id and text are
ignored by the query; ``score`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm.columns import shielded

TRAIN_ROWS = 4000
BITS = 18
PREFIX = 6  # bytes of a word's beginning
CAUTIONS = (4.0, 3.0, 2.0, 1.0, 0.0)  # tried in this order until the loss grows
FOLDS = 4
WAVES = ((0, 1, 2), (3,), (4,))  # numbers of the cautions that are tried at once
MOST_FEATURES = 20_000  # distinct features of a training row that count: those that it has most often
CHUNK = 500_000  # features that a training step looks at at once
MIN_QUALITY = 0.5
MAX_TOXIC = 0.3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = B.lut(b"#*$%&|<>")
_U = np.uint64


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules for each row of a block."""
    starts, ends, bounds = B.words(data, off, B.SPACE_WORD)
    rows = B.rows_of(bounds)
    prefix = B.prefix_hash(data)
    hashes = B.range_hash(prefix, starts, ends)
    out = {"n_words": np.diff(bounds), "word_chars": B.sum_rows(B.SPACE_WORD[data] & ((data & 0xC0) != 0x80), off), "n_symbols": B.sum_rows(SYMBOLS[data], off)}
    n = len(off) - 1
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts)
    first = np.flatnonzero(np.diff(line + rows, prepend=-1)) if len(starts) else np.zeros(0, np.int64)
    r, k = rows[first], line[first]
    edge = np.concatenate([[-1], breaks, [len(data)]])
    begin, end = np.maximum(off[:-1][r], edge[k] + 1), np.minimum(off[1:][r], edge[k + 1])
    key = B.mix(B.range_hash(prefix, begin, end) + r.astype(_U) * _U(0x9FB21C651E98DF25))
    order = np.argsort(key)
    again = key[order[1:]] == key[order[:-1]]
    out["n_dup_lines"] = np.bincount(r[order[1:]][again], minlength=n)
    covered = np.zeros(len(starts), bool)
    if len(starts) > 2:
        at = np.flatnonzero(rows[2:] == rows[:-2])
        g = hashes[:-2] * _U(0xFF51AFD7ED558CCD) + hashes[1:-1] * _U(0xC4CEB9FE1A85EC53) + hashes[2:] * _U(0x2545F4914F6CDD1D)
        key = B.mix(g + rows[:-2].astype(_U) * _U(0x9FB21C651E98DF25))[at]
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        hit = np.zeros(len(at), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        w = at[hit]
        for d in range(3):
            covered[w + d] = True
    out["n_repeat_words"] = B.sum_rows(covered, bounds)
    return out


def features(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of each row as (indices, bounds): word unigrams, word bigrams, character 4-grams, beginnings of words."""
    low = B.LOWER[data]
    starts, ends, bounds = B.words(low, off, B.ALNUM_WORD)
    h = B.range_hash(B.prefix_hash(low), starts, ends)
    pairs, pair_bounds = B.grams(h, bounds, 2)
    down = _U(64 - BITS)
    groups = [(((h * _U(0x9E3779B97F4A7C15)) >> down).astype(np.int32), bounds), (((pairs * _U(0xC2B2AE3D27D4EB4F)) >> down).astype(np.int32), pair_bounds)]
    wide = data.astype(np.uint32)
    code = np.zeros(len(data), np.uint32)
    m = len(data) - 3
    if m > 0:
        code[:m] = wide[:m] | wide[1 : m + 1] << 8 | wide[2 : m + 2] << 16 | wide[3 : m + 3] << 24
    idx = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)
    counts = np.maximum(np.diff(off) - 3, 0)
    char_bounds = np.concatenate([[0], np.cumsum(counts)])
    keep = np.repeat(off[:-1] - char_bounds[:-1], counts) + np.arange(char_bounds[-1])
    groups.append((idx[keep], char_bounds))
    long = ends - starts >= PREFIX
    stems = B.range_hash(B.prefix_hash(low), starts[long], starts[long] + PREFIX)
    groups.append((((stems * _U(0x165667B19E3779F9)) >> down).astype(np.int32), np.searchsorted(np.flatnonzero(long), bounds)))
    return groups


def scale(counts: np.ndarray) -> np.ndarray:
    """Weight of one occurrence: the root of the row's number of them, so that a few telling words in a long text still count."""
    return (1 / np.sqrt(np.maximum(counts, 1))).astype(np.float32)


def raw_scores(data: np.ndarray, off: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Linear scores, one column per model. weights: (2**BITS + 1, models), the bias last."""
    total = np.tile(weights[-1].astype(np.float64), (len(off) - 1, 1))
    for idx, bounds in features(data, off):
        per = scale(np.diff(bounds))
        for m in range(weights.shape[1]):
            total[:, m] += B.sum_rows(weights[idx, m].astype(np.float64), bounds) * per
    return total


def sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training features of each sampled document as packed (index, value) arrays of its distinct features."""
    for rows, data, off in B.blocks(batches):
        groups = features(data, off)
        packed = []
        for r in range(rows.num_rows):
            part = [(u, c * scale(b[r + 1 : r + 2] - b[r])[0]) for idx, b in groups for u, c in [np.unique(idx[b[r] : b[r + 1]], return_counts=True)]]
            idx, value = np.concatenate([p[0] for p in part]).astype(np.int32), np.concatenate([p[1] for p in part]).astype(np.float16)
            if len(idx) > MOST_FEATURES:  # bounds what a long text can add to the sample
                top = np.sort(np.argsort(-value, kind="stable")[:MOST_FEATURES])
                idx, value = idx[top], value[top]
            packed.append(idx.tobytes() + value.tobytes())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])


def logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, steps: int = 60, rate: float = 0.3, l2: float = 1e-4, caution: float = CAUTIONS[0]) -> np.ndarray:
    """Weights of a class-balanced logistic regression, the bias last.

    Each feature is first scaled by its log odds between the classes, less ``caution`` standard
    errors, so that what could be chance has weight 0; the regression then learns on the rest.
    """
    good, bad = np.ones(1 << BITS), np.ones(1 << BITS)
    for (i, _), label in zip(rows, y, strict=True):
        (good if label > 0 else bad)[i] += 1
    odds = np.log(good / (y.sum() + 2)) - np.log(bad / ((1 - y).sum() + 2))
    odds = (np.sign(odds) * np.maximum(np.abs(odds) - caution * np.sqrt(1 / good + 1 / bad), 0)).astype(np.float32)
    told = [odds[i] != 0 for i, _ in rows]  # only what is left is ever held for all rows together
    bounds = np.concatenate([[0], np.cumsum([int(t.sum()) for t in told])])
    place = np.zeros(1 << BITS, np.int32)
    for (i, _), t in zip(rows, told, strict=True):
        place[i[t]] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used), dtype=np.int32)
    col, val = np.empty(bounds[-1], np.int32), np.empty(bounds[-1], np.float32)
    for k, ((i, v), t) in enumerate(zip(rows, told, strict=True)):
        mine = slice(bounds[k], bounds[k + 1])
        col[mine], val[mine] = place[i[t]], v[t].astype(np.float32) * odds[i[t]]
    del told
    cut = np.unique([*np.searchsorted(bounds, np.arange(0, bounds[-1], CHUNK)), len(rows)])  # whole rows, so that what a step makes stays small
    w, b = np.zeros(len(used), np.float32), 0.0
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    seen, seen_b = np.full(len(used), 1e-10, np.float32), 1e-10
    for _ in range(steps):
        total, slope = 0.0, np.zeros(len(used))
        for k, n in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            mine = slice(bounds[k], bounds[n])
            row = np.repeat(np.arange(n - k), np.diff(bounds[k : n + 1]))
            z = np.bincount(row, w[col[mine]] * val[mine], n - k) + b
            err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[k:n]) * share[k:n]).astype(np.float32)
            slope += np.bincount(col[mine], err[row] * val[mine], len(used))
            total += float(err.sum())
        grad = slope.astype(np.float32) + l2 * w
        seen += grad * grad
        seen_b += total**2
        w -= rate * grad / np.sqrt(seen)
        b -= rate * total / np.sqrt(seen_b)
    out = np.zeros((1 << BITS) + 1, np.float32)
    out[used], out[-1] = w * odds[used], b
    return out


def platt(z: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of the calibrated logit, by Newton steps with smoothed targets."""
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, h = p - t, np.maximum(p * (1 - p), 1e-6)
        ga, gb, haa, hab, hbb = (g * z).sum(), g.sum(), (h * z * z).sum() + 1e-3, (h * z).sum(), h.sum() + 1e-3
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return float(a), float(b)


def linear(w: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Scores of packed rows under weights with the bias last."""
    return np.array([(w[i] * v.astype(np.float32)).sum() + w[-1] for i, v in rows])


def folds_of(y: np.ndarray) -> np.ndarray | None:
    """The fold of each row, classes spread evenly; None if a class has fewer rows than there are folds."""
    fold = np.zeros(len(y), np.int64)
    for label in (0, 1):
        of = np.flatnonzero(y == label)
        if len(of) < FOLDS:
            return None
        fold[of] = np.arange(len(of)) % FOLDS
    return fold


class Sample:
    """The training rows, packed, and the labels of each model: sent to the tasks that fit."""

    def __init__(self, packed: list[bytes], labels: list[np.ndarray]):
        self.packed = packed
        self.known = [np.flatnonzero(np.isfinite(y)) for y in labels]
        self.y = [(y[k] >= 0.5).astype(np.float64) for y, k in zip(labels, self.known, strict=True)]

    def rows(self, model: int, which: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for i in self.known[model] if which is None else self.known[model][which]:
            p = self.packed[i]
            n = len(p) // 6
            out.append((np.frombuffer(p, np.int32, n), np.frombuffer(p, np.float16, n, 4 * n)))
        return out

    def fit(self, model: int, caution: int, fold: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the rows of a fold under a model of the others, as (rows, scores); without a fold (-1) the weights, as (places, weights)."""
        y = self.y[model]
        if fold < 0:
            w = logistic(self.rows(model), y, caution=CAUTIONS[caution])
            used = np.flatnonzero(w)
            return used, w[used].astype(np.float64)
        of = folds_of(y)
        rest, out = np.flatnonzero(of != fold), np.flatnonzero(of == fold)
        w = logistic(self.rows(model, rest), y[rest], caution=CAUTIONS[caution])
        return out, linear(w, self.rows(model, out)).astype(np.float64)


def fitted(spark: SparkSession, shared, jobs: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]]:
    """The results of ``Sample.fit`` for (model, caution, fold), a task each. shared: a broadcast sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.give_back()
        for batch in batches:
            for job in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, value = shared.value.fit(*job)
                yield pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in job), pa.array([at.astype(np.int64).tobytes()]), pa.array([value.tobytes()])], ["model", "caution", "fold", "at", "value"])

    todo = spark.createDataFrame(spark.sparkContext.parallelize(jobs, max(len(jobs), 1)), "model int, caution int, fold int")
    got = todo.mapInArrow(run, "model int, caution int, fold int, at binary, value binary").collect()
    return {(r.model, r.caution, r.fold): (np.frombuffer(r.at, np.int64), np.frombuffer(r.value)) for r in got}


def validate(spark: SparkSession, sample: Sample, shared) -> list[tuple[int, float, float]]:
    """For each model the caution (its number) of least calibrated log loss on rows left out in turn, and the slope and offset there.

    Cautions are tried in waves, each fold a task, and count in their order until the loss grows. If a class has fewer rows than there
    are folds, the first caution, uncalibrated.
    """
    best = [(0, 1.0, 0.0)] * len(sample.y)
    least, todo = [np.inf] * len(best), [folds_of(y) is not None for y in sample.y]
    for wave in WAVES:
        got = fitted(spark, shared, [(m, c, f) for m, ok in enumerate(todo) if ok for c in wave for f in range(FOLDS)]) if any(todo) else {}
        for m, y in enumerate(sample.y):
            for c in wave if todo[m] else ():
                z = np.zeros(len(y))
                for f in range(FOLDS):
                    out, values = got[m, c, f]
                    z[out] = values
                a, b = platt(z, y)
                loss = np.logaddexp(0, np.where(y > 0, -1, 1) * (a * z + b)).mean()
                if not loss < least[m]:
                    todo[m] = False
                    break
                best[m], least[m] = (c, a, b), loss
    return best


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Calibrated weights (2**BITS + 1, 2) of the quality and toxicity models, fitted in tasks."""
    out = np.zeros(((1 << BITS) + 1, 2), np.float32)
    out[-1] = 5.0, -5.0
    spark = docs.sparkSession
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"), F.avg("toxic").alias("toxic"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")  # train_rows bounds the broadcast
    packed = texts.mapInArrow(sparse_rows, "doc_id long, packed binary").groupBy("doc_id").agg(F.min("packed").alias("packed")).toPandas()  # one of several texts, always the same
    truth = sample.toPandas().set_index("doc_id")
    packed = packed.sort_values("doc_id")
    if not len(packed):
        return out
    learn = Sample(packed["packed"].tolist(), [truth[name].reindex(packed["doc_id"]).to_numpy(float) for name in ("quality", "toxic")])
    del packed
    shared = spark.sparkContext.broadcast(learn)  # the packed sample: train_rows of at most MOST_FEATURES features
    try:
        able = [m for m, y in enumerate(learn.y) if 0 < y.sum() < len(y)]
        best = validate(spark, learn, shared)
        for (m, _, _), (at, w) in fitted(spark, shared, [(m, best[m][0], -1) for m in able]).items():
            _, a, b = best[m]
            out[:, m] = 0
            out[at, m] = w.astype(np.float32)
            out[:, m] *= a
            out[-1, m] += b
    finally:
        shared.destroy()
    return out


def judge(weights: np.ndarray):
    """mapInArrow function that appends counts, calibrated scores and the verdict to whatever columns come in."""
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap()
        for rows, data, off in B.blocks(batches):
            c = base_counts(data, off)
            p = 1 / (1 + np.exp(-np.clip(raw_scores(data, off, weights), -30, 30)))
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
            kept = ~failed & (p[:, 0] >= MIN_QUALITY) & (p[:, 1] < MAX_TOXIC)
            arrays = [*rows.columns, *(pa.array(c[k].astype(np.int64)) for k in added), pa.array(failed), pa.array(kept), pa.array(p[:, 0]), pa.array(p[:, 1])]
            yield pa.RecordBatch.from_arrays(arrays, [*rows.schema.names, *added, "base_failed", "kept", "quality_score", "toxic_score"])

    return run


JUDGED = ", n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, quality_score double, toxic_score double"


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Every column of ``docs`` that does not clash with an added one, plus the counts, scores and verdict."""
    weights = fit(docs, labels, train_rows)
    names = {c.split()[0] for c in JUDGED.split(", ")[1:]}
    left = docs.select(*[c for c in docs.columns if c not in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields)
    return left.mapInArrow(judge(weights), kinds + JUDGED)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that pass, with the columns of ``documents``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return shielded(docs, lambda d: score(d, labels).where("kept"))
