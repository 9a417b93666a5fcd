"""Spelling variants: words that differ by one letter, found by anagram hashing.

1. Tasks count the words of their documents and send each distinct one once a flush; sums by word make the vocabulary.
2. A word's anagram key is the sum of the fifth powers of its letters (modulo a prime, so that it fits a long whatever the
   length). Two words differ by an added or removed letter only if their keys differ by that letter's value, and by an
   exchanged letter only if they differ by the difference of two values. Each word therefore is listed under its key less the
   value of each of its distinct letters, and under its key itself; lists with equal keys are joined. Fifth powers of letters have no two equal
   sums of two, so a pair meets once.
3. Large anagram groups are split by letter order before the join: one changed letter leaves the first or the last half of
   the rest as it is, so lists are keyed by these halves too. What meets is verified by its edit distance.
4. Each word takes its best near word; roots follow from joins that double their reach, in rounds as deep as a logarithm of a chain that itself is no
   longer than the logarithm of the largest count.

Nothing is collected, and no group's pairs are made in one task: the join is Spark's own, which splits skewed keys. The joins are hinted to
merge: Spark takes a small table of words for a small side, whatever the lists that come of it, and would build these in the driver.

Defined results: null text has no words; a null doc_id counts as the empty string before the colon; each row counts, repeated rows too.
Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import collections
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm.scratch import Scratch

LEAST_LENGTH = 5
LEAST_COUNT = 3
NOISE = 97
RATIO = 2
HELD = 300_000
PRIME = (1 << 61) - 1

_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(doc_id: int | None, text: str | None) -> collections.Counter:
    """Words of one document and how often they occur, those of fewer than ``LEAST_LENGTH`` letters left out."""
    out: collections.Counter = collections.Counter()
    if not text:
        return out
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in collections.Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
        h = zlib.crc32(run.encode(), before)
        if h % NOISE == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        if len(run) >= LEAST_LENGTH:
            out[run] += n
    return out


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: collections.Counter = collections.Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total.update(words_of(i, t.as_py()))
            if len(total) >= HELD:
                yield out()
                total.clear()
    if total:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of words with at least ``LEAST_COUNT`` occurrences."""
    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_value(letter: Column) -> Column:
    """Fifth power of a code point below 256."""
    c = F.ascii(letter).cast("long")
    return c * c * c * c * c


def anagram_key(letters: Column) -> Column:
    return F.aggregate(letters, F.lit(0).cast("long"), lambda a, c: F.pmod(a + letter_value(c), F.lit(PRIME)))


def listed(words: DataFrame) -> DataFrame:
    """(word, n, key, less, rest, side, half): every word under its anagram key less each of its letters, and less nothing."""
    keyed = words.withColumn("letters", F.split("word", "")).withColumn("key", anagram_key(F.col("letters")))
    less = F.transform(F.array_distinct("letters"), lambda c: F.struct(F.pmod(F.col("key") - letter_value(c), F.lit(PRIME)).alias("less"), (F.length("word") - 1).alias("rest")))
    own = F.array(F.struct(F.col("key").alias("less"), F.length("word").alias("rest")))
    rows = keyed.select("word", "n", "key", F.inline(F.concat(own, less))).withColumn("h", F.floor(F.col("rest") / 2).cast("int"))
    return rows.select("word", "n", "key", "less", "rest", F.inline(F.array(
        F.struct(F.lit("first").alias("side"), F.expr("left(word, h)").alias("half")),
        F.struct(F.lit("last").alias("side"), F.expr("right(word, h)").alias("half")),
    )))


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n) of all ordered pairs that differ by exactly one inserted, deleted or replaced letter."""
    a = listed(words).withColumnRenamed("n", "own_n").alias("a")
    b = listed(words).select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("key").alias("other_key"), "less", "rest", "side", "half")
    met = a.join(b.hint("merge"), ["less", "rest", "side", "half"]).where(F.col("key") != F.col("other_key"))
    once = (F.col("side") == "first") | (F.expr("left(word, int(floor(rest / 2)))") != F.expr("left(other, int(floor(rest / 2)))"))
    return met.where(once & (F.levenshtein("word", "other", 1) == 1)).select("word", "other", "other_n")


def variants(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = scratch.save(vocabulary(docs), "words")
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form"))).alias("best"))
    joined = words.join(best.hint("merge"), "word", "left")
    takes = -F.col("best.n") >= RATIO * F.col("n")
    forms = scratch.save(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.form")).alias("form"), F.when(takes, -F.col("best.n")).alias("form_n")), "forms")
    roots, k = scratch.save(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        k += 1
        far = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = scratch.save(roots.join(far.hint("merge"), "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), f"roots-{k}")
        scratch.drop(f"roots-{k - 1}")
        roots = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
    scratch.keep("forms", f"roots-{k}")
    return forms.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "spelling"))
