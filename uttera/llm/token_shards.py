"""Token shards: ids in ascending doc_id order, each shard a wavelet matrix in one compressed file.

Documents are range-partitioned and sorted by doc_id (nulls first; rows of a repeated id stand together, by a hash of
their text); each task encodes its texts and writes shards of about ``SHARD`` ids, ``PER_FILE`` a file. A shard
is a header, the document ids and sizes, a directory and the bit planes of its wavelet matrix in chunks of ``CHUNK`` bits,
each compressed. The directory has the place of every chunk and the ones before it, so ``ShardFile`` answers
token access, counting and occurrence lookup from the file by reading a chunk a level; ``token_counts`` and ``occurrences``
do so for a whole folder. Reading all of a shard back undoes the partitions. Files are written by Spark's own writer with
its commit protocol, so a lost executor's tasks are simply run again, and on any file system: a shard ends in
a line feed, which the text writer adds. They are read as streams, a shard at a time.

Null or empty text is the end id alone. No documents make no shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm.scratch import Scratch, open_file, shuffles_removed
from uttera.llm.tokens import Encoder, with_end
from uttera.llm.wavelet import Queries, WaveletMatrix, bit_at

SHARD = 2 << 20
PER_FILE = 64
CHUNK = 1 << 16
NULL_ID = -(1 << 63)
_HEAD = struct.Struct("<4sQQQII")  # magic, body bytes, documents, tokens, bits, bytes of the compressed document table


def shard_bytes(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard, less its closing line feed."""
    bits = max(1, int(ids.max()).bit_length() if len(ids) else 1)
    size, ones, body = [], [], []
    for plane in WaveletMatrix(ids, bits).planes:
        chunks = [plane[a : a + CHUNK // 8] for a in range(0, len(plane), CHUNK // 8)]
        packed = [pa.compress(c.tobytes(), "zstd", asbytes=True) for c in chunks]
        size.append([len(c) for c in packed])
        ones.append(np.concatenate([[0], np.cumsum([int(np.bitwise_count(c).sum()) for c in chunks])]))
        body += packed
    table = pa.compress(doc_ids.astype("<i8").tobytes() + sizes.astype("<i8").tobytes(), "zstd", asbytes=True)
    body = b"".join([table, np.array(size, "<u4").tobytes(), np.array(ones, "<u8").tobytes(), *body])
    return _HEAD.pack(b"UTS2", len(body), len(doc_ids), len(ids), bits, len(table)) + body


class ShardFile(Queries):
    """A shard that begins at a place of an open file; a query reads the chunks that it touches and keeps them."""

    def __init__(self, file, at: int = 0):
        file.seek(at)
        magic, size, self.docs, self.n, self.bits, table = _HEAD.unpack(file.read(_HEAD.size))
        if magic != b"UTS2":
            raise ValueError("not a token shard")
        self.file, self.end, self.table = file, at + _HEAD.size + size + 1, table
        self.chunks = -(-self.n // CHUNK)
        raw = file.read(table + 4 * self.bits * self.chunks + 8 * self.bits * (self.chunks + 1))
        head = np.frombuffer(pa.decompress(raw[:table], 16 * self.docs, "zstd", asbytes=True), "<i8")
        self.doc_ids, self.sizes = head[: self.docs], head[self.docs :]
        size = np.frombuffer(raw, "<u4", self.bits * self.chunks, table).astype(np.int64)
        self.before = np.frombuffer(raw, "<u8", offset=table + size.nbytes // 2).astype(np.int64).reshape(self.bits, self.chunks + 1)
        self.place = at + _HEAD.size + len(raw) + np.concatenate([[0], np.cumsum(size)])
        self.zeros = (self.n - self.before[:, -1]).tolist()
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _plain(self, raw: bytes, k: int) -> bytes:
        c = k % self.chunks
        return pa.decompress(raw, -(-min(CHUNK, self.n - c * CHUNK) // 8), "zstd", asbytes=True)

    def _chunk(self, level: int, c: int) -> tuple[np.ndarray, np.ndarray]:
        """64-bit words of a chunk, and the ones before each of them."""
        k = level * self.chunks + c
        if k not in self.kept:
            self.file.seek(int(self.place[k]))
            plain = self._plain(self.file.read(int(self.place[k + 1] - self.place[k])), k)
            words = np.zeros(CHUNK // 64, np.uint64)
            words.view(np.uint8)[: len(plain)] = np.frombuffer(plain, np.uint8)
            self.kept[k] = words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return self.kept[k]

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        out = self.before[level][i // CHUNK].copy()
        inner = i % CHUNK
        for c in np.unique(i[inner > 0] // CHUNK).tolist():
            mine = np.flatnonzero((i // CHUNK == c) & (inner > 0))
            words, ones = self._chunk(level, c)
            x = inner[mine]
            out[mine] += ones[x >> 6] + np.bitwise_count(words[x >> 6] & ((np.uint64(1) << (x & 63).astype(np.uint64)) - np.uint64(1)))
        return out

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), bool)
        for c in np.unique(i // CHUNK).tolist():
            mine = np.flatnonzero(i // CHUNK == c)
            x = i[mine] % CHUNK
            out[mine] = (self._chunk(level, c)[0][x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) != 0
        return out

    def _select(self, level: int, k: np.ndarray, one: bool) -> np.ndarray:
        before = self.before[level] if one else np.minimum(CHUNK * np.arange(self.chunks + 1), self.n) - self.before[level]
        chunk = np.searchsorted(before, k, "right") - 1
        out = np.zeros(len(k), np.int64)
        for c in np.unique(chunk).tolist():
            mine = np.flatnonzero(chunk == c)
            words, ones = self._chunk(level, c)
            inside = ones if one else 64 * np.arange(len(ones)) - ones
            at = np.searchsorted(inside, k[mine] - before[c], "right") - 1
            out[mine] = CHUNK * c + 64 * at + bit_at(words[at] if one else ~words[at], k[mine] - before[c] - inside[at])
        return out

    def decode(self) -> np.ndarray:
        """All ids of the shard."""
        self.file.seek(int(self.place[0]))
        raw, place = self.file.read(int(self.place[-1] - self.place[0])), (self.place - self.place[0]).tolist()
        plain = [self._plain(raw[place[k] : place[k + 1]], k) for k in range(self.bits * self.chunks)]
        planes = [np.frombuffer(b"".join(plain[x : x + self.chunks]), np.uint8) for x in range(0, len(plain), self.chunks)]
        return WaveletMatrix.of_planes(planes, self.n).decode()


def shards_of(file) -> Iterator[ShardFile]:
    """Every shard of an open file, one after the other."""
    at = 0
    file.seek(0, 2)
    end = file.tell()
    while at < end:
        shard = ShardFile(file, at)
        yield shard
        at = shard.end


def encode_shards(path: str, shard: int, fold: bool):
    """mapInArrow function: sorted documents in, shards out, of about ``shard`` ids (a longer text is not divided)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap(encoders=True)
        encoder = Encoder.of(path, fold)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def out() -> pa.RecordBatch:
            docs, sizes, ids = (np.concatenate([h[k] for h in held]) for k in range(3))
            return pa.RecordBatch.from_arrays([pa.array([shard_bytes(docs, sizes, ids)], pa.binary())], ["shard"])

        for rows, data, off in B.blocks(batches):
            ids, bounds = with_end(*encoder.encode(data, off))
            held.append((rows.column("doc_id").fill_null(NULL_ID).to_numpy(), np.diff(bounds), ids))
            count += len(ids)
            if count >= shard:
                yield out()
                held, count = [], 0
        if held:
            yield out()

    return run


def write_shards(docs: DataFrame, tokenizer: str, folder: str, fold: bool = True) -> None:
    """Shards of all documents in ``folder``. ``fold`` is for vocabularies that drop white space and case."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shards = ordered.drop("tie").mapInArrow(encode_shards(tokenizer, SHARD, fold), "shard binary")
    with shuffles_removed(docs.sparkSession):
        lines = shards.select(F.col("shard").cast("string").alias("value"))
        lines.write.option("lineSep", "\n").option("maxRecordsPerFile", PER_FILE).text(folder)


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """path and order (task, then file of the task: a name's numbers, whatever their width) of the folder's files, spread over tasks."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path")
    number = lambda p: F.regexp_extract("path", p, 1).cast("long")
    listed = files.select("path", F.struct(number(r"part-(\d+)-[^/]*$").alias("task"), F.coalesce(number(r"-c(\d+)[^/]*$"), F.lit(0)).alias("file")).alias("order"))
    return listed.repartition(max(1, min(listed.count(), 10_000)), "path")


def decode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each file: position in the file, size and crc32 of the ids, from the shards alone."""
    B.keep_heap(encoders=True)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            base = 0
            with open_file(path) as file:
                for shard in shards_of(file):
                    bounds = np.concatenate([[0], np.cumsum(shard.sizes)])
                    raw = memoryview(shard.decode().view(np.uint8))
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * shard.docs, pa.string()), pa.array(shard.doc_ids.astype(np.int64), mask=shard.doc_ids == NULL_ID), pa.array(base + bounds[:-1]), pa.array(shard.sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                        ["path", "doc_id", "at", "n_tokens", "ids_crc32"],
                    )
                    base += int(bounds[-1])


def read_documents(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the folder's files.

    Starts need the totals of the files before: one number a file of up to ``PER_FILE`` shards.
    """
    files = scratch.save(files_of(spark, folder), "files")
    docs = scratch.save(files.select("path").mapInArrow(decode_files, "path string, doc_id long, at long, n_tokens long, ids_crc32 long"), "documents")
    totals = docs.groupBy("path").agg(F.sum("n_tokens").alias("n")).join(files, "path")
    bases, total = [], 0
    for name, n, _ in sorted(totals.select("path", "n", "order").collect(), key=lambda r: tuple(r[2])):
        bases.append((name, total))
        total += n
    table = spark.createDataFrame(bases, "path string, base long")
    return docs.join(F.broadcast(table), "path").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")  # one row a file


def token_counts(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of a few tokens occurs in the folder's files, by rank queries on their directories and chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    for shard in shards_of(file):
                        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([shard.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return files_of(spark, folder).select("path").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(doc_id, position in the document) of every occurrence of a token, by select queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    for shard in shards_of(file):
                        at, bounds = shard.positions(token), np.concatenate([[0], np.cumsum(shard.sizes)])
                        doc = np.searchsorted(bounds, at, "right") - 1
                        yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[doc].astype(np.int64), mask=shard.doc_ids[doc] == NULL_ID), pa.array(at - bounds[doc])], ["doc_id", "position"])

    return files_of(spark, folder).select("path").mapInArrow(run, "doc_id long, position long")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    scratch = Scratch(spark, "token-shards")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), scratch.path("shards"))
    out = read_documents(spark, scratch.path("shards"), scratch)
    scratch.keep("documents")
    scratch.drop("shards")  # read back whole by now
    return out
