"""Clips from blocks against plain cuts of the whole recording."""

import io
import wave

import numpy as np
import pytest

from uttera.operators import audio
from uttera.sources.files import cut_audio, read_audio
from uttera.sources.wav import read_blocks


def wav(values, rate=16000, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(np.asarray(values, "<i2").tobytes())
    return out.getvalue()


@pytest.mark.parametrize("size", [7, 64, 1000, 16_000])
def test_clips_equal_plain_cuts(spark, size):
    rng = np.random.default_rng(size)
    signals = {v: rng.integers(-(1 << 15), 1 << 15, n) for v, n in ((1, 3000), (2, 16), (3, 1))}
    rows = [(v, i, int(x)) for v, s in signals.items() for i, x in enumerate(s)]
    clips = [(v, f"c{v}-{k}", a, b) for v in signals for k, (a, b) in enumerate([(-5, 2), (0, 1), (0, 500), (3, 3), (9, 4), (10, 187), (187, 188), (60, 1_000_000), (5000, 6000), (-9, -1)])]
    clips.append((4, "none", 0, 10))
    blocks = audio.signal_blocks(spark.createDataFrame(rows, "video_id long, idx long, value int"), "video_id", size)
    assert blocks.selectExpr("max(octet_length(pcm))").first()[0] == 2 * min(size, 3000)
    got = audio.export_clips(blocks, spark.createDataFrame(clips, "video_id long, clip_name string, start_ms long, end_ms long"), "video_id", 16_000, size)
    got = {r.clip_name: bytes(r.wav) for r in got.collect()}
    assert got == {c: cut_audio(wav(signals.get(v, [])), a, b) for v, c, a, b in clips}


def test_two_channels(spark):
    x = np.arange(400).astype("<i2")
    blocks = spark.createDataFrame([(1, k, bytes(x[40 * k : 40 * k + 40].tobytes())) for k in range(10)], "video_id long, block long, pcm binary")
    clips = spark.createDataFrame([(1, "c", 3, 17)], "video_id long, clip_name string, start_ms long, end_ms long")
    (row,) = audio.export_clips(blocks, clips, "video_id", 10_000, 20, 2).collect()
    assert bytes(row.wav) == cut_audio(wav(x, 10_000, 2), 3, 17) and row.n_samples == 140


def test_no_row_holds_a_recording(spark):
    """The join moves blocks and pieces: the widest row is a block, however long the recording is."""
    n = 200_000
    blocks = audio.signal_blocks(spark.range(n).selectExpr("1 as video_id", "id as idx", "int(id % 100) as value"), "video_id", 500)
    clips = spark.createDataFrame([(1, f"c{k}", 1000 * k, 1000 * k + 20) for k in range(12)], "video_id long, clip_name string, start_ms long, end_ms long")
    pieces = audio.clip_pieces(blocks, clips, "video_id", 16_000, 500)
    assert pieces.selectExpr("max(octet_length(pcm))").first()[0] <= 1000 and pieces.count() <= 12 * 2


def put(folder, name, content):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content)


def pcm_of(rows):
    return {p: b"".join(bytes(r.pcm) for r in sorted((r for r in rows if r.path == p), key=lambda r: r.block)) for p in {r.path for r in rows}}


@pytest.mark.parametrize("size, step", [(100, 64), (100, 1000), (7, 33), (16_000, 1 << 20)])
def test_ranges_equal_the_whole_read(spark, tmp_path, size, step):
    rng = np.random.default_rng(1)
    signals = {f"a/{k}.wav": rng.integers(-(1 << 15), 1 << 15, n) for k, n in enumerate([0, 1, 99, 100, 101, 1000])}
    for name, s in signals.items():
        put(tmp_path, name, wav(s))
    put(tmp_path, "two/c.wav", wav(rng.integers(-9, 9, 600), channels=2))
    extra = wav(signals["a/5.wav"])  # a chunk before the samples, and one behind them
    put(tmp_path, "x.wav", extra[:36] + b"LIST" + (3).to_bytes(4, "little") + b"abc\0" + extra[36:] + b"tail" + (2).to_bytes(4, "little") + b"zz")
    rows = read_blocks(spark, str(tmp_path), block=size, range_bytes=step).collect()
    assert len({(r.path, r.block) for r in rows}) == len(rows) and all(r.start_ms == r.block * size // 16 and r.error is None for r in rows)
    got = {p.removeprefix(f"{tmp_path}/"): x for p, x in pcm_of(rows).items()}
    want = {n: np.asarray(s, "<i2").tobytes() for n, s in signals.items() if len(s)}
    assert {n: got[n] for n in want} == want and got["x.wav"] == want["a/5.wav"] and len(got["two/c.wav"]) == 1200
    assert {r.channels for r in rows if "two" in r.path} == {2}


def test_paths_and_times_reach_the_ranges(spark, tmp_path):
    for k in range(4):
        put(tmp_path, f"{k}.wav", wav(np.arange(1600)))
    put(tmp_path, "bad.wav", b"not opened")
    names = [f"{tmp_path}/{k}.wav" for k in (1, 3)]
    some = read_blocks(spark, str(tmp_path), names, block=160, range_bytes=500, from_ms=20, to_ms=60)
    assert sorted((r.path[-5], r.block) for r in some.collect()) == [(k, b) for k in "13" for b in (2, 3, 4, 5)]
    every = read_blocks(spark, str(tmp_path), block=160, range_bytes=500, on_error="report")
    assert some.rdd.getNumPartitions() == 14 and every.rdd.getNumPartitions() == 29
    # conditions of one query are not kept for the next
    assert [every.where(c).count() for c in ("start_ms < 20", "block = 1", "true")] == [8, 4, 41]


def test_other_rates(spark, tmp_path):
    put(tmp_path, "good.wav", wav([1, 2, 3]))
    put(tmp_path, "slow.wav", wav([1, 2, 3], rate=8000))
    put(tmp_path, "none.wav", b"")
    put(tmp_path, "text.wav", b"RIFF....WAVEjunk")
    with pytest.raises(Exception, match="Hz|wav|samples"):
        read_blocks(spark, str(tmp_path)).collect()
    rows = {r.path.rsplit("/", 1)[1]: r for r in read_blocks(spark, str(tmp_path), on_error="report").collect()}
    assert {n: r.error for n, r in rows.items()} == {"good.wav": None, "slow.wav": "8000 Hz, not 16000", "none.wav": "not a wav file", "text.wav": "no samples"}


def test_clips_of_files(spark, tmp_path):
    """From files to clips without a row that holds a recording, and as plain cuts of the files."""
    rng = np.random.default_rng(3)
    signals = {f"{v}.wav": rng.integers(-(1 << 15), 1 << 15, 5000) for v in range(2)}
    for n, s in signals.items():
        put(tmp_path, n, wav(s))
    blocks = read_blocks(spark, str(tmp_path), block=300, range_bytes=2000).select("path", "block", "pcm")
    clips = [(f"{tmp_path}/{n}", f"{n}-{k}", 40 * k - 7, 40 * k + 33 * (k % 4)) for n in signals for k in range(9)]
    got = audio.export_clips(blocks, spark.createDataFrame(clips, "path string, clip_name string, start_ms long, end_ms long"), "path", 16_000, 300)
    assert {r.clip_name: bytes(r.wav) for r in got.collect()} == {c: cut_audio(wav(signals[p.rsplit("/", 1)[1]]), a, b) for p, c, a, b in clips}


@pytest.mark.parametrize("frame_ms, step", [(1, 700), (10, 5000), (30, 1 << 20)])
def test_levels_of_files(spark, tmp_path, frame_ms, step):
    """Root mean squares by range equal those of the whole file; silence follows from them."""
    rng = np.random.default_rng(frame_ms)
    signals = {f"{v}.wav": np.where(np.arange(n) // 1600 % 2, rng.integers(-9, 9, n), rng.integers(-9000, 9000, n)) for v, n in ((1, 50_000), (2, 15_999), (3, 7))}
    for n, s in signals.items():
        put(tmp_path, n, wav(s))
    got = {}
    for r in read_audio(spark, str(tmp_path), frame_ms=frame_ms, range_bytes=step).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], {})[r.idx] = r.value
    for n, s in signals.items():
        x = s[: len(s) - len(s) % (16 * frame_ms)].reshape(-1, 16 * frame_ms).astype(float)
        assert sorted(got.get(n, {}).items()) == [(k, pytest.approx(v)) for k, v in enumerate(np.sqrt((x * x).mean(1)))]
