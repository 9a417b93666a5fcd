"""Queries over whole texts, against plain Python: nothing is cut to a prefix."""

import difflib

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from uttera.functions.text import ACCENTED, PLAIN, SPECIAL
from uttera.operators.utterance import Fold
from uttera.plans.queries import queries

TURNS = [(1, 0, "user", "word " * 20 + "alpha beta gamma " * 12), (1, 1, "user", "word " * 20 + "ox " * 80), (1, 2, "assistant", "it's well-known " + "déjà vu, " * 40), (1, 3, "user", "Done."), (2, 0, "user", "*sigh* R-right"), (2, 1, "user", "plain words here"), (2, 2, "system", None)]


@pytest.fixture(scope="module")
def turns(tmp_path_factory):
    d = tmp_path_factory.mktemp("whole")
    pq.write_table(pa.table({k: pa.array(v, t) for k, v, t in zip(("conv_id", "turn", "role", "text"), zip(*TURNS), (pa.int64(), pa.int64(), pa.string(), pa.string()))}), d / "conversations.parquet")
    return str(d)


def levenshtein(a, b):
    return 1 - duckdb.execute("SELECT levenshtein(?, ?)", [a, b]).fetchone()[0] / max(len(a), len(b))


def reads(d):
    """The observations of every turn, by hand: (video, seg, speaker, text)."""
    table = str.maketrans(dict(zip(ACCENTED, PLAIN)) | SPECIAL)
    for conv, turn, role, text in sorted(map(tuple, pq.read_table(f"{d}/conversations.parquet").select(["conv_id", "turn", "role", "text"]).to_pandas().itertuples(index=False))):
        for r in range(4 if text is not None else 0):
            t = text.translate(table).upper()
            t = "" if (conv + turn * 5 + r) % 13 == 0 else t[:-3] if (conv * 7 + turn + r) % 11 == 0 else t
            yield conv, turn * 4 + r, "" if (conv * 3 + turn + r) % 17 == 0 else role.upper(), t


def folded(d, similarity):
    """Runs of each video: [video, speaker, text, dropped], by the fold one observation at a time."""
    out, video = [], None
    for v, _, s, t in reads(d):
        if v != video:
            fold, video = Fold(similarity=similarity), v
        new, bad, *_ = fold.step(s, t, False, False, s in ("USER", "ASSISTANT"))
        if new:
            out.append([v, s, t, bad])
        else:
            out[-1][3] |= bad
    return out


@pytest.mark.parametrize("small", [True, False])
def test_folds_read_whole_texts(spark, sf, turns, small):
    d = turns if small else sf
    got = queries()["utterance_fold_lev"](spark, d).orderBy("video_id", "run_idx").select("video_id", "speaker", "text", "dropped").collect()
    assert [list(r) for r in got] == folded(d, levenshtein) and any(len(r.text) > 200 for r in got)
    got = queries()["utterance_fold_ratio"](spark, d).orderBy("video_id", "start_ms").select("video_id", "speaker", "text").collect()
    assert [list(r) for r in got] == [r[:3] for r in folded(d, lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()) if not r[3]]
    for name in ("clip_names", "utterance_transcripts"):
        assert max(len(r["text" if name == "clip_names" else "content"]) for r in queries()[name](spark, d).collect()) > 200
    assert queries()["utterance_status"](spark, d).where("is_new").count() == len(folded(d, levenshtein)) and queries()["utterance_stats"](spark, d).count() > 0


def test_similarity_of_whole_texts(spark, tmp_path):
    a, b = "WORD " * 60 + "ALPHA", "WORD " * 60 + "OMEGA" + " OX" * 90
    pq.write_table(pa.table({"conv_id": [1, 1], "turn": [0, 1], "role": ["user", "user"], "text": [a, b]}), tmp_path / "conversations.parquet")
    (row,) = queries()["similarity_levenshtein"](spark, str(tmp_path)).collect()
    assert row.turn == 1 and row.similarity == pytest.approx(levenshtein(a, b)) and row.similarity < 0.6


def test_alignment_lines_hold_every_word(spark, tmp_path):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(70)]
    pq.write_table(pa.table({"conv_id": [1], "turn": [0], "role": ["user"], "text": [", ".join(words)]}), tmp_path / "conversations.parquet")
    (row,) = queries()["alignment_lines"](spark, str(tmp_path)).collect()
    ends = ["0.12"] + [str(k * 0.25) for k in range(1, 72)]
    assert row.line == f'C-1-0000 ",{",".join(words).upper()}," "{",".join(ends)}"'
    (row,) = queries()["interval_array_repair"](spark, str(tmp_path)).collect()
    assert row.n == 72 and row.texts == "|" + "|".join(words) + "|" and row.ends_silent and row.total == pytest.approx(sum(map(float, ends)))


def test_matching_fold_is_the_exact_fold(spark, sf):
    both = [sorted(map(tuple, queries()[n](spark, sf).collect())) for n in ("utterance_fold_matching", "utterance_fold_ratio")]
    assert both[0] == both[1] and both[0]
