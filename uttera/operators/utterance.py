"""Utterances: the ordered fold over observations, its islands variant, clips, transcripts, counters.

Observations: (video_id, seg_idx, start_ms, end_ms, speaker, text) cleaned, and optionally
speaker_invalid and text_invalid from the raw texts. The fold compares each text with the first of
its run. Chunks of rows are folded apart from each other, and again where a run goes on from one to the next; everything else is set-oriented.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from uttera.config import Params
from uttera.functions.text import clip_name, levenshtein_ratio, matching_decided, ratio
from uttera.operators.scan import Ordered
from uttera.storage import written

P = Params()
PIECE = 1024
COUNTERS = {"cleaner": "cleaner", "no_speaker": "no_speaker", "no_transcript": "no_transcript", "discrepancy": "discrepancies", "blacklisted": "blacklisted"}
DECIDED = "seg_idx bigint, start_ms bigint, end_ms bigint, speaker string, text string, is_new boolean, bad boolean, no_speaker int, no_transcript int, discrepancy int, blacklisted int, cleaner int, status string"


def _input(obs: DataFrame) -> DataFrame:
    have = obs.columns
    for c in ("speaker_invalid", "text_invalid"):
        if c not in have:
            obs = obs.withColumn(c, F.lit(False))
    return obs.select("video_id", "seg_idx", "start_ms", "end_ms", F.coalesce("speaker", F.lit("")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"), "speaker_invalid", "text_invalid", *(["allowed"] if "allowed" in have else []))


def with_allowed(obs: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """Adds ``allowed``: the speaker is in the allow-list. allowed: a dimension (on..., speaker), small enough for AQE to broadcast."""
    keys = [*on, "speaker"]
    return obs.join(allowed.select(*keys).distinct().withColumn("allowed", F.lit(True)), keys, "left").withColumn("allowed", F.coalesce("allowed", F.lit(False)))


def decide_native(obs: DataFrame, similarity: Callable[[Column, Column], Column] = levenshtein_ratio, threshold: float = P.similarity, deviation: float = P.deviation) -> DataFrame:
    """One decision per observation and the number of its run, in the JVM, as a written table.

    Rows are ordered in pieces (see ``scan``) and cut into chunks of up to ``PIECE`` rows of a video; equal neighbours in a chunk are one item of the
    fold. Each chunk is folded with ``aggregate``, as if nothing came before it. What comes before matters only if the chunk's first
    row may go on with a run: then the chunk is folded again with the state that the chunk before leaves, in rounds. A chunk
    without a new run hands on what it was given, so a run over any number of chunks is known to all of them after two rounds.
    """
    return _decisions(_folded(obs, similarity, threshold, deviation)).drop("stretch", "undecided")


def _folded(obs: DataFrame, similarity: Callable[[Column, Column], Column], threshold: float, deviation: float) -> DataFrame:
    """Every row with its flags, the letter of its decision, its run and its stretch, from written chunks."""
    fold = _Chunks(similarity, threshold, deviation)
    chunks = written(fold.cut(Ordered(_input(obs), ["video_id"], ["seg_idx"]).rows), "chunks")
    state = fold.rounds(chunks)
    earlier = Window.partitionBy("video_id").orderBy("piece", "cell").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda n: F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n)
    placed = state.select(F.col("video_id").alias("v"), *_CHUNK[1:], "codes", so_far("n_new"), so_far("n_hard"))
    joined = chunks.select(*_CHUNK, "items").join(placed, (F.col("video_id").eqNullSafe(F.col("v"))) & (chunks["piece"] == placed["piece"]) & (chunks["cell"] == placed["cell"]))
    items = joined.select("video_id", "n_new", "n_hard", "codes", F.posexplode("items").alias("at", "item"))
    upto = F.expr("left(codes, at + 1)")
    each = items.select(
        "video_id", F.col("item.speaker").alias("speaker"), F.col("item.text").alias("text"), F.expr("substring(codes, at + 1, 1)").alias("first_code"),
        (F.col("n_new") + _count(upto, _NEW) - 1).cast("long").alias("run_idx"), (F.col("n_hard") + _count(upto, "H")).cast("long").alias("stretch"), F.posexplode("item.rows").alias("k", "o"),
    )
    code = F.when(F.col("k") == 0, F.col("first_code")).otherwise(F.translate("first_code", "HND", "SSd"))
    return each.select("video_id", "speaker", "text", "run_idx", "stretch", code.alias("code"), "o.*")


def _decisions(each: DataFrame) -> DataFrame:
    new, differs = F.col("code").isin(*_NEW), F.upper("code") == "D"
    bad = F.col("flaw") | differs
    num = lambda c: c.cast("int")
    return each.select(
        "video_id", F.col("seg_idx").cast("bigint").alias("seg_idx"), F.col("start_ms").cast("bigint").alias("start_ms"), F.col("end_ms").cast("bigint").alias("end_ms"), "speaker", "text", new.alias("is_new"), bad.alias("bad"),
        num(F.col("speaker") == "").alias("no_speaker"), num((F.col("text") == "") & ~F.col("d2")).alias("no_transcript"), num(F.col("code") == "D").alias("discrepancy"), num(F.col("banned")).alias("blacklisted"),
        (num(F.col("speaker_invalid")) + num(F.col("text_invalid") & ~F.col("d1"))).alias("cleaner"),
        F.when(new & bad, "NEW_UTTERANCE_BAD").when(new, "NEW_UTTERANCE_GOOD").when(bad, "DROP_UTTERANCE").otherwise("SAME_UTTERANCE").alias("status"), "run_idx", "stretch", (F.col("code") == "U").alias("undecided"),
    )


def decide_matching(obs: DataFrame, threshold: float = P.similarity, deviation: float = P.deviation) -> DataFrame:
    """The decisions of ``decide_exact``: bounds decide in the JVM, and only stretches with a pair that they leave open are matched in Python.

    A stretch begins at a row that is new whatever came before it (no speaker, no text or another speaker), so it can be folded alone.
    """
    each = _folded(obs, lambda a, b: matching_decided(a, b, threshold), threshold, deviation)
    open_ = each.where("code = 'U'").select(F.col("video_id").alias("v"), F.col("stretch").alias("s")).distinct()
    same = F.col("video_id").eqNullSafe(F.col("v")) & (F.col("stretch") == F.col("s"))
    native = _decisions(each.join(open_, same, "left_anti")).drop("run_idx", "stretch", "undecided")
    rest = each.join(open_, same, "left_semi").withColumn("allowed", ~F.col("banned"))
    columns = [c.split()[0] for c in DECIDED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, fold = None, None
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                if fold is None or (r.video_id, r.stretch) != at:
                    at, fold = (r.video_id, r.stretch), Fold(threshold=threshold, deviation=deviation)
                out.append((r.video_id, r.seg_idx, r.start_ms, r.end_ms, r.speaker, r.text, *fold.step(r.speaker, r.text, r.speaker_invalid, r.text_invalid, r.allowed)))
            yield pd.DataFrame(out, columns=["video_id", *columns])

    rows = rest.select(F.col("video_id").cast("long"), "stretch", "seg_idx", "start_ms", "end_ms", "speaker", "text", "speaker_invalid", "text_invalid", "allowed")
    matched = rows.repartition("video_id", "stretch").sortWithinPartitions("video_id", "stretch", "seg_idx").mapInPandas(run, f"video_id bigint, {DECIDED}")
    return native.unionByName(matched)


def decided_natively(obs: DataFrame, threshold: float = P.similarity, deviation: float = P.deviation) -> DataFrame:
    """One row: how many rows there are, how many need a similarity and how many of their stretches' rows bounds decide."""
    each = _folded(obs, lambda a, b: matching_decided(a, b, threshold), threshold, deviation)
    open_ = each.groupBy("video_id", "stretch").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("code") == "U").alias("u"))
    return open_.agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("u") == 0, F.col("n")).otherwise(0)).alias("native"), F.count(F.lit(1)).alias("stretches"), F.count_if(F.col("u") > 0).alias("matched_stretches"))


_CHUNK = ["video_id", "piece", "cell"]
_STATE = "struct<sp:string,tx:string,drop:boolean,unsure:boolean>"
_NEW = "HN"


def _count(codes: Column, which: str) -> Column:
    """How many letters of a string of decisions are among ``which``."""
    return F.length(F.translate(codes, "".join(x for x in "HNSDdU" if x not in which), ""))


class _Chunks:
    """The fold of chunks: cutting, folding with a given state, and rounds until every chunk was folded with the right one."""

    def __init__(self, similarity: Callable[[Column, Column], Column], threshold: float, deviation: float):
        self.similarity, self.threshold, self.deviation = similarity, threshold, deviation

    def cut(self, rows: DataFrame) -> DataFrame:
        """(video_id, piece, cell, items): items of equal neighbours, each with the rows it stands for, ``PIECE`` rows a chunk at most."""
        s, t = F.col("speaker"), F.col("text")
        d1 = F.col("speaker_invalid") | (s == "")
        d2 = d1 | F.col("text_invalid")
        banned = (s != "") & ~F.col("allowed")
        flaw = d2 | (t == "") | banned
        within = Window.partitionBy("video_id", "__piece").orderBy("__at")
        row = F.struct("seg_idx", "start_ms", "end_ms", "speaker_invalid", "text_invalid", d1.alias("d1"), d2.alias("d2"), banned.alias("banned"), flaw.alias("flaw"))
        rows = rows.select("video_id", F.col("__piece").alias("piece"), "__at", "speaker", "text", row.alias("row"), F.floor((F.row_number().over(within) - 1) / PIECE).cast("int").alias("cell"), F.lag(F.struct("speaker", "text")).over(within).alias("p"))
        again = (s != "") & (t != "") & F.coalesce((s == F.col("p.speaker")) & (t == F.col("p.text")), F.lit(False))
        rows = rows.withColumn("item", F.sum((~again).cast("long")).over(Window.partitionBy("video_id", "piece").orderBy("__at")))
        listed = lambda c: F.array_sort(F.collect_list(c))  # noqa: E731  within a chunk: at most ``PIECE`` rows
        item = rows.groupBy(*_CHUNK, "item").agg(F.first("speaker").alias("speaker"), F.first("text").alias("text"), listed("row").alias("rows"))
        flaws = F.exists("rows", lambda r: r["flaw"]).alias("flaw")
        return item.select(*_CHUNK, F.struct("item", "speaker", "text", "rows", flaws).alias("o")).groupBy(*_CHUNK).agg(listed("o").alias("items"))

    def fold(self, chunks: DataFrame) -> DataFrame:
        """(..., codes, n_new, n_hard, bad, out) of chunks with their items and a state ``given``, null where nothing came before.

        codes has a letter an item: H new whatever came before, N new, S same, D differs, d differs in a run that is dropped already, U where a
        similarity was null, and what follows up to the next H. ``out`` is the state left behind.
        """
        zero = F.struct(
            F.col("given.sp").alias("sp"), F.col("given.tx").alias("tx"), F.lit("").alias("before"), F.lit(0.0).cast("double").alias("r"), F.coalesce("given.drop", F.lit(False)).alias("drop"),
            F.lit(False).alias("bad"), F.coalesce("given.unsure", F.lit(False)).alias("unsure"), F.lit("").alias("codes"),
        )

        def step(acc: Column, o: Column) -> Column:
            s, t = o["speaker"], o["text"]
            hard = (s == "") | (t == "") | ~s.eqNullSafe(acc["sp"])
            far = F.least(F.length(t), F.length(acc["tx"])) <= self.threshold * F.greatest(F.length(t), F.length(acc["tx"]))  # no similarity can exceed the ratio of lengths
            r = F.when(hard, F.lit(0.0)).when(t == acc["tx"], F.lit(1.0)).when(t == acc["before"], acc["r"]).when(far, F.lit(0.0)).otherwise(self.similarity(t, acc["tx"]))
            # bound by a lambda: each mention of the column would compute the similarity again
            return F.get(F.transform(F.array(F.struct(hard.alias("hard"), r.alias("r"))), lambda x: decide(acc, o, t, x["hard"], x["r"])), F.lit(0))

        def decide(acc: Column, o: Column, t: Column, hard: Column, r: Column) -> Column:
            unsure = ~hard & (acc["unsure"] | r.isNull())
            new = ~unsure & (r <= self.threshold)
            differs = ~unsure & ~new & (r <= 1 - self.deviation)
            code = F.when(hard, "H").when(unsure, "U").when(new, "N").when(differs, F.when(acc["drop"], "d").otherwise("D")).otherwise("S")
            return F.struct(
                o["speaker"].alias("sp"), F.when(new, t).otherwise(acc["tx"]).alias("tx"), t.alias("before"), F.when(new, 1.0).otherwise(r).alias("r"), F.when(new, o["flaw"]).otherwise(acc["drop"] | o["flaw"] | differs).alias("drop"),
                (acc["bad"] | o["flaw"] | differs).alias("bad"), unsure.alias("unsure"), F.concat(acc["codes"], code).alias("codes"),
            )

        done = chunks.withColumn("end", F.aggregate("items", zero, step))
        codes = F.col("end.codes")
        return done.select(
            *[c for c in chunks.columns if c != "items"], codes.alias("codes"), _count(codes, _NEW).alias("n_new"), _count(codes, "H").alias("n_hard"), F.col("end.bad").alias("bad"), F.struct("end.sp", "end.tx", "end.drop", "end.unsure").alias("out")
        )

    def rounds(self, chunks: DataFrame) -> DataFrame:
        """(video_id, piece, cell, codes, n_new, ...) of all chunks, each folded with what really comes before it."""
        first = F.element_at("items", 1)
        starts = F.when((first["speaker"] != "") & (first["text"] != ""), first["speaker"])  # null: its first row is new whatever came before
        state = written(self.fold(chunks.select(*_CHUNK, "items", starts.alias("starts"), F.lit(None).cast(_STATE).alias("given"))), "fold")
        while True:
            todo = state.select("*", self.handed_on().alias("due")).where(F.col("starts").isNotNull() & (F.col("due.sp") == F.col("starts")) & ~F.col("due").eqNullSafe(F.col("given")))
            if todo.isEmpty():
                return state
            todo = written(todo.select(*[F.col(c).alias(f"__{c}") for c in _CHUNK], F.col("due").alias("given"), "starts"), "due")
            same = chunks["video_id"].eqNullSafe(F.col("__video_id")) & (chunks["piece"] == F.col("__piece")) & (chunks["cell"] == F.col("__cell"))
            again = self.fold(chunks.join(todo, same).select(*_CHUNK, "items", "starts", "given"))
            kept = state.join(todo, state["video_id"].eqNullSafe(F.col("__video_id")) & (state["piece"] == F.col("__piece")) & (state["cell"] == F.col("__cell")), "left_anti")
            state = written(kept.unionByName(again), "fold")

    @staticmethod
    def handed_on() -> Column:
        """The state before each chunk: that of the last chunk with a new run, dropped (or unsure) if it was or if a chunk since then has a flaw (or lost track)."""
        before = Window.partitionBy("video_id").orderBy("piece", "cell").rowsBetween(Window.unboundedPreceding, -1)
        changed = F.col("n_new") > 0
        last = F.last(F.when(changed, F.col("out")), True).over(before)
        place = F.struct("piece", "cell")
        since = F.max(F.when(changed, place)).over(before)
        bad_after = F.max(F.when(~changed & F.col("bad"), place)).over(before)
        lost_after = F.max(F.when(~changed & F.col("out.unsure"), place)).over(before)
        later = lambda x: F.coalesce(x > since, F.lit(False))
        return F.when(last.isNotNull(), F.struct(last["sp"].alias("sp"), last["tx"].alias("tx"), (last["drop"] | later(bad_after)).alias("drop"), (last["unsure"] | later(lost_after)).alias("unsure")))


class Fold:
    """The same decisions one observation at a time: the state of a stream, and the exact similarity."""

    def __init__(self, state: tuple = (None, None, False), similarity: Callable[[str, str], float] = ratio, threshold: float = P.similarity, deviation: float = P.deviation):
        (self.sp, self.tx, self.drop), self.similarity, self.threshold, self.deviation = state, similarity, threshold, deviation

    def step(self, s: str, t: str, speaker_invalid: bool, text_invalid: bool, allowed: bool) -> tuple:
        d1 = speaker_invalid or s == ""
        d2 = d1 or text_invalid
        new, differs = s == "" or self.sp is None or self.sp != s or t == "", False
        if not new:
            r = 1.0 if t == self.tx else self.similarity(t, self.tx)
            new = r <= self.threshold
            differs = not new and r <= 1 - self.deviation
        banned = s != "" and not allowed
        bad = d2 or t == "" or differs or banned
        out = (new, bad, int(s == ""), int(t == "" and not d2), int(differs and not self.drop), int(banned), int(speaker_invalid) + int(text_invalid and not d1), ("NEW_UTTERANCE_BAD" if bad else "NEW_UTTERANCE_GOOD") if new else ("DROP_UTTERANCE" if bad else "SAME_UTTERANCE"))
        if new:
            self.sp, self.tx, self.drop = s, t, bad
        else:
            self.drop = self.drop or bad
        return out


def decide_exact(obs: DataFrame, similarity: Callable[[str, str], float] = ratio) -> DataFrame:
    """One decision per observation with the matching-blocks similarity.

    Rows are partitioned and sorted by video and streamed in Arrow batches; only the state of the current video is held.
    """
    columns = [c.split()[0] for c in DECIDED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        video, fold, first = None, None, True
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                if first or r.video_id != video:
                    video, fold, first = r.video_id, Fold(similarity=similarity), False
                out.append((r.video_id, r.seg_idx, r.start_ms, r.end_ms, r.speaker, r.text, *fold.step(r.speaker, r.text, r.speaker_invalid, r.text_invalid, r.allowed)))
            yield pd.DataFrame(out, columns=["video_id", *columns])

    rows = _input(obs).withColumn("video_id", F.col("video_id").cast("long")).repartition("video_id").sortWithinPartitions("video_id", "seg_idx")
    return rows.mapInPandas(run, f"video_id bigint, {DECIDED}")


def runs(decided: DataFrame, *counts: Column) -> DataFrame:
    """Runs of decisions: (video_id, run_idx, speaker, text, start_ms, end_ms, dropped, is_last), and what ``counts`` adds up."""
    numbered = decided
    if "run_idx" not in decided.columns:
        numbered = Ordered(decided, ["video_id"], ["seg_idx"]).scan(sums={"run_idx": F.col("is_new").cast("long")}).withColumn("run_idx", F.col("run_idx") - 1)
    grouped = numbered.groupBy("video_id", "run_idx").agg(
        F.min_by("speaker", "seg_idx").alias("speaker"), F.min_by("text", "seg_idx").alias("text"), F.min_by("start_ms", "seg_idx").alias("start_ms"), F.max_by("end_ms", "seg_idx").alias("end_ms"), F.bool_or("bad").alias("dropped"), *counts
    )
    last = grouped.groupBy(F.col("video_id").alias("__video")).agg(F.max("run_idx").alias("__last"))  # of the same exchange; a video's runs never meet
    joined = grouped.join(last, F.col("video_id").eqNullSafe(F.col("__video")))
    return joined.withColumn("is_last", F.col("run_idx") == F.col("__last")).drop("__video", "__last")


def utterances(decided: DataFrame, flush_tail: bool = False) -> DataFrame:
    """Accepted utterances with their index by speaker and clip name. The last run of a video is kept only with ``flush_tail``."""
    kept = runs(decided).where(~F.col("dropped") & (F.lit(flush_tail) | ~F.col("is_last")))
    w = Window.partitionBy("video_id", "speaker").orderBy("run_idx")
    kept = kept.withColumn("utt_idx", (F.row_number().over(w) - 1).cast("int"))
    return kept.select("video_id", "speaker", "utt_idx", "start_ms", "end_ms", "text", clip_name(F.col("speaker"), F.col("video_id"), F.col("utt_idx")).alias("clip_name"))


def _counted_runs(decided: DataFrame) -> DataFrame:
    return runs(decided, F.count(F.lit(1)).alias("potential"), *[F.sum(c).alias(n) for c, n in COUNTERS.items()])


def statistics(decided: DataFrame, rejected: DataFrame | None = None, flush_tail: bool = False) -> DataFrame:
    """The nine counters of each video in one pass, runs first; ``rejected`` (video_id, ...) are clips that verification took out."""
    by_run = _counted_runs(decided)
    ended = F.lit(flush_tail) | ~F.col("is_last")
    totals = [F.sum(n).cast("long").alias(n) for n in ("potential", *COUNTERS.values())]
    out = by_run.groupBy("video_id").agg(*totals, F.count_if(ended & ~F.col("dropped")).alias("emitted"), F.count_if(ended & F.col("dropped")).alias("lost"))
    if rejected is not None:
        out = out.join(rejected.groupBy("video_id").agg(F.count(F.lit(1)).alias("failed")), "video_id", "left")
    else:
        out = out.withColumn("failed", F.lit(0).cast("long"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select("video_id", "potential", (z("emitted") - z("failed")).alias("successful"), (z("lost") + z("failed")).alias("total_dropped"), "cleaner", "no_speaker", "no_transcript", "discrepancies", "blacklisted", z("failed").alias("verification_failed"))


def save_runs(decided: DataFrame, folder: str, flush_tail: bool = False) -> dict[str, int]:
    """Writes the runs with their counters as Parquet and returns the totals, observed while they are written: no second pass."""
    by_run = _counted_runs(decided)
    ended = F.lit(flush_tail) | ~F.col("is_last")
    seen = Observation("fold")
    totals = [F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in ("potential", *COUNTERS.values())]
    by_run.observe(seen, *totals, F.count_if(ended & ~F.col("dropped")).alias("successful"), F.count_if(ended & F.col("dropped")).alias("total_dropped")).write.mode("overwrite").parquet(folder)
    return dict(seen.get)


def summary(totals: dict[str, int]) -> str:
    """Totals as lines of text, in the order of the counters."""
    return "\n".join(f"{n}: {totals[n]}" for n in ("potential", "successful", "total_dropped", *COUNTERS.values()))


def islands(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Run-length islands of equal values: (key, island, value, n, first, last) with first and last of ``order[-1]``."""
    w = Window.partitionBy(key).orderBy(*order)
    changed = rows.withColumn("_new", ((F.row_number().over(w) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("long"))
    return changed.withColumn("island", F.sum("_new").over(w)).groupBy(key, "island").agg(F.first(value).alias(value), F.count(F.lit(1)).alias("n"), F.min(order[-1]).alias("first"), F.max(order[-1]).alias("last"))


def blocked_speakers(obs: DataFrame, key: str = "video_id", order: str = "seg_idx") -> DataFrame:
    """Speakers outside the allow-list with their first place. obs has ``allowed``."""
    return obs.where((F.coalesce("speaker", F.lit("")) != "") & ~F.col("allowed")).groupBy(key, "speaker").agg(F.min(order).alias("first_seen"))


def transcript_text(utts: DataFrame, keys: list[str], order: str, line: Column) -> DataFrame:
    """One text per key, a line for each row in order."""
    return utts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("lines")).select(*keys, F.size("lines").alias("n_lines"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("content"))
