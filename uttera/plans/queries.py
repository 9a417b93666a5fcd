"""Registered queries and their DuckDB equivalents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.config import ALLOWED, CATEGORIES, ROI
from uttera.functions import text as T
from uttera.operators import align, asof, audio, images, intervals, outliers, split, utterance
from uttera.plans import dataset
from uttera.plans import derived as D
from uttera.storage import shared_folder, written
from uttera.streaming import ordered
from uttera.streaming.fold import activity_sessions

KEYS = ("example.com", "example.net", "example.org")
TOLERANCE = 1.42
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL if there is any."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


# Text


@query(f"SELECT doc_id, {D.sql_clean('text', chr(40) + 'doc_id % 5 < 2' + chr(41))} AS clean FROM documents")
def clean_text_documents(spark, sf):
    category = F.element_at(F.array(*[F.lit(c) for c in ("berseria", "zestiria", "xillia 1", "xillia 2", "vesperia")]), (F.col("doc_id") % 5 + 1).cast("int"))
    return D.spread(D.table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", T.clean_text(F.col("text"), category).alias("clean"))


#: Letters of the same sound, to write given texts in other scripts.
_LATIN, _CYRILLIC, _GREEK = "abvgdzijklmnoprstufhcyeABVGDZ", "абвгджийклмнопрстуфхцыяЩЮЬЪЁЖ", "αβγδεζηθικλμνξοπρςστυφψΩΆΐΘΧ "


@query(f"SELECT doc_id, {D.sql_clean('text')} AS clean FROM (SELECT doc_id, CASE doc_id % 3 WHEN 1 THEN translate(text, '{_LATIN}', '{_CYRILLIC}') WHEN 2 THEN translate(text, '{_LATIN}', '{_GREEK}') ELSE text END AS text FROM documents)")
def clean_text_scripts(spark, sf):
    """Documents written in Cyrillic and Greek letters, cleaned."""
    script = F.when(F.col("doc_id") % 3 == 1, F.translate("text", _LATIN, _CYRILLIC)).when(F.col("doc_id") % 3 == 2, F.translate("text", _LATIN, _GREEK)).otherwise(F.col("text"))
    return D.spread(D.table(spark, sf, "documents").select("doc_id", script.alias("text"))).select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query(f"SELECT conv_id, turn, {D.sql_clean('role')} AS speaker, {D.sql_clean('text')} AS clean FROM conversations")
def clean_text_conversations(spark, sf):
    return D.table(spark, sf, "conversations").select("conv_id", "turn", T.clean_text(F.col("role")).alias("speaker"), T.clean_text(F.col("text")).alias("clean"))


@query("SELECT doc_id, contains(text, '*') AS star, NOT contains(text, '*') AND regexp_matches(text, '[A-Za-z]-[A-Za-z]') AS stutter, contains(text, '*') OR regexp_matches(text, '[A-Za-z]-[A-Za-z]') AS invalid FROM documents")
def text_validity_flags(spark, sf):
    c = F.col("text")
    return D.table(spark, sf, "documents").select("doc_id", T.has_star(c).alias("star"), (~T.has_star(c) & T.has_stutter(c)).alias("stutter"), T.invalid(c).alias("invalid"))


def _sql_collapse() -> str:
    c = "replace(replace(text, ',', '.'), ' ', '.')"
    for n in range(10, 1, -1):
        c = f"replace({c}, '{'.' * n}', '.')"
    return c


@query(f"SELECT doc_id, {_sql_collapse()} AS collapsed FROM documents")
def collapse_repeats(spark, sf):
    c = F.replace(F.replace(F.col("text"), F.lit(","), F.lit(".")), F.lit(" "), F.lit("."))
    return D.table(spark, sf, "documents").select("doc_id", T.collapse_repeats(c).alias("collapsed"))


@query("SELECT page_id, CASE " + " ".join(f"WHEN contains(lower(url), '{k}') THEN '{k}'" for k in KEYS) + " END AS category FROM pages")
def category_first_match(spark, sf):
    return D.table(spark, sf, "pages").select("page_id", T.first_category(F.col("url"), KEYS).alias("category"))


@query("SELECT page_id, replace(url, '/', chr(92)) AS raw, list_last(string_split(url, '/')) AS name, string_split(url, '/')[-2] AS parent, replace(list_last(string_split(url, '/')), '.html', '') AS stem FROM pages WHERE url IS NOT NULL")
def path_parts(spark, sf):
    raw = F.replace("url", F.lit("/"), F.lit("\\"))
    path = T.normal_path(F.col("raw"))
    return D.table(spark, sf, "pages").where("url is not null").select("page_id", raw.alias("raw")).select("page_id", "raw", T.last_part(path).alias("name"), T.parent_part(path).alias("parent"), T.strip_suffix(T.last_part(path), ".html").alias("stem"))


@query(f"SELECT a.conv_id, a.turn, 1.0 - levenshtein(a.t, b.t)::DOUBLE / greatest(length(a.t), length(b.t)) AS similarity FROM (SELECT conv_id, turn, {D.sql_clean('text')} AS t FROM conversations) a JOIN (SELECT conv_id, turn, {D.sql_clean('text')} AS t FROM conversations) b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1 WHERE greatest(length(a.t), length(b.t)) > 0")
def similarity_levenshtein(spark, sf):
    t = D.spread(D.table(spark, sf, "conversations").select("conv_id", "turn", "text")).select("conv_id", "turn", T.clean_text(F.col("text")).alias("t"))
    pairs = t.join(t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("t").alias("b")), ["conv_id", "turn"]).where("length(t) > 0 or length(b) > 0")
    return pairs.select("conv_id", "turn", T.levenshtein_ratio(F.col("t"), F.col("b")).alias("similarity"))


@query()
def similarity_matching(spark, sf):
    t = D.spread(D.table(spark, sf, "conversations").select("conv_id", "turn", "text")).select("conv_id", "turn", T.clean_text(F.col("text")).alias("t"))
    pairs = t.join(t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("t").alias("b")), ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", T.matching_ratio("t", "b").alias("similarity"))


# Allow-lists and islands


def _speakers(spark, sf):
    return D.table(spark, sf, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seg_idx"), F.upper("role").alias("speaker"))


def _allow(spark):
    return spark.createDataFrame([("USER",), ("ASSISTANT",)], "speaker string")


@query("SELECT conv_id AS video_id, turn AS seg_idx, upper(role) AS speaker FROM conversations WHERE upper(role) IN ('USER', 'ASSISTANT')")
def allowlist_semi(spark, sf):
    return _speakers(spark, sf).join(_allow(spark), "speaker", "left_semi").select("video_id", "seg_idx", "speaker")


@query("SELECT conv_id AS video_id, upper(role) AS speaker, min(turn) AS first_seen FROM conversations WHERE upper(role) NOT IN ('USER', 'ASSISTANT') GROUP BY ALL")
def blocklist_first_seen(spark, sf):
    return utterance.blocked_speakers(utterance.with_allowed(_speakers(spark, sf), _allow(spark), []))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{s}')" for c, names in ALLOWED.items() for s in names) + ") v(category, speaker)")
def allowlist_table(spark, sf):
    return spark.createDataFrame([(c, s) for c, names in ALLOWED.items() for s in names], "category string, speaker string")


@query("""WITH c AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM c)
SELECT user_id, CAST(island AS BIGINT) AS island, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM i GROUP BY user_id, island""")
def run_islands_exact(spark, sf):
    return utterance.islands(D.table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_type")


# Segments and signals


@query(f"WITH {D.SQL_SEGMENTS} SELECT user_id, seg_idx, start_ms, end_ms, (end_ms - start_ms) // 2 + start_ms AS middle_ms, start_ms - 5 AS buffered_start, end_ms + 5 AS buffered_end FROM segments WHERE end_ms - start_ms >= 60000")
def segment_filter_buffer_mid(spark, sf):
    return intervals.prepare_segments(D.segments(spark, sf), min_ms=60000)


@query(f"WITH {D.SQL_SEGMENTS} SELECT user_id, CAST(count_if(end_ms - start_ms < 60000) AS BIGINT) AS dropped, count(*) AS total FROM segments GROUP BY user_id")
def segment_short_counts(spark, sf):
    return intervals.count_short(D.segments(spark, sf), "user_id", 60000)


@query(f"WITH {D.SQL_SEGMENTS}, b AS (SELECT user_id, seg_idx, end_ms + 5 AS buffered_end, lead(start_ms - 5) OVER (PARTITION BY user_id ORDER BY seg_idx) AS next_start FROM segments) SELECT * FROM b WHERE next_start < buffered_end")
def segment_overlap_check(spark, sf):
    found = intervals.overlaps(intervals.prepare_segments(D.segments(spark, sf)), "user_id", "seg_idx")
    return found.select("user_id", "seg_idx", "buffered_end", "next_start")


_SQL_SILENCE = f"""{D.SQL_SAMPLES}, level AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, sqrt(avg(value * value) OVER (PARTITION BY user_id)) * power(10, -3.0 / 20) AS lim, sqrt(avg(value * value) OVER (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) AS rms FROM samples),
quiet AS (SELECT user_id, idx FROM level WHERE idx <= n - 4 AND rms <= lim),
marked AS (SELECT *, sum(CASE WHEN idx > prev + 4 OR prev IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY idx) - 1 AS k FROM (SELECT *, lag(idx) OVER (PARTITION BY user_id ORDER BY idx) AS prev FROM quiet)),
silence AS (SELECT user_id, CAST(k AS BIGINT) AS silence_idx, min(idx) AS s, max(idx) + 4 AS e FROM marked GROUP BY user_id, k)"""


@query(f'WITH {_SQL_SILENCE} SELECT user_id, silence_idx, s AS "start", e AS "end" FROM silence')
def silence_islands(spark, sf):
    return intervals.silence_ranges(D.samples(spark, sf), "user_id", 4, 3.0)


@query(_SQL["silence_islands"])
def silence_blocks(spark, sf):
    """Silence found in blocks of 64 samples that are stitched."""
    return intervals.silence_ranges_in_blocks(D.samples(spark, sf), "user_id", 4, 3.0, 64)


@query(f"""WITH {_SQL_SILENCE}, ends AS (SELECT user_id, s, e FROM silence UNION ALL SELECT user_id, count(*), count(*) FROM samples GROUP BY user_id),
gaps AS (SELECT user_id, coalesce(max(e) OVER (PARTITION BY user_id ORDER BY e, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, s AS b FROM ends)
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY a) - 1 AS INTEGER) AS seg_idx, a AS "start", b AS "end" FROM gaps WHERE a < b""")
def activity_segments(spark, sf):
    return intervals.activity_segments(D.samples(spark, sf), "user_id", 4, 3.0)


@query(f"WITH {D.SQL_SAMPLES}, s AS (SELECT user_id, avg(value * value) AS p, count(*) AS n FROM samples GROUP BY user_id) SELECT user_id, n, round(sqrt(p), 6) AS rms, round(20 * log10(sqrt(p)), 6) AS db FROM s")
def signal_level(spark, sf):
    s = intervals.signal_level(D.samples(spark, sf), "user_id")
    return s.select("user_id", "n", F.round("rms", 6).alias("rms"), F.round("db", 6).alias("db"))


@query(f"WITH {D.SQL_SAMPLES}, clips AS (SELECT user_id, idx AS a, idx + 5 AS b FROM samples WHERE idx % 16 = 3) SELECT s.user_id, c.a AS clip, count(*) AS n, min(s.value) AS least, max(s.value) AS most FROM samples s JOIN clips c ON s.user_id = c.user_id AND s.idx >= c.a AND s.idx < c.b GROUP BY ALL")
def clip_slice(spark, sf):
    s = D.samples(spark, sf)
    clips = s.where("idx % 16 = 3").select("user_id", F.col("idx").alias("start"), (F.col("idx") + 5).alias("end"))
    return intervals.clip_samples(s, clips, "user_id").groupBy("user_id", F.col("start").alias("clip")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


_LE4 = "printf('%02x%02x%02x%02x', {0} & 255, ({0} >> 8) & 255, ({0} >> 16) & 255, ({0} >> 24) & 255)"


@query(f"""WITH {D.SQL_SAMPLES}, pcm AS (SELECT user_id, idx, CAST(floor(value * 100) AS BIGINT) % 60000 - 30000 AS v FROM samples), clips AS (SELECT user_id, idx AS clip, greatest(idx - 5, 0) AS a, idx + 40 AS b FROM samples WHERE idx % 16 = 3),
cut AS (SELECT c.user_id, c.clip, count(*) AS n, string_agg(printf('%02x%02x', v & 255, (v >> 8) & 255), '' ORDER BY p.idx) AS x FROM clips c JOIN pcm p ON p.user_id = c.user_id AND p.idx >= c.a AND p.idx < c.b GROUP BY ALL)
SELECT user_id, clip, n AS n_samples, sha256('52494646' || {_LE4.format('(36 + 2 * n)')} || '57415645666d7420100000000100' || '0100' || 'e8030000' || 'd0070000' || '0200' || '1000' || '64617461' || {_LE4.format('(2 * n)')} || x) AS wav_sha256 FROM cut""")
def clip_export(spark, sf):
    """Clips of each user's signal as wav files, put together from blocks of 16 samples."""
    s = D.samples(spark, sf)
    blocks = audio.signal_blocks(s.withColumn("value", F.expr("bigint(floor(value * 100)) % 60000 - 30000")), "user_id", 16)
    clips = s.where("idx % 16 = 3").select("user_id", F.col("idx").alias("clip_name"), (F.col("idx") - 5).alias("start_ms"), (F.col("idx") + 40).alias("end_ms"))
    got = audio.export_clips(blocks, clips, "user_id", 1000, 16)
    return got.select("user_id", F.col("clip_name").alias("clip"), "n_samples", F.sha2(F.lower(F.hex("wav")), 256).alias("wav_sha256"))


@query("""SELECT i AS video_id, abs(frames * 1000 / fps - audio_ms) / (frames * 1000 / fps) AS deviation, abs(frames * 1000 / fps - audio_ms) / (frames * 1000 / fps) <= 0.3 AS passes, abs(frames * fps - audio_ms) / (frames * fps) <= 0.3 AS passes_as_is
FROM (SELECT o_orderkey AS i, (100 + o_orderkey % 900)::DOUBLE AS frames, (24 + o_orderkey % 37)::DOUBLE AS fps, (o_orderkey * 7 % 40000)::DOUBLE AS audio_ms FROM orders)""")
def duration_gate(spark, sf):
    v = D.table(spark, sf, "orders").selectExpr("o_orderkey as video_id", "double(100 + o_orderkey % 900) as frames", "double(24 + o_orderkey % 37) as fps", "double(o_orderkey * 7 % 40000) as audio_ms")
    both = intervals.duration_gate(v).join(intervals.duration_gate(v, frames_times_fps=True).select("video_id", F.col("passes").alias("passes_as_is")), "video_id")
    return both.select("video_id", "deviation", "passes", "passes_as_is")


# As-of

_SQL_ASOF = """frames AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, (epoch_us(ts) // 1000) AS ts FROM events WHERE event_type = 'view'),
middles AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seg_idx, (epoch_us(ts) // 1000) AS m FROM events WHERE event_type = 'purchase'),
total AS (SELECT user_id, count(*) AS n FROM frames GROUP BY user_id)"""


@query(f"""WITH RECURSIVE {_SQL_ASOF}, step AS (
  SELECT user_id, CAST(-1 AS BIGINT) AS seg_idx, CAST(-1 AS BIGINT) AS frame_idx FROM total
  UNION ALL
  SELECT s.user_id, s.seg_idx + 1, (SELECT min(f.frame_idx) FROM frames f WHERE f.user_id = s.user_id AND f.frame_idx > s.frame_idx AND f.ts >= m.m) FROM step s JOIN middles m ON m.user_id = s.user_id AND m.seg_idx = s.seg_idx + 1 WHERE s.frame_idx IS NOT NULL
) SELECT user_id, seg_idx, frame_idx FROM step WHERE seg_idx >= 0 AND frame_idx IS NOT NULL""")
def greedy_asof(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = D.table(spark, sf, "events")
    number = (F.row_number().over(w) - 1).cast("long")
    frames = e.where("event_type = 'view'").select("user_id", number.alias("frame_idx"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))
    middles = e.where("event_type = 'purchase'").select("user_id", number.alias("seg_idx"), F.unix_millis(F.col("ts").cast("timestamp")).alias("middle"))
    return asof.greedy_asof(frames, middles, "user_id")


# Utterances


def _decided(spark, sf):
    return utterance.decide_native(D.observations(spark, sf))


@query(f"WITH RECURSIVE {D.SQL_DECIDED} SELECT video_id, run_idx, speaker, text, start_ms, end_ms, dropped, is_last FROM runs")
def utterance_fold_lev(spark, sf):
    return utterance.runs(_decided(spark, sf))


@query(f"""WITH RECURSIVE {D.SQL_DECIDED} SELECT video_id, seg_idx, is_new, bad, CASE WHEN is_new AND bad THEN 'NEW_UTTERANCE_BAD' WHEN is_new THEN 'NEW_UTTERANCE_GOOD' WHEN bad THEN 'DROP_UTTERANCE' ELSE 'SAME_UTTERANCE' END AS status FROM decided""")
def utterance_status(spark, sf):
    return _decided(spark, sf).select("video_id", "seg_idx", "is_new", "bad", "status")


@query(f"""WITH RECURSIVE {D.SQL_DECIDED}, a AS (SELECT video_id, count(*) AS potential, CAST(sum(cleaner) AS BIGINT) AS cleaner, CAST(sum(no_speaker) AS BIGINT) AS no_speaker, CAST(sum(no_transcript) AS BIGINT) AS no_transcript, CAST(sum(discrepancy) AS BIGINT) AS discrepancies, CAST(sum(blacklisted) AS BIGINT) AS blacklisted FROM decided GROUP BY video_id),
b AS (SELECT video_id, count_if(NOT dropped) AS e, count_if(dropped) AS l FROM runs WHERE NOT is_last GROUP BY video_id)
SELECT a.video_id, potential, CAST(coalesce(e, 0) AS BIGINT) AS successful, CAST(coalesce(l, 0) AS BIGINT) AS total_dropped, cleaner, no_speaker, no_transcript, discrepancies, blacklisted, CAST(0 AS BIGINT) AS verification_failed FROM a LEFT JOIN b USING (video_id)""")
def utterance_stats(spark, sf):
    return utterance.statistics(_decided(spark, sf))


@query(f"WITH RECURSIVE {D.SQL_DECIDED} SELECT *, printf('%s-%d-%04d', speaker, video_id, utt_idx) AS clip_name FROM utts")
def clip_names(spark, sf):
    return utterance.utterances(_decided(spark, sf))


@query(f"WITH RECURSIVE {D.SQL_DECIDED} SELECT video_id, speaker, CAST(count(*) AS INTEGER) AS n_lines, string_agg(printf('%s-%d-%04d', speaker, video_id, utt_idx) || ' ' || text, chr(10) ORDER BY utt_idx) AS content FROM utts GROUP BY video_id, speaker")
def utterance_transcripts(spark, sf):
    return utterance.transcript_text(utterance.utterances(_decided(spark, sf)), ["video_id", "speaker"], "utt_idx", F.concat_ws(" ", "clip_name", "text"))


@query(_SQL["utterance_status"])
def utterance_fold_stream(spark, sf):
    """The fold as a stream: observations replayed out of order, a slice of 32 segments after the other and half of each with the next one."""
    late = F.pmod(F.xxhash64("video_id", "seg_idx"), F.lit(2))
    rows = D.observations(spark, sf).withColumn("ts", F.timestamp_seconds(F.col("seg_idx") + 10**6)).withColumn("slice", F.least(F.floor(F.col("seg_idx") / 32) + late, F.lit(15)))
    rows = written(rows.select("video_id", "seg_idx", "ts", "start_ms", "end_ms", "speaker", "text", F.lit(False).alias("speaker_invalid"), F.lit(False).alias("text_invalid"), "allowed", "slice"), "observations", by="slice")
    folder = f"{shared_folder(spark)}/replay-{uuid.uuid4().hex}"
    slices = rows.agg(F.max("slice")).first()[0]
    stream = ordered.replayed(rows, "slice", f"{folder}/in", 0 if slices is None else slices + 1, max(8, spark.sparkContext.defaultParallelism))
    similar = lambda a, b: T.levenshtein_text(a, b) if 5 * min(len(a), len(b)) > 3 * max(len(a), len(b)) else 0.0  # noqa: E731  no similarity exceeds the ratio of lengths
    done = ordered.run_to_end(ordered.decide_ordered(stream, "96 seconds" if slices is None or slices < 15 else "100 days", similar), folder)
    return done.where("video_id >= 0").select("video_id", "seg_idx", "is_new", "bad", "status")


def _dataset(spark, sf):
    segments, frames = D.recording(spark, sf)
    return dataset.build(segments, frames, _allow(spark), lambda u: (u["video_id"] * 7 + u["utt_idx"]) % 5 == 0)


@query(f"""WITH RECURSIVE {D.SQL_RECORDING}, a AS (SELECT video_id, count(*) AS potential, CAST(sum(cleaner) AS BIGINT) AS cleaner, CAST(sum(no_speaker) AS BIGINT) AS no_speaker, CAST(sum(no_transcript) AS BIGINT) AS no_transcript, CAST(sum(discrepancy) AS BIGINT) AS discrepancies, CAST(sum(blacklisted) AS BIGINT) AS blacklisted FROM decided GROUP BY video_id),
b AS (SELECT video_id, count_if(NOT dropped) AS e, count_if(dropped) AS l FROM runs WHERE NOT is_last GROUP BY video_id), c AS (SELECT video_id, count(*) AS f FROM rejects GROUP BY video_id)
SELECT a.video_id, potential, CAST(coalesce(e, 0) - coalesce(f, 0) AS BIGINT) AS successful, CAST(coalesce(l, 0) + coalesce(f, 0) AS BIGINT) AS total_dropped, cleaner, no_speaker, no_transcript, discrepancies, blacklisted, CAST(coalesce(f, 0) AS BIGINT) AS verification_failed FROM a LEFT JOIN b USING (video_id) LEFT JOIN c USING (video_id)""")
def dataset_statistics(spark, sf):
    """The whole plan from segments to counters, with rejects of verification."""
    return _dataset(spark, sf).statistics


@query(f"""WITH RECURSIVE {D.SQL_RECORDING}, kept AS (SELECT *, printf('%s-%d-%04d', speaker, video_id, utt_idx) AS clip_name FROM utts WHERE (video_id, speaker, utt_idx) NOT IN (SELECT (video_id, speaker, utt_idx) FROM rejects)),
parted AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY speaker, video_id ORDER BY utt_idx) <= floor(count(*) OVER (PARTITION BY speaker, video_id) * 0.9::DOUBLE) OR count(*) OVER (PARTITION BY speaker, video_id) - floor(count(*) OVER (PARTITION BY speaker, video_id) * 0.9::DOUBLE) < 1 THEN 'train' ELSE 'test' END AS split FROM kept)
SELECT split, speaker, video_id, CAST(count(*) AS INTEGER) AS n_lines, string_agg(clip_name || ' ' || text, chr(10) ORDER BY utt_idx) AS content FROM parted GROUP BY ALL""")
def dataset_transcripts(spark, sf):
    """The whole plan from segments to the split transcripts of verified utterances."""
    return _dataset(spark, sf).transcripts


@query()
def utterance_fold_ratio(spark, sf):
    return utterance.utterances(utterance.decide_exact(D.observations(spark, sf)), flush_tail=True)


@query()
def utterance_fold_matching(spark, sf):
    """``utterance_fold_ratio``, matched in Python only where bounds leave a stretch open."""
    return utterance.utterances(utterance.decide_matching(D.observations(spark, sf)), flush_tail=True)


@query("SELECT conv_id, CAST(count(*) AS INTEGER) AS n_lines, string_agg(concat_ws(' ', upper(role), replace(text, chr(10), ' ')), chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id")
def ordered_transcript(spark, sf):
    return utterance.transcript_text(D.table(spark, sf, "conversations"), ["conv_id"], "turn", F.concat_ws(" ", F.upper("role"), F.replace("text", F.lit("\n"), F.lit(" "))))


# Split

_SQL_SPLIT = "split AS (SELECT doc_id, source, lang, CASE WHEN row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) <= floor(count(*) OVER (PARTITION BY source, lang) * 0.9::DOUBLE) OR count(*) OVER (PARTITION BY source, lang) - floor(count(*) OVER (PARTITION BY source, lang) * 0.9::DOUBLE) < 1 THEN 'train' ELSE 'test' END AS split FROM documents)"


def _split(spark, sf):
    return split.positional_split(D.table(spark, sf, "documents").select("doc_id", "source", "lang"), ["source", "lang"], ["doc_id"])


@query(f"WITH {_SQL_SPLIT} SELECT * FROM split")
def train_test_split(spark, sf):
    return _split(spark, sf)


@query(f"WITH {_SQL_SPLIT} SELECT split, count(*) AS n FROM split GROUP BY split")
def split_counts(spark, sf):
    return split.count_split(D.table(spark, sf, "documents").select("source", "lang"), ["source", "lang"])


@query(f"WITH {_SQL_SPLIT} SELECT doc_id, split, 'out/' || split || '/' || source || '/' || lang || '/' || doc_id || '.wav' AS new_path FROM split")
def split_path_rewrite(spark, sf):
    rows = _split(spark, sf).withColumn("path", F.concat(F.lit("out/full/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav")))
    return split.split_paths(rows).select("doc_id", "split", "new_path")


# Outliers

_SQL_SCORES = "scores AS (SELECT a.label, a.vec_id, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) / greatest(count(*) - 1, 1) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label GROUP BY a.label, a.vec_id)"


def _scores(spark, sf):
    return outliers.member_scores(D.table(spark, sf, "embeddings"), "label", "vec_id", "embedding")


@query(f"WITH {_SQL_SCORES} SELECT label, vec_id, round(score, 5) AS score, score > {TOLERANCE} AS rejected FROM scores")
def l2_outliers(spark, sf):
    return _scores(spark, sf).select("label", "vec_id", F.round("score", 5).alias("score"), (F.col("score") > TOLERANCE).alias("rejected"))


@query(f"WITH {_SQL_SCORES} SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM scores WHERE score > {TOLERANCE})")
def outlier_antijoin(spark, sf):
    rejects = outliers.rejected(_scores(spark, sf), TOLERANCE)
    return outliers.without_rejected(D.table(spark, sf, "embeddings").select("vec_id", "label"), rejects, ["vec_id"])


@query(f"WITH {_SQL_SCORES} SELECT printf('%.2f - %d', round(score, 5), vec_id) AS line FROM scores WHERE score > {TOLERANCE}")
def outlier_report(spark, sf):
    return outliers.report_lines(outliers.rejected(_scores(spark, sf), TOLERANCE).withColumn("score", F.round("score", 5)), "vec_id")


@query("WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS k FROM embeddings), c AS (SELECT label, k, avg(v) AS m FROM x GROUP BY ALL) SELECT x.label, vec_id, round(sqrt(sum((v - m) * (v - m))), 5) AS score FROM x JOIN c USING (label, k) GROUP BY x.label, vec_id")
def l2_outliers_centroid(spark, sf):
    s = outliers.member_scores(D.table(spark, sf, "embeddings"), "label", "vec_id", "embedding", "centroid")
    return s.select("label", "vec_id", F.round("score", 5).alias("score"))


# Transcripts and alignment


def _entries(spark, sf):
    lines = D.table(spark, sf, "conversations").where("text is not null").select("conv_id", "turn", F.when(F.col("turn") % 7 == 6, "").otherwise(F.concat_ws(" ", F.format_string("%s-%d-%04d", F.upper("role"), F.col("conv_id"), F.col("turn")), F.replace("text", F.lit("\n"), F.lit(" ")))).alias("value"))
    return align.transcript_entries(lines).select("conv_id", "turn", "clip_name", "text")


_SQL_ENTRIES = "entries AS (SELECT conv_id, turn, printf('%s-%d-%04d', upper(role), conv_id, turn) AS clip_name, replace(text, chr(10), ' ') AS text FROM conversations WHERE text IS NOT NULL AND turn % 7 <> 6)"


@query(f"WITH {_SQL_ENTRIES} SELECT * FROM entries")
def transcript_parse(spark, sf):
    return _entries(spark, sf)


@query(f"WITH {_SQL_ENTRIES}, a AS (SELECT conv_id, count(*) AS lines FROM entries GROUP BY conv_id), b AS (SELECT conv_id, count(*) AS clips FROM conversations WHERE text IS NOT NULL GROUP BY conv_id) SELECT conv_id, lines, clips FROM a FULL JOIN b USING (conv_id) WHERE lines IS DISTINCT FROM clips")
def transcript_completeness(spark, sf):
    return align.incomplete_directories(_entries(spark, sf), D.table(spark, sf, "conversations").where("text is not null"), ["conv_id"])


@query(f"WITH {_SQL_ENTRIES} SELECT e.conv_id, e.turn, e.text, 'full/' || e.conv_id || '/' || e.clip_name || '.wav' AS path FROM entries e")
def clip_text_join(spark, sf):
    e = _entries(spark, sf)
    clips = D.table(spark, sf, "conversations").select("conv_id", "turn", F.format_string("full/%d/%s-%d-%04d.wav", F.col("conv_id"), F.upper("role"), F.col("conv_id"), F.col("turn")).alias("path"))
    return align.clip_texts(e, clips, ["conv_id", "turn"]).select("conv_id", "turn", "text", "path")


@query("SELECT page_id, CASE WHEN ext = '.wav' OR ext = '.txt' THEN 'full/S/' || page_id || ext END AS dest, 'full/S/1/' || page_id || ext AS path FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '.wav' WHEN 1 THEN '.txt' WHEN 2 THEN '.trans.txt' ELSE '.mp4' END AS ext FROM pages)")
def flatten_paths(spark, sf):
    ext = F.element_at(F.array(*[F.lit(x) for x in (".wav", ".txt", ".trans.txt", ".mp4")]), (F.col("page_id") % 4 + 1).cast("int"))
    rows = D.table(spark, sf, "pages").select("page_id", F.concat(F.lit("full/S/1/"), F.col("page_id").cast("string"), ext).alias("path"))
    return rows.select("page_id", align.flat_destination(F.col("path")).alias("dest"), "path")


def _grids(spark, sf):
    g = D.grids(spark, sf)
    iv = g.select("conv_id", "turn", "silence_end_ms", align.textgrid_intervals(F.col("content")).alias("iv"))
    return iv.select("conv_id", "turn", align.ends_silent(F.col("iv")).alias("ends_silent"), align.with_leading_silence(F.col("iv"), F.col("silence_end_ms")).alias("iv"))


@query(f"WITH {D.SQL_GRIDS} SELECT conv_id, turn, true AS ends_silent, CAST(len(texts) AS INTEGER) AS n, array_to_string(texts, '|') AS texts, round(list_sum(ends), 6) AS total FROM repaired")
def interval_array_repair(spark, sf):
    g = _grids(spark, sf)
    return g.select("conv_id", "turn", "ends_silent", F.size("iv").alias("n"), F.array_join(F.transform("iv", lambda x: x["text"]), "|").alias("texts"), F.round(F.aggregate("iv", F.lit(0.0), lambda a, x: a + x["xmax"]), 6).alias("total"))


@query(f"""WITH {D.SQL_GRIDS} SELECT conv_id, turn, 'C-' || conv_id || '-' || printf('%04d', turn) || ' "' || upper(array_to_string(texts, ',')) || '" "' || array_to_string(list_transform(ends, lambda x: CASE WHEN x = 0 THEN '0' ELSE CAST(CAST(x AS DOUBLE) AS VARCHAR) END), ',') || '"' AS line FROM repaired""")
def alignment_lines(spark, sf):
    clip = F.format_string("C-%d-%04d", F.col("conv_id"), F.col("turn"))
    return _grids(spark, sf).select("conv_id", "turn", align.alignment_line(clip, F.col("iv")).alias("line"))


@query(f"""WITH {_SQL_SILENCE}, first AS (SELECT user_id, min(s) AS s, arg_min(e, s) AS e FROM silence GROUP BY user_id), u AS (SELECT DISTINCT user_id FROM samples)
SELECT u.user_id, first.e AS silence_end, CASE WHEN first.e IS NULL OR first.e >= 250 THEN 0.0::DOUBLE ELSE first.e / 1000 END AS cut FROM u LEFT JOIN first USING (user_id)""")
def first_silence_repair(spark, sf):
    """Each user's signal as a clip: the end of its first silence cuts a first interval of a quarter second."""
    silences = intervals.first_silence(D.samples(spark, sf), "user_id", 4, 3.0)
    iv = F.array(F.struct(F.lit(0.0).alias("xmin"), F.lit(0.25).alias("xmax"), F.lit("go").alias("text")), F.struct(F.lit(0.25).alias("xmin"), F.lit(0.5).alias("xmax"), F.lit("").alias("text")))
    return silences.select("user_id", F.col("end").alias("silence_end"), F.element_at(align.with_leading_silence(iv, F.col("end")), 1)["xmax"].alias("cut"))


_FLOAT = "(o_orderkey * 7919 % 100003) * power(CAST(10 AS DOUBLE), greatest(o_orderkey % 27 - 12, 0)) / power(CAST(10 AS DOUBLE), greatest(12 - o_orderkey % 27, 0))"


@query(f"SELECT o_orderkey AS k, CAST({_FLOAT} AS VARCHAR) AS text FROM orders")
def python_floats(spark, sf):
    return D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), T.python_float(F.expr(_FLOAT)).alias("text"))


@query(f"WITH {_SQL_ENTRIES}, d AS (SELECT e.* FROM entries e WHERE (e.conv_id + e.turn) % 3 = 0) SELECT conv_id, CAST(count(*) AS INTEGER) AS n, 'Dropped: ' || count(*) || chr(10) || chr(10) || string_agg('  ' || clip_name, chr(10) ORDER BY clip_name) AS content FROM d GROUP BY conv_id")
def alignment_dropped(spark, sf):
    drops = align.dropped(_entries(spark, sf), D.grids(spark, sf), ["conv_id", "turn"])
    return align.dropped_report(drops, "clip_name", ["conv_id"])


@query(f"WITH {_SQL_ENTRIES} SELECT conv_id, turn, clip_name FROM entries WHERE (conv_id + turn) % 3 <> 0")
def alignment_kept(spark, sf):
    return align.aligned(_entries(spark, sf), D.grids(spark, sf), ["conv_id", "turn"]).select("conv_id", "turn", "clip_name")


# Frames

_SIZES = ((1920, 1080), (1280, 720), (640, 360))


@query("WITH roi AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{r}', {a}::DOUBLE, {b}::DOUBLE, {x}::DOUBLE, {y}::DOUBLE)" for c, r, a, b, x, y in ROI) + ") v(category, region, a, b, x, y)), sizes AS (SELECT * FROM (VALUES " + ", ".join(f"({w}, {h})" for w, h in _SIZES) + ") s(width, height)) SELECT category, region, width, height, CAST(floor(a * width) AS BIGINT) AS x1, CAST(floor(b * height) AS BIGINT) AS y1, CAST(width - floor(x * width) AS BIGINT) AS x2, CAST(height - floor(y * height) AS BIGINT) AS y2 FROM roi, sizes")
def roi_boxes(spark, sf):
    rows = [(c, w, h) for c in sorted({r[0] for r in ROI}) for w, h in _SIZES]
    return images.roi_boxes(spark.createDataFrame(rows, "category string, width int, height int"), images.roi_table(spark))


_FRAMES = "SELECT doc_id AS video_id, ['" + "', '".join(CATEGORIES) + "', 'other'][doc_id % 6 + 1] AS category, 320 + n_chars % 1601 AS width, 180 + n_chars % 901 AS height FROM documents"


@query(f"WITH roi AS (SELECT * FROM (VALUES {', '.join(f'({D.q(c)}, {D.q(r)}, {a}::DOUBLE, {b}::DOUBLE, {x}::DOUBLE, {y}::DOUBLE)' for c, r, a, b, x, y in ROI)}) v(category, region, a, b, x, y)) SELECT video_id, f.category, width, height, region, CAST(floor(a * width) AS BIGINT) AS x1, CAST(floor(b * height) AS BIGINT) AS y1, CAST(width - floor(x * width) AS BIGINT) AS x2, CAST(height - floor(y * height) AS BIGINT) AS y2 FROM ({_FRAMES}) f JOIN roi ON f.category = roi.category")
def frame_regions(spark, sf):
    """Every document as a frame of a size of its own: the boxes of its category's regions."""
    category = F.element_at(F.array(*[F.lit(c) for c in (*CATEGORIES, "other")]), (F.col("doc_id") % 6 + 1).cast("int"))
    frames = D.table(spark, sf, "documents").select(F.col("doc_id").alias("video_id"), category.alias("category"), (F.col("n_chars") % 1601 + 320).alias("width"), (F.col("n_chars") % 901 + 180).alias("height"))
    return images.roi_boxes(frames, images.roi_table(spark))


@query()
def frame_preprocessing(spark, sf):
    """Every text's bytes as frames, the last one padded with zeros, through crop, preprocessing and a stand-in for recognition."""
    categories = sorted({r[0] for r in ROI})
    size = 48 * 64 * 3
    docs = D.spread(D.table(spark, sf, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", F.col("text").cast("binary").alias("raw"))
    parts = docs.select("doc_id", "raw", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("raw") / size), F.lit(1)).cast("int") - 1)).alias("k"))
    piece = F.substring(F.col("raw"), F.col("k") * size + 1, F.lit(size))
    pixels = F.concat(piece, F.unhex(F.repeat(F.lit("00"), F.lit(size) - F.octet_length(piece))))
    frames = parts.select(F.col("doc_id").alias("video_id"), F.col("k").cast("long").alias("frame_idx"), F.element_at(F.array(*[F.lit(c) for c in categories]), (F.col("doc_id") % 5 + 1).cast("int")).alias("category"), F.lit(64).alias("width"), F.lit(48).alias("height"), pixels.alias("image"))
    return images.recognise(frames, lambda image: f"{image.shape}:{int(image.sum())}")


# Event time


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 10 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM m)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 10 MINUTE AS "end", count(*) AS n FROM k GROUP BY user_id, i""")
def activity_by_session(spark, sf):
    return activity_sessions(D.table(spark, sf, "events"), "user_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
