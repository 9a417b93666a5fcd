"""Inputs that the queries derive from the driver's tables, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.functions.text import ACCENTED, FIXES, PLAIN, SCRIPT_RANGE, SCRIPTS, SPECIAL, transliterate
from uttera.operators.utterance import with_allowed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the input has fewer parts than that: work on texts by the row is worth the exchange."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df


def q(s: str) -> str:
    """A DuckDB string literal."""
    return "'" + s.replace("'", "''") + "'"


def _sql_written(c: str, letters: dict[str, str]) -> str:
    single = {k: v for k, v in letters.items() if len(v) == 1}
    c = f"translate({c}, {q(''.join(single))}, {q(''.join(single.values()))})"
    for k, v in letters.items():
        if len(v) > 1:
            c = f"replace({c}, {q(k)}, {q(v)})"
    return c


def sql_transliterate(c: str) -> str:
    c = f"CASE WHEN regexp_matches({c}, '{SCRIPT_RANGE}') THEN {_sql_written(c, SCRIPTS)} ELSE {c} END"
    return _sql_written(c, {**dict(zip(ACCENTED, PLAIN, strict=True)), **SPECIAL})


def sql_clean(c: str, category: str | None = None) -> str:
    c = f"replace(replace({c}, '|', 'I'), chr(10), ' ')"
    c = f"regexp_replace({sql_transliterate(c)}, '[,!?|]', '.', 'g')"
    c = f"regexp_replace({c}, '[^A-Za-z0-9 \\t\\n\\x0B\\f\\r''.]', '', 'g')"
    c = f"trim(upper(regexp_replace(replace({c}, '.', ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), ' ')"
    if category:
        c = f"CASE WHEN {category} THEN replace({c}, '1', 'I') ELSE {c} END"
    for a, b in FIXES:
        c = f"replace({c}, {q(a)}, {q(b)})"
    return c


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four reads of every turn, some with the speaker or text blank or the end cut off."""
    turns = spread(table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", "role", "text"))
    upper = turns.select("conv_id", "turn", F.upper("role").alias("role"), F.upper(transliterate(F.col("text"))).alias("t"))  # before the reads are made: once a turn
    t = upper.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("r"))
    seq = F.col("turn") * 4 + F.col("r")
    cut = F.when((F.col("conv_id") * 7 + F.col("turn") + F.col("r")) % 11 == 0, F.expr("left(t, length(t) - 3)")).otherwise(F.col("t"))
    rows = t.select(
        F.col("conv_id").alias("video_id"), seq.alias("seg_idx"), (seq * 400 + 95).alias("start_ms"), (seq * 400 + 405).alias("end_ms"),
        F.when((F.col("conv_id") * 3 + F.col("turn") + F.col("r")) % 17 == 0, "").otherwise(F.col("role")).alias("speaker"),
        F.when((F.col("conv_id") + F.col("turn") * 5 + F.col("r")) % 13 == 0, "").otherwise(cut).alias("text"),
    )
    allowed = spark.createDataFrame([("USER",), ("ASSISTANT",)], "speaker string")
    return with_allowed(rows, allowed, [])


SQL_OBS = f"""obs AS (
  SELECT conv_id AS video_id, turn * 4 + r AS seg_idx, (turn * 4 + r) * 400 + 95 AS start_ms, (turn * 4 + r) * 400 + 405 AS end_ms,
    CASE WHEN (conv_id * 3 + turn + r) % 17 = 0 THEN '' ELSE role END AS s,
    CASE WHEN (conv_id + turn * 5 + r) % 13 = 0 THEN '' WHEN (conv_id * 7 + turn + r) % 11 = 0 THEN left(t, greatest(length(t) - 3, 0)) ELSE t END AS t, false AS si, false AS ti
  FROM (SELECT conv_id, turn, upper(role) AS role, upper({sql_transliterate('text')}) AS t, unnest([0, 1, 2, 3]) AS r FROM conversations WHERE text IS NOT NULL)
)"""

#: The fold as a recursive query over ``obs``: one observation of every video a step. s and t are clean, si and ti the flags of the raw.
SQL_FOLD = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seg_idx) AS k FROM obs
), fold AS (
  SELECT video_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS sp, CAST(NULL AS VARCHAR) AS tx, false AS drp, CAST(NULL AS BIGINT) AS seg_idx, CAST(NULL AS BIGINT) AS start_ms, CAST(NULL AS BIGINT) AS end_ms,
    CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS t, false AS is_new, false AS bad, 0 AS no_speaker, 0 AS no_transcript, 0 AS discrepancy, 0 AS blacklisted, 0 AS cleaner
  FROM (SELECT DISTINCT video_id FROM obs)
  UNION ALL
  SELECT video_id, k, CASE WHEN is_new THEN s ELSE sp END, CASE WHEN is_new THEN t ELSE tx END, CASE WHEN is_new THEN bad ELSE drp OR bad END, seg_idx, start_ms, end_ms, s, t, is_new, bad,
    CAST(s = '' AS INTEGER), CAST(t = '' AND NOT d2 AS INTEGER), CAST(differs AND NOT drp AS INTEGER), CAST(banned AS INTEGER), CAST(si AS INTEGER) + CAST(ti AND NOT d1 AS INTEGER)
  FROM (SELECT *, (d2 OR t = '' OR differs OR banned) AS bad FROM (SELECT *, (si OR s = '') AS d1, (si OR s = '' OR ti) AS d2, NOT is_new AND r <= 1 - 0.00001 AS differs, s NOT IN ('', 'USER', 'ASSISTANT') AS banned FROM (
    SELECT *, early OR r <= 0.6 AS is_new FROM (
      SELECT f.sp, f.tx, f.drp, n.*, (n.s = '' OR f.sp IS NULL OR f.sp <> n.s OR n.t = '') AS early,
        CASE WHEN n.s = '' OR f.sp IS NULL OR f.sp <> n.s OR n.t = '' THEN 0.0 ELSE 1.0 - levenshtein(n.t, f.tx)::DOUBLE / greatest(length(n.t), length(f.tx)) END AS r
      FROM fold f JOIN numbered n ON n.video_id = f.video_id AND n.k = f.k + 1))))
), decided AS (SELECT * FROM fold WHERE k > 0),
run_rows AS (SELECT *, sum(CAST(is_new AS BIGINT)) OVER (PARTITION BY video_id ORDER BY seg_idx) - 1 AS run_idx FROM decided),
runs AS (
  SELECT video_id, CAST(run_idx AS BIGINT) AS run_idx, arg_min(s, seg_idx) AS speaker, arg_min(t, seg_idx) AS text, arg_min(start_ms, seg_idx) AS start_ms, arg_max(end_ms, seg_idx) AS end_ms, bool_or(bad) AS dropped,
    lead(run_idx) OVER (PARTITION BY video_id ORDER BY run_idx) IS NULL AS is_last
  FROM run_rows GROUP BY video_id, run_idx
), utts AS (
  SELECT video_id, speaker, CAST(row_number() OVER (PARTITION BY video_id, speaker ORDER BY run_idx) - 1 AS INTEGER) AS utt_idx, start_ms, end_ms, text FROM runs WHERE NOT dropped AND NOT is_last
)"""
SQL_DECIDED = f"{SQL_OBS}, {SQL_FOLD}"


def recording(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Segments and frames of every conversation as a recording: three segments and twelve frames a turn.

    Some segments are short; frames have the raw speaker and text, some marked, blank or with the end cut off.
    """
    t = spread(table(spark, sf_dir, "conversations").where("text is not null").select(F.col("conv_id").alias("video_id"), "turn", "role", "text"))
    g, r = (F.explode(F.sequence(F.lit(0), F.lit(n))) for n in (2, 11))
    start = F.col("turn") * 1200 + F.col("g") * 400 + 20
    length = F.when((F.col("video_id") + F.col("turn") + F.col("g")) % 9 == 0, 30).otherwise(260)
    segments_ = t.select("video_id", "turn", g.alias("g")).select("video_id", (F.col("turn") * 3 + F.col("g")).alias("seg_idx"), start.alias("start_ms"), (start + length).alias("end_ms"))
    f = t.withColumn("r", r).withColumn("g", F.floor(F.col("r") / 4).cast("int"))
    speaker = F.when((F.col("video_id") * 3 + F.col("turn") + F.col("g")) % 17 == 0, "").when((F.col("video_id") * 5 + F.col("turn")) % 29 == 0, F.concat("role", F.lit("*"))).otherwise(F.col("role"))
    cut = F.when((F.col("video_id") * 7 + F.col("turn") + F.col("g")) % 11 == 0, F.expr("left(text, length(text) - 3)")).otherwise(F.col("text"))
    text = F.when((F.col("video_id") + F.col("turn") * 5 + F.col("g")) % 13 == 0, "").when((F.col("video_id") + F.col("turn") * 3) % 31 == 0, F.concat("text", F.lit(" *"))).otherwise(cut)
    frames = f.select("video_id", (F.col("turn") * 12 + F.col("r")).alias("frame_idx"), (F.col("turn") * 1200 + F.col("r") * 100 + F.col("video_id") % 3).alias("ts"), speaker.alias("raw_speaker"), text.alias("raw_text"))
    return segments_, frames


SQL_RECORDING = f"""turns AS (SELECT conv_id AS video_id, turn, role, text FROM conversations WHERE text IS NOT NULL),
segs AS (SELECT *, (e - b) // 2 + b AS m FROM (SELECT video_id, turn * 3 + g AS seg_idx, turn * 1200 + g * 400 + 20 AS b, turn * 1200 + g * 400 + 20 + CASE WHEN (video_id + turn + g) % 9 = 0 THEN 30 ELSE 260 END AS e FROM (SELECT *, unnest([0, 1, 2]) AS g FROM turns)) WHERE e - b >= 100),
order_ AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seg_idx) AS k FROM segs),
frames AS (SELECT video_id, turn * 12 + r AS frame_idx, turn * 1200 + r * 100 + video_id % 3 AS ts,
    CASE WHEN (video_id * 3 + turn + r // 4) % 17 = 0 THEN '' WHEN (video_id * 5 + turn) % 29 = 0 THEN role || '*' ELSE role END AS raw_speaker,
    CASE WHEN (video_id + turn * 5 + r // 4) % 13 = 0 THEN '' WHEN (video_id + turn * 3) % 31 = 0 THEN text || ' *' WHEN (video_id * 7 + turn + r // 4) % 11 = 0 THEN left(text, greatest(length(text) - 3, 0)) ELSE text END AS raw_text
  FROM (SELECT *, unnest(range(12)) AS r FROM turns)),
matched AS (
  SELECT DISTINCT video_id, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS frame_idx FROM segs
  UNION ALL
  SELECT x.video_id, x.k + 1, (SELECT min(f.frame_idx) FROM frames f WHERE f.video_id = x.video_id AND f.frame_idx > x.frame_idx AND f.ts >= o.m) FROM matched x JOIN order_ o ON o.video_id = x.video_id AND o.k = x.k + 1 WHERE x.frame_idx IS NOT NULL
),
obs AS (SELECT o.video_id, o.seg_idx, o.b - 5 AS start_ms, o.e + 5 AS end_ms, {sql_clean('raw_speaker')} AS s, {sql_clean('raw_text')} AS t,
    contains(raw_speaker, '*') OR regexp_matches(raw_speaker, '[A-Za-z]-[A-Za-z]') AS si, contains(raw_text, '*') OR regexp_matches(raw_text, '[A-Za-z]-[A-Za-z]') AS ti
  FROM order_ o JOIN matched x ON x.video_id = o.video_id AND x.k = o.k JOIN frames f ON f.video_id = o.video_id AND f.frame_idx = x.frame_idx),
{SQL_FOLD},
rejects AS (SELECT *, printf('%s-%d-%04d', speaker, video_id, utt_idx) AS clip_name FROM utts WHERE speaker IN ('USER', 'ASSISTANT') AND (video_id * 7 + utt_idx) % 5 = 0)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user as a signal: (user_id, idx, value)."""
    from pyspark.sql import Window

    return table(spark, sf_dir, "events").select("user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long").alias("idx"), "value")


SQL_SAMPLES = "samples AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, value FROM events)"


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of each user as segments from one to a fixed share of the way to the next."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id", (F.row_number().over(w) - 1).cast("long").alias("seg_idx"), F.unix_millis(F.col("ts").cast("timestamp")).alias("start_ms"), F.unix_millis(F.lead("ts").over(w).cast("timestamp")).alias("next_ms"))
    return e.where("next_ms is not null").select("user_id", "seg_idx", "start_ms", F.expr("start_ms + least(next_ms - start_ms + 3, 3600000)").alias("end_ms"))


SQL_SEGMENTS = """segments AS (
  SELECT user_id, seg_idx, start_ms, start_ms + least(next_ms - start_ms + 3, 3600000) AS end_ms FROM (
    SELECT user_id, row_number() OVER w - 1 AS seg_idx, (epoch_us(ts) // 1000) AS start_ms, (epoch_us(lead(ts) OVER w) // 1000) AS next_ms FROM events WHERE event_type = 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  WHERE next_ms IS NOT NULL
)"""


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid text for two thirds of the turns: a word an interval, the last one silent, and a second tier."""
    t = table(spark, sf_dir, "conversations").where("text is not null and (conv_id + turn) % 3 <> 0")
    words = F.split(F.trim(F.regexp_replace("text", "[^A-Za-z ]+", "")), " +")
    item = lambda w, i: F.format_string('        intervals [%d]:\n            xmin = %s \n            xmax = %s \n            text = "%s" \n', i + 1, (i * F.lit(0.25)).cast("string"), ((i + 1) * F.lit(0.25)).cast("string"), w)
    body = F.array_join(F.transform(F.concat("w", F.array(F.lit(""))), item), "")
    head = 'File type = "ooTextFile"\nxmin = 0 \nxmax = 9 \nitem []: \n    item [1]:\n        name = "words" \n        xmin = 0 \n        xmax = 9 \n        intervals: size = '
    tail = '    item [2]:\n        name = "phones" \n        xmin = 0 \n        xmax = 9 \n        intervals: size = 1 \n        intervals [1]:\n            xmin = 0 \n            xmax = 9 \n            text = "x" \n'
    return t.withColumn("w", words).select("conv_id", "turn", F.concat(F.lit(head), (F.size("w") + 1).cast("string"), F.lit(" \n"), body, F.lit(tail)).alias("content"), F.when((F.col("turn") % 2) == 0, F.lit(120)).when(F.col("turn") % 3 == 0, F.lit(400)).alias("silence_end_ms"))


SQL_GRIDS = """grids AS (
  SELECT conv_id, turn, list_append(w, '') AS w, CASE WHEN turn % 2 = 0 THEN 120 WHEN turn % 3 = 0 THEN 400 END AS silence_end_ms
  FROM (SELECT conv_id, turn, regexp_split_to_array(trim(regexp_replace(text, '[^A-Za-z ]+', '', 'g'), ' '), ' +') AS w FROM conversations WHERE text IS NOT NULL AND (conv_id + turn) % 3 <> 0)
), repaired AS (
  SELECT conv_id, turn, CASE WHEN w[1] <> '' THEN list_concat([''], w) ELSE w END AS texts,
    CASE WHEN w[1] <> '' THEN list_concat([CASE WHEN silence_end_ms IS NULL OR silence_end_ms / 1000 >= 0.25 THEN 0.0 ELSE silence_end_ms / 1000 END], list_transform(range(1, len(w) + 1), lambda i: i * 0.25::DOUBLE)) ELSE list_transform(range(1, len(w) + 1), lambda i: i * 0.25::DOUBLE) END AS ends
  FROM grids
)"""
