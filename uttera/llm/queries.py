"""Queries of this subpackage, and DuckDB SQL for those that SQL can express.

Without SQL: models (4, 6, 7, 11), token ids (2, 8), iterated propagation (10), 50-byte strings at every position (1, too
slow on whole tables) and the pipeline; tests compare those with brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from uttera.llm.contamination import op9_decontamination
from uttera.llm.context_tree import op11_lm_scoring
from uttera.llm.jaccard import op3_ngram_jaccard
from uttera.llm.language import op6_language_id
from uttera.llm.packing import op2_packing
from uttera.llm.periodic import op12_periodic_runs
from uttera.llm.privacy import op7_pii
from uttera.llm.quality import op4_quality_rules
from uttera.llm.spelling import op13_spelling_variants
from uttera.llm.substrings import op1_suffix_dedup
from uttera.llm.token_shards import op8_token_shards
from uttera.llm.urls import op10_url_filter
from uttera.llm.warc import op5_warc


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_packing": op2_packing,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_quality_rules": op4_quality_rules,
        "op5_warc": op5_warc,
        "op6_language_id": op6_language_id,
        "op7_pii": op7_pii,
        "op8_token_shards": op8_token_shards,
        "op9_decontamination": op9_decontamination,
        "op10_url_filter": op10_url_filter,
        "op11_lm_scoring": op11_lm_scoring,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": _pipeline,
    }


_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

_JACCARD = f"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, least(t.doc_id, (SELECT min(b) FROM r WHERE a = t.doc_id)) AS component_id FROM t LEFT JOIN n ON n.doc_id = t.doc_id"""

_WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), g AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(x, CAST(k // 4 AS INTEGER) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM g"""

_WORDS = f"regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_CONTAMINATION = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, z, array_to_string(w[k : k + z - 1], ' ') AS s FROM (SELECT item_id, w, least(13, len(w)) AS z, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, z, k, array_to_string(w[k : k + z - 1], ' ') AS s FROM (SELECT doc_id, w, z, unnest(range(1, len(w) - z + 2)) AS k FROM d, (SELECT DISTINCT z FROM iw) WHERE len(w) >= z)),
m AS (SELECT doc_id, item_id, dw.z, k FROM dw JOIN iw ON dw.s = iw.s AND dw.z = iw.z),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + z)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id"""


#: The checksum's table of bytes as a DuckDB list.
_CRC = "crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"

_RUNS = f"""WITH {_CRC},
d AS (SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(doc_id::VARCHAR)), lambda k: CAST(ascii(substr(doc_id::VARCHAR, k + 1, 1)) AS BIGINT))), lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]))) AS h
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents), crc),
e AS (SELECT doc_id, n, w, h, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM d),
x AS (SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS w FROM (SELECT *, unnest(range(n)) AS i FROM e)),
m AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.w = b.w AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
s AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m) GROUP BY doc_id, q, k),
r AS (SELECT doc_id, s, n, min(q) AS q FROM s WHERE n >= greatest(6, 4 * q) GROUP BY doc_id, s, n),
f AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(concat(s, ',', n, ',', q, chr(10)), '' ORDER BY s, q)) AS sha, min_by(struct_pack(s := s, n := n, q := q), (-(n / q), s, q)) AS top FROM r GROUP BY doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM r),
c AS (SELECT x.doc_id, string_agg(w, ' ' ORDER BY x.i) AS text FROM x ANTI JOIN g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS "start", top.n AS length, top.q AS period, 1000 * top.n // top.q AS exponent_milli, coalesce(sha, sha256('')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM d LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""

_VARIANTS = f"""WITH RECURSIVE {_CRC},
r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
b AS (SELECT w, n, hex(encode(concat(doc_id, ':', w))) AS x FROM r),
h AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda k: CAST(concat('0x', substr(x, 2 * k + 1, 2)) AS BIGINT))), lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]))) AS h FROM b, crc),
v AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS w, n FROM h) WHERE length(w) >= 5 GROUP BY ALL HAVING sum(n) >= 3),
g AS (SELECT w, n, k, concat(substr(w, 1, k), substr(w, k + 2)) AS d FROM (SELECT w, n, unnest(range(length(w))) AS k FROM v)),
p AS (SELECT a.w, b.w AS o, b.n FROM g a JOIN g b ON a.k = b.k AND a.d = b.d AND a.w <> b.w UNION SELECT g.w, v.w, v.n FROM g JOIN v ON g.d = v.w UNION SELECT v.w, g.w, g.n FROM g JOIN v ON g.d = v.w),
m AS (SELECT w, count(*) AS n_near, arg_min(o, (-n, o)) AS o, max(n) AS f FROM p GROUP BY w),
q AS (SELECT v.w, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN f >= 2 * v.n THEN o END AS form, CASE WHEN f >= 2 * v.n THEN f END AS form_n FROM v LEFT JOIN m ON m.w = v.w),
s AS (SELECT w, coalesce(form, w) AS root FROM q UNION ALL SELECT s.w, q.form FROM s JOIN q ON q.w = s.root WHERE q.form IS NOT NULL AND s.root <> s.w),
z AS (SELECT w, arg_max(root, n) AS root FROM (SELECT s.w, s.root, q.n FROM s JOIN q ON q.w = s.root) GROUP BY w)
SELECT q.w AS word, form, root, n, n_near, form_n FROM q JOIN z ON z.w = q.w"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_jaccard": _JACCARD, "op5_warc": _WARC, "op9_decontamination": _CONTAMINATION, "op12_periodic_runs": _RUNS, "op13_spelling_variants": _VARIANTS}
