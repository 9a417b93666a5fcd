"""Personal data: fixed patterns, and a skip-chain conditional random field that adds spans.

Patterns (email, ip, card, phone) are found leftmost and without overlap per kind; matches that
fail their test are dropped without a retry. They are written so that every scan is linear.

The field's nodes are mentions: tokens with a digit, ``@`` or a dozen capitals in a row; up to ``RUN`` neighbouring tokens of
digits and punctuation are one mention, and of ``key=value`` the value is. Labels are the four kinds, secrets (passwords,
tokens, access keys: no pattern finds them, the field alone adds and counts them) and none. Chain edges join mentions at most
``NEAR`` words apart. Skip edges join each mention, however distant, to the first one in the document of
the same letters and digits, the same seven or more digits, or the same part before ``@`` (*same* edges), and of one edit's
difference or a long common beginning (*similar* edges). As they meet in the first mention, any two are two steps apart.

Weights are trained on a bounded sample (``TRAIN_ROWS`` documents with candidates, smallest hashes of doc_id) by gradient
ascent on the pseudo-likelihood. Its labels come from the patterns, and from key words for secrets; so that the field
learns what patterns cannot see, mentions are repeated in the sample in disguise (other separators, a sign left out,
one character changed) with their label but without their pattern, beside disguised mentions of nobody and repeats of
clean tokens, which are none; some texts get a secret in a common form, and its value alone, which is none. When decoding, mentions that a pattern covers are evidence: their label is held while messages pass
over all edges until none changes by more than ``TOLERANCE`` (at most ``ROUNDS`` damped rounds). A mention with a label of
at least ``SURE`` that touches no pattern span is added, without surrounding punctuation.

Defined results: null text is empty: no spans, the hash of the empty string. Documents without
candidates cost one scan. Without any document with a candidate there is no field, and the patterns stand alone. Rows are independent,
so repeated rows give equal results; of a repeated doc_id the least text is in the sample. Positions are code points.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm import bytesops as B
from uttera.llm.columns import shielded

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS, "secret")
SECRET = 5
TRAIN_ROWS = 2000
FEATURES = 1 << 14
NEAR = 2
RUN = 6
ROUNDS = 400
TOLERANCE = 1e-3
SURE = 0.9
HELD = 40.0  # log odds of evidence
EDGES = ("chain", "same", "similar")
PRIOR = (0.0, 4.0, 2.0)  # what agreement over an edge is worth before anything is learnt
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++(?=@)")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CANDIDATE = re.compile(r"[0-9@]|[A-Z]{12}")
_NUMERIC = re.compile(r"[0-9+().,/:\[\]-]*[0-9][0-9+().,/:\[\]-]*")
_KEYED = re.compile(r"[^A-Za-z0-9]*([A-Za-z_][A-Za-z0-9_-]*)[=:]+[\"'(\[]*(?=.)")
#: Fixed words that announce a secret, and the public form of an access key.
SECRET_KEYS = ("password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "access_key", "auth")
_SECRET_KEY = re.compile("(?i)" + "|".join(SECRET_KEYS))
_ACCESS_KEY = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}")
_AT = re.compile(r"(?i)[\[({<](?:at|dot)[\])}>]")
_EDGE = ".,;:!?()[]{}<>\"'#*$&|"
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CANDIDATE_BYTES = B.lut(b"0123456789@")
CAPITALS = B.lut(range(65, 91))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` decides alone: what stands before it, after the last match, and a domain behind it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
            at = text.find("@", end)
        else:
            end = at + 1  # no later match can begin before this sign
            at = text.find("@", end)
    return out


def patterns(text: str) -> dict[str, list[tuple[int, int]]]:
    """The pattern spans of a text by kind."""
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    cards = []
    for m in _CARD.finditer(text):
        d = digits_of(m[0]) if m.end() - m.start() < 40 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15] if "+" in text else []
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


def shape(word: str) -> str:
    out = []
    for c in word:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def describe(core: str, key: str, two: str, before: str, after: str) -> list[int]:
    """Hashed features of a mention."""
    d, letters = sum(c.isdigit() for c in core), sum(c.isalpha() for c in core)
    hexadecimal = len(core) >= 16 and all(c in "0123456789abcdef" for c in core)
    named = [
        "shape=" + shape(core), f"digits={min(d, 20)}", f"letters={min(letters, 12)}", f"dots={min(core.count('.'), 5)}", f"ats={min(core.count('@'), 2)}", f"dashes={min(core.count('-'), 4)}", f"length={min(len(core) // 4, 12)}",
        f"luhn={d >= 13 and luhn(digits_of(core))}", f"hex={hexadecimal}", "capitals=" + str(len(core) >= 16 and core.isupper()), "key=" + key.lower(), f"secret key={bool(_SECRET_KEY.fullmatch(key))}",
        "before=" + before.strip(_EDGE).lower(), "two=" + two.strip(_EDGE).lower(), "after=" + shape(after), "before shape=" + shape(before), "head=" + core[:4] if core.isupper() else "head=", "all",
    ]
    return [zlib.crc32(x.encode()) % FEATURES for x in named]


NAMED = len(describe("1", "", "", "", ""))


def skip_keys(core: str) -> tuple[set[str], set[str]]:
    """What mentions of one entity have in common: keys of *same* and of *similar* edges."""
    plain = _AT.sub("", core)
    letters = "".join(c for c in plain.lower() if c.isalnum())
    d = digits_of(core)
    same, similar = set(), set()
    if len(letters) >= 5 and (len(letters) > len(d) >= 2 or "@" in core or plain != core or len(letters) >= 12):
        same.add("a" + letters)
        if 8 <= len(letters) <= 64 and len(letters) > len(d):
            similar.update("e" + letters[:k] + letters[k + 1 :] for k in range(len(letters)))
            similar.add("e" + letters)
        if len(letters) >= 16:
            similar.add("p" + letters[:12])
    if len(d) >= 7:
        same.add("d" + d)
        if 10 <= len(d) <= 15:
            same.add("t" + d[-10:])
        if 8 <= len(d) <= 24:
            similar.update("n" + d[:k] + d[k + 1 :] for k in range(len(d)))
            similar.add("n" + d)
    if "@" in core:
        local = "".join(c for c in core[: core.index("@")].lower() if c.isalnum())
        if len(local) >= 5:
            same.add("a" + local)
    return same, similar


def mentions(text: str) -> list[tuple[int, int, int, int, str]]:
    """(start, end, first word, last word, key) of every mention, surrounding punctuation left out."""
    spans = [m.span() for m in _WORD.finditer(text)]
    runs: list[list[int]] = []
    for k, (a, b) in enumerate(spans):
        if not _CANDIDATE.search(text, a, b):
            continue
        numeric = _NUMERIC.fullmatch(text, a, b) is not None
        if numeric and runs and runs[-1][1] == k - 1 and runs[-1][2]:
            runs[-1][1] = k
        else:
            runs.append([k, k, numeric])
    out = []
    for first, last, _ in runs:
        parts = [(first, last)] if last - first < RUN else [(k, k) for k in range(first, last + 1)]
        for f, z in parts:
            a, b = spans[f][0], spans[z][1]
            m = _KEYED.match(text, a, b)
            key, a = (m[1], m.end()) if m and _CANDIDATE.search(text, m.end(), b) else ("", a)
            if not key and f > 1 and text[slice(*spans[f - 1])] in ("=", ":"):
                key = text[slice(*spans[f - 2])].strip(_EDGE)
            core = text[a:b]
            start = a + len(core) - len(core.lstrip(_EDGE))
            end = start + len(core.strip(_EDGE))
            if start < end:
                out.append((start, end, f, z, key))
    return out


def is_secret(key: str, core: str) -> bool:
    return bool(_SECRET_KEY.fullmatch(key) and len(core) >= 8 or _ACCESS_KEY.fullmatch(core))


class Graph:
    """Mentions and edges of many texts."""

    def __init__(self):
        self.spans: list[tuple[int, int, int]] = []  # text, start, end
        self.features: list[list[int]] = []
        self.evidence: list[int] = []  # label of the pattern that covers the mention, else 0
        self.labels: list[int] = []  # the same with secrets and what training knows
        self.edges: dict[str, list[tuple[int, int]]] = {e: [] for e in EDGES}

    def add(self, number: int, text: str, found: dict[str, list[tuple[int, int]]], known: list[tuple[int, int, int]] = ()) -> None:
        """``known`` are (start, end, label) that hold whatever the patterns say."""
        words = [m.span() for m in _WORD.finditer(text)]
        word = lambda k: text[slice(*words[k])] if 0 <= k < len(words) else ""
        starts = {kind: [a for a, _ in found[kind]] for kind in KINDS}
        last, same, similar = None, {}, {}
        for start, end, f, z, key in mentions(text):
            node, core, label = len(self.spans), text[start:end], 0
            for k, kind in enumerate(KINDS):
                at = bisect_left(starts[kind], end) - 1
                if not label and at >= 0 and found[kind][at][1] > start:
                    label = k + 1
            told = next((x for a, b, x in known if a < end and b > start), None)
            self.evidence.append(label)
            self.labels.append(told if told is not None else label or (SECRET if is_secret(key, core) else 0))
            self.spans.append((number, start, end))
            self.features.append(describe(core, key, word(f - 2), word(f - 1), word(z + 1)))
            if last is not None and f - last[0] <= NEAR:
                self.edges["chain"].append((last[1], node))
            last = (z, node)
            joined = set()
            for kind, seen, keys in zip(EDGES[1:], (same, similar), skip_keys(core), strict=True):
                ends = {seen[x] for x in keys if x in seen} - joined
                joined |= ends
                self.edges[kind] += [(e, node) for e in sorted(ends)]
                for x in keys:
                    seen.setdefault(x, node)

    def arrays(self):
        pairs = [np.array(self.edges[e], np.int64).reshape(-1, 2) for e in EDGES]
        return np.array(self.features, np.int64).reshape(len(self.spans), NAMED), np.array(self.labels, np.int64), pairs


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def disguised(kind: str, mention: str, rng: random.Random) -> str:
    """The mention as a pattern does not see it."""
    if kind == "email":
        local, _, domain = mention.partition("@")
        return rng.choice([f"{local}[at]{domain}", f"{local}(at){domain}", local, f"{local}[at]{domain.replace('.', '[dot]')}"])
    groups = re.findall("[0-9]+", mention)
    if kind in ("card", "phone") and rng.random() < 0.5:  # other groups
        d, groups = "".join(groups), []
        while d:
            k = rng.randint(3, 5)
            groups.append(d[:k])
            d = d[k:]
    out = rng.choice(["-", ".", " ", "", "/", ". "]).join(groups)
    if rng.random() < 0.2 and len(out) > 8:
        k = rng.randrange(1, len(out))
        out = out[:k] + rng.choice("0123456789") + out[k:]
    return out


def lesson(text: str, rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A training text with disguised repeats, disguised strangers and clean repeats behind it, and their labels."""
    found = patterns(text)
    entities = [(k, text[a:b]) for k in KINDS for a, b in found[k]]
    clean = [text[a:b] for a, b, *_ in mentions(text) if not any(x < b and y > a for k in KINDS for x, y in found[k])]
    extra: list[tuple[str, int]] = []
    for kind, mention in 2 * rng.sample(entities, min(len(entities), 3)):
        extra.append((disguised(kind, mention, rng), LABELS.index(kind)))
        stranger = "".join(rng.choice("0123456789") if c.isdigit() else rng.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in mention)
        extra.append((disguised(kind, stranger, rng), 0))
        if rng.random() < 0.5:
            extra.append((extra[-1][0], 0))
    if rng.random() < 0.3:  # a secret in a common form, so that they are learnt where the corpus has few
        value = "".join(rng.choices("0123456789abcdef" if rng.random() < 0.6 else string.ascii_letters + string.digits, k=rng.randint(12, 40))) + rng.choice(string.digits)
        key = rng.choice(SECRET_KEYS)
        extra.append((rng.choice([f"{key}={value}", f"{key}: {value}", f'{key} = "{value}"']), SECRET))
        extra.append(("AKIA" + "".join(rng.choices(string.ascii_uppercase + "234567", k=16)), SECRET))
        extra.append((value if rng.random() < 0.5 else "".join(rng.choices(string.ascii_uppercase, k=20)), 0))
    extra += [(x, -1) for x in rng.sample(clean, min(len(clean), 2))]
    rng.shuffle(extra)
    words = _WORD.findall(text)[:200] or ["-"]
    known = []
    for mention, label in extra:
        text += " ".join(["", *(re.sub("[0-9@]", "", rng.choice(words)) or "-" for _ in range(NEAR + 1)), ""])
        if label >= 0:
            known.append((len(text), len(text) + len(mention), label))
        text += mention
    return text, known


def train(graph: Graph, steps: int = 400, rate: float = 0.3, l2: float = 1e-4) -> tuple[np.ndarray, list[np.ndarray]] | None:
    """Node weights and a table for each kind of edge by pseudo-likelihood: each label given its neighbours'."""
    feats, y, edges = graph.arrays()
    if not len(y) or not y.any():
        return None
    n, labels = len(y), len(LABELS)
    start = [p * np.eye(labels) for p in PRIOR]
    w, tables = np.zeros((FEATURES, labels)), [x.copy() for x in start]
    seen = [np.full_like(x, 1e-8) for x in (w, *tables)]
    weight = (1 / np.sqrt(np.bincount(y, minlength=labels) + 1.0))[y]
    weight /= weight.sum()
    one = np.eye(labels)
    for _ in range(steps):
        z = w[feats].sum(1)
        for e, table in zip(edges, tables, strict=True):
            np.add.at(z, e[:, 1], table[y[e[:, 0]]])
            np.add.at(z, e[:, 0], table.T[y[e[:, 1]]])
        err = (one[y] - softmax(z)) * weight[:, None]
        grads = [np.stack([np.bincount(feats.ravel(), np.repeat(err[:, k], feats.shape[1]), FEATURES) for k in range(labels)], 1) - l2 * w / n]
        for e, table, prior in zip(edges, tables, start, strict=True):
            g = np.zeros_like(table)
            np.add.at(g, y[e[:, 0]], err[e[:, 1]])
            np.add.at(g.T, y[e[:, 1]], err[e[:, 0]])
            grads.append(g - l2 * (table - prior))
        for x, s, g in zip((w, *tables), seen, grads, strict=True):
            s += g * g
            x += rate * g / np.sqrt(s)
    return w, tables


def beliefs(model, graph: Graph, rounds: int = ROUNDS, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of every mention by loopy message passing over all edges, evidence held."""
    w, tables = model
    feats, _, edges = graph.arrays()
    theta = w[feats].sum(1)
    held = np.flatnonzero(graph.evidence)
    theta[held, np.array(graph.evidence, np.int64)[held]] += HELD
    pairs = np.concatenate(edges)
    if not len(pairs):
        return softmax(theta)
    psi = np.concatenate([np.broadcast_to(t, (len(e), *t.shape)) for e, t in zip(edges, tables, strict=True)])
    src, dst = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
    psi = np.concatenate([psi, psi.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    m = np.zeros((len(src), theta.shape[1]))
    of = np.array([span[0] for span in graph.spans])[src]  # the document of each edge
    live = np.arange(len(src))
    for _ in range(rounds):
        total = theta.copy()
        np.add.at(total, dst, m)
        z = (total[src[live]] - m[back[live]])[:, :, None] + psi[live]
        top = z.max(1, keepdims=True)
        new = (top + np.log(np.exp(z - top).sum(1, keepdims=True)))[:, 0]
        new -= new.max(1, keepdims=True)
        change = np.zeros(int(of.max()) + 1)
        np.maximum.at(change, of[live], np.abs(new - m[live]).max(1))
        m[live] = damping * m[live] + (1 - damping) * new
        live = live[change[of[live]] >= TOLERANCE]  # each document stops by itself, whatever stands beside it
        if not len(live):
            break
    total = theta.copy()
    np.add.at(total, dst, m)
    return softmax(total)


def spans_of(texts: list[str], model) -> tuple[list[dict], list[list[tuple[str, int, int]]]]:
    """Pattern spans of each text, and the spans that the field adds."""
    found = [patterns(t) for t in texts]
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if model is None:
        return found, added
    graph = Graph()
    for k, (t, f) in enumerate(zip(texts, found, strict=True)):
        graph.add(k, t, f)
    if not graph.spans:
        return found, added
    p = beliefs(model, graph)
    best = p.argmax(1)
    for node in np.flatnonzero((best > 0) & (p.max(1) >= SURE)).tolist():
        k, start, end = graph.spans[node]
        if not graph.evidence[node]:
            added[k].append((LABELS[best[node]], start, end))
    return found, added


def joined_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (LABELS.index(s[0]), s[1], s[2])))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS):
    """A model from a bounded sample of documents with candidates, or None if there is nothing to learn."""
    able = docs.where(F.col("text").rlike(_CANDIDATE.pattern) & F.col("doc_id").isNotNull()).select("doc_id")
    sample = able.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left_semi").where(F.col("text").isNotNull())  # train_rows bounds the broadcast
    reduced = texts.mapInArrow(near_candidates, "doc_id long, text string")
    rows = reduced.groupBy("doc_id").agg(F.min("text").alias("text")).toPandas().sort_values("doc_id")
    graph = Graph()
    for k, (i, t) in enumerate(zip(rows["doc_id"], rows["text"], strict=True)):
        text, known = lesson(t, random.Random(int(i)))
        graph.add(k, text, {kind: [s for s in spans if not any(a < s[1] and b > s[0] for a, b, _ in known)] for kind, spans in patterns(text).items()}, known)
    return train(graph)


def near_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts reduced to their candidate tokens and the words around them, which is all that training looks at."""
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            spans = [m.span() for m in _WORD.finditer(text)]
            keep = set()
            for k, (a, b) in enumerate(spans):
                if _CANDIDATE.search(text, a, b):
                    keep.update(range(k - NEAR - 1, k + NEAR + 2))
            out.append(" ".join(text[slice(*spans[k])] for k in sorted(keep) if 0 <= k < len(spans)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])


FOUND = ", n_email long, n_ip long, n_card long, n_phone long, n_secret long, base_sha256 string, spans string, redacted string"


def detect(model, redact: bool):
    """mapInArrow function: appends counts, digest, spans and, if asked for, the redacted text."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        B.keep_heap()
        for rows, data, off in B.blocks(batches):
            n = rows.num_rows
            busy = np.flatnonzero(B.sum_rows(may_be_mention(data), off) > 0)
            column = rows.column(rows.schema.get_field_index("text"))
            texts = column.take(pa.array(busy)).to_pylist()
            found, added = spans_of(texts, model)
            counts, digests, spans = np.zeros((5, n), np.int64), [nothing] * n, [""] * n
            clean: list[str | None] = [None] * n
            for k, text, f, more in zip(busy.tolist(), texts, found, added, strict=True):
                base = [(kind, a, b) for kind in KINDS for a, b in f[kind]]
                counts[:, k] = [*(len(f[kind]) for kind in KINDS), sum(kind == "secret" for kind, _, _ in more)]
                digests[k] = hashlib.sha256(joined_spans(base).encode()).hexdigest()
                spans[k] = joined_spans(base + more)
                if redact and (base or more):
                    clean[k] = replaced(text, base + more)
            extra = [*(pa.array(c) for c in counts), pa.array(digests), pa.array(spans), pa.array(clean, pa.string())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *extra], [*rows.schema.names, *(c.split()[0] for c in FOUND.split(", ")[1:])])

    return run


def may_be_mention(data: np.ndarray) -> np.ndarray:
    """Bytes that begin what makes a token a candidate."""
    out, capital = CANDIDATE_BYTES[data], CAPITALS[data]
    if len(data) >= 12:
        four = capital[:-3] & capital[1:-2] & capital[2:-1] & capital[3:]
        out[:-11] |= four[:-8] & four[4:-4] & four[8:]
    return out


def replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    out, end = [], 0
    for a, b, kind in sorted((a, -b, kind) for kind, a, b in spans):
        b = -b
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find_private(docs: DataFrame, train_rows: int = TRAIN_ROWS, redact: bool = False) -> DataFrame:
    """Columns of ``docs`` (less clashing ones), counts, digest, spans and, with ``redact``, the redacted text (null: unchanged)."""
    model = fit(docs, train_rows)
    left = docs.select(*[c for c in docs.columns if c not in {x.split()[0] for x in FOUND.split(", ")[1:]}])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields)
    return left.mapInArrow(detect(model, redact), kinds + FOUND)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_private(docs).drop("text", "redacted")


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document, its personal data replaced by ``[KIND]``, n_chars to match."""
    size = "n_chars" in docs.columns

    def redacted(d: DataFrame) -> DataFrame:
        found = find_private(d, redact=True)
        if size:
            own = f"__own_{docs.columns.index('n_chars')}"
            found = found.withColumn(own, F.when(F.col("redacted").isNull(), F.col(own)).otherwise(F.length("redacted")).cast(docs.schema["n_chars"].dataType))
        return found.withColumn("text", F.coalesce("redacted", "text"))

    return shielded(docs, redacted)
