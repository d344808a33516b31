"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds what they miss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import slices, small_batches, text_or_empty
from lakeloom.plans import skew

# The fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so shorter ones need not be looked at
KINDS = ("assign", "access", "hex")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

O, B, I = range(3)
#: Values of each feature: length, shape, changes of character class, hex run by length, mark before, mark after, first letters of this word and
#: of the last one, shape of the last and of the next word, size of the file, share of digits in the file.
SIZES = (12, 96, 8, 24, 64, 64, 256, 256, 96, 96, 16, 8)
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)])
REACH = 10


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, by start and then kind; leftmost and not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, z) for a, k, z in sorted(out)]


def value_spans(text: str) -> list[tuple[int, int]]:
    """Where the secret itself lies in each match of the fixed patterns; what the field learns to tag."""
    return [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] + [
        m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 20] + [m.span() for m in HEX.finditer(text)]


def _kinds() -> np.ndarray:
    """Of each ASCII code: 0 mark or white space, 1 digit, 2 capital, 3 small letter, 4 one of + / _ -; 5 stands for all beyond."""
    out = np.zeros(129, np.uint8)
    for kind, first, last in ((1, "0", "9"), (2, "A", "Z"), (3, "a", "z")):
        out[ord(first):ord(last) + 1] = kind
    out[[ord(c) for c in "+/_-"]] = 4
    out[128] = 5
    return out


KIND_OF = _kinds()


@dataclass
class Words:
    """Words of some texts laid end to end: places, the text they are in, and the row of each feature in the weight table."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    base: np.ndarray  # where each text begins
    rows: np.ndarray


def words_of(texts: list[str]) -> Words:
    """Words are runs of letters, digits and + / _ -; features look at the word, its neighbours and its whole text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer((" " + " ".join(texts) + "      ").encode("utf-32-le", "surrogatepass"), np.uint32)
    base = 1 + np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    ascii_ = np.minimum(codes, 128).astype(np.uint8)
    kind = KIND_OF[ascii_]
    kind[codes == 0xA0] = 0
    inside = (kind > 0).view(np.int8)
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    doc = np.searchsorted(base, start, "right") - 1
    if not len(start):
        return Words(start, end, doc, base, np.empty((0, len(SIZES)), np.int64))
    add = lambda mask: np.add.reduceat(mask, start, dtype=np.int64)  # noqa: E731  marks between words add nothing
    n = end - start
    digits, capitals, smalls, signs = (add(kind == k) for k in (1, 2, 3, 4))
    beyond = add(kind == 5)
    change = np.zeros(len(kind), bool)
    change[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    changes = add(change)
    hexes = digits + add((codes >= 97) & (codes <= 102))
    length = np.minimum(np.log2(n + 1) * 2, 11).astype(np.int64)
    part = lambda x, k: np.minimum(x * k // n, k - 1)
    shape = (part(digits, 4) * 4 + part(capitals, 4)) * 3 + np.where(smalls > 0, np.where(smalls == n, 2, 1), 0) + 48 * ((signs > 0) | (beyond > 0))
    letter = [np.where(n > i, np.where((kind[start + i] == 2), codes[start + i] + 32, codes[start + i]), 0).astype(np.int64) for i in range(4)]
    first = ((letter[0] * 31 + letter[1]) * 31 + letter[2]) * 31 + letter[3]
    first = first * 2654435761 % 2**32 >> 24
    before = lambda x, none: np.concatenate([[none], np.where(doc[1:] == doc[:-1], x[:-1], none)])
    after = lambda x, none: np.concatenate([np.where(doc[1:] == doc[:-1], x[1:], none), [none]])
    mark = lambda at: np.where(ascii_[at] < 64, ascii_[at], 63 - ascii_[at] % 16)
    size = np.minimum(np.log2(lengths + 1), 15).astype(np.int64)
    of_digits = np.add.reduceat(np.append(kind == 1, False), np.minimum(base, len(kind)), dtype=np.int64)
    share = np.minimum(np.log2(of_digits * 256 / np.maximum(lengths, 1) + 1), 7).astype(np.int64)
    rows = np.stack([length, shape, np.minimum(changes, 7), np.where(hexes == n, 12 + length, length), mark(start - 1), mark(end), first,
                     before(first, 255), before(shape, 95), after(shape, 95), size[doc], share[doc]], 1).astype(np.int64) + OFFSETS[:-1]
    return Words(start, end, doc, base, rows)


@dataclass
class Field:
    """Weights of each feature value for the three tags, and of each tag after each tag; after the text's edge as after O."""

    weight: np.ndarray
    follow: np.ndarray

    @staticmethod
    def zero() -> Field:
        follow = np.zeros((3, 3))
        follow[O, I] = -np.inf
        return Field(np.zeros((OFFSETS[-1], 3)), follow)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), 3))
        for j in range(rows.shape[1]):
            out += self.weight[rows[:, j]]
        return out

    def tags(self, words: Words) -> np.ndarray:
        """The best tags of each text (Viterbi).

        Most words are certainly outside: tagging such a word O instead of B or I gains more than the at most three pairs of tags that
        change with it, and turning a following I into B, can cost. Texts fall apart at those words; the runs between them are decoded one by one.
        """
        tags = np.zeros(len(words.rows), np.int8)
        if not len(tags):
            return tags
        e = self.scores(words.rows)
        allowed = self.follow[np.isfinite(self.follow)]
        cost = 3 * (allowed.max() - allowed.min()) + 1e-9
        turn = np.append(np.maximum(e[1:, I] - e[1:, B], 0) * (words.doc[1:] == words.doc[:-1]), 0.0)
        open_ = np.flatnonzero(e[:, O] - np.maximum(e[:, B], e[:, I]) <= cost + turn)
        if not len(open_):
            return tags
        cuts = np.flatnonzero((np.diff(open_) > 1) | (np.diff(words.doc[open_]) > 0)) + 1
        for run in np.split(open_, cuts):
            a, z = run[0], run[-1] + 1
            closed = z < len(tags) and words.doc[z] == words.doc[a]  # an O follows
            tags[a:z] = self.decode(e[a:z], closed)
        return tags

    def decode(self, e: np.ndarray, closed: bool) -> list[int]:
        f = self.follow.tolist()
        best, back = [f[O][t] + e[0][t] for t in range(3)], []
        for row in e[1:].tolist():
            came = [max(range(3), key=lambda s: (best[s] + f[s][t], -s)) for t in range(3)]
            best = [best[came[t]] + f[came[t]][t] + row[t] for t in range(3)]
            back.append(came)
        if closed:
            best = [best[t] + f[t][O] for t in range(3)]
        out = [max(range(3), key=lambda t: (best[t], -t))]
        for came in reversed(back):
            out.append(came[out[-1]])
        return out[::-1]


def train(rows: np.ndarray, tags: np.ndarray, epochs: int = 40, rate: float = 0.2, decay: float = 2e-5) -> Field:
    """A field from windows of equal length: ``rows`` (windows, words, features), ``tags`` (windows, words).

    Gradient steps (Adam) on the mean log-likelihood, whose expectations come from the forward and backward sums over all windows at once.
    """
    field = Field.zero()
    n, t_max, n_feat = rows.shape
    if not n:
        field.weight[:, O] = 1.0
        return field
    flat, lanes = rows.reshape(-1, n_feat), np.arange(n)
    m = [np.zeros_like(field.weight), np.zeros((3, 3))]
    v = [np.zeros_like(field.weight), np.zeros((3, 3))]
    for step in range(1, epochs + 1):
        e = field.scores(flat).reshape(n, t_max, 3)
        f = field.follow
        with np.errstate(divide="ignore"):
            fore = np.empty_like(e)
            fore[:, 0] = f[O] + e[:, 0]
            for t in range(1, t_max):
                fore[:, t] = np.logaddexp.reduce(fore[:, t - 1, :, None] + f, axis=1) + e[:, t]
            aft = np.zeros_like(e)
            for t in range(t_max - 2, -1, -1):
                aft[:, t] = np.logaddexp.reduce(f + (e[:, t + 1] + aft[:, t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(fore[:, -1], axis=1)
        p = np.exp(fore + aft - total[:, None, None])
        want = -p
        np.add.at(want, (lanes[:, None], np.arange(t_max), tags), 1.0)
        g_follow = np.zeros((3, 3))
        np.add.at(g_follow, (np.full(n, O), tags[:, 0]), 1)
        g_follow[O] -= p[:, 0].sum(0)
        for t in range(1, t_max):
            np.add.at(g_follow, (tags[:, t - 1], tags[:, t]), 1)
            g_follow -= np.exp(fore[:, t - 1, :, None] + f + (e[:, t] + aft[:, t])[:, None, :] - total[:, None, None]).sum(0)
        g_weight = np.stack([sum(np.bincount(flat[:, j], want[..., k].ravel(), OFFSETS[-1]) for j in range(n_feat)) for k in range(3)], 1)
        grads = (g_weight / n - decay * field.weight, np.where(np.isfinite(f), g_follow, 0) / n)
        for k, (param, g) in enumerate(zip((field.weight, field.follow), grads)):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            param += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
    return field


def fit(docs: DataFrame, most_documents: int = 20_000, most_windows: int = 3_000) -> Field:
    """A field trained on windows around the fixed patterns' matches, and around one other word, of about ``most_documents`` texts.

    Distinct texts are picked by a hash, equal windows count once, and windows with and without a secret get half of ``most_windows`` each,
    or what the other half leaves; both bounds are parameters and do not grow with the table.
    """
    docs = docs.select(text_or_empty().alias("text"))
    n = docs.select(F.xxhash64("text")).distinct().count()
    picked = F.pmod(F.xxhash64(F.lit("fit"), "text"), F.lit(2**31)) < int(min(1.0, most_documents / max(n, 1)) * 2**31)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            rows, tags, secret, key = [], [], [], []
            for text in texts:
                words = words_of([text])
                if not len(words.rows):
                    continue
                tag = np.zeros(len(words.rows), np.int8)
                for a, z in value_spans(text):
                    hit = np.flatnonzero((words.end - 1 > a) & (words.start - 1 < z))
                    tag[hit[1:]] = I
                    tag[hit[:1]] = B
                heads = np.flatnonzero(tag == B)
                other = int(np.frombuffer(text.encode()[-8:].rjust(8, b"\0"), "<u8")[0] % len(tag))
                for at in {*heads.tolist(), other}:
                    pick = np.clip(np.arange(at - REACH, at + REACH + 1), 0, len(tag) - 1)
                    legal = tag[pick].copy()
                    legal[0] = min(legal[0], B)
                    legal[1:][(legal[1:] == I) & (legal[:-1] == O)] = B
                    rows.append(words.rows[pick].astype(np.int32).tobytes())
                    tags.append(legal.tobytes())
                    secret.append(bool(legal.any()))
                    key.append(hash_place(rows[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(tags, pa.binary()), pa.array(secret, pa.bool_()),
                                              pa.array(key, pa.int64())], ["rows", "tags", "secret", "key"])

    found = docs.filter(picked).dropDuplicates(["text"]).mapInArrow(windows, "rows binary, tags binary, secret boolean, key long")
    order = [F.asc(c) for c in ("key", "rows", "tags")]
    kept = skew.top_per_key(found.dropDuplicates(["rows", "tags"]), ["secret"], order, most_windows, "place").collect()
    clean, secret = (sorted((r for r in kept if r["secret"] == s), key=lambda r: r["place"]) for s in (False, True))
    got = secret[:max(most_windows // 2, most_windows - len(clean))]
    got += clean[:most_windows - len(got)]
    width = 2 * REACH + 1
    rows = np.frombuffer(b"".join(r["rows"] for r in got), np.int32).reshape(-1, width, len(SIZES)).astype(np.int64)
    return train(rows, np.frombuffer(b"".join(r["tags"] for r in got), np.int8).reshape(-1, width).astype(np.int64))


def hash_place(data: bytes) -> int:
    """A number that orders windows in no meaningful way, alike on every machine."""
    return int(np.bitwise_xor.reduce(np.frombuffer(data, "<u4").astype(np.uint64) * np.arange(1, len(data) // 4 + 1, dtype=np.uint64)
                                     * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(2))


def all_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """(fixed spans, all spans) of each text; a tagged span that meets a fixed one is left to that."""
    out = []
    for a, z in slices(texts, 500_000):
        words = words_of(texts[a:z])
        tags = field.tags(words)
        heads = np.flatnonzero(tags == B)
        added: dict[int, list] = {}
        for h in heads.tolist():
            last = h
            while last + 1 < len(tags) and tags[last + 1] == I and words.doc[last + 1] == words.doc[h]:
                last += 1
            d = int(words.doc[h])
            added.setdefault(d, []).append(("tagged", int(words.start[h] - words.base[d]), int(words.end[last] - words.base[d])))
        for d, text in enumerate(texts[a:z]):
            fixed = base_spans(text)
            more = [s for s in added.get(d, ()) if not any(s[1] < f[2] and f[1] < s[2] for f in fixed)]
            order = {k: i for i, k in enumerate((*KINDS, "tagged"))}
            out.append((fixed, sorted(fixed + more, key=lambda s: (s[1], order[s[0]], s[2])) if more else fixed))
    return out


def _line(spans: list) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def secrets(docs: DataFrame, **bounds) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_spans and spans (both as kind:start:end, comma-joined) of every whole text.

    Places count code points, the end is exclusive. ``base_spans`` are the fixed patterns' matches, ``spans`` also has those the field tags
    (kind ``tagged``) away from them. Null and empty texts have none. Every row gives one row, whether doc_id is null or
    repeated; an empty table gives an empty result. Other columns are not read. See ``fit`` for ``bounds``.
    """
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = all_spans(batch.column("text").to_pylist(), field.value)
            count = [pa.array([sum(s[0] == k for s in fixed) for fixed, _ in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *count, pa.array([_line(f) for f, _ in found], pa.string()), pa.array([_line(s) for _, s in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")


def without_secrets(docs: DataFrame, mark: str = "[secret]", **bounds) -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced by ``mark`` (spans that meet become one mark) and n_chars set anew.

    All rows and columns stay; null texts stay null.
    """
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, **bounds))
    at = docs.schema.names.index("text")

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            out = []
            for text, (_, spans) in zip(texts, all_spans([t or "" for t in texts], field.value)):
                merged: list[list[int]] = []
                for _, a, z in spans:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], z)
                    else:
                        merged.append([a, z])
                for a, z in reversed(merged):
                    text = text[:a] + mark + text[z:]
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, batch.schema.types[at]) if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    rows = docs.mapInArrow(redact, docs.schema)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows
