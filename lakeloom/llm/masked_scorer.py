"""Masked pseudo-likelihood: how well a small two-sided window network predicts each word of a text."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import byte_batches, slices, small_batches, text_or_empty
from lakeloom.plans import durable

SIDE = 32  # classes, and members of each class, at least
VOCAB = SIDE * SIDE
WINDOW = 2
BLOCK = 2048  # places scored at a time
KNOWN = 131_072  # frequent words whose counts travel to the tasks; all others meet theirs in a join


@dataclass
class Net:
    """Embeddings (numbers + 1, E) shared by all places, hidden layer, and a softmax over classes, then over members of the class.

    There are as many classes as members of a class. The last embedding is that of the pad before and after a text.
    """

    embed: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    members: np.ndarray
    member_bias: np.ndarray

    def __post_init__(self):
        # the biases stand under the weights, so that one product adds them; the fields are views
        self.top = np.concatenate([self.classes, self.class_bias[None]])
        self.low = np.concatenate([self.members, self.member_bias[:, None]], 1)
        self.classes, self.class_bias, self.members, self.member_bias = self.top[:-1], self.top[-1], self.low[:, :-1], self.low[:, -1]

    def __reduce__(self):
        return Net, tuple(self.parts())

    NAMES = ("embed", "hidden", "hidden_bias", "classes", "class_bias", "members", "member_bias")

    @staticmethod
    def start(counts: np.ndarray, embed: int = 8, hidden: int = 16, seed: int = 5) -> Net:
        """Small random weights; the biases are the corpus's own word frequencies, so an untrained net is the unigram model."""
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        side = math.isqrt(len(counts))
        share = (counts + 0.5).reshape(side, side)
        return Net(draw(len(counts) + 1, embed, scale=0.3), draw(2 * WINDOW * embed, hidden, scale=0.2), np.zeros(hidden, np.float32),
                   np.zeros((hidden, side), np.float32), np.log(share.sum(1) / share.sum()).astype(np.float32),
                   np.zeros((side, hidden, side), np.float32), np.log(share / share.sum(1, keepdims=True)).astype(np.float32))

    @property
    def side(self) -> int:
        return len(self.class_bias)

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_flat(self, values: np.ndarray) -> Net:
        out, at = [], 0
        for p in self.parts():
            out.append(values[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Net(*out)

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(embeddings of the context, hidden layer with a last column of ones for the biases)"""
        x = self.embed.take(context.ravel(), axis=0).reshape(len(context), -1)
        h = np.ones((len(x), self.hidden.shape[1] + 1), np.float32)
        z = x @ self.hidden
        z += self.hidden_bias
        np.tanh(z, out=h[:, :-1])
        return x, h

    def log_prob(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log P(target | the words on both sides), without looking at the target."""
        order = self._by_class(target)
        context, target = context[order], target[order]
        got = np.empty(len(target), np.float32)
        for i in range(0, len(target), BLOCK):  # few rows at a time, so that their logits stay in the processor's cache
            cls, member = np.divmod(target[i:i + BLOCK], self.side)
            h = self.forward(context[i:i + BLOCK])[1]
            got[i:i + BLOCK] = _log_softmax_at(self._within(h, self._runs(cls)), member)
            got[i:i + BLOCK] += _log_softmax_at(h @ self.top, cls)
        out = np.empty_like(got)
        out[order] = got
        return out

    def _by_class(self, target: np.ndarray) -> np.ndarray:
        """The order of the rows by class; numbers of 16 bits are sorted by their digits."""
        cls = target // self.side
        return np.argsort(cls.astype(np.int16) if self.side < 2**15 else cls, kind="stable")

    @staticmethod
    def _runs(cls: np.ndarray) -> list[tuple[int, int, int]]:
        """(class, first, end) of each class among sorted rows."""
        first = np.flatnonzero(np.diff(cls, prepend=-1))
        return list(zip(cls[first].tolist(), first.tolist(), [*first[1:].tolist(), len(cls)]))

    def _within(self, h: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
        """Each row's logits of the members of its class; the rows are sorted by class."""
        out = np.empty((len(h), self.side), np.float32)
        for c, a, b in runs:
            np.dot(h[a:b], self.low[c], out=out[a:b])
        return out

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of gradient descent on the mean of -log P.

        What only some rows of the batch reach (the members of a class, the embedding of a word) moves by their sum over the
        geometric mean of their number and the batch's, else rare words would hardly learn in large batches. The rows are taken by
        class, and the totals of the softmaxes divide the short rows of hidden numbers, not the long ones of logits.
        """
        n, order = len(target), self._by_class(target)
        context, target = context[order], target[order]
        cls, member = np.divmod(target, self.side)
        runs, rows, (x, h) = self._runs(cls), np.arange(n), self.forward(context)
        top = h @ self.top
        total = _powers(top)
        top[rows, cls] -= total
        back = top @ self.classes.T
        back /= total[:, None]
        scaled = h * (rate / n / total).astype(np.float32)[:, None]
        d_top = sum(scaled[i:i + 256].T @ top[i:i + 256] for i in range(0, n, 256))  # so many rows at once take the least time
        low = self._within(h, runs)
        total = _powers(low)
        low[rows, member] -= total
        share = 1 / np.sqrt(n * np.bincount(cls, minlength=self.side)[cls])
        scaled = h * (rate * share / total).astype(np.float32)[:, None]
        low_back, moved = np.empty_like(back), np.empty((len(runs), *self.low.shape[1:]), np.float32)
        for (c, a, b), out in zip(runs, moved):
            part = low[a:b]
            np.dot(part, self.members[c].T, out=low_back[a:b])
            np.dot(scaled[a:b].T, part, out=out)
        self.low[[c for c, _, _ in runs]] -= moved
        self.top -= d_top
        low_back /= total[:, None]
        back += low_back
        back *= 1 - h[:, :-1] ** 2
        d_x = np.ascontiguousarray((back @ self.hidden.T).reshape(-1, self.embed.shape[1]).T)
        self.hidden -= rate / n * (x.T @ back)
        self.hidden_bias -= rate / n * (np.ones(n, np.float32) @ back)
        flat = context.ravel()
        times = np.bincount(flat, minlength=len(self.embed))
        seen = np.flatnonzero(times)
        place = np.empty(len(self.embed), np.int64)
        place[seen] = np.arange(len(seen))
        at = place[flat]
        d_embed = np.zeros((len(d_x), len(seen)), np.float32)
        for out, d in zip(d_embed, d_x):
            np.add.at(out, at, d)
        d_embed *= (rate / np.sqrt(n * times[seen])).astype(np.float32)
        self.embed[seen] = self.embed.take(seen, axis=0) - d_embed.T


def _bounded(z: np.ndarray) -> np.ndarray:
    """Logits, their rows shifted in place where single precision would not hold their powers."""
    if z.size and max(z.max(), -z.min()) > 60:
        z -= z.max(1, keepdims=True)
    return z


def _powers(z: np.ndarray) -> np.ndarray:
    """The rows' totals of the powers of logits, which replace these."""
    np.exp(_bounded(z), out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    got = _bounded(z)[np.arange(len(z)), at]
    return got - np.log(_powers(z))


def side_for(n_words: int) -> int:
    """Classes for a corpus of ``n_words``: the numbers, their square, grow with the square root of the corpus."""
    return max(SIDE, math.ceil(n_words**0.25))


@dataclass
class Vocabulary:
    """Words as numbers, sized from the counts of a corpus.

    The most frequent words have numbers of their own; the first quarter of the numbers is shared by all others, by a hash that is alike
    on every machine. ``words`` are the most frequent ones (more than have a number) with their counts, ``counts`` are those of the numbers.
    """

    words: list[str]
    n: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        self.shared = len(self.counts) // 4
        own = len(self.counts) - self.shared
        self.row = {w: i for i, w in enumerate(self.words)}
        rest = np.array([self.place(w) for w in self.words[own:]], np.int32)
        self.code = np.concatenate([self.shared + np.arange(min(own, len(self.words)), dtype=np.int32), rest])
        # log P(word | number): n of a shared number's total + 1; that 1 is the mass of words that the corpus lacks
        self.inside = np.zeros(len(self.words))
        self.inside[own:] = np.log(self.n[own:]) + self.unseen(rest)

    def place(self, word: str) -> int:
        return zlib.crc32(word.encode()) % self.shared

    def unseen(self, code: np.ndarray) -> np.ndarray:
        return -np.log(self.counts[code] + 1)

    def codes(self, texts: list[str]) -> Places:
        split = [text.split() for text in texts]
        n = np.array([len(w) for w in split], np.int64)
        flat = list(chain.from_iterable(split))
        row = np.fromiter(map(self.row.get, flat, repeat(-1)), np.int32, len(flat))
        other = np.flatnonzero(row < 0)
        code = np.append(self.code, np.int32(0))[row]
        code[other] = [self.place(flat[i]) for i in other]
        inside = np.append(self.inside, 0.0)[row]
        inside[other] = self.unseen(code[other])
        return Places.of(code, n, len(self.counts), inside, np.repeat(np.arange(len(texts)), n)[other], [flat[i] for i in other])


@dataclass
class Places:
    """Texts as numbers with pads before, between and after them: where the words stand, words per text, log P(word | number) of each
    word without what the whole count table adds, and the words that are to meet that table, with their texts."""

    laid: np.ndarray
    at: np.ndarray
    n: np.ndarray
    inside: np.ndarray | None = None
    text: np.ndarray | None = None
    other: list[str] | None = None

    @staticmethod
    def of(code: np.ndarray, n: np.ndarray, pad: int, *words) -> Places:
        at = np.arange(len(code)) + WINDOW * (1 + np.repeat(np.arange(len(n)), n))
        laid = np.full(len(code) + WINDOW * (1 + len(n)), pad, np.int32)
        laid[at] = code
        return Places(laid, at, n, *words)

    def rows(self, some: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """(contexts, targets)"""
        at = self.at[some]
        return np.stack([self.laid[at + d] for d in (*range(-WINDOW, 0), *range(1, WINDOW + 1))], 1), self.laid[at]


def vocabulary(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of all documents and the whole count table (word, n), from counts over the whole table.

    ``docs``: (text). Counts are summed per task, then by word over the cluster; the driver gets the frequent words and one sum per shared number.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in small_batches(batches):
            for text in batch.column("text").to_pylist():
                held.update(text.split())
            if len(held) > 500_000:
                yield _counted(held)
                held = Counter()
        yield _counted(held)

    words = durable.cut(docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    side = side_for(words.agg(F.sum("n")).first()[0] or 0)
    shared, own = side * side // 4, side * side - side * side // 4
    frequent = words.orderBy(F.desc("n"), "word").limit(max(KNOWN, own)).toPandas()
    places = words.groupBy((F.crc32("word") % shared).alias("place")).agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(side * side)
    counts[places["place"].astype(int)] = places["n"]
    most = frequent["word"].tolist(), frequent["n"].to_numpy(np.float64)
    np.subtract.at(counts, [zlib.crc32(w.encode()) % shared for w in most[0][:own]], most[1][:own])
    counts[shared:shared + len(most[0][:own])] = most[1][:own]
    return Vocabulary(*most, counts), words


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """The mean of one part of the weights over the tasks, which give it times their number of words."""
    total = np.sum([np.frombuffer(w) for w in rows["weights"]], axis=0)
    return pd.DataFrame({"part": rows["part"].iloc[:1], "weights": [(total / rows["used"].sum()).tobytes()]})


def _coded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """row, doc_id, part, codes, inside, other of ``docs`` (doc_id, text), written once for all later passes.

    ``row`` is unique, a ``part`` are texts of about a million characters that follow each other, ``codes`` the numbers of the words (4 bytes each),
    ``inside`` the sum of log P(word | number) without what the whole count table adds, ``other`` the words that are to meet that table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row, part = shared.value, TaskContext.get().partitionId() << 33, TaskContext.get().partitionId() << 33
        for batch in small_batches(batches):
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for a, b in slices(texts, 1_000_000):
                places, rows = known.codes(texts[a:b]), np.arange(row, row + b - a)
                code, ends = places.laid[places.at].astype("<i4", copy=False), np.cumsum(places.n)
                sums = np.concatenate([[0.0], np.cumsum(places.inside)])
                others = np.concatenate([[0], np.cumsum(np.bincount(places.text, minlength=b - a))])
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows), ids.slice(a, b - a), pa.array(np.full(b - a, part)),
                    pa.array([code[end - n:end].tobytes() for n, end in zip(places.n, ends)], pa.binary()), pa.array(sums[ends] - sums[ends - places.n]),
                    pa.ListArray.from_arrays(pa.array(others, pa.int32()), pa.array(places.other, pa.string()))],
                    ["row", "doc_id", "part", "codes", "inside", "other"])
                row, part = row + b - a, part + 1

    return durable.cut(docs.mapInArrow(run, "row long, doc_id long, part long, codes binary, inside double, other array<string>"), "coded")


def _parts(batch: pa.RecordBatch, pad: int) -> Iterator[tuple[int, int, Places]]:
    """(first row, end, places) of each part in a batch of ``codes`` and ``part``."""
    part, column = batch.column("part").to_numpy(), batch.column("codes")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(part) + 1] // 4
    code = np.frombuffer(column.buffers()[2] or b"", "<i4")
    first = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)]):
        yield a, b, Places.of(code[ends[a]:ends[b]], np.diff(ends[a:b + 1]).astype(np.int64), pad)


def fit(docs: DataFrame, **options) -> tuple[Vocabulary, DataFrame, Net]:
    """The vocabulary, the count table and a net that all documents (doc_id, text) have trained."""
    docs = _texts(docs)
    vocab, counted = vocabulary(docs)
    return vocab, counted, _trained(_coded(docs, vocab), vocab, **options)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))


def _trained(coded: DataFrame, vocab: Vocabulary, rounds: int = 1, batch: int = 2048, rate: float = 1.0) -> Net:
    """A net that all ``coded`` documents have trained.

    Each task takes the net of the round, goes over its own documents in steps of gradient descent, and gives its weights; the next net is their
    mean, weighted by the words each task learned from and summed by Spark. Every place of every text is learned from, once a round;
    without a round the net is the unigram model.
    """
    net, pad = Net.start(vocab.counts), len(vocab.counts)
    for _ in range(rounds):
        shared = coded.sparkSession.sparkContext.broadcast(net)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, used = shared.value, 0
            own = start.with_flat(start.flat())
            for some in byte_batches(batches, "codes"):
                for _, _, places in _parts(some, pad):
                    order = np.random.default_rng(len(places.at)).permutation(len(places.at))
                    for i in range(0, len(order), batch):
                        own.step(*places.rows(order[i:i + batch]), rate)
                    used += len(order)
            if used:
                values = own.flat().astype(np.float64) * used
                parts = [values[k:k + 1024].tobytes() for k in range(0, len(values), 1024)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(len(parts)), pa.int32()), pa.array(parts, pa.binary()), pa.array(np.full(len(parts), float(used)))],
                    ["part", "weights", "used"])

        means = coded.select("part", "codes").mapInArrow(learn, "part int, weights binary, used double").groupBy("part").applyInPandas(
            _mean, "part int, weights binary").toPandas()
        if len(means):
            net = net.with_flat(np.concatenate([np.frombuffer(w) for w in means.sort_values("part")["weights"]]))
    return net


def pseudo_likelihood(docs: DataFrame, train: DataFrame | None = None, **options) -> DataFrame:
    """doc_id, n_words, log_likelihood (sum over all words of log P(word | two words on either side)) and per_word (its mean) of every whole text.

    Words are what white space separates. The net predicts the number of a word, learned from all documents (those of ``train``, if given);
    frequent words have one of their own. For the others log P(word | number) is added, from the counts of all words, which meet the texts in a
    join. A word that the learned documents lack has the mass 1 / (total of its number + 1). Null and empty texts have no word, a sum of
    0 and a null mean. Every row gives one row, whether doc_id is null or repeated; an empty table gives an empty result. Other columns are not read.
    """
    vocab, counted = vocabulary(learned := _texts(docs if train is None else train))
    coded = _coded(learned, vocab)
    net, pad = _trained(coded, vocab, **options), len(vocab.counts)
    if train is not None:
        coded = _coded(_texts(docs), vocab)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in byte_batches(batches, "codes"):
            for a, b, places in _parts(batch, pad):
                each = np.concatenate([[0.0], *(model.log_prob(*places.rows(slice(i, i + 65_536))) for i in range(0, len(places.at), 65_536))])
                sums, ends = np.cumsum(each), np.cumsum(places.n)
                some = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([
                    some.column("row"), some.column("doc_id"), pa.array(places.n), pa.array(
                        some.column("inside").to_numpy() + sums[ends] - sums[ends - places.n])], FIELDS)

    own = coded.select("row", "doc_id", "part", "codes", "inside").mapInArrow(run, "row long, doc_id long, n_words long, value double")
    # the row of a text carries a word that no text has, so that these rows spread too
    scored = own.withColumn("word", F.concat(F.lit(" "), "row")).unionByName(
        coded.select("row", F.explode("other").alias("word")), allowMissingColumns=True)
    joined = scored.join(counted.filter("n > 1"), "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        (F.sum("value") + F.coalesce(F.sum(F.log("n")), F.lit(0.0))).alias("log_likelihood"))
    return joined.select("doc_id", "n_words", "log_likelihood", F.try_divide("log_likelihood", F.nullif("n_words", F.lit(0))).alias("per_word"))


FIELDS = ["row", "doc_id", "n_words", "value"]
