"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import small_batches, text_or_empty
from lakeloom.plans import durable

BITS = 18
BLOCK = 4_000_000


class Grams:
    """Which hashed byte 4-grams and 6-grams of the lower-cased text occur, however often; one flag per bucket."""

    def __init__(self):
        self.seen = np.zeros(2**BITS, bool)

    def of(self, text: str) -> np.ndarray:
        data = (" " + text.lower() + " ").encode()
        for start in range(0, len(data), BLOCK):
            b = np.frombuffer(data[start:start + BLOCK + 5], np.uint8).astype(np.uint64)
            for n, odd in ((4, 0x9E3779B97F4A7C15), (6, 0xC2B2AE3D27D4EB4F)):
                if len(b) >= n:
                    code = sum(b[i:len(b) - n + 1 + i] << np.uint64(8 * i) for i in range(n))
                    self.seen[code * np.uint64(odd) >> np.uint64(64 - BITS)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found.astype(np.int32)


@dataclass
class Model:
    """A linear classifier over the buckets that are kept; ``weight`` is 0 elsewhere."""

    kept: np.ndarray
    weight: np.ndarray
    bias: float

    def margin(self, grams: np.ndarray) -> float:
        held = grams[self.kept[grams]]
        return float(self.weight[held].sum(dtype=np.float64)) / np.sqrt(len(held) + 1.0) + self.bias

    def score(self, grams: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(grams), -30, 30))))


def telling(n_pos: np.ndarray, n_unl: np.ndarray, positive: int, unlabelled: int) -> np.ndarray:
    """The value of each bucket, 0 for those that do not take part.

    From the numbers of positive and unlabelled texts that have it: the log of the ratio of their shares, where it is clearly above 0 and enough
    positive texts have it.
    """
    ratio = np.log((n_pos + 1) / (positive + 2)) - np.log((n_unl + 1) / (unlabelled + 2))
    return np.where((n_pos >= min(5, max(2, positive // 10))) & (ratio > 0.7), ratio, 0.0)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], ratio: np.ndarray, prior: float, epochs: int = 15, batch: int = 500,
          rate: float = 0.02, seed: int = 3) -> Model:
    """A linear classifier from examples of one class and unlabelled ones, given as their buckets of nonzero ``ratio``.

    Minimises prior * mean_P l(f) + max(0, mean_U l(-f) - prior * mean_P l(-f)) with the logistic loss l(z) = log(1 + exp(-z)). The bracket
    estimates the risk on the other class, which cannot be negative; where a batch makes it so, the step goes the other way, which keeps
    the classifier from memorising the positive examples. Adam steps over shuffled batches.

    A bucket's value is its ``ratio``, and a text's values are divided by the root of their number. Last, the border is put into the widest gap
    between the margins of the unlabelled texts that leaves about the share ``prior`` of them above. Without positive or
    unlabelled texts all score ``prior``.
    """
    size, kept = 2**BITS, ratio != 0
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.zeros(size, bool), np.zeros(size, np.float32), start)
    rng, w, b = np.random.default_rng(seed), np.zeros(size), start
    m, v, t = np.zeros(size + 1), np.zeros(size + 1), 0
    steps = max(1, -(-len(unlabelled) // batch))
    for _ in range(epochs):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for p_part, u_part in zip(np.array_split(p_order, steps), np.array_split(u_order, steps)):
            rows = [*(positive[i] for i in p_part), *(unlabelled[i] for i in u_part)]
            lengths = np.fromiter(map(len, rows), np.int64, len(rows))
            index, norm = np.concatenate(rows), 1 / np.sqrt(lengths + 1.0)
            ends = np.cumsum(lengths)
            total = np.concatenate([[0.0], np.cumsum((w * ratio)[index])])
            f = (total[ends] - total[ends - lengths]) * norm + b
            s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
            k = len(p_part)
            n_p, n_u = max(1, k), max(1, len(u_part))
            loss = np.logaddexp(0, f)  # l(-f)
            other = loss[k:].sum() / n_u - prior * loss[:k].sum() / n_p
            on_u, on_p = s[k:] / n_u, prior * s[:k] / n_p  # slopes of the two parts of the bracket
            if other >= 0:  # l(f) has the slope s - 1
                slope = np.concatenate([prior * (s[:k] - 1) / n_p - on_p, on_u])
            else:
                slope = np.concatenate([on_p, -on_u])
            g = np.append(np.bincount(index, np.repeat(slope * norm, lengths), size) * ratio + 1e-6 * w, slope.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    model = Model(kept, (w * ratio).astype(np.float32), b)
    margins = np.sort([model.margin(x) for x in unlabelled])
    low, high = (int(np.clip(len(margins) * (1 - share * prior), 1, len(margins) - 1)) for share in (1.4, 0.6))
    if len(margins) > 1:
        at = low + int(np.argmax(np.diff(margins[low - 1:high + 1])))
        model.bias -= (margins[at - 1] + margins[at]) / 2
    return model


def held_out() -> Column:
    """Rows whose labels are never learned from; a null doc_id has no label."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _picked(most: int, n: int, *cols) -> Column:
    """About ``most`` of ``n`` rows, chosen by a hash."""
    return F.pmod(F.xxhash64(F.lit("fit"), *cols), F.lit(2**31)) < int(min(1.0, most / max(n, 1)) * 2**31)


def fit(docs: DataFrame, labels: DataFrame, most_positive: int = 3000, most_unlabelled: int = 6000) -> Model:
    """A model from about ``most_positive`` confirmed toxic texts and ``most_unlabelled`` texts without regard to labels.

    Both are picked by a hash out of all rows that are not held out, and the bounds do not grow with the table. The class prior is the toxic
    share of all labelled rows that are not held out (0.1 if there are none). Of repeated labels the largest counts, null labels do not.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text")).filter(~held_out())
    labels = labels.select(labels["doc_id"].cast("long").alias("doc_id"), "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = labels.filter(~held_out()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.count_if("toxic")).first()
    prior = float(np.clip(n_toxic / n_known if n_known else 0.1, 0.001, 0.9))
    n_docs = docs.count()
    toxic = known.filter(F.col("toxic") & _picked(most_positive, n_toxic, "doc_id")).select("doc_id").limit(2 * most_positive)
    chosen = docs.join(F.broadcast(toxic.withColumn("positive", F.lit(True))), "doc_id", "left")
    chosen = chosen.withColumn("unlabelled", _picked(most_unlabelled, n_docs, "doc_id", "text")).filter("positive OR unlabelled")

    chosen = durable.cut(chosen.select("positive", "unlabelled", "text").limit(2 * (most_positive + most_unlabelled)), "examples")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n_pos, n_unl = Grams(), np.zeros(2**BITS, np.int64), np.zeros(2**BITS, np.int64)
        for batch in small_batches(batches):
            for text, pos, unl in zip(*(batch.column(c).to_pylist() for c in ("text", "positive", "unlabelled"))):
                held = grams.of(text)
                n_pos[held] += bool(pos)
                n_unl[held] += bool(unl)
        used = np.flatnonzero(n_pos + n_unl)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n_pos[used]), pa.array(n_unl[used])], ["bucket", "n_pos", "n_unl"])

    sums = chosen.mapInArrow(count, "bucket long, n_pos long, n_unl long").groupBy("bucket").agg(F.sum("n_pos"), F.sum("n_unl")).toPandas()
    totals = np.zeros((2, 2**BITS))
    totals[:, sums["bucket"].to_numpy(np.int64)] = sums.iloc[:, 1:].to_numpy(np.float64).T
    sizes = chosen.agg(F.count_if("positive"), F.count_if("unlabelled")).first()
    ratio = telling(totals[0], totals[1], *sizes)
    shared = docs.sparkSession.sparkContext.broadcast(ratio != 0)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, kept = Grams(), shared.value
        for batch in small_batches(batches):
            held = [(x := grams.of(t))[kept[x]].tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), batch.column("unlabelled"), pa.array(held, pa.binary())],
                                             ["positive", "unlabelled", "grams"])

    rows = chosen.mapInArrow(features, "positive boolean, unlabelled boolean, grams binary").collect()
    grams = [np.frombuffer(r["grams"], np.int32) for r in rows]
    return train([g for g, r in zip(grams, rows) if r["positive"]], [g for g, r in zip(grams, rows) if r["unlabelled"]], ratio, prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: toxic likelier) and predicted (1 if score >= 0.5) of every whole text.

    The score depends on the text alone. Null and empty texts are scored as texts without any word. Every row gives one row, whether
    doc_id is null or repeated; an empty table gives an empty result. Other columns are not read. See ``fit`` for ``bounds``.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = Grams(), model.value
        for batch in small_batches(batches):
            scores = np.array([held.score(grams.of(t)) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("held_out", held_out())
    return rows.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, all columns as they are. See ``toxicity_scores``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = Grams(), model.value
        for batch in small_batches(batches):
            keep = [held.margin(grams.of(t or "")) < 0 for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)
