"""Fill-in-the-middle by exchanging blocks in place: three reversals move a block, and the same move backwards restores the text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import byte_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
STRETCH = 1 << 16  # bytes that a reversal holds beside the text
CODED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """Turn ``view[a:b]`` around in place, a stretch from both ends at a time."""
    while b - a > 1:
        k = min(STRETCH, (b - a) // 2)
        left = view[a:a + k][::-1].copy()
        view[a:a + k] = view[b - k:b][::-1]
        view[b - k:b] = left
        a, b = a + k, b - k


def rotate(text: bytearray, a: int, m: int, b: int) -> None:
    """Exchange the neighbouring blocks ``text[a:m]`` and ``text[m:b]`` in place."""
    view = np.frombuffer(text, np.uint8)
    reverse(view, a, m)
    reverse(view, m, b)
    reverse(view, a, b)


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, its newline included; a last line need not have one."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    return ends


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 from the seed and the document's number; a null one counts as an empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def characters(text: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def exchange(text: bytes, cut1: int, cut2: int, form: str) -> bytearray:
    """``text`` with its middle, between the cuts, moved behind the suffix, and a sentinel before each of the three parts."""
    out = bytearray(text)
    out[cut2:cut2] = SUFFIX
    out[cut1:cut1] = MIDDLE
    out[0:0] = PREFIX
    middle, suffix = cut1 + len(PREFIX), cut2 + len(PREFIX) + len(MIDDLE)
    # laid out as prefix, middle, suffix: the suffix changes places with the middle alone, or with all that stands before it
    rotate(out, middle if form == "psm" else 0, suffix, len(out))
    return out


def undo(output: bytes, form: str) -> bytearray:
    """The text behind an output. A text that holds a sentinel is never exchanged, so each is found once."""
    out = bytearray(output)
    if form == "plain":
        return out
    middle = out.find(MIDDLE)
    if form == "psm":
        start = out.find(SUFFIX)
        rotate(out, start, middle, len(out))
        second = start
    else:
        prefix = out.find(PREFIX)
        rotate(out, 0, prefix, len(out))
        second = middle - prefix
    third = out.find(SUFFIX, second)
    del out[third:third + len(SUFFIX)]
    del out[second:second + len(MIDDLE)]
    del out[:len(PREFIX)]
    return out


def transform(text: bytes, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, characters of the prefix, of the middle, output)"""
    ends = line_ends(text)
    n = len(ends)
    h = draws(doc_id, seed)
    if not n or h[2] % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    cut1, cut2 = (int(ends[k - 1]) if k else 0 for k in (low, high))
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, characters(text[:cut1]), characters(text[cut1:cut2]), bytes(exchange(text, cut1, cut2, form))


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output (bytes) of every whole text of ``docs``.

    A text is cut after two of its lines, which a digest of ``seed`` and doc_id names. psm gives ``<P>`` prefix ``<S>`` suffix ``<M>`` middle,
    spm (``spm`` of 100 texts) gives ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. Texts stay plain, with null characters, if they are empty or
    null, hold one of the sentinels, or are not among ``rate`` of 100.

    Every row gives one row: a null doc_id is drawn as an empty string, repeated rows give equal results, parts may be empty, and an empty
    table gives an empty result. Other columns are not read. One text has to fit into a task a few times over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            made = [transform(t.as_buffer().to_pybytes(), i, seed, rate, spm) for i, t in zip(ids, batch.column("text"))]
            n, form, before, inside, output = zip(*made)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                pa.array(inside, pa.int64()), pa.array(output, pa.binary())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return _texts(docs).mapInArrow(run, CODED)


def restored(coded: DataFrame) -> DataFrame:
    """``coded`` (doc_id, n, form, prefix_chars, middle_chars, output) with ``text``: the bytes rebuilt from output and form alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "output"):
            forms = batch.column("form").to_pylist()
            texts = [bytes(undo(o.as_buffer().to_pybytes(), f)) for o, f in zip(batch.column("output"), forms)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "text"])

    return coded.select(*[c.split()[0] for c in CODED.split(", ")]).mapInArrow(run, f"{CODED}, text binary")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
