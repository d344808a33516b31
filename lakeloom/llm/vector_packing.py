"""Best-fit packing of documents into sequences under several capacities."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm.base import byte_letters, small_batches, text_or_empty
from lakeloom.plans import durable

#: How byte-level vocabularies cut a text before merging (a fixed value), without a look ahead; see ``RUN``.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

#: Two or more characters of the property White_Space (Python's own class has four more); before another character the last of them begins a piece.
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
RUN = re.compile(SPACE + SPACE + "+")


class Ids:
    """A text's ids as little-endian unsigned 32-bit numbers, equal to those of the ``tokenizers`` library.

    The vocabulary is read by ``tokenizers``, which also encodes the texts that hold special strings. ``tiktoken`` encodes all others, with the
    same ranks. The library's pattern ends in ``\\s+(?!\\S)|\\s+``, which is slow to match: here texts are cut before the last character of
    the runs that this concerns, and ``\\s+`` finds the same pieces.
    """

    def __init__(self, path: str):
        self.tool = Tokenizer.from_file(path)
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t.content for t in self.tool.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in t): i for t, i in self.tool.get_vocab().items() if t not in self.special}
        self.merge = tiktoken.Encoding("pieces", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.tool.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        cuts = [0, *(run.end() - 1 for run in RUN.finditer(text) if run.end() < len(text)), len(text)]
        return b"".join([self.merge.encode_to_numpy(text[a:b], disallowed_special=()).astype("<u4", copy=False).tobytes()
                         for a, b in zip(cuts, cuts[1:])])


@functools.lru_cache(2)
def _ids(path: str) -> Ids:
    return Ids(path)


def pieces_of(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every whole text's ids and ``end_id``, cut only where longer than ``size``.

    A longer document is cut so that all pieces but the first hold ``size`` ids. Null and empty texts consist of ``end_id``.
    """
    tail = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _ids(path)
        for batch in small_batches(batches):
            doc, piece, start, length, crc = [], [], [], [], []
            for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = tool.of(text) + tail
                n = len(data) // 4
                cuts = [0, *range(n % size or size, n + 1, size)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(number)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a:4 * b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(length: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float],
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, taken as they come, by vector best-fit.

    An item needs (length, 1, length squared) of the capacities (tokens, documents, attention cost). Of the open bins that hold it under
    every capacity it goes to the one with the smallest weighted norm of what stays free (``rule`` "norm") or the largest weighted product
    of need and free room ("dot"); ties go to the oldest bin. Shares are of the capacity. Items that no bin can hold are refused.
    """
    cap, w = np.array(capacity, float), np.array(weights, float)[:, None]
    need = np.stack([length, np.ones(len(length)), np.square(length.astype(float))]) / cap[:, None]
    if (need > 1 + 1e-12).any():
        raise ValueError("an item is larger than a bin")
    low = np.minimum.accumulate(need[:, ::-1], axis=1)[:, ::-1]  # the least that any later item needs
    free, number, used, opened = np.empty((3, 64)), np.empty(64, np.int64), np.empty(64, np.int64), 0
    out_bin, out_at, bins = np.empty(len(length), np.int64), np.empty(len(length), np.int64), 0
    slack = 1e-12
    for i in range(len(length)):
        if i % 128 == 0 and opened:
            stay = (free[:, :opened] + slack >= low[:, i, None]).all(0)
            kept = int(stay.sum())
            free[:, :kept], number[:kept], used[:kept] = free[:, :opened][:, stay], number[:opened][stay], used[:opened][stay]
            opened = kept
        item = need[:, i, None]
        rest = free[:, :opened] - item
        fits = (rest >= -slack).all(0)
        if fits.any():
            score = (w * rest * rest).sum(0) if rule == "norm" else -(w * item * free[:, :opened]).sum(0)
            at = int(np.argmin(np.where(fits, score, np.inf)))
        else:
            if opened == free.shape[1]:
                free, number, used = np.concatenate([free, free], 1), np.tile(number, 2), np.tile(used, 2)
            at, opened = opened, opened + 1
            free[:, at], number[at], used[at] = 1, bins, 0
            bins += 1
        out_bin[i], out_at[i] = number[at], used[at]
        used[at] += length[i]
        free[:, at] -= item[:, 0]
    return out_bin, out_at


def pack(pieces: DataFrame, size: int = 1024, max_documents: int = 1024, max_cost: float = 1024.0**2,
         weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), rule: str = "norm", group_rows: int = 20_000) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Each sequence holds at most ``size`` tokens, ``max_documents`` pieces and an attention cost (sum of squared lengths) of
    ``max_cost``. The rows are dealt by hash over groups of about ``group_rows``; each group is packed on its own, longest first, so a
    group leaves a few unfilled sequences and no task sees more than its group. Every piece is placed; equal rows are placed one by one.
    An empty table gives an empty result.
    """
    n = pieces.count()
    groups = max(1, round(n / group_rows))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["g"].iloc[0])
        rows = rows.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True], kind="stable")
        length = rows["length"].to_numpy(np.int64)
        whole = int((length == size).sum()) if size * size <= max_cost else 0  # full pieces are sequences of their own
        bins, at = best_fit(length[whole:], (size, max_documents, max_cost), weights, rule)
        rows["sequence_id"] = group * 2**32 + np.concatenate([np.arange(whole), bins + whole])
        rows["offset"] = np.concatenate([np.zeros(whole, np.int64), at])
        return rows.drop(columns="g")

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    dealt = pieces.select("doc_id", "piece", "start", "length", "ids_crc32",
                          F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).alias("g"))
    return dealt.groupBy("g").applyInPandas(run, kinds)


def pack_documents(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, **limits) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: ``docs`` as ids of the vocabulary ``path``, packed.

    See ``pieces_of`` and ``pack``. A null doc_id is a document like any other. Other columns are not read.
    """
    return pack(durable.cut(pieces_of(docs, path, size, end_id), "pieces"), size, **limits)
