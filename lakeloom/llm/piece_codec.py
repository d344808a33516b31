"""Byte-level BPE encoding and decoding through a sentencepiece model that is written straight from a rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from lakeloom.llm.base import byte_letters, small_batches, splitter, text_or_empty

MOST_WORDS = 500_000


def _varint(n: int) -> bytes:
    n &= 2**64 - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes((*out, n))


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: integer, 32-bit float or length-delimited."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model of kind BPE in which a piece's id is its rank.

    Pieces are the vocabulary's byte strings written in printable letters, scored by negative rank, so that the best pair is always the one of
    lowest rank. The normaliser is the identity. The unknown piece comes last; it cannot occur, for every byte is a piece.
    """
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes((b,)) not in ranks for b in range(256)):
        raise ValueError("ranks have to be 0, 1, 2, ... and hold every byte")
    letters, n = byte_letters(), len(ranks)
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(letters[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1)))  # kind 1: normal
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))  # kind 2: unknown
    trainer = _field(3, 2) + _field(4, n + 1) + _field(40, n) + _field(41, -1) + _field(42, -1) + _field(43, -1)  # kind 2: BPE
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, nothing removed or escaped
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.find = splitter(pattern).findall
        self.words: dict[str, tuple[int, ...]] = {}

    def learn(self, words: set[str]) -> None:
        """Encode the words not met so far; the memory of words starts anew when it is full."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > MOST_WORDS:
            self.words.clear()
            new = words
        raw = [w.encode() for w in new]
        coded = self.model.encode([r.decode("latin-1").translate(self.letters) for r in raw], num_threads=1)
        for word, data, ids in zip(new, raw, coded):
            whole = self.ranks.get(data)  # a word that is a token stays whole
            self.words[word] = tuple(ids) if whole is None else (whole,)

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; meant for a few megabytes at a time."""
        words = [self.find(t) for t in texts]
        self.learn(set().union(*words))
        for each in words:
            yield list(chain.from_iterable(map(self.words.__getitem__, each)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (list) of every whole text, by the ranks in ``path`` and the pre-token ``pattern``.

    Null and empty texts have no ids. Every row gives one row, whether doc_id is null or repeated. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in small_batches(batches):
            ids = list(tool.encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and data (binary) of rows (doc_id, ids); null ids decode to nothing, an unknown id fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in batches:
            data = [tool.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text: ``encode_documents`` and ``decode_documents`` in one pass.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the bytes that the ids decode to. Rows as in ``encode_documents``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in small_batches(batches):
            n, first, second = [], [], []
            for ids in tool.encode(batch.column("text").to_pylist()):
                n.append(len(ids))
                first.append(hashlib.sha256(",".join(map(tool.text_of.__getitem__, ids)).encode()).hexdigest())
                second.append(hashlib.sha256(tool.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(first), pa.array(second)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
