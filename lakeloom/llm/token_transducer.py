"""Token counts by finite-state transducers, without building any ids.

Two deterministic transducers work one after the other. The first reads character classes and marks where pieces of text begin, as the
byte-level pre-tokenizer cuts them; it has eight states and runs over fixed-size chunks of a whole batch at once. Each chunk first
gives a map from entry state to exit state; these maps are composed by a parallel prefix scan, which tells each chunk its entry state.
The second reads the bytes of a piece. Its state holds what is needed of the merges so far: the longest suffix that can still become
part of a token and the last token at each cut in it. Each transition carries the change in the number of tokens.
It is compiled as far as the texts need it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lakeloom.llm.base import Memo, byte_letters, slices, small_batches, text_or_empty

# Symbols of the first transducer: letter, digit, other, apostrophe that opens a contraction of two or three characters, last white space
# before a visible character (a space, or another one), any other white space, end of a text.
LETTER, DIGIT, OTHER, TWO, THREE, SPACE, BLANK, WHITE, END = range(9)
# Its states: at a border, in letters, in digits, in others, after the space that opens a piece, in white space, 1 or 2 characters
# before the end of a contraction.
BORDER, IN_LETTERS, IN_DIGITS, IN_OTHERS, AFTER_SPACE, IN_WHITE, LAST_ONE, LAST_TWO = range(8)
N_STATES = 8
CHUNK = 512


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, 1 if a piece begins) by symbol * N_STATES + state."""
    go, emit = np.zeros((9, N_STATES), np.int64), np.zeros((9, N_STATES), np.uint8)
    for state in range(N_STATES):
        for symbol in range(9):
            runs = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHERS, WHITE: IN_WHITE}
            if symbol == END:
                to, begins = BORDER, 0
            elif state in (LAST_ONE, LAST_TWO):
                to, begins = BORDER if state == LAST_ONE else LAST_ONE, 0
            elif symbol in (TWO, THREE):
                inside = state in (IN_OTHERS, AFTER_SPACE)
                to, begins = IN_OTHERS if inside else LAST_ONE if symbol == TWO else LAST_TWO, int(not inside)
            elif symbol in (SPACE, BLANK):
                to, begins = AFTER_SPACE if symbol == SPACE else BORDER, 1
            else:
                to = runs[symbol]
                begins = int(state != to and not (state == AFTER_SPACE and symbol != WHITE))
            go[symbol, state], emit[symbol, state] = to, begins
    return go.ravel(), emit.ravel()


@functools.lru_cache(None)
def _classes() -> np.ndarray:
    """LETTER, DIGIT, OTHER or WHITE of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            first, last = ord(m[0][0]), ord(m[0][-1])
            out[first:last + 1] = kind
            if first < 0xD800 <= last:
                out[0xD800:0xE000] = OTHER
    return out


def symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Input symbols of code points; ``ends``: places of the END marks between texts."""
    sym = _classes()[codes]
    sym[ends] = END
    white = sym == WHITE
    last = white.copy()
    last[:-1] &= (sym[1:] != WHITE) & (sym[1:] != END)
    last[-1:] = False
    sym[last] = np.where(codes[last] == 32, SPACE, BLANK)
    quote = np.flatnonzero((codes == 39) & (sym == OTHER))
    padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
    one, two = padded[quote + 1], padded[quote + 2]
    sym[quote[np.isin(one, [ord(c) for c in "stmd"])]] = TWO
    long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    sym[quote[long]] = THREE
    return sym


def begins(sym: np.ndarray) -> np.ndarray:
    """1 where a piece begins, by the first transducer over chunks and a prefix scan of their state maps."""
    go, emit = _tables()
    lanes = -(-len(sym) // CHUNK)
    padded = np.full(lanes * CHUNK, END, np.int64)
    padded[: len(sym)] = sym
    steps = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T) * N_STATES
    maps = np.tile(np.arange(N_STATES), (lanes, 1))
    for row in steps:
        maps = go.take(row[:, None] + maps)
    shift = 1
    while shift < lanes:  # maps[i] becomes the map over chunks 0..i
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift].copy(), 1)
        shift *= 2
    state = np.concatenate([[BORDER], maps[:-1, BORDER]])
    out = np.empty((CHUNK, lanes), np.uint8)
    for i, row in enumerate(steps):
        at = row + state
        out[i], state = emit.take(at), go.take(at)
    return np.ascontiguousarray(out.T).ravel()[: len(sym)]


class CountTransducer:
    """Tokens of a piece of text, read byte by byte.

    State: the longest suffix s of the bytes read that is a proper prefix of some token, and for each cut in s the last token before it
    (-1 at the beginning of the piece) and the number of tokens up to it, less those up to now. The encoding of any prefix is found by its last
    token: the one suffix that is a token and does not merge differently beside the token before it.
    """

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], most_states: int = 200_000):
        self.vocab, self.bytes_of, self.most = vocab, {i: b for b, i in vocab.items()}, most_states
        self.merge_rank = {(vocab[a], vocab[b]): (n, vocab[a + b]) for n, (a, b) in enumerate(merges)}
        self.prefixes = {t[:n] for t in vocab for n in range(len(t))}
        self.halves = {new: pair for pair, (_, new) in self.merge_rank.items()}
        self.when = {new: rank for rank, new in self.merge_rank.values()}
        self.fits = Memo(lambda ab: self.stays_apart(*ab))
        self.forget()

    def forget(self) -> None:
        self.go: dict[tuple[int, int], tuple[int, int]] = {}
        first = (b"", (-1,), (0,))
        self.states, self.number = [first], {first: 0}

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether the bytes of two adjacent tokens are encoded as just these two.

        Follows their border back through time. The parts that meet there are undone in the order opposite to that in which they were merged; if at
        any time a merge across the border had come before the next merge on either side, the tokens would not both have come about.
        """
        bound = len(self.merge_rank)
        while True:
            across = self.merge_rank.get((left, right))
            if across is not None and across[0] < bound:
                return False
            made_left, made_right = self.when.get(left, -1), self.when.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left >= made_right:  # at equal rank the left one was merged first, so the border met the right part until then
                if made_left == made_right:
                    bound, right = made_right + 1, self.halves[right][0]
                else:
                    bound, left = made_left, self.halves[left][1]
            else:
                bound, right = made_right + 1, self.halves[right][0]

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, change in the number of tokens) on reading ``byte``."""
        held, last, count = self.states[state]
        held += bytes((byte,))
        for i in range(len(held)):
            token = self.vocab.get(held[i:])
            if token is not None and (last[i] < 0 or self.fits[last[i], token]):
                break
        delta = count[i] + 1
        last, count = (*last, token), (*(c - delta for c in count), 0)
        cut = next(k for k in range(len(held) + 1) if held[k:] in self.prefixes)
        key = (held[cut:], last[cut:], count[cut:])
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        self.go[state, byte] = to, delta
        return to, delta

    def count(self, piece: str) -> int:
        if len(self.states) > self.most:
            self.forget()
        state = total = 0
        for byte in piece.encode():
            step = self.go.get((state, byte)) or self.compile(state, byte)
            state = step[0]
            total += step[1]
        return total


class TokenCounter:
    """Counts of a vocabulary file in the ``tokenizers`` format with byte-level pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind, model = spec["pre_tokenizer"], spec["model"]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"] or model["type"] != "BPE":
            raise ValueError(f"{path}: only byte-level BPE without a prefix space is compiled here")
        byte = {c: b for b, c in enumerate(byte_letters())}
        raw = lambda s: bytes(byte[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        added = set(self.special)
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.transducer = CountTransducer(vocab, [(raw(a), raw(b)) for a, b in pairs])
        self.memo = Memo(self.transducer.count, 800_000)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if added else None

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            if self.cut is not None and any(s in text for s in self.special):
                pieces = self.cut.split(text)
                out[i] += len(pieces) - 1  # a special string is one token
            else:
                pieces = [text]
            parts += pieces
            owner += [i] * len(pieces)
        for a, b in slices(parts):
            joined = "\0".join(parts[a:b]) + "\0"
            lengths = np.fromiter(map(len, parts[a:b]), np.int64, b - a)
            ends = np.cumsum(lengths + 1) - 1
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            first = begins(symbols(codes, ends))
            starts = np.flatnonzero(first)
            if not len(starts):
                continue
            first[ends] = 1
            borders = np.flatnonzero(first)
            stops = borders[np.searchsorted(borders, starts, "right")]
            memo = self.memo
            each = np.fromiter((memo[joined[x:y]] for x, y in zip(starts.tolist(), stops.tolist())), np.int64, len(starts))
            np.add.at(out, np.asarray(owner[a:b]), np.bincount(np.searchsorted(ends, starts), each, b - a).astype(np.int64))
        return out


@functools.lru_cache(2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every whole text.

    Counts are those of the vocabulary file ``path``, which has to be readable on every executor; nothing is added, cut or padded, and a
    special string within a text is one token, which is the library's default. Null and empty texts have no token. Every row
    gives one row, whether doc_id is null or repeated. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(path)
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            tokens = tool.counts(texts)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens),
                pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
