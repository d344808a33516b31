"""Near duplicates by word shingles: a MinHash LSH forest proposes, exact Jaccard similarities decide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import Memo, small_batches, text_or_empty
from lakeloom.plans import durable
from lakeloom.plans.components import components
from lakeloom.plans.grouped import by_group, first_connected, in_blocks, overlaps

TRIES, DEEPEST = 16, 6
HASHES = TRIES * DEEPEST
ODD = np.uint64(0x9E3779B97F4A7C15)
BUCKET_ROWS, GROUP_ROWS = 2000, 1000


def depth_for(threshold: float, target: float) -> int:
    """How far matched prefixes have to be shortened.

    Two texts of similarity s share the first d hashes of one trie with probability s^d. From the deepest level on, prefixes are shortened until
    pairs at the threshold meet in one of the tries with probability ``target``.
    """
    depth = DEEPEST
    while depth > 1 and 1 - (1 - threshold**depth) ** TRIES < target:
        depth -= 1
    return depth


def least_equal(threshold: float, target: float, depth: int) -> int:
    """How many of the hashes two texts have to share, half of them at most.

    Falling short of it and meeting in no trie together happen to a pair at the threshold with probability 1 - ``target`` at most.
    """
    missed = (1 - threshold**depth) ** TRIES
    if missed > 1 - target:
        raise ValueError(f"{TRIES} tries find pairs of similarity {threshold} with probability {1 - missed:.6f}, under {target}")
    hashes, least = TRIES * depth, 0
    while least < hashes / 2:
        missed += math.comb(hashes, least) * threshold**least * (1 - threshold) ** (hashes - least)
        if missed > 1 - target:
            break
        least += 1
    return least


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of hashed runs of ``width`` words, sorted; a shorter text is one run, a text without words has none."""

    def __init__(self, width: int):
        self.width = width
        self.words = Memo(lambda w: int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little"))

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            out = out * ODD + h[i:len(h) - width + 1 + i]
        return np.unique(_mix(out))


def _signature(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 8192):
        low = np.minimum(low, (shingles[i:i + 8192, None] * factors + offsets).min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, width: int, depth: int) -> DataFrame:
    """doc_id, s1, s2 (a 128-bit hash of the shingle set), n (its size) and sig: ``depth`` MinHash values for each trie in turn."""
    draw = np.random.default_rng(11).integers(1, 2**63, (2, HASHES), dtype=np.uint64)
    used = np.concatenate([np.arange(t * DEEPEST, t * DEEPEST + depth) for t in range(TRIES)])
    factors, offsets = draw[0][used] * np.uint64(2) + np.uint64(1), draw[1][used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Shingles(width)
        for batch in small_batches(batches):
            s1, s2, n, sig = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = tool.of(text)
                s1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(_mix(s + ODD).sum(dtype=np.uint64).view(np.int64)))
                n.append(len(s))
                sig.append(_signature(s, factors, offsets).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                                              pa.array(n, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "s1", "s2", "n", "sig"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, s1 long, s2 long, n long, sig binary")


def candidates(nodes: DataFrame, depth: int, least: int) -> DataFrame:
    """(a, b): links that hold together all texts which share a trie prefix and at least ``least`` of all hashes.

    ``least`` follows from the threshold (``least_equal``), so that a true pair practically never falls short of it; it keeps texts that merely share a
    passage from growing into one group. Each group of one prefix gives one link per text and not one per pair.
    """
    width = 4 * depth
    tries = nodes.select("rep", "sig", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))).alias("trie"))
    keyed = tries.select("rep", F.xxhash64("trie", F.expr(f"substring(sig, trie * {width} + 1, {width})")).alias("prefix"))
    crowded = keyed.groupBy("prefix").agg(F.count("*").alias("m")).filter("m > 1")
    shared = keyed.join(crowded, "prefix").join(nodes.select("rep", "sig"), "rep")
    dealt = in_blocks(shared, "prefix", "rep", "m", BUCKET_ROWS).select("group", "rep", "sig")

    def link(table: pa.Table) -> pa.RecordBatch | None:
        if table.num_rows < 2:
            return None
        rep = table.column("rep").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(rep), -1)
        same = np.zeros((len(rep), len(rep)), np.uint16)
        for column in sig.T:
            same += column[:, None] == column[None, :]
        order = np.argsort(rep, kind="stable")
        root, _ = first_connected((same >= least)[np.ix_(order, order)])
        rep = rep[order]
        far = root != np.arange(len(rep))
        return pa.RecordBatch.from_arrays([pa.array(rep[root[far]]), pa.array(rep[far])], ["a", "b"]) if far.any() else None

    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(by_group(link), "a long, b long").distinct()


def similar(docs: DataFrame, threshold: float = 0.8, width: int = 5, target: float = 0.9999) -> DataFrame:
    """doc_id, class_id, n_links: all texts whose sets of ``width``-word shingles have a Jaccard similarity of ``threshold`` or more.

    n_links counts the other documents that a text is linked with, exact copies included; class_id is the smallest doc_id that it is connected to by
    links. A threshold for which the tries cannot hold ``target`` is refused. Words are what white space separates. Texts with equal shingle sets are one node with a number of copies. Nodes that share a trie
    prefix become candidates, and each group of connected candidates is compared pair by pair on its whole shingle sets, large
    groups in blocks; only counts and one link per text leave a task. A link is missed only if no trie proposes it, it falls
    short of ``least_equal``, or a chain of proposals does, which at the threshold happens to a pair with probability 1 - ``target``.

    Texts without words (null, empty, blank) are linked to nothing and are classes of their own. Rows with a null doc_id take no part and get a
    null class and 0 links. Of equal rows each is returned and they count as one document. An empty table gives an empty result.
    """
    depth = depth_for(threshold, target)
    least = least_equal(threshold, target, depth)
    rows = durable.cut(signatures(docs, width, depth), "signatures")
    known = rows.filter("doc_id IS NOT NULL AND n > 0")
    nodes = known.groupBy("s1", "s2", "doc_id").agg(F.first("n").alias("n"), F.first("sig").alias("sig")).groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = durable.cut(nodes.withColumn("rep", F.struct("rep", "s1", "s2")).select(
        "rep.rep", "s1", "s2", "copies", "sig"), "nodes")
    node = F.xxhash64("rep", "s1", "s2")
    named = nodes.select(node.alias("rep"), "sig")
    groups = durable.cut(components(candidates(named, depth, least)), "groups")
    sizes = groups.groupBy("root").agg(F.count("*").alias("m"))
    member = nodes.select("rep", "s1", "s2", "copies", node.alias("node")).join(groups.join(sizes, "root"), "node")

    chosen = docs.select(docs["doc_id"].cast("long").alias("rep"), text_or_empty().alias("text")).join(member, "rep")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Shingles(width)
        for batch in small_batches(batches):
            sets = [tool.of(t) for t in batch.column("text").to_pylist()]
            own = pa.array([int(s.sum(dtype=np.uint64).view(np.int64)) == x for s, x in zip(sets, batch.column("s1").to_pylist())])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "root", "m", "copies")),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "root", "m", "copies", "set"]).filter(own)

    sets = chosen.select("node", "root", "m", "copies", "s1", "text").mapInArrow(
        shingles, "node long, root long, m long, copies long, set binary")
    dealt = in_blocks(sets, "root", "node", "m", GROUP_ROWS).select("group", "node", "copies", "part", "a", "b", "set")
    exact = Fraction(threshold).limit_denominator(10**6)
    over, under = exact.numerator, exact.denominator

    def verify(table: pa.Table) -> pa.RecordBatch | None:
        node, first = np.unique(table.column("node").to_numpy(), return_index=True)
        if len(node) < 2:
            return None
        copies, part = (table.column(c).to_numpy()[first] for c in ("copies", "part"))
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        held = [np.frombuffer(table.column("set")[int(i)].as_py(), np.uint64) for i in first]
        size = np.array([len(s) for s in held])
        linked = overlaps(held) * (over + under) >= over * (size[:, None] + size[None, :])
        np.fill_diagonal(linked, False)
        # pairs within a part meet in several pairs of parts and count in the first of them
        home = (part == 0) & (b <= 1) | (part > 0) & (a == 0) & (part == b)
        counted = linked & ((part[:, None] != part[None, :]) | home[:, None])
        root, _ = first_connected(linked)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(counted @ copies), pa.array(node[root])], ["node", "links", "first"])

    checked = durable.cut(dealt.repartition("group").sortWithinPartitions("group").mapInArrow(
        by_group(verify), "node long, links long, first long"), "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(checked.select(F.col("node").alias("a"), F.col("first").alias("b")))
    place = nodes.select("rep", "s1", "s2", "copies", node.alias("node")).join(links, "node", "left").join(joined, "node", "left")
    place = place.withColumn("root", F.coalesce("root", "node"))
    lowest = place.groupBy("root").agg(F.min("rep").alias("class_id"))
    place = place.join(lowest, "root").select(
        "s1", "s2", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.withColumn("known", F.col("doc_id").isNotNull() & (F.col("n") > 0))
    alone = out.filter(~F.col("known")).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.filter("known").join(place, ["s1", "s2"]).select("doc_id", "class_id", "n_links").unionByName(alone)


def without_similar(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class of ``similar``: the one with the smallest doc_id.

    Rows with a null doc_id and texts without words stay, and so does every row of a document that stays.
    """
    found = similar(docs, **options)
    gone = found.filter("class_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
