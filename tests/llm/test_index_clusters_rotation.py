"""Exact dedup by the hash index, clustering by pivots and the block rotation: brute force, round trips and small hard tables."""

import hashlib
import os
import random
import re

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import block_rotation, hash_index, pivot_clusters, queries

SCHEMA = "doc_id long, text string, h long, row int, bucket string, n string, last int, output string, form string"
EXTRA = (7, 1, "b", "n", 2, "o", "f")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    long = "Line of a very long text\n" * 40_000
    rows = [(1, "Some Text"), (2, "some text"), (9, "SOME TEXT"), (3, "other"), (4, None), (5, ""), (6, ""), (7, "É"), (8, "é"), (10, long),
            (11, long.upper()), (3, "other"), (3, "other"), (None, "other"), (None, "alone"), (None, "alone"), (12, "other \n<P>"), (13, "\n"),
            (14, "a\r\nb\n\n漢字 \U0001F600"), (15, "some text "), (16, "<S"), (17, "one\n<S\ntwo\n")]
    return frame(spark, rows)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    out = []
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        stays = ids.index(best)
        out += [(i, best, len(ids), k == stays, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(map(str, out))


def weak():
    return F.xxhash64(F.length("text"))


@pytest.mark.parametrize("capacity, key", [(32_768, None), (2, None), (1, weak), (2, lambda: F.lit(5).cast("long"))])
def test_groups_equal_brute_force(spark, docs, capacity, key):
    """Also with hashes that unlike texts share, up to one hash for all of them."""
    got = hash_index.exact_duplicates(docs, capacity, key and key())
    assert sorted(str(tuple(r)) for r in got.collect()) == expected_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_on_random_texts(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["A", "hot"]) if i % 3 == 0 else "".join(rng.choice("aAbB") for _ in range(rng.randint(0, 5)))) for i in range(600)]
    got = hash_index.exact_duplicates(frame(spark, rows), 3, weak())
    assert sorted(str(tuple(r)) for r in got.collect()) == expected_groups(rows)


def test_no_documents(spark):
    assert hash_index.exact_duplicates(frame(spark, [])).collect() == []
    assert block_rotation.restored(block_rotation.fill_in_middle(frame(spark, []))).collect() == []


def batch(spark, texts):
    rows = spark.createDataFrame(texts, "text string, last long").withColumn("h", F.xxhash64("text"))
    return rows, rows.groupBy("h").agg(F.count("*").alias("n"))


def test_index_grows_and_keeps_untouched_buckets(spark):
    index = hash_index.HashIndex(spark, capacity=8)
    first = [(f"text {i % 60}", i) for i in range(90)]
    index.add(*batch(spark, first))
    assert index.depth >= 3 and len(index.directory()) == 2**index.depth
    before = dict(index.buckets)
    index.add(*batch(spark, [("text 5", 1000), ("one more", 1001)]))
    kept = [b for b, path in before.items() if path and index.buckets.get(b) == path]
    assert len(kept) >= len(before) - 4 and all(os.path.exists(before[b]) for b in kept)
    got = {r.text: (r.n, r.last) for r in index.table().collect()}
    want = {}
    for t, i in [*first, ("text 5", 1000), ("one more", 1001)]:
        n, last = want.get(t, (0, -1))
        want[t] = n + 1, max(last, i)
    assert got == want
    for b in index.buckets:  # a bucket is a range of the hash, in order, and within its capacity
        hashes = [r.h for r in index.table([b]).collect()]
        assert len(set(hashes)) <= 8 and all(f"{h % 2**64:064b}".startswith(b) for h in hashes)
        assert [h % 2**64 for h in hashes] == sorted(h % 2**64 for h in hashes)


def test_dedup_sends_texts_once_and_runs_no_python(spark, sf_dir):
    plan = queries.QUERIES["op11_hash_index"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def brute_clusters(rows, k=16, rounds=3):
    at = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)[:k]
    at = [v for _, v in at]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        groups = {}
        for _, v in rows:
            groups.setdefault(near(v)[1], []).append(v)
        for c, vs in groups.items():
            at[c] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted((str(i), near(v)[1], near(v)[0]) for i, v in rows)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<double>, p int, cluster int, part string")


def got_clusters(df):
    return sorted((str(r.vec_id), r.cluster, r.distance) for r in df.collect())


def as_integers(rows):
    return [(i, [int(np.floor(64 * x)) if abs(x) < 1e300 else 64 * int(x) for x in v]) for i, v in rows]


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 3, (5, 64))
    fine = [(int(i), (centre[i % 5] + rng.normal(0, 1, 64)).tolist()) for i in range(200)]
    fine += [(7, fine[7][1]), (8, fine[9][1]), (None, fine[3][1]), (500, [0.0] * 64), (501, [0.0] * 64)]
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [float("nan")] * 64), (906, [float("inf")] * 64)]
    shares = []
    out = pivot_clusters.clusters(vectors(spark, fine + odd), computed=shares)
    rows = out.collect()
    assert got_clusters(out) == brute_clusters(as_integers(fine))
    assert len(shares) == 3 and min(shares) < 0.9
    for r in rows:
        assert r.cluster_inertia == sum(x.distance for x in rows if x.cluster == r.cluster) and r.inertia == sum(x.distance for x in rows)


def test_clusters_of_huge_few_or_no_vectors(spark):
    huge = [(i, [((-1) ** i) * 10.0**e] * 64) for i, e in enumerate([306, 300, 40, 8, 3, 0, 0, -3])]
    want = [(i, c, min(d, 2**63 - 1)) for i, c, d in brute_clusters(as_integers(huge), 3)]
    assert got_clusters(pivot_clusters.clusters(vectors(spark, huge), k=3)) == want
    few = [(1, [0.5] * 64), (2, [0.5] * 64)]
    assert got_clusters(pivot_clusters.clusters(vectors(spark, few))) == [("1", 0, 0), ("2", 0, 0)]
    assert pivot_clusters.clusters(vectors(spark, [])).collect() == []
    assert pivot_clusters.clusters(vectors(spark, [(1, None), (2, [1.0])])).collect() == []


def test_no_bound_exceeds_its_distance():
    rng = np.random.default_rng(5)
    for scale in (1, 1000, 2**26):
        v = rng.integers(-scale, scale, (400, 64), endpoint=True)
        v[50:60] = v[0]  # rows that are pivots and centroids themselves
        c = pivot_clusters.Centroids(v[:16], v[:6])
        cached = np.stack([pivot_clusters.root(pivot_clusters.squared(v, np.repeat(p[None], len(v), 0))) for p in c.pivots], 1)
        exact = ((v[:, None].astype(object) - c.at[None].astype(object)) ** 2).sum(2)
        assert (c.bounds(cached).astype(object) <= exact).all()


def test_rotation_equals_plain_strings_and_goes_back(spark, docs):
    coded = block_rotation.restored(block_rotation.fill_in_middle(docs)).collect()
    by_row = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, bytes(r.text).decode()) for r in coded), key=str) == by_row
    for r in coded:
        text, out = bytes(r.text).decode(), bytes(r.output).decode()
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert r.n == len(lines)
        if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
            assert (r.form, out, r.prefix_chars, r.middle_chars) == ("plain", text, None, None)
            continue
        digest = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        a, b, _, d = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
        low, high = sorted((a % (r.n + 1), b % (r.n + 1)))
        pre, mid, suf = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
        assert (r.prefix_chars, r.middle_chars, r.form) == (len(pre), len(mid), "spm" if d % 100 < 50 else "psm")
        assert out == (f"<S>{suf}<P>{pre}<M>{mid}" if r.form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}")


def test_rotation_of_long_blocks():
    rng = random.Random(8)
    for _ in range(20):
        data = rng.randbytes(rng.randint(0, 400_000))
        a, m, b = sorted(rng.randint(0, len(data)) for _ in range(3))
        turned = bytearray(data)
        block_rotation.rotate(turned, a, m, b)
        assert bytes(turned) == data[:a] + data[m:b] + data[a:m] + data[b:]


def test_rate_and_share(spark):
    docs = frame(spark, [(i, f"a{i}\nb\nc") for i in range(400)])
    forms = [r.form for r in block_rotation.fill_in_middle(docs, rate=50, spm=0).collect()]
    assert 140 < forms.count("plain") < 260 and "spm" not in forms


@pytest.mark.parametrize("name", ["op11_hash_index", "op12_pivot_clusters", "op13_block_rotation"])
def test_queries_equal_sql(spark, sf_dir, name):
    assert oracle.compare(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.SQL[name]) is None
