"""Vector search: the one-plan exact search over several blocks of queries, and the bucketed one against it."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import retrieval as R


def brute(rows, asked, k):
    out = {}
    for q, v in asked:
        v = np.array(v)
        scores = sorted((-float(np.dot(v, x) / np.linalg.norm(v) / np.linalg.norm(x)), i) for i, x in rows)
        out[q] = [i for _, i in scores[:k]]
    return out


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 24))
    rows = [(i, (centre[i % 12] * 3 + rng.normal(size=24)).tolist()) for i in range(600)]
    df = spark.createDataFrame([*rows, (700, None), (701, [0.0] * 24), (702, [float("nan")] * 24)], "id long, v array<double>")
    return rows, df.repartition(4).persist()


def listed(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.id)
    return out


def test_exact_search_over_several_blocks(spark, clustered, monkeypatch):
    rows, df = clustered
    monkeypatch.setattr(R, "QUERIES_PER_BLOCK", 7)
    asked = df.filter("id < 40").select(F.col("id").alias("query_id"), F.col("v").alias("qvec"))
    for threshold in (None, "-1"):  # queries that travel, and queries that are joined on block and salt
        if threshold:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = listed(R.vector_top_k(df.filter("id < 700"), asked, "id", "v", 5))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == brute(rows, rows[:40], 5)


def test_buckets_are_widened_to_the_recall(spark, clustered):
    rows, df = clustered
    asked = df.filter("id % 3 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("qvec"))
    tries = []
    found = R.lsh_top_k(df, asked, "id", "v", 10, target=0.95, report=tries)
    want = brute(rows, rows[::3], 10)
    got = listed(found)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    assert tries[-1][2] >= 0.95 and all(r < 0.95 for _, _, r in tries[:-1])


def test_unreachable_target_falls_back_to_the_exact_search(spark, clustered):
    rows, df = clustered
    asked = df.filter("id < 3").select(F.col("id").alias("query_id"), F.col("v").alias("qvec"))
    assert listed(R.lsh_top_k(df, asked, "id", "v", 4, target=1.1, most_tables=4)) == brute(rows, rows[:3], 4)


def test_buckets_cut_into_tiles_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 8))
    v[40:200] = v[3]  # more copies than are asked for, and ties between rows of different tiles
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame([*rows, (300, None), (301, [0.0] * 8)], "id long, v array<double>").repartition(3).persist()
    asked = df.filter("id % 20 = 0 OR id = 3").select(F.col("id").alias("query_id"), F.col("v").alias("qvec"))
    monkeypatch.setattr(R, "ROWS_PER_TILE", 50)
    monkeypatch.setattr(R, "QUERIES_PER_TILE", 4)
    for target in (0.95, 1.1):  # the last is out of reach, so all are compared
        got = listed(R.lsh_top_k(df, asked, "id", "v", 6, target=target, most_tables=16))
        want = listed(R.vector_top_k(df.filter("id < 300"), asked.filter("query_id < 300"), "id", "v", 6))
        assert set(got) == set(want) and all(len(ids) == 6 for ids in got.values())
        assert np.mean([len(set(got[q]) & set(want[q])) / 6 for q in want]) >= 0.9
        assert all(got[i] == [3, 40, 41, 42, 43, 44] for i in (3, 40, 60, 180))


def test_tile_needs_no_comparison_by_rows(spark, clustered):
    """The plan compares in tiles: no row is multiplied by the queries of its bucket."""
    _, df = clustered
    asked = df.filter("id % 3 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("qvec"))
    plan = R.lsh_top_k(df, asked, "id", "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_summary_scores_frequent_and_rare_words_in_one_pass(spark, monkeypatch):
    texts = [(1, "Common words here. Rare zebra words! Common common. ... "), (2, "Common here? Words words. Quartz"), (2, "Common again. Quartz quartz"),
             (3, "..."), (4, ""), (5, None), (None, "Common lost. Rare"), (6, "Common here. Words here. Common words. Here")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    split = [(i, [s for s in re.split(r"[.!?]\s+", x)]) for i, x in texts if x is not None]
    words = lambda s: re.findall(r"[^\W_]+", s.lower())
    df = Counter(w for _, ss in split for w in {w for s in ss for w in words(s)})
    want = {}
    for key in {i for i, _ in split if i is not None}:
        said = [(pos, s) for i, ss in split if i == key for pos, s in enumerate(ss)]
        scores = {}
        for pos in {pos for pos, _ in said}:
            all_words = [w for p, s in said if p == pos for w in words(s)]
            if all_words:
                scores[pos] = round(sum(math.log(len(texts) / df[w]) for w in all_words) / len(all_words), 6)
        best = sorted(scores, key=lambda pos: (-scores[pos], pos))[:2]
        if best:
            want[key] = ". ".join(s for _, s in sorted((p, s) for p, s in said if p in best))
    for frequent in (1, 8, 1_000_000):  # no word, some, all known to the tasks
        monkeypatch.setattr(R, "FREQUENT", frequent)
        out = R.extractive_summary(docs, "doc_id", "text", 2)
        got = out.collect()
        assert len(got) == len(want) and {r.doc_id: r.summary for r in got} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
