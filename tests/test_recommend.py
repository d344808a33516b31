"""Best items per user: all pairs as the yardstick, fewer pairs scored, and the library's own recommendations."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from lakeloom.operators import recommend as R


def table(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors], "id long, features array<float>")


def brute(users, items, k):
    out = {}
    for u, a in users:
        a = np.float32(a).astype(float)
        scored = sorted((-float(a @ np.float32(b).astype(float)), i) for i, b in items)
        out[u] = [i for _, i in scored[:k]]
    return out


def listed(df):
    out = {}
    for r in df.orderBy("user", "rank").collect():
        out.setdefault(r.user, []).append(r.item)
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(R, "ITEMS_PER_CHUNK", 50)
    monkeypatch.setattr(R, "USERS_PER_BLOCK", 40)


def test_equals_all_pairs_with_fewer_scored(spark, small_blocks):
    rng = np.random.default_rng(3)
    users = [(i, rng.normal(size=6)) for i in range(150)]
    items = [(i, rng.normal(size=6) * rng.lognormal(0, 1)) for i in range(800)] + [(900 + i, np.ones(6)) for i in range(5)]
    counted = []
    got = listed(R.top_items(table(spark, users), table(spark, items), 4, counted))
    assert got == brute(users, items, 4)
    assert sum(counted) < 0.6 * len(users) * len(items) and len(counted) > 1


def test_ties_few_items_zero_and_null_vectors(spark, small_blocks):
    users = table(spark, [(1, [1, 0]), (2, [0, 0])]).unionByName(spark.createDataFrame([(None, [1.0, 1.0]), (3, None)], "id long, features array<float>"))
    items = [(9, [1, 0]), (4, [1, 0]), (7, [2, 5])]
    assert listed(R.top_items(users, table(spark, items), 2)) == {1: [7, 4], 2: [4, 7]}
    assert listed(R.top_items(users, table(spark, items), 10)) == {1: [7, 4, 9], 2: [4, 7, 9]}
    assert listed(R.top_items(users, table(spark, []), 2)) == {}


def test_equals_the_library(spark, small_blocks):
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i), float(rng.random())) for u in range(60) for i in rng.choice(200, 12, replace=False)]
    model = ALS(userCol="u", itemCol="i", ratingCol="r", rank=4, maxIter=3, seed=1).fit(spark.createDataFrame(rows, "u int, i int, r float"))
    want = {r.u: {round(x.rating, 4) for x in r.recommendations} for r in model.recommendForAllUsers(5).collect()}
    got = R.top_items(model.userFactors, model.itemFactors, 5).groupBy("user").agg(F.collect_set(F.round("score", 4)).alias("s"))
    for r in got.collect():
        assert np.allclose(sorted(r.s), sorted(want[r.user]), atol=2e-4)
