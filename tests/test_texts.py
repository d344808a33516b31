import math
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import stats
from lakeloom.functions import text as X
from lakeloom.functions.literals import half_up
from lakeloom.operators import chunking, dedup, graph, monitoring, retrieval


def test_rank_fusion_worked_example(spark):
    a = spark.createDataFrame([(0, "A", 1), (0, "C", 2), (0, "B", 5)], "query_id long, doc string, rank long")
    b = spark.createDataFrame([(0, "A", 3), (0, "C", 2), (0, "B", 1)], "query_id long, doc string, rank long")
    out = retrieval.reciprocal_rank_fusion([(a, 0.5), (b, 0.5)], "doc", 3).orderBy("rank").collect()
    assert [r.doc for r in out] == ["A", "C", "B"]
    assert [round(r.score, 5) for r in out] == [0.01613, 0.01613, 0.01589]


@given(st.text(alphabet="ab \n.", max_size=400), st.integers(1, 60))
def test_recursive_pieces_keep_the_text(text, size):
    pieces = chunking.split_recursive(text, size)
    assert "".join(pieces) == text
    assert all(0 < len(p) <= size for p in pieces)


def test_fixed_chunks_overlap(spark):
    text = "".join(chr(97 + i % 26) for i in range(2500))
    got = chunking.fixed_chunks(spark.createDataFrame([(1, text), (2, "")], "id long, text string"), ["id"], "text").orderBy("chunk_index").collect()
    assert [r.content for r in got] == [text[0:1000], text[800:1800], text[1600:2500]]
    assert {r.total_chunks for r in got} == {3}


def _jaccard(a, b, k=3):
    def runs(s):
        w = s.split()
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}

    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    docs = [" ".join(rng.choices(words, k=80)) for _ in range(25)]
    docs += [docs[0] + f" tail{i}" for i in range(40)]  # a hot group of near copies
    docs += [docs[1]] * 30  # and one of exact copies
    docs += [d.replace("w1 ", "x ") for d in docs[2:8]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in dedup.near_duplicate_groups(df, "doc_id", "text", 0.85).collect()}
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if _jaccard(docs[i], docs[j]) >= 0.85:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    roots = [find(i) for i in range(len(docs))]
    want = {i: r for i, r in enumerate(roots) if roots.count(r) > 1}
    assert got == want


def test_near_duplicates_in_chains_and_split_buckets(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    text = rng.choices(words, k=200)
    docs = [" ".join(text[i * 4:i * 4 + 130]) for i in range(17)]  # neighbours are alike, the ends are not
    docs += [" ".join(rng.choices(words, k=60)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    near = {(i, j) for i in range(len(docs)) for j in range(i) if _jaccard(docs[i], docs[j]) >= 0.85}
    assert (1, 0) in near and (16, 0) not in near
    for rows in (500, 3):
        monkeypatch.setattr(dedup, "BUCKET_ROWS", rows)
        got = {r.doc_id: r.group_id for r in dedup.near_duplicate_groups(df, "doc_id", "text", 0.85).collect()}
        assert got == {i: 0 for i in range(17)}


def test_rounding_of_large_amounts(spark):
    df = spark.createDataFrame([(2.0e17,), (1e18,), (-3.0e300,), (1.005,), (2.5,), (None,)], "v double")
    got = [r[0] for r in df.select(half_up(F.col("v"), 2)).collect()]
    assert got == [2.0e17, 1e18, -3.0e300, 1.0, 2.5, None]


def test_links_are_linear_in_the_group(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3
    df = spark.createDataFrame([(i, text + f"t{i}") for i in range(150)], "doc_id long, text string")
    # all pairs would be about 75 per text; a link needs a leader of one of the bands
    assert dedup.near_duplicate_links(df, "doc_id", "text", 0.85).count() <= 150 * 25


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}


def test_reachability_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "source long, target long")
    start = spark.createDataFrame([(1,)], "node long")
    assert {r.node: r.hops for r in graph.reachable(edges, start, 9).collect()} == {2: 1, 3: 2, 4: 3}


def test_drift_of_a_sample_with_itself_is_zero(spark):
    base = spark.range(200).select(F.lit("base").alias("side"), F.lit("f").alias("feature"), (F.col("id") % 17).cast("double").alias("value"))
    both = base.unionByName(base.withColumn("side", F.lit("current")))
    assert abs(monitoring.psi(both).first().psi) < 1e-12
    assert abs(monitoring.jensen_shannon(both).first().js) < 1e-12
    ks = monitoring.kolmogorov_smirnov(both, 1.0).first()
    assert ks.ks == 0 and ks.p_value == 1


def test_p_values(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (18.307038053275146, 10), (2.0, 2)], "s double, k long")
    got = [r[0] for r in df.select(stats.chi2_sf("s", "k")).collect()]
    assert all(math.isclose(g, w, rel_tol=1e-9) for g, w in zip(got, [0.05, 0.05, math.exp(-1)]))
    p = spark.range(1).select(stats.kolmogorov_sf(F.lit(0.1358), F.lit(200.0), F.lit(200.0))).first()[0]
    assert math.isclose(p, 0.05, abs_tol=0.002)


def test_titles_and_page_marks(spark):
    texts = ["intro\n# First heading \n# Second", "#no heading\nbody", "", "a\n- 12 -\nb"]
    got = spark.createDataFrame(enumerate(texts), "id int, text string").select(
        "id", X.title(F.col("text")).alias("title"), X.clean(F.col("text")).alias("clean")).orderBy("id").collect()
    assert [r.title for r in got] == ["First heading", "#no heading", "", "a"]
    assert got[3].clean == "a\n\nb"


def test_every_vector_query_is_fused(t):
    from lakeloom.catalog import texts

    labels = {r.label for r in t.embeddings.select("label").distinct().collect()}
    for run in (texts.rrf_all, texts.weighted_all):
        got = run(t).collect()
        assert {r.query_id for r in got} == labels and len(got) == 10 * len(labels)
    asked = {r.query_id for r in texts._hybrid_all(t, 20)[1].select("query_id").distinct().collect()}
    assert asked == labels
