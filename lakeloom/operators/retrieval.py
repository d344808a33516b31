"""Vector, keyword and hybrid search, their fusion and evaluation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakeloom.functions.text import tokens
from lakeloom.plans import durable, ordered, skew

K1, B = 1.2, 0.75
RRF_CONSTANT = 60
QUERIES_PER_BLOCK = 1000
ROWS_PER_TILE, LEAST_ROWS_PER_TILE, QUERIES_PER_TILE = 65_536, 4_096, 16_384


def as_doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_top_k(vectors: DataFrame, queries: DataFrame, key: str, vec: str, k: int) -> DataFrame:
    """Exact cosine top-k per query (query_id, qvec).

    Queries are packed ``QUERIES_PER_BLOCK`` to a row; a vector meets each block once and a task keeps its own best k per query before
    anything is sent. A few blocks travel to the vectors by their size; many are joined on block and a salt of the vector's key, so that a
    block is not one task.
    """
    qs = queries.select("query_id", as_doubles(F.col("qvec")).alias("q"))
    blocks = F.greatest(F.lit(1), F.ceil(qs.agg(F.count("*")).scalar() / QUERIES_PER_BLOCK)).cast("int")
    packed = qs.groupBy(F.pmod(F.xxhash64("query_id"), blocks).cast("int").alias("__block")).agg(
        F.collect_list(F.struct("query_id", "q")).alias("__asked"))
    rows = vectors.select(key, as_doubles(F.col(vec)).alias("__v")).withColumn("__block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = skew.salted_join(rows, packed, ["__block"], [key]).withColumn("__q", F.explode("__asked"))
    scored = met.select(F.col("__q.query_id").alias("query_id"), key, cosine(F.col("__v"), F.col("__q.q")).alias("score"))
    return skew.top_per_key(scored, ["query_id"], [F.desc("score"), F.asc(key)], k, "rank")


def recall(found: DataFrame, exact: DataFrame, key: str) -> float:
    """Share of the exact pairs (query_id, key) that were found."""
    both = exact.select("query_id", key).join(found.select("query_id", key).withColumn("__hit", F.lit(1)), ["query_id", key], "left")
    return both.agg(F.coalesce(F.avg(F.coalesce("__hit", F.lit(0))), F.lit(1.0))).first()[0]


def lsh_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    key: str,
    vec: str,
    k: int,
    target: float = 0.95,
    sample: int = 64,
    most_tables: int = 64,
    report: list[tuple[int, float, float]] | None = None,
) -> DataFrame:
    """Cosine top-k per query among the vectors that share a bucket of random projections with it.

    The tables (up to ``most_tables``), then the width of their buckets are doubled until ``sample`` of the queries, picked by hash, find
    ``target`` of their exact neighbours; the exact search is for these few only, unless no setting meets the target: then it answers all
    queries. A try hashes these queries and neighbours alone. Vectors without a direction are left out. The pairs to compare are as many as
    buckets hold, of vectors without structure nearly all; tasks compare them in tiles. ``report`` receives (tables, width, recall) of each try.
    """
    rows = durable.cut(_unit(vectors.select(key, F.col(vec).alias("__v"))), "lsh-rows")
    asked = durable.cut(_unit(queries.select("query_id", F.col("qvec").alias("__v"))), "lsh-queries")
    few = asked.withColumn("__h", F.xxhash64("query_id")).orderBy("__h").limit(sample).drop("__h")
    few = durable.cut(few, "lsh-sample")
    # a neighbour is found if it shares a bucket with its query, as all that it is compared with are no nearer than in the exact search
    exact = _in_tiles(_one_bucket(rows), _one_bucket(few), key, k).select("query_id", key)
    exact = exact.join(rows, key, "left").withColumnRenamed("__v", "__near").join(few, "query_id", "left")
    exact = durable.cut(exact.select(F.coalesce("__near", "__v").alias("__near"), "__v", F.col("__near").isNull().alias("__lost")), "lsh-exact")
    tables, width = 4, 0.25
    while True:
        model = BucketedRandomProjectionLSH(
            inputCol="__f", outputCol="__h", numHashTables=tables, bucketLength=width, seed=17).fit(_features(rows))
        pairs = _hashed(model, _hashed(model, exact, "__asked").drop("__v").withColumnRenamed("__near", "__v"), "__own")
        hit = F.exists(F.arrays_zip("__own", "__asked"), lambda x: x["__own"] == x["__asked"]) & ~F.col("__lost")
        got = pairs.agg(F.coalesce(F.avg(hit.cast("int")), F.lit(1.0))).first()[0]
        if report is not None:
            report.append((tables, width, got))
        if got >= target:
            return _in_tiles(_buckets(model, rows), _buckets(model, asked), key, k)
        if width > 1:  # projections of unit vectors are at most 1, so wider buckets are no different
            return _in_tiles(_one_bucket(rows), _one_bucket(asked), key, k)
        tables, width = (tables * 2, width) if tables < most_tables else (4, width * 2)


def _unit(df: DataFrame) -> DataFrame:
    """Vectors of length 1, null or zero ones and those with components that are not finite left out."""
    v = F.col("__v")
    df = df.withColumn("__v", as_doubles(v)).filter(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return df.withColumn("__n", F.sqrt(dot(v, v))).filter("__n > 0").withColumn("__v", F.transform("__v", lambda x: x / F.col("__n"))).drop("__n")


def _features(df: DataFrame) -> DataFrame:
    return df.withColumn("__f", array_to_vector("__v"))


def _hashed(model, df: DataFrame, name: str) -> DataFrame:
    hashed = model.transform(_features(df)).drop("__f")
    return hashed.withColumn(name, F.transform("__h", lambda x: vector_to_array(x)[0].cast("long"))).drop("__h")


def _buckets(model, df: DataFrame) -> DataFrame:
    return _hashed(model, df, "__own").select("*", F.posexplode("__own").alias("__table", "__bucket"))


def _one_bucket(df: DataFrame) -> DataFrame:
    return df.select("*", F.array(F.lit(0).cast("long")).alias("__own"), F.lit(0).alias("__table"), F.lit(0).cast("long").alias("__bucket"))


def _in_tiles(rows: DataFrame, asked: DataFrame, key: str, k: int) -> DataFrame:
    """Cosine top-k per query among the vectors in its buckets; all are of length 1, so the inner product is the cosine.

    A bucket is cut into tiles of at most about ROWS_PER_TILE vectors and QUERIES_PER_TILE queries, so a task holds one tile, however large a
    bucket. A pair that meets in several tables counts in the first one.
    """
    place = ["__table", "__bucket"]
    sizes = rows.groupBy(place).agg(F.count("*").alias("__n")).join(asked.groupBy(place).agg(F.count("*").alias("__m")), place)
    # few buckets of unit vectors: their projections are at most 1; small buckets are cut too, so that no task gets half of the pairs
    per_tile = F.least(F.lit(ROWS_PER_TILE), F.greatest(F.lit(LEAST_ROWS_PER_TILE), F.ceil(F.col("__n") / 32)))
    sizes = durable.cut(sizes.select(*place, F.ceil(F.col("__n") / per_tile).alias("__salts"),
                                     F.ceil(F.col("__m") / QUERIES_PER_TILE).alias("__blocks")), "lsh-sizes")

    def cut(df: DataFrame, row: str, own: str, every: str, ours: str, others: str) -> DataFrame:
        return df.join(F.broadcast(sizes), place).withColumn(ours, F.pmod(F.xxhash64(row, "__v"), F.col(own))).withColumn(
            others, F.explode(F.sequence(F.lit(0).cast("long"), F.col(every) - 1))).drop("__salts", "__blocks")

    tile = [*place, "__salt", "__block"]
    left = cut(rows, key, "__salts", "__blocks", "__salt", "__block").groupBy(tile)
    right = cut(asked, "query_id", "__blocks", "__salts", "__block", "__salt").groupBy(tile)
    schema = StructType([asked.schema["query_id"], rows.schema[key], StructField("score", DoubleType())])
    scored = left.cogroup(right).applyInArrow(lambda a, b: _tile_top_k(a, b, key, k), schema)
    return skew.top_per_key(scored, ["query_id"], [F.desc("score"), F.asc(key)], k, "rank")


def _tile_top_k(rows: pa.Table, asked: pa.Table, key: str, k: int) -> pa.Table:
    """query_id, key, score of the k best rows of each query of a tile, without those that share a bucket in an earlier table.

    A pair among the best of all is among the best of the tile where it first meets, so earlier pairs may be left out after the choice. Single
    precision chooses with a margin above its error; the scores are sums in double precision, in the order of the components.
    """
    found = pa.schema([asked.schema.field("query_id"), rows.schema.field(key), pa.field("score", pa.float64())])
    if not rows.num_rows or not asked.num_rows:
        return found.empty_table()
    table = rows.column("__table")[0].as_py()
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(key, "ascending")], null_placement="at_start"))
    v, q = _matrix(rows, "__v"), _matrix(asked, "__v")
    # of equal vectors only the first k by key can be among the best
    same = np.unique(v.view(np.dtype((np.void, v.dtype.itemsize * v.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    order = np.argsort(same, kind="stable")
    first = np.searchsorted(same[order], same[order])
    kept = np.sort(order[np.arange(len(order)) - first < k])
    rows, v = rows.take(kept), v[kept]
    own, their = _matrix(rows, "__own"), _matrix(asked, "__own")
    low, margin = np.ascontiguousarray(v.T, np.float32), 4 * (v.shape[1] + 4) * float(np.finfo(np.float32).eps)
    out = []
    for i in range(0, len(q), max(1, 4_000_000 // len(v))):
        part = q[i:i + max(1, 4_000_000 // len(v))]
        rough = part.astype(np.float32) @ low
        least = np.partition(rough, len(v) - k, 1)[:, len(v) - k] if len(v) > k else np.full(len(part), -np.inf, np.float32)
        at, row = np.nonzero(rough >= (least - np.float32(margin))[:, None])
        score = np.zeros(len(at))
        for j in range(v.shape[1]):
            score += v[row, j] * part[at, j]
        best = np.lexsort((row, -score, at))
        at, row, score = at[best], row[best], score[best]
        some = np.flatnonzero((np.arange(len(at)) - np.searchsorted(at, at) < k) & ~(own[row, :table] == their[at + i, :table]).any(1))
        out.append(pa.Table.from_arrays([asked.column("query_id").take(pa.array(at[some] + i)), rows.column(key).take(pa.array(row[some])),
                                         pa.chunked_array([score[some]])], schema=found))
    return pa.concat_tables(out)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    lists = table.column(name).combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def bm25_top_k(docs: DataFrame, queries: dict[int, str], key: str, text: str, k: int) -> DataFrame:
    """BM25 top-k per query; only the words of the queries leave the scan."""
    import re

    terms = [(q, w) for q, s in queries.items() for w in sorted(set(re.findall(r"[^\W_]+", s.lower())))]
    words = sorted({w for _, w in terms})
    base = docs.select(key, tokens(F.col(text)).alias("__t"))
    size = docs.select(F.size(tokens(F.col(text))).alias("n")).agg(F.count("*").alias("docs"), F.avg("n").alias("avgdl"))
    n_docs, avgdl = size.select("docs").scalar(), size.select("avgdl").scalar()
    asked = F.filter("__t", lambda w: w.isin(*words))
    hits = base.select(key, F.size("__t").alias("dl"), F.explode_outer(asked).alias("term")).filter("term IS NOT NULL")
    tf = hits.groupBy(key, "dl", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))  # one row per query word
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    sat = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
    asks = F.create_map(*[x for w in words for x in (F.lit(w), F.array(*[F.lit(q) for q, t in terms if t == w]))])
    weighted = tf.join(df, "term").withColumn("query_id", F.explode(asks[F.col("term")]))
    scored = weighted.groupBy("query_id", key).agg(F.round(F.sum(idf * sat), 9).alias("score"))
    return skew.top_per_key(scored, ["query_id"], [F.desc("score"), F.asc(key)], k, "rank")


def bm25_of_terms(docs: DataFrame, asked: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """BM25 top-k per query, for queries in a table (query_id, term); a term counts once a query."""
    asked = asked.distinct()
    size = docs.select(F.size(tokens(F.col(text))).alias("n")).agg(F.count("*").alias("docs"), F.avg("n").alias("avgdl"))
    n_docs, avgdl = size.select("docs").scalar(), size.select("avgdl").scalar()
    words = docs.select(key, tokens(F.col(text)).alias("__t")).select(key, F.size("__t").alias("dl"), F.explode_outer("__t").alias("term"))
    tf = words.join(skew.checked_broadcast(asked.select("term").distinct()), "term").groupBy(key, "dl", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    sat = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
    scored = tf.join(df, "term").join(asked, "term").groupBy("query_id", key).agg(F.round(F.sum(idf * sat), 9).alias("score"))
    return skew.top_per_key(scored, ["query_id"], [F.desc("score"), F.asc(key)], k, "rank")


def reciprocal_rank_fusion(lists: Sequence[tuple[DataFrame, float]], key: str, k: int) -> DataFrame:
    """Sum of weight / (60 + rank) over ranked lists (query_id, key, rank)."""
    parts = [df.select("query_id", key, (F.lit(w) / (RRF_CONSTANT + F.col("rank"))).alias("__s")) for df, w in lists]
    fused = reduce(lambda a, b: a.unionByName(b), parts).groupBy("query_id", key).agg(F.round(F.sum("__s"), 12).alias("score"))
    return skew.top_per_key(fused, ["query_id"], [F.desc("score"), F.asc(key)], k, "rank")


def weighted_fusion(lists: Sequence[tuple[DataFrame, float]], key: str, k: int) -> DataFrame:
    """Weighted sum of scores after min-max scaling within each list and query."""
    parts = []
    for df, w in lists:
        span = df.groupBy("query_id").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
        scaled = F.coalesce(F.try_divide(F.col("score") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(1.0))
        parts.append(df.join(span, "query_id").select("query_id", key, (scaled * w).alias("__s")))
    fused = reduce(lambda a, b: a.unionByName(b), parts).groupBy("query_id", key).agg(F.round(F.sum("__s"), 9).alias("score"))
    return skew.top_per_key(fused, ["query_id"], [F.desc("score"), F.asc(key)], k, "rank")


def evaluate(ranked: DataFrame, truth: DataFrame, key: str, k: int) -> DataFrame:
    """Precision, recall, reciprocal rank and NDCG at k per query of the truth (query_id, key)."""
    top = ranked.filter(F.col("rank") <= k).join(truth, ["query_id", key])
    hits = top.groupBy("query_id").agg(
        F.count("*").alias("hits"), F.min("rank").alias("first"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    sizes = truth.groupBy("query_id").agg(F.count("*").alias("relevant"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("relevant"), F.lit(k)).cast("int")), F.lit(0.0),
                        lambda s, i: s + 1 / F.log2(i + F.lit(1.0)))
    return sizes.join(hits, "query_id", "left").fillna(0, ["hits", "dcg"]).select(
        "query_id", (F.col("hits") / k).alias("precision"), (F.col("hits") / F.col("relevant")).alias("recall"),
        F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("mrr"), (F.col("dcg") / ideal).alias("ndcg"))


def context_windows(turns: DataFrame, key: str, order: str, role: str, text: str, n: int, block: int = 256) -> DataFrame:
    """Each turn with the ``n`` turns before it, oldest first.

    Turns are numbered, cut into blocks, and the last ``n`` of a block are lent to the next one, so a
    conversation of any length is spread over tasks.
    """
    from pyspark.sql import Window

    numbered = ordered.position(turns, [key], [order], F.floor(F.col(order) / block), "__pos")
    own = F.floor((F.col("__pos") - 1) / block)
    reach = F.floor((F.col("__pos") - 1 + n) / block)
    spread = numbered.withColumn("__own", own).withColumn("__block", F.explode(F.sequence(own, reach)))
    w = Window.partitionBy(key, "__block").orderBy("__pos").rowsBetween(-n, -1)
    said = F.concat_ws(": ", role, text)
    out = spread.withColumn("context", F.collect_list(said).over(w))
    return out.filter("__block = __own").select(key, order, role, text, "context")


FREQUENT = 1_000_000  # words of more than one in so many of all are known to the tasks; there are at most as many


def extractive_summary(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """The ``n`` sentences with the highest mean inverse document frequency, in original order."""
    # a document's distinct words are found in its row, so only counts per word are exchanged
    freq = docs.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    freq = durable.cut(freq, "word-documents")
    idf = F.log(docs.agg(F.count("*")).scalar() / F.col("df"))
    often = F.col("df") * FREQUENT > freq.agg(F.sum("df")).scalar()
    shared = docs.sparkSession.sparkContext.broadcast(freq.filter(often).select("w", idf.alias("idf")).toArrow().combine_chunks())

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per sentence the sum over its frequent words and its number of words, and a row for each of its other words."""
        row = TaskContext.get().partitionId() << 33
        table = shared.value
        frequent, values = pa.array(table.column("w").combine_chunks()), np.append(table.column("idf").to_numpy(), 0.0)
        for batch in batches:
            lists = batch.column("words")
            words, size = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            at = np.repeat(np.arange(len(size)), size)
            code = pc.fill_null(pc.index_in(words, frequent), -1).to_numpy(zero_copy_only=False)
            total = np.bincount(at, values[code], len(size))
            other = np.flatnonzero(code < 0)
            # the sums of a sentence travel with its first other word; without one, with a word that no text has, so that these rows spread too
            bare = np.setdiff1d(np.arange(len(size)), at[other])
            line = np.concatenate([at[other], bare])
            lead = np.concatenate([np.diff(at[other], prepend=-1) > 0, np.ones(len(bare), bool)])
            w = pa.concat_arrays([words.take(pa.array(other)), pa.array([f" {row + i}" for i in bare.tolist()], pa.string())])
            out = pa.RecordBatch.from_arrays([
                batch.column(key).take(pa.array(line)), batch.column("pos").take(pa.array(line)),
                pa.array(np.where(lead, total[line], 0.0)), pa.array(np.where(lead, size[line], 0).astype(np.int64)), w],
                [key, "pos", "total", "words", "w"])
            for i in range(0, out.num_rows, 50_000):
                yield out.slice(i, 50_000)
            row += len(size)

    fields = [docs.schema[key], *(StructField(*f) for f in (("pos", IntegerType()), ("total", DoubleType()), ("words", LongType()), ("w", StringType())))]
    sentences = F.split(text, r"[.!?]\s+")
    cut = docs.filter(F.col(key).isNotNull()).select(key, F.posexplode(sentences).alias("pos", "sentence"))
    met = cut.select(key, "pos", tokens(F.col("sentence")).alias("words")).filter(F.size("words") > 0).mapInArrow(
        known, StructType(fields))
    scored = met.join(freq.filter(~often), "w", "left").groupBy(key, "pos").agg(
        F.round((F.sum("total") + F.coalesce(F.sum(idf), F.lit(0.0))) / F.sum("words"), 6).alias("score"))
    best = skew.top_per_key(scored, [key], [F.desc("score"), F.asc("pos")], n, "rank").groupBy(key).agg(F.collect_list("pos").alias("best"))
    # whole texts meet the numbers of their sentences: one row of a document is exchanged, not one a sentence
    chosen = docs.join(best, key).select(key, "best", F.posexplode(sentences).alias("pos", "sentence")).filter(F.array_contains("best", F.col("pos")))
    ordered_list = F.sort_array(F.collect_list(F.struct("pos", "sentence")))
    return chosen.groupBy(key).agg(F.array_join(F.transform(ordered_list, lambda s: s["sentence"]), ". ").alias("summary"))
