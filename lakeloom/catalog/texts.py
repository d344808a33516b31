"""Text, retrieval, vectors (2.17)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from lakeloom.functions import text as X
from lakeloom.functions.split import digest100
from lakeloom.operators import chunking as K
from lakeloom.operators import dedup as D
from lakeloom.operators import monitoring as N
from lakeloom.operators import retrieval as R
from lakeloom.plans import durable, ordered, skew
from lakeloom.registry import query

TOK = f"list_filter(regexp_split_to_array(lower(text), '{X.WORD}'), lambda w: w <> '')"


def _replace_chain(col: str, steps) -> str:
    for pattern, into in steps:
        col = f"regexp_replace({col}, '{pattern}', {into}, 'g')"
    return col


CLEAN_SQL = "trim(" + _replace_chain("text", [
    ("(?i)page [0-9]+ of [0-9]+", "''"), ("- [0-9]+ -", "''"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "''"), (X.TRACKING, "''"),
    (r"(?m)^[ |\t-]*\|[ |\t-]*$", "''"), (r"[ \t]+", "' '"), (r"\n{3,}", "chr(10) || chr(10)")]) + ")"


@query("txt_01_clean", f"SELECT doc_id, length(c) AS chars, md5(c) AS digest FROM (SELECT doc_id, {CLEAN_SQL} AS c FROM (SELECT doc_id, text || '   x?ref=1' || chr(10) || chr(10) || chr(10) || '- 4 -' || chr(10) || 'Page 3 of 9' AS text FROM documents))")
def clean(t):
    noisy = F.concat("text", F.lit("   x?ref=1\n\n\n- 4 -\nPage 3 of 9"))
    return t.spread("documents", "doc_id").select("doc_id", X.clean(noisy).alias("c")).select("doc_id", F.length("c").cast("bigint").alias("chars"), F.md5("c").alias("digest"))


@query("txt_02_metadata", f"""
SELECT doc_id, coalesce(nullif(trim(regexp_extract(text, '{X.HEADING}', 1)), ''), split_part(text, chr(10), 1)) AS title,
 nullif(regexp_extract(text, '{X.ANY_DATE}'), '') AS first_date, length(text) AS chars, len(string_split(text, chr(10))) AS lines,
 len({TOK}) AS words, CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'copyright') THEN 'legal' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, '$') THEN 'finance' ELSE 'general' END AS category FROM documents
""")
def metadata(t):
    low, x = F.lower("text"), F.col("text")
    category = (F.when(low.contains("license") | low.contains("copyright"), "legal").when(x.contains("@"), "contact").when(x.contains("$"), "finance").otherwise("general"))
    return t.spread("documents", "doc_id").select(
        "doc_id", X.title(x).alias("title"), F.nullif(F.regexp_extract("text", X.ANY_DATE, 0), F.lit("")).alias("first_date"),
        F.length("text").cast("bigint").alias("chars"), F.size(F.split("text", "\n")).cast("bigint").alias("lines"),
        F.size(X.tokens(x)).cast("bigint").alias("words"), category.alias("category"))


@query("txt_03_fixed_chunks", """
WITH c AS (SELECT doc_id, text, greatest(0, ceil((length(text) - 1000) / 800))::INT AS last FROM documents WHERE length(text) > 0)
SELECT doc_id, (last + 1)::INT AS total_chunks, i::INT AS chunk_index, md5(substr(text, i * 800 + 1, 1000)) AS digest FROM c, LATERAL (SELECT unnest(range(0, last + 1)) AS i)
""")
def fixed(t):
    out = K.fixed_chunks(t.spread("documents", "doc_id"), ["doc_id"], "text")
    return out.select("doc_id", "total_chunks", "chunk_index", F.md5("content").alias("digest"))


@query("txt_04_recursive_chunks")
def recursive(t):
    """Per document: chunks, longest chunk and whether the chunks joined are the text again."""
    chunks = K.recursive_chunks(t.spread("documents", "doc_id"), "doc_id", "text")
    joined = chunks.groupBy("doc_id").agg(
        F.count("*").alias("chunks"), F.max(F.length("content")).alias("longest"),
        F.sort_array(F.collect_list(F.struct("chunk_index", "content"))).alias("cs"))
    same = F.md5(F.array_join(F.transform("cs", lambda c: c["content"]), "")) == F.md5("text")
    return joined.join(t.spread("documents", "doc_id"), "doc_id").select("doc_id", "chunks", "longest", same.alias("complete"))


def _page_text(t):
    html = F.col("html")
    for lv in (1, 2, 3):
        html = F.regexp_replace(html, f"(?s)<h{lv}[^>]*>(.*?)</h{lv}>", "\n" + "#" * lv + " $1\n")
    html = F.regexp_replace(F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", ""), r"</p>|</li>|<br/?>", "\n")
    return t.spread("pages", "page_id").select("page_id", F.regexp_replace(html, "<[^>]+>", "").alias("text"))


_PAGE = "html"
for _lv in (1, 2, 3):
    _PAGE = f"regexp_replace({_PAGE}, '(?s)<h{_lv}[^>]*>(.*?)</h{_lv}>', chr(10) || '{'#' * _lv} ' || '\\1' || chr(10), 'g')"
_PAGE = f"regexp_replace({_PAGE}, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
_PAGE = f"regexp_replace(regexp_replace({_PAGE}, '</p>|</li>|<br/?>', chr(10), 'g'), '<[^>]+>', '', 'g')"


@query("txt_05_header_chunks", f"""
WITH p AS (SELECT page_id, string_split({_PAGE}, chr(10)) AS ls FROM pages), l AS (SELECT page_id, generate_subscripts(ls, 1) AS no, unnest(ls) AS line FROM p),
 t AS (SELECT *, length(regexp_extract(line, '^(#{{1,3}}) ', 1)) AS lv, regexp_replace(line, '^#{{1,3}} ', '') AS title FROM l),
 s AS (SELECT *, sum((lv > 0)::INT) OVER w AS section, max(CASE WHEN lv = 1 THEN no END) OVER w AS n1, max(CASE WHEN lv = 2 THEN no END) OVER w AS n2, max(CASE WHEN lv = 3 THEN no END) OVER w AS n3
  FROM t WINDOW w AS (PARTITION BY page_id ORDER BY no ROWS UNBOUNDED PRECEDING)),
 b AS (SELECT page_id, section, any_value(n1) AS n1, any_value(n2) AS n2, any_value(n3) AS n3, string_agg(line, chr(10) ORDER BY no) AS content FROM s WHERE lv = 0 GROUP BY 1, 2)
SELECT b.page_id, section::BIGINT AS section, a.title AS h1, c.title AS h2, d.title AS h3, md5(content) AS digest FROM b
LEFT JOIN t a ON a.page_id = b.page_id AND a.no = n1 LEFT JOIN t c ON c.page_id = b.page_id AND c.no = n2 AND n2 > coalesce(n1, 0)
LEFT JOIN t d ON d.page_id = b.page_id AND d.no = n3 AND n3 > greatest(coalesce(n1, 0), coalesce(n2, 0)) WHERE trim(content) <> ''
""")
def headers(t):
    return K.header_chunks(_page_text(t), "page_id", "text").select("page_id", "section", "h1", "h2", "h3", F.md5("content").alias("digest"))


@query("txt_06_token_chunks", f"""
WITH k AS (SELECT doc_id, {TOK} AS tk FROM documents), c AS (SELECT *, greatest(0, ceil((len(tk) - 256) / 226))::INT AS last FROM k WHERE len(tk) > 0)
SELECT doc_id, (last + 1)::INT AS total_chunks, i::INT AS chunk_index, md5(array_to_string(tk[i * 226 + 1 : i * 226 + 256], ' ')) AS digest FROM c, LATERAL (SELECT unnest(range(0, last + 1)) AS i)
""")
def token(t):
    return K.token_chunks(t.spread("documents", "doc_id"), ["doc_id"], "text").select("doc_id", "total_chunks", "chunk_index", F.md5("content").alias("digest"))


HASH_SQL = r"sha256(trim(regexp_replace(lower(text), '\s+', ' ', 'g')))"


@query("txt_07_exact_copies", f"SELECT doc_id, min(doc_id) OVER (PARTITION BY {HASH_SQL}) AS keep_id FROM documents")
def copies(t):
    return D.exact_copies(t.spread("documents", "doc_id"), "doc_id", "text")


NEAR_SQL = f"""
WITH RECURSIVE k AS (SELECT doc_id, {HASH_SQL} AS h, {TOK} AS w FROM documents),
 u AS (SELECT min(doc_id) AS id, any_value(w) AS w FROM k GROUP BY h),
 s AS (SELECT id, list_distinct(list_transform(range(0, greatest(len(w) - 2, 1)), lambda i: concat_ws(' ', w[i + 1], w[i + 2], w[i + 3]))) AS ss FROM u),
 e AS MATERIALIZED (SELECT id, len(ss) AS n, unnest(ss) AS x FROM s),
 p AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m FROM e a JOIN e b
  ON a.x = b.x AND a.id < b.id AND least(a.n, b.n) >= 0.85 * greatest(a.n, b.n) GROUP BY 1, 2),
 l AS (SELECT a, b FROM p WHERE m::DOUBLE / (na + nb - m) >= 0.85::DOUBLE
  UNION SELECT min(doc_id) OVER (PARTITION BY h) AS a, doc_id AS b FROM k QUALIFY a < b),
 g AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r AS (SELECT a AS node, b AS other FROM g UNION SELECT r.node, g.b FROM r JOIN g ON g.a = r.other)
SELECT node AS doc_id, least(node, min(other)) AS group_id FROM r GROUP BY node
"""


@query("txt_08_near_duplicate_groups", NEAR_SQL)
def near(t):
    return D.near_duplicate_groups(t.spread("documents", "doc_id"), "doc_id", "text", 0.85)


@query("txt_09_chunk_table", """
WITH c AS (SELECT doc_id, source, text, greatest(0, ceil((length(text) - 500) / 400))::INT AS last FROM documents WHERE length(text) > 0)
SELECT doc_id || '-' || i AS chunk_id, doc_id AS parent_doc_id, i::INT AS chunk_index, (last + 1)::INT AS total_chunks, source, length(substr(text, i * 400 + 1, 500)) AS chars FROM c, LATERAL (SELECT unnest(range(0, last + 1)) AS i)
""")
def chunk_table(t):
    out = K.fixed_chunks(t.spread("documents", "doc_id"), ["doc_id", "source"], "text", 500, 100)
    return out.select(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"), F.col("doc_id").alias("parent_doc_id"),
                      "chunk_index", "total_chunks", "source", F.length("content").cast("bigint").alias("chars"))


@query("txt_10_semantic_breakpoints", """
WITH d AS (SELECT label, vec_id, 1 - list_cosine_similarity(embedding::DOUBLE[], lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id)) AS dist FROM embeddings),
 q AS (SELECT label, quantile_cont(dist, 0.95) AS p95 FROM d GROUP BY 1)
SELECT label, vec_id, round(dist, 6) AS dist, (sum((coalesce(dist > p95, false))::INT) OVER (PARTITION BY label ORDER BY vec_id ROWS UNBOUNDED PRECEDING))::BIGINT AS segment FROM d JOIN q USING (label)
""")
def breakpoints(t):
    """The vectors of a label, by id, play the sentences of a document."""
    base = t.embeddings.select("label", "vec_id", R.as_doubles(F.col("embedding")).alias("v"))
    seen = ordered.scan(base, ["label"], ["vec_id"], before={"prev": F.col("v")})
    dist = durable.cut(seen.select("label", "vec_id", (1 - R.cosine(F.col("v"), F.col("prev"))).alias("dist")), "distances")
    p95 = ordered.exact_quantiles(dist, ["label"], "dist", {"p95": 0.95})
    cut = dist.join(p95, "label", "left").withColumn("b", F.coalesce(F.col("dist") > F.col("p95"), F.lit(False)).cast("bigint"))
    out = ordered.scan(cut, ["label"], ["vec_id"], sums={"segment": F.col("b")})
    return out.select("label", "vec_id", F.round("dist", 6).alias("dist"), "segment")


VQ = "q AS (SELECT label::BIGINT AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS qv FROM embeddings GROUP BY 1)"


def _vector_queries(t):
    return t.embeddings.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("qvec"))


def _vsearch(k: int, where: str = "true") -> str:
    return f"""v AS (SELECT query_id, vec_id, label, list_cosine_similarity(embedding::DOUBLE[], qv) AS score,
 row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(embedding::DOUBLE[], qv) DESC, vec_id) AS rank FROM embeddings, q WHERE {where} QUALIFY rank <= {k})"""


@query("txt_11_vector_top_k", f"WITH {VQ}, {_vsearch(10)} SELECT query_id, vec_id, round(score, 6) AS score, rank FROM v")
def vector_search(t):
    return R.vector_top_k(t.embeddings, _vector_queries(t), "vec_id", "embedding", 10).withColumn("score", F.round("score", 6))


@query("txt_11b_lsh_vector_top_k")
def lsh_search(t):
    """Every twentieth vector against all, through buckets of random projections widened to a recall of 0.95."""
    asked = t.embeddings.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))
    return R.lsh_top_k(t.embeddings, asked, "vec_id", "embedding", 10).withColumn("score", F.round("score", 6))


@query("txt_12_filtered_vector_search", f"WITH {VQ}, {_vsearch(5, 'label IN (1, 3, 5)')} SELECT query_id, vec_id, round(score, 6) AS score, rank FROM v")
def filtered_search(t):
    some = t.embeddings.filter(F.col("label").isin(1, 3, 5))
    return R.vector_top_k(some, _vector_queries(t), "vec_id", "embedding", 5).withColumn("score", F.round("score", 6))


TEXT_QUERIES = {0: "the table and thing", 1: "oning erthe ti", 2: "la des est", 3: "der die und"}


def _bm25(k: int, asked: str = "") -> str:
    terms = ", ".join(f"({q}, '{w}')" for q, s in TEXT_QUERIES.items() for w in sorted(set(s.split())))
    asked = asked or f"FROM (VALUES {terms}) x(query_id, term)"
    return f"""tk AS (SELECT doc_id, {TOK} AS w FROM documents), st AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM tk), qt AS ({asked}),
 tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM tk) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3),
 df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
 sc AS (SELECT query_id::BIGINT AS query_id, doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl)))), 9) AS score
  FROM tf JOIN df USING (term) JOIN qt USING (term), st GROUP BY 1, 2),
 bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc QUALIFY rank <= {k})"""


def _keyword(t, k):
    return R.bm25_top_k(t.spread("documents", "doc_id"), TEXT_QUERIES, "doc_id", "text", k).withColumn("query_id", F.col("query_id").cast("bigint"))


@query("txt_13_bm25", f"WITH {_bm25(10)} SELECT query_id, doc_id, round(score, 6) AS score, rank FROM bm")
def bm25(t):
    return _keyword(t, 10).withColumn("score", F.round("score", 6))


def _hybrid(t, k):
    """The vector of id n belongs to document n; vector query n is paired with text query n."""
    vectors = R.vector_top_k(t.embeddings, _vector_queries(t).filter("query_id < 4"), "vec_id", "embedding", k)
    return vectors.withColumnRenamed("vec_id", "doc_id"), _keyword(t, k)


HYBRID = f"{VQ}, {_vsearch(20, 'query_id < 4')}, {_bm25(20)}"


@query("txt_14_reciprocal_rank_fusion", f"""
WITH {HYBRID}, u AS (SELECT query_id, vec_id AS doc_id, 0.5::DOUBLE / (60 + rank) AS s FROM v UNION ALL SELECT query_id, doc_id, 0.5::DOUBLE / (60 + rank) FROM bm),
 f AS (SELECT query_id, doc_id, round(sum(s), 12) AS score FROM u GROUP BY 1, 2)
SELECT query_id, doc_id, round(score, 8) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f QUALIFY rank <= 10
""")
def rrf(t):
    v, b = _hybrid(t, 20)
    return R.reciprocal_rank_fusion([(v, 0.5), (b, 0.5)], "doc_id", 10).withColumn("score", F.round("score", 8))


@query("txt_15_weighted_fusion", f"""
WITH {HYBRID}, a AS (SELECT query_id, vec_id AS doc_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) * 0.6::DOUBLE AS s FROM v WINDOW w AS (PARTITION BY query_id)),
 b AS (SELECT query_id, doc_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) * 0.4::DOUBLE AS s FROM bm WINDOW w AS (PARTITION BY query_id)),
 f AS (SELECT query_id, doc_id, round(sum(s), 9) AS score FROM (FROM a UNION ALL FROM b) GROUP BY 1, 2)
SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f QUALIFY rank <= 10
""")
def weighted(t):
    v, b = _hybrid(t, 20)
    return R.weighted_fusion([(v, 0.6), (b, 0.4)], "doc_id", 10).withColumn("score", F.round("score", 6))


FIRST_WORDS = f"SELECT query_id, unnest(list_distinct(({TOK})[1:8])) AS term FROM (SELECT label::BIGINT AS query_id, min(vec_id) AS doc_id FROM embeddings GROUP BY 1) JOIN documents USING (doc_id)"
HYBRID_ALL = f"{VQ}, {_vsearch(20)}, {_bm25(20, FIRST_WORDS)}"


def _hybrid_all(t, k):
    """Every vector query; its text query is the first eight words of the document that its vector belongs to."""
    firsts = t.embeddings.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(F.min("vec_id").alias("doc_id"))
    asked = t.documents.join(skew.checked_broadcast(firsts), "doc_id").select("query_id", F.slice(X.tokens(F.col("text")), 1, 8).alias("words"))
    terms = asked.select("query_id", F.explode(F.array_distinct("words")).alias("term"))
    vectors = R.vector_top_k(t.embeddings, _vector_queries(t), "vec_id", "embedding", k).withColumnRenamed("vec_id", "doc_id")
    return vectors, R.bm25_of_terms(t.spread("documents", "doc_id"), terms, "doc_id", "text", k)


@query("txt_14b_rank_fusion_of_all_queries", f"""
WITH {HYBRID_ALL}, u AS (SELECT query_id, vec_id AS doc_id, 0.5::DOUBLE / (60 + rank) AS s FROM v UNION ALL SELECT query_id, doc_id, 0.5::DOUBLE / (60 + rank) FROM bm),
 f AS (SELECT query_id, doc_id, round(sum(s), 12) AS score FROM u GROUP BY 1, 2)
SELECT query_id, doc_id, round(score, 8) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f QUALIFY rank <= 10
""")
def rrf_all(t):
    v, b = _hybrid_all(t, 20)
    return R.reciprocal_rank_fusion([(v, 0.5), (b, 0.5)], "doc_id", 10).withColumn("score", F.round("score", 8))


@query("txt_15b_weighted_fusion_of_all_queries", f"""
WITH {HYBRID_ALL}, a AS (SELECT query_id, vec_id AS doc_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) * 0.6::DOUBLE AS s FROM v WINDOW w AS (PARTITION BY query_id)),
 b AS (SELECT query_id, doc_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) * 0.4::DOUBLE AS s FROM bm WINDOW w AS (PARTITION BY query_id)),
 f AS (SELECT query_id, doc_id, round(sum(s), 9) AS score FROM (FROM a UNION ALL FROM b) GROUP BY 1, 2)
SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f QUALIFY rank <= 10
""")
def weighted_all(t):
    v, b = _hybrid_all(t, 20)
    return R.weighted_fusion([(v, 0.6), (b, 0.4)], "doc_id", 10).withColumn("score", F.round("score", 6))


@query("txt_16_recency", """
WITH d AS (SELECT doc_id, (doc_id * 37) % 365 AS age FROM documents) SELECT doc_id, (DATE '2024-12-31' - age::INT)::DATE::VARCHAR AS updated_at, round(exp(-age / 90.0::DOUBLE), 6) AS weight FROM d WHERE age <= 180
""")
def recency(t):
    age = (F.col("doc_id") * 37) % 365
    d = t.documents.select("doc_id", age.alias("age"), F.date_sub(F.lit("2024-12-31").cast("date"), age.cast("int")).alias("updated_at"))
    fresh = d.filter(F.col("updated_at") >= F.date_sub(F.lit("2024-12-31").cast("date"), 180))
    return fresh.select("doc_id", "updated_at", F.round(F.exp(-F.col("age") / 90.0), 6).alias("weight"))


@query("txt_17_retrieval_evaluation", f"""
WITH {VQ}, {_vsearch(10)}, n AS (SELECT label::BIGINT AS query_id, count(*) AS rel FROM embeddings GROUP BY 1),
 h AS (SELECT query_id, count(*) AS hits, min(rank) AS first, sum(1 / log2(rank + 1)) AS dcg FROM v WHERE label = query_id GROUP BY 1)
SELECT query_id, coalesce(hits, 0) / 10 AS precision, round(coalesce(hits, 0) / rel, 6) AS recall, coalesce(1 / first, 0) AS mrr,
 round(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(rel, 10) + 1), lambda i: 1 / log2(i + 1))), 6) AS ndcg FROM n LEFT JOIN h USING (query_id)
""")
def evaluation(t):
    ranked = R.vector_top_k(t.embeddings, _vector_queries(t), "vec_id", "embedding", 10)
    truth = t.embeddings.select(F.col("label").cast("bigint").alias("query_id"), "vec_id")
    return R.evaluate(ranked, truth, "vec_id", 10).withColumns({c: F.round(c, 6) for c in ("recall", "ndcg")})


@query("txt_18_classification")
def classification(t):
    """Quality label from weighted word counts: trained on most labelled texts, measured on the rest."""
    rows = t.spread("documents", "doc_id").join(t.labels, "doc_id").select("doc_id", X.tokens(F.col("text")).alias("words"), F.col("quality").cast("double").alias("label"))
    part = digest100("doc_id") < 80
    model = Pipeline(stages=[
        HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 12), IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(maxIter=10, regParam=0.1)]).fit(rows.filter(part))
    scored = model.transform(rows.filter(~part))
    keyword = ~F.arrays_overlap("words", F.array(*[F.lit(w) for w in ("click", "buy", "free")]))
    both = scored.withColumn("m", F.explode(F.array(
        F.struct(F.lit("model").alias("method"), (F.col("prediction") == 1).alias("p")), F.struct(F.lit("keywords").alias("method"), keyword.alias("p")))))
    out = N.confusion(both.select("label", "m.*"), ["method"], F.col("label") == 1, F.col("p"))
    return out.select("method", "tp", "fp", "fn", "tn", F.round("accuracy", 4).alias("accuracy"))


FIELDS = {"dates": X.DATE, "amounts": X.AMOUNT, "emails": X.PII["email"], "phones": X.PII["phone"]}


@query("txt_19_field_extraction", "SELECT doc_id, " + ", ".join(f"array_to_string(regexp_extract_all(text, '{p}'), ',') AS {n}" for n, p in FIELDS.items()) + " FROM documents")
def extraction(t):
    return t.spread("documents", "doc_id").select("doc_id", *[F.array_join(F.regexp_extract_all("text", F.lit(p), F.lit(0)), ",").alias(n) for n, p in FIELDS.items()])


@query("txt_20_extractive_summary", f"""
WITH l AS (SELECT doc_id, regexp_split_to_array(text, '[.!?]\\s+') AS ss FROM documents), s AS (SELECT doc_id, generate_subscripts(ss, 1) - 1 AS pos, unnest(ss) AS text FROM l),
 w AS (SELECT doc_id, pos, unnest({TOK}) AS w FROM s), df AS (SELECT w, count(DISTINCT doc_id) AS df FROM w GROUP BY 1),
 sc AS (SELECT doc_id, pos, round(sum(tf * ln((SELECT count(*) FROM documents) / df)) / sum(tf), 6) AS score FROM (SELECT doc_id, pos, w, count(*) AS tf FROM w GROUP BY ALL) JOIN df USING (w) GROUP BY 1, 2),
 r AS (SELECT doc_id, pos FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 3)
SELECT doc_id, md5(string_agg(text, '. ' ORDER BY pos)) AS digest FROM s JOIN r USING (doc_id, pos) GROUP BY 1
""")
def summary(t):
    return R.extractive_summary(t.spread("documents", "doc_id"), "doc_id", "text", 3).select("doc_id", F.md5("summary").alias("digest"))


@query("txt_21_context_windows", """
SELECT conv_id, turn, role, md5(coalesce(string_agg(role || ': ' || text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '')) AS digest FROM conversations
""")
def context(t):
    out = R.context_windows(t.conversations, "conv_id", "turn", "role", "text", 3)
    return out.select("conv_id", "turn", "role", F.md5(F.array_join("context", "\n")).alias("digest"))


@query("txt_22_query_fan_out", f"""
WITH {_bm25(10)} SELECT query_id // 2 AS topic, doc_id, min(rank) AS best_rank FROM bm GROUP BY 1, 2
""")
def fan_out(t):
    return _keyword(t, 10).groupBy(F.expr("query_id div 2").alias("topic"), "doc_id").agg(F.min("rank").cast("bigint").alias("best_rank"))


@query("txt_23_keyword_mentions", f"""
WITH m AS (SELECT source, unnest({TOK}) AS word FROM documents) SELECT source, word, count(*) AS mentions FROM m WHERE length(word) > 2 GROUP BY 1, 2 ORDER BY mentions DESC, source, word LIMIT 20
""")
def mentions(t):
    words = t.spread("documents", "doc_id").select("source", X.each_token(F.col("text")).alias("word")).filter(F.length("word") > 2)
    return words.groupBy("source", "word").agg(F.count("*").alias("mentions")).orderBy(F.desc("mentions"), "source", "word").limit(20)
