"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    approximation_file, block_rotation, hash_index, line_runs, masked_scorer, means_tree, piece_codec, pivot_clusters, secret_tagger,
    shingle_forest, token_transducer, toxicity, vector_packing,
)
from lakeloom.llm.base import table


def op1_means_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return means_tree.nearest(table(spark, sf_dir, "embeddings"))


def op2_approximation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approximation_file.exact_top_k(table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_transducer.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_shingle_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_forest.similar(table(spark, sf_dir, "documents"))


def op8_secret_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_tagger.secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_masked_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_scorer.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op11_hash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_index.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.clusters(table(spark, sf_dir, "embeddings"))


def op13_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = block_rotation.restored(block_rotation.fill_in_middle(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("text", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_means_tree, op2_approximation_file, op3_token_counts, op4_toxicity, op5_line_runs, op6_vector_packing, op7_shingle_forest,
    op8_secret_tagger, op9_piece_codec, op10_masked_scorer, op11_hash_index, op12_pivot_clusters, op13_block_rotation)}

_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_ROUND = """
a{r} AS MATERIALIZED (SELECT vec_id, arg_min(k, (s, k)) AS k, min(s) AS s FROM (
  SELECT e.vec_id, c.k, sum((e.x - c.x) * (e.x - c.x)) AS s FROM e JOIN c{r} c ON e.d = c.d GROUP BY e.vec_id, c.k) GROUP BY vec_id),"""
_MOVE = """
m{r} AS MATERIALIZED (SELECT k, d, (s - ((s % n) + n) % n) // n AS x FROM (
  SELECT k, d, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM e JOIN a{r} USING (vec_id) GROUP BY k, d)),
c{next} AS MATERIALIZED (SELECT c.k, c.d, coalesce(m.x, c.x)::BIGINT AS x FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k AND c.d = m.d),"""

SQL = {
    "op11_hash_index": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)""",
    "op12_pivot_clusters": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda y: CAST(floor(64 * CAST(y AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
e AS MATERIALIZED (SELECT vec_id, unnest(range(1, 65)) AS d, unnest(x) AS x FROM v),
f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k FROM v),
c0 AS MATERIALIZED (SELECT f.k, e.d, e.x FROM f JOIN e USING (vec_id) WHERE f.k < 16),"""
    + "".join((_ROUND + (_MOVE if r < 3 else "")).format(r=r, next=r + 1) for r in range(4)) + """
h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c3 GROUP BY k)
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.s AS BIGINT) AS distance, CAST(sum(a.s) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.s) OVER () AS BIGINT) AS inertia, h.centroid_sha256 FROM a3 a JOIN h ON a.k = h.k""",
    "op13_block_rotation": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS g FROM documents),
u AS (SELECT *, regexp_extract_all(x, '[^\n]*\n|[^\n]+') AS u, ('0x' || substr(g, 1, 8))::BIGINT AS h1, ('0x' || substr(g, 9, 8))::BIGINT AS h2,
             ('0x' || substr(g, 17, 8))::BIGINT AS h3, ('0x' || substr(g, 25, 8))::BIGINT AS h4 FROM t),
n AS (SELECT *, len(u) AS n, CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 100 THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi FROM n),
p AS (SELECT *, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1:hi], '') AS mid, array_to_string(u[hi + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, if(form = 'plain', NULL, length(pre)) AS prefix_chars, if(form = 'plain', NULL, length(mid)) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(x) AS restored_sha256 FROM p""",
    "op2_approximation_file": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_line_runs": f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, {_KEY} AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (owner < k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (owner IS NULL OR owner >= k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN o ON length(k.key) >= 10 AND k.key = o.key GROUP BY k.doc_id""",
}
