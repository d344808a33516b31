"""NL-to-SQL benchmark records (2.19): a query log with one record per event."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalog._sql import hu
from lakeloom.functions.literals import half_up
from lakeloom.operators import querylog as Q
from lakeloom.registry import query
from lakeloom.sources.bronze import num, pick

STATEMENTS = (
    "SELECT region, sum(amount) FROM sales GROUP BY region", "select region,  sum(amount) from sales group by region;",
    "SELECT * FROM sales", "SELECT region, count(id) FROM sales JOIN stores ON sales.id = stores.id",
    "SELECT a / b FROM main.ratios WHERE day = DATE", "SELECT sum(amount) FROM sales", None,
    "SELECT a / NULLIF(b, 0) FROM `main`.`Ratios`", 'SELECT A / B FROM sales WHERE day = "2024-01-02"',
    "SELECT id FROM sales JOIN `stores` ON sales.id = stores.id",
)
LOG = {
    "record_id": "event_id", "iteration": num(601, 4),
    "expected_sql": f"'{STATEMENTS[0]}'", "generated_sql": pick(602, *STATEMENTS),
    "status": pick(603, "OK", "OK", "OK", "FAILED"),
    "error": pick(604, None, "[PARSE_SYNTAX_ERROR] near FROM", "query timed out", "[UNRESOLVED_COLUMN] x", "permission denied", "[TABLE_OR_VIEW_NOT_FOUND] t",
                  "[AMBIGUOUS_REFERENCE] Reference id is ambiguous"),
}
LOG_SQL = "l AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in LOG.items()) + " FROM events)"
NORM = r"trim(regexp_replace(regexp_replace(upper({c}), ';', ' ', 'g'), '\s+', ' ', 'g'))"
PASS_SQL = f"{LOG_SQL}, p AS (SELECT *, coalesce(status = 'OK' AND {NORM.format(c='generated_sql')} = {NORM.format(c='expected_sql')}, false) AS passed FROM l)"
ERR = "upper(coalesce(error, ''))"
CAT_SQL = f"""{PASS_SQL}, k AS (SELECT *, CASE WHEN passed THEN NULL WHEN trim(coalesce(generated_sql, '')) = '' THEN 'no_sql' WHEN contains({ERR}, 'TIMEOUT') OR contains({ERR}, 'TIMED OUT') THEN 'timeout'
 WHEN contains({ERR}, 'PERMISSION') OR contains({ERR}, 'DENIED') THEN 'permission' WHEN contains({ERR}, 'TABLE_OR_VIEW_NOT_FOUND') THEN 'missing_table'
 WHEN contains({ERR}, 'UNRESOLVED_COLUMN') THEN 'missing_column' WHEN contains({ERR}, 'AMBIGUOUS_REFERENCE') THEN 'ambiguous_reference' WHEN contains({ERR}, 'SYNTAX') THEN 'syntax' ELSE 'wrong_result' END AS category FROM p)"""


def log(t):
    return t.events.select(*[F.expr(e).alias(n) for n, e in LOG.items()])


@query("bsc_01_compare", f"WITH {PASS_SQL} SELECT record_id, passed FROM p")
def compare(t):
    return Q.compared(log(t)).select("record_id", "passed")


@query("bsc_02_failure_category", f"WITH {CAT_SQL} SELECT record_id, category FROM k")
def category(t):
    return Q.categorized(log(t)).select("record_id", "category")


@query("bsc_03_score_summary", f"""
WITH {CAT_SQL}, g AS (SELECT iteration, category, count(*) AS n FROM k GROUP BY 1, 2)
SELECT *, CASE WHEN category IS NOT NULL THEN {hu("n * 100.0::DOUBLE / sum(n) FILTER (WHERE category IS NOT NULL) OVER (PARTITION BY iteration)", 4)} END AS share_pct FROM g
""")
def summary(t):
    return Q.summary(log(t)).withColumn("share_pct", half_up(F.col("share_pct"), 4))


@query("bsc_04_iteration_delta", f"""
WITH {PASS_SQL}, s AS (SELECT iteration, count(*) FILTER (WHERE passed) * 100.0::DOUBLE / count(*) AS score FROM p GROUP BY 1)
SELECT iteration, {hu("score", 4)} AS score, {hu("score - lag(score) OVER (ORDER BY iteration)", 4)} AS delta FROM s
""")
def delta(t):
    return Q.iteration_delta(log(t)).select("iteration", *[half_up(F.col(c), 4).alias(c) for c in ("score", "delta")])


G = "generated_sql"


@query("bsc_05_lint", f"""
WITH {LOG_SQL}, i AS (SELECT concat_ws(',',
 if(contains(regexp_replace(lower({G}), '[[:space:]]+', ' ', 'g'), 'select *'), 'select_star', NULL),
 if(regexp_matches({G}, $$["'][0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}["']$$), 'hard_coded_date', NULL),
 if(len(list_filter(regexp_extract_all(lower({G}), '[a-z_)] */ *([a-z_]+|[(])', 1), lambda d: d NOT IN ('nullif', 'try_divide'))) > 0, 'unsafe_division', NULL),
 if(regexp_matches(lower({G}), '(sum|count|avg|min|max) *[(]') AND regexp_matches(lower({G}), 'select +[a-z_]+ *,') AND NOT contains(lower({G}), 'group by'), 'aggregate_without_group', NULL)) AS issues FROM l)
SELECT issues, count(*) AS n FROM i GROUP BY 1
""")
def lint(t):
    return log(t).groupBy(F.array_join(Q.lint(F.col(G)), ",").alias("issues")).agg(F.count("*").alias("n"))


@query("bsc_06_table_references", f"""
WITH {LOG_SQL}, w AS (SELECT record_id, string_split(replace(regexp_replace(lower({G}), '[[:space:]]+', ' ', 'g'), '`', ''), ' ') AS w FROM l),
r AS (SELECT DISTINCT record_id, w[i + 1] AS table_name FROM w, LATERAL (SELECT unnest(range(1, len(w))) AS i) WHERE w[i] IN ('from', 'join'))
SELECT rtrim(table_name, ';') AS table_name, count(*) AS queries FROM r GROUP BY 1
""")
def references(t):
    return Q.references(log(t), G)
