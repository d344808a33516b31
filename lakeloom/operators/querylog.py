"""Jobs over a table of logged queries: comparison, failure categories, lint, referenced tables.

Fixed values: the keyword rules and lint patterns below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import conditional as C

FAILURES = [
    ("timeout", ["TIMEOUT", "TIMED OUT"]), ("permission", ["PERMISSION", "DENIED"]),
    ("missing_table", ["TABLE_OR_VIEW_NOT_FOUND", "TABLE NOT FOUND"]), ("missing_column", ["UNRESOLVED_COLUMN", "COLUMN NOT FOUND"]),
    ("ambiguous_reference", ["AMBIGUOUS"]),
    ("syntax", ["PARSE_SYNTAX_ERROR", "SYNTAX"]),
]
LINT = {
    "select_star": r"(?i)select\s+\*",
    "hard_coded_date": r"""['"][0-9]{4}-[0-9]{2}-[0-9]{2}['"]""",
    "unsafe_division": r"(?i)[a-z_)]\s*/\s*(?!(?:nullif|try_divide)\s*\()[a-z_(]",
}
AGGREGATE = r"(?i)(sum|count|avg|min|max)\s*\("
REFERENCE = r"(?i)\b(?:from|join)\s+([a-z_`][a-z0-9_.`]*)"


def normalized(sql: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(sql), ";", " "), r"\s+", " "))


def compared(log: DataFrame) -> DataFrame:
    same = normalized(F.col("generated_sql")) == normalized(F.col("expected_sql"))
    return log.withColumn("passed", C.holds((F.col("status") == "OK") & same))


def categorized(log: DataFrame) -> DataFrame:
    """Category of each failed record; the first rule that fits wins."""
    cat = C.keyword_category(F.coalesce("error", F.lit("")), FAILURES, "wrong_result")
    no_sql = F.trim(F.coalesce("generated_sql", F.lit(""))) == ""
    return compared(log).withColumn("category", F.when(~F.col("passed"), F.when(no_sql, "no_sql").otherwise(cat)))


def summary(log: DataFrame) -> DataFrame:
    """Passed, failed and share of failures per iteration and category."""
    counts = categorized(log).groupBy("iteration", "category").agg(F.count("*").alias("n"))
    failures = F.sum(F.when(F.col("category").isNotNull(), F.col("n"))).over(Window.partitionBy("iteration"))  # one row per category
    return counts.withColumn("share_pct", F.when(F.col("category").isNotNull(), F.col("n") * F.lit(100.0) / failures))


def iteration_delta(log: DataFrame) -> DataFrame:
    scores = compared(log).groupBy("iteration").agg((F.count_if(F.col("passed")) * F.lit(100.0) / F.count("*")).alias("score"))
    return scores.withColumn("delta", F.col("score") - F.lag("score").over(Window.orderBy("iteration")))  # one row per iteration


def lint(sql: Column) -> Column:
    rules = {name: sql.rlike(pattern) for name, pattern in LINT.items()}
    rules["aggregate_without_group"] = sql.rlike(AGGREGATE) & sql.rlike(r"(?i)select\s+[a-z_]+\s*,") & ~sql.rlike(r"(?i)group\s+by")
    return C.flags(rules)


def references(log: DataFrame, sql: str) -> DataFrame:
    tables = F.transform(F.regexp_extract_all(sql, F.lit(REFERENCE), F.lit(1)), lambda x: F.lower(F.replace(x, F.lit("`"), F.lit(""))))
    return log.select(F.explode(F.array_distinct(tables)).alias("table_name")).groupBy("table_name").agg(F.count("*").alias("queries"))
