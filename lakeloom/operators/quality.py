"""Expectations: rules on rows, with warn / drop / fail actions, quarantine and reports.

A row passes a rule only if the rule IS TRUE, so the valid and the quarantined rows are together
always the whole input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.conditional import flags, holds

Rules = Mapping[str, Column]


def parse(rules: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in rules.items()}


def all_hold(rules: Rules) -> Column:
    out = F.lit(True)
    for test in rules.values():
        out = out & holds(test)
    return out


def violated(rules: Rules) -> Column:
    """Names of the broken rules, in rule order."""
    return flags({name: ~holds(test) for name, test in rules.items()})


def report(df: DataFrame, rules: Rules, by: Sequence[str] = ()) -> DataFrame:
    """Passed and failed rows per rule, from one pass."""
    counts = [F.count_if(~holds(test)).alias(name) for name, test in rules.items()]
    wide = df.groupBy(*by).agg(F.count("*").alias("__rows"), *counts)
    long = wide.unpivot([*by, "__rows"], list(rules), "rule", "failed")
    return long.select(*by, "rule", (F.col("__rows") - F.col("failed")).alias("passed"), "failed")


def drop_bad(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(all_hold(rules))


def fail_on_bad(df: DataFrame, rules: Rules) -> DataFrame:
    """The unchanged rows; the job stops with the rule names at the first bad one."""
    message = F.concat(F.lit("expectation violated: "), F.array_join(violated(rules), ","))
    checked = F.when(all_hold(rules), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(checked)


def quarantine(df: DataFrame, rules: Rules, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violating rows with all broken rules and the time of the check)."""
    marked = df.withColumn("violated_rules", violated(rules))
    bad = marked.filter(F.size("violated_rules") > 0)
    bad = bad.withColumn("first_rule", F.element_at("violated_rules", 1))
    bad = bad.withColumn("quarantined_at", at if at is not None else F.current_timestamp())
    return drop_bad(df, rules), bad


def rules_for(rule_table: DataFrame, target: str) -> dict[str, Column]:
    """Active rules of a target from a rule table (rule_name, rule_expression, target_table, is_active).

    Each rule becomes an expression of the plan, so the driver has to hold them all in any case.
    """
    wanted = rule_table.filter((F.col("target_table") == target) & F.col("is_active"))
    return {r.rule_name: F.expr(r.rule_expression) for r in wanted.select("rule_name", "rule_expression").orderBy("rule_name").collect()}


def null_duplicate_negative(df: DataFrame, key: str, required: str, amount: str) -> DataFrame:
    """Rows, NULLs, surplus rows of repeated keys and negative amounts."""
    repeats = df.groupBy(key).agg(F.count("*").alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates")
    )
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(required).isNull()).alias("nulls"),
        F.count_if(F.col(amount) < 0).alias("negatives"),
    ).withColumn("duplicates", repeats.scalar())


def out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows outside the physical range per column, all columns in one pass."""
    wide = df.agg(*[F.count_if(~holds(F.col(c).between(lo, hi))).alias(c) for c, (lo, hi) in ranges.items()])
    return wide.unpivot([], list(ranges), "column", "out_of_range")


def freshness(df: DataFrame, ts: str, now: Column, max_hours: float, by: Sequence[str] = ()) -> DataFrame:
    last = df.groupBy(*by).agg(F.max(ts).alias("last_change"))
    hours = F.floor((F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_change").cast("timestamp"))) / 3600)
    return last.withColumn("hours", hours).withColumn("stale", F.col("hours") > max_hours)


def volume(df: DataFrame, low: int, by: Sequence[str] = ()) -> DataFrame:
    n = df.groupBy(*by).agg(F.count("*").alias("n"))
    return n.withColumn("volume", F.when(F.col("n") == 0, "empty").when(F.col("n") < low, "low").otherwise("normal"))
