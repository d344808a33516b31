"""Join operators beyond the plain equi-join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import durable, ordered, skew


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    outputs: dict[str, Column],
    tie: str,
) -> DataFrame:
    """Latest right row at or before each left row, per key; left rows without one keep NULLs.

    Both sides become one time line and the last right row is carried forward, bucket by bucket of
    rows, so no key has to fit into one task. ``tie`` orders right rows of one instant.
    """
    packed = F.struct(*[c.alias(n) for n, c in outputs.items()])
    features = right.select(
        F.col(key), F.col(right_time).alias("__t"), F.lit(0).alias("__side"),
        F.col(tie).cast("string").alias("__tie"), packed.alias("__feature"),
    )
    labels = left.select(
        F.col(key), F.col(left_time).alias("__t"), F.lit(1).alias("__side"),
        F.struct(*left.columns).alias("__row"),
    )
    line = features.unionByName(labels, allowMissingColumns=True)
    carried = ordered.scan(line, [key], ["__t", "__side", "__tie"], last={"__asof": F.col("__feature")})
    return carried.filter("__side = 1").select("__row.*", *[F.col(f"__asof.{n}").alias(n) for n in outputs])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    seconds: int,
    how: str = "left",
) -> DataFrame:
    """Right rows within ``seconds`` after each left row of the same key.

    The time is cut into slots of that length and the slot joins the equi-key, so a hot key is
    spread over its slots. A right row can only meet left rows of its own or the previous slot.
    ``key`` must have the same name on both sides and is kept from the left one.
    """
    def slot(c: str) -> Column:
        return F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / seconds)

    a = left.withColumn("__slot", slot(left_time))
    b = right.withColumn("__rslot", F.explode(F.array(slot(right_time), slot(right_time) - 1)))
    b = b.withColumnRenamed(key, "__rkey")
    gap = F.expr(f"make_dt_interval(0, 0, 0, {seconds})")
    on = (
        (F.col(key) == F.col("__rkey"))
        & (F.col("__slot") == F.col("__rslot"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= F.col(left_time) + gap)
    )
    return a.join(b, on, how).drop("__slot", "__rslot", "__rkey")


def full_join_on(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several key-unique tables with the keys merged."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)


def calendar(first: str | Column, last: str | Column, spark, holidays: Mapping[str, str] | None = None, fiscal_start: int = 4) -> DataFrame:
    """Date dimension between two dates (ISO text or scalar subqueries), both included.

    ``holidays`` names fixed days of the year by "MM-dd". The fiscal year starts with the month ``fiscal_start`` and has the number of the
    year it starts in. Business days are neither at a weekend nor a holiday.
    """
    d = F.col("date")
    names = F.create_map(*[F.lit(x) for pair in holidays.items() for x in pair]) if holidays else F.lit(None).cast("map<string,string>")
    fiscal = F.add_months(d, 1 - fiscal_start)
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("date"))
        .select(
            F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
            "date",
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            F.dayofweek(d).alias("weekday"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.date_format(d, "EEEE").alias("weekday_name"),
            F.weekofyear(d).alias("week"),
            F.date_format(d, "yyyy-MM").alias("year_month"),
            F.year(fiscal).alias("fiscal_year"),
            F.concat(F.lit("Q"), F.quarter(fiscal)).alias("fiscal_quarter"),
            F.try_element_at(names, F.date_format(d, "MM-dd")).alias("holiday_name"),
        )
        .withColumn("is_holiday", F.col("holiday_name").isNotNull())
        .withColumn("is_business_day", ~F.col("is_weekend") & ~F.col("is_holiday"))
    )


def linked_to_first(df: DataFrame, group: Sequence[str], id_col: str) -> DataFrame:
    """(first id, other id) for every group of equal rows: all links, without all pairs; a large group's rows are not sent to one task."""
    firsts = df.groupBy(*group).agg(F.min(id_col).alias("first_id"), F.count("*").alias("copies"))
    repeated = durable.cut(firsts.filter("copies > 1"), "firsts")
    return (
        skew.uneven_join(df, repeated, list(group), "copies")
        .filter(F.col("first_id") < F.col(id_col))
        .select("first_id", F.col(id_col).alias("other_id"), *group)
    )


def overlap_at_least(
    left: DataFrame, right: DataFrame, key: str, by: Sequence[str], minimum: int
) -> DataFrame:
    """Size of the key overlap per group, released only from ``minimum`` distinct keys up."""
    shared = left.join(right.select(key).distinct(), key, "left_semi")
    return (
        shared.groupBy(*by).agg(F.count_distinct(key).alias("matched"))
        .filter(F.col("matched") >= minimum)
    )
