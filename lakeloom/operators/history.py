"""Change capture and history on DataFrames: upsert, history intervals, change feed, refresh."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import durable, ordered, skew


def close_intervals(
    versions: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None = None
) -> DataFrame:
    """Half-open intervals: a version holds from its sequence value to the next one of its key."""
    first = order[0]
    bucket = F.date_trunc("month", F.col(first)) if bucket is None else bucket
    closed = ordered.neighbor(versions, keys, order, bucket, {"end_at": F.col(first)}, forward=True)
    return closed.withColumn("start_at", F.col(first)).drop(*order)


def state_as_of(history: DataFrame, at: Column) -> DataFrame:
    """Versions that hold at ``at``; an open end counts as still valid."""
    return history.filter((F.col("start_at") <= at) & (F.col("end_at").isNull() | (F.col("end_at") > at)))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; other rows of both sides stay."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def conditional_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], seq: str, op: str, delete: str = "DELETE"
) -> DataFrame:
    """Merge with row conditions: delete, update only if newer, insert unless it is a delete.

    ``source`` holds one row per key with the target's columns plus ``op``.
    """
    cols = target.columns
    t = target.select(F.struct(*cols).alias("t"), *keys)
    s = source.select(F.struct(*cols, op).alias("s"), *keys)
    has_t, has_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    deleted = has_s & (F.col(f"s.{op}") == delete)
    newer = has_s & (~has_t | (F.col(f"s.{seq}") > F.col(f"t.{seq}")))
    joined = t.join(s, list(keys), "full").filter(~F.coalesce(deleted, F.lit(False)))
    return joined.select(
        *[F.when(newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols]
    )


def scd1(feed: DataFrame, keys: Sequence[str], order: Sequence[str], op: str | None = None,
         delete: str = "DELETE") -> DataFrame:
    """Current row per key by sequence; late rows lose, a key whose last change is a delete goes."""
    last = skew.latest_per_key(feed, keys, [F.desc(c) for c in order])
    return last.filter(F.col(op) != delete) if op else last


def after_truncate(feed: DataFrame, seq: str, op: str, truncate: str = "TRUNCATE") -> DataFrame:
    """Changes after the feed's last truncate; all of them if there is none."""
    last = feed.filter(F.col(op) == truncate).agg(F.max(seq))
    keep = F.coalesce(F.col(seq) > last.scalar(), F.lit(True))
    return feed.filter(keep & (F.col(op) != truncate))


def scd2(
    feed: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    tracked: Sequence[str] | None = None,
    op: str | None = None,
    delete: str = "DELETE",
) -> DataFrame:
    """History with ``start_at`` / ``end_at`` from a change feed in any arrival order.

    A delete closes the open interval. With ``tracked`` columns a new version starts only when one of
    them changes (or after a delete); other changes update the open version in place.
    """
    seq = order[0]
    is_delete = (F.col(op) == delete) if op else F.lit(False)
    feed = feed.withColumn("__del", is_delete)
    if tracked is None:
        closed = ordered.neighbor(feed, keys, order, bucket, {"end_at": F.col(seq)}, forward=True)
        return closed.filter("NOT __del").withColumn("start_at", F.col(seq)).drop("__del")
    image = F.struct(F.col("__del").alias("d"), *[F.col(c) for c in tracked])
    seen = ordered.scan(
        feed, keys, order, after={"__next": image, "end_at": F.col(seq)}, runs={"start_at": (image, F.col(seq))})
    # the last row of a run is its version; the next row, if any, starts the next version
    return seen.filter(~F.col("__next").eqNullSafe(image) & ~F.col("__del")).drop("__next", "__del")


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row images that lead from one snapshot to the next, typed as a change data feed."""
    cols = [c for c in before.columns if c not in keys]
    a = before.select(*keys, F.struct(*cols).alias("a"))
    b = after.select(*keys, F.struct(*cols).alias("b"))
    joined = a.join(b, list(keys), "full").filter(~F.col("a").eqNullSafe(F.col("b")))

    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("row"))

    images = (
        F.when(F.col("a").isNull(), F.array(image("insert", "b")))
        .when(F.col("b").isNull(), F.array(image("delete", "a")))
        .otherwise(F.array(image("update_preimage", "a"), image("update_postimage", "b")))
    )
    return joined.select(*keys, F.explode(images).alias("i")).select(*keys, "i._change_type", "i.row.*")


def apply_change_feed(before: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot after the feed of :func:`change_feed`."""
    touched = feed.select(*keys).distinct()
    images = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*before.columns)
    return before.join(touched, list(keys), "left_anti").unionByName(images)


def refresh_touched(
    stored: DataFrame, base: DataFrame, changed_keys: DataFrame, keys: Sequence[str], aggs: Sequence[Column]
) -> DataFrame:
    """Stored aggregate with only the groups of ``changed_keys`` computed again."""
    touched = changed_keys.select(*keys).distinct()
    again = base.join(touched, list(keys), "left_semi").groupBy(*keys).agg(*aggs)
    return stored.join(touched, list(keys), "left_anti").unionByName(again)


def refresh_by_deltas(
    stored: DataFrame, feed: DataFrame, rows_of: Callable[[DataFrame], DataFrame], keys: Sequence[str], value: str
) -> DataFrame:
    """Stored aggregate (keys, n, total, least, most) after the changes of ``feed``, from the changes alone.

    ``feed`` is a change feed (:func:`change_feed`) of the base rows: an update retracts its preimage and adds its postimage. Counts and
    sums move by the signed changes; ``least`` and ``most`` move unless a retracted value may have been the group's extreme. Only for
    such groups are base rows needed: ``rows_of`` gets their keys and gives their rows after the changes, and it is not called if there
    are none. Groups without rows vanish. Sums are decimals of two digits. NULL values count in ``n`` only.
    """
    v = F.col(value).cast("decimal(18,2)")
    adds = F.col("_change_type").isin("insert", "update_postimage")
    sign = F.when(adds, 1).otherwise(-1)
    delta = feed.groupBy(*keys).agg(
        F.sum(sign).alias("dn"), F.sum(v * sign).alias("dtotal"), F.min(F.when(adds, v)).alias("in_least"), F.max(F.when(adds, v)).alias("in_most"),
        F.min(F.when(~adds, v)).alias("out_least"), F.max(F.when(~adds, v)).alias("out_most"))
    joined = stored.join(delta.withColumn("__d", F.lit(True)), list(keys), "full").withColumn(
        "__again", F.coalesce((F.col("out_least") <= F.col("least")) | (F.col("out_most") >= F.col("most")), F.lit(False)))
    moved = durable.cut(joined.select(
        *keys, (F.coalesce("n", F.lit(0)) + F.coalesce("dn", F.lit(0))).alias("n"),
        F.coalesce(F.col("total") + F.col("dtotal"), "total", "dtotal").cast("decimal(38,2)").alias("total"),
        F.least("least", "in_least").alias("least"), F.greatest("most", "in_most").alias("most"), "__again"), "refresh").filter("n > 0")
    again = moved.filter("__again").select(*keys)
    if again.isEmpty():
        return moved.drop("__again")
    return moved.filter("NOT __again").drop("__again").unionByName(summed(rows_of(again), keys, value))


def summed(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The aggregate that :func:`refresh_by_deltas` keeps."""
    v = F.col(value).cast("decimal(18,2)")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(v).cast("decimal(38,2)").alias("total"), F.min(v).alias("least"), F.max(v).alias("most"))
