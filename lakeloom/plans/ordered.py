"""Ordered per-key computations that never put a whole key into one task.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task. Here each key is cut
into buckets that grow with the order, rows are windowed inside (key, bucket), and what crosses a
border is carried by a second table with one row per (key, bucket).

``scan`` takes all that one order can give in one pass, over buckets that follow the data: only keys
with many rows are cut, where a sample of them says. The functions after it take a bucket that the
caller computes (an hour, a price range, ...), whose carried table depends on the span of the order
column and not on the row count.

Keys must not be NULL. A given ``bucket`` must be non-decreasing in the first order column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.plans import durable

_B = "__bucket"


def hour_bucket(ts: str) -> Column:
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def day_bucket(ts: str) -> Column:
    return F.to_date(F.col(ts))


def width_bucket_of(value: str, width: float) -> Column:
    return F.floor(F.col(value) / F.lit(width))


def _windows(keys: Sequence[str], order: Sequence[str]):
    inside = Window.partitionBy(*keys, _B).orderBy(*[F.col(c) for c in order])
    across = Window.partitionBy(*keys).orderBy(_B)
    return inside, across


BUCKETS, SAMPLED = 32, 64  # buckets that an even table would have per task; sampled rows per bucket
MOST_PARTS = 2000  # tasks that borders are made for, which bounds them


def borders_by_load(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame | None:
    """Where keys with many rows are to be cut, written as a small table; None if no key has many.

    A hash of (keys, order) picks a sample whose size depends on the number of tasks; a key is cut after every ``SAMPLED`` of its sampled
    rows, so a bucket has about 1/``BUCKETS`` of a task's even share, however the key's rows lie, and a key with fewer rows than two
    buckets stays whole. ``order`` should tell all rows of a key apart; rows that tie stay together. The sample has about
    BUCKETS * SAMPLED * MOST_PARTS rows at most, so there are BUCKETS * MOST_PARTS borders in all and they can be broadcast.
    """
    spark = df.sparkSession
    parts = min(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_PARTS)
    slim = df.select(*keys, F.struct(*order).alias("__o"))
    every = F.greatest(F.lit(1), F.floor(df.agg(F.count("*")).scalar() / (parts * BUCKETS * SAMPLED)))
    picked = slim.filter(F.pmod(F.xxhash64(*keys, "__o"), every) == 0)
    lists = picked.groupBy(*keys).agg(F.sort_array(F.collect_list("__o")).alias("__s")).filter(F.size("__s") >= 2 * SAMPLED)
    places = F.sequence(F.lit(SAMPLED), F.size("__s") - 1, F.lit(SAMPLED))
    borders = lists.select(*keys, F.transform(places, lambda i: F.col("__s")[i]).alias("__borders"))
    borders = durable.cut(borders, "borders")
    return None if borders.isEmpty() else borders


def by_load(df: DataFrame, keys: Sequence[str], order: Sequence[str], borders: DataFrame | None, how: str = "left") -> DataFrame:
    """``df`` with a bucket number that grows with the order of a cut key and is 0 elsewhere; ``how="inner"`` keeps the cut keys only."""
    if borders is None:
        return df.withColumn(_B, F.lit(0))
    joined = with_coarse(borders, "__borders", "__coarse")
    joined = df.withColumn("__o", F.struct(*order)).join(F.broadcast(joined), list(keys), how)
    return numbered(joined, "__o", "__borders", "__coarse", _B).select(*df.columns, _B)


def even_borders(df: DataFrame, columns: Sequence[str], pieces: int) -> DataFrame:
    """One row with, per column, a sorted array of at most ``pieces`` - 1 structs that cut its values into pieces of about equal size.

    A hash of all columns picks about ``SAMPLED`` rows per piece. NULL sorts first. A value that fills several pieces is one border.
    """
    every = F.greatest(F.lit(1), F.floor(df.agg(F.count("*")).scalar() / (pieces * SAMPLED)))
    picked = df.select(*columns).filter(F.pmod(F.xxhash64(*columns), every) == 0)
    lists = picked.agg(*[F.sort_array(F.collect_list(F.struct(c))).alias(c) for c in columns])
    step = F.greatest(F.lit(1), F.ceil(F.size(columns[0]) / pieces)).cast("int")
    places = F.filter(F.sequence(F.lit(0), F.size(columns[0]), step), lambda i: (i > 0) & (i < F.size(columns[0])))
    borders = [F.array_distinct(F.transform("__places", lambda i: F.col(c)[i])).alias(c) for c in columns]  # noqa: B023 - called at once
    return lists.withColumn("__places", places).select(*borders)


def with_coarse(df: DataFrame, borders: str, name: str) -> DataFrame:
    """Every 64th of a sorted array of borders, for :func:`numbered`."""
    every = F.sequence(F.lit(0), F.size(borders) - 1, F.lit(64))
    return df.withColumn(name, F.when(F.size(borders) > 0, F.transform(every, lambda i: F.col(borders)[i])).otherwise(F.slice(borders, 1, 1)))


def numbered(df: DataFrame, value: str, borders: str, coarse: str, name: str) -> DataFrame:
    """How many of the sorted ``borders`` are at most ``value``; looks at every 64th first, then at the 64 behind the right one. NULL borders give 0."""
    block = F.size(F.filter(coarse, lambda x: x <= F.col(value)))
    df = df.withColumn("__block", F.when(F.col(borders).isNotNull(), block).otherwise(0))
    fine = F.slice(borders, 64 * (F.col("__block") - 1) + 1, F.lit(64))
    inside = 64 * (F.col("__block") - 1) + F.size(F.filter(fine, lambda x: x <= F.col(value)))
    return df.withColumn(name, F.when(F.col("__block") > 0, inside).otherwise(0)).drop("__block")


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    totals: Sequence[str] = (),
    last: dict[str, Column] | None = None,
    runs: dict[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Everything that one ordered pass per key gives, for keys of any size; rows are exchanged once.

    ``before`` / ``after``: values of the previous / next row, NULL at the end. ``sums``: running sums up to the row; those named in
    ``totals`` also get ``<name>_total`` over the key. ``last``: last non-NULL value at or before the row. ``runs``: per name
    (image, value), the ``value`` of the first row of the row's run, a run being neighbouring rows with equal images.

    Buckets follow the data, see :func:`borders_by_load`, for which a sample of ``df`` is taken while the plan is made; write ``df`` first
    where it is costly. One composite row per bucket of a cut key is carried: its outer values, sums, last values and runs. Keys
    that are not cut need none, and where none is cut the pass is a plain window. For ``runs`` over cut keys the windowed rows are written,
    otherwise the cut keys' rows are read again.
    """
    before, after, sums, last, runs = before or {}, after or {}, sums or {}, last or {}, runs or {}
    inside, across = _windows(keys, order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys, _B)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    own = F.struct(*order)
    back = F.struct(*[c.alias(n) for n, c in before.items()], *[i.alias(f"__i_{n}") for n, (i, _) in runs.items()], F.lit(1).alias("__x"))
    ahead = F.struct(*[c.alias(n) for n, c in after.items()], F.lit(1).alias("__x"))
    borders = borders_by_load(df, keys, order)

    near = {f"__in_{n}": F.sum(c).over(upto) for n, c in sums.items()}
    near |= {f"__all_{n}": F.sum(sums[n]).over(whole) for n in totals}
    near |= {f"__last_{n}": F.last(c, ignorenulls=True).over(upto) for n, c in last.items()}
    if before or runs:
        near["__back"] = F.lag(back).over(inside)
    if after:
        near["__ahead"] = F.lead(ahead).over(inside)
    local = by_load(df, keys, order, borders).withColumns(near)
    for n, (image, value) in runs.items():
        # a run that begins at the bucket's first row may have begun before it
        starts = F.col("__back").isNotNull() & ~F.col("__back")[f"__i_{n}"].eqNullSafe(image)
        own_value = F.struct(value.alias("v"))
        local = local.withColumns({f"__run_{n}": F.last(F.when(starts, own_value), ignorenulls=True).over(upto),
                                   f"__head_{n}": F.first(own_value).over(upto)})
    pairs = [("__back", before)] * bool(before) + [("__ahead", after)] * bool(after)
    if borders is None:
        return local.select(
            *df.columns, *[F.col(p)[n].alias(n) for p, cols in pairs for n in cols], *[F.col(f"__in_{n}").alias(n) for n in sums],
            *[F.col(f"__all_{n}").alias(f"{n}_total") for n in totals], *[F.col(f"__last_{n}").alias(n) for n in last],
            *[F.coalesce(f"__run_{n}", f"__head_{n}")["v"].alias(n) for n in runs])

    if runs:
        local = durable.cut(local, "scan")
        cut = local.join(F.broadcast(borders.select(*keys)), list(keys), "left_semi")
    else:
        cut = by_load(df, keys, order, borders, "inner")
    edge = {f"__part_{n}": F.sum(c) for n, c in sums.items()}
    edge |= {f"__part_last_{n}": F.max_by(c, F.when(c.isNotNull(), own)) for n, c in last.items()}
    if before or runs:
        edge["__end"] = F.max_by(back, own)
    if after:
        edge["__first"] = F.min_by(ahead, own)
    for n, (image, value) in runs.items():
        edge |= {f"__open_{n}": F.min_by(F.struct(image.alias("i"), value.alias("v")), own), f"__begun_{n}": F.max_by(f"__run_{n}", own)}
    edges = cut.groupBy(*keys, _B).agg(F.lit(1).alias("__x"), *[c.alias(n) for n, c in edge.items()])
    far = {f"__pre_{n}": F.sum(f"__part_{n}").over(earlier) for n in sums}
    far |= {f"__whole_{n}": F.sum(f"__part_{n}").over(Window.partitionBy(*keys)) for n in totals}
    far |= {f"__pre_last_{n}": F.last(f"__part_last_{n}", ignorenulls=True).over(earlier) for n in last}
    if before or runs:
        far["__far_back"] = F.lag("__end").over(across)
    if after:
        far["__far_ahead"] = F.lead("__first").over(across)
    carried = edges.withColumns(far)
    for n in runs:
        # the run that the bucket's first row is in: a new one, unless the bucket before ends with the same image
        opens = F.col("__far_back").isNull() | ~F.col("__far_back")[f"__i_{n}"].eqNullSafe(F.col(f"__open_{n}.i"))
        fresh = F.when(opens, F.struct(F.col(f"__open_{n}.v").alias("v")))
        ends = F.coalesce(F.col(f"__begun_{n}"), fresh)
        carried = carried.withColumn(f"__pre_run_{n}", F.coalesce(fresh, F.last(ends, ignorenulls=True).over(earlier)))
    names = [*far, *[f"__pre_run_{n}" for n in runs]]
    joined = local.join(F.broadcast(carried.select(*keys, _B, *names)), [*keys, _B], "left")

    out = [F.coalesce(p, p.replace("__", "__far_"))[n].alias(n) for p, cols in pairs for n in cols]
    out += [_plus(F.col(f"__in_{n}"), F.col(f"__pre_{n}")).alias(n) for n in sums]
    out += [F.coalesce(f"__whole_{n}", f"__all_{n}").alias(f"{n}_total") for n in totals]
    out += [F.coalesce(f"__last_{n}", f"__pre_last_{n}").alias(n) for n in last]
    out += [F.coalesce(f"__run_{n}", f"__pre_run_{n}", f"__head_{n}")["v"].alias(n) for n in runs]
    return joined.select(*df.columns, *out)


def _plus(a: Column, b: Column) -> Column:
    """a + b, a NULL side left out: a running sum is NULL only while all its values are."""
    return F.coalesce(a + b, a, b)


def neighbor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    outputs: dict[str, Column],
    forward: bool = False,
) -> DataFrame:
    """Values of the previous (or, with ``forward``, next) row of the same key; NULL at the end."""
    inside, across = _windows(keys, order)
    step, edge = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    packed = F.struct(*[c.alias(n) for n, c in outputs.items()])
    base = df.withColumn(_B, bucket)
    local = base.withColumn("__near", step(packed).over(inside))
    edges = base.groupBy(*keys, _B).agg(edge(packed, F.struct(*order)).alias("__edge"))
    carried = edges.select(*keys, _B, step("__edge").over(across).alias("__far"))
    both = F.coalesce("__near", "__far")
    return local.join(carried, [*keys, _B], "left").select(
        *df.columns, *[both[n].alias(n) for n in outputs]
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    sums: dict[str, Column],
    totals: bool = False,
) -> DataFrame:
    """Running sums (rows up to and including the current one) per key.

    With ``totals`` each sum also gets ``<name>_total``, the sum over the whole key.
    """
    inside, across = _windows(keys, order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    base = df.withColumn(_B, bucket)
    local = base.withColumns({f"__in_{n}": F.sum(c).over(upto) for n, c in sums.items()})
    parts = base.groupBy(*keys, _B).agg(*[F.sum(c).alias(f"__part_{n}") for n, c in sums.items()])
    carry = {f"__pre_{n}": F.coalesce(F.sum(f"__part_{n}").over(before), F.lit(0)) for n in sums}
    if totals:
        carry |= {f"{n}_total": F.sum(f"__part_{n}").over(whole) for n in sums}
    carried = parts.select(*keys, _B, *[c.alias(n) for n, c in carry.items()])
    out = [(F.col(f"__in_{n}") + F.col(f"__pre_{n}")).alias(n) for n in sums]
    if totals:
        out += [F.col(f"{n}_total") for n in sums]
    return local.join(carried, [*keys, _B], "left").select(*df.columns, *out)


def position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str = "pos"
) -> DataFrame:
    """1-based row number per key; ``order`` must be total for a stable result."""
    return running(df, keys, order, bucket, {name: F.lit(1).cast("bigint")})


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    value: Column,
    name: str,
) -> DataFrame:
    """Last non-NULL ``value`` at or before the row, per key."""
    inside, across = _windows(keys, order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    base = df.withColumn(_B, bucket)
    local = base.withColumn("__near", F.last(value, ignorenulls=True).over(upto))
    edges = base.groupBy(*keys, _B).agg(
        F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias("__edge")
    )
    carried = edges.select(
        *keys, _B, F.last("__edge", ignorenulls=True).over(before).alias("__far")
    )
    return local.join(carried, [*keys, _B], "left").select(
        *df.columns, F.coalesce("__near", "__far").alias(name)
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    width: float | None = None,
) -> DataFrame:
    """Interpolated quantiles per key without gathering a key's values in one buffer.

    Rows are first counted per distinct value, which is combined map-side; the running count then
    tells which value covers each wanted rank. NULL values are ignored, as in ``percentile_cont``.
    Without a bucket ``width`` the counts are written and cut where they are many.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    sums = {"__cum": F.col("__n")}
    if width is None:
        ranked = scan(durable.cut(counts, "counts"), keys, [value], sums=sums, totals=["__cum"])
    else:
        ranked = running(counts, keys, [value], width_bucket_of(value, width), sums, totals=True)
    aggs = []
    for name, p in probs.items():
        target = F.lit(p) * (F.col("__cum_total") - 1)
        for side, at in (("lo", F.floor(target)), ("hi", F.ceil(target))):
            covers = (F.col("__cum") - F.col("__n") <= at) & (at < F.col("__cum"))
            aggs.append(F.max(F.when(covers, F.col(value))).alias(f"__{side}_{name}"))
        aggs.append(F.max(target - F.floor(target)).alias(f"__frac_{name}"))
    picked = ranked.groupBy(*keys).agg(*aggs)
    out = [
        (
            F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__frac_{n}")
        ).alias(n)
        for n in probs
    ]
    return picked.select(*keys, *out)


def by_range(df: DataFrame, cols: Sequence[str], parts: int | None = None, name: str = "range_no") -> DataFrame:
    """Adds an even, order-preserving bucket number for any ordering, however repeated its values.

    The rows are range-partitioned on ``cols`` and written once, so every later use sees the same
    borders. Prefer a computed bucket where the order column spreads by itself.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.repartitionByRange(parts, *cols).withColumn(name, F.spark_partition_id())
    return durable.cut(numbered, "range")


def ranks(df: DataFrame, keys: Sequence[str], value: str, row_id: str, tiles: int = 4) -> DataFrame:
    """row_number, rank, dense_rank and ntile by descending ``value`` for groups of any size."""
    base = by_range(df.withColumn("__neg", -F.col(value)), [*keys, "__neg", row_id])
    bucket = F.col("range_no")
    seen = neighbor(base, keys, ["__neg", row_id], bucket, {"__prev": F.col("__neg")})
    first = F.when(F.col("__prev").isNull() | (F.col("__prev") != F.col("__neg")), 1).otherwise(0)
    sums = {"row_number": F.lit(1).cast("bigint"), "dense_rank": first.cast("bigint")}
    numbered = running(seen, keys, ["__neg", row_id], bucket, sums, totals=True)
    opening = F.when(first == 1, F.col("row_number"))
    full = carry_forward(numbered, keys, ["__neg", row_id], bucket, opening, "rank")
    n, r = F.col("row_number_total"), F.col("row_number")
    size, extra = F.floor(n / tiles), n % tiles
    big = extra * (size + 1)
    tile = F.when(r <= big, F.floor((r - 1) / (size + 1))).otherwise(
        extra + F.floor((r - 1 - big) / F.greatest(size, F.lit(1)))
    )
    return full.withColumn("ntile", (tile + 1).cast("bigint")).select(
        *df.columns, "row_number", "rank", "dense_rank", "ntile"
    )
