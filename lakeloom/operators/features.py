"""Feature tables, training sets and model evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.joins import asof_join
from lakeloom.plans import skew


@dataclass(frozen=True)
class Lookup:
    """Features of one table for a training set: by key, or by key and time if ``time`` is given."""

    table: DataFrame
    key: str
    features: Sequence[str]
    rename: Mapping[str, str] = field(default_factory=dict)
    time: str | None = None
    tie: str | None = None


def training_set(labels: DataFrame, lookups: Sequence[Lookup], label_time: str | None = None,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """Labels with the features of each lookup; labels without a match keep NULL features."""
    out = labels
    for look in lookups:
        names = {f: look.rename.get(f, f) for f in look.features}
        if look.time:
            outputs = {new: F.col(old) for old, new in names.items()}
            out = asof_join(out, look.table, look.key, label_time, look.time, outputs, look.tie or look.time)
        else:
            cols = [F.col(old).alias(new) for old, new in names.items()]
            out = out.join(look.table.select(look.key, *cols), look.key, "left")
    return out.drop(*exclude)


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of every feature with the target, in one pass."""
    wide = df.agg(*[F.corr(f, target).alias(f) for f in features])
    return wide.unpivot([], list(features), "feature", "correlation")


def dense_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """Gap-free integer ids (from 0) by ascending value, numbered range by range."""
    from lakeloom.plans import ordered

    values = ordered.by_range(df.select(col).distinct(), [col])
    numbered = ordered.position(values, [], [col], F.col("range_no"), name)
    return numbered.select(col, (F.col(name) - 1).cast("int").alias(name))


def holdout_metrics(recommended: DataFrame, relevant: DataFrame, user: str, item: str, rank: str, k: int) -> DataFrame:
    """Mean precision, recall and NDCG at k over the users that have relevant items."""
    truth = relevant.groupBy(user).agg(F.count("*").alias("n_rel"))
    hits = recommended.filter(F.col(rank) <= k).join(relevant.select(user, item), [user, item]).groupBy(user).agg(
        F.count("*").alias("hits"), F.sum(1 / F.log2(F.col(rank) + 1)).alias("dcg"))
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_rel"), F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + F.lit(1.0)))
    per = truth.join(hits, user, "left").fillna(0, ["hits", "dcg"])
    return per.agg(
        F.avg(F.col("hits") / k).alias("precision"), F.avg(F.col("hits") / F.col("n_rel")).alias("recall"),
        F.avg(F.col("dcg") / ideal).alias("ndcg"), F.count("*").alias("users"))


def error_metrics(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    e = actual - predicted
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def blend(a: DataFrame, b: DataFrame, user: str, item: str, score: str, weight_a: float, n: int) -> DataFrame:
    """Weighted sum of two recommenders' scores; an item of one list only keeps its weighted part."""
    left = a.select(user, item, F.col(score).alias("__a"))
    right = b.select(user, item, F.col(score).alias("__b"))
    both = left.join(right, [user, item], "full").fillna(0.0, ["__a", "__b"])
    mixed = both.withColumn(score, F.col("__a") * weight_a + F.col("__b") * (1 - weight_a)).drop("__a", "__b")
    return skew.top_per_key(mixed, [user], [F.desc(score), F.asc(item)], n, "rank")


RISK_TIERS = [(0.8, "critical"), (0.5, "high"), (0.3, "medium")]


def business_value(df: DataFrame, label: Column, predicted: Column, saved: float, alarm: float, missed: float,
                   service: float) -> DataFrame:
    """Money a classifier is worth: savings less the cost of service per true alarm, costs per false alarm and per miss."""
    tp, fp, fn = F.count_if(label & predicted), F.count_if(~label & predicted), F.count_if(label & ~predicted)
    return df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), (tp * saved - fp * alarm - fn * missed - tp * service).alias("value"))


def choose_threshold(df: DataFrame, score: Column, label: Column, min_recall: float, steps: int = 100) -> DataFrame:
    """Threshold of best precision among those that reach the recall, over ``steps`` score bins."""
    binned = df.groupBy(F.least(F.lit(steps - 1), F.floor(score * steps)).alias("bin")).agg(
        F.count_if(label).alias("pos"), F.count("*").alias("n"))
    above = Window.orderBy(F.desc("bin"))  # at most ``steps`` rows
    cum = binned.select("bin", F.sum("pos").over(above).alias("tp"), F.sum("n").over(above).alias("flagged"))
    total = binned.agg(F.sum("pos"))
    rated = cum.withColumns({
        "precision": F.col("tp") / F.col("flagged"), "recall": F.col("tp") / total.scalar(), "threshold": F.col("bin") / steps})
    best = rated.filter(F.col("recall") >= min_recall).orderBy(F.desc("precision"), F.desc("threshold")).limit(1)
    return best.select("threshold", "precision", "recall")
