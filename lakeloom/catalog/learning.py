"""Features and machine learning (2.16), and the grouped function of 2.20."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lakeloom.catalog._sql import digest100 as d100
from lakeloom.catalog._sql import emean, esum, hu
from lakeloom.functions import conditional as C
from lakeloom.functions.literals import exact_mean, exact_sum, half_up, ntz
from lakeloom.functions.split import digest100
from lakeloom.operators import features as L
from lakeloom.operators import recommend
from lakeloom.operators import history, quality
from lakeloom.operators import monitoring as N

from lakeloom.registry import query


@query("fea_01_customer_features", f"""
SELECT o_custkey, count(*) AS orders, {esum("o_totalprice")} AS ltv, {hu(emean("o_totalprice"), 4)} AS aov, date_diff('day', max(o_orderdate), TIMESTAMP '2002-01-01') AS recency_days,
 count(DISTINCT o_orderpriority) AS variety FROM orders GROUP BY 1
""")
def customer_features(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"), exact_sum("o_totalprice").alias("ltv"), half_up(exact_mean("o_totalprice"), 4).alias("aov"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.max("o_orderdate")).cast("bigint").alias("recency_days"),
        F.count_distinct("o_orderpriority").alias("variety"))


@query("fea_02_transaction_features", f"""
SELECT user_id, count(*) AS n, {hu(emean("value"), 4)} AS mean, max(value) AS top, round(stddev_samp(value), 4) AS sd,
 {hu("count(*) FILTER (WHERE hour(ts) >= 22 OR hour(ts) < 6) / count(*)", 4)} AS night_ratio FROM events GROUP BY 1
""")
def transaction_features(t):
    h = F.hour("ts")
    return t.events.groupBy("user_id").agg(
        F.count("*").alias("n"), half_up(exact_mean("value"), 4).alias("mean"), F.max("value").alias("top"), F.round(F.stddev("value"), 4).alias("sd"),
        half_up(F.count_if((h >= 22) | (h < 6)) / F.count("*"), 4).alias("night_ratio"))


HOURLY_SQL = f"SELECT user_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS feature_time, count(*) AS n, {esum('value')} AS total FROM events GROUP BY 1, 2"


def hourly(t):
    """Hourly features, stamped with the end of the window: only then are they known."""
    end = F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
    return t.events.groupBy("user_id", end.alias("feature_time")).agg(F.count("*").alias("n"), exact_sum("value").alias("total"))


@query("fea_03_hourly_features", f"SELECT * REPLACE (feature_time::VARCHAR AS feature_time) FROM ({HOURLY_SQL})")
def hourly_features(t):
    return hourly(t)


@query("fea_04_training_set", """
SELECT event_id, event_type = 'purchase' AS label, c_mktsegment AS segment, n.n AS orders FROM events LEFT JOIN customer ON c_custkey = user_id
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) n ON o_custkey = user_id
""")
def training(t):
    labels = t.events.select("event_id", "user_id", (F.col("event_type") == "purchase").alias("label"))
    people = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    orders = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n"))
    looks = [L.Lookup(people, "user_id", ["c_mktsegment"], {"c_mktsegment": "segment"}), L.Lookup(orders, "user_id", ["n"], {"n": "orders"})]
    return L.training_set(labels, looks, exclude=["user_id"])


@query("fea_05_point_in_time_set", f"""
WITH f AS ({HOURLY_SQL}) SELECT event_id, f.n AS n_last_hour, f.total AS total_last_hour FROM events e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.feature_time
""")
def point_in_time(t):
    labels = t.events.select("event_id", "user_id", "ts")
    look = L.Lookup(hourly(t), "user_id", ["n", "total"], {"n": "n_last_hour", "total": "total_last_hour"}, "feature_time", "feature_time")
    return L.training_set(labels, [look], "ts", exclude=["user_id", "ts"])


@query("fea_06_feature_upsert", f"SELECT user_id, {esum('value')} AS total FROM events GROUP BY 1")
def feature_upsert(t):
    cut = F.col("ts") < ntz("2024-01-20")
    stored = t.events.filter(cut).groupBy("user_id").agg(exact_sum("value").alias("total"))
    changed = t.events.join(t.events.filter(~cut).select("user_id").distinct(), "user_id", "left_semi")
    return history.upsert(stored, changed.groupBy("user_id").agg(exact_sum("value").alias("total")), ["user_id"])


@query("fea_07_feature_staleness", """
SELECT user_id, max(ts)::VARCHAR AS last_change, (epoch(TIMESTAMP '2024-01-31')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT) // 3600 AS hours,
 (epoch(TIMESTAMP '2024-01-31')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT) // 3600 > 24 AS stale FROM events GROUP BY 1
""")
def staleness(t):
    return quality.freshness(t.events, "ts", ntz("2024-01-31"), 24, ["user_id"])


SENSOR_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_quantity * l_discount AS power, l_tax - l_discount AS diff, l_quantity / nullif(l_discount, 0) AS ratio, l_quantity > 40 AS high_load,
 CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS code,
 floor((CASE WHEN l_quantity > 40 THEN 0.4 ELSE 0 END + CASE WHEN l_discount > 0.07 THEN 0.3 ELSE 0 END + CASE WHEN l_tax > 0.05 THEN 0.3 ELSE 0 END)::DOUBLE * 1e4 + 0.5) / 1e4 AS risk FROM lineitem
"""


def sensors(t):
    q, d, x = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")

    def part(test, w):
        return F.when(test, F.lit(w)).otherwise(F.lit(0.0))

    code = F.create_map(F.lit("A"), F.lit(0), F.lit("N"), F.lit(1))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", (q * d).alias("power"), (x - d).alias("diff"), F.try_divide(q, F.nullif(d, F.lit(0.0))).alias("ratio"),
        (q > 40).alias("high_load"), F.coalesce(code[F.col("l_returnflag")], F.lit(2)).alias("code"),
        half_up(part(q > 40, 0.4) + part(d > 0.07, 0.3) + part(x > 0.05, 0.3), 4).alias("risk"))


@query("fea_08_derived_features", SENSOR_SQL)
def derived(t):
    return sensors(t)


@query("fea_09_target_correlation", f"""
WITH s AS ({SENSOR_SQL}) SELECT 'power' AS feature, round(corr(power, risk), 6) AS correlation FROM s UNION ALL SELECT 'diff', round(corr(diff, risk), 6) FROM s
UNION ALL SELECT 'l_quantity', round(corr(l_quantity, risk), 6) FROM s
""")
def correlation(t):
    return L.target_correlations(sensors(t), ["power", "diff", "l_quantity"], "risk").withColumn("correlation", F.round("correlation", 6))


MATRIX_SQL = """
SELECT o_custkey AS cust, p_brand AS brand, count(*) AS views, sum(l_quantity) AS minutes, avg(l_quantity / 50) AS completion FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
"""


def matrix(t):
    """Implicit rating 0.3 views + 0.3 minutes + 0.4 * 100 * completion per customer and brand."""
    base = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("o_custkey").alias("cust"), F.col("p_brand").alias("brand"))
            .agg(F.count("*").alias("views"), F.sum("l_quantity").alias("minutes"), F.avg(F.col("l_quantity") / 50).alias("completion")))
    return base.withColumn("rating", 0.3 * F.col("views") + 0.3 * F.col("minutes") + 40 * F.col("completion"))


@query("fea_10_interaction_matrix", f"""
WITH m AS ({MATRIX_SQL}), u AS (SELECT cust, dense_rank() OVER (ORDER BY cust) - 1 AS user_no FROM (SELECT DISTINCT cust FROM m)),
 i AS (SELECT brand, dense_rank() OVER (ORDER BY brand) - 1 AS item_no FROM (SELECT DISTINCT brand FROM m))
SELECT user_no::INT AS user_no, item_no::INT AS item_no, round(0.3::DOUBLE * views + 0.3::DOUBLE * minutes + 40 * completion, 4) AS rating FROM m JOIN u USING (cust) JOIN i USING (brand)
""")
def interactions(t):
    m = matrix(t)
    users, items = L.dense_ids(m, "cust", "user_no"), L.dense_ids(m, "brand", "item_no")
    return m.join(users, "cust").join(items, "brand").select("user_no", "item_no", F.round("rating", 4).alias("rating"))


@query("fea_11_als_recommendations")
def als(t):
    """Top three brands per customer from the best of three factor models on a held-out fifth."""
    items = L.dense_ids(t.part, "p_brand", "item_no")
    m = matrix(t).join(items, F.col("brand") == F.col("p_brand")).select(F.col("cust").cast("int").alias("cust"), "item_no", F.col("rating").cast("float").alias("rating"))
    key = F.concat_ws(":", F.col("cust").cast("string"), F.col("item_no").cast("string"))
    train, test = m.filter(digest100(key) < 80).persist(), m.filter(digest100(key) >= 80).persist()
    try:
        best = None
        for rank, reg in ((4, 0.1), (8, 0.1), (8, 0.5)):
            als_ = ALS(userCol="cust", itemCol="item_no", ratingCol="rating", rank=rank, regParam=reg, maxIter=5, seed=42, coldStartStrategy="drop")
            model = als_.fit(train)
            rmse = L.error_metrics(model.transform(test), F.col("rating"), F.col("prediction")).first().rmse
            if best is None or rmse < best[0]:
                best = (rmse, model)
    finally:
        train.unpersist()
        test.unpersist()
    recs = recommend.top_items(best[1].userFactors, best[1].itemFactors, 3)
    return recs.join(items, F.col("item") == F.col("item_no")).select(
        F.col("user").cast("int").alias("cust"), F.col("rank").cast("int").alias("rank"), F.col("p_brand").alias("brand"), F.round("score", 2).alias("score"))


PART_SQL = f"""
p AS (SELECT *, {d100("cust || ':' || brand")} AS d FROM ({MATRIX_SQL})),
pop AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, brand) AS rank FROM p WHERE d < 80 GROUP BY brand)
"""


@query("fea_12_ranking_metrics", f"""
WITH {PART_SQL}, rel AS (SELECT cust, brand FROM p WHERE d >= 80), n AS (SELECT cust, count(*) AS n_rel FROM rel GROUP BY 1),
 h AS (SELECT cust, count(*) AS hits, sum(1 / log2(rank + 1)) AS dcg FROM rel JOIN pop USING (brand) WHERE rank <= 10 GROUP BY 1)
SELECT round(avg(coalesce(hits, 0) / 10), 6) AS precision, round(avg(coalesce(hits, 0) / n_rel), 6) AS recall,
 round(avg(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(n_rel, 10) + 1), lambda i: 1 / log2(i + 1)))), 6) AS ndcg, count(*) AS users FROM n LEFT JOIN h USING (cust)
""")
def ranking(t):
    """Popularity recommender against a held-out fifth; the ranked list is the same for everyone."""
    d = digest100(F.concat_ws(":", F.col("cust").cast("string"), "brand"))
    m = matrix(t).withColumn("d", d)
    popular = m.filter("d < 80").groupBy("brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "brand").limit(10)
    top = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "brand")))
    listed = popular.agg(F.transform(top, lambda x: x["brand"]).alias("top"))
    rel = m.filter("d >= 80").select("cust", "brand")
    everyone = rel.select("cust").distinct().withColumn("top", listed.scalar())
    recs = everyone.select("cust", F.posexplode("top").alias("pos", "brand"))
    out = L.holdout_metrics(recs.select("cust", "brand", (F.col("pos") + 1).alias("rank")), rel, "cust", "brand", "rank", 10)
    return out.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "ndcg")], "users")


@query("fea_13_blend_recommenders", """
WITH a AS (SELECT o_custkey AS cust, o_orderpriority AS item, count(*)::DOUBLE AS score FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
 b AS (SELECT o_custkey AS cust, o_orderpriority AS item, count(*) * 2.0::DOUBLE AS score FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2),
 m AS (SELECT coalesce(a.cust, b.cust) AS cust, coalesce(a.item, b.item) AS item, coalesce(a.score, 0) * 0.5 + coalesce(b.score, 0) * 0.5 AS score FROM a FULL JOIN b ON a.cust = b.cust AND a.item = b.item)
SELECT cust, item, score, row_number() OVER (PARTITION BY cust ORDER BY score DESC, item) AS rank FROM m QUALIFY rank <= 3
""")
def blended(t):
    def scored(test, weight):
        return t.orders.filter(test).groupBy(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("item")).agg((F.count("*") * F.lit(weight)).alias("score"))

    return L.blend(scored("o_orderstatus <> 'P'", 1.0), scored("o_orderstatus = 'P'", 2.0), "cust", "item", "score", 0.5, 3)


MODEL_COLS = ["l_quantity", "l_discount", "l_tax"]


def _vectors(df):
    return VectorAssembler(inputCols=MODEL_COLS, outputCol="features").transform(df)


@query("fea_14_batch_scoring")
def scoring(t):
    """Logistic model trained on four fifths of the orders, applied to every row, probability banded into risk tiers.

    Beside each tier's mean probability stands the share of positive rows among its held-out ones, which the model has not seen.
    """
    label = (F.col("l_quantity") * F.col("l_discount") > 2).cast("double")
    rows = _vectors(t.lineitem.withColumns({"label": label, "held_out": digest100("l_orderkey") >= 80}))
    model = LogisticRegression(maxIter=20).fit(rows.filter("NOT held_out"))
    p = vector_to_array("probability")[1]
    tier = C.band_from(p, L.RISK_TIERS, "low")
    return model.transform(rows).groupBy(tier.alias("tier")).agg(
        F.count("*").alias("n"), F.round(F.avg(p), 4).alias("mean_p"), F.count_if("held_out").alias("n_held_out"),
        F.round(F.avg(F.when(F.col("held_out"), F.col("label"))), 4).alias("held_out_share"))


RATIOS = {"tool_wear": 0.3, "heat": 0.25, "power": 0.2, "overstrain": 0.15, "random": 0.1}
SCORE_SQL = "1 / (1 + exp(-(0.02 * value - 1)))"


def scored_events(t):
    return t.events.withColumn("p", 1 / (1 + F.exp(-(F.lit(0.02) * F.col("value") - 1))))


@query("fea_15_split_probability", "SELECT event_id, " + ", ".join(f"round({SCORE_SQL} * {r}, 8) AS {n}" for n, r in RATIOS.items()) + " FROM events")
def split_probability(t):
    return scored_events(t).select("event_id", *[F.round(F.col("p") * r, 8).alias(n) for n, r in RATIOS.items()])


@query("fea_16_model_per_group", """
SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 4) AS r2
FROM lineitem GROUP BY 1
""")
def per_group(t):
    """Least squares per supplier from sums, so no supplier's rows have to meet in one task."""
    fit = ("l_extendedprice", "l_quantity")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.regr_slope(*fit), 4).alias("slope"), F.round(F.regr_intercept(*fit), 4).alias("intercept"), F.round(F.regr_r2(*fit), 4).alias("r2"))


@query("fea_17_vector_assembly", """
SELECT l_orderkey, l_linenumber, l_partkey, 3 AS size, round(l_quantity + l_discount + l_tax, 4) AS total FROM lineitem
""")
def assembly(t):
    arr = vector_to_array("features")
    return _vectors(t.lineitem).select("l_orderkey", "l_linenumber", "l_partkey", F.size(arr).alias("size"),
                                       F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("fea_18_drift_simulation", f"""
WITH s AS (SELECT shift, value > 60 AS label, 1 / (1 + exp(-(0.02 * (value + shift) - 1))) > 0.55 AS pred FROM events, (FROM (VALUES (0), (10), (20), (40), (80)) v(shift)))
SELECT shift, round(2 * count(*) FILTER (WHERE label AND pred) / (2 * count(*) FILTER (WHERE label AND pred) + count(*) FILTER (WHERE label <> pred)), 6) AS f1 FROM s GROUP BY 1
""")
def drift_simulation(t):
    shifted = t.events.withColumn("shift", F.explode(F.array(*[F.lit(x) for x in (0, 10, 20, 40, 80)])))
    pred = 1 / (1 + F.exp(-(F.lit(0.02) * (F.col("value") + F.col("shift")) - 1))) > 0.55
    return N.confusion(shifted, ["shift"], F.col("value") > 60, pred).select("shift", F.round("f1", 6).alias("f1"))


LABEL = "event_type = 'purchase' OR value > 120"


@query("fea_19_business_value", f"""
WITH s AS (SELECT {LABEL} AS l, {SCORE_SQL} > 0.5 AS p FROM events) SELECT count(*) FILTER (WHERE l AND p) AS tp, count(*) FILTER (WHERE NOT l AND p) AS fp, count(*) FILTER (WHERE l AND NOT p) AS fn,
 count(*) FILTER (WHERE l AND p) * 5000.0::DOUBLE - count(*) FILTER (WHERE NOT l AND p) * 500.0::DOUBLE - count(*) FILTER (WHERE l AND NOT p) * 8000.0::DOUBLE
 - count(*) FILTER (WHERE l AND p) * 1000.0::DOUBLE AS value FROM s
""")
def value(t):
    return L.business_value(scored_events(t), F.expr(LABEL), F.col("p") > 0.5, 5000.0, 500.0, 8000.0, 1000.0)


@query("fea_20_threshold_choice", f"""
WITH s AS (SELECT {LABEL} AS l, least(99, floor({SCORE_SQL} * 100)) AS bin FROM events), b AS (SELECT bin, count(*) FILTER (WHERE l) AS pos, count(*) AS n FROM s GROUP BY 1),
 c AS (SELECT bin, sum(pos) OVER (ORDER BY bin DESC) AS tp, sum(n) OVER (ORDER BY bin DESC) AS flagged, sum(pos) OVER () AS total FROM b)
SELECT bin / 100 AS threshold, tp / flagged AS precision, tp / total AS recall FROM c WHERE tp / total >= 0.8 ORDER BY precision DESC, threshold DESC LIMIT 1
""")
def threshold(t):
    return L.choose_threshold(scored_events(t), F.col("p"), F.expr(LABEL), 0.8)


@query("fea_21_class_weights", f"SELECT {hu(f'count(*) FILTER (WHERE NOT ({LABEL})) / count(*) FILTER (WHERE {LABEL})', 6)} AS positive_weight, count(*) AS rows FROM events")
def class_weights(t):
    label = F.expr(LABEL)
    return t.events.agg(half_up(F.try_divide(F.count_if(~label), F.count_if(label)), 6).alias("positive_weight"), F.count("*").alias("rows"))


@query("fea_21b_weighted_fit", f"""
WITH l AS (SELECT value AS x, CASE WHEN {LABEL} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM events),
 p AS (SELECT count(*) FILTER (WHERE y = 0)::DOUBLE / count(*) FILTER (WHERE y = 1) AS pw FROM l),
 s AS (SELECT sum(w) AS w, sum(w * x) AS x, sum(w * y) AS y, sum(w * x * y) AS xy, sum(w * x * x) AS xx FROM (SELECT x, y, CASE WHEN y = 1 THEN pw ELSE 1 END AS w FROM l, p))
SELECT round((w * xy - x * y) / (w * xx - x * x), 6) AS slope, round((y - (w * xy - x * y) / (w * xx - x * x) * x) / w, 6) AS intercept FROM s
""")
def weighted_fit(t):
    """A linear probability model whose fit gives each positive row the weight negatives / positives; one pass over the rows."""
    label = F.expr(LABEL)
    weight = t.events.agg(F.try_divide(F.count_if(~label), F.count_if(label)).alias("w")).scalar()
    rows = t.events.select("value", label.cast("double").alias("label"), F.when(label, weight).otherwise(1.0).alias("weight"))
    rows = VectorAssembler(inputCols=["value"], outputCol="features").transform(rows)
    model = LinearRegression(weightCol="weight", solver="normal").fit(rows)
    return t.spark.createDataFrame([(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6))], "slope double, intercept double")


@query("fea_22_champion_challenger", f"""
WITH s AS (SELECT model, {LABEL} AS l, CASE model WHEN 'champion' THEN {SCORE_SQL} > 0.5 ELSE value > 90 END AS p FROM events, (FROM (VALUES ('champion'), ('challenger')) v(model))),
 m AS (SELECT model, round(2 * count(*) FILTER (WHERE l AND p) / (2 * count(*) FILTER (WHERE l AND p) + count(*) FILTER (WHERE l <> p)), 6) AS f1,
  round(count(*) FILTER (WHERE l AND p) / count(*) FILTER (WHERE l), 6) AS recall FROM s GROUP BY 1)
SELECT a.f1 AS champion_f1, b.f1 AS challenger_f1, a.recall AS champion_recall, b.recall AS challenger_recall, b.f1 > a.f1 AS promote FROM m a, m b WHERE a.model = 'champion' AND b.model = 'challenger'
""")
def champion(t):
    both = scored_events(t).select(F.expr(LABEL).alias("l"), (F.col("p") > 0.5).alias("champion"), (F.col("value") > 90).alias("challenger"))
    long = both.withColumn("m", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("p")) for n in ("champion", "challenger")])))
    per = N.confusion(long.select("l", "m.*"), ["model"], F.col("l"), F.col("p")).select("model", F.round("f1", 6).alias("f1"), F.round("recall", 6).alias("recall"))
    wide = per.agg(*[F.max(F.when(F.col("model") == n, F.col(c))).alias(f"{n}_{c}") for n in ("champion", "challenger") for c in ("f1", "recall")])
    return wide.withColumn("promote", F.col("challenger_f1") > F.col("champion_f1"))


@query("udf_05_grouped_function", f"""
SELECT o_orderpriority, o_orderstatus, count(*) AS n, {hu(emean("o_totalprice"), 2)} AS mean FROM orders GROUP BY 1, 2
""")
def grouped(t):
    """Grouped function over partial sums: each group reaches Python as a few combined rows, whatever its size."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    parts = t.orders.groupBy("o_orderpriority", "o_orderstatus", F.month("o_orderdate").alias("part")).agg(
        F.count("*").alias("n"), (F.sum(price) * 100).cast("bigint").alias("cents"))

    def merge(pdf):
        n, cents = int(pdf["n"].sum()), int(pdf["cents"].sum())
        row = pdf.iloc[[0]][["o_orderpriority", "o_orderstatus"]].copy()
        row["n"], row["mean"] = n, cents / 100 / n
        return row

    out = parts.groupBy("o_orderpriority", "o_orderstatus").applyInPandas(merge, "o_orderpriority string, o_orderstatus string, n long, mean double")
    return out.withColumn("mean", half_up(F.col("mean"), 2))


@query("udf_05b_monotone_trend", """
WITH d AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2),
 i AS (SELECT event_type, day, n, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i, sum(n) OVER (PARTITION BY event_type ORDER BY day) AS upto FROM d),
 m AS (SELECT a.event_type, a.i AS first, z.i AS last, (z.upto - a.upto + a.n)::DOUBLE / (z.i - a.i + 1) AS mean FROM i a JOIN i z ON a.event_type = z.event_type AND a.i <= z.i),
 low AS (SELECT i.event_type, i.i, m.first, min(m.mean) AS least FROM i JOIN m ON m.event_type = i.event_type AND m.first <= i.i AND i.i <= m.last GROUP BY 1, 2, 3)
SELECT i.event_type, i.day::VARCHAR AS day, i.n, round(max(least), 6) AS trend FROM i JOIN low USING (event_type, i) GROUP BY 1, 2, 3
""")
def monotone_trend(t):
    """The rising curve closest to each event type's daily counts (pooled adjacent violators); a group is one row per day."""
    daily = t.events.filter("ts IS NOT NULL").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))

    def rise(pdf):
        pdf = pdf.sort_values("day")
        blocks = []
        for n in pdf["n"].tolist():
            total, size = n, 1
            while blocks and blocks[-1][0] * size >= total * blocks[-1][1]:
                before = blocks.pop()
                total, size = total + before[0], size + before[1]
            blocks.append((total, size))
        return pdf.assign(trend=[total / size for total, size in blocks for _ in range(size)])

    return daily.groupBy("event_type").applyInPandas(rise, "event_type string, day date, n long, trend double").withColumn("trend", F.round("trend", 6))
