"""Governance on data (2.13): masks, row filters, audit reports. ``events`` serves as the audit log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakeloom.catalog._sql import hu
from lakeloom.functions import masks as M
from lakeloom.functions import text as X
from lakeloom.functions.literals import half_up, ntz
from lakeloom.operators import graph, joins
from lakeloom.plans import skew
from lakeloom.registry import TABLE_NAMES, query

PEOPLE_SQL = """
people AS (SELECT c_custkey AS id, 'User' || c_custkey || '@Mail' || c_nationkey || '.com' AS email,
 '010-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') || '-' || lpad((c_custkey * 7 % 10000)::VARCHAR, 4, '0') AS phone,
 lpad((c_custkey % 1000000)::VARCHAR, 6, '0') || '-1234567' AS national_id,
 '1234-5678-9012-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS card, 18 + c_custkey % 60 AS age, c_acctbal AS salary,
 'u' || c_custkey % 50 AS owner, c_nationkey AS nation, c_mktsegment AS department FROM customer)
"""


def people(t):
    k = F.col("c_custkey")

    def text(c):
        return c.cast("string")

    return t.customer.select(
        k.alias("id"), F.concat(F.lit("User"), text(k), F.lit("@Mail"), text(F.col("c_nationkey")), F.lit(".com")).alias("email"),
        F.concat(F.lit("010-"), F.lpad(text(k % 10000), 4, "0"), F.lit("-"), F.lpad(text(k * 7 % 10000), 4, "0")).alias("phone"),
        F.concat(F.lpad(text(k % 1000000), 6, "0"), F.lit("-1234567")).alias("national_id"),
        F.concat(F.lit("1234-5678-9012-"), F.lpad(text(k % 10000), 4, "0")).alias("card"), (18 + k % 60).alias("age"),
        F.col("c_acctbal").alias("salary"), F.concat(F.lit("u"), text(k % 50)).alias("owner"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("department"))


SUPPORT = M.Principal("u7", frozenset({"support", "eu"}))
ANALYST = M.Principal("u8", frozenset({"analysts"}))


@query("gov_01_partial_masks", f"""
WITH {PEOPLE_SQL} SELECT id, left(email, 2) || '***@' || split_part(email, '@', 2) AS email, left(phone, 3) || '-****-' || right(phone, 4) AS phone,
 left(national_id, 6) || '-*******' AS national_id, '****-****-****-' || right(card, 4) AS card FROM people
""")
def partial(t):
    levels = {"admins": "raw", "support": "partial"}
    masks = {"email": M.email_partial, "phone": M.phone_partial, "national_id": M.national_id_partial, "card": M.card_partial}
    return people(t).select("id", *[M.by_level(SUPPORT, F.col(c), f(F.col(c)), levels).alias(c) for c, f in masks.items()])


@query("gov_02_four_level_mask", f"""
WITH {PEOPLE_SQL} SELECT id, email AS admin, left(email, 2) || '***@' || split_part(email, '@', 2) AS support,
 sha256(lower(trim(email))) AS analyst, '[REDACTED]' AS other FROM people
""")
def four_levels(t):
    levels = {"admins": "raw", "support": "partial", "analysts": "hash"}
    who = {"admin": M.Principal("a", {"admins"}), "support": SUPPORT, "analyst": ANALYST, "other": M.Principal("x")}
    e = F.col("email")
    return people(t).select("id", *[M.by_level(p, e, M.email_partial(e), levels).alias(n) for n, p in who.items()])


@query("gov_03_joinable_pseudonym", f"""
WITH {PEOPLE_SQL} SELECT sha256(lower(email)) AS person, count(*) AS orders FROM people JOIN orders ON o_custkey = id GROUP BY 1
""")
def pseudonyms(t):
    # the order side knows the address in other spelling; the pseudonyms still meet
    mails = people(t).select("id", "email")
    crm = mails.select(M.pseudonym(F.col("email")).alias("person"))
    shop = t.orders.join(mails, F.col("o_custkey") == F.col("id")).select(
        M.pseudonym(F.concat(F.lit(" "), F.upper("email"))).alias("person"))
    return shop.groupBy("person").agg(F.count("*").alias("orders")).join(crm, "person", "left_semi")


@query("gov_04_generalization", f"WITH {PEOPLE_SQL} SELECT (age // 10) * 10 AS decade, count(*) AS n FROM people GROUP BY 1")
def generalized(t):
    return people(t).groupBy(M.decade(F.col("age")).alias("decade")).agg(F.count("*").alias("n"))


@query("gov_05_mask_by_owner", f"WITH {PEOPLE_SQL} SELECT id, CASE WHEN owner = 'u8' THEN salary END AS salary FROM people")
def by_owner(t):
    return people(t).select("id", M.own_value(ANALYST, F.col("owner"), F.col("salary"), "hr").alias("salary"))


@query("gov_06_row_filters", f"""
WITH {PEOPLE_SQL} SELECT 'group' AS filter, count(*) AS n FROM people WHERE nation IN (1, 2, 3)
UNION ALL SELECT 'department', count(*) FROM people WHERE department = 'BUILDING' UNION ALL SELECT 'owner', count(*) FROM people WHERE owner = 'u7'
UNION ALL SELECT 'date', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
UNION ALL SELECT 'two_columns', count(*) FROM people WHERE nation IN (1, 2, 3) AND department = 'BUILDING'
""")
def row_filters(t):
    p = people(t)
    nation = M.rows_of_groups(SUPPORT, F.col("nation"), {"eu": [1, 2, 3], "us": [4]}, "admins")
    dept = M.rows_of_groups(SUPPORT, F.col("department"), {"support": ["BUILDING"]}, "admins")
    counts = {
        "group": p.filter(nation), "department": p.filter(dept), "owner": p.filter(M.rows_owned(SUPPORT, F.col("owner"), "admins")),
        "date": t.orders.filter(M.rows_since(SUPPORT, F.col("o_orderdate"), ntz("2001-01-01"), "admins")), "two_columns": p.filter(nation & dept),
    }
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("filter"), "n") for n, df in counts.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("gov_07_mapping_table_filter", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))
""")
def mapping(t):
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    mine = regions.filter(F.col("r_name").isin("ASIA", "EUROPE")).select("n_nationkey")
    return t.customer.join(skew.checked_broadcast(mine), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_nationkey")


NAME_PATTERNS = {"name": "person_name", "acctbal": "financial", "phone": "contact", "address": "contact"}


@query("gov_08_pii_column_names", """
SELECT 'customer' AS table_name, 'c_name' AS column_name, 'person_name' AS suspected, count(c_name) AS filled, 'missing' AS tag FROM customer
UNION ALL SELECT 'customer', 'c_acctbal', 'financial', count(c_acctbal), 'present' FROM customer
UNION ALL SELECT 'supplier', 's_name', 'person_name', count(s_name), 'missing' FROM supplier
UNION ALL SELECT 'supplier', 's_acctbal', 'financial', count(s_acctbal), 'missing' FROM supplier
""")
def column_names(t):
    """Suspicious columns of each table, with how many values they hold and whether they are tagged."""
    tagged = {("customer", "c_acctbal")}
    found = []
    for name in ("customer", "supplier"):
        df = getattr(t, name)
        hits = {c: kind for c in df.columns for p, kind in NAME_PATTERNS.items() if p in c}
        wide = df.agg(*[F.count(c).alias(c) for c in hits])
        long = wide.unpivot([], list(hits), "column_name", "filled")
        kinds = F.create_map(*[F.lit(x) for kv in hits.items() for x in kv])
        tags = F.when(F.col("column_name").isin([c for tb, c in tagged if tb == name]), "present").otherwise("missing")
        found.append(long.select(F.lit(name).alias("table_name"), "column_name", kinds[F.col("column_name")].alias("suspected"), "filled", tags.alias("tag")))
    return reduce(lambda a, b: a.unionByName(b), found)


COLUMN_PATTERNS = [("%name%", "person_name"), ("%acctbal%", "financial"), ("%price%", "financial"), ("%text%", "free_text"), ("%url%", "web_address"),
                   ("user_id", "person_key"), ("%custkey%", "person_key")]
COLUMN_TAGS = [("customer", "c_acctbal"), ("documents", "text"), ("events", "user_id")]


@query("gov_08b_pii_all_tables", """
WITH p(pattern, kind) AS (VALUES """ + ", ".join(map(str, COLUMN_PATTERNS)) + """),
 c AS (SELECT DISTINCT table_name, column_name FROM information_schema.columns WHERE table_name IN (""" + ", ".join(f"'{n}'" for n in TABLE_NAMES) + """)),
 f(table_name, filled) AS (""" + " UNION ALL ".join(f"SELECT '{n}', count(*) FROM {n}" for n in TABLE_NAMES) + """),
 g(table_name, column_name) AS (VALUES """ + ", ".join(map(str, COLUMN_TAGS)) + """)
SELECT c.table_name, c.column_name, kind AS suspected, filled AS rows, CASE WHEN g.column_name IS NULL THEN 'missing' ELSE 'present' END AS tag
FROM c JOIN p ON c.column_name LIKE pattern JOIN f ON f.table_name = c.table_name LEFT JOIN g ON g.table_name = c.table_name AND g.column_name = c.column_name
""")
def column_names_of_all(t):
    """Every table's columns that match a pattern of the pattern table, with the table's rows and whether the tag table names them."""
    schema = [(n, c) for n in TABLE_NAMES for c in getattr(t, n).columns]
    columns = t.spark.createDataFrame(schema, "table_name string, column_name string")
    patterns = t.spark.createDataFrame(COLUMN_PATTERNS, "pattern string, suspected string")
    tags = t.spark.createDataFrame([(*x, "present") for x in COLUMN_TAGS], "table_name string, column_name string, tag string")
    rows = reduce(lambda a, b: a.unionByName(b), [
        getattr(t, n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in TABLE_NAMES])
    found = columns.join(patterns, F.like("column_name", F.col("pattern")))  # schema rows and patterns, not data
    return found.join(rows, "table_name").join(tags, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "suspected", "rows", F.coalesce("tag", F.lit("missing")).alias("tag"))


@query("gov_09_pii_scan", "SELECT lang, " + ", ".join(
    f"sum(len(regexp_extract_all(text, '{X.PII[k]}')))::BIGINT AS {k}" for k in X.PII_ORDER) + " FROM documents GROUP BY 1")
def pii_scan(t):
    return t.spread("documents", "doc_id").groupBy("lang").agg(*[F.sum(X.count_matches(F.col("text"), X.PII[k])).alias(k) for k in X.PII_ORDER])


_REDACTED = "text"
for _k in X.PII_ORDER:
    _REDACTED = f"regexp_replace({_REDACTED}, '{X.PII[_k]}', '[{_k.upper()}]', 'g')"


@query("gov_09b_pii_redaction", f"SELECT doc_id, md5({_REDACTED}) AS digest FROM documents")
def pii_redaction(t):
    return t.spread("documents", "doc_id").select("doc_id", F.md5(X.redact(F.col("text"))).alias("digest"))


BLOCKED = ["idiot", "loser", "clown", "moron"]


@query("gov_10_keyword_block", f"""
WITH d AS (SELECT source, len(list_intersect(regexp_split_to_array(lower(text), '{X.WORD}'), {BLOCKED})) > 0 AS blocked FROM documents)
SELECT source, count(*) AS n, count(*) FILTER (WHERE blocked) AS blocked, {hu("count(*) FILTER (WHERE blocked) * 100.0::DOUBLE / count(*)", 2)} AS block_pct FROM d GROUP BY 1
""")
def keyword_block(t):
    hit = F.arrays_overlap(X.tokens(F.col("text")), F.array(*[F.lit(w) for w in BLOCKED]))
    return t.spread("documents", "doc_id").groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(hit).alias("blocked"), half_up(F.count_if(hit) * F.lit(100.0) / F.count("*"), 2).alias("block_pct"))


TOPICS = [("insult", "idiot"), ("insult", "loser"), ("insult", "clown"), ("insult", "moron"), ("secrets", "password"), ("secrets", "token")]


@query("gov_10b_topic_block_per_day", f"""
WITH k(topic, word) AS (VALUES {", ".join(map(str, TOPICS))}),
 d AS (SELECT DATE '2024-01-01' + (doc_id % 30)::INT AS day, doc_id, list_distinct(regexp_split_to_array(lower(text), '{X.WORD}')) AS words FROM documents),
 h AS (SELECT DISTINCT day, doc_id, topic FROM d JOIN k ON list_contains(words, word)),
 n AS (SELECT day, count(*) AS requests FROM d GROUP BY 1)
SELECT day::VARCHAR AS day, topic, requests, count(*) AS blocked, {hu("count(*) * 100.0::DOUBLE / requests", 2)} AS block_pct FROM h JOIN n USING (day) GROUP BY 1, 2, 3
""")
def topic_block(t):
    """Requests per day (a document's day comes from its id) that hold a word of the keyword table, by the table's topic.

    Words are matched inside the row before anything is exchanged: the table becomes one map of words to topics.
    """
    table = t.spark.createDataFrame(TOPICS, "topic string, word string")
    words = table.agg(F.map_from_entries(F.collect_list(F.struct("word", "topic")))).scalar()
    day = F.expr("date_add(DATE '2024-01-01', cast(doc_id % 30 AS int))")
    docs = t.spread("documents", "doc_id").select(day.alias("day"), X.tokens(F.col("text")).alias("tokens"), words.alias("words"))
    hits = docs.withColumn("topics", F.array_distinct(F.array_compact(F.transform("tokens", lambda w: F.try_element_at(F.col("words"), w)))))
    # a request counts once in its day, and once in each of its topics
    rows = hits.select("day", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("topics", F.array()))).alias("topic"))
    per = rows.groupBy("day", "topic").agg(F.count("*").alias("n"))
    whole = per.filter("topic IS NULL").select("day", F.col("n").alias("requests"))
    return per.filter("topic IS NOT NULL").join(whole, "day").select(
        "day", "topic", "requests", F.col("n").alias("blocked"), half_up(F.col("n") * F.lit(100.0) / F.col("requests"), 2).alias("block_pct"))


@query("gov_11b_failures_per_address", """
SELECT user_id, '10.0.0.' || json_extract_string(props, '$.k')::INT // 10 AS address, count(*) AS failures, min(ts)::VARCHAR AS first_seen
FROM events WHERE event_type = 'error' GROUP BY 1, 2 HAVING count(*) > 5
""")
def failures_per_address(t):
    """More than five failures of one user from one address (the audit log's address block comes from ``props``)."""
    address = F.concat(F.lit("10.0.0."), F.expr("cast(get_json_object(props, '$.k') AS int) div 10").cast("string"))
    failed = t.events.filter("event_type = 'error'").groupBy("user_id", address.alias("address"))
    return failed.agg(F.count("*").alias("failures"), F.min("ts").cast("string").alias("first_seen")).filter("failures > 5")


@query("gov_11_failed_login_burst", """
SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY user_id, ts::DATE HAVING count(*) > 2
""")
def burst(t):
    failed = t.events.filter("event_type = 'error'").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("failures"))
    return failed.filter("failures > 2")


@query("gov_12_access_breadth", """
SELECT user_id, count(DISTINCT json_extract_string(props, '$.k')) AS objects FROM events GROUP BY 1 HAVING objects > 50
""")
def breadth(t):
    k = F.get_json_object("props", "$.k")
    return t.events.groupBy("user_id").agg(F.count_distinct(k).alias("objects")).filter("objects > 50")


@query("gov_13_night_and_weekend", """
SELECT user_id, count(*) FILTER (WHERE hour(ts) >= 22 OR hour(ts) < 6) AS night, count(*) FILTER (WHERE dayofweek(ts) IN (0, 6)) AS weekend FROM events GROUP BY 1
""")
def night(t):
    h = F.hour("ts")
    return t.events.groupBy("user_id").agg(
        F.count_if((h >= 22) | (h < 6)).alias("night"), F.count_if(F.dayofweek("ts").isin(1, 7)).alias("weekend"))


@query("gov_14_daily_service_trend", """
SELECT ts::DATE::VARCHAR AS day, event_type AS service, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY ts::DATE, 2
""")
def trend(t):
    return t.events.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("service")).agg(
        F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query("gov_15_lineage_downstream", """
WITH RECURSIVE e AS (SELECT DISTINCT 'supplier_' || s_suppkey // 3 AS source, 'supplier_' || s_suppkey AS target FROM supplier WHERE s_suppkey > 0
  UNION SELECT 'supplier_' || s_suppkey, 'nation_' || s_nationkey FROM supplier UNION SELECT 'nation_' || n_nationkey, 'region_' || n_regionkey FROM nation
  UNION SELECT 'region_' || r_regionkey, 'supplier_0' FROM region),
 r AS (SELECT 'supplier_0' AS node, 0 AS hops UNION SELECT target, hops + 1 FROM r JOIN e ON source = node WHERE hops < 5)
SELECT node, min(hops)::BIGINT AS hops FROM r GROUP BY 1 HAVING min(hops) > 0
""")
def lineage(t):
    def node(prefix, c):
        return F.concat(F.lit(prefix), c.cast("string"))

    s, n = t.supplier, t.nation
    edges = (
        s.filter("s_suppkey > 0").select(node("supplier_", F.expr("s_suppkey div 3")).alias("source"), node("supplier_", F.col("s_suppkey")).alias("target"))
        .unionByName(s.select(node("supplier_", F.col("s_suppkey")).alias("source"), node("nation_", F.col("s_nationkey")).alias("target")))
        .unionByName(n.select(node("nation_", F.col("n_nationkey")).alias("source"), node("region_", F.col("n_regionkey")).alias("target")))
        .unionByName(t.region.select(node("region_", F.col("r_regionkey")).alias("source"), F.lit("supplier_0").alias("target"))))
    start = s.filter("s_suppkey = 0").select(node("supplier_", F.col("s_suppkey")).alias("node"))
    return graph.reachable(edges, start, 5)


@query("gov_16_minimum_cohort", """
SELECT c_nationkey, count(DISTINCT c_custkey) AS matched FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY 1 HAVING matched >= 55
""")
def cohort(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.overlap_at_least(t.customer, urgent, "c_custkey", ["c_nationkey"], 55)
