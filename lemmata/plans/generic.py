"""Beyond the reference: joins, grouping, ranking, frames and time windows on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lemmata.operators import analytics as A

from .registry import query

C = F.col


@query("join_customer_orders", "", "SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment")
def _(v):
    return v.orders.join(v.customer, C("o_custkey") == C("c_custkey")).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("join_five_tables", "", "SELECT r_name, n_name, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def _(v):
    t = v.lineitem.join(v.orders, C("l_orderkey") == C("o_orderkey")).join(v.customer, C("o_custkey") == C("c_custkey"))
    t = t.join(v.nation, C("c_nationkey") == C("n_nationkey")).join(v.region, C("n_regionkey") == C("r_regionkey"))
    return t.groupBy("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum(C("l_extendedprice") * (1 - C("l_discount"))), 2).alias("revenue"))


@query("pricing_summary", "", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem GROUP BY ALL")
def _(v):
    price = C("l_extendedprice")
    return v.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_price"), F.round(F.sum(price * (1 - C("l_discount")) * (1 + C("l_tax"))), 2).alias("sum_charge"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"),
    )


@query("customers_without_orders", "", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(v):
    return v.customer.join(v.orders, C("c_custkey") == C("o_custkey"), "left_anti").select("c_custkey")


@query("parts_with_returns", "", "SELECT p_partkey, p_brand FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 45)")
def _(v):
    hit = v.lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select("l_partkey")
    return v.part.join(hit, C("p_partkey") == C("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@query("full_outer_counts", "", "SELECT coalesce(s_nationkey, c_nationkey) AS nation, ns, nc FROM (SELECT s_nationkey, count(*) AS ns FROM supplier GROUP BY 1) FULL JOIN (SELECT c_nationkey, count(*) AS nc FROM customer GROUP BY 1) ON s_nationkey = c_nationkey")
def _(v):
    s = v.supplier.groupBy(C("s_nationkey").alias("nation")).agg(F.count("*").alias("ns"))
    c = v.customer.groupBy(C("c_nationkey").alias("nation")).agg(F.count("*").alias("nc"))
    return s.join(c, "nation", "full")


BANDS = "(VALUES (1, 0.0, 5000.0), (2, 5000.0, 20000.0), (3, 20000.0, 50000.0), (4, 40000.0, 90000.0)) AS b(band, lo, hi)"


@query("range_join_price_bands", "", f"SELECT band, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem JOIN {BANDS} ON l_extendedprice >= lo AND l_extendedprice < hi GROUP BY band")
def _(v):
    bands = v.spark.createDataFrame([(1, 0.0, 5000.0), (2, 5000.0, 20000.0), (3, 20000.0, 50000.0), (4, 40000.0, 90000.0)], "band int, lo double, hi double")
    t = A.range_join(v.lineitem.select("l_extendedprice", "l_quantity"), bands, "l_extendedprice", "lo", "hi", 5000.0)
    return t.groupBy("band").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(
    "asof_event_before_order", "",
    "SELECT o_orderkey, e.event_id FROM (SELECT o_orderkey, o_custkey % 150 AS user_id, o_orderdate FROM orders) o ASOF LEFT JOIN (SELECT event_id, user_id, ts - INTERVAL 20 YEAR AS ts FROM events) e ON o.user_id = e.user_id AND o.o_orderdate >= e.ts",
)
def _(v):
    o = v.orders.select("o_orderkey", (C("o_custkey") % 150).alias("user_id"), C("o_orderdate").alias("ts"))
    e = v.events.select("event_id", "user_id", F.expr("ts - INTERVAL 20 YEAR").alias("ts"))
    return A.as_of(o, e, ["user_id"], "ts", ["event_id"]).select("o_orderkey", "event_id")


@query("rollup_region_nation", "", "SELECT n_regionkey, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_name)")
def _(v):
    return v.customer.join(v.nation, C("c_nationkey") == C("n_nationkey")).rollup("n_regionkey", "n_name").agg(F.count("*").alias("n"))


@query("cube_flags", "", "SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, grouping(l_returnflag) + 2 * grouping(l_linestatus) AS g FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)")
def _(v):
    g = F.grouping("l_returnflag").cast("int") + 2 * F.grouping("l_linestatus").cast("int")
    return v.lineitem.cube("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"), g.cast("long").alias("g"))


@query("pivot_returns", "", "SELECT l_linenumber, count(*) FILTER (l_returnflag = 'A') AS A, count(*) FILTER (l_returnflag = 'N') AS N, count(*) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY l_linenumber")
def _(v):
    return v.lineitem.groupBy("l_linenumber").pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1))).na.fill(0)


@query("top_orders_per_customer", "", "SELECT o_custkey, o_orderkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def _(v):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return v.orders.withColumn("rn", F.row_number().over(w).cast("long")).where("rn <= 3").select("o_custkey", "o_orderkey", "rn")


@query("rank_functions", "", "SELECT s_suppkey, rank() OVER w AS r, dense_rank() OVER w AS d, round(percent_rank() OVER w, 6) AS p, round(cume_dist() OVER w, 6) AS c, ntile(4) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS q FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal)")
def _(v):
    w = Window.partitionBy("s_nationkey").orderBy("s_acctbal")
    q = F.ntile(4).over(Window.partitionBy("s_nationkey").orderBy("s_acctbal", "s_suppkey"))
    return v.supplier.select("s_suppkey", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"), F.round(F.percent_rank().over(w), 6).alias("p"), F.round(F.cume_dist().over(w), 6).alias("c"), q.cast("long").alias("q"))


@query("moving_average", "", "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS m, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS d FROM events")
def _(v):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return v.events.select("event_id", F.round(F.avg("value").over(w.rowsBetween(-3, 0)), 6).alias("m"), F.round(C("value") - F.lag("value").over(w), 6).alias("d"))


@query("set_operations", "", "SELECT o_custkey AS k, 'i' AS op FROM orders INTERSECT SELECT c_custkey, 'i' FROM customer WHERE c_acctbal > 0 UNION ALL (SELECT c_custkey, 'e' FROM customer EXCEPT SELECT o_custkey, 'e' FROM orders)")
def _(v):
    o, c = v.orders.select(C("o_custkey").alias("k")), v.customer.select(C("c_custkey").alias("k"), "c_acctbal")
    both = o.intersect(c.where("c_acctbal > 0").select("k")).withColumn("op", F.lit("i"))
    return both.unionByName(c.select("k").subtract(o).withColumn("op", F.lit("e")))


@query("json_properties", "", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def _(v):
    return v.events.groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("embedding_norms", "", "SELECT vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4) AS norm, len(list_filter(embedding, lambda x: x > 0)) AS n_positive FROM embeddings")
def _(v):
    norm = F.sqrt(F.aggregate(F.transform("embedding", lambda x: x.cast("double") * x), F.lit(0.0), lambda s, x: s + x))
    return v.embeddings.select("vec_id", "label", F.round(norm, 4).alias("norm"), F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("n_positive"))


@query("tumbling_windows", "", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(v):
    return v.events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(C("w.start").alias("start"), "event_type", "n", "total")


@query("sliding_windows", "", "SELECT time_bucket(INTERVAL 30 MINUTE, ts) - i * INTERVAL 30 MINUTE AS start, count(*) AS n FROM events, range(0, 2) AS r(i) GROUP BY ALL")
def _(v):
    return v.events.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select(C("w.start").alias("start"), "n")


@query(
    "session_windows", "",
    """WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM f) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""",
)
def _(v):
    return v.events.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", C("w.start").alias("start"), "n")


@query("stack_measures", "", "SELECT p_partkey, m, x FROM (SELECT p_partkey, unnest(['size', 'price']) AS m, unnest([CAST(p_size AS DOUBLE), p_retailprice]) AS x FROM part)")
def _(v):
    return v.part.select("p_partkey", C("p_size").cast("double").alias("size"), C("p_retailprice").alias("price")).unpivot("p_partkey", ["size", "price"], "m", "x")


@query("conversation_turns", "", "SELECT conv_id, count(*) AS n, string_agg(role, '>' ORDER BY turn) AS roles, max(length(text)) AS longest FROM conversations GROUP BY conv_id")
def _(v):
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    return v.conversations.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_join(roles, ">").alias("roles"), F.max(F.length("text")).cast("long").alias("longest"))


@query("stage_dependents", "", "WITH RECURSIVE e(a, b) AS (VALUES ('ingestion', 'classification'), ('classification', 'preprocessing'), ('preprocessing', 'layout'), ('layout', 'text'), ('layout', 'equations'), ('text', 'report'), ('equations', 'report')), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS stage, b AS dependent FROM r")
def _(v):
    from lemmata.operators.stages import EDGES, dependents

    return v.spark.createDataFrame([(s, d) for s in sorted({a for a, _ in EDGES}) for d in sorted(dependents(EDGES, s))], "stage string, dependent string")
