"""Relational jobs: projections, filters, keyed aggregates, set operations
and equi-joins (P*, A*, X*, J01-J13, J21-J26) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import exact_sum, int_to_ip, revenue
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import relational as R
from ..operators.sizing import spread
from ..sources.tables import load
from .derived import PROPS_K_SQL, event_graph_edges, EDGES_SQL, props_k
from .iterate import cut
from .registry import register

DEC_REV = "CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))"


def exact_avg(c):
    return exact_sum(c) / F.count(c)


# ------------------------------------------------------------------ P ------
def p01_p03_revenue_map(spark, sf):
    li = load(spark, sf, "lineitem")
    return R.map_columns(li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                                   "l_discount", "l_returnflag", "l_linestatus"),
                         revenue=revenue().cast("double"),
                         status=F.concat("l_returnflag", F.lit("|"), "l_linestatus")) \
        .select("l_orderkey", "l_linenumber", "revenue", "status")


register("p01_p03_revenue_map", p01_p03_revenue_map, f"""
SELECT l_orderkey, l_linenumber, CAST({DEC_REV} AS DOUBLE) AS revenue,
       l_returnflag || '|' || l_linestatus AS status FROM lineitem""")


def p02_positional_projection(spark, sf):
    return R.project_positions(load(spark, sf, "orders"), 0, 1)


register("p02_positional_projection", p02_positional_projection,
         "SELECT o_orderkey, o_custkey FROM orders")


def p04_rename_fields(spark, sf):
    e = load(spark, sf, "events", "event_id", "user_id", "event_type")
    return R.rename(e, "id", "uid", "behavior")


register("p04_rename_fields", p04_rename_fields,
         "SELECT event_id AS id, user_id AS uid, event_type AS behavior FROM events")


def p09_p14_threshold_filter(spark, sf):
    return R.filter_greater(load(spark, sf, "part", "p_partkey", "p_size"), "p_size", 40)


register("p09_p14_threshold_filter", p09_p14_threshold_filter,
         "SELECT p_partkey, p_size FROM part WHERE p_size > 40")


def p10_equality_filter(spark, sf):
    c = load(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    return R.filter_equals(c, "c_mktsegment", "AUTOMOBILE").select("c_custkey", "c_name")


register("p10_equality_filter", p10_equality_filter,
         "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'AUTOMOBILE'")


def p11_date_filters(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return R.filter_date_before(R.filter_date_after(o, "o_orderdate", "1996-06-30"),
                                "o_orderdate", "1997-01-01")


register("p11_date_filters", p11_date_filters, """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1996-06-30' AND CAST(o_orderdate AS DATE) < DATE '1997-01-01'""")


def p12_year_filter(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return R.filter_year(o, "o_orderdate", "==", 1997)


register("p12_year_filter", p12_year_filter,
         "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INTEGER) = 1997")


def p15_complete_records(spark, sf):
    d = load(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    return Q.drop_missing(d, ["role", "text"]).select("conv_id", "turn")


def p15_missing_counts(spark, sf):
    d = load(spark, sf, "conversations", "role", "text")
    return Q.missing_counts(d, ["role", "text"])


_BLANK = "regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') = ''"
register("p15_complete_records", p15_complete_records, f"""
SELECT conv_id, turn FROM conversations
WHERE role IS NOT NULL AND NOT ({_BLANK.format(c='role')})
  AND text IS NOT NULL AND NOT ({_BLANK.format(c='text')})""")
register("p15_missing_counts", p15_missing_counts, f"""
SELECT COUNT(*) FILTER (WHERE role IS NULL OR {_BLANK.format(c='role')}) AS missing_role,
       COUNT(*) FILTER (WHERE text IS NULL OR {_BLANK.format(c='text')}) AS missing_text
FROM conversations""")


def p18_key_by_position(spark, sf):
    li = load(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return R.key_by(li, 2).agg(exact_sum("l_quantity").alias("sum_qty"))


register("p18_key_by_position", p18_key_by_position,
         "SELECT l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS sum_qty FROM lineitem GROUP BY l_suppkey")


def p19_constant_key(spark, sf):
    e = load(spark, sf, "events", "value")
    return R.constant_key(e).agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"),
                                 F.max("value").alias("max_value"))


register("p19_constant_key", p19_constant_key,
         "SELECT COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total, MAX(value) AS max_value FROM events")


def p20_null_key_quarantine(spark, sf):
    """P20: documents keyed by their label's quality; unlabeled documents have
    a null key and go to the quarantine output instead of a null group."""
    d = load(spark, sf, "documents", "doc_id").join(load(spark, sf, "labels", "doc_id", "quality"),
                                                   "doc_id", "left")
    main, quarantine = Q.split_null_keys(d, "quality")
    counts = main.groupBy(F.col("quality").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("cnt"))
    q = quarantine.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit("quarantine").alias("key"), "cnt")
    return counts.unionByName(q)


register("p20_null_key_quarantine", p20_null_key_quarantine, """
SELECT COALESCE(CAST(l.quality AS VARCHAR), 'quarantine') AS key, COUNT(*) AS cnt
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")


def p21_undirected_edges(spark, sf):
    return R.undirect_edges(event_graph_edges(spark, sf)).distinct()


register("p21_undirected_edges", p21_undirected_edges,
         f"SELECT src, dst FROM {EDGES_SQL} UNION SELECT dst AS src, src AS dst FROM {EDGES_SQL}")


def p22_canonical_edges(spark, sf):
    e = event_graph_edges(spark, sf).toDF("v1", "v2")
    return R.canonical_edges(e).distinct()


register("p22_canonical_edges", p22_canonical_edges,
         f"SELECT DISTINCT least(src, dst) AS v1, greatest(src, dst) AS v2 FROM {EDGES_SQL}")


def p23_duplicate_and_tag(spark, sf):
    c = load(spark, sf, "customer", "c_custkey")
    return R.append_constant(R.duplicate_value(c, "c_custkey", "id", "label"), "one", 1)


register("p23_duplicate_and_tag", p23_duplicate_and_tag,
         "SELECT c_custkey AS id, c_custkey AS label, 1 AS one FROM customer")


def p24_address_format(spark, sf):
    e = load(spark, sf, "events", "event_id")
    addr = (F.col("event_id") * 2654435761) % 4294967296
    return e.select("event_id", int_to_ip(addr).alias("address"))


register("p24_address_format", p24_address_format, """
SELECT event_id, concat_ws('.', (a >> 24) & 255, (a >> 16) & 255, (a >> 8) & 255, a & 255) AS address
FROM (SELECT event_id, (event_id * 2654435761) % 4294967296 AS a FROM events)""")


# ------------------------------------------------------------------ A ------
def a01_grouped_sum(spark, sf):
    li = load(spark, sf, "lineitem", "l_suppkey", "l_quantity")
    return li.groupBy("l_suppkey").agg(exact_sum("l_quantity").alias("sum_qty"))


register("a01_grouped_sum", a01_grouped_sum,
         "SELECT l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS sum_qty FROM lineitem GROUP BY l_suppkey")


def a02_grouped_min(spark, sf):
    return R.grouped_min(load(spark, sf, "lineitem", "l_partkey", "l_extendedprice"),
                         "l_partkey", "l_extendedprice", "min_price")


register("a02_grouped_min", a02_grouped_min,
         "SELECT l_partkey, MIN(l_extendedprice) AS min_price FROM lineitem GROUP BY l_partkey")


def a05_max_by_row(spark, sf):
    e = load(spark, sf, "events", "user_id", "event_id", "ts", "event_type", "value")
    return R.max_by_row(e, "user_id", "value", order="event_id")


register("a05_max_by_row", a05_max_by_row, """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""")


def a07_global_reduce(spark, sf):
    li = load(spark, sf, "lineitem", "l_quantity")
    return li.agg(exact_sum("l_quantity").alias("total_qty"), F.count(F.lit(1)).alias("n"))


register("a07_global_reduce", a07_global_reduce,
         "SELECT CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS total_qty, COUNT(*) AS n FROM lineitem")


def a08_group_to_list(spark, sf):
    """Group-reduce to a list sorted inside the group."""
    o = load(spark, sf, "orders", "o_custkey", "o_orderkey")
    return R.group_to_list(o, "o_custkey", "o_orderkey", "orders")


register("a08_group_to_list", a08_group_to_list,
         "SELECT o_custkey, list_sort(list(o_orderkey)) AS orders FROM orders GROUP BY o_custkey")


def a10_distinct(spark, sf):
    return R.distinct_rows(load(spark, sf, "events", "user_id", "event_type"))


register("a10_distinct", a10_distinct, "SELECT DISTINCT user_id, event_type FROM events")


def a11_average(spark, sf):
    e = load(spark, sf, "events", "event_type", "value")
    return e.groupBy("event_type").agg(exact_avg("value").alias("avg_value"))


register("a11_average", a11_average, """
SELECT event_type, CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / COUNT(value) AS avg_value
FROM events GROUP BY event_type""")


def a12_weighted_average(spark, sf):
    e = load(spark, sf, "events", "user_id", "value", "props") \
        .select("user_id", F.floor("value").cast("long").alias("v"), props_k().alias("w"))
    return R.weighted_avg(e, "user_id", "v", "w", "wavg")


register("a12_weighted_average", a12_weighted_average, f"""
SELECT user_id, CAST(SUM(v * w) // NULLIF(SUM(w), 0) AS DOUBLE) AS wavg FROM (
  SELECT user_id, CAST(floor(value) AS BIGINT) AS v, {PROPS_K_SQL} AS w FROM events) GROUP BY user_id""")


def a14_sql_sum(spark, sf):
    load(spark, sf, "lineitem", "l_returnflag", "l_linestatus", "l_quantity") \
        .createOrReplaceTempView("lineitem_a14")
    return spark.sql("""SELECT l_returnflag, l_linestatus,
                               CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS sum_qty
                        FROM lineitem_a14 GROUP BY l_returnflag, l_linestatus""")


register("a14_sql_sum", a14_sql_sum, """
SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS sum_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")


def a15_count_per_key(spark, sf):
    return R.grouped_count(load(spark, sf, "events", "user_id", "event_type"),
                           "user_id", "event_type", "behavior_cnt")


register("a15_count_per_key", a15_count_per_key,
         "SELECT user_id, COUNT(event_type) AS behavior_cnt FROM events GROUP BY user_id")


def a16_expression_key(spark, sf):
    """GROUP BY an expression (hour text of ts) and a column."""
    e = load(spark, sf, "events", "ts", "event_type")
    hour = F.substring(F.col("ts").cast("string"), 12, 2)
    return e.groupBy(hour.alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("cnt"))


register("a16_expression_key", a16_expression_key, """
SELECT substr(CAST(ts AS VARCHAR), 12, 2) AS hour, event_type, COUNT(*) AS cnt FROM events GROUP BY 1, 2""")


# ------------------------------------------------------------------ X ------
def _views(spark, sf):
    return load(spark, sf, "events", "event_id", "user_id", "event_type", "value")


def x01_union_all(spark, sf):
    e = _views(spark, sf)
    return R.union_all(e.filter(F.col("event_type") == "view"), e.filter(F.col("value") > 400))


register("x01_union_all", x01_union_all, """
SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, user_id, event_type, value FROM events WHERE value > 400""")


def x02_union_distinct(spark, sf):
    e = _views(spark, sf).select("user_id", "event_type")
    return R.union_distinct(e.filter(F.col("event_type") == "view"),
                            e.filter(F.col("event_type") == "click"))


register("x02_union_distinct", x02_union_distinct, """
SELECT user_id, event_type FROM events WHERE event_type = 'view'
UNION SELECT user_id, event_type FROM events WHERE event_type = 'click'""")


def x03_difference(spark, sf):
    e = _views(spark, sf)
    buyers = e.filter(F.col("event_type") == "purchase").select("user_id").distinct()
    errs = e.filter(F.col("value") > 250).select("user_id").distinct()
    return R.difference(buyers, errs)


register("x03_difference", x03_difference, """
SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'
EXCEPT SELECT DISTINCT user_id FROM events WHERE value > 250""")


# ------------------------------------------------------------------ J ------
def j01_equi_join(spark, sf):
    """Inner equi-join (DataFrame form of the Table-API join)."""
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey")
    c = load(spark, sf, "customer", "c_custkey", "c_name")
    return J.equi_join(o, c, "o_custkey", "c_custkey").select("o_orderkey", "c_name")


register("j01_equi_join", j01_equi_join,
         "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")


def j02_join_pair(spark, sf):
    s = load(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    n = load(spark, sf, "nation", "n_nationkey", "n_name")
    return J.join_pair(s, n, "s_nationkey", "n_nationkey", "supplier", "nation") \
        .select(F.col("supplier.s_suppkey").alias("s_suppkey"), F.col("nation.n_name").alias("n_name"))


register("j02_join_pair", j02_join_pair,
         "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")


def j03_join_project(spark, sf):
    c = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = load(spark, sf, "nation", "n_nationkey", "n_name")
    return J.join_project(c, n, "c_nationkey", "n_nationkey",
                          first=("c_custkey", "c_name"), second=("n_name",))


register("j03_join_project", j03_join_project,
         "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")


def j04_join_with_tiny(spark, sf):
    s = load(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    n = load(spark, sf, "nation", "n_nationkey", "n_regionkey").withColumnRenamed("n_nationkey", "s_nationkey")
    r = load(spark, sf, "region", "r_regionkey", "r_name").withColumnRenamed("r_regionkey", "n_regionkey")
    return J.join_with_tiny(J.join_with_tiny(s, n, "s_nationkey"), r, "n_regionkey") \
        .select("s_suppkey", "r_name")


register("j04_join_with_tiny", j04_join_with_tiny, """
SELECT s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")


def j05_join_with_huge(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_orderpriority") \
        .filter(F.col("o_orderpriority") == "1-URGENT")
    li = load(spark, sf, "lineitem", "l_orderkey", "l_quantity")
    return J.join_with_huge(o.withColumnRenamed("o_orderkey", "l_orderkey"), li, "l_orderkey") \
        .groupBy("l_orderkey").agg(exact_sum("l_quantity").alias("qty"))


register("j05_join_with_huge", j05_join_with_huge, """
SELECT l_orderkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS qty
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY l_orderkey""")


def j06_composite_key(spark, sf):
    li = spread(load(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity"), "l_partkey", "l_suppkey")
    tot = li.groupBy("l_partkey", "l_suppkey").agg(exact_sum("l_quantity").alias("ps_qty")) \
            .withColumnsRenamed({"l_partkey": "ps_partkey", "l_suppkey": "ps_suppkey"})
    return J.equi_join(li, tot, ["l_partkey", "l_suppkey"], ["ps_partkey", "ps_suppkey"]) \
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "ps_qty")


register("j06_composite_key", j06_composite_key, """
SELECT l_orderkey, l.l_partkey, l.l_suppkey, l_quantity, t.ps_qty FROM lineitem l JOIN (
  SELECT l_partkey, l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS ps_qty
  FROM lineitem GROUP BY 1, 2) t ON l.l_partkey = t.l_partkey AND l.l_suppkey = t.l_suppkey""")


def j07_conditional_join(spark, sf):
    c = load(spark, sf, "customer", "c_custkey", "c_acctbal")
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return J.join_filter(c, o, c.c_custkey == o.o_custkey,
                         F.col("o_totalprice") < F.col("c_acctbal") * 20) \
        .select("o_orderkey", "c_custkey")


register("j07_conditional_join", j07_conditional_join, """
SELECT o_orderkey, c_custkey FROM customer JOIN orders ON c_custkey = o_custkey
WHERE o_totalprice < c_acctbal * 20""")


def j08_join_fanout(spark, sf):
    """Join each vector with its label's group size, then fan out over
    the vector's array (one row per component)."""
    emb = load(spark, sf, "embeddings", "vec_id", "embedding", "label")
    sizes = emb.groupBy("label").agg(F.count(F.lit(1)).alias("label_size"))
    return J.join_fanout(sizes, emb, "label", "embedding", "component", pos_col="dim") \
        .select("vec_id", "label", "label_size", "dim", "component")


register("j08_join_fanout", j08_join_fanout, """
WITH s AS (SELECT label, COUNT(*) AS label_size FROM embeddings GROUP BY label)
SELECT vec_id, e.label, s.label_size, CAST(g.i - 1 AS INTEGER) AS dim, e.embedding[g.i] AS component
FROM embeddings e JOIN s ON e.label = s.label, LATERAL (SELECT generate_subscripts(e.embedding, 1) AS i) g""")


def j09_anti_join(spark, sf):
    c = load(spark, sf, "customer", "c_custkey", "c_name")
    o = load(spark, sf, "orders", "o_custkey", "o_orderpriority") \
        .filter(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return J.anti_join(c, o, "c_custkey")


register("j09_anti_join", j09_anti_join, """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")


def j10_cogroup_difference(spark, sf):
    e = load(spark, sf, "events", "user_id", "event_type", "value")
    new = e.filter(F.col("event_type") == "click")
    old = e.filter((F.col("event_type") == "view") & (F.col("value") > 100))
    return J.cogroup_difference(new.select("user_id"), old.select("user_id"))


register("j10_cogroup_difference", j10_cogroup_difference, """
SELECT DISTINCT user_id FROM events WHERE event_type = 'click'
EXCEPT SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND value > 100""")


def j13_sql_regular_join(spark, sf):
    load(spark, sf, "lineitem", "l_orderkey", "l_partkey").createOrReplaceTempView("li_j13")
    load(spark, sf, "part", "p_partkey", "p_size", "p_brand").createOrReplaceTempView("part_j13")
    return spark.sql("""SELECT l_orderkey, p_brand FROM li_j13, part_j13
                        WHERE l_partkey = p_partkey AND p_size > 45""")


register("j13_sql_regular_join", j13_sql_regular_join,
         "SELECT l_orderkey, p_brand FROM lineitem, part WHERE l_partkey = p_partkey AND p_size > 45")


def j21_dimension_lookup(spark, sf):
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    dim = load(spark, sf, "part", "p_partkey", "p_brand").withColumnRenamed("p_partkey", "l_partkey")
    return J.lookup_join(li, dim, "l_partkey").select("l_orderkey", "l_linenumber", "p_brand")


register("j21_dimension_lookup", j21_dimension_lookup,
         "SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey")


def j22_lateral_split(spark, sf):
    p = load(spark, sf, "pages", "page_id", "url")
    return J.lateral_split(p, "url", "#", "s").select("page_id", "s")


def j23_left_lateral_split(spark, sf):
    p = load(spark, sf, "pages", "page_id", "url")
    return J.lateral_split(p, "url", "#", "s", outer=True).select("page_id", "s")


_SHARP = """CASE WHEN regexp_replace(url, '#+$', '') = '' THEN []::VARCHAR[]
                ELSE string_split(regexp_replace(url, '#+$', ''), '#') END"""
register("j22_lateral_split", j22_lateral_split, f"""
SELECT page_id, unnest({_SHARP}) AS s FROM pages WHERE contains(url, '#')""")
register("j23_left_lateral_split", j23_left_lateral_split, f"""
SELECT page_id, s FROM pages LEFT JOIN LATERAL (
  SELECT unnest(CASE WHEN contains(url, '#') THEN {_SHARP} ELSE []::VARCHAR[] END) AS s) t ON TRUE""")


def j24_connect_map(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_totalprice")
    li = load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice")
    return J.connect_map(
        o, li,
        lambda d: d.select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind"),
                           F.col("o_totalprice").alias("amount")),
        lambda d: d.select(F.col("l_orderkey").alias("key"), F.lit("item").alias("kind"),
                           F.col("l_extendedprice").alias("amount")))


register("j24_connect_map", j24_connect_map, """
SELECT o_orderkey AS key, 'order' AS kind, o_totalprice AS amount FROM orders
UNION ALL SELECT l_orderkey AS key, 'item' AS kind, l_extendedprice AS amount FROM lineitem""")


def j26_path_extend(spark, sf):
    e = cut(event_graph_edges(spark, sf))   # derived once, read several times
    return J.path_extend(e, e, distinct=True)


register("j26_path_extend", j26_path_extend, f"""
SELECT DISTINCT p.src, e.dst FROM {EDGES_SQL} p JOIN {EDGES_SQL} e ON p.dst = e.src""")
