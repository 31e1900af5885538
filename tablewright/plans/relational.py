"""Joins, aggregates, windows, sorts and set operations."""

from pyspark.sql import functions as F

from tablewright.operators import aggs as A
from tablewright.operators import joins as J
from tablewright.operators import series as S
from tablewright.operators import windows as W
from tablewright.plans.bindings import (
    DAILY, DIRTY_ORDERS, DIRTY_PARTS, ITEM_SCHEMA, MONTHLY, QUARTER_HOURS, SPLIT_SQL, split_bucket,
)
from tablewright.plans.registry import query


def rounded(df, places=4, *skip):
    """Double columns rounded, the rest as they are."""
    return df.select(
        *[F.round(c, places).alias(c) if k == "double" and c not in skip else F.col(c) for c, k in df.dtypes]
    )


# -- joins -----------------------------------------------------------------


@query(
    "join_inner",
    "SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey",
)
def join_inner(t):
    return J.join_inner(t.customer, t.orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice"
    )


@query(
    "join_left",
    """
    SELECT o_orderkey, coalesce(n, 0) AS n_lines, coalesce(q, 0) AS quantity FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1)
      ON o_orderkey = l_orderkey
    """,
)
def join_left(t):
    stats = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")
    )
    joined = J.join_left(t.orders, stats, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("q", F.lit(0.0)).alias("quantity")
    )


@query(
    "join_right",
    """
    SELECT c_custkey, coalesce(spent, 0) AS spent, coalesce(open_orders, 0) AS open_orders FROM
      (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1)
      RIGHT JOIN customer ON k = c_custkey
      LEFT JOIN (SELECT o_custkey AS k2, count(*) AS open_orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
        ON k2 = c_custkey
    """,
)
def join_right(t):
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    opened = (
        t.orders.filter(F.col("o_orderstatus") == "O")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("open_orders"))
    )
    right = J.join_right(opened, J.join_right(spent, t.customer.select("c_custkey"), "c_custkey"), "c_custkey")
    return right.select(
        "c_custkey",
        F.coalesce("spent", F.lit(0.0)).alias("spent"),
        F.coalesce("open_orders", F.lit(0)).alias("open_orders"),
    )


@query(
    "join_outer",
    """
    SELECT coalesce(n_nationkey, k) AS nation_key, coalesce(n_name, '?') AS name, coalesce(n, 0) AS customers
    FROM nation FULL JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1)
      ON n_nationkey = k
    """,
)
def join_outer(t):
    counts = (
        t.customer.filter(F.col("c_acctbal") > 0)
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return J.join_outer(t.nation, counts, "n_nationkey").select(
        F.col("n_nationkey").alias("nation_key"),
        F.coalesce("n_name", F.lit("?")).alias("name"),
        F.coalesce("n", F.lit(0)).alias("customers"),
    )


@query(
    "join_suffix",
    f"""
    WITH o AS (SELECT *, {SPLIT_SQL('o_orderkey')} < 80 AS is_train FROM orders)
    SELECT a.o_orderpriority, a.n AS n_train, b.n AS n_test, a.mean_price AS mean_price_train,
      b.mean_price AS mean_price_test
    FROM (SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM o WHERE is_train GROUP BY 1) a
    JOIN (SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM o WHERE NOT is_train GROUP BY 1) b
      USING (o_orderpriority)
    """,
)
def join_suffix(t):
    def profile(df):
        return df.groupBy("o_orderpriority").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
        )

    train = split_bucket(F.col("o_orderkey")) < 80
    return J.join_suffix(
        profile(t.orders.filter(train)), profile(t.orders.filter(~train)), ["o_orderpriority"], ("_train", "_test")
    )


@query(
    "join_multikey",
    """
    SELECT l_partkey, l_suppkey, n, o_returned FROM
      (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
      JOIN (SELECT l_partkey, l_suppkey, count(*) AS o_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
      USING (l_partkey, l_suppkey)
    """,
)
def join_multikey(t):
    keys = ["l_partkey", "l_suppkey"]
    total = A.group_count(t.lineitem, keys)
    returned = A.group_count(t.lineitem.filter(F.col("l_returnflag") == "R"), keys, "o_returned")
    return J.join_inner(total, returned, keys)


@query(
    "calendar_join",
    f"""
    WITH {QUARTER_HOURS}
    SELECT series_id, t, round(value, 4) AS value, CASE WHEN value IS NULL THEN 1 ELSE 0 END AS is_gap
    FROM (SELECT series_id, unnest(range(min(t), max(t) + 1)) AS t FROM quarter_hours GROUP BY series_id)
    LEFT JOIN quarter_hours USING (series_id, t)
    """,
)
def calendar_join(t):
    full = S.fill_steps(t.quarter_hours, ["series_id"], "t")
    return full.select(
        "series_id", "t", F.round("value", 4).alias("value"), F.col("value").isNull().cast("int").alias("is_gap")
    )


@query(
    "nearest_assign",
    """
    WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label AS ref, i, avg(v) AS m FROM x GROUP BY ALL),
    d AS (SELECT vec_id, label, ref, sum((v - m) * (v - m)) AS dist FROM x JOIN c USING (i) GROUP BY ALL)
    SELECT vec_id, label, arg_min(ref, dist) AS nearest, round(min(dist), 4) AS nearest_dist FROM d GROUP BY ALL
    """,
)
def nearest_assign(t):
    from tablewright.operators.vectors import class_means

    centres = class_means(t.embeddings, "label", "embedding")
    near = J.nearest_assign(t.embeddings, "embedding", centres)
    return near.select("vec_id", "label", "nearest", F.round("nearest_dist", 4).alias("nearest_dist"))


@query(
    "mapping_join",
    f"""
    WITH {MONTHLY}, idx AS (SELECT t % 12 AS m, avg(value) AS month_mean FROM monthly GROUP BY 1)
    SELECT series_id, t, round(value, 2) AS value, round(month_mean, 2) AS month_mean
    FROM monthly JOIN idx ON t % 12 = m
    """,
)
def mapping_join(t):
    rows = t.monthly.withColumn("m", F.col("t") % 12)
    index = rows.groupBy("m").agg(F.avg("value").alias("month_mean"))
    return J.mapping_join(rows, index, ["m"]).select(
        "series_id", "t", F.round("value", 2).alias("value"), F.round("month_mean", 2).alias("month_mean")
    )


# -- aggregates ------------------------------------------------------------


@query("group_sum", "SELECT o_custkey, round(sum(o_totalprice), 2) AS total_spent FROM orders GROUP BY 1")
def group_sum(t):
    return rounded(A.group_sum(t.orders, ["o_custkey"], "o_totalprice", "total_spent"), 2)


@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def group_count(t):
    return A.group_count(t.events, ["event_type"]).orderBy(F.desc("n"), "event_type")


@query("group_mean", "SELECT p_type, round(avg(p_retailprice), 4) AS mean_price FROM part GROUP BY 1")
def group_mean(t):
    return rounded(A.group_mean(t.part, ["p_type"], "p_retailprice", "mean_price"))


@query(
    "nested_quantity",
    """
    SELECT o_custkey, l_partkey, sum(l_quantity) AS quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
    """,
)
def nested_quantity(t):
    joined = t.orders.select("o_orderkey", "o_custkey").join(
        t.order_items, F.col("o_orderkey") == F.col("l_orderkey")
    )
    return A.nested_quantity(joined, "o_custkey", "items", ITEM_SCHEMA, "l_partkey", "l_quantity")


@query(
    "collect_items",
    """
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders)
    SELECT o_custkey, pos // 10000 AS part, count(*) AS n,
      string_agg(o_orderkey || '/' || o_orderstatus, ',' ORDER BY o_orderkey) AS order_list
    FROM n GROUP BY ALL
    """,
)
def collect_items(t):
    lists = A.collect_items(t.orders, "o_custkey", "o_orderkey", ["o_orderkey", "o_orderstatus"])
    text = F.transform("items", lambda s: F.concat_ws("/", s["o_orderkey"], s["o_orderstatus"]))
    return lists.select(
        "o_custkey", "part", F.size("items").cast("long").alias("n"), F.array_join(text, ",").alias("order_list")
    )


SUMMARY_SQL = """
WITH q AS (
  SELECT o_custkey, l_partkey, sum(l_quantity) AS quantity
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY quantity DESC, l_partkey) AS rn FROM q),
top AS (SELECT o_custkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY rn) AS top_products
  FROM r WHERE rn <= 3 GROUP BY 1)
SELECT o_custkey, count(*) AS total_orders, round(sum(o_totalprice), 2) AS total_spent, any_value(top_products) AS top_products
FROM orders LEFT JOIN top USING (o_custkey) GROUP BY 1
"""


@query("customer_summary", SUMMARY_SQL)
def customer_summary(t):
    summary = A.customer_summary(t.orders, t.order_items, ITEM_SCHEMA)
    return summary.select(
        "o_custkey",
        "total_orders",
        F.round("total_spent", 2).alias("total_spent"),
        F.array_join("top", ",").alias("top_products"),
    )


@query(
    "count_distinct",
    """
    SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS n_distinct FROM orders
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
    UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
    UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice) FROM orders
    """,
)
def count_distinct(t):
    return A.count_distinct(t.orders, ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])


@query(
    "distinct_values",
    """
    SELECT DISTINCT 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem
    UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem
    """,
)
def distinct_values(t):
    return A.distinct_values(t.lineitem, ["l_returnflag", "l_linestatus"])


def _describe_sql(table, cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, "
        f"round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, "
        f"round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75, round(max({c})::DOUBLE, 4) AS max FROM {table}"
        for c in cols
    )


@query(
    "describe_numeric",
    _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
)
def describe_numeric(t):
    return rounded(
        A.describe_numeric(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    )


_DIRTY_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(
    "null_counts",
    f"WITH {DIRTY_ORDERS} "
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM dirty_orders" for c in _DIRTY_COLS
    ),
)
def null_counts(t):
    return A.null_counts(t.dirty_orders, _DIRTY_COLS)


def _null_profile_sql(where, suffix):
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null_{suffix}, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS pct_null_{suffix}, "
        f"CAST((count(*) - count({c})) * 100.0 / count(*) > 10 AS INTEGER) AS mostly_null_{suffix} FROM s WHERE {where}"
        for c in ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    )


@query(
    "null_profile",
    f"""
    WITH {DIRTY_ORDERS}, s AS (SELECT *, {SPLIT_SQL('o_orderkey')} < 80 AS is_train FROM dirty_orders)
    SELECT * FROM ({_null_profile_sql('is_train', 'train')}) JOIN ({_null_profile_sql('NOT is_train', 'test')})
      USING (column_name)
    """,
)
def null_profile(t):
    cols = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    train = split_bucket(F.col("o_orderkey")) < 80
    d = t.dirty_orders
    return rounded(
        J.join_suffix(
            A.null_profile(d.filter(train), cols, 10),
            A.null_profile(d.filter(~train), cols, 10),
            ["column_name"],
            ("_train", "_test"),
        )
    )


@query(
    "zero_profile",
    f"""
    WITH {DIRTY_PARTS}
    SELECT 'p_size' AS column_name, count(*) FILTER (p_size = 0) AS n_zero,
      round(count(*) FILTER (p_size = 0) * 100.0::DOUBLE / count(*), 4) AS pct_zero FROM dirty_parts
    UNION ALL SELECT 'p_partkey', count(*) FILTER (p_partkey = 0),
      round(count(*) FILTER (p_partkey = 0) * 100.0::DOUBLE / count(*), 4) FROM dirty_parts
    """,
)
def zero_profile(t):
    return rounded(A.zero_profile(t.dirty_parts, ["p_size", "p_partkey"]))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs_sql(fn, out, places):
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({fn}({a}, {b}), {places}) AS {out} FROM lineitem"
        for a in _NUM
        for b in _NUM
    )


@query("covariance_matrix", _pairs_sql("covar_samp", "covariance", 3))
def covariance_matrix(t):
    return rounded(A.covariance_matrix(t.lineitem, _NUM), 3)


@query("correlation_matrix", _pairs_sql("corr", "correlation", 6))
def correlation_matrix(t):
    return rounded(A.correlation_matrix(t.lineitem, _NUM), 6)


@query(
    "histogram",
    """
    WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(CAST(floor((value - lo) / (hi - lo) * 20) AS INTEGER), 19) AS bin, count(*) AS n
      FROM events, b GROUP BY 1)
    SELECT g.bin, round(lo + (hi - lo) * g.bin / 20, 4) AS bin_from, round(lo + (hi - lo) * (g.bin + 1) / 20, 4) AS bin_to,
      coalesce(n, 0) AS n
    FROM (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin) g CROSS JOIN b LEFT JOIN c USING (bin)
    """,
)
def histogram(t):
    return rounded(A.histogram(t.events, "value", 20))


@query(
    "kernel_density",
    """
    SELECT g.point, round(avg(exp(-pow((value - g.point) / 5.0, 2) / 2)) / (5.0 * sqrt(2 * pi())), 8) AS density
    FROM events, (SELECT CAST(unnest(range(0, 101, 10)) AS DOUBLE) AS point) g GROUP BY 1
    """,
)
def kernel_density(t):
    return rounded(A.kernel_density(t.events, "value", list(range(0, 101, 10)), 5.0), 8)


@query(
    "frobenius_norm",
    "SELECT round(sqrt(sum(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax)), 4) AS norm FROM lineitem",
)
def frobenius_norm(t):
    return rounded(A.frobenius_norm(t.lineitem, ["l_quantity", "l_discount", "l_tax"]))


@query(
    "share_by_class",
    """
    SELECT l_returnflag, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM lineitem), 4) AS share_pct
    FROM lineitem GROUP BY 1
    """,
)
def share_by_class(t):
    return rounded(A.share_by_class(t.lineitem, "l_returnflag"))


@query(
    "pivot_mean",
    """
    SELECT m.month, y.year, round(avg(o_totalprice), 4) AS price
    FROM (SELECT DISTINCT CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) m CROSS JOIN (SELECT DISTINCT 'y' || year(o_orderdate) AS year FROM orders) y
      LEFT JOIN orders ON month(o_orderdate) = m.month AND 'y' || year(o_orderdate) = y.year GROUP BY ALL
    """,
)
def pivot_mean(t):
    base = t.orders.select(
        F.month("o_orderdate").alias("month"),
        F.concat(F.lit("y"), F.year("o_orderdate")).alias("year"),
        "o_totalprice",
    )
    years = sorted(r[0] for r in base.select("year").distinct().collect())  # as many as the result has columns
    wide = A.pivot_mean(base, "month", "year", "o_totalprice", years)
    return rounded(wide.unpivot("month", years, "year", "price"))  # its columns depend on the data, so they are compared as rows


@query(
    "rate_by_group",
    """
    SELECT l_linestatus, round(avg(CAST(l_returnflag = 'R' AS INTEGER)), 6) AS rate, count(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def rate_by_group(t):
    return rounded(A.rate_by_group(t.lineitem, "l_linestatus", F.col("l_returnflag") == "R"), 6)


@query(
    "weighted_centroid",
    """
    SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS cx,
      round(sum(l_tax * l_quantity) / sum(l_quantity), 6) AS cy, sum(l_quantity) AS weight
    FROM lineitem GROUP BY 1
    """,
)
def weighted_centroid(t):
    return rounded(
        A.weighted_centroid(t.lineitem, ["l_returnflag"], "l_discount", "l_tax", "l_quantity"), 6, "weight"
    )


_VAR = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "column_variance_rank",
    "WITH v AS ("
    + "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, var_samp({c}) AS variance FROM lineitem" for c in _VAR)
    + """), r AS (SELECT *, CAST(row_number() OVER (ORDER BY variance DESC, column_name) AS INTEGER) AS position FROM v)
    SELECT column_name, round(variance, 3) AS variance, position, CAST(position > 1 AS INTEGER) AS kept FROM r""",
)
def column_variance_rank(t):
    return rounded(A.column_variance_rank(t.lineitem, _VAR, 0.2), 3)


# -- windows ---------------------------------------------------------------

_QTY = """q AS (SELECT o_custkey, l_partkey, sum(l_quantity) AS quantity
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""


def _quantities(t):
    joined = t.orders.select("o_orderkey", "o_custkey").join(
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    return joined.groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"))


@query(
    "rank_topk",
    f"""
    WITH {_QTY} SELECT * FROM (SELECT o_custkey, l_partkey, quantity,
      CAST(rank() OVER (PARTITION BY o_custkey ORDER BY quantity DESC) AS INTEGER) AS rank FROM q) WHERE rank <= 3
    """,
)
def rank_topk(t):
    return W.rank_topk(_quantities(t), ["o_custkey"], [F.desc("quantity")], 3)


@query(
    "rownum_topk",
    f"""
    WITH {_QTY} SELECT * FROM (SELECT o_custkey, l_partkey, quantity, CAST(row_number() OVER
      (PARTITION BY o_custkey ORDER BY quantity DESC, l_partkey) AS INTEGER) AS position FROM q) WHERE position <= 3
    """,
)
def rownum_topk(t):
    return W.rownum_topk(_quantities(t), ["o_custkey"], [F.desc("quantity"), F.col("l_partkey")], 3)


@query(
    "zscore_outliers",
    """
    SELECT event_id, event_type, value FROM events
    WHERE value > (SELECT avg(value) + 3 * stddev_samp(value) FROM events)
    """,
)
def zscore_outliers(t):
    return W.zscore_outliers(t.events.select("event_id", "event_type", "value"), "value", 3)


@query(
    "iqr_outliers",
    """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75 FROM events)
    SELECT event_id, value, round(q25, 4) AS q25, round(q75, 4) AS q75 FROM events, q
    WHERE value < q25 - 1.5 * (q75 - q25) OR value > q75 + 1.5 * (q75 - q25)
    """,
)
def iqr_outliers(t):
    from tablewright.session import pin_small

    rows = t.events.select("event_id", "value")
    fences = pin_small(W.iqr_fences(rows, "value"))
    return W.iqr_outliers(rows, "value", fences).select(
        "event_id", "value",
        F.round(fences.select("q25").scalar(), 4).alias("q25"),
        F.round(fences.select("q75").scalar(), 4).alias("q75"),
    )


@query(
    "lag_diff",
    f"""
    WITH {DAILY} SELECT series_id, t, round(value, 4) AS value,
      round(value - lag(value) OVER (PARTITION BY series_id ORDER BY t), 4) AS diff FROM daily
    """,
)
def lag_diff(t):
    return rounded(S.lag_diff(t.daily.drop("n"), ["series_id"], "t", "value"))


@query(
    "seasonal_diff",
    f"""
    WITH {DAILY} SELECT series_id, t, round(value, 4) AS value,
      round(value - lag(value, 7) OVER (PARTITION BY series_id ORDER BY t), 4) AS diff FROM daily
    """,
)
def seasonal_diff(t):
    return rounded(S.lag_diff(t.daily.drop("n"), ["series_id"], "t", "value", m=7))


@query(
    "log_diff",
    f"""
    WITH {DAILY} SELECT series_id, t, round(value, 4) AS value,
      round(ln(nullif(value, 0)) - lag(ln(nullif(value, 0))) OVER (PARTITION BY series_id ORDER BY t), 6) AS log_diff FROM daily
    """,
)
def log_diff(t):
    df = S.log_diff(t.daily.drop("n"), ["series_id"], "t", "value")
    return df.select("series_id", "t", F.round("value", 4).alias("value"), F.round("log_diff", 6).alias("log_diff"))


@query(
    "rolling_mean_std",
    f"""
    WITH {DAILY} SELECT series_id, t,
      CASE WHEN count(value) OVER w = 7 THEN round(avg(value) OVER w, 4) END AS rolling_mean,
      CASE WHEN count(value) OVER w = 7 THEN round(stddev_samp(value) OVER w, 4) END AS rolling_std
    FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    """,
)
def rolling_mean_std(t):
    df = S.rolling_mean_std(t.daily, ["series_id"], "t", "value", 7)
    return rounded(df.select("series_id", "t", "rolling_mean", "rolling_std"))


_GAPPY = f"""{QUARTER_HOURS}, gappy AS (
  SELECT series_id, t, value
  FROM (SELECT series_id, unnest(range(min(t), max(t) + 1)) AS t FROM quarter_hours GROUP BY series_id)
  LEFT JOIN quarter_hours USING (series_id, t))"""


@query(
    "forward_fill",
    f"""
    WITH {_GAPPY} SELECT series_id, t, round(last_value(value IGNORE NULLS) OVER
      (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS filled FROM gappy
    """,
)
def forward_fill(t):
    gappy = S.fill_steps(t.quarter_hours, ["series_id"], "t")
    return rounded(S.forward_fill(gappy, ["series_id"], "t", "value").drop("value"))


@query(
    "linear_interpolate",
    f"""
    WITH {_GAPPY}, s AS (SELECT series_id, t, value,
      last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER b AS t0, last_value(value IGNORE NULLS) OVER b AS v0,
      first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t1, first_value(value IGNORE NULLS) OVER a AS v1
      FROM gappy WINDOW b AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        a AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT series_id, t, round(coalesce(value, v0 + (v1 - v0) * (t - t0) / (t1 - t0)), 8) AS filled FROM s
    """,
)
def linear_interpolate(t):
    gappy = S.fill_steps(t.quarter_hours, ["series_id"], "t")
    return rounded(S.linear_interpolate(gappy, ["series_id"], "t", "value").drop("value"), 8)


@query(
    "cumulative_sum",
    f"""
    WITH {DAILY} SELECT series_id, t, round(sum(value) OVER (PARTITION BY series_id ORDER BY t), 4) AS running FROM daily
    """,
)
def cumulative_sum(t):
    return rounded(S.cumulative_sum(t.daily, ["series_id"], "t", "value").select("series_id", "t", "running"))


@query(
    "lag_features",
    f"""
    WITH {DAILY} SELECT * FROM (SELECT series_id, t, round(value, 4) AS value,
      round(lag(value, 1) OVER w, 4) AS lag_1, round(lag(value, 2) OVER w, 4) AS lag_2, round(lag(value, 3) OVER w, 4) AS lag_3
      FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY t)) WHERE lag_3 IS NOT NULL
    """,
)
def lag_features(t):
    return rounded(S.lag_features(t.daily.drop("n"), ["series_id"], "t", "value", 3))


@query(
    "time_split",
    f"""
    WITH {DAILY} SELECT series_id, t, round(value, 4) AS value, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY t)
      <= floor(count(*) OVER (PARTITION BY series_id) * 0.8) THEN 'train' ELSE 'test' END AS part FROM daily
    """,
)
def time_split(t):
    return rounded(S.time_split(t.daily.drop("n"), ["series_id"], "t", 0.8))


# -- sorts and sets --------------------------------------------------------


@query("sort_multi", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def sort_multi(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return W.sort_multi(rows, F.col("o_custkey"), F.desc("o_totalprice"), F.col("o_orderkey"))


@query(
    "top_n_global",
    """
    SELECT o_custkey, count(*) AS total_orders, round(sum(o_totalprice), 2) AS total_spent FROM orders
    GROUP BY 1 ORDER BY total_orders DESC, o_custkey LIMIT 50
    """,
)
def top_n_global(t):
    totals = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_spent")
    )
    return W.top_n_global(totals, [F.desc("total_orders"), F.col("o_custkey")], 50)


@query(
    "mode_value",
    f"""
    WITH {DIRTY_ORDERS} SELECT o_orderpriority, count(*) AS n FROM dirty_orders
    WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 1
    """,
)
def mode_value(t):
    return W.mode_value(t.dirty_orders, "o_orderpriority")


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(t):
    return W.distinct_rows(t.part.select("p_brand", "p_type"))


@query(
    "union_rows",
    "SELECT c_nationkey AS nation_key, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_rows(t):
    a = t.customer.select(F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation_key"))
    return W.union_rows(a, b)
