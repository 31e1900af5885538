"""Data quality, imputation, features, sampling."""

from pyspark.sql import functions as F

from tablewright.operators import features as X
from tablewright.operators import linear as L
from tablewright.operators import neighbours as N
from tablewright.operators import quality as Q
from tablewright.operators import sampling as S
from tablewright.plans.bindings import DIRTY_ORDERS, DIRTY_PARTS, SPLIT_SQL, split_bucket
from tablewright.plans.registry import query
from tablewright.plans.relational import rounded
from tablewright.session import small_table

_DUCK_TYPES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END"""


@query(
    "schema_validate",
    f"""
    WITH want(column_name, expected_type) AS (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'int'),
      ('o_totalprice', 'double'), ('o_comment', 'string')),
    have AS (SELECT column_name, {_DUCK_TYPES} AS actual_type FROM (DESCRIBE SELECT * FROM orders))
    SELECT column_name, coalesce(expected_type, '') AS expected_type, coalesce(actual_type, '') AS actual_type,
      CASE WHEN actual_type IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'extra'
        WHEN expected_type = actual_type THEN 'ok' ELSE 'type mismatch' END AS status
    FROM want FULL JOIN have USING (column_name)
    """,
)
def schema_validate(t):
    from pyspark.sql.types import _parse_datatype_string

    want = _parse_datatype_string("o_orderkey bigint, o_custkey int, o_totalprice double, o_comment string")
    return Q.schema_validate(t.orders, want)


_REPORT_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _report_sql():
    parts = [
        "SELECT '*' AS column_name, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM dirty_orders",
        "SELECT '*', 'columns', 5.0::DOUBLE",
    ]
    for c in _REPORT_COLS:
        parts.append(f"SELECT '{c}', 'missing', CAST(count(*) - count({c}) AS DOUBLE) FROM dirty_orders")
        parts.append(
            f"SELECT '{c}', 'missing_pct', round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) FROM dirty_orders"
        )
    p = "o_totalprice"
    out = f"count(*) FILTER (NOT {p} BETWEEN 1000 AND 400000)"
    parts += [
        f"SELECT '{p}', 'min', min({p}) FROM dirty_orders",
        f"SELECT '{p}', 'max', max({p}) FROM dirty_orders",
        f"SELECT '{p}', 'mean', round(avg({p}), 4) FROM dirty_orders",
        f"SELECT '{p}', 'stddev', round(stddev_samp({p}), 4) FROM dirty_orders",
        f"SELECT '{p}', 'out_of_range', {out}::DOUBLE FROM dirty_orders",
        "SELECT 'o_orderstatus', 'unexpected', count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))::DOUBLE FROM dirty_orders",
        "SELECT 'o_orderkey', 'issue', 0.0::DOUBLE",
        "SELECT 'o_custkey', 'issue', 0.0::DOUBLE",
        "SELECT 'o_orderpriority', 'issue', CAST((count(*) - count(o_orderpriority)) * 100.0 / count(*) > 50 AS INTEGER)::DOUBLE FROM dirty_orders",
        f"SELECT '{p}', 'issue', CAST({out} > 0 AS INTEGER)::DOUBLE FROM dirty_orders",
        "SELECT 'o_orderstatus', 'issue', CAST(count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) > 0 AS INTEGER)::DOUBLE FROM dirty_orders",
    ]
    return f"WITH {DIRTY_ORDERS} " + "\nUNION ALL ".join(parts)


@query("quality_report", _report_sql())
def quality_report(t):
    rules = Q.QualityRules(
        ranges={"o_totalprice": (1000, 400000)}, domains={"o_orderstatus": ["F", "O"]}, missing_pct=50
    )
    return rounded(Q.quality_report(t.dirty_orders, rules))


@query(
    "corrupt_rows",
    f"""
    WITH {DIRTY_ORDERS}, s AS (SELECT CAST(o_orderstatus IS NULL AS INTEGER) + CAST(o_totalprice IS NULL AS INTEGER)
      + CAST(o_orderpriority IS NULL AS INTEGER) AS bad FROM dirty_orders)
    SELECT count(*) AS n_rows, count(*) FILTER (bad > 0) AS n_corrupt_rows, CAST(sum(bad) AS BIGINT) AS n_corrupt_values FROM s
    """,
)
def corrupt_rows(t):
    return Q.corrupt_rows(t.dirty_orders, _REPORT_COLS)


@query(
    "drop_null_rows",
    f"""
    WITH {DIRTY_ORDERS} SELECT * FROM dirty_orders
    WHERE o_totalprice IS NOT NULL AND o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
    """,
)
def drop_null_rows(t):
    return Q.drop_null_rows(t.dirty_orders)


@query(
    "drop_sparse_rows",
    f"""
    WITH {DIRTY_ORDERS} SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM dirty_orders
    WHERE CAST(o_orderstatus IS NULL AS INTEGER) + CAST(o_totalprice IS NULL AS INTEGER)
      + CAST(o_orderpriority IS NULL AS INTEGER) < 2
    """,
)
def drop_sparse_rows(t):
    cols = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    return Q.drop_sparse_rows(t.dirty_orders, cols, 0.5).select("o_orderkey", *cols)


@query("drop_null_columns", f"WITH {DIRTY_ORDERS} SELECT o_orderkey, o_custkey FROM dirty_orders")
def drop_null_columns(t):
    return Q.drop_null_columns(t.dirty_orders, "any")


@query(
    "impute_mean_mode",
    f"""
    WITH {DIRTY_ORDERS},
    m AS (SELECT (SELECT avg(o_totalprice) FROM dirty_orders) AS price,
      (SELECT o_orderstatus FROM dirty_orders WHERE o_orderstatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS status,
      (SELECT o_orderpriority FROM dirty_orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS priority)
    SELECT o_orderkey, round(coalesce(o_totalprice, price), 4) AS o_totalprice, coalesce(o_orderstatus, status) AS o_orderstatus,
      coalesce(o_orderpriority, priority) AS o_orderpriority FROM dirty_orders, m
    """,
)
def impute_mean_mode(t):
    filled = Q.impute_mean_mode(t.dirty_orders, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"])
    return rounded(filled.drop("o_custkey"))


@query(
    "impute_constant",
    f"""
    WITH {DIRTY_ORDERS} SELECT o_orderkey, coalesce(o_totalprice, 0) AS o_totalprice,
      coalesce(o_orderpriority, 'Unknown') AS o_orderpriority FROM dirty_orders
    """,
)
def impute_constant(t):
    cols = t.dirty_orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return Q.impute_constant(cols, {"o_totalprice": 0.0, "o_orderpriority": "Unknown"})


@query(
    "impute_median",
    f"""
    WITH {DIRTY_ORDERS}, m AS (SELECT median(o_totalprice) AS med FROM dirty_orders WHERE {SPLIT_SQL('o_orderkey')} < 80)
    SELECT o_orderkey, round(coalesce(o_totalprice, med), 4) AS o_totalprice FROM dirty_orders, m
    WHERE {SPLIT_SQL('o_orderkey')} >= 80
    """,
)
def impute_median(t):
    rows = t.dirty_orders.select("o_orderkey", "o_totalprice")
    train = split_bucket(F.col("o_orderkey")) < 80
    return rounded(Q.impute_median(rows.filter(train), rows.filter(~train), ["o_totalprice"]))


@query(
    "impute_group_stat",
    f"""
    WITH {DIRTY_ORDERS}, g AS (SELECT o_custkey, o_orderstatus, median(o_totalprice) AS med FROM dirty_orders
      WHERE o_totalprice IS NOT NULL GROUP BY ALL), a AS (SELECT median(o_totalprice) AS med_all FROM dirty_orders)
    SELECT d.o_orderkey, round(coalesce(d.o_totalprice, g.med, a.med_all), 4) AS o_totalprice
    FROM dirty_orders d LEFT JOIN g ON d.o_custkey = g.o_custkey AND d.o_orderstatus IS NOT DISTINCT FROM g.o_orderstatus, a
    """,
)
def impute_group_stat(t):
    filled = Q.impute_group_stat(t.dirty_orders, "o_totalprice", ["o_custkey", "o_orderstatus"], "median")
    return rounded(filled.select("o_orderkey", "o_totalprice"))


@query(
    "impute_zero_as_missing",
    f"""
    WITH {DIRTY_PARTS}, m AS (SELECT median(p_size) AS med FROM dirty_parts WHERE p_size <> 0 AND {SPLIT_SQL('p_partkey')} < 80)
    SELECT p_partkey, CASE WHEN p_size = 0 THEN med ELSE p_size END::DOUBLE AS p_size FROM dirty_parts, m
    WHERE {SPLIT_SQL('p_partkey')} >= 80
    """,
)
def impute_zero_as_missing(t):
    rows = t.dirty_parts.select("p_partkey", "p_size")
    train = split_bucket(F.col("p_partkey")) < 80
    return Q.impute_zero_as_missing(rows.filter(train), rows.filter(~train), ["p_size"])


def _order_features(t):
    stats = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount")
    )
    rows = t.dirty_orders.join(stats, "o_orderkey", "left")
    return rows.select(
        "o_orderkey",
        "o_totalprice",
        (F.coalesce("quantity", F.lit(0.0)) / 50).alias("f1"),
        (F.coalesce("discount", F.lit(0.0)) * 10).alias("f2"),
        (F.col("o_custkey") / 1000).alias("f3"),
    )


@query(
    "impute_knn",
    f"""
    WITH {DIRTY_ORDERS}, st AS (SELECT l_orderkey, sum(l_quantity) AS q, avg(l_discount) AS d FROM lineitem GROUP BY 1),
    r AS (SELECT o_orderkey, o_totalprice, coalesce(q, 0) / 50 AS f1, coalesce(d, 0) * 10 AS f2, o_custkey / 1000 AS f3
      FROM dirty_orders LEFT JOIN st ON l_orderkey = o_orderkey),
    n AS (SELECT a.o_orderkey, arg_min(b.o_totalprice, {{'d': round(sqrt((a.f1 - b.f1) * (a.f1 - b.f1) + (a.f2 - b.f2) * (a.f2 - b.f2)
        + (a.f3 - b.f3) * (a.f3 - b.f3)), 12), 'i': b.o_orderkey}}, 5) AS near
      FROM r a, r b WHERE a.o_totalprice IS NULL AND b.o_totalprice IS NOT NULL GROUP BY 1)
    SELECT o_orderkey, round(coalesce(o_totalprice, list_avg(near)), 4) AS o_totalprice FROM r LEFT JOIN n USING (o_orderkey)
    """,
)
def impute_knn(t):
    filled = Q.impute_knn(_order_features(t), "o_orderkey", "o_totalprice", ["f1", "f2", "f3"], 5)
    return rounded(filled.select("o_orderkey", "o_totalprice"))


def _chained_sql(rounds):
    """Chained regressions of the two incomplete columns on the three others, by Cramer's rule."""
    cols = ["o_totalprice", "f1", "f2", "f3"]
    head = f"""
    WITH {DIRTY_ORDERS}, st AS (SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS q, avg(l_discount) AS d FROM lineitem GROUP BY 1),
    b AS (SELECT o_orderkey, o_totalprice, coalesce(q, 0) / 50 AS f1, CASE WHEN o_orderkey % 5 <> 0 THEN coalesce(d, 0) * 10 END AS f2,
      o_custkey / 1000 AS f3 FROM dirty_orders LEFT JOIN st USING (o_orderkey)),
    r0 AS MATERIALIZED (SELECT o_orderkey, o_totalprice IS NULL AS m0, f2 IS NULL AS m2, coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM b)) AS o_totalprice,
      f1, coalesce(f2, (SELECT avg(f2) FROM b)) AS f2, f3 FROM b)"""
    steps, at = [], 0
    for _ in range(rounds):
        for target, missing in (("o_totalprice", "m0"), ("f2", "m2")):
            x, y, z = (c for c in cols if c != target)
            cov = lambda a, b: f"covar_pop({a}, {b})"
            steps.append(
                f"c{at} AS (SELECT {cov(x, x)} AS a, {cov(x, y)} AS b, {cov(x, z)} AS c, {cov(y, y)} AS d, {cov(y, z)} AS e, {cov(z, z)} AS f, "
                f"{cov(x, target)} AS u, {cov(y, target)} AS v, {cov(z, target)} AS w, avg({x}) AS mx, avg({y}) AS my, avg({z}) AS mz, avg({target}) AS mt "
                f"FROM r{at} WHERE NOT {missing}), "
                f"k{at} AS MATERIALIZED (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM c{at}), "
                f"s{at} AS MATERIALIZED (SELECT mx, my, mz, mt, (u * (d * f - e * e) - b * (v * f - e * w) + c * (v * e - d * w)) / det AS b1, "
                f"(a * (v * f - e * w) - u * (b * f - c * e) + c * (b * w - c * v)) / det AS b2, "
                f"(a * (d * w - v * e) - b * (b * w - v * c) + u * (b * e - c * d)) / det AS b3 FROM k{at}), "
                f"r{at + 1} AS MATERIALIZED (SELECT o_orderkey, m0, m2, "
                + ", ".join(
                    f"CASE WHEN {missing} THEN mt + b1 * ({x} - mx) + b2 * ({y} - my) + b3 * ({z} - mz) ELSE {target} END AS {target}" if c == target else c for c in cols
                )
                + f" FROM r{at}, s{at})"
            )
            at += 1
    return f"{head}, {', '.join(steps)} SELECT o_orderkey, " + ", ".join(f"round({c}, 4) AS {c}" for c in cols) + f" FROM r{at}"


@query("impute_iterative", _chained_sql(3))
def impute_iterative(t):
    rows = _order_features(t).withColumn("f2", F.when(F.col("o_orderkey") % 5 != 0, F.col("f2")))
    return rounded(Q.impute_iterative(rows, ["o_totalprice", "f1", "f2", "f3"], rounds=3))


# -- features --------------------------------------------------------------


@query(
    "encode_label",
    f"""
    WITH {DIRTY_ORDERS}, r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i
      FROM dirty_orders WHERE o_orderpriority IS NOT NULL AND {SPLIT_SQL('o_orderkey')} < 80 GROUP BY 1)
    SELECT o_orderkey, coalesce(i, (SELECT count(*) FROM r)) AS priority_index FROM dirty_orders LEFT JOIN r USING (o_orderpriority)
    """,
)
def encode_label(t):
    d = t.dirty_orders
    train = d.filter(split_bucket(F.col("o_orderkey")) < 80)
    return X.encode_label(train, d, "o_orderpriority", "priority_index").select("o_orderkey", "priority_index")


@query(
    "encode_ordinal",
    f"""
    WITH {DIRTY_ORDERS} SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1
      WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 ELSE -1 END AS urgency FROM dirty_orders
    """,
)
def encode_ordinal(t):
    order = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    return t.dirty_orders.select("o_orderkey", X.encode_ordinal(F.col("o_orderpriority"), order).alias("urgency"))


@query(
    "encode_onehot",
    "SELECT event_id, "
    + ", ".join(
        f"CAST(event_type = '{e}' AS INTEGER) AS event_type_{e}" for e in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events",
)
def encode_onehot(t):
    wide = X.encode_onehot(t.events.select("event_id", "event_type"), "event_type")
    return wide.drop("event_type")


@query(
    "encode_dummies",
    """
    SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O,
      CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P FROM orders
    """,
)
def encode_dummies(t):
    return X.encode_dummies(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query(
    "encode_target",
    """
    WITH b AS (SELECT event_id, user_id, CAST(event_type = 'purchase' AS INTEGER) AS y FROM events),
    g AS (SELECT user_id, sum(y) AS s, count(*) AS n FROM b GROUP BY 1)
    SELECT event_id, round(s / n, 6) AS mean_target, round((s - y) / nullif(n - 1, 0), 6) AS loo_target FROM b JOIN g USING (user_id)
    """,
)
def encode_target(t):
    base = t.events.select("event_id", "user_id", (F.col("event_type") == "purchase").cast("int").alias("y"))
    plain = X.encode_target(base, "user_id", "y").withColumnRenamed("user_id_target", "mean_target")
    both = X.encode_target(plain, "user_id", "y", leave_one_out=True)
    return both.select(
        "event_id", F.round("mean_target", 6).alias("mean_target"), F.round("user_id_target", 6).alias("loo_target")
    )


@query(
    "assemble_features",
    "SELECT p_partkey, round(p_size + p_retailprice, 2) AS total, CAST(2 AS INTEGER) AS n FROM part",
)
def assemble_features(t):
    from pyspark.ml.functions import vector_to_array

    df = X.assemble_features(t.part, ["p_size", "p_retailprice"]).withColumn("a", vector_to_array("features"))
    return df.select(
        "p_partkey", F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 2).alias("total"), F.size("a").alias("n")
    )


@query(
    "scale_standard",
    f"""
    WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders WHERE {SPLIT_SQL('o_orderkey')} < 80)
    SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice FROM orders, s WHERE {SPLIT_SQL('o_orderkey')} >= 80
    """,
)
def scale_standard(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    train = split_bucket(F.col("o_orderkey")) < 80
    return rounded(X.scale_standard(rows.filter(train), rows.filter(~train), ["o_totalprice"]), 6)


@query(
    "scale_minmax",
    """
    WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT event_id, round((value - lo) / (hi - lo), 6) AS value FROM events, s
    """,
)
def scale_minmax(t):
    rows = t.events.select("event_id", "value")
    return rounded(X.scale_minmax(rows, rows, ["value"]), 6)


@query(
    "poly_features",
    """
    SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice AS b, p_size * p_size::DOUBLE AS "a*a",
      round(p_size * p_retailprice, 4) AS "a*b", round(p_retailprice * p_retailprice, 4) AS "b*b" FROM part
    """,
)
def poly_features(t):
    base = t.part.select("p_partkey", F.col("p_size").alias("a"), F.col("p_retailprice").alias("b"))
    return X.poly_features(base, ["a", "b"], 2).select(
        "p_partkey", "a", "b", "`a*a`", F.round("`a*b`", 4).alias("a*b"), F.round("`b*b`", 4).alias("b*b")
    )


@query(
    "radial_feature",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * l_discount + l_tax * l_tax, 6) AS radius2 FROM lineitem
    """,
)
def radial_feature(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(X.radial_feature("l_discount", "l_tax"), 6).alias("radius2")
    )


@query("nystrom_features")
def nystrom_features(t):
    phi = X.nystrom_features(t.embeddings, "vec_id", "embedding", m=16, param=0.5)
    return phi.select("vec_id", F.array_join(F.transform("phi", lambda x: F.round(x, 4).cast("string")), ",").alias("phi"))


@query("pca_project")
def pca_project(t):
    scores, share = X.pca_project(t.embeddings, "embedding", 3)
    return scores.select(
        "vec_id",
        *[F.round(F.col("scores")[i], 4).alias(f"pc{i + 1}") for i in range(3)],
        F.lit(round(float(share.sum()), 6)).alias("explained"),
    )


@query("svd_low_rank")
def svd_low_rank(t):
    from tablewright.functions.arrays import squared_distance

    approx = X.svd_low_rank(t.embeddings, "embedding", 8)
    zero = F.transform("embedding", lambda x: F.lit(0.0))
    return approx.select(
        "vec_id",
        F.round(squared_distance(F.col("embedding"), F.col("approx")), 5).alias("residual"),
        F.round(squared_distance(F.col("embedding"), zero), 5).alias("energy"),
    )


@query("nmf_factors")
def nmf_factors(t):
    # Shifted to be non-negative: embeddings are unit vectors, so every entry is above -1.
    positive = t.embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double") + 1).alias("v"))
    factors, rows = X.nmf_factors(positive, "vec_id", "v", 4)
    top = [sorted(range(len(f)), key=lambda i: -f[i])[:5] for f in factors]
    names = F.array(*[F.lit(" ".join(map(str, x))) for x in top])
    best = F.array_position("weights", F.array_max("weights")).cast("int")
    return rows.select("vec_id", best.alias("component"), F.element_at(names, best).alias("top_features"))


@query("select_by_importance")
def select_by_importance(t):
    from tablewright.operators.trees import feature_importance
    from tablewright.plans.learning import FEATURES, line_table

    importance = feature_importance(line_table(t), FEATURES, "label")
    kept = set(X.select_by_importance(importance))
    return small_table(
        t.spark,
        [(k, float(v), int(k in kept)) for k, v in importance.items()],
        "feature string, importance double, kept int",
    )


# -- sampling --------------------------------------------------------------


@query(
    "split_random",
    f"SELECT o_orderkey, CASE WHEN {SPLIT_SQL('o_orderkey')} < 80 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def split_random(t):
    return S.split_random(t.orders.select("o_orderkey"), "o_orderkey")


_HASH = "(o_orderkey % 2147483648) * 2654435761 % 4294967296"


@query(
    "split_stratified",
    f"""
    SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH}, o_orderkey)
      <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.8) THEN 'train' ELSE 'test' END AS part FROM orders
    """,
)
def split_stratified(t):
    return S.split_stratified(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 0.8)


@query(
    "kfold_assign",
    f"""
    SELECT o_orderkey, CAST(({_HASH}) * 5 // 4294967296 AS INTEGER) AS fold,
      CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH}, o_orderkey) - 1) % 5 AS INTEGER) AS strat_fold FROM orders
    """,
)
def kfold_assign(t):
    plain = S.kfold_assign(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 5)
    return S.kfold_assign(plain, "o_orderkey", 5, "o_orderstatus", "strat_fold").drop("o_orderstatus")


@query(
    "class_weights",
    """
    WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
      round((SELECT count(*) FROM lineitem) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM lineitem JOIN c USING (l_returnflag)
    """,
)
def class_weights(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return rounded(S.class_weights(rows, "l_returnflag"), 6)


@query(
    "imbalance_ratio",
    """
    SELECT max(n) AS majority, min(n) AS minority, round(max(n) / min(n), 6) AS ratio
    FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
    """,
)
def imbalance_ratio(t):
    return rounded(S.imbalance_ratio(t.orders, "o_orderstatus"), 6)


@query("smote_nc")
def smote_nc(t):
    rows = t.orders.select(
        "o_orderkey",
        (F.col("o_totalprice") / 1000).alias("price"),
        (F.col("o_custkey") / 100).alias("cust"),
        "o_orderstatus",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
    )
    made = N.smote_nc(rows, "o_orderkey", "urgent", ["price", "cust"], ["o_orderstatus"], 5)
    return rounded(made.groupBy("urgent", "synthetic", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean_price"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.avg("cust").alias("mean_cust"),
    ))


@query(
    "bootstrap_sample",
    f"""
    WITH m AS (SELECT o_orderkey, o_totalprice, (o_orderkey % 1048576 + 7 * 7919) % 2147483648 * 2654435761 % 4294967296 AS m FROM orders),
    u AS (SELECT *, (((m % 1048576) * 40503 + m // 1048576) % 1000003 + 0.5::DOUBLE) / 1000003 AS u FROM m)
    SELECT o_orderkey, o_totalprice, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM (
      SELECT *, len(list_filter({S.poisson_steps(0.8)}, lambda c: c < u)) AS n FROM u)
    """,
)
def bootstrap_sample(t):
    return S.bootstrap_sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 0.8, 7)
