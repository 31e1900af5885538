"""Models, model selection and clustering."""

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.operators import cells
from tablewright.operators import classify as C
from tablewright.operators import cluster as K
from tablewright.operators import evaluate as E
from tablewright.operators import linear as L
from tablewright.operators import neighbours as N
from tablewright.operators import trees as M
from tablewright.operators.aggs import describe_numeric
from tablewright.operators.joins import nearest_assign
from tablewright.operators.sampling import hash_percent, kfold_assign
from tablewright.operators.skew import held
from tablewright.plans.bindings import SPLIT_SQL
from tablewright.plans.registry import query
from tablewright.plans.relational import rounded

FEATURES = ["l_quantity", "l_price", "l_discount", "l_tax", "l_linenumber"]


def line_table(t):
    """Line items with a 0/1 label (net price above 40,000) and a hash split by order."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.select(
        "l_orderkey",
        "l_quantity",
        (F.col("l_extendedprice") / 1000).alias("l_price"),
        "l_discount",
        "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        "l_returnflag",
        (net > 40000).cast("double").alias("label"),
        F.when(hash_percent(F.col("l_orderkey")) < 80, "train").otherwise("test").alias("part"),
    )


def line_split(t, *keep):
    rows = M.assembled(line_table(t), FEATURES, "label", "part", *keep)
    return rows.filter("part = 'train'"), rows.filter("part = 'test'")


def vector_table(t):
    """Embeddings as vectors with their class, and a hash split."""
    return t.embeddings.select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
        F.when(hash_percent(F.col("vec_id")) < 80, "train").otherwise("test").alias("part"),
    )


def vector_split(t):
    v = vector_table(t)
    return v.filter("part = 'train'"), v.filter("part = 'test'")


# -- regression ------------------------------------------------------------


@query(
    "ols_simple",
    """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
      round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2
    FROM lineitem GROUP BY 1
    """,
)
def ols_simple(t):
    f = L.ols_simple(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return f.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"))


_NORMAL_2 = """m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my,
  var_pop(l_quantity) AS xx, covar_pop(l_quantity, l_discount) AS xz, var_pop(l_discount) AS zz,
  covar_pop(l_quantity, l_extendedprice) AS xy, covar_pop(l_discount, l_extendedprice) AS zy, var_pop(l_extendedprice) AS yy FROM lineitem),
b AS (SELECT *, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2, xx * zz - xz * xz AS det FROM m),
s AS (SELECT *, my - b1 * mx - b2 * mz AS b0, n * (yy - b1 * xy - b2 * zy) / (n - 3) AS s2 FROM b)"""


@query(
    "ols_inference",
    f"""
    WITH {_NORMAL_2}
    SELECT 'intercept' AS term, round(b0, 4) AS coef, round(sqrt(s2 * (1 / n + (mx * mx * zz - 2 * mx * mz * xz + mz * mz * xx) / det / n)), 4) AS std_err FROM s
    UNION ALL SELECT 'l_quantity', round(b1, 4), round(sqrt(s2 * zz / det / n), 4) FROM s
    UNION ALL SELECT 'l_discount', round(b2, 4), round(sqrt(s2 * xx / det / n), 4) FROM s
    """,
)
def ols_inference(t):
    return rounded(L.ols_inference(t.lineitem, ["l_quantity", "l_discount"], "l_extendedprice").select("term", "coef", "std_err"))


@query("poly_regression_sweep")
def poly_regression_sweep(t):
    rows = line_table(t)
    sweep = L.poly_regression_sweep(
        rows.filter("part = 'train'"), rows.filter("part = 'test'"), "l_quantity", "l_price", [1, 2, 3, 4]
    )
    return rounded(sweep, 6)


@query("ridge_lasso")
def ridge_lasso(t):
    return rounded(L.ridge_lasso(line_table(t), ["l_quantity", "l_discount", "l_tax"], "l_price", [0.01, 0.1, 1.0]), 6)


@query("kernel_regression")
def kernel_regression(t):
    rows = t.embeddings.select("vec_id", "embedding", F.col("label").cast("double").alias("y"))
    ridge = L.kernel_regression(rows, "vec_id", "embedding", "y", 24, "rbf", 0.5)
    pcr = L.kernel_regression(rows, "vec_id", "embedding", "y", 24, "poly", 2, components=2)
    a = E.regression_metrics(ridge, "y", "prediction").select(F.lit("ridge").alias("model"), "n", "rmse", "r2")
    b = E.regression_metrics(pcr, "y", "prediction").select(F.lit("components").alias("model"), "n", "rmse", "r2")
    return rounded(a.unionByName(b))


@query(
    "tls_regression",
    """
    WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, stddev_pop(l_quantity) AS sx, stddev_pop(l_extendedprice) AS sy,
      corr(l_quantity, l_extendedprice) AS r FROM lineitem)
    SELECT 'l_quantity' AS term, round(sign(r) * sy / sx, 4) AS coef FROM m
    UNION ALL SELECT 'intercept', round(my - sign(r) * sy / sx * mx, 4) FROM m
    """,
)
def tls_regression(t):
    return rounded(L.tls_regression(t.lineitem, ["l_quantity"], "l_extendedprice"))


# -- classification --------------------------------------------------------


@query("logistic_regression")
def logistic_regression(t):
    return rounded(M.logistic_regression(*line_split(t)), 4)


@query("logit_inference")
def logit_inference(t):
    rows = line_table(t)
    ranked = M.logit_inference(rows, FEATURES)
    stats = describe_numeric(rows, FEATURES)
    top = ranked.filter("position <= 3").join(stats, F.col("feature") == F.col("column_name")).drop("column_name")
    return rounded(top)


def _sgd_sql(rates, epochs):
    """Full-batch gradient steps as one common table expression per epoch."""
    z = ["1.0::DOUBLE", *[f"({x} - m{i}) / s{i}" for i, x in enumerate(FEATURES)]]
    n = len(z)
    lin = " + ".join(f"w{j} * z{j}" for j in range(n))
    base = (
        "b AS (SELECT CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) > 40000 AS DOUBLE) AS y, l_quantity, l_extendedprice / 1000 AS l_price, "
        "l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem), s AS (SELECT "
        + ", ".join(f"avg({x}) AS m{i}, stddev_pop({x}) AS s{i}" for i, x in enumerate(FEATURES))
        + " FROM b), z AS MATERIALIZED (SELECT y, " + ", ".join(f"{e} AS z{i}" for i, e in enumerate(z)) + " FROM b, s), "
        + "w0 AS MATERIALIZED (SELECT rate::DOUBLE AS rate, " + ", ".join(f"0.0::DOUBLE AS w{j}" for j in range(n))
        + f" FROM (VALUES {', '.join(f'({r})' for r in rates)}) v(rate))"
    )
    steps = [
        f"w{e + 1} AS MATERIALIZED (SELECT rate, "
        + ", ".join(f"any_value(w{j}) - rate * avg((1 / (1 + exp(-({lin}))) - y) * z{j}) AS w{j}" for j in range(n))
        + f" FROM z, w{e} GROUP BY rate)"
        for e in range(epochs - 1)
    ]
    loss = f"avg(greatest({lin}, 0) + ln(1 + exp(-abs({lin}))) - y * ({lin}))"
    rows = [f"SELECT rate, {e}::INTEGER AS epoch, round({loss}, 6) AS log_loss FROM z, w{e} GROUP BY rate" for e in range(epochs)]
    return f"WITH {base}, {', '.join(steps)} {' UNION ALL '.join(rows)}"


@query("sgd_logistic", _sgd_sql([0.05, 0.5, 2.0], 10))
def sgd_logistic(t):
    table, _ = C.sgd_logistic(line_table(t), FEATURES, "label", [0.05, 0.5, 2.0], epochs=10)
    return rounded(table, 6)


@query("decision_tree")
def decision_tree(t):
    return rounded(M.decision_tree(*line_split(t), impurity="entropy", depth=5, min_leaf=5))


@query("random_forest")
def random_forest(t):
    return rounded(M.random_forest(*line_split(t)))


@query("bagging_trees")
def bagging_trees(t):
    return rounded(M.bagging_trees(*line_split(t), trees=30))


@query("extra_trees")
def extra_trees(t):
    return rounded(M.extra_trees(*line_split(t)))


@query("gradient_boosting")
def gradient_boosting(t):
    rows = line_table(t)
    train, test, count = M.tree_split(rows, FEATURES)
    binary = M.gradient_boosting(train, test, rounds=8, count=count).select(F.lit("binary").alias("task"), "n", "accuracy")
    lab = F.when(F.col("l_quantity") < 15, 0.0).when(F.col("l_price") < 40, 1.0).otherwise(2.0)
    train, test, count = M.tree_split(rows.withColumn("label", lab), FEATURES)
    multi = M.gradient_boosting_multi(train, test, rounds=3, count=count)
    return rounded(binary.unionByName(multi.select(F.lit("one vs rest").alias("task"), "n", "accuracy")))


@query("gbt_multi_target")
def gbt_multi_target(t):
    rows = line_table(t).withColumn("net", F.col("l_price") * (1 - F.col("l_discount"))).withColumn(
        "taxed", F.col("l_price") * (1 + F.col("l_tax"))
    )
    data = M.assembled(rows, FEATURES, "net", "taxed", "part")
    return rounded(M.gbt_multi_target(data.filter("part = 'train'"), data.filter("part = 'test'"), ["net", "taxed"], 5))


@query("adaboost")
def adaboost(t):
    train, test = line_split(t)
    pred, log = C.adaboost(train, test, "features", "label", rounds=5)
    return rounded(C.binary_metrics(pred).withColumn("rounds", F.lit(len(log))))


_VECTORS = f"""v AS (SELECT vec_id, label, {SPLIT_SQL('vec_id')} < 80 AS train, unnest(embedding)::DOUBLE AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)"""


def _bayes_sql():
    """Both models in closed form: normal densities per class and component, and smoothed shares."""
    sums = ", ".join(f"sum({x}) AS t{i}" for i, x in enumerate(FEATURES))
    share = " + ".join(f"{x} * ln((t{i} + 1) / (all_t + {len(FEATURES)}))" for i, x in enumerate(FEATURES))
    return f"""
    WITH {_VECTORS}, st AS (SELECT label, i, avg(e) AS m, var_pop(e) AS v FROM v WHERE train GROUP BY ALL),
    pr AS (SELECT label, count(*) FILTER (train) AS c FROM (SELECT DISTINCT vec_id, label, train FROM v) GROUP BY 1),
    g AS (SELECT a.vec_id, any_value(a.label) AS y, st.label AS c, ln(any_value(pr.c)) - sum((a.e - m) * (a.e - m) / (2 * st.v) + 0.5 * ln(st.v)) AS s
      FROM v a JOIN st USING (i) JOIN pr ON pr.label = st.label WHERE NOT a.train GROUP BY a.vec_id, st.label),
    gp AS (SELECT vec_id, any_value(y) AS y, arg_max(c, s) AS p FROM g GROUP BY 1),
    b AS (SELECT row_number() OVER () AS id, CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) > 40000 AS INTEGER) AS y, l_quantity, l_extendedprice / 1000 AS l_price,
      l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber, {SPLIT_SQL('l_orderkey')} < 80 AS train FROM lineitem),
    ms AS (SELECT y AS c, count(*) AS n, {sums} FROM b WHERE train GROUP BY 1),
    mt AS (SELECT *, {" + ".join(f"t{i}" for i in range(len(FEATURES)))} AS all_t FROM ms),
    mp AS (SELECT id, any_value(y) AS y, arg_max(c, ln(n + 1) + {share}) AS p FROM b, mt WHERE NOT train GROUP BY id)
    SELECT 'gaussian' AS kind, count(*) AS n, round(avg(CAST(y = p AS INTEGER)), 4) AS accuracy FROM gp
    UNION ALL SELECT 'multinomial', count(*), round(avg(CAST(y = p AS INTEGER)), 4) FROM mp
    """


@query("naive_bayes", _bayes_sql())
def naive_bayes(t):
    train, test = vector_split(t)
    gauss = M.naive_bayes(train, test, "gaussian").select(F.lit("gaussian").alias("kind"), "n", "accuracy")
    a, b = line_split(t)
    multi = M.naive_bayes(a, b, "multinomial").select(F.lit("multinomial").alias("kind"), "n", "accuracy")
    return rounded(gauss.unionByName(multi))


# Two features, three classes: the closed form fits into SQL.
_GAUSS = f"""g AS (SELECT l_returnflag AS c, l_quantity / 10 AS x, (l_extendedprice / 10000 + l_linenumber * CASE WHEN l_returnflag = 'R' THEN 2
  WHEN l_returnflag = 'N' THEN 1 ELSE 0.5 END) AS y, {SPLIT_SQL('l_orderkey')} < 80 AS train FROM lineitem),
own AS (SELECT c, count(*) / (SELECT count(*) FROM g WHERE train) AS pr, avg(x) AS mx, avg(y) AS my, var_samp(x) AS xx, covar_samp(x, y) AS xy, var_samp(y) AS yy
  FROM g WHERE train GROUP BY 1),
alls AS (SELECT var_samp(x) AS xx, covar_samp(x, y) AS xy, var_samp(y) AS yy FROM g WHERE train),
par AS (SELECT 'identity' AS cov, c, pr, mx, my, 1.0::DOUBLE AS xx, 0.0::DOUBLE AS xy, 1.0::DOUBLE AS yy FROM own
  UNION ALL SELECT 'pooled', c, pr, mx, my, alls.xx, alls.xy, alls.yy FROM own, alls
  UNION ALL SELECT 'own', c, pr, mx, my, xx, xy, yy FROM own),
sc AS (SELECT cov, r.id, r.c AS label, p.c AS class, ln(pr) - 0.5 * ln(xx * yy - xy * xy)
    - 0.5 * (yy * (x - mx) * (x - mx) - 2 * xy * (x - mx) * (y - my) + xx * (y - my) * (y - my)) / (xx * yy - xy * xy) AS s
  FROM (SELECT *, row_number() OVER () AS id FROM g WHERE NOT train) r, par p)"""


def _gauss_rows(t):
    lift = F.when(F.col("l_returnflag") == "R", 2.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(0.5)
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("label"),
        (F.col("l_quantity") / 10).alias("x"),
        (F.col("l_extendedprice") / 10000 + F.col("l_linenumber") * lift).alias("y"),
        (hash_percent(F.col("l_orderkey")) < 80).alias("train"),
    )
    return rows.filter("train").drop("train"), rows.filter("NOT train").drop("train")


@query(
    "gaussian_discriminant",
    f"""
    WITH {_GAUSS}, b AS (SELECT cov, id, label, arg_max(class, s) AS prediction FROM sc GROUP BY ALL)
    SELECT cov, label, prediction, count(*) AS n FROM b GROUP BY ALL
    """,
)
def gaussian_discriminant(t):
    train, test = _gauss_rows(t)
    out = None
    for cov in ("identity", "pooled", "own"):
        pred = C.gaussian_discriminant(train, test, "label", ["x", "y"], cov)
        row = pred.groupBy(F.lit(cov).alias("cov"), "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "bayes_min_risk",
    f"""
    WITH {_GAUSS}, e AS (SELECT id, label, class, exp(s - max(s) OVER (PARTITION BY id)) AS u FROM sc WHERE cov = 'own'),
    p AS (SELECT id, label, sum(CASE class WHEN 'A' THEN u ELSE 0 END) / sum(u) AS a, sum(CASE class WHEN 'N' THEN u ELSE 0 END) / sum(u) AS n,
      sum(CASE class WHEN 'R' THEN u ELSE 0 END) / sum(u) AS r FROM e GROUP BY ALL),
    k AS (SELECT id, label, 1 * n + 4 * r AS ra, 2 * a + 1 * r AS rn, 3 * a + 1 * n AS rr FROM p)
    SELECT label, CASE WHEN ra <= rn AND ra <= rr THEN 'A' WHEN rn <= rr THEN 'N' ELSE 'R' END AS prediction, count(*) AS n FROM k GROUP BY ALL
    """,
)
def bayes_min_risk(t):
    train, test = _gauss_rows(t)
    loss = [[0, 2, 3], [1, 0, 1], [4, 1, 0]]
    pred = C.bayes_min_risk(train, test, "label", ["x", "y"], loss)
    return pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("linear_svc")
def linear_svc(t):
    return rounded(M.linear_svc(*line_split(t)))


@query("kernel_svc")
def kernel_svc(t):
    rows = t.embeddings.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.col("label").cast("double").alias("label"),
        (hash_percent(F.col("vec_id")) < 80).alias("train"),
    )
    train, test = rows.filter("train"), rows.filter("not train")
    rbf = M.kernel_svc(train, test, "vec_id", "v", "rbf", 0.5).select(F.lit("rbf").alias("kernel"), "n", "accuracy")
    poly = M.kernel_svc(train, test, "vec_id", "v", "poly", 2).select(F.lit("poly").alias("kernel"), "n", "accuracy")
    return rounded(rbf.unionByName(poly))


# Student's t at 0.975 by the expansion around the normal quantile, exact to 1e-9 at these sizes.
_T975 = "(1.959963984540054 + 2.372271230026 / f + 2.822498618030 / (f * f))"


@query(
    "ols_intervals",
    f"""
    WITH m AS (SELECT count(*) AS n, count(*) - 2 AS f, avg(l_quantity) AS mx, regr_slope(l_extendedprice, l_quantity) AS b,
      regr_intercept(l_extendedprice, l_quantity) AS a, regr_sxx(l_extendedprice, l_quantity) AS sxx,
      regr_syy(l_extendedprice, l_quantity) - pow(regr_sxy(l_extendedprice, l_quantity), 2) / regr_sxx(l_extendedprice, l_quantity) AS sse FROM lineitem),
    r AS (SELECT l_orderkey, l_linenumber, a + b * l_quantity AS fit, {_T975} AS q, sse / f AS s2,
      1 / n + (l_quantity - mx) * (l_quantity - mx) / sxx AS lever FROM lineitem, m)
    SELECT l_orderkey, l_linenumber, round(fit, 1) AS fit, round(fit - q * sqrt(s2 * lever), 1) AS ci_low, round(fit + q * sqrt(s2 * lever), 1) AS ci_high,
      round(fit - q * sqrt(s2 * (1 + lever)), 1) AS pi_low, round(fit + q * sqrt(s2 * (1 + lever)), 1) AS pi_high FROM r
    """,
)
def ols_intervals(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return rounded(L.ols_intervals(rows, ["l_quantity"], "l_extendedprice").drop("l_quantity", "l_extendedprice"), 1)


@query(
    "knn_classify",
    f"""
    WITH {_VECTORS}, d AS (SELECT a.vec_id, b.vec_id AS ref, any_value(b.label) AS label, sum((a.e - b.e) * (a.e - b.e)) AS dist
      FROM v a JOIN v b USING (i) WHERE NOT a.train AND b.train GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, ref) AS rn FROM d),
    w AS (SELECT vec_id, label, count(*) AS votes FROM r WHERE rn <= 5 GROUP BY ALL)
    SELECT vec_id, arg_min(label, -votes * 1000 + label) AS prediction FROM w GROUP BY 1
    """,
)
def knn_classify(t):
    train = hash_percent(F.col("vec_id")) < 80
    return N.knn_classify(t.embeddings.filter(~train), t.embeddings.filter(train), "vec_id", "label", "embedding", 5)


@query("mlp_classifier")
def mlp_classifier(t):
    return rounded(M.mlp_classifier(*vector_split(t), layers=[64, 16, 10]))


@query(
    "group_representative",
    """
    WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label AS ref, i, avg(v) AS m FROM x GROUP BY ALL),
    d AS (SELECT vec_id, label, ref, sum((v - m) * (v - m)) AS dist FROM x JOIN c USING (i) GROUP BY ALL),
    n AS (SELECT vec_id, label, arg_min(ref, dist) AS prediction FROM d GROUP BY ALL)
    SELECT label, count(*) AS n, count(*) FILTER (label = prediction) AS correct FROM n GROUP BY 1
    """,
)
def group_representative(t):
    centres = C.group_representative(t.embeddings, "label", "embedding", "mean")
    near = nearest_assign(t.embeddings, "embedding", centres, "prediction")
    return near.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("correct")
    )


@query("group_representative_rank1")
def group_representative_rank1(t):
    positive = t.embeddings.select("label", F.transform("embedding", lambda x: x.cast("double") + 1).alias("v"))
    out = None
    for how in ("pca", "nmf", "norm"):
        near = nearest_assign(positive, "v", C.group_representative(positive, "label", "v", how), "prediction")
        row = near.agg(
            F.lit(how).alias("how"), F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("label") == F.col("prediction")).alias("correct"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _three_models(train):
    with held(train) as data:
        return {
            "lr": LogisticRegression(maxIter=15).fit(data),
            "rf": RandomForestClassifier(numTrees=8, maxDepth=4, seed=7).fit(data),
            "nb": NaiveBayes(modelType="gaussian").fit(data),
        }


@query("ensemble_inverse_loss")
def ensemble_inverse_loss(t):
    train, test = line_split(t, "l_orderkey")
    # The models learn from one part of the training rows, their weights come from the other.
    fit, valid = train.filter("l_orderkey % 4 <> 0"), train.filter("l_orderkey % 4 = 0")
    pred, weights = C.ensemble_inverse_loss(_three_models(fit), valid, test, "label")
    m = C.binary_metrics(pred)
    return rounded(m.withColumns({f"w_{k}": F.lit(float(v)) for k, v in weights.items()}))


# -- selection -------------------------------------------------------------


@query("grid_search_cv")
def grid_search_cv(t):
    rows = line_table(t).filter("part = 'train'")
    long = rows.count() > cells.MANY
    return rounded(M.grid_search_cells(rows, FEATURES) if long else M.grid_search_cv(line_split(t)[0]))


@query("cross_val_scores")
def cross_val_scores(t):
    rows = kfold_assign(M.assembled(line_table(t), FEATURES, "label", "l_orderkey"), "l_orderkey", 3)
    return rounded(M.cross_val_scores(rows, DecisionTreeClassifier(maxDepth=4, seed=7), 3))


@query("compare_models")
def compare_models(t):
    models = {
        "logistic": LogisticRegression(maxIter=30),
        "forest": RandomForestClassifier(numTrees=10, maxDepth=5, seed=7),
        "bayes": NaiveBayes(modelType="gaussian"),
    }
    return rounded(M.compare_models(models, *line_split(t)))


# -- clustering ------------------------------------------------------------


@query("kmeans_clusters")
def kmeans_clusters(t):
    c = K.kmeans_clusters(vector_table(t), 10)
    return c.select("cluster", "size", F.round(F.sqrt(F.aggregate("centre", F.lit(0.0), lambda s, x: s + x * x)), 4).alias("norm"))


@query("kmeans_evaluate")
def kmeans_evaluate(t):
    return rounded(K.kmeans_evaluate(vector_table(t), [2, 5, 10]))


@query("kmeans_two_stage")
def kmeans_two_stage(t):
    rows = K.kmeans_two_stage(t.embeddings, "embedding", 5)
    return rounded(rows.groupBy("cluster", "half").agg(F.count(F.lit(1)).alias("n"), F.avg("distance").alias("mean_distance")))


@query("gmm_clusters")
def gmm_clusters(t):
    rows = M.assembled(line_table(t), ["l_quantity", "l_price"])
    table, _ = K.gmm_clusters(rows, 3)
    return table.select("component", F.round("weight", 4).alias("weight"), F.round(F.col("mean")[0], 3).alias("m0"), F.round(F.col("mean")[1], 3).alias("m1"), "size")


def _facility_sql(rounds, start):
    ctes = ["pts AS (SELECT l_partkey, avg(l_extendedprice) / 1000 AS x, avg(l_quantity) AS y, sum(l_quantity) AS w FROM lineitem GROUP BY 1)"]
    values = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(start))
    ctes.append(f"f0(i, a, b) AS (VALUES {values})")
    for r in range(1, rounds + 1):
        ctes.append(
            f"a{r} AS (SELECT l_partkey, x, y, w, arg_min(i, sqrt((x - a) * (x - a) + (y - b) * (y - b))) AS i FROM pts, f{r - 1} GROUP BY ALL)"
        )
        ctes.append(f"f{r} AS (SELECT i, sum(x * w) / sum(w) AS a, sum(y * w) / sum(w) AS b FROM a{r} GROUP BY 1)")
    last = (
        f"z AS (SELECT l_partkey, w, arg_min(i, sqrt((x - a) * (x - a) + (y - b) * (y - b))) AS i, "
        f"min(sqrt((x - a) * (x - a) + (y - b) * (y - b))) AS d FROM pts, f{rounds} GROUP BY ALL)"
    )
    ctes.append(last)
    return (
        "WITH " + ",\n".join(ctes)
        + f" SELECT CAST(f.i AS INTEGER) AS facility, round(a, 4) AS cx, round(b, 4) AS cy, sum(w) AS demand, round(sum(w * d), 2) AS cost, count(*) AS n"
        f" FROM f{rounds} f JOIN z ON z.i = f.i GROUP BY f.i, a, b"
    )


_START = [(45.0, 25.0), (60.0, 25.0)]


@query("facility_location", _facility_sql(9, _START))
def facility_location(t):
    pts = t.lineitem.groupBy("l_partkey").agg(
        (F.avg("l_extendedprice") / 1000).alias("x"), F.avg("l_quantity").alias("y"), F.sum("l_quantity").alias("w")
    )
    f = K.facility_location(pts, "x", "y", "w", _START, 9)
    return f.select("facility", F.round("cx", 4).alias("cx"), F.round("cy", 4).alias("cy"), "demand", F.round("cost", 2).alias("cost"), "n")


@query("cluster_then_classify")
def cluster_then_classify(t):
    return rounded(K.cluster_then_classify(vector_table(t).drop("label"), 6))
