"""Model metrics over a rule-scored table of line items, and residual checks on series."""

from pyspark.sql import functions as F

from tablewright.operators import evaluate as E
from tablewright.operators import series as S
from tablewright.operators import timeseries as TS
from tablewright.plans.bindings import DAILY
from tablewright.plans.registry import query
from tablewright.plans.relational import rounded

# One scoring rule for all metric queries: three class probabilities and a binary score.
_SCORED = """scored AS (
  SELECT l_returnflag AS label, CAST(l_returnflag = 'R' AS INTEGER) AS y,
    (l_quantity + l_linenumber * 7) / 100 AS score,
    (l_quantity + 1) / (l_quantity + 1 + l_linenumber * 8 + 25) AS p_a,
    l_linenumber * 8 / (l_quantity + 1 + l_linenumber * 8 + 25) AS p_n,
    25 / (l_quantity + 1 + l_linenumber * 8 + 25) AS p_r FROM lineitem),
pred AS (SELECT *, CASE WHEN p_a >= p_n AND p_a >= p_r THEN 'A' WHEN p_n >= p_r THEN 'N' ELSE 'R' END AS predicted,
  CAST(score > 0.5 AS INTEGER) AS y_hat FROM scored)"""


def scored(t):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    total = q + 1 + n * 8 + 25
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("label"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        ((q + n * 7) / 100).alias("score"),
        ((q + 1) / total).alias("p_a"),
        (n * 8 / total).alias("p_n"),
        (25 / total).alias("p_r"),
    )
    a, b, c = F.col("p_a"), F.col("p_n"), F.col("p_r")
    return rows.withColumn(
        "predicted", F.when((a >= b) & (a >= c), "A").when(b >= c, "N").otherwise("R")
    ).withColumn("y_hat", (F.col("score") > 0.5).cast("int"))


@query(
    "confusion_matrix",
    f"""
    WITH {_SCORED}, c(k) AS (VALUES ('A'), ('N'), ('R'))
    SELECT a.k AS label, b.k AS prediction, (SELECT count(*) FROM pred WHERE label = a.k AND predicted = b.k) AS n
    FROM c a, c b
    """,
)
def confusion_matrix(t):
    return E.confusion_matrix(scored(t), "label", "predicted")


@query(
    "classification_report",
    f"""
    WITH {_SCORED}, per AS (
      SELECT k AS class, count(*) FILTER (label = k) AS support, count(*) FILTER (predicted = k) AS predicted,
        count(*) FILTER (label = k AND predicted = k) AS hit FROM pred, (VALUES ('A'), ('N'), ('R')) c(k) GROUP BY 1),
    m AS (SELECT *, hit / predicted AS precision, hit / support AS recall FROM per),
    f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM m)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL SELECT 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
      round(sum(hit) / sum(support), 6), sum(support)::BIGINT FROM f
    """,
)
def classification_report(t):
    return rounded(E.classification_report(scored(t), "label", "predicted"), 6)


_ONE_VS_REST = f"""{_SCORED}, ovr AS (
  SELECT 'A' AS class, p_a AS s, label = 'A' AS pos FROM scored
  UNION ALL SELECT 'N', p_n, label = 'N' FROM scored
  UNION ALL SELECT 'R', p_r, label = 'R' FROM scored),
every AS (SELECT class, round(s, 6) AS s, pos FROM ovr UNION ALL SELECT 'micro', round(s, 6), pos FROM ovr)"""


def _one_vs_rest(t):
    cases = F.array(
        *[
            F.struct(F.lit(k).alias("class"), F.round(p, 6).alias("s"), (F.col("label") == k).alias("pos"))
            for k, p in (("A", "p_a"), ("N", "p_n"), ("R", "p_r"))
        ]
    )
    ovr = scored(t).select(F.inline(cases))
    return ovr.select(F.explode(F.array("class", F.lit("micro"))).alias("class"), "s", "pos")


@query(
    "roc_points",
    f"""
    WITH {_ONE_VS_REST}, g AS (SELECT class, s, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n FROM every GROUP BY ALL)
    SELECT class, s AS threshold,
      round(sum(n) OVER (PARTITION BY class ORDER BY s DESC) / sum(n) OVER (PARTITION BY class), 6) AS fpr,
      round(sum(p) OVER (PARTITION BY class ORDER BY s DESC) / sum(p) OVER (PARTITION BY class), 6) AS tpr FROM g
    """,
)
def roc_points(t):
    return rounded(E.roc_points(_one_vs_rest(t), "s", F.col("pos"), ["class"]), 6)


@query(
    "auc_roc",
    f"""
    WITH {_ONE_VS_REST}, r AS (SELECT class, pos, rank() OVER w + (count(*) OVER (PARTITION BY class, s) - 1) / 2 AS rk
      FROM every WINDOW w AS (PARTITION BY class ORDER BY s)),
    a AS (SELECT class, sum(rk) FILTER (pos) AS rs, count(*) FILTER (pos)::DOUBLE AS p, count(*) FILTER (NOT pos)::DOUBLE AS n FROM r GROUP BY 1)
    SELECT class, round((rs - p * (p + 1) / 2) / (p * n), 6) AS auc FROM a
    """,
)
def auc_roc(t):
    return rounded(E.auc_roc(_one_vs_rest(t), "s", F.col("pos"), ["class"]), 6)


@query(
    "log_loss",
    f"""
    WITH {_SCORED} SELECT
      round(avg(-ln(CASE WHEN y = 1 THEN least(greatest(score, 1e-15), 1 - 1e-15) ELSE 1 - least(greatest(score, 1e-15), 1 - 1e-15) END)), 6) AS log_loss,
      round(avg(-ln(CASE label WHEN 'A' THEN p_a WHEN 'N' THEN p_n ELSE p_r END)), 6) AS log_loss_multi FROM scored
    """,
)
def log_loss(t):
    s = scored(t)
    true_p = F.when(F.col("label") == "A", F.col("p_a")).when(F.col("label") == "N", F.col("p_n")).otherwise(F.col("p_r"))
    multi = E.log_loss_multi(s, true_p).scalar()
    return rounded(E.log_loss(s, "y", "score").select("log_loss", multi.alias("log_loss_multi")), 6)


@query(
    "hinge_loss",
    f"""
    WITH {_SCORED} SELECT round(sum(greatest(0, 1 - (2 * y - 1) * (score * 4 - 2))), 4) AS hinge_sum,
      round(avg(greatest(0, 1 - (2 * y - 1) * (score * 4 - 2))), 6) AS hinge_mean FROM scored
    """,
)
def hinge_loss(t):
    out = E.hinge_loss(scored(t), 2 * F.col("y") - 1, F.col("score") * 4 - 2)
    return out.select(F.round("hinge_sum", 4).alias("hinge_sum"), F.round("hinge_mean", 6).alias("hinge_mean"))


@query("zero_one_error", f"WITH {_SCORED} SELECT round(avg(CAST(y <> y_hat AS INTEGER)), 6) AS error FROM pred")
def zero_one_error(t):
    return rounded(E.zero_one_error(scored(t), "y", "y_hat"), 6)


_PRICED = "priced AS (SELECT l_extendedprice AS actual, l_quantity * 1500 AS predicted FROM lineitem)"


def _priced(t):
    return t.lineitem.select(
        F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500).alias("predicted")
    )


@query(
    "regression_metrics",
    f"""
    WITH {_PRICED}, m AS (SELECT count(*) AS n, avg(abs(actual - predicted)) AS mae, avg((actual - predicted) * (actual - predicted)) AS mse,
      var_pop(actual) AS v FROM priced)
    SELECT n, round(mae, 4) AS mae, round(mse, 2) AS mse, round(sqrt(mse), 4) AS rmse, round(1 - mse / v, 6) AS r2,
      round(1 - (mse / v) * (n - 1) / (n - 2), 6) AS adj_r2 FROM m
    """,
)
def regression_metrics(t):
    m = E.regression_metrics(_priced(t), "actual", "predicted", 1)
    return m.select(
        "n", F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"),
        F.round("r2", 6).alias("r2"), F.round("adj_r2", 6).alias("adj_r2"),
    )


@query(
    "mape",
    """
    SELECT l_returnflag, round(avg(abs((l_tax - 0.04) / nullif(l_tax, 0))), 6) AS mape FROM lineitem GROUP BY 1
    """,
)
def mape(t):
    rows = t.lineitem.select("l_returnflag", "l_tax", F.lit(0.04).alias("guess"))
    return rounded(E.mape(rows, "l_tax", "guess", ["l_returnflag"]).drop("mape_masked"), 6)


@query(
    "mape_masked",
    """
    SELECT l_returnflag, round(avg(abs(l_tax - 0.04) / CASE WHEN l_tax = 0 THEN 1 ELSE l_tax END), 6) AS mape_masked
    FROM lineitem GROUP BY 1
    """,
)
def mape_masked(t):
    rows = t.lineitem.select("l_returnflag", "l_tax", F.lit(0.04).alias("guess"))
    return rounded(E.mape(rows, "l_tax", "guess", ["l_returnflag"]).drop("mape"), 6)


@query(
    "residual_runs_test",
    f"""
    WITH {DAILY}, u AS (SELECT series_id, t, CAST(value >= avg(value) OVER (PARTITION BY series_id) AS INTEGER) AS up FROM daily),
    w AS (SELECT *, CAST(up <> lag(up) OVER (PARTITION BY series_id ORDER BY t) AS INTEGER) AS turn FROM u),
    s AS (SELECT series_id, count(*) AS n, CAST(1 + sum(turn) AS BIGINT) AS runs, sum(up)::DOUBLE AS a FROM w GROUP BY 1),
    z AS (SELECT *, 1 + 2 * a * (n - a) / n AS m, 2 * a * (n - a) * (2 * a * (n - a) - n) / (n::DOUBLE * n * (n - 1)) AS v FROM s)
    SELECT series_id, n, runs, round(CASE WHEN n > 50 THEN runs - m WHEN runs - m > 0.5 THEN runs - m - 0.5
      WHEN runs - m < -0.5 THEN runs - m + 0.5 ELSE 0 END / sqrt(v), 6) AS z FROM z
    """,
)
def residual_runs_test(t):
    return rounded(E.residual_runs_test(t.daily, ["series_id"], "t", "value").drop("p"), 6)


@query(
    "residual_table",
    f"""
    WITH {DAILY}, f AS (SELECT series_id, regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM daily GROUP BY 1)
    SELECT series_id, t, round(value, 4) AS value, round(value - (a + b * t), 3) AS residual FROM daily JOIN f USING (series_id)
    """,
)
def residual_table(t):
    d = t.daily
    lines, _ = TS.trend_season(d, ["series_id"], "t", "value", 7)
    fitted = d.join(lines, "series_id").withColumn("fit", F.col("intercept") + F.col("slope") * F.col("t"))
    out = E.residual_table(fitted, "value", "fit")
    return out.select("series_id", "t", F.round("value", 4).alias("value"), F.round("residual", 3).alias("residual"))
