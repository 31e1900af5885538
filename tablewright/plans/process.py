"""Process loops and drift."""

from pyspark.sql import functions as F

from tablewright.operators import drift as D
from tablewright.operators import loops as L
from tablewright.plans.bindings import LOOPS
from tablewright.plans.registry import query
from tablewright.plans.relational import rounded

_STATS = """st AS (SELECT loop_id, avg((sp - pv) * (sp - pv)) AS mse, avg(abs(sp - pv)) AS mae, stddev_pop(sp - pv) AS error_std,
  kurtosis_pop(sp - pv) AS error_kurtosis, avg(pow(sp - pv - em, 3)) / pow(stddev_pop(sp - pv), 3) AS error_skew
  FROM (SELECT *, avg(sp - pv) OVER (PARTITION BY loop_id) AS em FROM loops) GROUP BY 1)"""

_NOISE = """nz AS (SELECT loop_id, stddev_pop(d) AS noise_metric, stddev_pop(d) / (stddev_pop(pv) + 1e-9) AS noise_ratio FROM
  (SELECT loop_id, pv, pv - lag(pv) OVER (PARTITION BY loop_id ORDER BY t) AS d FROM loops) GROUP BY 1)"""

_OSC = """ln AS (SELECT loop_id, count(*) AS n, least(count(*), 256) AS m FROM loops GROUP BY 1),
ls AS (SELECT loop_id, t, sp - pv AS e, n, m, m - m // 2 AS st FROM loops JOIN ln USING (loop_id)),
sg AS (SELECT loop_id, s, m, t - st * s AS j, e FROM ls, (SELECT unnest(range(0, (SELECT max(n) FROM ln))) AS s) WHERE t >= st * s AND t < st * s + m AND st * s + m <= n),
wx AS (SELECT loop_id, s, m, j, (e - avg(e) OVER (PARTITION BY loop_id, s)) * (0.5 - 0.5 * cos(2 * pi() * j / m)) AS x FROM sg),
kx AS (SELECT unnest(range(0, 129)) AS k),
pp AS (SELECT loop_id, s, m, k, (pow(sum(x * cos(2 * pi() * k * j / m)), 2) + pow(sum(x * sin(2 * pi() * k * j / m)), 2))
  AS pw FROM wx, kx WHERE k <= m // 2 GROUP BY loop_id, s, m, k),
pa AS (SELECT loop_id, m, k, avg(pw * CASE WHEN k = 0 OR 2 * k = m THEN 1 ELSE 2 END) AS pw FROM pp GROUP BY loop_id, m, k),
sw AS (SELECT m, sum(pow(0.5 - 0.5 * cos(2 * pi() * i / m), 2)) AS w2 FROM (SELECT DISTINCT m FROM ln), (SELECT unnest(range(0, 256)) AS i) WHERE i < m GROUP BY 1),
os AS (SELECT loop_id, max(pw / w2) / (sum(pw / w2) + 1e-9) AS strength FROM pa JOIN sw USING (m) GROUP BY 1)"""

_STICTION = """least(CASE WHEN strength > 0.1 THEN 60 + CASE WHEN error_kurtosis < 2.5 THEN 20 ELSE 0 END + strength * 20 ELSE 5 END, 99.9)"""

_LAGS = """zz AS (SELECT loop_id, t, (pv - avg(pv) OVER w) / (stddev_pop(pv) OVER w + 1e-9) AS p, (op - avg(op) OVER w) / (stddev_pop(op) OVER w + 1e-9) AS o
  FROM loops WINDOW w AS (PARTITION BY loop_id)),
xc AS (SELECT a.loop_id, a.t - b.t AS k, round(sum(a.p * b.o), 6) AS c FROM zz a JOIN zz b ON a.loop_id = b.loop_id GROUP BY ALL),
lg AS (SELECT loop_id, CAST(abs(first(k ORDER BY c DESC, k)) AS INTEGER) AS pv_op_lag, max(c) AS peak FROM xc GROUP BY 1)"""


@query(
    "loop_error_stats",
    f"""
    WITH {LOOPS}, {_STATS} SELECT loop_id, round(mse, 4) AS mse, round(mae, 4) AS mae, round(error_std, 4) AS error_std,
      round(error_kurtosis, 4) AS error_kurtosis, round(error_skew, 4) AS error_skew FROM st
    """,
)
def loop_error_stats(t):
    return rounded(L.loop_error_stats(t.loops).drop("sp_std"))


@query(
    "loop_noise_ratio",
    f"""
    WITH {LOOPS}, {_NOISE} SELECT loop_id, round(noise_metric, 4) AS noise_metric, round(noise_ratio, 4) AS noise_ratio,
      CAST(noise_ratio > 0.5 AS INTEGER) AS noisy FROM nz
    """,
)
def loop_noise_ratio(t):
    return rounded(L.loop_noise_ratio(t.loops))


@query(
    "loop_oscillation",
    f"""
    WITH {LOOPS}, {_OSC} SELECT loop_id, round(strength, 6) AS oscillation_strength, CAST(strength > 0.1 AS INTEGER) AS oscillating FROM os
    """,
)
def loop_oscillation(t):
    return rounded(L.loop_oscillation(t.loops), 6)


@query(
    "loop_pv_op_lag",
    f"WITH {LOOPS}, {_LAGS} SELECT loop_id, pv_op_lag, round(peak, 4) AS peak FROM lg",
)
def loop_pv_op_lag(t):
    return rounded(L.loop_pv_op_lag(t.loops))


@query(
    "loop_stiction",
    f"WITH {LOOPS}, {_STATS}, {_OSC} SELECT loop_id, round({_STICTION}, 4)::DOUBLE AS stiction FROM st JOIN os USING (loop_id)",
)
def loop_stiction(t):
    return rounded(L.loop_stiction(t.loops))


@query(
    "loop_behaviours",
    f"""
    WITH {LOOPS}, {_STATS}, {_NOISE}, {_OSC}, a AS (SELECT loop_id, mse, strength > 0.1 AS osc, noise_ratio > 0.5 AS noisy, {_STICTION} AS stiction
      FROM st JOIN os USING (loop_id) JOIN nz USING (loop_id))
    SELECT loop_id, concat_ws('; ', CASE WHEN noisy THEN 'Noisy Sensor Signal' END, CASE WHEN osc THEN 'Significant Oscillation' END,
      CASE WHEN mse > 1 AND NOT osc THEN 'External Disturbance' END, CASE WHEN stiction > 50 THEN 'High Valve Stiction Risk' END,
      CASE WHEN NOT noisy AND NOT osc AND NOT (mse > 1) AND stiction <= 50 AND mse < 1 THEN 'Stable / Well-Tuned' END) AS behaviours FROM a
    """,
)
def loop_behaviours(t):
    return L.loop_behaviours(t.loops).select("loop_id", F.array_join("behaviours", "; ").alias("behaviours"))


@query(
    "loop_feature_table",
    f"""
    WITH {LOOPS}, {_STATS}, {_NOISE}, {_OSC}, {_LAGS},
    lb AS (SELECT user_id % 20 AS loop_id, count(*) FILTER (event_type = 'error') AS errs, count(*) AS n FROM events GROUP BY 1)
    SELECT loop_id, round(mse, 4) AS mse, round(mae, 4) AS mae, round(error_std, 4) AS error_std, round(noise_metric, 4) AS noise_metric,
      round(noise_ratio, 4) AS noise_ratio, round(strength, 4) AS oscillation_strength, round(error_kurtosis, 4) AS error_kurtosis,
      round(error_skew, 4) AS error_skew, pv_op_lag, CAST(errs * 5 > n AS INTEGER) AS is_oscillatory, 1 AS is_noisy, 0 AS is_disturbance
    FROM st JOIN nz USING (loop_id) JOIN os USING (loop_id) JOIN lg USING (loop_id) JOIN lb USING (loop_id)
    """,
)
def loop_feature_table(t):
    errs = F.count_if(F.col("event_type") == "error") * 5 > F.count(F.lit(1))
    labels = t.events.groupBy((F.col("user_id") % 20).alias("loop_id")).agg(
        F.when(errs, " Yes (Intermittent)").otherwise("no").alias("oscillatory"),
        F.first(F.lit("may be NOISE")).alias("noisy"),
        F.first(F.lit(None).cast("string")).alias("disturbance"),
    )
    return rounded(L.loop_feature_table(t.loops, labels))


_OFFSET = "off AS (SELECT loop_id, t, pv - 20 AS pv, sp - 20 AS sp, op FROM loops)"


def _offset(t):
    return t.loops.withColumns({"pv": F.col("pv") - 20, "sp": F.col("sp") - 20})


@query(
    "loop_control_metrics",
    f"""
    WITH {LOOPS}, {_OFFSET}, a AS (SELECT *, (abs(sp - pv) + lag(abs(sp - pv)) OVER w) / 2 * 0.1 AS ia,
      (pow(sp - pv, 2) + lag(pow(sp - pv, 2)) OVER w) / 2 * 0.1 AS isq FROM off WINDOW w AS (PARTITION BY loop_id ORDER BY t))
    SELECT loop_id, round(avg(CAST(pv >= 0 AS INTEGER)), 6) AS service_level, round(sum(greatest(-pv, 0)) * 0.1, 4) AS stockout_volume,
      round(avg(CAST(pv < 0 AS INTEGER)), 6) AS stockout_fraction, round(sum(ia), 4) AS iae, round(sum(isq), 4) AS ise,
      round(avg(pv), 4) AS pv_mean, round(stddev_pop(pv), 4) AS pv_std, round(stddev_pop(op), 4) AS op_std FROM a GROUP BY 1
    """,
)
def loop_control_metrics(t):
    m = L.loop_control_metrics(_offset(t), 0.1)
    six = ("service_level", "stockout_fraction")
    return m.select(
        "loop_id", *[F.round(c, 6 if c in six else 4).alias(c) for c in m.columns if c != "loop_id"]
    )


@query(
    "loop_itae",
    f"""
    WITH {LOOPS}, a AS (SELECT loop_id, (t * 0.1 * abs(sp - pv) + lag(t * 0.1 * abs(sp - pv)) OVER (PARTITION BY loop_id ORDER BY t)) / 2 * 0.1 AS v FROM loops)
    SELECT loop_id, round(sum(v), 3) AS itae FROM a GROUP BY 1
    """,
)
def loop_itae(t):
    return rounded(L.loop_itae(t.loops, 0.1), 3)


# -- drift -----------------------------------------------------------------

_HALVES = """side AS (SELECT value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, ts < TIMESTAMP '2024-01-16' AS is_ref FROM events),
long AS (SELECT 'value' AS feature, value AS x, is_ref FROM side UNION ALL SELECT 'k', k, is_ref FROM side)"""


def halves(t):
    rows = t.events.select(
        "value", F.get_json_object("props", "$.k").cast("double").alias("k"),
        (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).alias("is_ref"),
    )
    return rows.filter("is_ref").drop("is_ref"), rows.filter("NOT is_ref").drop("is_ref")


PSI_SQL = f"""
WITH {_HALVES},
q AS (SELECT feature, unnest(range(0, 11)) AS i, list_sort(list(x) FILTER (is_ref)) AS xs FROM long GROUP BY feature),
e0 AS (SELECT DISTINCT feature, xs[CAST(floor(i * (len(xs) - 1) / 10) AS BIGINT) + 1] + (xs[CAST(ceil(i * (len(xs) - 1) / 10) AS BIGINT) + 1]
  - xs[CAST(floor(i * (len(xs) - 1) / 10) AS BIGINT) + 1]) * (i * (len(xs) - 1) / 10 - floor(i * (len(xs) - 1) / 10)) AS lo FROM q),
e AS (SELECT feature, lo, lead(lo) OVER (PARTITION BY feature ORDER BY lo) AS hi, max(lo) OVER (PARTITION BY feature) AS top FROM e0),
h AS (SELECT e.feature, lo, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS n FROM e JOIN long l
  ON l.feature = e.feature AND x >= lo AND (x < hi OR (hi = top AND x = top)) WHERE hi IS NOT NULL GROUP BY ALL),
s AS (SELECT feature, r / (sum(r) OVER (PARTITION BY feature) + 1e-6) AS ex, n / (sum(n) OVER (PARTITION BY feature) + 1e-6) AS ac FROM h),
p AS (SELECT feature, sum((ac - ex) * ln((ac + 1e-6) / (ex + 1e-6))) AS psi FROM s GROUP BY 1)
SELECT feature, round(psi, 6) AS psi, CAST(psi > 0.2 AS INTEGER) AS drift, (SELECT max(CAST(psi > 0.2 AS INTEGER)) FROM p) AS overall_drift FROM p
"""


@query("psi_drift", PSI_SQL)
def psi_drift(t):
    ref, new = halves(t)
    return rounded(D.psi_drift(ref, new, ["value", "k"]), 6)


@query(
    "ks_drift",
    f"""
    WITH {_HALVES}, c AS (SELECT feature, x, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS n FROM long GROUP BY ALL),
    f AS (SELECT feature, sum(r) OVER (w ORDER BY x) / sum(r) OVER w AS fr, sum(n) OVER (w ORDER BY x) / sum(n) OVER w AS fn FROM c WINDOW w AS (PARTITION BY feature))
    SELECT feature, round(max(abs(fr - fn)), 6) AS ks FROM f GROUP BY 1
    """,
)
def ks_drift(t):
    ref, new = halves(t)
    return rounded(D.ks_drift(ref, new, ["value", "k"]), 6)
