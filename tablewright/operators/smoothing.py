"""Exponential smoothing of series of any length.

For fixed constants a step of additive level/trend/season smoothing is an affine map of the state, so
a block of steps is one too. Long series are cut into blocks; each becomes its map (for all
constants of the grid at once), maps are composed ``FAN`` at a time up a tree, and the states at which
blocks begin come back down it. Then every block runs from its own state and the squared
errors are added up. No task holds more than a block, or the maps of one node of the tree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import dense_index
from tablewright.operators.skew import attach
from tablewright.session import pin, pin_small

BLOCK = 16_384  # steps
FAN = 8
MAP_CELLS = 1 << 20  # numbers in the maps of a block that one task makes
WIDE = ("alpha", "beta", "gamma")


def constants(grid: Sequence[float], seasonal: bool) -> np.ndarray:
    """(alpha, beta, gamma) of every combination."""
    return np.array([(a, b, g) for a in grid for b in grid for g in (grid if seasonal else [0.0])], float)


def first_state(y: np.ndarray, period: int) -> np.ndarray:
    """level, trend, season from the first two periods (no season: from two steps)."""
    if period > 1:
        first, second = y[:period].mean(), y[period : 2 * period].mean()
        return np.r_[first, (second - first) / period, y[:period] - first]
    return np.r_[y[0], y[1] - y[0] if len(y) > 1 else 0.0]


def advance(state: np.ndarray, y: np.ndarray, at: int, consts: np.ndarray, input_column: bool = False):
    """Run steps ``at, at + 1, ...`` with values ``y``; changes ``state`` and gives the squared errors' sum.

    Constants under which the recursion grows without bound end with an infinite sum. ``state``: (constants, 2 + season, columns). Each column is a state of its own; with
    ``input_column`` only the last one feels the values, so unit vectors become the columns of the map.
    """
    a, b, g = (consts[:, i, None] for i in range(3))
    m = state.shape[1] - 2
    feels = np.zeros(state.shape[2])
    feels[-1 if input_column else slice(None)] = 1.0
    sse = np.zeros((state.shape[0], state.shape[2]))
    level, trend = state[:, 0].copy(), state[:, 1].copy()
    with np.errstate(over="ignore", invalid="ignore"):
        for i, v in enumerate(y.tolist()):
            own = v * feels
            ahead = level + trend
            if m:
                k = 2 + (at + i) % m
                s = state[:, k].copy()
            else:
                s = 0.0
            error = own - ahead - s
            sse += error * error
            new = a * (own - s) + (1 - a) * ahead
            trend = b * (new - level) + (1 - b) * trend
            level = new
            if m:
                state[:, k] = g * (own - level) + (1 - g) * s
    state[:, 0], state[:, 1] = level, trend
    return np.where(np.isnan(sse), np.inf, sse)


def block_map(y: np.ndarray, at: int, consts: np.ndarray, size: int) -> np.ndarray:
    """The map of a block: (constants, size, size + 1), the last column being the constant part."""
    state = np.zeros((len(consts), size, size + 1))
    state[:, np.arange(size), np.arange(size)] = 1.0
    advance(state, y, at, consts, input_column=True)
    return state


def after(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The map of ``first`` and then ``then``."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = then[:, :, :-1] @ first
        out[:, :, -1] += then[:, :, -1]
    return out


def ahead(state: np.ndarray, n: int, h: int) -> list[float]:
    """Forecasts of the h steps after n, from the state after n steps."""
    m = len(state) - 2
    return [float(state[0] + (j + 1) * state[1] + (state[2 + (n + j) % m] if m else 0.0)) for j in range(h)]


def _short(rows: DataFrame, period: int, h: int, grid: Sequence[float], schema: T.StructType) -> DataFrame:
    """Series of at most a block: smoothed whole."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        y = pdf["_y"].to_numpy(float)
        m = period if period > 1 and len(y) >= 2 * period else 0
        consts = constants(grid, m > 0)
        state = np.repeat(first_state(y, m)[None, :, None], len(consts), axis=0)
        sse = advance(state, y[m or 1 :], m or 1, consts)[:, 0]
        best = int(np.argmin(sse))
        return pd.DataFrame([[pdf["_sid"].iloc[0], *consts[best], sse[best], ahead(state[best, :, 0], len(y), h)]], columns=schema.names)

    return rows.select("_sid", "_i", "_y").groupBy("_sid").applyInPandas(run, schema)


def _long(rows: DataFrame, period: int, h: int, grid: Sequence[float], block: int, schema: T.StructType) -> DataFrame:
    """Series of several blocks, by maps up a tree and states down again."""
    m = period if period > 1 else 0
    size = 2 + m
    consts = constants(grid, m > 0)
    per = max(1, MAP_CELLS // (size * (size + 1)))  # constants in one task
    parts = [consts[i : i + per] for i in range(0, len(consts), per)]
    start = m or 1
    key = ["_sid", "_part", "_block"]
    spread = F.explode(F.sequence(F.lit(0), F.lit(len(parts) - 1)))
    blocks = rows.select("_sid", "_i", "_y", F.floor(F.col("_i") / block).cast("long").alias("_block")).withColumn("_part", spread)
    map_schema = "_sid string, _part int, _block long, map array<double>"

    def packed(pdf: pd.DataFrame, number: int, value: np.ndarray, name: str) -> pd.DataFrame:
        return pd.DataFrame({"_sid": [pdf["_sid"].iloc[0]], "_part": [int(pdf["_part"].iloc[0])], "_block": [number], name: [value.ravel()]})

    def steps(pdf: pd.DataFrame) -> tuple[np.ndarray, int]:
        pdf = pdf.sort_values("_i")
        pdf = pdf[pdf["_i"] >= start]
        return pdf["_y"].to_numpy(float), int(pdf["_i"].iloc[0])

    def leaf(pdf: pd.DataFrame) -> pd.DataFrame:
        y, at = steps(pdf)
        return packed(pdf, int(pdf["_block"].iloc[0]), block_map(y, at, parts[int(pdf["_part"].iloc[0])], size), "map")

    def shaped(values) -> np.ndarray:
        return np.asarray(values, float).reshape(-1, size, size + 1)

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for values in pdf.sort_values("_block")["map"]:
            own = shaped(values)
            whole = own if whole is None else after(whole, own)
        return packed(pdf, int(pdf["_block"].iloc[0]) // FAN, whole, "map")

    levels = [pin(blocks.groupBy(*key).applyInPandas(leaf, map_schema))]
    while levels[-1].filter("_block > 0").head(1):
        up = levels[-1].withColumn("_up", F.floor(F.col("_block") / FAN).cast("long"))
        levels.append(pin(up.groupBy("_sid", "_part", "_up").applyInPandas(lambda pdf: joined(pdf.drop(columns="_up")), map_schema)))

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        state = first_state(pdf.sort_values("_i")["_y"].to_numpy(float), m)
        return pd.DataFrame({"_sid": [pdf["_sid"].iloc[0]], "first": [state]})

    first = rows.filter(F.col("_i") < 2 * start).select("_sid", "_i", "_y").groupBy("_sid").applyInPandas(begin, "_sid string, first array<double>")
    counts = F.element_at(F.array(*[F.lit(len(p)) for p in parts]), F.col("_part") + 1)
    states = pin(
        levels[-1].join(first, "_sid").select(*key, F.flatten(F.array_repeat("first", counts)).alias("state"))
    )
    state_schema = "_sid string, _part int, _block long, state array<double>"

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        state = np.asarray(pdf["state"].iloc[0], float).reshape(-1, size, 1)
        out = []
        for number, values in zip(pdf["_block"], pdf["map"]):
            out.append(state.ravel())
            own = shaped(values)
            with np.errstate(over="ignore", invalid="ignore"):
                state = own[:, :, :-1] @ state + own[:, :, -1:]
        return pd.DataFrame({"_sid": pdf["_sid"], "_part": pdf["_part"], "_block": pdf["_block"], "state": out})

    for maps in reversed(levels[:-1]):
        above = states.withColumnRenamed("_block", "_up")
        children = maps.withColumn("_up", F.floor(F.col("_block") / FAN).cast("long")).join(above, ["_sid", "_part", "_up"])
        found = children.groupBy("_sid", "_part", "_up").applyInPandas(lambda pdf: down(pdf.drop(columns="_up")), state_schema)
        states = pin(found)

    def finish(key_, own: pd.DataFrame, begun: pd.DataFrame) -> pd.DataFrame:
        part = int(key_[1])
        state = np.array(begun["state"].iloc[0], float).reshape(-1, size, 1)
        y, at = steps(own)
        sse = advance(state, y, at, parts[part])[:, 0]
        number = part * per + np.arange(len(sse))
        return pd.DataFrame({"_sid": key_[0], "_block": key_[2], "_n": at + len(y), "combo": number, "sse": sse, "state": list(state[:, :, 0])})

    done = blocks.groupBy(*key).cogroup(states.groupBy(*key)).applyInPandas(
        finish, "_sid string, _block long, _n long, combo int, sse double, state array<double>"
    )
    # Only the state after the last block goes on.
    errors = pin(done).groupBy("_sid", "combo").agg(F.sum("sse").alias("sse"), F.max_by(F.struct(F.col("_n").alias("n"), "state"), "_block").alias("end"))
    best = errors.groupBy("_sid").agg(F.min_by(F.struct("combo", "sse", "end"), F.struct("sse", "combo")).alias("b")).select("_sid", "b.*")

    def forecast(batches):
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                out.append([r[0], *consts[r.combo], r.sse, ahead(np.asarray(r.end["state"], float), int(r.end["n"]), h)])
            yield pd.DataFrame(out, columns=schema.names)

    return best.mapInPandas(forecast, schema)


def holt_winters(
    df: DataFrame, keys: Sequence[str], t: str, value: str, period: int, h: int,
    grid: Sequence[float] = (0.1, 0.3, 0.5, 0.7, 0.9), block: int = BLOCK,
) -> DataFrame:
    """(keys, t, forecast, alpha, beta, gamma, sse): additive smoothing by the constants of least squared one-step error.

    Of equal errors the first combination counts. The first period gives level and season, the second the trend; series
    under two periods have no season. Steps are taken in order of ``t`` whatever its gaps; rows
    without a value are left out. Null keys are a series; no rows give no rows.
    """
    block = max(block, 2 * period)
    block = -(-block // max(period, 1)) * max(period, 1)
    plain = df.select(*keys, F.col(t).alias("_t"), F.col(value).cast("double").alias("_y")).dropna(subset=["_t", "_y"])
    placed = dense_index(plain, keys, ["_t"], "_i")
    sid = F.to_json(F.struct(*keys)) if keys else F.lit("{}")
    rows = pin(placed.withColumn("_sid", sid))
    ends = pin_small(rows.groupBy("_sid", *keys).agg(F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_n")))
    schema = T._parse_datatype_string("_sid string, alpha double, beta double, gamma double, sse double, ahead array<double>")
    is_long = F.col("_n") > block
    if ends.filter(is_long).isEmpty():
        found = _short(rows, period, h, grid, schema)
    else:
        sized = attach(rows.select("_sid", "_i", "_y"), ends.select("_sid", "_n"), ["_sid"])
        found = _short(sized.filter(~is_long), period, h, grid, schema).unionByName(
            _long(pin(sized.filter(is_long).drop("_n")), period, h, grid, block, schema)
        )
    wide = ends.join(found, "_sid").select(*keys, "_last", *WIDE, "sse", F.posexplode("ahead").alias("_j", "forecast"))
    return wide.select(*keys, (F.col("_last") + F.col("_j") + 1).cast("long").alias(t), "forecast", *WIDE, "sse")
