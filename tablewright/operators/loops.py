"""Process-loop analytics over ``(loop_id, t, pv, sp, op)``; a loop may be of any length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import null_safe_join
from tablewright.operators.ordering import step_window
from tablewright.operators.project import keyword_flag
from tablewright.operators.skew import attach
from tablewright.operators.timeseries import welch_psd
from tablewright.session import pin_small

KEY = ["loop_id"]

# Decision thresholds and scores of the loop rules.
NOISE_LIMIT = 0.5
OSCILLATION_LIMIT = 0.1
STICTION_BASE, STICTION_SQUARE, STICTION_SCALE, STICTION_QUIET, STICTION_CAP = 60.0, 20.0, 20.0, 5.0, 99.9
SQUARE_KURTOSIS = 2.5
SEGMENT = 256
LAG_BLOCK = 16_384  # steps of a block in the cross-correlation
FEW_BLOCKS = 4  # a loop with more blocks than this is correlated by its spectrum,
SPARSE = 8  # unless it has fewer than one in so many steps
CELL = 1 << 17  # numbers in a band of the spectrum's matrix


def error_column() -> Column:
    return F.col("sp") - F.col("pv")


def loop_error_stats(df: DataFrame) -> DataFrame:
    """mse, mae, population deviation, excess kurtosis and skewness of sp - pv."""
    e = error_column()
    return df.groupBy("loop_id").agg(
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.stddev_pop(e).alias("error_std"),
        F.kurtosis(e).alias("error_kurtosis"),
        F.skewness(e).alias("error_skew"),
        F.stddev_pop("sp").alias("sp_std"),
    )


def loop_noise_ratio(df: DataFrame) -> DataFrame:
    """Deviation of the steps of pv over the deviation of pv."""
    moved = step_window(
        df, KEY, "t", lambda w: {"_step": F.col("pv") - F.lag("pv").over(w)}, before=1
    )
    out = moved.groupBy("loop_id").agg(
        F.stddev_pop("_step").alias("noise_metric"), F.stddev_pop("pv").alias("_pv")
    )
    ratio = F.col("noise_metric") / (F.col("_pv") + 1e-9)
    return out.select(
        "loop_id", "noise_metric", ratio.alias("noise_ratio"), (ratio > NOISE_LIMIT).cast("int").alias("noisy")
    )


def loop_oscillation(df: DataFrame) -> DataFrame:
    """Share of the strongest frequency in the spectrum of the error."""
    e = df.select("loop_id", "t", error_column().alias("e"))
    psd = welch_psd(e, KEY, "t", "e", SEGMENT)
    out = psd.groupBy("loop_id").agg((F.max("power") / (F.sum("power") + 1e-9)).alias("oscillation_strength"))
    return out.withColumn("oscillating", (F.col("oscillation_strength") > OSCILLATION_LIMIT).cast("int"))


def cross_products(df: DataFrame, t: str, x: str, y: str, block: int = LAG_BLOCK, cell: int = CELL) -> DataFrame:
    """(loop_id, lag, c): the sum of x(t) * y(t - lag) at every lag at which the loop has steps.

    A loop of a few blocks of steps is cut into them; every block of x meets every block of y.
    That grows with the square of the blocks, so longer loops go through a Fourier transform
    whose rows and columns are dealt to tasks, unless most of their steps are missing.
    """
    xs, ys = F.nanvl(F.col(x).cast("double"), F.lit(None)), F.nanvl(F.col(y).cast("double"), F.lit(None))
    cut = df.select("loop_id", F.col(t).cast("long").alias("t"), F.floor(F.col(t) / block).cast("long").alias("b"), xs.alias("x"), ys.alias("y"))
    at = {"x": F.when(F.col("x").isNotNull(), F.col("t")), "y": F.when(F.col("y").isNotNull(), F.col("t"))}
    ends = cut.groupBy("loop_id").agg(
        F.min("b").alias("_lo"), F.max("b").alias("_hi"), F.count(F.lit(1)).alias("_n"),
        *[f(c).alias(f"_{n}{name}") for n, c in at.items() for f, name in ((F.min, "lo"), (F.max, "hi"))],
    )
    ends = ends.withColumn("_base", F.least("_xlo", "_ylo")).withColumn("_len", F.greatest("_xhi", "_yhi") - F.col("_base") + 1)
    met = F.col("_xlo").isNotNull() & F.col("_ylo").isNotNull()
    long = met & (F.col("_hi") - F.col("_lo") >= FEW_BLOCKS) & (F.col("_len") <= SPARSE * F.col("_n"))
    ends = pin_small(ends.withColumn("_long", F.coalesce(long, F.lit(False))))
    kinds = {r["_long"] for r in ends.select("_long").distinct().collect()}
    rows = attach(cut, ends, KEY)
    if True not in kinds:
        return _by_blocks(rows)
    found = _by_spectrum(rows.filter("_long"), ends, cell)
    return found.unionByName(_by_blocks(rows.filter("not _long"))) if False in kinds else found


def _by_blocks(rows: DataFrame) -> DataFrame:
    """Every block of x meets every block of y in a cell of its own, and the sums of a lag are added
    up over the cells. No task sees more than two blocks."""
    other = F.explode(F.sequence("_lo", "_hi"))
    left = rows.select("loop_id", F.col("b").alias("i"), other.alias("j"), F.lit(0).alias("side"), "t", F.col("x").alias("v"))
    right = rows.select("loop_id", other.alias("i"), F.col("b").alias("j"), F.lit(1).alias("side"), "t", F.col("y").alias("v"))
    kind = rows.schema["loop_id"].dataType.simpleString()

    def correlate(key, cell):
        sides, first = [], []
        for side in (0, 1):
            own = cell[(cell.side == side) & cell.v.notna()]
            low = int(own.t.min()) if len(own) else 0
            dense = np.zeros((int(own.t.max()) - low + 1) if len(own) else 0)
            dense[own.t.to_numpy(np.int64) - low] = own.v.to_numpy()
            sides.append(dense)
            first.append(low)
        n, m = map(len, sides)
        if not n or not m:
            return pd.DataFrame({"loop_id": [], "lag": [], "c": []})
        size = 1 << (n + m - 1).bit_length()
        sums = np.fft.irfft(np.fft.rfft(sides[0], size) * np.fft.rfft(sides[1][::-1], size), size)[: n + m - 1]
        return pd.DataFrame({"loop_id": key[0], "lag": np.arange(n + m - 1) - (m - 1) + first[0] - first[1], "c": sums})

    cells = left.unionByName(right).groupBy("loop_id", "i", "j").applyInPandas(correlate, f"loop_id {kind}, lag long, c double")
    return cells.groupBy("loop_id", "lag").agg(F.sum("c").alias("c"))


def _by_spectrum(rows: DataFrame, ends: DataFrame, cell: int) -> DataFrame:
    """The same as a circular correlation of 2**p steps, enough that nothing wraps around.

    Step n is entry (n div n2, n mod n2) of a matrix of n1 by n2: transforms down its columns, a twist,
    transforms along its rows give the spectra; their product comes back the same way. A task
    has a band of columns or rows, about ``cell`` entries, and bands trade tiles, so the rows
    shuffled are in proportion to the steps, whatever a loop's length.
    """
    kind = rows.schema["loop_id"].dataType.simpleString()

    def shape(p: int) -> tuple[int, int, int, int]:
        """Rows and columns, columns in a band and rows in a band."""
        n1, n2 = 1 << (p + 1) // 2, 1 << p // 2
        return n1, n2, max(1, min(n2, cell // n1)), max(1, min(n1, cell // n2))

    def twist(rows: np.ndarray, columns: np.ndarray, p: int) -> np.ndarray:
        return np.exp(2j * np.pi / (1 << p) * (rows[:, None] * columns[None, :] % (1 << p)))

    def down(key, steps):
        loop, band, p = key
        n1, n2, wide, high = shape(p)
        z = np.zeros((2, n1, wide))
        at = steps.n.to_numpy(np.int64)
        for side, name in enumerate("xy"):
            v = steps[name].to_numpy(float)
            own = ~np.isnan(v)
            z[side, at[own] // n2, at[own] % n2 - band * wide] = v[own]
        z = np.fft.fft(z, axis=1) * twist(np.arange(n1), band * wide + np.arange(wide), p).conj()
        tiles = [z[:, r : r + high].tobytes() for r in range(0, n1, high)]
        return pd.DataFrame({"loop_id": loop, "p": p, "col": band, "row": np.arange(len(tiles)), "tile": tiles})

    def along(key, tiles):
        loop, band, p = key
        n1, n2, wide, high = shape(p)
        z = np.zeros((2, high, n2), complex)
        for col, tile in zip(tiles["col"], tiles["tile"]):
            z[:, :, col * wide : (col + 1) * wide] = np.frombuffer(tile, complex).reshape(2, high, wide)
        z = np.fft.fft(z, axis=2)
        c = np.fft.ifft(z[0] * z[1].conj(), axis=1) * twist(band * high + np.arange(high), np.arange(n2), p)
        tiles = [c[:, s : s + wide].tobytes() for s in range(0, n2, wide)]
        return pd.DataFrame({"loop_id": loop, "p": p, "col": np.arange(len(tiles)), "row": band, "tile": tiles})

    def up(key, tiles):
        loop, band, p = key
        n1, n2, wide, high = shape(p)
        c = np.zeros((n1, wide), complex)
        for row, tile in zip(tiles["row"], tiles["tile"]):
            c[row * high : (row + 1) * high] = np.frombuffer(tile, complex).reshape(high, wide)
        lag = np.arange(n1)[:, None] * n2 + band * wide + np.arange(wide)[None, :]
        lag = np.where(lag < 1 << (p - 1), lag, lag - (1 << p)).ravel()
        return pd.DataFrame({"loop_id": loop, "lag": lag, "c": np.fft.ifft(c, axis=0).real.ravel()})

    # 2**p is at least twice the steps, so lags fit on both sides of zero.
    p = F.greatest(F.length(F.bin(F.col("_len") * 2 - 1)), F.lit(2))
    steps = rows.filter("t is not null and (x is not null or y is not null)").select(
        "loop_id", p.alias("p"), (F.col("t") - F.col("_base")).alias("n"), "x", "y"
    )
    columns = F.expr("shiftleft(1L, CAST(p div 2 AS INT))")
    wide = F.expr(f"greatest(1, least(shiftleft(1L, CAST(p div 2 AS INT)), {cell} div shiftleft(1L, CAST((p + 1) div 2 AS INT))))")
    steps = steps.withColumn("col", F.floor(F.pmod("n", columns) / wide).cast("long"))
    tile = f"loop_id {kind}, p int, col long, row long, tile binary"
    tiles = steps.groupBy("loop_id", "col", "p").applyInPandas(down, tile)
    tiles = tiles.groupBy("loop_id", "row", "p").applyInPandas(along, tile)
    sums = tiles.groupBy("loop_id", "col", "p").applyInPandas(up, f"loop_id {kind}, lag long, c double")
    return attach(sums, ends.filter("_long").select("loop_id", "_xlo", "_xhi", "_ylo", "_yhi"), KEY).filter("lag between _xlo - _yhi and _xhi - _ylo").select("loop_id", "lag", "c")


def loop_pv_op_lag(df: DataFrame) -> DataFrame:
    """Distance from zero of the lag at which standardised pv and op agree most.

    All lags at which the two overlap; sums are compared at six decimals, and ties go to the most negative.
    """
    stats = df.groupBy("loop_id").agg(
        F.avg("pv").alias("_mp"), F.stddev_pop("pv").alias("_dp"),
        F.avg("op").alias("_mo"), F.stddev_pop("op").alias("_do"),
    )
    std = attach(df, stats, KEY).select(
        "loop_id", "t",
        ((F.col("pv") - F.col("_mp")) / (F.col("_dp") + 1e-9)).alias("_p"),
        ((F.col("op") - F.col("_mo")) / (F.col("_do") + 1e-9)).alias("_o"),
    )
    best = F.max(F.struct(F.round("c", 6).alias("c"), (-F.col("lag")).alias("x")))
    found = cross_products(std, "t", "_p", "_o").groupBy("loop_id").agg(best.alias("best"))
    return found.select("loop_id", F.abs("best.x").cast("int").alias("pv_op_lag"), F.col("best.c").alias("peak"))


def stiction_score(oscillating: Column, strength: Column, kurtosis: Column) -> Column:
    hit = (
        F.lit(STICTION_BASE)
        + F.when(kurtosis < SQUARE_KURTOSIS, STICTION_SQUARE).otherwise(0.0)
        + strength * STICTION_SCALE
    )
    return F.least(F.when(oscillating == 1, hit).otherwise(STICTION_QUIET), F.lit(STICTION_CAP))


def loop_summary(df: DataFrame) -> DataFrame:
    """Error, noise and oscillation features side by side, one row per loop."""
    return null_safe_join(null_safe_join(loop_error_stats(df), loop_noise_ratio(df), KEY), loop_oscillation(df), KEY)


def loop_stiction(df: DataFrame) -> DataFrame:
    s = null_safe_join(loop_error_stats(df), loop_oscillation(df), KEY)
    return s.select(
        "loop_id",
        stiction_score(F.col("oscillating"), F.col("oscillation_strength"), F.col("error_kurtosis")).alias("stiction"),
    )


def loop_behaviours(df: DataFrame) -> DataFrame:
    """(loop_id, behaviours): the inferences that hold for each loop, in fixed words."""
    s = loop_summary(df)
    stiction = stiction_score(F.col("oscillating"), F.col("oscillation_strength"), F.col("error_kurtosis"))
    disturbed = (F.col("mse") > 1.0) & (F.col("oscillating") == 0) & (F.col("sp_std") < 0.1)
    found = F.array_compact(
        F.array(
            F.when(F.col("noisy") == 1, "Noisy Sensor Signal"),
            F.when(F.col("oscillating") == 1, "Significant Oscillation"),
            F.when(disturbed, "External Disturbance"),
            F.when(stiction > 50, "High Valve Stiction Risk"),
        )
    )
    calm = (F.size(found) == 0) & (F.col("mse") < 1.0)
    return s.select(
        "loop_id", F.when(calm, F.array(F.lit("Stable / Well-Tuned"))).otherwise(found).alias("behaviours")
    )


def loop_feature_table(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Nine features per loop beside its cleaned labels.

    ``labels`` has loop_id and free-text columns oscillatory, noisy, disturbance.
    """
    clean = labels.select(
        "loop_id", *[keyword_flag(c).alias(f"is_{c}") for c in ("oscillatory", "noisy", "disturbance")]
    )
    features = null_safe_join(
        loop_summary(df).drop("noisy", "oscillating", "sp_std"), loop_pv_op_lag(df).drop("peak"), KEY
    )
    return null_safe_join(features, clean, KEY, "left")


def _trapezoid(df: DataFrame, dt: float, columns: dict[str, Column]) -> DataFrame:
    """Area of each column between a step and the one before it."""
    return step_window(
        df, KEY, "t", lambda w: {n: (c + F.lag(c).over(w)) / 2 * dt for n, c in columns.items()}, before=1
    )


def loop_control_metrics(df: DataFrame, dt: float = 1.0) -> DataFrame:
    """IAE, ISE, service level, stock-out volume and share, spread of pv and op."""
    e = error_column()
    areas = _trapezoid(df, dt, {"_iae": F.abs(e), "_ise": e * e})
    short = F.greatest(-F.col("pv"), F.lit(0.0))
    return areas.groupBy("loop_id").agg(
        F.avg((F.col("pv") >= 0).cast("double")).alias("service_level"),
        (F.sum(short) * dt).alias("stockout_volume"),
        F.avg((F.col("pv") < 0).cast("double")).alias("stockout_fraction"),
        F.sum("_iae").alias("iae"),
        F.sum("_ise").alias("ise"),
        F.avg("pv").alias("pv_mean"),
        F.stddev_pop("pv").alias("pv_std"),
        F.stddev_pop("op").alias("op_std"),
    )


def loop_itae(df: DataFrame, dt: float = 1.0) -> DataFrame:
    """Integral of time times absolute error."""
    weighted = F.col("t") * dt * F.abs(error_column())
    return _trapezoid(df, dt, {"_a": weighted}).groupBy("loop_id").agg(F.sum("_a").alias("itae"))
