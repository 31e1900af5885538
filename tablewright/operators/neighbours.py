"""Exact k nearest neighbours between two tables, without pairing all rows.

Reference rows are put into cells around a few pivot rows and each cell is cut,
in order of distance to its pivot, into chunks of at most ``CHUNK_ROWS`` rows (or twice
the rows asked for, if that is more), whatever the size of the table; the chunks' bounds are a
table. A query first meets the chunk at its own place, which gives it a true k-th distance; the
triangle inequality gives a lower bound per cell and chunk, and then it meets only the other
chunks that can hold a nearer row. In many dimensions bounds say little and most chunks remain.
In up to ``BOX_DIMENSIONS`` dimensions cells are boxes of a k-d tree drawn from a sample, about
``BOX_ROWS`` rows each, so that a query meets a few boxes however many rows there are.
Within a chunk numpy computes the distances and hands on k rows per query.
Copies of one vector are reduced to the k smallest ids beforehand, which is
exact because ties go to the smallest id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import dense_index
from tablewright.session import pin, pin_small, small_table

MAX_PIVOTS = 256
CHUNK_ROWS = 4_096
QUERY_BATCH = 4_096
BOX_DIMENSIONS = 8
BOX_ROWS = 1_024  # reference rows in a box, about
MAX_DEPTH = 16  # of the tree; with more than 2 ** 16 times BOX_ROWS rows boxes hold more
SAMPLED = 4  # rows a box that the cuts are drawn from
DECIMALS = 12  # distances equal to this many decimals are ties, whatever the order of summation


def distances(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """len(x) by len(y) distances, summed dimension by dimension."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j][:, None] - y[:, j][None, :]
        out += np.abs(d) if metric == "manhattan" else d * d
    return out if metric == "manhattan" else np.sqrt(out)


def _stack(v) -> np.ndarray:
    return np.vstack(v.to_numpy()).astype(float)


def _top(x, y, ids, k, metric):
    """Positions (row, column, distance) of the k nearest of each row; ``ids`` break ties."""
    if metric == "manhattan" or x.shape[1] <= 8:
        d = distances(x, y, metric)
        kth = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
        r, c = np.nonzero(d <= kth[:, None] + 1e-12 * (1 + kth[:, None]))
        dist = d[r, c]
    else:
        # A matrix product finds candidates with a margin for its rounding; these
        # few are measured again without cancellation.
        nx, ny = (x * x).sum(axis=1), (y * y).sum(axis=1)
        d2 = nx[:, None] + ny[None, :] - 2.0 * (x @ y.T)
        kth = np.partition(d2, min(k, d2.shape[1]) - 1, axis=1)[:, min(k, d2.shape[1]) - 1]
        slack = 1e-9 * (nx[:, None] + ny.max() + 1.0)
        r, c = np.nonzero(d2 <= kth[:, None] + slack)
        dist = np.sqrt(((x[r] - y[c]) ** 2).sum(axis=1))
    dist = np.round(dist, DECIMALS)
    order = np.lexsort((ids[c], dist, r))
    r, c, dist = r[order], c[order], dist[order]
    first = np.searchsorted(r, r, side="left")
    keep = np.arange(len(r)) - first < k
    return r[keep], c[keep], dist[keep]


class Boxes:
    """A complete k-d tree: node i has the children 2 i + 1 and 2 i + 2, the last level are the boxes."""

    def __init__(self, sample: np.ndarray, depth: int, metric: str):
        self.depth, self.metric = depth, metric
        self.inner = 2**depth - 1  # nodes that are cut; box b is node inner + b
        self.dim, self.cut = np.zeros(self.inner, np.int64), np.full(self.inner, np.inf)
        rows = {0: sample}
        for i in range(self.inner):
            x = rows.pop(i)
            if len(x):
                j = int((x.max(axis=0) - x.min(axis=0)).argmax())
                at = np.sort(x[:, j])
                # Rows on the cut go left; if the greatest value is that common, the next lesser one is cut at.
                cut = min(at[(len(x) - 1) // 2], at[max(np.searchsorted(at, at[-1]) - 1, 0)])
                self.dim[i], self.cut[i] = j, cut
            right = x[:, self.dim[i]] > self.cut[i]
            rows[2 * i + 1], rows[2 * i + 2] = x[~right], x[right]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The box of each row."""
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[np.arange(len(x)), self.dim[at]] > self.cut[at])
        return at - self.inner

    def bound(self, box: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Set rows and bounds of all nodes from those of the boxes that have rows."""
        self.size = np.zeros(2 * self.inner + 1, np.int64)
        self.lo, self.hi = np.full((len(self.size), lo.shape[1]), np.inf), np.full((len(self.size), lo.shape[1]), -np.inf)
        at = self.inner + box
        self.size[at], self.lo[at], self.hi[at] = size, lo, hi
        for d in reversed(range(self.depth)):
            up = np.arange(2**d - 1, 2 ** (d + 1) - 1)
            a, b = 2 * up + 1, 2 * up + 2
            self.size[up] = self.size[a] + self.size[b]
            self.lo[up], self.hi[up] = np.minimum(self.lo[a], self.lo[b]), np.maximum(self.hi[a], self.hi[b])

    def home(self, x: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the least node around it that has ``need`` rows, and that node's height."""
        at, height = np.zeros(len(x), np.int64), np.full(len(x), self.depth)
        for d in range(self.depth):
            child = 2 * at + 1 + (x[np.arange(len(x)), self.dim[np.minimum(at, self.inner - 1)]] > self.cut[np.minimum(at, self.inner - 1)])
            down = (height == self.depth - d) & (self.size[np.minimum(child, len(self.size) - 1)] >= need)
            at, height = np.where(down, child, at), np.where(down, height - 1, height)
        return at, height

    def near(self, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of all boxes that can hold a row within ``limit``."""
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            row, node = np.repeat(row, 2), np.column_stack([2 * node + 1, 2 * node + 2]).ravel()
            gap = np.maximum(np.maximum(self.lo[node] - x[row], x[row] - self.hi[node]), 0.0)
            least = gap.sum(axis=1) if self.metric == "manhattan" else np.sqrt((gap * gap).sum(axis=1))
            keep = (self.size[node] > 0) & (least <= limit[row])
            row, node = row[keep], node[keep]
        return row, node - self.inner

    def below(self, node: np.ndarray, height: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of the boxes with rows under each row's node."""
        first = (node + 1) * 2**height - 1 - self.inner
        row = np.repeat(np.arange(len(node)), 2**height)
        box = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(2**height) - 2**height, 2**height)
        keep = self.size[self.inner + box] > 0
        return row[keep], box[keep]


def _lists(rows: int, row: np.ndarray, values: np.ndarray) -> list:
    """The values of each row as arrays."""
    order = np.argsort(row, kind="stable")
    return np.split(values[order], np.searchsorted(row[order], np.arange(1, rows)))


def _boxed(refs: DataFrame, n: int, dims: int, need: int, metric: str):
    """Reference rows with their ``chunk``, and functions from vectors (and distances of the k-th row met)
    to the chunks that a query meets first, and then.

    The tree and the boxes' bounds travel inside the functions; a box has some 16 bytes a dimension.
    """
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(n / BOX_ROWS))))
    drawn = refs.orderBy(F.xxhash64("_rid"), "_rid").limit(SAMPLED << depth).select("_rvec") if depth else refs.limit(0).select("_rvec")
    sample = drawn.toPandas()["_rvec"]
    tree = Boxes(_stack(sample) if len(sample) else np.zeros((0, dims)), depth, metric)

    @F.pandas_udf("long")
    def place(v: pd.Series) -> pd.Series:
        return pd.Series(tree.place(_stack(v)) if len(v) else [], dtype="int64")

    placed = pin(refs.withColumn("box", place("_rvec")))
    ends = [f(F.get("_rvec", F.lit(j))).alias(f"{w}{j}") for w, f in (("lo", F.min), ("hi", F.max)) for j in range(dims)]
    stats = placed.groupBy("box").agg(F.count(F.lit(1)).alias("_n"), *ends).toPandas()  # one row a box
    size = stats["_n"].to_numpy()
    lo, hi = (stats[[f"{w}{j}" for j in range(dims)]].to_numpy(float) for w in ("lo", "hi"))
    tree.bound(stats["box"].to_numpy(), size, lo, hi)
    # A box the sample did not see well is dealt to chunks by a hash of the ids.
    pieces = -(-tree.size[tree.inner :] // max(4 * BOX_ROWS, 2 * need))
    many = np.flatnonzero(pieces > 1)
    deal = F.lit(1)
    if len(many):
        cuts = refs.sparkSession.createDataFrame(pd.DataFrame({"box": many, "_pieces": pieces[many]}))
        placed = placed.join(F.broadcast(cuts), "box", "left")
        deal = F.coalesce("_pieces", F.lit(1))
    placed = placed.select("_rid", "_rvec", (F.col("box") * (1 << 32) + F.pmod(F.xxhash64("_rid", "_rvec"), deal)).alias("chunk"))

    def chunks(rows: int, row: np.ndarray, box: np.ndarray) -> list:
        times = pieces[box]
        first = np.cumsum(times) - times
        at = np.repeat(np.arange(len(box)), times)
        return _lists(rows, row[at], (box[at] << 32) + np.arange(len(at)) - first[at])

    @F.pandas_udf("array<long>")
    def first(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(chunks(len(v), *tree.below(*tree.home(_stack(v), need))), index=v.index, dtype=object)

    @F.pandas_udf("array<long>")
    def then(v: pd.Series, kth: pd.Series) -> pd.Series:
        out, limit = [], kth.fillna(np.inf).to_numpy(float) * (1 + 1e-9) + 1e-12
        step = max(64, min(4_096, 8_000_000 >> depth)) if len(v) else 1
        for s in range(0, len(v), step):
            x = _stack(v.iloc[s : s + step])
            row, box = tree.near(x, limit[s : s + step])
            node, height = tree.home(x, need)
            new = (box + tree.inner + 1) >> height[row] != node[row] + 1  # not under the node met first
            out.extend(chunks(len(x), row[new], box[new]))
        return pd.Series(out, index=v.index, dtype=object)

    return placed, first, then


def _in_boxes(queries: DataFrame, refs: DataFrame, dims: int, need: int, metric: str) -> DataFrame:
    """(_qid, _rid, dist): ``need`` nearest rows or more of every query, in boxes. Vectors with a missing number are near nothing."""
    whole = lambda c: F.col(c).isNotNull() & ~F.exists(c, lambda v: v.isNull() | F.isnan(v))
    refs, queries = refs.filter(whole("_rvec")), queries.filter(whole("_qvec"))
    n = refs.count()
    if n == 0:
        return small_table(queries.sparkSession, [], "_qid long, _rid long, dist double")
    placed, first_chunks, more_chunks = _boxed(refs, n, dims, need, metric)
    queries = pin(queries)
    first = pin(_meet(pin(queries.select("_qid", "_qvec", F.explode(first_chunks("_qvec")).alias("chunk"))), placed, need, metric))
    asked = queries.join(_kth(first, need), "_qid", "left").select("_qid", "_qvec", F.explode(more_chunks("_qvec", "_kth")).alias("chunk"))
    return first.unionByName(_meet(pin(asked), placed, need, metric))


def _meet(asked: DataFrame, placed: DataFrame, need: int, metric: str) -> DataFrame:
    """(_qid, _rid, dist): of every query (``asked``: _qid, _qvec, chunk) the nearest rows of each chunk it asks."""
    schema = T.StructType(
        [
            T.StructField("_qid", T.LongType()),
            T.StructField("_rid", T.LongType()),
            T.StructField("dist", T.DoubleType()),
        ]
    )

    def measure(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(r) == 0:
            return pd.DataFrame({"_qid": [], "_rid": [], "dist": []})
        y, ids = _stack(r["_rvec"]), r["_rid"].to_numpy()
        qids, parts = q["_qid"].to_numpy(), []
        step = max(1, 250_000 // len(y))  # distances that stay in the processor's cache
        for s in range(0, len(q), step):
            x = _stack(q["_qvec"].iloc[s : s + step])
            i, j, dist = _top(x, y, ids, need, metric)
            parts.append(pd.DataFrame({"_qid": qids[s : s + step][i], "_rid": ids[j], "dist": dist}))
        return pd.concat(parts, ignore_index=True)

    # A chunk that many queries need is dealt to several tasks, each with a part of the queries.
    load = pin_small(asked.groupBy("chunk").agg(F.ceil(F.count(F.lit(1)) / QUERY_BATCH).cast("int").alias("_parts")))
    dealt = asked.join(load, "chunk").withColumn("salt", F.pmod(F.xxhash64("_qid"), F.col("_parts")).cast("int"))
    held = placed.join(load, "chunk").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return (
        dealt.select("_qid", "_qvec", "chunk", "salt")
        .groupBy("chunk", "salt")
        .cogroup(held.select("_rid", "_rvec", "chunk", "salt").groupBy("chunk", "salt"))
        .applyInPandas(measure, schema)
    )


def _kth(found: DataFrame, need: int) -> DataFrame:
    """(_qid, _kth): true distance of the k-th row met so far; of fewer rows than needed, none."""
    order = Window.partitionBy("_qid").orderBy("dist", "_rid")
    return found.withColumn("_pos", F.row_number().over(order)).filter(F.col("_pos") == need).select("_qid", F.col("dist").alias("_kth"))


def knn(
    queries: DataFrame,
    refs: DataFrame,
    qid: str,
    rid: str,
    vec: str,
    k: int,
    metric: str = "euclidean",
    exclude_self: bool = False,
) -> DataFrame:
    """(qid, rid, dist, pos): the k nearest reference rows of every query row.

    Ties go to the smaller reference id. ``exclude_self`` leaves out the reference
    whose id equals the query's (self-join).
    """
    need = k + 1 if exclude_self else k
    doubles = F.transform(vec, lambda v: v.cast("double"))
    refs = refs.select(F.col(rid).cast("long").alias("_rid"), doubles.alias("_rvec"))
    queries = queries.select(F.col(qid).cast("long").alias("_qid"), doubles.alias("_qvec"))

    copies = Window.partitionBy("_rvec").orderBy("_rid")
    refs = (
        refs.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= need).drop("_copy")
    )
    refs = pin(refs)
    shape = refs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_rvec")).alias("dims")).first()
    n = shape["n"]
    if n == 0:
        found = small_table(queries.sparkSession, [], "_qid long, _rid long, dist double")
        return _ranked(found, qid, rid, k)
    if 0 < shape["dims"] <= BOX_DIMENSIONS:
        found = _in_boxes(queries, refs, shape["dims"], need, metric)
        if exclude_self:
            found = found.filter(F.col("_qid") != F.col("_rid"))
        return _ranked(found, qid, rid, k)

    m = max(1, min(MAX_PIVOTS, math.ceil(math.sqrt(n) / 4)))
    pivots = np.array(
        [r["_rvec"] for r in refs.orderBy(F.xxhash64("_rid"), "_rid").limit(m).collect()], dtype=float
    )
    @F.pandas_udf("cell int, reach double")
    def place(v: pd.Series) -> pd.DataFrame:
        if len(v) == 0:
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "reach": pd.Series(dtype=float)})
        d = distances(_stack(v), pivots, metric)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": d[np.arange(len(d)), cell]})

    placed = refs.withColumn("_p", place("_rvec")).select("_rid", "_rvec", "_p.cell", "_p.reach")
    # Pinned: the bounds and the rows are read by separate jobs.
    placed = pin(dense_index(placed, ["cell"], ["reach", "_rid"], "_i"))
    cells = pin_small(
        placed.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"), F.min("reach").alias("lo"), F.max("reach").alias("hi"))
    )
    stats = cells.toPandas().sort_values("cell")  # at most MAX_PIVOTS rows
    cell, size, lo, hi = (stats[c].to_numpy() for c in ("cell", "_n", "lo", "hi"))
    # Cells are cut evenly: a chunk has half of CHUNK_ROWS at least, or is a whole cell.
    cut = f"CAST(cell AS BIGINT) * {1 << 32} + (_i * CAST(ceil(_n / {max(CHUNK_ROWS, 2 * need)}) AS BIGINT)) div _n"
    placed = placed.join(F.broadcast(cells.select("cell", "_n")), "cell").withColumn("chunk", F.expr(cut))
    chunks = pin(placed.groupBy("cell", "chunk").agg(F.min("reach").alias("_lo"), F.max("reach").alias("_hi")))

    def bounds(v: pd.Series):
        """Per query and cell the least possible distance and that to the pivot, in steps of bounded size."""
        step = max(1, 2_000_000 // max(len(cell), 1))
        for s in range(0, len(v), step):
            d = distances(_stack(v.iloc[s : s + step]), pivots, metric)[:, cell]
            yield slice(s, s + step), np.maximum(np.maximum(d - hi, lo - d), 0.0), d

    def listed(mask: np.ndarray, d: np.ndarray) -> list:
        return [[{"cell": int(c), "d": float(x)} for c, x in zip(cell[m], row[m])] for m, row in zip(mask, d)]

    @F.pandas_udf("array<struct<cell int, d double>>")
    def around(v: pd.Series) -> pd.Series:
        """The nearest cells that have ``need`` rows between them."""
        out = []
        for _, lower, d in bounds(v):
            order = np.lexsort((d, lower), axis=1)
            before = np.cumsum(size[order], axis=1) - size[order]
            mask = np.zeros(lower.shape, bool)
            np.put_along_axis(mask, order, before < need, axis=1)
            out.extend(listed(mask, d))
        return pd.Series(out, index=v.index, dtype=object)

    @F.pandas_udf("array<struct<cell int, d double>>")
    def within(v: pd.Series, kth: pd.Series) -> pd.Series:
        """The cells that can hold a row as near as the k-th."""
        out, limit = [], kth.fillna(np.inf).to_numpy()
        for at, lower, d in bounds(v):
            out.extend(listed(lower <= (limit[at] * (1 + 1e-9) + 1e-12)[:, None], d))
        return pd.Series(out, index=v.index, dtype=object)

    gap = F.greatest(F.col("d") - F.col("_hi"), F.col("_lo") - F.col("d"), F.lit(0.0))

    # Of each of the nearest cells, the chunk at the query's distance from the pivot.
    start = pin(
        queries.select("_qid", "_qvec", F.inline(around("_qvec")))
        .join(chunks, "cell")
        .groupBy("_qid", "cell")
        .agg(F.first("_qvec").alias("_qvec"), F.min_by("chunk", F.struct(gap, "chunk")).alias("chunk"))
    )
    first = pin(_meet(start, placed, need, metric))
    kth = _kth(first, need)
    met = start.groupBy("_qid").agg(F.collect_set("chunk").alias("_met"))  # at most ``need`` chunks
    asked = (
        queries.join(kth, "_qid", "left")
        .join(met, "_qid")
        .select("_qid", "_qvec", "_kth", "_met", F.inline(within("_qvec", "_kth")))
        .join(chunks, "cell")
        .filter(F.col("_kth").isNull() | (gap <= F.col("_kth") * (1 + 1e-9) + 1e-12))
        .filter(~F.array_contains("_met", F.col("chunk")))
        .select("_qid", "_qvec", "chunk")
    )
    found = first.unionByName(_meet(pin(asked), placed, need, metric))
    if exclude_self:
        found = found.filter(F.col("_qid") != F.col("_rid"))
    return _ranked(found, qid, rid, k)


def _ranked(found: DataFrame, qid: str, rid: str, k: int) -> DataFrame:
    w = Window.partitionBy("_qid").orderBy("dist", "_rid")
    return (
        found.withColumn("pos", F.row_number().over(w))
        .filter(F.col("pos") <= k)
        .select(F.col("_qid").alias(qid), F.col("_rid").alias(rid), "dist", "pos")
    )


def knn_classify(
    queries: DataFrame,
    train: DataFrame,
    key: str,
    label: str,
    vec: str,
    k: int = 5,
    weights: str = "uniform",
    metric: str = "euclidean",
) -> DataFrame:
    """(key, prediction): vote of the k nearest labelled rows; ties to the smallest label."""
    refs = train.select(F.col(key).alias("_ref"), vec)
    near = knn(queries.select(key, vec), refs, key, "_ref", vec, k, metric)
    labelled = near.join(train.select(F.col(key).alias("_ref"), label), "_ref")
    weight = F.lit(1.0) if weights == "uniform" else 1.0 / F.greatest("dist", F.lit(1e-12))
    votes = labelled.groupBy(key, label).agg(F.sum(weight).alias("_w"))
    return votes.groupBy(key).agg(
        F.min_by(F.col(label), F.struct(-F.col("_w"), F.col(label))).alias("prediction")
    )


def smote_nc(
    df: DataFrame,
    key: str,
    label: str,
    numeric: list[str],
    categorical: list[str],
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Original rows plus synthetic rows of the smaller class until both have the same count.

    A synthetic row lies between a minority row and one of its k nearest minority
    rows; its categories are the most frequent among those neighbours. Neighbours
    use numbers only, with each unequal category counted by the median deviation
    of the numbers. All draws are hashes of row key and copy number.
    """
    from tablewright.operators.features import category_scale

    counts = {r[label]: r["count"] for r in df.groupBy(label).count().orderBy("count", label).limit(3).collect()}
    if len(counts) != 2:
        raise ValueError("smote_nc needs two classes")
    (minor, n_minor), (_, n_major) = sorted(counts.items(), key=lambda kv: (kv[1], kv[0]))
    wanted = n_major - n_minor
    small = df.filter(F.col(label) == minor)
    codes, penalty = category_scale(small, numeric, categorical)
    parts = [F.array(*[F.col(c).cast("double") for c in numeric])]
    for c in categorical:
        # Two rows of unequal category differ by the penalty in this block.
        parts.append(
            F.array(*[F.when(F.col(c) == lv, F.lit(penalty / math.sqrt(2))).otherwise(0.0) for lv in codes[c]])
        )
    rows = small.select(key, *numeric, *categorical, F.concat(*parts).alias("_vec"))
    near = knn(
        rows.select(key, "_vec"), rows.select(F.col(key).alias("_near"), "_vec"), key, "_near", "_vec", k,
        exclude_self=True,
    )
    other = rows.select(
        F.col(key).alias("_near"),
        *[F.col(c).alias(f"_n_{c}") for c in (*numeric, *categorical)],
    )
    hood = near.join(other, "_near")
    # Most frequent category among at most k neighbours.
    per_row = hood.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", *[f"_n_{c}" for c in (*numeric, *categorical)]))).alias("_hood")
    )
    # Copies per row: the same number for all, one more for the first in hash order.
    base, extra = divmod(wanted, n_minor)
    ranked = dense_index(rows.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), [], ["_h", key], "_rank")
    copies = F.lit(base) + F.when(F.col("_rank") < extra, 1).otherwise(0)
    drawn = (
        ranked.withColumn("_copies", copies.cast("int"))
        .filter(F.col("_copies") > 0)
        .join(per_row, key)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    )
    pick = F.col("_hood")[
        F.pmod(F.xxhash64(F.col(key), "_copy", F.lit(seed + 1)), F.size("_hood").cast("long")).cast("int")
    ]
    lam = F.pmod(F.xxhash64(F.col(key), "_copy", F.lit(seed + 2)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    made = drawn.withColumn("_pick", pick).withColumn("_lam", lam)

    def frequent(c: str):
        values = F.transform("_hood", lambda s: s[f"_n_{c}"])
        tallies = F.transform(
            F.array_distinct(values),
            lambda v: F.struct((-F.size(F.filter(values, lambda u: u == v))).alias("n"), v.alias("v")),
        )
        return F.array_min(tallies)["v"]

    synthetic = made.select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        *[
            (F.col(c) + F.col("_lam") * (F.col("_pick")[f"_n_{c}"] - F.col(c))).cast("double").alias(c)
            for c in numeric
        ],
        *[frequent(c).alias(c) for c in categorical],
        F.lit(minor).alias(label),
        F.lit(1).alias("synthetic"),
    )
    original = df.select(
        key, *[F.col(c).cast("double").alias(c) for c in numeric], *categorical, label, F.lit(0).alias("synthetic")
    )
    return original.unionByName(synthetic)
