"""Near duplicates by SetSketch registers.

A document's set is its distinct five-word shingles. Its sketch has ``M`` registers: every
shingle draws exponential values for the registers, a register keeps the least, and holds
``floor(1 - log_b(least))`` cut to 16 bits, so registers are exponentially spaced, merge by
maximum, and agree between two sets the more often the more alike they are.

1. One pass gives each document its set's size, a 128-bit digest and its registers.
   Documents with equal sets become one node.
2. Bands of registers make buckets. In a bucket each node is paired with the bucket's
   best-connected node, never all with all; register agreement gives the maximum-likelihood similarity
   of each pair, and unlikely pairs go.
3. The remaining pairs are confirmed on their full sets, and components are built.
4. Buckets whose nodes still lie in several components are compared on registers, cell by
   cell. Components that likely pairs connect form a group; a group's documents come
   together, again in cells of bounded size, and every likely pair across components is
   confirmed on full sets. So each pair that shares a bucket is either in one component or
   was rejected, and tasks pass on no more pairs than there are components to join.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import words as W
from tablewright.llm.graph import components
from tablewright.llm.sieve import Sieve
from tablewright.session import pin

M = 128  # registers
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
ROWS = 4  # registers in a band
MARGIN = 0.16  # likely pairs: the estimate may fall short of the wanted similarity by four deviations
CELL = 512  # nodes of a group compared with as many others at a time
MEMBERS = 256  # pairs of one left side that one task confirms
_U = np.uint64


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; rows with fewer words: all words as one."""
    grams, begin = W.gram_hashes(hashes, first, size)
    out = []
    for row in range(len(first) - 1):
        n = first[row + 1] - first[row]
        if n >= size:
            out.append(np.unique(grams[begin[row] : begin[row + 1]]))
        elif n:
            whole = np.array([n], np.uint64)
            for x in hashes[first[row] : first[row + 1]]:
                whole = W.mix(whole * _U(W.MULTIPLIER) + x)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (rows x M, uint16) of sets of 64-bit hashes.

    Every element visits the registers in an order of its own with ascending exponential
    values (spacings of rate RATE * (M - j)), and stops once its value exceeds the
    largest register minimum of its set; most elements stop after one or two visits.
    """
    n = len(sets)
    least = np.full(n * M, np.inf)
    element = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    start = (element >> _U(7)).astype(np.int64) & (M - 1)
    stride = ((element >> _U(21)).astype(np.int64) & (M - 1)) | 1  # odd: visits all M
    value = np.zeros(len(element))
    for j in range(M):
        if not len(element):
            break
        draw = W.mix(element + _U(((j + 1) * W.MULTIPLIER) % (1 << 64)))
        value = value - np.log(((draw >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / (RATE * (M - j))
        np.minimum.at(least, row * M + ((start + j * stride) & (M - 1)), value)
        going = value < least.reshape(n, M).max(axis=1)[row]
        element, row, start, stride, value = (x[going] for x in (element, row, start, stride, value))
    least = np.where(np.isfinite(least), least, 1e300)
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, TOP).astype(np.uint16).reshape(n, M)


def likely_similarity(above: np.ndarray, below: np.ndarray, left: np.ndarray, right: np.ndarray, grid: int = 101) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register comparisons and known set sizes.

    ``above`` / ``below``: registers of the left set that are greater / less. With shares
    u and v of the two sizes, a register is greater with probability p(u - vJ) and less
    with p(v - uJ), p(x) = -log_b(1 - x (b - 1) / b).
    """
    u, v = left / (left + right), right / (left + right)
    best, score = np.zeros(len(u)), np.full(len(u), -np.inf)
    prob = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    limit = np.minimum(u / v, v / u)
    for step in np.linspace(0, 1, grid):
        j = step * limit
        more, less = prob(u - v * j), prob(v - u * j)
        same = np.maximum(1 - more - less, 1e-12)
        ll = above * np.log(np.maximum(more, 1e-12)) + below * np.log(np.maximum(less, 1e-12)) + (M - above - below) * np.log(same)
        up = ll > score
        best, score = np.where(up, j, best), np.where(up, ll, score)
    return best


def reaches(above: np.ndarray, below: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Whether the likeliest similarity is ``least`` or more: the sign of the likelihood's slope there.

    Sizes that rule the similarity out decide at once.
    """
    u, v = left / (left + right), right / (left + right)
    q = (BASE - 1) / BASE / math.log(BASE)
    prob = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)
    slope = lambda x: q / (1 - x * (BASE - 1) / BASE)
    x, y = np.maximum(u - v * least, 1e-9), np.maximum(v - u * least, 1e-9)
    more, less = prob(x), prob(y)
    same = M - above - below
    rise = -above * v * slope(x) / more - below * u * slope(y) / less + same * (v * slope(x) + u * slope(y)) / np.maximum(1 - more - less, 1e-9)
    return (np.minimum(left, right) >= least * np.maximum(left, right)) & (rise >= 0)


def _reaching(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, least: float) -> np.ndarray:
    return reaches((x > y).sum(axis=1), (x < y).sum(axis=1), nx.astype(float), ny.astype(float), least)


def _regs(column) -> np.ndarray:
    """Registers (rows x M) of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """``doc_id, n_shingles, node, check, regs``: size, 128-bit digest (two longs) and registers
    of every document's shingle set. Empty sets have no node and no registers."""

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 22):
                sets = shingle_sets(*W.word_hashes(part.column("text")), size)
                regs = registers(sets)
                counts = np.array([len(s) for s in sets], np.int64)
                none = counts == 0
                node, check = _digests(sets)
                raw = [None if none[i] else regs[i].tobytes() for i in range(len(sets))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts),
                        pa.array(node, mask=none),
                        pa.array(check, mask=none),
                        pa.array(raw, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "node", "check", "regs"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, node long, check long, regs binary"
    )


def _bands(nodes: DataFrame) -> DataFrame:
    """``node, bucket``: one row a band."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = _regs(batch.column("regs")).astype(np.uint64)
            count = M // ROWS
            keys = np.zeros((len(regs), count), np.uint64) + np.arange(1, count + 1, dtype=np.uint64)
            for k in range(ROWS):
                keys = W.mix(keys * _U(W.MULTIPLIER) + regs[:, k::ROWS])
            node = np.repeat(np.asarray(batch.column("node")), count)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(_signed(keys.reshape(-1)))], names=["node", "bucket"])

    return nodes.select("node", "regs").mapInArrow(run, "node long, bucket long")


def _likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` whose registers make a similarity of ``least`` likely."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _regs(batch.column("ra")), _regs(batch.column("rb"))
            good = _reaching(x, y, np.asarray(batch.column("na")), np.asarray(batch.column("nb")), least)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    side = lambda end: nodes.select(F.col("node").alias(end), F.col("regs").alias(f"r{end}"), F.col("n_shingles").alias(f"n{end}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as two longs: sums of two hashes of its elements."""
    node = [W.mix((s * _U(0x9FB21C651E98DF25)).sum(dtype=np.uint64, keepdims=True) ^ _U(len(s)))[0] for s in sets]
    check = [W.mix(s + _U(77)).sum(dtype=np.uint64) for s in sets]
    return _signed(np.array(node, np.uint64)), _signed(np.array(check, np.uint64))


def _texts(pairs: DataFrame, nodes: DataFrame, source: DataFrame, size: int) -> DataFrame:
    """``node, text`` of the nodes that pairs name: the text of a node's least document.

    A doc_id may stand in several rows; only texts with the node's own digest stay. Texts that
    no pair names are sifted out ahead of the shuffle.
    """
    named = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = pin(nodes.join(named, "node").select("node", "doc_id"))
    source, _ = Sieve(wanted, "doc_id").split(source, "doc_id")

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 22):
                node, _ = _digests(shingle_sets(*W.word_hashes(part.column("text")), size))
                yield part.filter(pa.array(node == np.asarray(part.column("node"))))

    return source.join(wanted, "doc_id").select("node", "text").mapInArrow(run, "node long, text string")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs whose full sets reach the similarity.

    Rows of a left side are dealt in parts of ``MEMBERS`` pairs; each part gets the left text
    once, ahead of its members, so a task holds one left set at a time.
    """
    share = round(similarity * 100)
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("parts"))
    rows = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    members = rows.join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    heads = (
        texts.withColumnRenamed("node", "a")
        .join(parts, "a")
        .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text")
    )
    placed = heads.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches):
        head, key = None, None
        for batch in batches:
            for piece in W.slices(batch, "text", 1 << 22):
                sets = shingle_sets(*W.word_hashes(piece.column("text")), size)
                a, b = piece.column("a").to_pylist(), piece.column("b").to_pylist()
                part = piece.column("part").to_pylist()
                found = []
                for i, own in enumerate(sets):
                    if b[i] is None:
                        head, key = own, (a[i], part[i])
                    elif key == (a[i], part[i]):
                        at = np.minimum(np.searchsorted(head, own), len(head) - 1)
                        both = int((head[at] == own).sum())
                        if 100 * both >= share * (len(head) + len(own) - both):
                            found.append((a[i], b[i]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
                    )

    return placed.mapInArrow(run, "a long, b long")


def _cells(rows: DataFrame, group: str) -> DataFrame:
    """Rows of a group dealt into chunks and laid out as pairs of chunks ``lo <= hi``, so that every
    pair of rows of a group meets in a cell of bounded size."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / CELL).alias("chunks"))
    dealt = rows.join(sizes, group).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    cells = cells.withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")}).drop("other", "chunks")
    return cells.repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi")


def _per_cell(batches, group: str, compare):
    """Feeds the rows of each cell to ``compare`` as one table."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        keys = np.stack([np.asarray(rows[c]) for c in (group, "lo", "hi")])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        for s, e in zip(edges, edges[1:]):
            if e - s > 1:
                yield compare(rows.slice(s, e - s).combine_chunks())
        held = rows.slice(edges[-1])
    if held is not None and held.num_rows > 1:
        yield compare(held.combine_chunks())


def _likely_within(rows: pa.Table, least: float, confirm=None) -> tuple[list[int], list[int]]:
    """Row pairs of a cell that join components: a pair counts if it is likely, and if ``confirm(i, js)``
    says so, and if no pair before it has joined the two components already."""
    root, size, regs = np.asarray(rows["label"]).copy(), np.asarray(rows["n_shingles"]), _regs(rows["regs"])
    chunk = np.asarray(rows["chunk"])
    low, high = np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk == chunk.max())
    a, b = [], []
    for i in low:
        js = high[root[high] != root[i]]
        if low[-1] == high[-1]:
            js = js[js > i]
        js = js[np.minimum(size[js], size[i]) >= least * np.maximum(size[js], size[i])]
        js = js[(regs[js] == regs[i]).sum(axis=1) >= (least - 0.1) * M]
        if len(js):
            js = js[_reaching(regs[js], np.broadcast_to(regs[i], (len(js), M)), size[js], np.full(len(js), size[i]), least)]
        if len(js) and confirm is not None:
            js = js[confirm(i, js)]
        for j in js:
            if root[j] != root[i]:
                a.append(i)
                b.append(j)
                root[root == root[j]] = root[i]
    return a, b


def _forest(mixed: DataFrame, least: float) -> DataFrame:
    """Components (``a, b``) that likely pairs of some bucket connect (``bucket, node, label, n_shingles, regs``).

    A cell sends no more pairs than it has components, however many pairs are likely.
    """

    def compare(rows: pa.Table):
        label = np.asarray(rows["label"])
        a, b = _likely_within(rows, least)
        return pa.RecordBatch.from_arrays([pa.array(label[a], pa.int64()), pa.array(label[b], pa.int64())], names=["a", "b"])

    def run(batches):
        yield from _per_cell(batches, "bucket", compare)

    return _cells(mixed, "bucket").mapInArrow(run, "a long, b long").distinct()


def _confirmed_within(groups: DataFrame, least: float, size: int, similarity: float) -> DataFrame:
    """Links between components of one group (``group, node, label, n_shingles, regs, text``).

    All likely pairs of a group that lie in two components are held against each other on
    their full sets, cell by cell; a cell sends the links that join components.
    """
    share = round(similarity * 100)

    def compare(rows: pa.Table):
        sets = shingle_sets(*W.word_hashes(rows["text"]), size)
        counts = np.array([len(s) for s in sets])

        def confirm(i: int, js: np.ndarray) -> np.ndarray:
            found = np.concatenate([sets[j] for j in js])
            at = np.minimum(np.searchsorted(sets[i], found), counts[i] - 1)
            both = np.add.reduceat((sets[i][at] == found).astype(np.int64), np.concatenate([[0], np.cumsum(counts[js])[:-1]]))
            return 100 * both >= share * (counts[i] + counts[js] - both)

        node = np.asarray(rows["node"])
        a, b = _likely_within(rows, least, confirm)
        return pa.RecordBatch.from_arrays([pa.array(node[a], pa.int64()), pa.array(node[b], pa.int64())], names=["a", "b"])

    def run(batches):
        yield from _per_cell(batches, "group", compare)

    return _cells(groups, "group").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.75
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their distinct ``size``-word
    shingle sets (ASCII lower case) is at least ``similarity``, confirmed on the full sets;
    ``component_id`` is the least doc_id that links reach, ``kept`` marks that document.

    Fewer words than ``size``: the whole sequence is the one shingle. No words or null text:
    the set is empty and linked with nothing. Rows that repeat a doc_id are one document:
    their sets share a component. Null doc_id: the row has no name, so a null
    ``component_id``, and is kept. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = pin(sketches(docs, doc_id, text, size))
    sets = rows.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = pin(
        sets.groupBy("node", "check").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"))
    )
    least = similarity - MARGIN

    bands = _bands(nodes)
    several = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = pin(bands.join(several, "bucket"))
    # The node that meets others most often is likely the one that the others were copied from.
    met = met.join(met.groupBy("node").agg(F.sum("n").alias("degree")), "node")
    heads = met.groupBy("bucket").agg(F.max_by("node", F.struct("degree", "node")).alias("a"))
    shared = pin(met.join(heads, "bucket").select("bucket", "node", "a"))
    stars = shared.filter("node <> a").groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("hits"))
    likely = _likely(stars, nodes, least)
    best = pin(likely.join(stars, ["a", "b"]).groupBy("b").agg(F.max_by("a", F.struct("hits", "a")).alias("a")))

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def confirm(pairs: DataFrame) -> DataFrame:
        return _confirmed(pairs, _texts(pairs, nodes, source, size), size, similarity)

    links = pin(confirm(best.select("a", "b")))
    # One document with several texts: its sets belong together.
    double = sets.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("doc_id", "lo")
    same = sets.join(double, "doc_id").filter("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b"))
    labels = components(links.unionByName(same))

    tagged = shared.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    split = tagged.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("bucket")
    mixed = tagged.join(split, "bucket").join(nodes.select("node", "n_shingles", "regs"), "node")
    mixed = pin(mixed)
    forest = pin(_forest(mixed, least))
    if not forest.isEmpty():
        groups = components(forest).select(F.col("node").alias("label"), F.col("label").alias("group"))
        members = mixed.select("node", "label", "n_shingles", "regs").dropDuplicates(["node"]).join(groups, "label")
        texts = _texts(members.select(F.col("node").alias("a"), F.col("node").alias("b")), nodes, source, size)
        more = pin(_confirmed_within(members.join(texts, "node"), least, size, similarity))
        labels = components(links.unionByName(same).unionByName(more))

    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_node = named.join(ids, "label").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
