"""Prefix trie of conversations, with sums over subtrees.

A node is a distinct sequence of first turns. Its key is the sum of 124-bit digests of (place, turn)
over the sequence, so keys are running sums and a node's key less its last turn's digest is its
parent's: no turn is compared with another, however long the conversations.

Subtree sums go up by depth bands. A band has ``BAND`` depths; each node sends its values to its
ancestors within its band only. What arrives at a band's roots is the sum over its band. The
band roots form a trie of their own, ``BAND`` times less deep, which is summed the same way; then each
band root, its sum complete, sends it to its ancestors in the band above. So a trie of depth D
takes log D / log BAND levels, and no node ever makes more than 2 ``BAND`` rows on a level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordering import dense_index, running_totals
from tablewright.operators.skew import CHUNK, attach, in_pages
from tablewright.session import pin

BAND = 16
LANES = ("a1", "a2", "b1", "b2")  # digests of 32 bits, of which keys keep 31
NODE = ["d", "k1", "k2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def numbered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, turn_digest, words``: the turns of each conversation, numbered from 1.

    Order: by turn, null first; ties by role and text. Null roles and texts are empty. Rows without a
    conversation id are of no conversation and left out. Repeated rows are turns of their own.
    """
    plain = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in (("role", role), ("text", text))],
    ).filter("conv is not null")
    placed = dense_index(plain, ["conv"], ["turn", "role", "text"], "pos", 1)
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return placed.select("conv", "pos", F.sha2(whole, 256).alias("turn_digest"), words.cast("long").alias("words"))


def with_shared_heads(turns: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations, and the table ``conv`` of all conversations, rebuilt ones without a turn too.

    Each conversation c becomes the first ``heads`` turns (an expression of ``conv``, at most ``most``) of
    conversation ``base`` (likewise; all its turns if it has fewer, none if it is not there), then
    its own turns after its first ``heads``.
    """
    turns = pin(turns)
    all_convs = turns.select("conv").distinct()
    first = turns.filter(F.col("pos") <= most)
    given = first.select(F.col("conv").alias("base"), F.col("pos").alias("d"), "turn_digest", "words")
    asked = all_convs.select("conv", base.alias("base"), heads.alias("h"))
    head = asked.join(given, "base").filter(F.col("d") <= F.col("h")).select("conv", "d", "turn_digest", "words")
    lengths = first.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("there"))
    own = turns.select("conv", "pos", "turn_digest", "words", base.alias("base"), heads.alias("h")).filter(F.col("pos") > F.col("h"))
    shift = F.least("h", F.coalesce("there", F.lit(0)))
    rest = attach(own, lengths, ["base"], "left").select("conv", (F.col("pos") - F.col("h") + shift).alias("d"), "turn_digest", "words")
    return head.unionByName(rest), all_convs


def _lane(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def _key(lanes: Sequence[Column]) -> list[Column]:
    low = [F.pmod(x, F.lit(1 << 31)) for x in lanes]
    return [F.shiftleft(low[0], 31).bitwiseOR(low[1]), F.shiftleft(low[2], 31).bitwiseOR(low[3])]


def _prefixes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """``conv, d, k1, k2, p1, p2, words, last``: each prefix of each conversation, the empty ones too."""
    placed = F.sha2(F.concat(F.col("d").cast("string"), F.lit(":"), F.col("turn_digest")), 256)
    rows = turns.select("conv", "d", "words", placed.alias("_digest"))
    rows = rows.select("conv", "d", "words", *[_lane(F.col("_digest"), i).alias(n) for i, n in enumerate(LANES)], F.lit(1).cast("long").alias("one"))
    sums = running_totals(rows, ["conv"], ["d"], {f"s_{n}": n for n in LANES} | {"s_one": "one"})
    k1, k2 = _key([F.col(f"s_{n}") for n in LANES])
    p1, p2 = _key([F.col(f"s_{n}") - F.col(n) for n in LANES])
    full = sums.select(
        "conv", "d", k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"), "words", (F.col("d") == F.col("s_one_total")).alias("last")
    )
    zero = F.lit(0).cast("long")
    some = rows.select("conv").distinct().withColumn("_some", F.lit(True))
    root = members.join(some, "conv", "left").select(
        "conv", zero.alias("d"), zero.alias("k1"), zero.alias("k2"), *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")],
        zero.alias("words"), F.col("_some").isNull().alias("last"),
    )
    return pin(full.unionByName(root))


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: Sequence[str], band: int = BAND) -> DataFrame:
    """``d, k1, k2`` and the sums of ``values`` over each node's subtree, itself included.

    ``nodes``: ``conv, d, k1, k2`` and the values, one row a node, from depth 0 on; ``paths``: ``conv, d,
    k1, k2``, in which each node's ``conv`` has the node and all its ancestors, one row each.
    """
    deepest = nodes.agg(F.max("d")).first()[0]
    stretch = F.floor(F.col("d") / band).cast("long")
    above = paths.select("conv", stretch.alias("band"), F.col("d").alias("to"), F.col("k1").alias("t1"), F.col("k2").alias("t2"))
    target = [F.col(c).alias(n) for c, n in zip(("to", "t1", "t2"), NODE)]

    def sent(rows: DataFrame) -> DataFrame:
        """Rows ``conv, band, d, values`` summed at the nodes of that band on their conversation's path."""
        met = rows.join(above, ["conv", "band"]).filter(F.col("to") <= F.col("d"))
        return met.groupBy(*target).agg(*[F.sum(v).alias(v) for v in values])

    within = sent(nodes.select("conv", stretch.alias("band"), "d", *values))
    if deepest is None or deepest < band:
        return within
    within = pin(within)
    at_root = F.col("d") % band == 0
    roots = nodes.filter(at_root).drop(*values).join(within, NODE)
    scaled = (F.col("d") / band).cast("long").alias("d")
    inner_nodes = roots.select("conv", scaled, "k1", "k2", *values)
    inner_paths = paths.filter(at_root).select("conv", scaled, "k1", "k2")
    full = subtree_sums(pin(inner_nodes), pin(inner_paths), values, band)
    full = full.withColumn("d", F.col("d") * band).join(nodes.select(*NODE, "conv"), NODE)
    below = sent(full.filter("d > 0").select("conv", (F.col("d") / band - 1).cast("long").alias("band"), "d", *values))
    return within.unionByName(below).groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def _end_digests(ends: DataFrame) -> DataFrame:
    """``d, k1, k2, ends_sha256``: the digest of the ids of conversations that end at a node, ascending, joined by commas.

    Ids of a node are joined page by page. A node with one page is digested where it stands; pages of
    the others come in order to one task, which feeds them to the digest one by one, as it is of one string.
    """
    paged = in_pages(ends.select(*NODE, "conv"), NODE, ["conv"])
    page = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    pages = pin(paged.groupBy(*NODE, "page").agg(page.alias("ids")))
    several = pages.filter("page > 0").select(*NODE).distinct()
    short = pages.join(several, NODE, "left_anti").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    long = pages.join(several, NODE).repartition(*NODE).sortWithinPartitions(*NODE, "page").select(*NODE, "ids")
    schema = pa.schema([*((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string())])

    def run(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, state.hexdigest())))], schema=schema)

    return short.unionByName(long.mapInArrow(run, "d long, k1 long, k2 long, ends_sha256 string"))


def trie(turns: DataFrame, members: DataFrame, band: int = BAND) -> DataFrame:
    """One row a node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns``: ``conv, d, turn_digest, words``, d from 1 without gaps; ``members``: ``conv``, every conversation
    once, also those without turns. conv_id is the node's smallest member; n_leaves and saved_tokens
    sum over its subtree, itself included; saved_tokens counts the words of a node's last text once for each
    member but one. No conversations give no nodes, any others the textless root at depth 0.
    """
    prefixes = _prefixes(turns, members)
    nodes = prefixes.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("words").alias("words")
    )
    nodes = pin(nodes)
    up = (F.col("d") - 1).alias("d")
    children = nodes.filter("d > 0").groupBy(up, F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    counted = pin(counted.select("*", leaf.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")))
    sums = subtree_sums(
        counted.select("conv", *NODE, "n_leaves", "saved_tokens"), prefixes.select("conv", *NODE), ["n_leaves", "saved_tokens"], band
    )
    digests = _end_digests(prefixes.filter("last"))
    found = counted.drop("n_leaves", "saved_tokens").join(sums, NODE).join(digests, NODE, "left")
    # Parents of very many children are few (nodes / CHUNK); theirs are sent out first, the others meet in a plain join.
    parents = counted.filter("n_children > 0").select(
        (F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"), "n_children"
    )
    key = ["d", "p1", "p2"]
    hot = attach(found, parents.filter(F.col("n_children") > CHUNK).select(*key, F.col("parent").alias("far")), key, "left")
    cold = hot.filter("far is null").join(parents.filter(F.col("n_children") <= CHUNK).drop("n_children"), key, "left")
    both = hot.filter("far is not null").withColumn("parent", F.col("far")).unionByName(cold)
    return both.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", band: int = BAND) -> DataFrame:
    """The trie of the conversations as they stand; see ``numbered`` for rows and ``trie`` for the result."""
    turns = pin(numbered(rows, conv, turn, role, text))
    return trie(turns.withColumnRenamed("pos", "d"), turns.select("conv").distinct(), band)
