"""Chat formatting of reply trees.

Messages form trees by their parents. Self-joins that double the distance each round give every
message its ancestors at distances 1, 2, 4, ..., its depth and the score of the path to it.
The best leaves of each tree are kept, and the same joins, read from the longest distance
down, list the messages of each chosen path; rows grow with the paths, not with their
squares. Every turn is then written between control strings that texts cannot contain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablewright.operators.joins import null_safe_join
from tablewright.operators.ordering import dense_index
from tablewright.session import pin

OPEN, CLOSE = "### ", "</turn>\n"
# What a text may not contain as it stands, and its escape; the escape sign first.
ESCAPES = (("\\", "\\e"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))
LEARNED = "assistant"


def escape(column: Column, table: Sequence[tuple[str, str]] = ESCAPES) -> Column:
    for plain, code in table:
        column = F.replace(column, F.lit(plain), F.lit(code))
    return column


def unescape(text: str) -> str:
    """The inverse of both tables."""
    if "\\" not in text:
        return text
    codes = {code[1]: plain for plain, code in ROLE_ESCAPES}
    out = text.split("\\")
    return out[0] + "".join(codes[part[0]] + part[1:] for part in out[1:])


def chain(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` of unbranched conversations with ``message, parent``: each answers the one before."""
    numbered = dense_index(rows, [tree], list(order), out="message")
    return numbered.withColumn("parent", F.when(F.col("message") > 0, F.col("message") - 1))


def best_paths(messages: DataFrame, tree: str = "tree", score: str | None = None, keep: int = 1) -> DataFrame:
    """``tree, path, message, depth`` for the ``keep`` root-to-leaf paths of the highest score.

    ``messages`` has ``tree, message, parent`` and a score column; a path's score is the sum of its
    messages' (null: 0; no column: 1 each, so longer paths first), ties go to the lesser
    leaf. A null parent, or one that is not there, makes a root. Messages whose parents run in
    a circle are on no path. A message id that is repeated within a tree counts once. Paths are
    numbered from 0; depth counts from 0 at the root.
    """
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(1.0)
    nodes = messages.select(F.col(tree).alias("tree"), "message", F.col("parent"), value.alias("value"))
    nodes = nodes.filter(F.col("message").isNotNull()).groupBy("tree", "message").agg(F.min("parent").alias("parent"), F.max("value").alias("value"))
    nodes = pin(nodes)
    known = nodes.select("tree", F.col("message").alias("parent"), F.lit(True).alias("there"))
    linked = null_safe_join(nodes, known, ["tree", "parent"], "left")
    up = F.when(F.col("there"), F.col("parent"))
    level = pin(linked.select("tree", "message", up.alias("up"), F.lit(1).cast("long").alias("steps"), F.col("value").alias("total")))
    n = level.count()
    levels, ended = [], [level.filter("up is null")]
    while len(levels) <= max(n, 1).bit_length() + 1:
        going = level.filter("up is not null")
        if going.isEmpty():
            break
        levels.append(going.select("tree", "message", "up"))
        done = going.select("tree", "message", "up", "steps", "total")
        for e in ended:
            done = done.unionByName(e.select("tree", "message", "up", "steps", "total"))
        ahead = done.select("tree", F.col("message").alias("up"), F.col("up").alias("far"), F.col("steps").alias("more"), F.col("total").alias("sum"))
        jumped = null_safe_join(going, ahead, ["tree", "up"])
        level = pin(
            jumped.select("tree", "message", F.col("far").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("sum")).alias("total"))
        )
        ended.append(level.filter("up is null"))
    whole = ended[0]
    for e in ended[1:]:
        whole = whole.unionByName(e)
    whole = pin(whole.select("tree", "message", "steps", "total"))
    parents = linked.filter("there").select("tree", F.col("parent").alias("message"), F.lit(True).alias("inner")).distinct()
    leaves = null_safe_join(whole, parents, ["tree", "message"], "left").filter("inner is null")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.asc("message"))
    chosen = leaves.withColumn("path", F.row_number().over(order) - 1).filter(F.col("path") < keep)
    path = pin(chosen.select("tree", "path", "message"))
    for far in reversed(levels):
        more = null_safe_join(path, far, ["tree", "message"]).select("tree", "path", F.col("up").alias("message"))
        path = pin(path.unionByName(more))
    return null_safe_join(path, whole, ["tree", "message"]).select("tree", "path", "message", (F.col("steps") - 1).alias("depth"))


def formatted(messages: DataFrame, paths: DataFrame, tree: str = "tree", role: str = "role", text: str = "text") -> DataFrame:
    """``tree, path, depth, piece, loss_start, loss_length``: every turn of the chosen paths, written.

    A turn is ``### role``, the text, ``</turn>``; the pieces of a path in order of depth are the
    conversation (``joined`` makes one string of them). The loss mask of a piece covers the
    text of an assistant, in code points from the start of the piece; other turns have none. Null roles and texts are
    empty; of rows with one message id the least by role and text is written.
    """
    turn = F.struct(F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = messages.groupBy(F.col(tree).alias("tree"), "message").agg(F.min(turn).alias("turn")).select("tree", "message", "turn.*")
    found = null_safe_join(paths, rows, ["tree", "message"])
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    body = escape(F.col("text"))
    learned = F.col("role") == LEARNED
    return found.select(
        "tree",
        "path",
        "depth",
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.when(learned, F.length(head)).cast("long").alias("loss_start"),
        F.when(learned, F.length(body)).cast("long").alias("loss_length"),
    )


def joined(pieces: DataFrame) -> DataFrame:
    """``tree, path, conversation``: one string a path."""
    turns = F.array_sort(F.collect_list(F.struct("depth", "piece")))
    return pieces.groupBy("tree", "path").agg(F.array_join(F.transform(turns, lambda t: t["piece"]), "").alias("conversation"))


def read_back(pieces: DataFrame) -> DataFrame:
    """``tree, path, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from written turns.

    Pieces of a path come to one task in order and are read one by one, so a long
    conversation is never held whole.
    """
    kind = pieces.schema["tree"].dataType.simpleString()
    placed = pieces.repartition("tree", "path").sortWithinPartitions("tree", "path", "depth")
    names = ["tree", "path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for tree, path, piece, start, length in zip(*(batch.column(c).to_pylist() for c in ("tree", "path", "piece", "loss_start", "loss_length"))):
                if state is None or key != (tree, path):
                    if state is not None:
                        done.append((*key, *_closed(state)))
                    key, state = (tree, path), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if not (piece.startswith(OPEN) and piece.endswith(CLOSE)):
                    raise ValueError("a piece is not a turn")
                role, _, body = piece[len(OPEN) : -len(CLOSE)].partition("\n")
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                if start is not None:
                    learned = unescape(piece[start : start + length])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(piece)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, *_closed(state))))], schema=schema)

    schema = pa.schema(
        [("tree", to_arrow_type(pieces.schema["tree"].dataType)), ("path", pa.int32()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )
    return placed.mapInArrow(
        run, f"tree {kind}, path int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _closed(state: list) -> tuple:
    return state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
