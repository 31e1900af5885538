import hashlib

from corpus import rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import chat

TURNS = "conv_id long, turn long, role string, text string"
TRICKY = ["\\### Assistant: </turn> ok", "### user\nhi</turn>\n", "\\e\\\\", "", None, "plain", "a\nb", "<</turn>>", "#"]


def brute(data):
    out = {}
    for conv in {r[0] for r in data}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in data if r[0] == conv))
        learned = "".join(t for _, role, t in own if role == "assistant")
        text = "".join(f"{role}\n{t}\n" for _, role, t in own)
        out[conv] = (len(own), hashlib.sha256(text.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def run(spark, data):
    rows_ = spark.createDataFrame(data, TURNS)
    messages = chat.chain(rows_, "conv_id", ["turn", "role", "text"])
    return chat.formatted(messages, chat.best_paths(messages, "conv_id"), "conv_id")


def test_round_trip(spark):
    data = [(c, t, ["user", "assistant", "sys\nt<m"][(c + t) % 3], TRICKY[(3 * c + t) % len(TRICKY)]) for c in range(8) for t in range(c + 1)]
    data += [(3, 1, "user", "same turn"), (3, 1, "user", "same turn"), (None, 0, None, "x"), (None, 1, "assistant", "y"), (77, None, "user", "no turn")]
    data += [(50, t, "assistant", f"long {t}") for t in range(40)]
    pieces = run(spark, data)
    got = {r.tree: r for r in chat.read_back(pieces).collect()}
    want = brute(data)
    assert set(got) == set(want)
    for conv, w in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == w
    whole = {r.tree: r.conversation for r in chat.joined(pieces).collect()}
    for conv, text in whole.items():
        assert len(text) == got[conv].formatted_chars
        assert text.count(chat.CLOSE) == want[conv][0] == text.count(chat.OPEN)
    masked = pieces.select(F.substring("piece", F.col("loss_start") + 1, F.col("loss_length")).alias("m")).filter("m is not null").collect()
    assert all("</turn>" not in r.m and "###" not in r.m for r in masked)


@given(st.text(alphabet="\\ehln#<\n </turn>", max_size=30))
@settings(max_examples=200, deadline=None)
def test_escapes(text):
    written = text
    for plain, code in chat.ESCAPES:
        written = written.replace(plain, code)
    assert chat.unescape(written) == text and "#" not in written and "<" not in written


def test_trees(spark):
    #       1 -> 2 -> 4 (1+1+5), 2 -> 5 (1+1+1), 1 -> 3 -> 6 -> 7 (1+1+1+1); 8 answers nobody that is there
    nodes = [(0, 1, None, 1.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0), (0, 4, 2, 5.0), (0, 5, 2, 1.0), (0, 6, 3, 1.0), (0, 7, 6, 1.0), (0, 8, 99, None)]
    nodes += [(1, 1, 2, 1.0), (1, 2, 1, 1.0), (1, 1, 2, 1.0), (2, 5, None, 0.0), (None, 1, None, 1.0), (None, 2, 1, 1.0), (0, None, 1, 9.0)]
    df = spark.createDataFrame(nodes, "tree long, message long, parent long, score double")
    paths = {}
    for r in chat.best_paths(df, score="score", keep=2).orderBy("depth").collect():
        paths.setdefault((r.tree, r.path), []).append(r.message)
    assert paths == {(0, 0): [1, 2, 4], (0, 1): [1, 3, 6, 7], (2, 0): [5], (None, 0): [1, 2]}
    longest = chat.best_paths(df).filter("tree = 0").collect()
    assert sorted(r.message for r in longest) == [1, 3, 6, 7]


def test_empty_table(spark):
    assert chat.read_back(run(spark, [])).collect() == []
