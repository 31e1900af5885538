"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, score double, node string, size int"


def fold_case(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, lower=True):
    return WORD.findall(fold_case(text) if lower else text or "")


def texts(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 6))) for _ in range(120)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(1, 90))) + rng.choice(["", ".", "\n", "\t\n x"]) for _ in range(n)]


def rows(n=60, seed=3):
    """Documents as tuples in the order of ``SCHEMA``."""
    own = texts(n, seed)
    own += ["", None, " \t\n", "One", "one two three four", "ONE TWO three four", own[0], own[0].upper(), "α β γ δ ε ζ"]
    own += [own[1] + " extra", "x " * 3000, " word ", "日本語 テキスト", "123 456 !!"]
    out = [(i, t, "ab"[i % 2] + "z", ["s1", "s2", "Ω", "", None][i % 5], 0.5, "n", i) for i, t in enumerate(own)]
    out += [out[2], (None, own[3], None, None, None, None, None), (5, "another text under one id", "az", "s1", 1.0, "n", 1)]
    return out


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
