"""URL filtering by a sorted digest array.

The listed strings (host and path, like ``net/`` or ``example.com/de/``) are kept as the 64-bit
xxhash of each, sorted, with the full strings beside them, cut into shards of ``SHARD``
keys. A URL asks for its host's suffixes with its path's prefixes, only of the label counts and
lengths that the list has. A task maps a shard, finds all its probes by one binary
search over the array, and confirms every hit on the stored string, so an equal digest of
another string does no harm.
"""

from __future__ import annotations

import mmap

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import pin

SHARD = 1 << 20  # keys in a shard of the array
PROBES = 1 << 20  # probes of a shard that one task answers
SALTS = 32


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path; both empty without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


class DigestArray:
    """Sorted 64-bit digests with their strings, one memory map.

    The map is anonymous: the array itself lies in the shared folder as a table, and a task's
    copy of a shard needs no local file that a lost executor would leave behind.
    """

    def __init__(self, digests: bytes, offsets: bytes, strings: bytes):
        n = len(digests) // 8
        self.map = mmap.mmap(-1, len(digests) + len(offsets) + len(strings) or 1)
        for part in (digests, offsets, strings):
            self.map.write(part)
        raw = np.frombuffer(self.map, np.uint8)
        self.digests = raw[: 8 * n].view(np.uint64)
        self.offsets = raw[8 * n : 8 * n + len(offsets)].view(np.int64)
        self.strings = raw[8 * n + len(offsets) :]

    def close(self) -> None:
        self.digests = self.offsets = self.strings = None
        self.map.close()

    @staticmethod
    def pack(digests: np.ndarray, strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
        """The three parts of the file, in digest order (strings that share a digest by value)."""
        order = sorted(range(len(strings)), key=lambda i: (int(digests[i]), strings[i]))
        ends = np.cumsum([0] + [len(strings[i]) for i in order], dtype=np.int64)
        return digests[order].astype(np.uint64).tobytes(), ends.tobytes(), b"".join(strings[i] for i in order)

    def find(self, digests: np.ndarray, strings: list[bytes]) -> np.ndarray:
        """Position of each string in the array, -1 if it is not there."""
        found = np.full(len(digests), -1, np.int64)
        at = np.searchsorted(self.digests, digests)
        open_ = np.arange(len(digests))
        while len(open_):
            open_ = open_[at[open_] < len(self.digests)]
            open_ = open_[self.digests[at[open_]] == digests[open_]]
            for i in open_:
                p = at[i]
                if self.strings[self.offsets[p] : self.offsets[p + 1]].tobytes() == strings[i]:
                    found[i] = p
            open_ = open_[found[open_] < 0]
            at[open_] += 1  # another string of the same digest may follow
        return found


def build(listed: DataFrame) -> DataFrame:
    """The array of a table ``host, path``: one row a shard, ``shard, keys, digests, offsets, strings``.

    Null hosts or paths count as empty; a string that is listed twice is stored once.
    """
    key = F.concat(F.coalesce("host", F.lit("")), F.coalesce("path", F.lit("")))
    keys = pin(listed.select(key.alias("key")).distinct().withColumn("digest", F.xxhash64("key")))
    shards = max(1, -(-keys.count() // SHARD))

    def run(shard, table):
        digests = np.asarray(table["digest"]).view(np.uint64)
        parts = DigestArray.pack(digests, [s.encode() for s in table["key"].to_pylist()])
        row = [[shard[0].as_py()], [table.num_rows], *([p] for p in parts)]
        return pa.table(row, names=["shard", "keys", "digests", "offsets", "strings"])

    return pin(
        keys.groupBy(_shard(shards).alias("shard")).applyInArrow(
            run, "shard long, keys long, digests binary, offsets binary, strings binary"
        )
    )


def _shard(shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned("digest", 32), F.lit(shards)).cast("long")


def lookup(probes: DataFrame, array: DataFrame) -> DataFrame:
    """The distinct ``key`` values of ``probes`` that the array holds."""
    keys = probes.select("key").distinct().withColumn("digest", F.xxhash64("key"))
    shards = max(1, array.count())
    parts = max(1, -(-keys.count() // (PROBES * shards)))
    asked = keys.withColumn("shard", _shard(shards)).withColumn("part", F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(parts)))
    copies = array.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def probe(left, right):
        keys = left["key"].to_pylist()
        hit = np.zeros(len(keys), bool)
        digests = np.asarray(left["digest"]).astype(np.int64).view(np.uint64)
        strings = [k.encode() for k in keys]
        for d, o, s in zip(*(right[c].to_pylist() for c in ("digests", "offsets", "strings"))):
            held = DigestArray(d, o, s)
            try:
                hit |= held.find(digests, strings) >= 0
            finally:
                held.close()
        return pa.table({"key": pa.array([k for k, h in zip(keys, hit) if h], pa.string())})

    return asked.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(probe, "key string")


def judge(pages: DataFrame, entries: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    ``entries``: ``host, path, verdict, ruled``. An entry fits its host and all subdomains if
    the path starts with its path. The longest fitting entry with ``ruled`` decides and is
    named in ``rule`` (host and path); without one the longest other entry decides and
    ``rule`` is null; without any the verdict is allow. Of entries alike in all but the
    verdict, block wins. Null urls and urls without ``://`` have an empty host and path, and fit
    nothing. Repeated rows are judged alike. Columns named like the results are replaced.
    """
    results = ("host", "path", "rule", "verdict")
    host, path = url_parts(url)
    plain = [c for c in pages.columns if c.lower() not in results or c == url]
    rows = pages.select(*[F.col(f"`{c}`") for c in plain], host.alias("_host"), path.alias("_path"))
    known = pin(
        entries.select(
            F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict", "ruled"
        )
        .filter("host <> ''")
        .groupBy("host", "path", "ruled")
        .agg(F.max("verdict").alias("verdict"))
    )
    # Distinct small numbers: labels in a listed host, lengths of a listed path.
    labels = sorted(r[0] for r in known.select(F.size(F.split("host", r"\."))).distinct().collect())
    lengths = sorted(r[0] for r in known.select(F.length("path")).distinct().collect())
    if not labels:
        return rows.select(*_out(plain, url), F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))

    asked = rows.select("_host", "_path").distinct().filter("_host <> ''").withColumn("_labels", F.split("_host", r"\."))
    suffixes = F.array_compact(
        F.array(*[F.when(F.size("_labels") >= n, F.array_join(F.slice("_labels", -n, n), ".")) for n in labels])
    )
    prefixes = F.array_compact(F.array(*[F.when(F.length("_path") >= n, F.substring("_path", 1, n)) for n in lengths]))
    tried = asked.withColumn("_suffix", F.explode(suffixes)).withColumn("_prefix", F.explode(prefixes))
    tried = tried.select("_host", "_path", "_suffix", "_prefix", F.concat("_suffix", "_prefix").alias("key"))
    hits = lookup(tried, build(known.select("host", "path")))

    # A listed key may be asked for by a third of all urls: deal its rows over SALTS.
    named = known.withColumn("key", F.concat("host", "path")).join(hits, "key")
    named = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = tried.withColumn("salt", F.pmod(F.xxhash64("_host", "_path"), F.lit(SALTS)).cast("int"))
    fits = salted.join(named, ["key", "salt"]).filter("host = _suffix and path = _prefix")
    rank = F.struct("ruled", F.length("key").alias("n"), F.length("host").alias("h"), "verdict", "key")
    best = fits.groupBy("_host", "_path").agg(F.max(rank).alias("best"))
    judged = rows.join(best, ["_host", "_path"], "left")
    rule = F.when(F.col("best.ruled"), F.col("best.key"))
    return judged.select(*_out(plain, url), rule.alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


def _out(plain: list[str], url: str) -> list[Column]:
    return [*(F.col(f"`{c}`") for c in plain if c.lower() not in ("host", "path", "rule", "verdict")), F.col("_host").alias("host"), F.col("_path").alias("path")]
