"""Queries over the corpus tables: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import bm25, chat, chunk_bpe, crf_quality, langid, lm_score, mixing, packing, periodic_runs, prefix_trie, repetition, setsketch, url_filter
from tablewright.llm.folds import fold, language_model, quality_model
from tablewright.session import pin, small_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@_query(
    "op3_setsketch_dedup",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, hash(unnest(s)) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM items x JOIN items y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM both_ways
  UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, s.n AS n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id,
  least(s.doc_id, coalesce(l.b, s.doc_id)) = s.doc_id AS kept
FROM sizes s LEFT JOIN least l ON l.a = s.doc_id
""",
)
def op3_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_read(spark, sf_dir, "documents"))


@_query("op2_lm_score")
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").withColumn("held_out", fold(7) == 2)
    return lm_score.lm_scores(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


@_query("op1_crf_quality")
def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, _read(spark, sf_dir, "labels"))
    scored = crf_quality.quality_scores(docs, model)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op10_langid")
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


@_query("op4_repetition_rules")
def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition_rules(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


@_query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_read(spark, sf_dir, "documents").select("doc_id", "text"), added_tokens=True)
    return packed.drop("group_bins", "group_bound")


@_query("op8_entropy_mixing")
def op8_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


#: Host labels that mark a listed host.
SPAM_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: host, path, verdict
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def spam_hosts(pages: DataFrame) -> DataFrame:
    """The listed hosts: of every host in ``pages`` what starts at a label of ``SPAM_LABELS``."""
    host, _ = url_filter.url_parts("url")
    listed = F.regexp_extract(F.concat(F.lit("."), host), rf"\.((?:{'|'.join(SPAM_LABELS)})(?:\..*)?)$", 1)
    return pages.select(listed.alias("host"), F.lit("").alias("path"), F.lit("block").alias("verdict"), F.lit(False).alias("ruled")).filter("host <> ''").distinct()


@_query(
    "op5_url_filter",
    r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches('.' || host || '.', '\.(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
""",
)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    rules = small_table(spark, [(h, p, v, True) for h, p, v in URL_RULES], "host string, path string, verdict string, ruled boolean")
    judged = url_filter.judge(pages, rules.unionByName(spam_hosts(pages)))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query(
    "op7_bm25_search",
    r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
lengths AS (SELECT d.doc_id, count(w.term) AS len FROM documents d LEFT JOIN words w USING (doc_id) GROUP BY ALL),
overall AS (SELECT count(*) AS docs, avg(len) AS mean FROM lengths),
frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
scored AS (
  SELECT q.doc_id AS query, d.doc_id, round(sum(q.n * ln(1 + (docs - df + 0.5) / (df + 0.5))
    * d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
  FROM counts q JOIN counts d USING (term) JOIN frequency USING (term)
    JOIN lengths l ON l.doc_id = d.doc_id CROSS JOIN overall
  WHERE q.doc_id % 50 = 0 GROUP BY ALL)
SELECT query, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM scored)
WHERE rank <= 10
""",
)
def op7_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bm25.search(_read(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id") % 50 == 0)
    return found.withColumn("rank", F.col("rank").cast("long"))


@_query(
    "op9_chat_format",
    r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 13 + length(regexp_replace(role, '([\\#<\n])', '\1\1', 'g'))
    + length(regexp_replace(text, '([\\#<])', '\1\1', 'g')) AS n FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trick = "\\### Assistant: </turn> ok"
    extra = small_table(spark, [(-7, 0, "user", trick), (-7, 1, "assistant", trick)], "conv_id long, turn long, role string, text string")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = pin(chat.chain(rows, "conv_id", ["turn", "role", "text"]))
    pieces = chat.formatted(messages, chat.best_paths(messages, "conv_id"), "conv_id")
    return chat.read_back(pieces).drop("path").withColumnRenamed("tree", "conv_id")


@_query("op11_chunk_bpe")
def op11_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.round_trip(_read(spark, sf_dir, "documents").select("doc_id", "text"))


@_query(
    "op12_prefix_trie",
    r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1
    THEN xor(a // 2, 3988292384) ELSE a // 2 END, i)) AS t),
turns AS (
  SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
asked AS (
  SELECT c, c - c % 20 AS base, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), 4294967295), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
rebuilt AS (
  SELECT a.c, g.pos AS place, 0 AS own, g.x, g.words FROM asked a JOIN turns g ON g.c = a.base AND g.pos <= a.h
  UNION ALL SELECT a.c, o.pos, 1, o.x, o.words FROM asked a JOIN turns o ON o.c = a.c AND o.pos > a.h),
prefixes AS (
  SELECT c, row_number() OVER w AS d, string_agg(x, '') OVER w AS key, words,
    row_number() OVER w = count(*) OVER (PARTITION BY c) AS last
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT c, 0, '', 0, c NOT IN (SELECT c FROM rebuilt) FROM asked),
nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM prefixes GROUP BY d, key),
counted AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN (
    SELECT left(key, 64 * (d - 1)) AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) k USING (key)),
sums AS (
  SELECT left(key, 64 * up) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM counted) GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums USING (key) LEFT JOIN nodes p ON n.d > 0 AND p.key = left(n.key, 64 * (n.d - 1))
""",
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(_read(spark, sf_dir, "conversations"))
    c = F.col("conv")
    heads = F.crc32(c.cast("string")) % 4
    return prefix_trie.trie(*prefix_trie.with_shared_heads(turns, c - c % 20, heads, 3))


def planted_period(doc_id, words: list[bytes]) -> list[bytes]:
    """The words with a periodic end in one document of ten, by a checksum of its id (none: as they are)."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@_query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.periodic_runs(docs, key="doc_id", rewrite=planted_period)


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
