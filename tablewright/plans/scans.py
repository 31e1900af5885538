"""Sources and sinks."""

from pyspark.sql import functions as F

from tablewright.plans.bindings import ITEM_SCHEMA, LOOPS
from tablewright.plans.registry import query
from tablewright.session import scratch_path
from tablewright.sources import readers as R
from tablewright.sources import writers as W

_ITEMS_SQL = """
SELECT l_orderkey, l_partkey, sum(l_quantity) AS quantity, count(*) AS n
FROM lineitem GROUP BY ALL
"""


def _items_from(table):
    item = F.explode(F.from_json("items", ITEM_SCHEMA)).alias("i")
    return (
        table.select("l_orderkey", item)
        .groupBy("l_orderkey", F.col("i.l_partkey").alias("l_partkey"))
        .agg(F.sum("i.l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))
    )


@query("scan_csv_schema", _ITEMS_SQL)
def scan_csv_schema(t):
    path = W.write_csv(t.order_items, scratch_path(t.spark, "items_csv"), sep=";")
    back = R.read_csv(t.spark, path, "l_orderkey bigint, page bigint, items string", sep=";")
    return _items_from(back)


@query(
    "scan_csv_multiline",
    "SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n FROM documents",
)
def scan_csv_multiline(t):
    path = W.write_csv(t.documents.select("doc_id", "lang", "text"), scratch_path(t.spark, "docs_csv"))
    back = R.read_csv(t.spark, path, "doc_id bigint, lang string, text string", multiline=True)
    return back.select(
        "doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n")
    )


@query(
    "scan_csv_infer",
    """
    SELECT o_orderkey, o_totalprice, o_orderpriority,
      CAST(o_orderkey AS BIGINT) + o_totalprice AS key_plus_price FROM orders
    """,
)
def scan_csv_infer(t):
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    path = W.write_csv(t.orders.select(*cols), scratch_path(t.spark, "orders_csv"))
    back = R.read_csv(t.spark, path, infer=True)
    return back.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        "o_totalprice",
        "o_orderpriority",
        (F.col("o_orderkey") + F.col("o_totalprice")).alias("key_plus_price"),
    )


@query("scan_parquet", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_parquet(t):
    return R.read_parquet(
        t.spark, f"{t.sf_dir}/customer.parquet", ["c_custkey", "c_name", "c_acctbal"]
    )


@query(
    "scan_loop_files",
    f"WITH {LOOPS} SELECT loop_id, t, round(pv, 4) AS pv, round(sp, 4) AS sp, round(op, 4) AS op FROM loops",
)
def scan_loop_files(t):
    loops = t.loops
    root = scratch_path(t.spark, "loops")
    # Two makes of logger: other column names, other column order.
    even = loops.filter(F.col("loop_id") % 2 == 0).select(
        "loop_id", F.col("t").alias("Time"), F.col("pv").alias("Ctl.PV"),
        F.col("sp").alias("Ctl.SP"), F.col("op").alias("Ctl.OP"),
    )
    odd = loops.filter(F.col("loop_id") % 2 == 1).select(
        "loop_id", F.col("op").alias("OP_out"), F.col("sp").alias("SP_set"),
        F.col("pv").alias("PV_meas"), F.col("t").alias("timestep"),
    )
    for name, part in (("a", even), ("b", odd)):
        part.hint("rebalance", "loop_id").write.partitionBy("loop_id").option("header", True).csv(f"{root}/{name}")
    back = R.read_loop_files(t.spark, root, r"loop_id=(\d+)")
    return back.select(
        "loop_id", F.col("t").cast("long").alias("t"), *[F.round(c, 4).alias(c) for c in ("pv", "sp", "op")]
    )


@query(
    "scan_html_pages",
    r"""
    SELECT page_id,
      nullif(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1), '') AS title,
      nullif(regexp_extract(html, '(?is)<img\b[^>]*?\balt="([^"]*)"', 1), '') AS first_alt,
      nullif(trim(regexp_replace(regexp_extract(html, '(?is)<div class="ad">(.*?)</div>', 1),
        '<[^>]*>', '', 'g')), '') AS ad_text
    FROM pages
    """,
)
def scan_html_pages(t):
    html = F.col("html")
    return t.pages.select(
        "page_id",
        R.html_field(html, "title").alias("title"),
        R.html_first_attr(html, "img", "alt").alias("first_alt"),
        R.html_class_text(html, "div", "ad").alias("ad_text"),
    )


@query(
    "html_elements",
    r"""
    WITH e AS (SELECT page_id, regexp_extract_all(html, '(?is)<div class="ad">(.*?)</div>', 1) AS xs FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS element, nullif(trim(regexp_replace(xs[i], '<[^>]*>', '', 'g')), '') AS text
    FROM (SELECT page_id, xs, unnest(range(1, len(xs) + 1)) AS i FROM e)
    """,
)
def html_elements(t):
    return R.html_elements(t.pages.select("page_id", "html"), "html", "div", "ad", {})


@query(
    "html_links",
    """
    SELECT page_id, href, count(*) AS n FROM (
      SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)
    WHERE suffix(href, 'on') GROUP BY ALL
    """,
)
def html_links(t):
    links = R.html_links(t.pages.select("page_id", "html"), "html", "on")
    return links.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


@query(
    "synthetic_table",
    """
    WITH a AS (
      SELECT o_orderkey,
        (o_orderkey % 1048576 + 42 * 7919 + 1) * 2654435761 % 4294967296 AS m1,
        (o_orderkey % 1048576 + 42 * 7919 + 2) * 2654435761 % 4294967296 AS m2 FROM orders),
    u AS (
      SELECT o_orderkey,
        (((m1 % 1048576) * 40503 + m1 // 1048576) % 1000003 + 1) / CAST(1000004 AS DOUBLE) AS u1,
        (((m2 % 1048576) * 40503 + m2 // 1048576) % 1000003 + 1) / CAST(1000004 AS DOUBLE) AS u2 FROM a)
    SELECT o_orderkey, round(u1, 6) AS uniform,
      round(sqrt(-2 * ln(u1)) * cos(2 * pi() * u2), 6) AS normal,
      CAST(u2 > 0.5 AS INTEGER) AS flag FROM u
    """,
)
def synthetic_table(t):
    made = R.synthetic_table(t.orders.select("o_orderkey"), "o_orderkey", seed=42)
    return made.select(
        "o_orderkey", F.round("uniform", 6).alias("uniform"), F.round("normal", 6).alias("normal"), "flag"
    )


@query(
    "sink_parquet",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def sink_parquet(t):
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    path = W.write_parquet(t.orders.select(*cols), scratch_path(t.spark, "orders_parquet"))
    return t.spark.read.parquet(path)


@query("sink_csv", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def sink_csv(t):
    cols = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
    path = W.write_csv(t.part.select(*cols), scratch_path(t.spark, "part_csv"))
    return R.read_csv(
        t.spark, path, "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
    )


@query(
    "sink_json_report",
    """
    SELECT 'o_totalprice' AS column_name, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders
    UNION ALL SELECT 'o_totalprice', 'min', min(o_totalprice) FROM orders
    UNION ALL SELECT 'o_totalprice', 'max', max(o_totalprice) FROM orders
    """,
)
def sink_json_report(t):
    stats = t.orders.agg(
        F.count("o_totalprice").cast("double").alias("rows"),
        F.min("o_totalprice").alias("min"),
        F.max("o_totalprice").alias("max"),
    )
    report = stats.unpivot([], ["rows", "min", "max"], "metric", "value").select(
        F.lit("o_totalprice").alias("column_name"), "metric", "value"
    )
    path = W.write_json_report(report, scratch_path(t.spark, "report_json"))
    return t.spark.read.schema("column_name string, metric string, value double").json(path)
