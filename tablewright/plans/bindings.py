"""The given tables, the views derived from them, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.ordering import dense_index, step_window
from tablewright.operators.sampling import hash_percent as split_bucket  # noqa: F401
from tablewright.operators.series import fill_steps
from tablewright.operators.skew import attach, bounded_parts, in_pages

ITEM_SCHEMA = "array<struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>>"


class Tables:
    """Lazy access: ``tables.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- derived views ----------------------------------------------------
    @property
    def dirty_orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.orders.select(
            "o_orderkey",
            "o_custkey",
            F.when(key % 13 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
            F.when(key % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
            F.when(key % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        )

    @property
    def dirty_parts(self) -> DataFrame:
        return self.part.select(
            "p_partkey",
            "p_name",
            "p_brand",
            F.when(F.col("p_partkey") % 9 == 0, 0).otherwise(F.col("p_size")).alias("p_size"),
            F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("p_price_text"),
        )

    @property
    def order_items(self) -> DataFrame:
        """Orders as the JSON feed has them: arrays of items in order of their fields.

        A page holds ``skew.CHUNK`` items, so an order of ordinary size is one row
        (page 0) and no order has to fit in one value.
        """
        fields = ["l_partkey", "l_quantity", "l_extendedprice"]
        lines = self.lineitem.select("l_orderkey", "l_linenumber", *fields)
        dealt = in_pages(lines, ["l_orderkey"], [*fields, "l_linenumber"], parts=bounded_parts(lines))
        return dealt.groupBy("l_orderkey", "page").agg(
            F.to_json(F.array_sort(F.collect_list(F.struct(*fields)))).alias("items")
        )

    @property
    def daily(self) -> DataFrame:
        """(series_id, t, n, value): events per type and day, days since 1970, no gaps."""
        cells = self.events.groupBy(
            F.col("event_type").alias("series_id"),
            F.unix_date(F.to_date("ts")).cast("long").alias("t"),
        ).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
        return fill_steps(cells, ["series_id"], "t").na.fill(0, ["n"]).na.fill(0.0, ["value"])

    @property
    def monthly(self) -> DataFrame:
        """(series_id, t, value): order totals per priority and month, month = 12 * year + m - 1."""
        cells = self.orders.groupBy(
            F.col("o_orderpriority").alias("series_id"),
            (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("long").alias("t"),
        ).agg(F.sum("o_totalprice").alias("value"))
        return fill_steps(cells, ["series_id"], "t").na.fill(0.0, ["value"])

    @property
    def quarter_hours(self) -> DataFrame:
        """(series_id, t, value): mean value per type and quarter hour; empty cells are absent."""
        return self.events.groupBy(
            F.col("event_type").alias("series_id"),
            F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 900).alias("t"),
        ).agg(F.avg("value").alias("value"))

    @property
    def loops(self) -> DataFrame:
        """(loop_id, t, pv, sp, op): events dealt to 20 signals, t = 0, 1, ... within each."""
        rows = self.events.select(
            (F.col("user_id") % 20).alias("loop_id"), "ts", "event_id", F.col("value").alias("pv")
        )
        setpoint = rows.groupBy("loop_id").agg(F.avg("pv").alias("sp"))
        indexed = dense_index(rows, ["loop_id"], ["ts", "event_id"]).drop("ts", "event_id")
        moved = step_window(
            indexed,
            ["loop_id"],
            "t",
            lambda w: {"op": F.avg("pv").over(w.rowsBetween(-2, 0))},
            before=2,
        )
        return attach(moved, setpoint, ["loop_id"]).select("loop_id", "t", "pv", "sp", "op")


def SPLIT_SQL(key: str) -> str:
    """``split_bucket`` as SQL."""
    return f"CAST(floor((({key} % 2147483648) * 2654435761 % 4294967296) * 100 / 4294967296) AS BIGINT)"


DIRTY_ORDERS = """dirty_orders AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders)"""

DIRTY_PARTS = """dirty_parts AS (
  SELECT p_partkey, p_name, p_brand,
    CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE p_size END AS p_size
  FROM part)"""

DAILY = """d0 AS (
  SELECT event_type AS series_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS t,
    count(*) AS n, sum(value) AS value FROM events GROUP BY ALL),
daily AS (
  SELECT series_id, t, coalesce(n, 0) AS n, coalesce(value, 0) AS value
  FROM (SELECT series_id, unnest(range(min(t), max(t) + 1)) AS t FROM d0 GROUP BY series_id) g
  LEFT JOIN d0 USING (series_id, t))"""

MONTHLY = """m0 AS (
  SELECT o_orderpriority AS series_id, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS t,
    sum(o_totalprice) AS value FROM orders GROUP BY ALL),
monthly AS (
  SELECT series_id, t, coalesce(value, 0) AS value
  FROM (SELECT series_id, unnest(range(min(t), max(t) + 1)) AS t FROM m0 GROUP BY series_id) g
  LEFT JOIN m0 USING (series_id, t))"""

QUARTER_HOURS = """quarter_hours AS (
  SELECT event_type AS series_id, CAST(floor(epoch_us(ts) / 1000000 / 900) AS BIGINT) AS t,
    avg(value) AS value FROM events GROUP BY ALL)"""

LOOPS = """l0 AS (
  SELECT user_id % 20 AS loop_id,
    row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) - 1 AS t, value AS pv
  FROM events),
loops AS (
  SELECT loop_id, t, pv, avg(pv) OVER (PARTITION BY loop_id) AS sp,
    avg(pv) OVER (PARTITION BY loop_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS op
  FROM l0)"""
