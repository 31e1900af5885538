"""Projections, filters, recodes and scalar functions."""

from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.operators import aggs as G
from tablewright.operators import project as P
from tablewright.operators import series as S
from tablewright.plans.bindings import DAILY, DIRTY_ORDERS, DIRTY_PARTS, ITEM_SCHEMA
from tablewright.plans.registry import query


@query("select_columns", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def select_columns(t):
    return P.select_columns(t.orders, ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query("column_slice", "SELECT c_name, c_nationkey, c_acctbal FROM customer")
def column_slice(t):
    return P.column_slice(t.customer, "c_name", "c_acctbal")


@query(
    "drop_columns",
    "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def drop_columns(t):
    return P.drop_columns(t.customer, ["c_name", "c_comment"])


@query(
    "rename_columns",
    "SELECT s_suppkey AS supplier_id, s_name AS name, s_nationkey AS nation_key, s_acctbal AS s_acctbal FROM supplier",
)
def rename_columns(t):
    named = P.rename_columns(
        t.supplier, {"s_suppkey": "Supplier ID", "s_name": "Name", "s_nationkey": "Nation key"}
    )
    return P.snake_case_columns(named)


@query(
    "filter_predicate",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity > 30 AND (l_discount >= 0.05 OR l_returnflag = 'R')
    """,
)
def filter_predicate(t):
    cond = (F.col("l_quantity") > 30) & ((F.col("l_discount") >= 0.05) | (F.col("l_returnflag") == "R"))
    return P.filter_predicate(t.lineitem, cond).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )


@query(
    "range_filter",
    f"""
    WITH {DIRTY_ORDERS}
    SELECT o_orderkey, o_totalprice,
      (SELECT count(*) FROM dirty_orders WHERE NOT (o_totalprice BETWEEN 1000 AND 300000)) AS n_outside
    FROM dirty_orders WHERE o_totalprice IS NULL OR o_totalprice BETWEEN 1000 AND 300000
    """,
)
def range_filter(t):
    d = t.dirty_orders
    outside = P.range_violations(d, "o_totalprice", 1000, 300000).select("n_outside").scalar()
    kept = P.range_filter(d, "o_totalprice", 1000, 300000)
    return kept.select("o_orderkey", "o_totalprice", outside.alias("n_outside"))


@query(
    "isin_filter",
    "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase')",
)
def isin_filter(t):
    return P.isin_filter(t.events, "event_type", ["click", "purchase"]).select(
        "event_id", "event_type", "value"
    )


@query(
    "types_split",
    """
    SELECT column_name,
      CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric'
           WHEN column_type = 'VARCHAR' THEN 'string' ELSE 'other' END AS type_class
    FROM (DESCRIBE SELECT * FROM lineitem)
    """,
)
def types_split(t):
    return P.types_split(t.lineitem)


@query("clean_currency", "SELECT p_partkey, round(p_retailprice, 2) AS price FROM part")
def clean_currency(t):
    return P.clean_currency(t.dirty_parts, "p_price_text", "price").select("p_partkey", "price")


@query(
    "cast_columns",
    """
    SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS priority_no,
      CAST(floor(o_totalprice) AS BIGINT) AS price_units,
      TRY_CAST(o_orderstatus AS DOUBLE) AS bad_number FROM orders
    """,
)
def cast_columns(t):
    df = t.orders.select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("priority_no"),
        F.floor("o_totalprice").alias("price_units"),
        F.col("o_orderstatus").alias("bad_number"),
    )
    return P.cast_columns(df, {"priority_no": "int", "price_units": "long", "bad_number": "double"})


@query(
    "case_bucket",
    """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'basic'
      WHEN p_type IN ('PROMO', 'STANDARD') THEN 'shop' ELSE 'other' END AS type_group FROM part
    """,
)
def case_bucket(t):
    groups = {"basic": ["ECONOMY", "SMALL"], "shop": ["PROMO", "STANDARD"]}
    return t.part.select("p_partkey", P.case_bucket(F.col("p_type"), groups, "other").alias("type_group"))


@query(
    "flag_known",
    f"WITH {DIRTY_ORDERS} SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 0 ELSE 1 END AS price_known FROM dirty_orders",
)
def flag_known(t):
    return t.dirty_orders.select("o_orderkey", P.flag_known("o_totalprice").alias("price_known"))


@query(
    "derived_arith",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + l_linenumber + 1 AS parts_plus_one,
      round(l_extendedprice / nullif(l_quantity, 0), 8) AS unit_price,
      CASE WHEN l_quantity + l_linenumber + 1 = 3 THEN 1 ELSE 0 END AS is_three FROM lineitem
    """,
)
def derived_arith(t):
    total = F.col("l_quantity") + F.col("l_linenumber") + 1
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        total.alias("parts_plus_one"),
        F.round(F.try_divide("l_extendedprice", "l_quantity"), 8).alias("unit_price"),
        F.when(total == 3, 1).otherwise(0).alias("is_three"),
    )


@query(
    "map_values",
    f"""
    WITH {DIRTY_ORDERS} SELECT o_orderkey,
      CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 WHEN 'P' THEN 0 ELSE -1 END AS status_code
    FROM dirty_orders
    """,
)
def map_values(t):
    code = P.map_values(F.col("o_orderstatus"), {"F": 2, "O": 1, "P": 0}, -1)
    return t.dirty_orders.select("o_orderkey", code.alias("status_code"))


@query(
    "bin_numeric",
    """
    SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 15 THEN 'small'
      WHEN p_size > 15 AND p_size <= 35 THEN 'medium'
      WHEN p_size > 35 AND p_size <= 50 THEN 'large' END AS size_class FROM part
    """,
)
def bin_numeric(t):
    label = P.bin_numeric(F.col("p_size"), [0, 15, 35, 50], ["small", "medium", "large"])
    return t.part.select("p_partkey", label.alias("size_class"))


@query(
    "keyword_flag",
    """
    SELECT doc_id, CAST(coalesce(contains(lower(text), 'the') OR contains(lower(text), 'yes')
      OR contains(lower(text), 'eau (') , false) AS INTEGER) AS flagged FROM documents
    """,
)
def keyword_flag(t):
    return t.documents.select("doc_id", P.keyword_flag("text", ["the", "YES", "eau ("]).alias("flagged"))


# -- scalar functions ------------------------------------------------------


@query(
    "regex_extract_title",
    r"SELECT c_custkey, regexp_extract(c_name, '([A-Za-z]+)#', 1) AS title FROM customer",
)
def regex_extract_title(t):
    return t.customer.select("c_custkey", F.regexp_extract("c_name", r"([A-Za-z]+)#", 1).alias("title"))


@query(
    "text_normalize",
    "SELECT o_orderkey, replace(lower(trim(o_orderpriority)), ' ', '_') AS priority FROM orders",
)
def text_normalize(t):
    return t.orders.select("o_orderkey", P.text_normalize("o_orderpriority").alias("priority"))


@query(
    "split_part",
    """
    SELECT s_suppkey, split_part(s_name, '#', 1) AS kind, CAST(split_part(s_name, '#', 2) AS BIGINT) AS number,
      substr(s_name, 1, 3) AS short FROM supplier
    """,
)
def split_part(t):
    parts = F.split("s_name", "#")
    return t.supplier.select(
        "s_suppkey",
        parts[0].alias("kind"),
        parts[1].cast("long").alias("number"),
        F.substring("s_name", 1, 3).alias("short"),
    )


_PER_ORDER = """
SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS quantity,
  round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY ALL
"""


@query("json_parse", _PER_ORDER)
def json_parse(t):
    parsed = t.order_items.withColumn("i", A.json_items("items", ITEM_SCHEMA))

    def total(field):
        return F.aggregate("i", F.lit(0.0), lambda acc, x: acc + x[field])

    pages = parsed.select(
        "l_orderkey", F.size("i").alias("n"), total("l_quantity").alias("q"), total("l_extendedprice").alias("p")
    )
    return pages.groupBy("l_orderkey").agg(
        F.sum("n").cast("long").alias("n_items"), F.sum("q").alias("quantity"), F.round(F.sum("p"), 2).alias("price")
    )


@query(
    "array_transform_struct",
    """
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_partkey, l_quantity, l_extendedprice, l_linenumber) - 1 AS pos FROM lineitem)
    SELECT l_orderkey, pos // 10000 AS page,
      string_agg(l_partkey || ':' || CAST(l_quantity AS INTEGER), ',' ORDER BY pos) AS kept
    FROM n GROUP BY ALL
    """,
)
def array_transform_struct(t):
    kept = A.keep_fields(A.json_items("items", ITEM_SCHEMA), ["l_partkey", "l_quantity"])
    text = F.transform(
        kept, lambda x: F.concat_ws(":", x["l_partkey"], x["l_quantity"].cast("int"))
    )
    return t.order_items.select("l_orderkey", "page", F.array_join(text, ",").alias("kept"))


@query(
    "array_flatten",
    """
    WITH n AS (SELECT o_custkey, year(o_orderdate) AS order_year, l_partkey,
      row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY l_partkey) - 1 AS pos
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT o_custkey, order_year, pos // 10000 AS part, count(*) AS n_items,
      string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts
    FROM n GROUP BY ALL
    """,
)
def array_flatten(t):
    per_order = t.order_items.select(
        "l_orderkey", F.struct("l_orderkey", "page").alias("item"), F.from_json("items", ITEM_SCHEMA)["l_partkey"].alias("parts")
    )
    joined = t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", F.year("o_orderdate").alias("order_year"), "item", "parts"
    )
    lists = G.flatten_lists(joined, ["o_custkey", "order_year"], "parts", "item", "parts")
    return lists.select(
        "o_custkey",
        F.col("order_year").cast("long").alias("order_year"),
        "part",
        F.size("parts").cast("long").alias("n_items"),
        F.array_join("parts", ",").alias("parts"),
    )


@query(
    "array_explode",
    """
    SELECT l_orderkey, l_partkey, l_quantity, round(l_extendedprice, 2) AS l_extendedprice FROM lineitem
    """,
)
def array_explode(t):
    item = F.explode(A.json_items("items", ITEM_SCHEMA)).alias("i")
    return t.order_items.select("l_orderkey", item).select(
        "l_orderkey", "i.l_partkey", "i.l_quantity", F.round("i.l_extendedprice", 2).alias("l_extendedprice")
    )


@query(
    "array_slice",
    """
    SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY rn) AS first_three FROM (
      SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_partkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
    WHERE rn <= 3 GROUP BY l_orderkey
    """,
)
def array_slice(t):
    first = F.slice(A.json_items("items", ITEM_SCHEMA)["l_partkey"], 1, 3)
    return t.order_items.filter("page = 0").select("l_orderkey", F.array_join(first, ",").alias("first_three"))


@query(
    "map_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      CASE l_returnflag WHEN 'A' THEN 0.5 WHEN 'N' THEN 1.5 WHEN 'R' THEN 2.25 END::DOUBLE AS weight
    FROM lineitem
    """,
)
def map_lookup(t):
    weights = F.create_map(
        F.lit("A"), F.lit(0.5), F.lit("N"), F.lit(1.5), F.lit("R"), F.lit(2.25)
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", weights[F.col("l_returnflag")].alias("weight")
    )


@query(
    "date_parts",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(year(o_orderdate) AS INTEGER) AS y,
      CAST(month(o_orderdate) AS INTEGER) AS m FROM orders
    """,
)
def date_parts(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    d = F.to_date("day", "yyyy-MM-dd")
    return text.select("o_orderkey", "day", F.year(d).alias("y"), F.month(d).alias("m"))


@query(
    "business_days",
    f"""
    WITH {DAILY}
    SELECT series_id, t, n FROM daily WHERE isodow(DATE '1970-01-01' + CAST(t AS INTEGER)) < 6
    """,
)
def business_days(t):
    days = t.daily.withColumn("day", F.date_from_unix_date(F.col("t").cast("int")))
    return S.business_days(days, "day").select("series_id", "t", "n")


@query(
    "fourier_terms",
    f"""
    WITH {DAILY}
    SELECT series_id, t, round(sin(2 * pi() * t / 7), 4) AS sin_1, round(cos(2 * pi() * t / 7), 4) AS cos_1,
      round(sin(4 * pi() * t / 7), 4) AS sin_2, round(cos(4 * pi() * t / 7), 4) AS cos_2 FROM daily
    """,
)
def fourier_terms(t):
    wave = S.fourier_terms(t.daily, "t", 7, 2)
    return wave.select(
        "series_id", "t", *[F.round(c, 4).alias(c) for c in ("sin_1", "cos_1", "sin_2", "cos_2")]
    )


@query(
    "vector_to_array_cols",
    """
    SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS f0, round(CAST(embedding[64] AS DOUBLE), 6) AS f63,
      round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings
    """,
)
def vector_to_array_cols(t):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    doubles = F.transform("embedding", lambda x: x.cast("double"))
    back = t.embeddings.select("vec_id", vector_to_array(array_to_vector(doubles)).alias("a"))
    return back.select(
        "vec_id",
        F.round(F.col("a")[0], 6).alias("f0"),
        F.round(F.element_at("a", -1), 6).alias("f63"),
        F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 4).alias("total"),
    )


@query(
    "euclidean_distance",
    """
    SELECT vec_id, round(sqrt(list_sum(list_transform(embedding,
      lambda x: pow(CAST(x AS DOUBLE) - 0.1, 2)))), 4) AS dist FROM embeddings
    """,
)
def euclidean_distance(t):
    point = F.transform("embedding", lambda x: F.lit(0.1))
    return t.embeddings.select(
        "vec_id", F.round(A.euclidean_distance(F.col("embedding"), point), 4).alias("dist")
    )
