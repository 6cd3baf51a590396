"""Projection, schema and column operators; filters."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6
from larkspur.functions.text import messages
from larkspur.operators import columns as C, quality as Q, sampling as X
from larkspur.sources.readers import table


@query(
    "P1 P2 C14",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
              round(l_extendedprice + l_quantity - l_tax, 6) AS mixed FROM lineitem""",
)
def derived_columns(spark, sf):
    price, cut, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r6(price * (1 - cut) * (1 + tax)).alias("charge"), r6(price + F.col("l_quantity") - tax).alias("mixed")
    )


@query("P3", 'SELECT n_nationkey AS id, n_name AS "name", n_regionkey FROM nation')
def rename_map(spark, sf):
    return C.rename(table(spark, sf, "nation"), {"n_nationkey": "id", "n_name": "name"})


@query("P4", "SELECT r_regionkey AS a, r_name AS b FROM region")
def rename_positional(spark, sf):
    return C.rename_positional(table(spark, sf, "region"), ["a", "b"])


@query(
    "P5",
    "SELECT s_suppkey AS supp_key, s_name AS supp_key_1, s_nationkey AS col_2nd_nation, s_acctbal AS blank FROM supplier",
)
def sanitise_names(spark, sf):
    raw = table(spark, sf, "supplier").toDF(" Supp-Key ", "supp  key", "2nd (nation)", "%%")
    return C.sanitise_names(raw)


@query("P6", "SELECT s_suppkey AS supp, s_acctbal AS bal FROM supplier")
def lower_names(spark, sf):
    return C.lower_names(table(spark, sf, "supplier").select(F.col("s_suppkey").alias(" Supp "), F.col("s_acctbal").alias("BAL")))


@query("P7 P8 C4", "SELECT p_partkey, p_type AS label, concat_ws(' ', p_name, p_brand) AS text FROM part")
def resolve_names(spark, sf):
    part = table(spark, sf, "part")
    label = C.resolve_column(part, ["class", "p_type", "p_brand"])
    text = C.resolve_columns(part, [("title", "description"), ("p_name", "p_brand"), ("p_name",)])
    return part.select("p_partkey", F.col(label).alias("label"), F.concat_ws(" ", *text).alias("text"))


@query("P9", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns(spark, sf):
    return table(spark, sf, "customer").drop("c_acctbal", "c_nationkey")


@query(
    "P10 C9",
    """SELECT o_orderkey, floor(o_totalprice + 0.5)::bigint AS whole, try_cast(o_orderpriority AS double) AS bad,
              epoch_ms((1325376000 + o_orderkey * 60) * 1000) AS at FROM orders""",
)
def cast_columns(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") + 0.5).alias("whole"), F.col("o_orderpriority").alias("bad"),
        C.epoch_to_timestamp(F.lit(1325376000) + F.col("o_orderkey") * 60).cast("timestamp_ntz").alias("at"),
    )
    orders = orders.withColumn("at", F.convert_timezone(None, F.lit("UTC"), "at"))
    return C.cast_columns(orders, {"whole": "bigint", "bad": "double"})


@query("P11", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def numeric_projection(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(*C.numeric_columns(customer))


@query("P11", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def string_projection(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    names = C.columns_of_type(lineitem, "string")
    return lineitem.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


@query("P12", "SELECT l_orderkey, l_partkey, l_linestatus, l_shipdate FROM lineitem")
def edge_columns(spark, sf):
    return C.edge_columns(table(spark, sf, "lineitem"), 2)


@query("P13", "SELECT n_nationkey, 'train' AS split, 1.0::double AS label FROM nation")
def constant_columns(spark, sf):
    return C.with_constants(table(spark, sf, "nation").select("n_nationkey"), {"split": "train", "label": 1.0})


@query("P14 C12", "SELECT c_custkey, c_name, round(c_acctbal / 7, 2) AS part FROM customer")
def round_columns(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", (F.col("c_acctbal") / 7).alias("part"))
    return C.round_columns(customer, 2)


@query(
    "P15 C12",
    """SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS "position", round(unnest(embedding)::double, 3) AS x FROM embeddings""",
)
def round_vectors(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    short = C.round_vectors(rows, "v", 3, keep=["vec_id"])
    return short.select("vec_id", F.posexplode("v_rounded").alias("position", "x")).withColumn("position", F.col("position").cast("bigint"))


@query("P16", "SELECT vec_id, round(embedding[1]::double, 6) AS first, round(embedding[64]::double, 6) AS last FROM embeddings")
def vector_element(spark, sf):
    v = array_to_vector("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", r6(C.vector_element(v, 0)).alias("first"), r6(C.vector_element(v, 63)).alias("last")
    )


@query(
    "P17 Q2",
    """SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'),
         (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string')) t("position", "name", "type"),
       LATERAL (SELECT CASE "name" WHEN 'o_orderkey' THEN count(*) FILTER (o_orderkey IS NULL) WHEN 'o_custkey' THEN count(*) FILTER (o_custkey IS NULL)
         WHEN 'o_orderstatus' THEN count(*) FILTER (o_orderstatus IS NULL) WHEN 'o_totalprice' THEN count(*) FILTER (o_totalprice IS NULL)
         WHEN 'o_orderdate' THEN count(*) FILTER (o_orderdate IS NULL) ELSE count(*) FILTER (o_orderpriority IS NULL) END AS missing FROM orders)""",
)
def schema_profile(spark, sf):
    """Schema of the orders table next to its missing counts."""
    orders = table(spark, sf, "orders")
    missing = Q.missing_counts(orders).withColumnRenamed("column", "name")
    return F.broadcast(C.schema_report(orders)).join(missing, "name").select("position", "name", "type", "missing")


@query("P18", "SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS month, count(*) AS n FROM orders GROUP BY 1")
def month_start(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return orders.groupBy(C.month_start("y", "m").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "P19",
    """SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END, 'other') AS status FROM orders""",
)
def map_values(spark, sf):
    names = {"F": "finished", "O": "open"}
    return table(spark, sf, "orders").select("o_orderkey", C.map_values("o_orderstatus", names, F.lit("other")).alias("status"))


# Filters


@query("F1", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_discount <= 0.02")
def compare_filter(spark, sf):
    rows = table(spark, sf, "lineitem").filter((F.col("l_quantity") > 45) & (F.col("l_discount") <= 0.02))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query("F3", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 100000")
def text_predicate(spark, sf):
    return table(spark, sf, "orders").where("o_orderstatus = 'F' and o_totalprice < 100000").select("o_orderkey")


@query(
    "F4 F5 C1",
    """SELECT c_custkey, lower(trim(c_mktsegment)) AS c_mktsegment, trim(c_name) AS c_name FROM customer
       WHERE lower(trim(c_mktsegment)) IN ('building', 'machinery') AND length(trim(c_name)) > 0""",
)
def message_filter(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    return messages(rows, "c_mktsegment", "c_name", ["building", "machinery"])


@query("F9 X6", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1")
def column_split(spark, sf):
    train, test = X.column_split(table(spark, sf, "orders"), "o_orderstatus", "F", "O")
    return X.union_named(train, test).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "F11",
    """SELECT count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'F') AS n_finished, count(*) FILTER (o_totalprice > 250000) AS n_large,
              round((count(*) FILTER (o_orderstatus = 'F'))::double / count(*), 6) AS share_finished,
              round((count(*) FILTER (o_totalprice > 250000))::double / count(*), 6) AS share_large FROM orders""",
)
def matching_share(spark, sf):
    orders = table(spark, sf, "orders")
    out = Q.matching_share(orders, finished=F.col("o_orderstatus") == "F", large=F.col("o_totalprice") > 250000)
    return out.withColumns({c: r6(c) for c in ("share_finished", "share_large")})
