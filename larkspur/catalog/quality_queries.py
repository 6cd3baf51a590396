"""Missing data, cleaning rules and profiles.

The test tables have no gaps, so gaps are made from the event id; every row
of the table stays in the query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6, rounded
from larkspur.operators import quality as Q
from larkspur.sources.readers import table

_GAPPY = """SELECT event_id, user_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'nan'::double ELSE value END AS value FROM events"""


def gappy_events(spark, sf):
    i = F.col("event_id")
    value = F.when(i % 7 == 0, None).when(i % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.when(i % 11 != 0, F.col("event_type")).alias("event_type"), value.alias("value")
    )


def _long(names: str, measure: str, source: str, alias: str) -> str:
    arms = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {measure.format(c=c)} AS {alias} FROM g" for c in names.split())
    return f"WITH g AS ({source}) {arms}"


@query("Q1 Q3", _long("event_id user_id event_type value", "count(*) FILTER ({c} IS NULL)", _GAPPY, "missing"))
def null_counts(spark, sf):
    return Q.null_counts(gappy_events(spark, sf))


@query(
    "Q2 C6",
    f"""WITH g AS ({_GAPPY}) SELECT 'event_id' AS "column", count(*) FILTER (event_id IS NULL) AS missing FROM g
        UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM g
        UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM g
        UNION ALL SELECT 'value', count(*) FILTER (value IS NULL OR isnan(value)) FROM g""",
)
def missing_counts(spark, sf):
    return Q.missing_counts(gappy_events(spark, sf))


@query("Q4", _long("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax", "count(*) FILTER ({c} = 0)", "SELECT * FROM lineitem", "zeros"))
def zero_counts(spark, sf):
    return Q.zero_counts(table(spark, sf, "lineitem"))


@query("F6", f"WITH g AS ({_GAPPY}) SELECT event_id, user_id, event_type FROM g WHERE event_type IS NULL OR value IS NULL OR isnan(value)")
def rows_with_missing(spark, sf):
    return Q.rows_with_missing(gappy_events(spark, sf)).drop("value")


@query("F2", f"WITH g AS ({_GAPPY}) SELECT event_id, event_type FROM g WHERE event_type IS NOT NULL AND value IS NOT NULL")
def not_null_filter(spark, sf):
    rows = gappy_events(spark, sf)
    return rows.filter(F.col("event_type").isNotNull() & F.col("value").isNotNull()).select("event_id", "event_type")


@query("Q10 C6", f"WITH g AS ({_GAPPY}) SELECT event_id, value FROM g WHERE value IS NOT NULL AND NOT isnan(value)")
def drop_missing(spark, sf):
    return gappy_events(spark, sf).dropna(subset=["value"]).select("event_id", "value")


@query("Q5", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount FROM lineitem")
def zeros_to_missing(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return Q.zeros_to_missing(rows, ["l_discount"]).withColumn("l_discount", F.nanvl("l_discount", F.lit(None).cast("double")))


@query(
    "Q6",
    f"""WITH g AS ({_GAPPY}), m AS (SELECT avg(value) AS a FROM g WHERE NOT isnan(value))
        SELECT event_id, round(CASE WHEN value IS NULL OR isnan(value) THEN (SELECT a FROM m) ELSE value END, 6) AS value FROM g""",
)
def impute_mean(spark, sf):
    return rounded(Q.impute_mean(gappy_events(spark, sf).select("event_id", "value"), ["value"]), "value")


@query(
    "Q7",
    """SELECT event_id, coalesce(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END, 'Unknown') AS event_type,
              CASE WHEN event_id % 7 = 0 THEN 0 ELSE value END AS value FROM events""",
)
def fill_by_type(spark, sf):
    i = F.col("event_id")
    rows = table(spark, sf, "events").select(
        "event_id", F.when(i % 11 != 0, F.col("event_type")).alias("event_type"), F.when(i % 7 != 0, F.col("value")).alias("value")
    )
    return Q.fill_by_type(rows)


_DELAYS = """SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_discount,
    CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN NULL ELSE l_extendedprice END AS delayed FROM lineitem"""


def _delays(spark, sf):
    gap = (F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", F.when(~gap, F.col("l_extendedprice")).alias("delayed")
    )


@query(
    "Q8",
    f"""WITH g AS ({_DELAYS}) SELECT l_orderkey, l_linenumber,
        CASE WHEN delayed IS NULL AND l_discount = 0 THEN 0 WHEN delayed IS NULL AND l_tax = 0 THEN -1 ELSE delayed END AS delayed FROM g""",
)
def conditional_impute(spark, sf):
    rules = [(F.col("l_discount") == 0, 0.0), (F.col("l_tax") == 0, -1.0)]
    return Q.fill_when(_delays(spark, sf), "delayed", rules).select("l_orderkey", "l_linenumber", "delayed")


@query("F7", f"WITH g AS ({_DELAYS}) SELECT l_orderkey, l_linenumber FROM g WHERE delayed IS NULL AND l_quantity - 1 = 0")
def residual_gaps(spark, sf):
    rows = _delays(spark, sf).filter(F.col("delayed").isNull() & (F.col("l_quantity") - 1 == 0))
    return rows.select("l_orderkey", "l_linenumber")


@query("Q9 P10", "SELECT o_orderkey, coalesce(try_cast(left(o_orderpriority, 1 + o_orderkey % 2) AS double), 0) AS level FROM orders")
def numbers_or_zero(spark, sf):
    level = F.expr("left(o_orderpriority, cast(1 + o_orderkey % 2 as int))")
    return Q.numbers_or_zero(table(spark, sf, "orders").select("o_orderkey", level.alias("level")), ["level"])


@query("Q11", "SELECT event_id, CASE WHEN user_id % 10 = 0 THEN NULL ELSE round(value / (user_id % 10), 6) END AS ratio FROM events")
def infinities_to_null(spark, sf):
    part = F.col("user_id") % 10
    ratio = F.when(part == 0, F.lit(float("inf"))).otherwise(F.round(F.col("value") / F.nullif(part, F.lit(0)), 6))
    return Q.infinities_to_null(table(spark, sf, "events").select("event_id", ratio.alias("ratio")))


@query(
    "Q12",
    """SELECT l_returnflag, count(*) AS n, round(max(abs(l_extendedprice * (1 + l_tax) - (l_extendedprice + l_extendedprice * l_tax))), 6) AS worst,
              round(max(abs(l_extendedprice - l_quantity * 1000)), 6) AS gap FROM lineitem GROUP BY 1""",
)
def reconcile(spark, sf):
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    rows = Q.reconcile(table(spark, sf, "lineitem"), price * (1 + tax), [price, price * tax])
    rows = Q.reconcile(rows, price, [F.col("l_quantity") * 1000], "gap")
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), r6(F.max(F.abs("difference"))).alias("worst"), r6(F.max(F.abs("gap"))).alias("gap")
    )


@query(
    "Q13",
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS "value", count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""",
)
def column_values(spark, sf):
    return Q.column_values(table(spark, sf, "orders"))


@query("Q14", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "Q15 E15 A2",
    """SELECT toxic, count(*) AS n, round(count(*)::double / (SELECT count(*) FROM labels), 6) AS share FROM labels GROUP BY 1""",
)
def class_balance(spark, sf):
    labels = table(spark, sf, "labels")
    everything = labels.agg(F.count(F.lit(1))).scalar()
    n = F.count(F.lit(1))
    return labels.groupBy("toxic").agg(n.alias("n")).withColumn("share", r6(F.col("n").cast("double") / everything))


@query("Q16")
def approx_distinct(spark, sf):
    return Q.approx_distinct_counts(table(spark, sf, "lineitem"))


@query(
    "Q16 C13",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) > 0 AS close FROM lineitem" for c in ("l_suppkey", "l_linenumber", "l_returnflag")
    ),
)
def approx_distinct_error(spark, sf):
    """Approximate distinct counts lie within 10 % of the exact ones."""
    cols = ["l_suppkey", "l_linenumber", "l_returnflag"]
    rows = table(spark, sf, "lineitem")
    exact = Q.per_column(rows, {"exact": {c: F.count_distinct(c) for c in cols}})
    near = Q.approx_distinct_counts(rows.select(*cols), 0.02)
    return exact.join(near, "column").select("column", (F.abs(F.col("approx_distinct") / F.col("exact") - 1) < 0.1).alias("close"))
