"""Grouped rates, shares, extremes, distributions and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6, rounded
from larkspur.operators import aggregates as A
from larkspur.sources.readers import table

def _month():
    return F.month("o_orderdate").alias("month")


@query("A1", "SELECT count(*) AS n_rows, 11::bigint AS n_columns FROM lineitem")
def table_size(spark, sf):
    return A.table_size(table(spark, sf, "lineitem")).drop("n_partitions").withColumn("n_rows", F.col("n_rows").cast("bigint"))


@query("A1 X3", "SELECT count(*) AS n_rows, 16::bigint AS n_partitions FROM lineitem")
def partition_count(spark, sf):
    sizes = A.table_size(table(spark, sf, "lineitem").repartition(16))
    return sizes.select(F.col("n_rows").cast("bigint").alias("n_rows"), "n_partitions")


@query("A2", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def group_count(spark, sf):
    return A.group_count(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("A3", "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean_balance FROM customer GROUP BY 1")
def group_mean(spark, sf):
    out = A.group_mean(table(spark, sf, "customer"), ["c_mktsegment"], {"c_acctbal": "mean_balance"})
    return rounded(out, "mean_balance")


@query(
    "A4 O1",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS quantity, round(sum(l_extendedprice), 4) AS price
       FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2""",
)
def multi_sum(spark, sf):
    keys = ["l_returnflag", "l_linestatus"]
    out = A.group_sum(table(spark, sf, "lineitem"), keys, {"l_quantity": "quantity", "l_extendedprice": "price"})
    return out.withColumns({c: F.round(c, 4) for c in ("quantity", "price")}).orderBy(*keys)


@query(
    "A5 O1",
    """SELECT month(o_orderdate)::int AS month, round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 6) AS rate
       FROM orders GROUP BY 1 ORDER BY 1""",
)
def order_rate_by_month(spark, sf):
    finished = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return rounded(A.ratio_of_sums(table(spark, sf, "orders"), [_month()], finished, F.lit(1)), "rate").orderBy("month")


@query(
    "A6 C7",
    """SELECT l_returnflag, year(l_shipdate)::int AS year,
              CASE WHEN sum(greatest(l_quantity - 25, 0)) > 0 THEN round(sum(l_discount) / sum(greatest(l_quantity - 25, 0)), 6) END AS rate
       FROM lineitem GROUP BY 1, 2""",
)
def guarded_rate_by_year(spark, sf):
    keys = ["l_returnflag", F.year("l_shipdate").alias("year")]
    return rounded(A.guarded_ratio(table(spark, sf, "lineitem"), keys, "l_discount", F.col("l_quantity") - 25), "rate")


def _measures():
    return {"quantity": "l_quantity", "discount": F.col("l_discount") * 100, "tax": F.col("l_tax") * 1000}


_SUMS = """SELECT {key}, sum(l_quantity) AS quantity, sum(l_discount * 100) AS discount, sum(l_tax * 1000) AS tax FROM lineitem GROUP BY 1"""


@query(
    "A7",
    f"""SELECT year, round(quantity, 4) AS quantity, round(discount, 4) AS discount, round(tax, 4) AS tax, round(quantity + discount + tax, 4) AS total,
               round(quantity / (quantity + discount + tax), 6) AS share_quantity, round(discount / (quantity + discount + tax), 6) AS share_discount,
               round(tax / (quantity + discount + tax), 6) AS share_tax FROM ({_SUMS.format(key='year(l_shipdate)::int AS year')})""",
)
def share_of_total_by_year(spark, sf):
    out = A.shares(table(spark, sf, "lineitem"), [F.year("l_shipdate").alias("year")], _measures())
    out = out.withColumns({c: F.round(c, 4) for c in ("quantity", "discount", "tax", "total")})
    return rounded(out, "share_quantity", "share_discount", "share_tax")


@query("A8", f"SELECT month, round(quantity, 4) AS quantity, round(discount, 4) AS discount, round(tax, 4) AS tax FROM ({_SUMS.format(key='month(l_shipdate)::int AS month')})")
def seasonal_profile(spark, sf):
    out = table(spark, sf, "lineitem").groupBy(F.month("l_shipdate").alias("month")).agg(
        *[F.round(F.sum(c), 4).alias(n) for n, c in _measures().items()]
    )
    return out


@query(
    "A9",
    f"""SELECT year, CASE greatest(quantity, discount, tax) WHEN quantity THEN 'quantity' WHEN discount THEN 'discount' ELSE 'tax' END AS dominant,
               round(greatest(quantity, discount, tax) / (quantity + discount + tax), 6) AS share
        FROM ({_SUMS.format(key='year(l_shipdate)::int AS year')})""",
)
def dominant_measure(spark, sf):
    out = A.shares(table(spark, sf, "lineitem"), [F.year("l_shipdate").alias("year")], _measures())
    out = A.dominant_column(out, list(_measures()))
    return out.select("year", "dominant", r6(F.col("dominant_value") / F.col("total")).alias("share"))


@query(
    "A10",
    """WITH m AS (SELECT month(o_orderdate)::int AS month, round(avg(o_totalprice), 6) AS mean_price FROM orders GROUP BY 1)
       SELECT (SELECT month FROM m ORDER BY mean_price, month LIMIT 1) AS min_month, (SELECT min(mean_price) FROM m) AS min_mean_price,
              (SELECT month FROM m ORDER BY mean_price DESC, month LIMIT 1) AS max_month, (SELECT max(mean_price) FROM m) AS max_mean_price""",
)
def extreme_months(spark, sf):
    months = table(spark, sf, "orders").groupBy(_month()).agg(r6(F.avg("o_totalprice")).alias("mean_price"))
    return A.extreme_rows(months, "mean_price", "month")


@query(
    "A11 O2 O3",
    """SELECT l_partkey, round(sum(l_extendedprice), 4) AS revenue FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_parts(spark, sf):
    sums = A.group_sum(table(spark, sf, "lineitem"), ["l_partkey"], {"l_extendedprice": "revenue"})
    return A.top_groups(sums.withColumn("revenue", F.round("revenue", 4)), "revenue", 10, ["l_partkey"])


@query("A12 O3 O4", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "part"), "p_brand", 10)


def _describe_sql(cols: str, source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS stddev,
            min({c})::double AS "min", max({c})::double AS "max"{extra.format(c=c)} FROM {source}"""
        for c in cols.split()
    )


@query("A13 C13", _describe_sql("l_quantity l_extendedprice l_discount l_linenumber", "lineitem"))
def describe_long(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    return rounded(A.describe(table(spark, sf, "lineitem"), cols), "mean", "stddev")


@query(
    "A14",
    _describe_sql(
        "l_quantity l_discount", "lineitem",
        ", quantile_disc({c}, 0.25)::double AS q25, quantile_disc({c}, 0.5)::double AS q50, quantile_disc({c}, 0.75)::double AS q75",
    ),
)
def summary(spark, sf):
    return rounded(A.summary(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], 100_000), "mean", "stddev")


@query(
    "A17",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events), w AS (SELECT lo, (hi - lo) / 20.0::double AS w FROM b),
            h AS (SELECT least(floor((value - lo) / w), 19)::int AS bin, count(*) AS n FROM events, w GROUP BY 1)
       SELECT bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, n,
              round(n / ((SELECT count(*) FROM events) * w), 6) AS density FROM h, w""",
)
def histogram(spark, sf):
    return rounded(A.histogram(table(spark, sf, "events"), "value", 20, density=True), "bin_start", "bin_end", "density")


_Q = "round(quantile_cont({c}, {p}), 6)"


@query(
    "A18",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {p}::double AS prob, {_Q.format(c=c, p=p)}::double AS quantile FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount") for p in (0.25, 0.5, 0.75)
    ),
)
def quartiles(spark, sf):
    return rounded(A.exact_quantiles(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], keep=5_000), "quantile")


@query(
    "A18",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence,
            round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence, min({c})::double AS "min", max({c})::double AS "max",
            count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
            FROM events, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM events) GROUP BY q1, median, q3"""
        for c in ("value", "user_id")
    ),
)
def box_stats(spark, sf):
    out = A.box_stats(table(spark, sf, "events"), ["value", "user_id"])
    return rounded(out, "q1", "median", "q3", "lower_fence", "upper_fence")


@query(
    "A19",
    """SELECT round(avg(value), 6) AS mean, round(stddev(value), 6) AS stddev, round(avg(value) - 3 * stddev(value), 6) AS lower_limit,
              round(avg(value) + 3 * stddev(value), 6) AS upper_limit FROM events""",
)
def sigma_limits(spark, sf):
    return rounded(A.sigma_limits(table(spark, sf, "events"), "value"), "mean", "stddev", "lower_limit", "upper_limit")


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM {source}" for a in _CORR_COLS for b in _CORR_COLS
    )


@query("A20 A21", _corr_sql("lineitem"))
def pearson_matrix(spark, sf):
    return rounded(A.pearson_matrix(table(spark, sf, "lineitem"), _CORR_COLS), "corr")


@query("A21 S10", _corr_sql("lineitem"))
def pearson_matrix_ml(spark, sf):
    return rounded(A.pearson_matrix_ml(table(spark, sf, "lineitem"), _CORR_COLS), "corr")


_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::double AS {c}" for c in _CORR_COLS
)


@query("A22", f"WITH r AS (SELECT {_RANKS} FROM lineitem) " + _corr_sql("r"))
def spearman_matrix(spark, sf):
    return rounded(A.spearman_matrix(table(spark, sf, "lineitem"), _CORR_COLS), "corr")


_GAPPY = """SELECT *, CASE WHEN event_id % 7 = 0 THEN 'NaN'::double WHEN event_id % 11 = 0 THEN 'inf'::double WHEN event_id % 13 = 0 THEN NULL ELSE value END AS v,
       CASE WHEN event_id % 5 <> 0 THEN user_id END AS u FROM events"""


def _gappy(spark, sf):
    """Events with NaN, infinite and null values in ``v`` and nulls in ``u``."""
    spot = lambda n: F.col("event_id") % n == 0
    v = F.when(spot(7), float("nan")).when(spot(11), float("inf")).when(spot(13), None).otherwise(F.col("value"))
    return table(spark, sf, "events").withColumns({"v": v, "u": F.when(~spot(5), F.col("user_id"))})


@query(
    "A17",
    f"""WITH g AS ({_GAPPY}), f AS (SELECT v FROM g WHERE isfinite(v)), w AS (SELECT min(v) AS lo, (max(v) - min(v)) / 8.0::double AS w FROM f)
       SELECT least(floor((v - lo) / w), 7)::int AS bin, count(*) AS n, round(min(lo) + least(floor((v - lo) / w), 7) * min(w), 6) AS bin_start,
              round(min(lo) + (least(floor((v - lo) / w), 7) + 1) * min(w), 6) AS bin_end FROM f, w GROUP BY least(floor((v - lo) / w), 7)
       UNION ALL SELECT NULL, count(*), NULL, NULL FROM g WHERE NOT isfinite(v)""",
)
def histogram_gaps(spark, sf):
    """Bins of the finite values; NaN and infinite ones are counted apart."""
    return rounded(A.histogram(_gappy(spark, sf), "v", 8, others=True), "bin_start", "bin_end")


def _pair_sql(a: str, b: str) -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::double AS r{i}" for i, c in enumerate((a, b)))
    return f"SELECT '{a}' AS a, '{b}' AS b, round(corr(r0, r1), 6) AS corr FROM (SELECT {ranks} FROM g WHERE NOT isnan({a}) AND NOT isnan({b}) AND {a} IS NOT NULL AND {b} IS NOT NULL)"


_GAP_COLS = ["v", "u", "event_id"]


@query("A22", f"WITH g AS (SELECT v::double AS v, u::double AS u, event_id::double AS event_id FROM ({_GAPPY})) " + " UNION ALL ".join(_pair_sql(a, b) for a in _GAP_COLS for b in _GAP_COLS))
def spearman_gaps(spark, sf):
    """Rank correlation of columns with gaps, each pair over its common rows."""
    return rounded(A.spearman_matrix(_gappy(spark, sf), _GAP_COLS), "corr")


@query(
    "A23",
    """SELECT count(*) AS n_rows, round(avg(value), 6) AS mean_value, arg_max(value, (ts, event_id)) AS latest_value,
              arg_max(event_type, (ts, event_id)) AS latest_type FROM events""",
)
def kpi_row(spark, sf):
    out = A.latest_kpis(
        table(spark, sf, "events"), {"value": "mean_value"}, {"value": "latest_value", "event_type": "latest_type"}, ["ts", "event_id"]
    )
    return rounded(out, "mean_value")


@query(
    "A26",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
              count(*) FILTER (o_orderstatus = 'P') AS "P", 0::BIGINT AS other FROM orders GROUP BY 1""",
)
def contingency(spark, sf):
    return A.contingency(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "A26",
    """SELECT o_orderpriority, count(*) FILTER (s = 'F') AS "F", count(*) FILTER (s IS DISTINCT FROM 'F') AS rest
       FROM (SELECT o_orderpriority, nullif(o_orderstatus, 'O') AS s FROM orders) GROUP BY 1""",
)
def contingency_rest(spark, sf):
    """One listed value; all others and null are counted together."""
    rows = table(spark, sf, "orders").withColumn("s", F.nullif("o_orderstatus", F.lit("O")))
    return A.contingency(rows, "o_orderpriority", "s", ["F"], "rest")


@query(
    "A27 T14 C1",
    """WITH d AS (SELECT toxic, length(text)::double AS v FROM documents JOIN labels USING (doc_id)),
            w AS (SELECT min(v) AS lo, (max(v) - min(v)) / 10.0::double AS w FROM d)
       SELECT toxic, least(floor((v - lo) / w), 9)::int AS bin, count(*) AS n, round(min(lo) + least(floor((v - lo) / w), 9) * min(w), 6) AS bin_start,
              round(min(lo) + (least(floor((v - lo) / w), 9) + 1) * min(w), 6) AS bin_end FROM d, w GROUP BY toxic, least(floor((v - lo) / w), 9)""",
)
def text_length_hist(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.length("text").alias("n")).join(table(spark, sf, "labels"), "doc_id")
    return rounded(A.histogram(rows.withColumnRenamed("n", "size"), "size", 10, ["toxic"]), "bin_start", "bin_end")


@query(
    "A28",
    """SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id::varchar), vec_id) AS rn FROM embeddings) WHERE rn <= 5""",
)
def cluster_sample(spark, sf):
    return A.sample_per_group(table(spark, sf, "embeddings").select("label", "vec_id"), "label", "vec_id", 5)


@query(
    "A28",
    """SELECT label, "position", round(min(x), 6) AS "min", round(avg(x), 6) AS mean, round(max(x), 6) AS "max" FROM
       (SELECT label, (generate_subscripts(embedding, 1) - 1)::int AS "position", unnest(embedding)::double AS x FROM embeddings) GROUP BY 1, 2""",
)
def cluster_profile(spark, sf):
    rows = table(spark, sf, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("e"))
    return rounded(A.array_profile(rows, "label", "e"), "min", "mean", "max")


@query("O1 O2", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_quantity DESC, l_orderkey, l_linenumber")
def sorted_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rows.orderBy(F.desc("l_quantity"), "l_orderkey", "l_linenumber")
