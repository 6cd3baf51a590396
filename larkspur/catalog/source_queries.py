"""Scans, sinks and previews."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.catalog.registry import query, r6
from larkspur.operators import columns as C
from larkspur.plans import features as G, models as M
from larkspur.session import scratch_path
from larkspur.sources import readers as S


@query("S1 S2", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "customer-csv")
    S.table(spark, sf, "customer").write.option("header", True).csv(path)
    return S.read_csv(
        spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", mode="FAILFAST"
    )


@query("S1", "SELECT s_nationkey, count(*) AS n, round(sum(s_acctbal), 6) AS balance FROM supplier GROUP BY 1")
def csv_inferred(spark, sf):
    path = scratch_path(spark, "supplier-csv")
    S.table(spark, sf, "supplier").write.option("header", True).csv(path)
    return S.read_csv(spark, path).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("s_acctbal")).alias("balance"))


@query("S3 P4", "SELECT c_mktsegment AS label, c_name AS message FROM customer")
def tsv_scan(spark, sf):
    path = scratch_path(spark, "customer-tsv")
    S.table(spark, sf, "customer").select("c_mktsegment", "c_name").write.option("sep", "\t").csv(path)
    return S.read_tsv(spark, path, ["label", "message"])


@query(
    "S4 P13",
    """SELECT CASE WHEN item_id % 5 = 0 THEN 'split=test' ELSE 'split=train' END AS split,
              CASE WHEN length(text) > 200 THEN 1.0 ELSE 0.0 END::double AS label, md5(trim(text)) AS text_md5
       FROM benchmark""",
)
def corpus_scan(spark, sf):
    """One file per benchmark item, read back whole with split and class taken from the folder.

    The query writes its own corpus, so it makes as many files as the table has
    items: the operator is a scan with one row per file.
    """
    root = scratch_path(spark, "corpus")
    items = S.table(spark, sf, "benchmark").select(
        F.when(F.col("item_id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.when(F.length("text") > 200, "long").otherwise("short").alias("size"),
        "text",
    )
    items.write.option("maxRecordsPerFile", 1).partitionBy("split", "size").text(root)
    corpus = S.read_corpus(spark, root, ["split=train", "split=test"], {"size=long": 1.0, "size=short": 0.0})
    return corpus.select("split", "label", F.md5(F.regexp_replace("text_raw", r"^ +|[ \n]+$", "")).alias("text_md5"))


_STATUS = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1"


@query(
    "S5 S6 S8 S9 P19",
    f"""SELECT s.o_orderstatus, CASE s.o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status,
               CASE s.o_orderstatus WHEN 'O' THEN 2 WHEN 'P' THEN 1 ELSE 0 END AS urgency,
               s.o_orderstatus <> 'F' AS active, n FROM ({_STATUS}) s""",
)
def local_rows(spark, sf):
    """Literal tables (DDL schema, names only, dictionaries) used as lookups of the orders table."""
    names = S.local_rows(spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, status string")
    urgency = S.local_rows(spark, [("F", 0), ("O", 2), ("P", 1)], ["o_orderstatus", "urgency"])
    active = S.local_records(
        spark, [{"o_orderstatus": "F", "active": False}, {"o_orderstatus": "O", "active": True}, {"o_orderstatus": "P", "active": True}]
    )
    counts = S.table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    key = "o_orderstatus"
    return counts.join(names, key).join(urgency, key).join(active, key).withColumn("urgency", F.col("urgency").cast("int"))


@query("S7", "SELECT o_orderpriority, ascii(o_orderpriority) - 48 AS level, count(*) AS n FROM orders GROUP BY 1, 2")
def pandas_rows(spark, sf):
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    levels = S.from_pandas(spark, pd.DataFrame({"o_orderpriority": names, "level": range(1, 6)}), "o_orderpriority string, level int")
    counts = S.table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(levels), "o_orderpriority")


@query("S12 M1", "SELECT count(*) AS n_rows, 0::bigint AS n_changed FROM lineitem")
def stages_roundtrip(spark, sf):
    """An unfitted pipeline gives the same predictions after being saved and loaded."""
    rows = S.table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    stages = [G.assembler(["l_quantity", "l_discount"], "features"), M.linear("l_extendedprice")]
    original = Pipeline(stages=stages)
    loaded = S.load_pipeline(S.save_pipeline(original, scratch_path(spark, "pipeline")))
    with M.held(rows) as kept:
        first, second = original.fit(kept), loaded.fit(kept)
    again = second.transform(first.transform(rows).withColumnRenamed("prediction", "before").drop("features"))
    changed = F.abs(F.col("prediction") - F.col("before")) > 1e-6
    return again.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(changed).alias("n_changed"))


@query("S13", "SELECT count(*) AS n_rows, 0::bigint AS n_changed FROM embeddings")
def model_roundtrip(spark, sf):
    """A fitted clustering scores every row as before once saved and loaded."""
    points = S.table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("features"))
    model = Pipeline(stages=[M.kmeans(5)]).fit(points)
    loaded = S.load_model(S.save_pipeline(model, scratch_path(spark, "model")))
    both = loaded.transform(model.transform(points).withColumnRenamed("prediction", "before"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") != F.col("before")).alias("n_changed"))


@query("S15 W13", "SELECT * FROM (SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100) ORDER BY ts, event_id")
def last_rows(spark, sf):
    return C.last_rows(S.table(spark, sf, "events").select("event_id", "ts", "value"), 100, ["ts", "event_id"])


@query("S16", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 1")
def first_row(spark, sf):
    return C.first_row(S.table(spark, sf, "events").select("event_id", "ts", "value"), ["ts", "event_id"])


@query("S14 S17", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer ORDER BY 1, 2 LIMIT 20")
def preview(spark, sf):
    cols = ["c_mktsegment", "c_nationkey"]
    return C.preview(S.table(spark, sf, "customer"), *cols, n=20, distinct=True, order_by=cols)
