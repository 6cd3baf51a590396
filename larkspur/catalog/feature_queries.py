"""Feature engineering."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6, rounded
from larkspur.operators.sampling import hash_bucket, hash_split
from larkspur.plans import features as G
from larkspur.sources.readers import table


def _positions(df, row_id: str, vector: str):
    return df.select(row_id, F.posexplode(vector_to_array(vector)).alias("position", "value"))


def _unpivot(select: str, source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f'SELECT {select}, {i} AS "position", {c} AS "value" FROM {source}' for i, c in enumerate(cols))


@query("G1", _unpivot("s_suppkey", "supplier", ["s_nationkey::double", "s_acctbal"]))
def assembled_vectors(spark, sf):
    rows = G.assembler(["s_nationkey", "s_acctbal"]).transform(table(spark, sf, "supplier"))
    return _positions(rows, "s_suppkey", "features")


@query("G1", _unpivot("s_suppkey", "supplier", ["s_nationkey::double", "CASE WHEN s_acctbal >= 0 THEN s_acctbal END"]))
def assembled_with_gaps(spark, sf):
    """Nulls kept as NaN by the assembler come back as null."""
    rows = table(spark, sf, "supplier").withColumn("s_acctbal", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")))
    out = _positions(G.assembler(["s_nationkey", "s_acctbal"], keep_invalid=True).transform(rows), "s_suppkey", "features")
    return out.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


@query(
    "G2",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev(c_acctbal) AS d, avg(c_nationkey) AS mn, stddev(c_nationkey) AS dn FROM customer)
       SELECT c_custkey, round((c_acctbal - m) / d, 6) AS c_acctbal_z, round((c_nationkey - mn) / dn, 6) AS c_nationkey_z FROM customer, s""",
)
def standardise(spark, sf):
    out = G.standardise(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    return rounded(out, "c_acctbal_z", "c_nationkey_z").select("c_custkey", "c_acctbal_z", "c_nationkey_z")


def _scaled(spark, sf, centre: bool):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"))
    stages = [G.assembler(["c_acctbal", "c_nationkey"], "raw"), G.scaler("raw", "scaled", centre)]
    out = Pipeline(stages=stages).fit(rows).transform(rows)
    return _positions(out, "c_custkey", "scaled").withColumn("value", r6("value"))


_STATS = "customer, (SELECT avg(c_acctbal) AS m, stddev(c_acctbal) AS d, avg(c_nationkey) AS mn, stddev(c_nationkey) AS dn FROM customer)"


@query("G2 G12", _unpivot("c_custkey", _STATS, ["round(c_acctbal / d, 6)", "round(c_nationkey / dn, 6)"]))
def unit_deviation(spark, sf):
    return _scaled(spark, sf, False)


@query("G2 G12", _unpivot("c_custkey", _STATS, ["round((c_acctbal - m) / d, 6)", "round((c_nationkey - mn) / dn, 6)"]))
def zscored_vectors(spark, sf):
    return _scaled(spark, sf, True)


def _index_sql(col: str, source: str, order: str) -> str:
    return f"SELECT {col}, count(*) AS n, row_number() OVER (ORDER BY {order}) - 1 AS \"index\" FROM {source} GROUP BY 1"


@query("G3", _index_sql("p_type", "part", "count(*) DESC, p_type"))
def category_index(spark, sf):
    return G.category_index(table(spark, sf, "part"), "p_type")


@query("G3", f"WITH i AS ({_index_sql('p_type', 'part', 'count(*) DESC, p_type')}) SELECT p_partkey, i.\"index\" AS type_index FROM part JOIN i USING (p_type)")
def indexed_rows(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_type")
    return G.with_category_index(rows, "p_type", "type_index").drop("p_type")


def _indexed_counts(spark, sf, alphabetical: bool):
    rows = table(spark, sf, "part").select("p_type")
    out = G.indexer("p_type", "i", alphabetical).fit(rows).transform(rows)
    return out.groupBy("p_type", F.col("i").cast("bigint").alias("index")).agg(F.count(F.lit(1)).alias("n"))


@query("G3", _index_sql("p_type", "part", "count(*) DESC, p_type"))
def frequency_indexer(spark, sf):
    return _indexed_counts(spark, sf, False)


@query("G4", _index_sql("p_type", "part", "p_type"))
def alphabetical_indexer(spark, sf):
    return _indexed_counts(spark, sf, True)


_SEGMENT = _index_sql("c_mktsegment", "customer", "count(*) DESC, c_mktsegment")


@query(
    "G5",
    f"""WITH i AS ({_SEGMENT}) SELECT c_custkey, i."index" AS "position" FROM customer JOIN i USING (c_mktsegment) WHERE i."index" < (SELECT max("index") FROM i)""",
)
def one_hot_long(spark, sf):
    return G.one_hot_long(table(spark, sf, "customer"), "c_custkey", "c_mktsegment")


@query(
    "G5 G6 G12",
    f"""WITH i AS ({_SEGMENT})
        SELECT c_custkey, i."index"::int AS "position", 1.0::double AS "value" FROM customer JOIN i USING (c_mktsegment) WHERE i."index" < (SELECT max("index") FROM i)
        UNION ALL SELECT c_custkey, (SELECT max("index") FROM i)::int, c_acctbal FROM customer WHERE c_acctbal <> 0
        UNION ALL SELECT c_custkey, (SELECT max("index") + 1 FROM i)::int, c_nationkey::double FROM customer WHERE c_nationkey <> 0""",
)
def mixed_features(spark, sf):
    """One pipeline: index and one-hot a string column, append numeric columns."""
    rows = table(spark, sf, "customer")
    out = G.mixed_features(["c_mktsegment"], ["c_acctbal", "c_nationkey"]).fit(rows).transform(rows)
    return G.sparse_entries(out, "c_custkey", "features")


@query(
    "G7",
    """WITH r AS (SELECT avg(CASE WHEN toxic = 1 THEN 0.0 ELSE 1.0 END::double) AS neg FROM labels)
       SELECT doc_id, toxic, round(CASE WHEN toxic = 1 THEN neg ELSE 1 - neg END, 6) AS weight FROM labels, r""",
)
def class_weights(spark, sf):
    return rounded(G.with_class_weights(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic"), "weight")


_TRAIN = """SELECT lang, source, (n_chars > 1500)::varchar AS long, quality FROM documents JOIN labels USING (doc_id)
    WHERE ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 100 < 80"""


def _chi_sql() -> str:
    arms = []
    for f in ("lang", "source", "long"):
        arms.append(
            f"""SELECT '{f}' AS feature, round(sum((coalesce(o, 0) - r * c / n) ** 2 / (r * c / n)), 4) AS statistic,
                ((count(DISTINCT v) - 1) * (count(DISTINCT q) - 1))::bigint AS degrees_of_freedom FROM
                (SELECT {f} AS v, count(*)::double AS r FROM t GROUP BY 1) a, (SELECT quality AS q, count(*)::double AS c FROM t GROUP BY 1) b,
                (SELECT count(*)::double AS n FROM t) s LEFT JOIN (SELECT {f} AS v2, quality AS q2, count(*)::double AS o FROM t GROUP BY 1, 2) x ON v = v2 AND q = q2"""
        )
    return f"WITH t AS ({_TRAIN}) " + " UNION ALL ".join(arms)


def _labelled(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", (F.col("n_chars") > 1500).cast("string").alias("long"))
    return rows.join(table(spark, sf, "labels"), "doc_id")


@query("G8", _chi_sql())
def chi_square(spark, sf):
    """Chi-square of each categorical feature against the label, on the training part only."""
    train = _labelled(spark, sf).filter(hash_bucket("doc_id") < 80)
    return G.chi_square(train, ["lang", "source", "long"], "quality").withColumn("statistic", F.round("statistic", 4))


@query("G8")
def chi_square_selection(spark, sf):
    """Features kept by the selector fitted on the training part, counted on the test part."""
    train, test = hash_split(_labelled(spark, sf), "doc_id")
    names = ["lang", "source", "long"]
    stages = [G.indexer(c, f"{c}_i", unseen="keep") for c in names]
    stages += [G.assembler([f"{c}_i" for c in names], "all"), G.feature_selector("all", "kept", "quality", mode="fpr", threshold=0.5)]
    model = Pipeline(stages=stages).fit(train)
    kept = model.stages[-1].selectedFeatures
    n = F.count(F.lit(1)).alias("n_test")
    return model.transform(test).agg(n, F.max(F.size(vector_to_array("kept"))).alias("width")).withColumn(
        "kept", F.lit(",".join(names[i] for i in sorted(kept)))
    )


@query("G9")
def anova_selection(spark, sf):
    """Embedding positions kept by the F test against the class."""
    rows = table(spark, sf, "embeddings").select(array_to_vector("embedding").alias("all"), "label")
    model = G.feature_selector("all", "kept", "label", continuous=True).fit(rows)
    return model.transform(rows).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector_to_array("kept"))).alias("width"))


@query("G10", _unpivot("vec_id", "embeddings", ["embedding[4]::double", "embedding[1]::double", "embedding[64]::double"]))
def vector_slice(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("all"))
    return _positions(G.vector_slice("all", "some", [3, 0, 63]).transform(rows), "vec_id", "some")


@query("G11")
def quantile_bins(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_extendedprice")
    out = G.quantile_bins("l_extendedprice", "bin", 4).fit(rows).transform(rows)
    return out.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))


@query("G13", f"""WITH i AS ({_SEGMENT}) SELECT 'c_mktsegment_index' AS "column", i."index"::double AS "index", c_mktsegment AS label FROM i""")
def label_names(spark, sf):
    rows = table(spark, sf, "customer").select("c_mktsegment")
    return G.label_names(Pipeline(stages=[G.indexer("c_mktsegment", "c_mktsegment_index")]).fit(rows), spark)
