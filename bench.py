"""Headline queries, each run to completion once; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from larkspur.catalog import ENTRIES
from larkspur.session import local_session

HEADLINES = [
    "order_rate_by_month", "share_of_total_by_year", "multi_sum", "top_parts", "describe_long", "summary", "histogram", "quartiles", "pearson_matrix",
    "spearman_matrix", "missing_counts", "column_values", "ohlcv_daily", "lags", "lags_by_user", "rolling_stats", "bar_features", "chrono_split",
    "global_row_numbers", "zscore_anomalies", "daily_return_anomalies", "clean_text", "term_counts", "tfidf_long", "top_terms", "stemmed_terms",
    "lemma_counts", "standardise", "indexed_rows", "chi_square", "confusion_counts", "roc_points", "auc", "linreg_family", "forecast",
    "text_logistic", "text_svm", "naive_bayes_multinomial", "kmeans_sweep", "decision_trees",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="bench", **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINES:
        started = time.perf_counter()
        ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
