"""Reading tables, delimited files, text corpora and local rows; writing and reading models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.operators.columns import rename_positional


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True, **options) -> DataFrame:
    """CSV with a declared DDL schema; without one the types are inferred by an extra pass."""
    reader = spark.read.option("header", header).options(**options)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_tsv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Tab-separated text columns without a header, named by position."""
    raw = spark.read.options(sep="\t", header=False, inferSchema=False).csv(path)
    return rename_positional(raw, names)


def read_corpus(
    spark: SparkSession, root: str, splits: Sequence[str], labels: Mapping[str, float]
) -> DataFrame:
    """One row per file under ``root/<split>/<class>/*.txt`` with path, text, split, class and label.

    Spark's file sources give no row for a file of zero bytes.
    """
    paths = [f"{root}/{s}/{c}/*.txt" for s in splits for c in labels]
    path = F.col("_metadata.file_path")
    part = lambda i: F.element_at(F.split(path, "/"), -i)
    files = spark.read.text(paths, wholetext=True).select(
        path.alias("file_path"), F.col("value").alias("text_raw"), part(3).alias("split"), part(2).alias("sentiment")
    )
    label = F.element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), F.col("sentiment"))
    return files.withColumn("label", label.cast("double"))


def local_rows(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    """Small literal tables: rows with a DDL schema, or with names only."""
    return spark.createDataFrame(list(rows), schema)


def local_records(spark: SparkSession, records: Sequence[Mapping[str, object]]) -> DataFrame:
    """Small literal tables from dictionaries."""
    return spark.createDataFrame([dict(r) for r in records])


def from_pandas(spark: SparkSession, frame, schema: str | None = None) -> DataFrame:
    return spark.createDataFrame(frame, schema) if schema else spark.createDataFrame(frame)


def save_pipeline(pipeline: Pipeline | PipelineModel, path: str) -> str:
    pipeline.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> Pipeline:
    return Pipeline.load(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
