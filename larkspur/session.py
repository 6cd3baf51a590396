"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}  # application id -> folder made for it
_SCRATCH: set[str] = set()

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "larkspur", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**_DEFAULTS, "spark.sql.shuffle.partitions": "8", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, read from ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder, deleted when Python
    exits; on a cluster an unset folder is an error, because a machine-local
    path would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table or model, in this application's folder under :func:`shared_dir`."""
    folder = f"{shared_dir(spark)}/larkspur/{spark.sparkContext.applicationId}"
    if folder not in _SCRATCH:
        _SCRATCH.add(folder)
        atexit.register(clear_scratch, spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under :func:`shared_dir` and read it back: computed once, and its lineage ends at files that outlive executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote with :func:`scratch_path`; called when Python exits if the session still runs."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/larkspur/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
