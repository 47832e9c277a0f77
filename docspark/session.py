"""Session helpers: recommended settings, shared work folder, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import docspark

# Document cells are large: Arrow batches of few rows keep the Python workers' memory flat,
# beside the bound on their bytes that Spark sets by itself.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.session.timeZone": "UTC",
    # decode() knows all charsets of the JVM, and puts a replacement for bytes that are none of theirs.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}

# A broadcast side may hold at most this many rows; beyond it the join is left to shuffle.
BROADCAST_ROW_LIMIT = 1_000_000

_LOCAL_WORK_DIR: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library is tuned for (all of them runtime settings).

    The helpers that run in Python workers travel with the plan, so that executors do not
    need the package installed.
    """
    cloudpickle.register_pickle_by_value(docspark)
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the one the cluster names in ``spark.checkpoint.dir``.

    Executors that are lost can only be replaced when the folder is shared, so a
    machine-local folder is used in local mode alone.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK_DIR:
        _LOCAL_WORK_DIR[app] = tempfile.mkdtemp(prefix="docspark-")
    return _LOCAL_WORK_DIR[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the work folder and read it back.

    This cuts the lineage, survives lost executors, and unlike ``checkpoint()`` keeps
    column pruning and filter pushdown for the readers. ``codec`` names another compression
    than the session's, for tables of texts.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast only after counting the side; past the limit Spark shuffles it.

    Call it on written tables, where the count comes from file footers. A shuffled join
    stays whole under skew because adaptive execution splits the hot partitions.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
