"""Session settings, shared scratch tables and scoped configuration."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Fixed settings every job of this package is tuned for.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"
LOCAL_SCRATCH_CONF = "tierflow.scratch.dir"


def build_session(app_name: str = "tierflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the package defaults; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. On a cluster the setting is required, because a
    machine-local folder is not visible to other executors.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get(LOCAL_SCRATCH_CONF, None)
    if root is None:
        if not _is_local(spark):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tierflow-")
        spark.conf.set(LOCAL_SCRATCH_CONF, root)
    return root.rstrip("/")


def _session_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tierflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below this application's part of the shared scratch folder."""
    return f"{_session_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this application. Frames that still read one stop working."""
    delete_path(spark, _session_scratch(spark))


def _as_arrow(value, dtype: T.DataType):
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        return {field.name: _as_arrow(item, field.dataType) for field, item in zip(dtype.fields, value)}
    if isinstance(dtype, T.ArrayType):
        return [_as_arrow(item, dtype.elementType) for item in value]
    return value


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small driver-side table. Through Arrow it becomes a local relation: no Python worker, exact values."""
    records = [_as_arrow(row, schema) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)


def stage(df: DataFrame, label: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared scratch folder; the stored frame and its path.

    The written table cuts the lineage (lost executors only repeat the read), is columnar, so that later passes read
    just the columns they need, and gives the row count from file footers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """The stored frame of ``stage``; it stays until ``clear_scratch``."""
    return stage(df, label)[0]


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply ``settings`` for the actions inside the block and restore the previous values."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove one directory through the Hadoop file system that owns it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(hadoop_path)
