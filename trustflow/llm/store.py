"""Reading the given tables and keeping intermediate results in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only where it is unset (tests) a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="llm-shared-")
    return _own_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Writes a result once and reads it back: recovery does not repeat what led to it, and
    Catalyst knows its true size, so it broadcasts it only if that is under its own threshold."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """What is run inside is planned with these settings."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uri(path: str) -> str:
    """A path as a URI that pyarrow's file systems take."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        return "file:///" + path[len("file:/") :].lstrip("/")
    return path if "://" in path else f"file://{path}"
