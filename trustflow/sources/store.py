"""Small control files on the cluster's file system, through Hadoop's API."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds; nothing happens where there is none."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def delete_all(spark: SparkSession, folder: str, names: list[str]) -> None:
    fs, _ = _fs(spark, folder)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        fs.delete(new_path(f"{folder}/{name}"), False)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without those that start with a dot or an underscore."""
    fs, p = _fs(spark, path)
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    names = [q.getName() for q in paths]
    return [n for n in names if n[0] not in "._"]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Exclusive create: an existing file is an error, never overwritten."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def replace_dir(spark: SparkSession, source: str, target: str) -> None:
    """Moves a finished folder into place; the old one is set aside, not mixed in."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    if fs.exists(dst):
        _, old = _fs(spark, source + "-replaced")
        if not fs.rename(dst, old):
            raise OSError(f"Cannot set {target} aside")
    if not fs.rename(src, dst):
        raise OSError(f"Cannot move {source} to {target}")


def create_json(spark: SparkSession, path: str, data: dict) -> None:
    create_text(spark, path, json.dumps(data, sort_keys=True, indent=2))


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))
