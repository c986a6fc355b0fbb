"""Folders of any file system that Spark reads: listing, publishing by rename, small notes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from blotter.session import checkpoint_dir


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, written: str, final: str) -> None:
    """Move a fully written folder to its final name in one step; an error if that name is taken."""
    jvm = spark._jvm
    source, fs = _path(spark, written)
    target, _ = _path(spark, final)
    fs.mkdirs(target.getParent())
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)


def note(spark: SparkSession, path: str, content: dict) -> None:
    """A small JSON file that appears whole or not at all; an error if it is there."""
    hidden = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    p, fs = _path(spark, hidden)
    out = fs.create(p, True)
    try:
        out.write(json.dumps(content).encode())
    finally:
        out.close()
    publish(spark, hidden, path)


def read_note(spark: SparkSession, path: str) -> dict:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        raw = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return json.loads(bytes(raw).decode())


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder in the shared checkpoint folder, deleted at the end."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete(spark, folder)
