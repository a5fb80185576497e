"""Byte files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from gatewright.session import shared_dir

#: Hadoop's scheme names where Arrow uses another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def shared_uri(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one, as a URI that names its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, purpose))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def store(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, mark, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{mark}{rest}")


@contextlib.contextmanager
def writing(uri: str) -> Iterator[pa.NativeFile]:
    """A file that appears under its name only when it is complete, so a retried or doubled task does no harm."""
    where, path = store(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.attempt-{uuid.uuid4().hex}"
    with where.open_output_stream(attempt) as out:
        yield out
    where.move(attempt, path)


def reading(uri: str) -> pa.NativeFile:
    where, path = store(uri)
    return where.open_input_file(path)
