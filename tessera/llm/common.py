"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import gc
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where the driver
    has it. On a cluster it is installed on the nodes or sent with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([*have, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: lineage is
    cut, the rows are computed once, and Spark's commit keeps only the output of
    successful task attempts, so lost executors do not matter."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that do not clash with those of ``df``
    (Spark compares column names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def col(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df[f"`{name}`"]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same for pure ASCII and is much
    faster there; other texts go through ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
            .otherwise(F.translate(text, upper, upper.lower()))


def bounded_broadcast(df: DataFrame, max_rows: int, bytes_per_row: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark ``df`` for broadcast only when a bounded count proves at most
    ``max_bytes``; otherwise return it unchanged, for a shuffled join.

    ``bytes_per_row`` must be an upper bound that the caller's schema ensures."""
    bound = min(max_rows, max_bytes // bytes_per_row)
    if df.limit(bound + 1).count() <= bound:
        return F.broadcast(df)
    return df


def local_path(path: str) -> str:
    """A plain path for ``file:`` URIs, else the URI itself (for pyarrow.fs)."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path


def open_fs(path: str):
    """(filesystem, path) of pyarrow for a path in the shared folder."""
    from pyarrow import fs
    p = local_path(path)
    if "://" in p:
        return fs.FileSystem.from_uri(p)
    return fs.LocalFileSystem(), p


def make_dir(path: str) -> None:
    f, p = open_fs(path)
    f.create_dir(p, recursive=True)


def join_path(base: str, *parts: str) -> str:
    return os.path.join(base.rstrip("/"), *parts)


@contextlib.contextmanager
def no_gc():
    """Hold Python's cycle collector while many small acyclic objects are made;
    its passes over them would cost more than the work itself."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def trim_memory() -> None:
    """Give freed memory of this process back to the system, where its C library can.
    A reused Python worker otherwise keeps the peak of its largest batch."""
    import ctypes
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass
