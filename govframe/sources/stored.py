"""Results kept for other queries: written once per state of their inputs, found again, removed when superseded."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from govframe.session import shared_path
from govframe.sources.sinks import write_version

# (application, name, inputs) -> (state of the inputs, folder); a few entries, one per named result
_kept: dict[tuple, tuple[tuple, str]] = {}
_lock = threading.Lock()


def _hadoop_path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def input_state(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Name, length and time of change of every file of the inputs."""
    out = []
    for path in paths:
        fs, hpath = _hadoop_path(spark, path)
        files = fs.listFiles(hpath, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def stored_once(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame],
                sort_within: Sequence[str] = ()) -> DataFrame:
    """``build()`` as a stored version in the shared folder, written when the inputs' files have changed since it last was.

    Later calls of the same application read that version.  A version whose inputs have changed is
    removed after its successor is written; one that has been lost is built again.
    """
    key = (spark.sparkContext.applicationId, name, tuple(inputs))
    with _lock:  # two queries at once build it once
        state = input_state(spark, inputs)
        had = _kept.get(key)
        if had is not None and had[0] == state:
            fs, folder = _hadoop_path(spark, f"{had[1]}/_SUCCESS")
            if fs.exists(folder):
                return spark.read.parquet(had[1])
        frame = build()
        path = write_version(frame, shared_path(spark, name), 1, sort_within=sort_within)
        _kept[key] = (state, path)
        if had is not None:
            fs, folder = _hadoop_path(spark, had[1])
            fs.delete(folder, True)
        return spark.read.schema(frame.schema).parquet(path)
