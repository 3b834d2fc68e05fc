"""Stored versions with a Bloom filter of each file's keys, to read only the files that may hold a batch's keys.

``write_filtered`` writes a version and, beside it, filters for each named key: rows (file, word, bits).  A file's filter is
an array of ``words`` 64-bit words; a key sets four bits of one word.  The rows are sorted by word, so a small
batch reads the row groups of its words only (``word`` is pushed down as an IN list up to ``PUSHED`` values).

``rows_for`` joins the batch's keys with the filters and reads the files that come out: all rows whose key is in the
batch are among them, so a semi join, an anti join or ``constraints.validated_append`` on them
gives what it gives on the whole table.  A filter lets some files through in vain (about one in thirty at the
default size); it never hides a key.  A batch so large that most files hold one of its keys gains nothing: when
keys times files exceed ``MOST_PROBES``, the whole version is returned without probing.

NULLs count as values (UNIQUE compares NULL with NULL), so a NULL key finds the files that hold one.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.sources.sinks import write_version

#: Keys times files that a probe may compare.
MOST_PROBES = 1_000_000_000
#: Values of an IN list that is pushed to the scan of the filters.
PUSHED = 1_000
_FILTERS = "name string, file string, word bigint, bits bigint"
_ABOUT = "keys string, words bigint, files bigint, table_schema string"


def _word_and_mask(keys: Sequence[str], words: int | Column) -> tuple[Column, Column]:
    parts = [*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys]]  # Spark's hashes skip NULL inputs
    second, mask = F.xxhash64(F.lit("mask"), *parts), F.lit(0).cast("long")
    for i in range(4):
        place = F.pmod(F.shiftrightunsigned(second, 6 * i), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.pmod(F.xxhash64(*parts), F.lit(words) if isinstance(words, int) else words), mask


@dataclass(frozen=True)
class FilteredVersion:
    """A version in ``path`` and its filters; ``keys``: the columns of each named key."""

    path: str
    filters: str
    keys: Mapping[str, Sequence[str]]
    words: int
    n_files: int
    schema: T.StructType

    def rows(self, spark: SparkSession) -> DataFrame:
        """The whole version."""
        return spark.read.schema(self.schema).parquet(self.path)

    def files_for(self, batch: DataFrame, names: Sequence[str] | None = None) -> list[str] | None:
        """Files that may hold a key of the batch, by any of the named keys; None if probing would cost more than it can spare."""
        spark, found = batch.sparkSession, None
        for name in self.keys if names is None else names:
            types = {f.name: f.dataType for f in self.schema}
            typed = batch.select(*[F.col(k).cast(types[k]).alias(k) for k in self.keys[name]])  # hashes depend on the type
            word, mask = _word_and_mask(self.keys[name], self.words)
            wanted = typed.select(word.alias("word"), mask.alias("mask")).distinct()
            if wanted.count() * self.n_files > MOST_PROBES:
                return None
            some = [r.word for r in wanted.select("word").distinct().limit(PUSHED + 1).collect()]
            stored = spark.read.schema(_FILTERS).parquet(self.filters).filter(F.col("name") == name)
            if len(some) <= PUSHED:
                stored = stored.filter(F.col("word").isin(some) if some else F.lit(False))
            hits = stored.join(wanted, "word").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("file")
            found = hits if found is None else found.union(hits)
        return sorted(r.file for r in found.distinct().collect())  # file names of one version

    def rows_for(self, batch: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """Rows of the files that may hold a key of the batch."""
        spark, files = batch.sparkSession, self.files_for(batch, names)
        if files is None:
            return self.rows(spark)
        if not files:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*files)


def write_filtered(df: DataFrame, table_dir: str, version: int, keys: Mapping[str, Sequence[str]], bits_per_key: int = 12,
                   sort_within: Sequence[str] = ()) -> FilteredVersion:
    """Write ``df`` as a version with a filter for each named key; ``bits_per_key`` sizes the filters for the fullest file."""
    spark = df.sparkSession
    path = write_version(df, table_dir, version, sort_within=sort_within)
    stored = spark.read.schema(df.schema).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    sizes = stored.groupBy("_file").count().agg(F.max("count").alias("most"), F.count(F.lit(1)).alias("files")).first()
    words = 1 << max(0, ((sizes.most or 1) * bits_per_key // 64)).bit_length()
    made = None
    for name, columns in keys.items():
        word, mask = _word_and_mask(list(columns), words)
        # partial aggregation in the scan's tasks: a file's words leave them once per task
        part = stored.groupBy(F.col("_file").alias("file"), word.alias("word")).agg(F.bit_or(mask).alias("bits"))
        part = part.select(F.lit(name).alias("name"), "file", "word", "bits")
        made = part if made is None else made.unionByName(part)
    filters = f"{table_dir.rstrip('/')}/_filters/v={version}"
    made.repartitionByRange("name", "word").sortWithinPartitions("name", "word").write.mode("errorifexists").parquet(f"{filters}/rows")
    about = (json.dumps({n: list(c) for n, c in keys.items()}), words, sizes.files, df.schema.json())
    spark.createDataFrame([about], _ABOUT).coalesce(1).write.parquet(f"{filters}/about")
    return open_filtered(spark, table_dir, version)


def open_filtered(spark: SparkSession, table_dir: str, version: int) -> FilteredVersion:
    """A version that ``write_filtered`` wrote."""
    base = table_dir.rstrip("/")
    r = spark.read.schema(_ABOUT).parquet(f"{base}/_filters/v={version}/about").first()
    return FilteredVersion(f"{base}/v={version}", f"{base}/_filters/v={version}/rows", json.loads(r["keys"]), r.words, r.files, T.StructType.fromJson(json.loads(r.table_schema)))
