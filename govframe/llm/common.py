"""Small helpers shared by the operators of this subpackage.

Texts reach Python as Arrow batches and are handled as UTF-8 bytes.  ``bytes.split()`` cuts
at exactly ``[\\x20\\x09-\\x0D]`` and ``bytes.lower()`` changes exactly A-Z, so words need no
regular expression.  Hashes are 64 bits wide and the same in every worker.
"""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.session import ensure_checkpoint_dir

#: Rows of an Arrow batch that are turned into Python objects at once (a memory bound, no result depends on it).
SLICE_ROWS = 256

PACKAGE_ZIP = "govframe-package.zip"
_FULL = (1 << 64) - 1
#: Odd multiplier of the rolling hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns, turned into Python objects a slice at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield from zip(*(c.slice(at, SLICE_ROWS).to_pylist() for c in columns), strict=True)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package, once per context, wherever the workers run."""
    sc = spark.sparkContext
    if any(f.endswith(f"/{PACKAGE_ZIP}") for f in sc.listFiles):
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.TemporaryDirectory(prefix="govframe-package-")  # the driver serves it from here until it ends
    atexit.register(folder.cleanup)
    with zipfile.ZipFile(path := f"{folder.name}/{PACKAGE_ZIP}", "w") as z:
        for f in sorted(root.glob("govframe/**/*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(path)


#: Rows of an Arrow batch while the session has Spark's default of 10,000: whole texts make batches large.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: What a worker keeps between the tasks of one operator.
_kept: dict = {}


def kept_in_worker(key, make: Callable[[], object]):
    """The object that ``make`` makes once per worker; tasks of ``arrow_map(..., keeps=True)`` find it again."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, and batches small enough for whole texts."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:  # the worker may have served another operator before
            _kept.clear()
        yield from run(batches)

    return df.mapInArrow(task, schema)


def map_texts(df: DataFrame, per_row: Callable[[Iterator[tuple]], Iterator[tuple]], fields: list[tuple[str, str, pa.DataType]], *columns: str, keeps: bool = False) -> DataFrame:
    """``per_row`` over the rows of ``columns`` of each partition; ``fields``: name, Spark type, Arrow type of the result."""
    schema = pa.schema([(n, t) for n, _, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(per_row(rows_of(batches, *columns)), schema)

    return arrow_map(df.select(*columns), run, ", ".join(f"`{n}` {t}" for n, t, _ in fields), keeps)


def as_bytes(column: str = "text"):
    """The UTF-8 bytes of a text column."""
    return F.col(column).cast("binary")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


#: Makes Spark remove a query's shuffle files when the query has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written once to the cluster's shared checkpoint folder; the shuffle files that led to it go."""
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)


def compact(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A written table with a partition for each ``rows`` rows at most, so that small tables take few tasks."""
    return df.coalesce(max(1, -(-df.count() // rows)))


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered for up to ``bound`` words at a time."""

    def __init__(self, bound: int = 120_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Hashes of all runs of consecutive symbols of one sequence, from prefix sums modulo 2**64."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        if len(Rolling._powers) <= n:
            size = 1 << (n + 1).bit_length()
            for name, base in (("_powers", BASE), ("_inverse", BASE_INV)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(Rolling, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * Rolling._powers[:n], out=self.sums[1:])

    def grams(self, g: int) -> np.ndarray:
        """Hash of each run of ``g`` symbols."""
        m = max(0, len(self.sums) - g)
        return mix((self.sums[g : g + m] - self.sums[:m]) * Rolling._inverse[:m])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each run from ``starts`` to ``ends``, its length included."""
        return mix((self.sums[ends] - self.sums[starts]) * Rolling._inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values (prefix and suffix minima of blocks of ``w``)."""
    n = len(a)
    padded = np.full(-(-n // w) * w, np.uint64(_FULL))
    padded[:n] = a
    blocks = padded.reshape(-1, w)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[: n - w + 1], prefix[w - 1 : n])


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions of 0..n that some run from ``starts`` to ``ends`` covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


#: Bits of the largest bitmap that is broadcast (8 MB).
MOST_BITS = 1 << 26


def bitmap(hashes: DataFrame, bits: int, column: str = "hash") -> bytes:
    """Bitmap of a column of 64-bit hashes, built by Spark; its size is fixed by ``bits``."""
    place = F.pmod(column, F.lit(bits)) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bytes"))
    out, width = bytearray(max(bits // 8, 4096)), 4096
    for row in parts.collect():  # at most bits / 32768 rows of 4 KB
        out[(row.bucket - 1) * width : row.bucket * width] = row.bytes
    return bytes(out[: bits // 8])


def unpacked(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)


def named_by(spark: SparkSession, rows: DataFrame, ids: DataFrame, id_col: str, named: bool = True) -> DataFrame:
    """Rows whose id may be (or with ``named=False`` cannot be) among ``ids``, told by a bitmap.

    The bitmap has 16 bits an id up to MOST_BITS; beyond that more rows pass than need to, and a
    join afterwards decides.  It only spares the shuffle of rows that certainly have no partner.
    """
    n = ids.count()
    bits = min(MOST_BITS, max(1 << 18, 1 << (16 * n).bit_length()))
    shared = spark.sparkContext.broadcast(bitmap(ids.select(F.xxhash64(F.coalesce(F.col(ids.columns[0]).cast("long"), F.lit(0))).alias("hash")), bits))
    hashed = rows.withColumn(fresh("_id_hash", rows), F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(0))))  # a null id shares a bit with 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = unpacked(shared.value)
        for batch in batches:
            hit = member[batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False) % bits]
            yield batch.filter(pa.array(hit == named)).select(list(range(batch.num_columns - 1)))

    return arrow_map(hashed, run, rows.schema)
