"""Snapshot chains: a full snapshot, incremental ones after it, and a restore that checks every link.

A link is a folder:

* ``data``      Parquet files in folders ``_bucket=<n>``; a key's bucket is its hash modulo ``buckets``.  The full
                link holds all rows, an incremental one the rows that are new or changed and the keys that went;
* ``tree``      fingerprints of the whole table as of that link: a leaf for each bucket (row count, sum and XOR of
                row hashes), and above them nodes that hash ``fanout`` nodes of the level below, up to one root;
* ``manifest``  path, length and SHA-256 of every data file;
* ``link``      one row: kind, the root of the link before, the own root, keys, shape and schema.

What a change costs follows the change.  The current table is read once for its leaves (a hash aggregate
to a row per bucket; its rows are not shuffled).  Walking down from the two roots finds the buckets that differ;
only their rows are read again, on both sides, and only these are shuffled for the comparison.  A restore
reads untouched buckets as they are and joins the others with the latest change of each key.

The trees and manifests that reach the driver have a row per bucket and node (``MOST_BUCKETS`` at most) or
are compared in Spark (files).  Keys must be unique and not NULL (``constraints.pk_violations``); other values may be NULL.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.sources.sinks import SnapshotError, _log_row, _now, snapshot_diff

BUCKET = "_bucket"
MOST_BUCKETS = 65_536
_LINK = ("kind string, parent_root string, root string, n_rows bigint, keys array<string>, buckets int, fanout int, table_schema string")
_TREE = "level int, node int, n_rows bigint, digest string"
Tree = dict[tuple[int, int], tuple[int, str]]


class DamagedSnapshot(RuntimeError):
    """A link that must not be used; ``reasons`` says why, one line each."""

    def __init__(self, path: str, reasons: Sequence[str]):
        super().__init__(f"{path}: " + "; ".join(reasons))
        self.path, self.reasons = path, list(reasons)


@dataclass(frozen=True)
class TreeShape:
    """Key columns, number of buckets, and nodes under one node.  All links of a chain share them."""

    keys: tuple[str, ...]
    buckets: int = 256
    fanout: int = 16

    def __post_init__(self):
        if not 1 <= self.buckets <= MOST_BUCKETS or self.fanout < 2:
            raise ValueError(f"1 to {MOST_BUCKETS} buckets, and two nodes or more under a node")

    @property
    def levels(self) -> int:
        """Levels above the leaves, up to the root."""
        n, wide = 0, 1
        while wide < self.buckets:
            n, wide = n + 1, wide * self.fanout
        return n

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


# -------------------------------------------------------- fingerprints ----

def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row, NULL flags included (Spark's hashes skip NULL inputs)."""
    parts = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def leaves(df: DataFrame, shape: TreeShape) -> DataFrame:
    """(node, n_rows, digest) of each bucket that has rows.  Sum and XOR do not depend on the rows' order."""
    one, two = row_hashes(df.columns)
    g = df.select(shape.bucket().alias("node"), one.alias("h1"), two.alias("h2")).groupBy("node").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h1").cast("decimal(20,0)")).alias("s"), F.bit_xor("h2").alias("x"))
    digest = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in ("n_rows", "s", "x")]), 256)
    return g.select("node", "n_rows", digest.alias("digest"))


def fingerprint_tree(df: DataFrame, shape: TreeShape) -> Tree:
    """(level, node) -> (rows, digest); level 0 are the leaves, the root is node 0 of the last level."""
    tree: Tree = {(0, r.node): (r.n_rows, r.digest) for r in leaves(df, shape).collect()}  # a row per bucket
    below = {node: v for (_, node), v in tree.items()}
    for level in range(1, shape.levels + 1):
        groups: dict[int, list[int]] = {}
        for node in sorted(below):
            groups.setdefault(node // shape.fanout, []).append(node)
        below = {up: (sum(below[n][0] for n in nodes), hashlib.sha256("|".join(f"{n}:{below[n][1]}" for n in nodes).encode()).hexdigest())
                 for up, nodes in groups.items()}
        tree |= {(level, node): v for node, v in below.items()}
    return tree


def root_of(tree: Tree, shape: TreeShape) -> str:
    """The root's digest; that of an empty table is the empty string."""
    return tree.get((shape.levels, 0), (0, ""))[1]


def changed_buckets(old: Tree, new: Tree, shape: TreeShape) -> list[int]:
    """Buckets whose rows differ, found from the roots downwards: equal nodes are not opened."""
    differs = [0] if old.get((shape.levels, 0)) != new.get((shape.levels, 0)) else []
    for level in range(shape.levels - 1, -1, -1):
        under = (n * shape.fanout + i for n in differs for i in range(shape.fanout))
        differs = [n for n in under if old.get((level, n)) != new.get((level, n))]
    return differs


# --------------------------------------------------------------- links ----

@dataclass(frozen=True)
class Link:
    """A written link, as its ``link`` row says."""

    path: str
    kind: str
    parent_root: str | None
    root: str
    n_rows: int
    shape: TreeShape
    schema: T.StructType

    @property
    def stored_schema(self) -> T.StructType:
        """The table's columns; an incremental link also has the kind of change."""
        more = [T.StructField("change_kind", T.StringType())] if self.kind == "DIFF" else []
        return T.StructType([*self.schema.fields, *more, T.StructField(BUCKET, T.IntegerType())])

    def rows(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """Stored rows, of some buckets only: the folders of the others are not listed as input."""
        df = spark.read.schema(self.stored_schema).parquet(f"{self.path}/data")
        return df if buckets is None else df.filter(F.col(BUCKET).isin(list(buckets)) if buckets else F.lit(False))

    def tree(self, spark: SparkSession) -> Tree:
        return {(r.level, r.node): (r.n_rows, r.digest) for r in spark.read.schema(_TREE).parquet(f"{self.path}/tree").collect()}


def open_link(spark: SparkSession, path: str) -> Link:
    """Read a link's own row; a folder without one was never finished."""
    try:
        r = spark.read.schema(_LINK).parquet(f"{path}/link").first()
    except Exception as exc:
        raise DamagedSnapshot(path, [f"no link row ({type(exc).__name__})"]) from exc
    if r is None:
        raise DamagedSnapshot(path, ["no link row"])
    return Link(path, r.kind, r.parent_root, r.root, r.n_rows, TreeShape(tuple(r["keys"]), r.buckets, r.fanout), T.StructType.fromJson(json.loads(r.table_schema)))


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, sha256) of a link's data files as they are now; the bytes are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{path}/data")
    leaf = f"/{path.rstrip('/').rpartition('/')[2]}/data/"
    return files.select(F.substring_index(F.col("path"), leaf, -1).alias("file"), "length", F.sha2("content", 256).alias("sha256"))


def _write_link(spark: SparkSession, path: str, rows: DataFrame, kind: str, parent: Link | None, tree: Tree | None, shape: TreeShape, schema: T.StructType) -> Link:
    stored = rows.withColumn(BUCKET, shape.bucket())
    # rows of a bucket meet in one file, or in several where they are many; the order makes key ranges readable alone
    (stored.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *shape.keys)
     .write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{path}/data"))
    if tree is None:  # a full link: the fingerprints are those of the rows as they were written
        tree = fingerprint_tree(spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{path}/data").select(*schema.names), shape)
    spark.createDataFrame([(lv, n, *v) for (lv, n), v in sorted(tree.items())], _TREE).coalesce(1).write.parquet(f"{path}/tree")
    data_files(spark, path).write.parquet(f"{path}/manifest")
    n_rows = tree.get((shape.levels, 0), (0, ""))[0]
    row = (kind, parent.root if parent else None, root_of(tree, shape), n_rows, list(shape.keys), shape.buckets, shape.fanout, schema.json())
    spark.createDataFrame([row], _LINK).coalesce(1).write.parquet(f"{path}/link")  # last: a link without it is not used
    return open_link(spark, path)


def write_full(df: DataFrame, base_path: str, db: str, as_of: _dt.datetime, shape: TreeShape) -> tuple[Link, DataFrame]:
    """The first link of a chain and its run-log row.  A failure raises ``SnapshotError`` with a FAILED row."""
    return _logged(df.sparkSession, "FULL", base_path, db, as_of,
                   lambda path: _write_link(df.sparkSession, path, df, "FULL", None, None, shape, df.schema))


def write_incremental(current: DataFrame, chain: Sequence[Link], base_path: str, db: str, as_of: _dt.datetime) -> tuple[Link, DataFrame]:
    """A link with the changes since the last one of ``chain``, and its run-log row.

    Only buckets whose fingerprints differ are compared; an unchanged table gives a link without rows.
    """
    spark, last = current.sparkSession, chain[-1]

    def write(path: str) -> Link:
        shape, schema = last.shape, last.schema
        now = current.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        tree = fingerprint_tree(now, shape)
        buckets = changed_buckets(last.tree(spark), tree, shape)
        part = now.filter(shape.bucket().isin(buckets) if buckets else F.lit(False))
        changes = snapshot_diff(part, restore_chain(spark, chain, buckets, check_files=False), list(shape.keys))
        return _write_link(spark, path, changes.select(*schema.names, "change_kind"), "DIFF", last, tree, shape, schema)

    return _logged(spark, "DIFF", base_path, db, as_of, write)


def _logged(spark: SparkSession, kind: str, base_path: str, db: str, as_of: _dt.datetime, write) -> tuple[Link, DataFrame]:
    path, start = f"{base_path.rstrip('/')}/{db}_{kind}_{as_of:%Y%m%d_%H%M%S}", _now()
    try:
        link = write(path)
    except Exception as exc:
        raise SnapshotError(str(exc), _log_row(spark, kind, path, start, _now(), "FAILED", str(exc))) from exc
    return link, _log_row(spark, kind, path, start, _now(), "SUCCESS", None)


# ------------------------------------------------------------- restore ----

#: Faults that an error message names; the check itself looks at every file.
NAMED = 5


def damaged_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason) of files that are MISSING, EXTRA, or differ in LENGTH or CHECKSUM from the manifest."""
    told = spark.read.schema("file string, length bigint, sha256 string").parquet(f"{path}/manifest").withColumn("told", F.lit(True))
    there = data_files(spark, path).select("file", F.col("length").alias("length_now"), F.col("sha256").alias("sha256_now"), F.lit(True).alias("there"))
    reason = (F.when(F.col("there").isNull(), "MISSING").when(F.col("told").isNull(), "EXTRA")
              .when(F.col("length") != F.col("length_now"), "LENGTH").when(F.col("sha256") != F.col("sha256_now"), "CHECKSUM"))
    return told.join(there, "file", "full_outer").select("file", reason.alias("reason")).filter("reason IS NOT NULL")


def check_link(spark: SparkSession, link: Link) -> None:
    """Raise ``DamagedSnapshot`` unless tree and data files are as they were written."""
    try:
        tree = link.tree(spark)
        bad = [f"{r.reason} {r.file}" for r in damaged_files(spark, link.path).orderBy("file").limit(NAMED).collect()]
    except Exception as exc:
        raise DamagedSnapshot(link.path, [f"unreadable ({type(exc).__name__})"]) from exc
    if root_of(tree, link.shape) != link.root:
        bad.append("the tree's root is not the link's")
    if bad:
        raise DamagedSnapshot(link.path, bad)


def check_order(chain: Sequence[Link]) -> None:
    """Raise ``DamagedSnapshot`` unless the chain is one full link and, after it, links that follow one another."""
    for i, link in enumerate(chain):
        if (link.kind == "FULL") != (i == 0):
            raise DamagedSnapshot(link.path, [f"link {i} is of kind {link.kind}"])
        if i and (link.parent_root != chain[i - 1].root or link.shape != chain[0].shape or link.schema != chain[0].schema):
            raise DamagedSnapshot(link.path, ["it does not follow the link before it"])


def restore_chain(spark: SparkSession, chain: Sequence[Link], buckets: Sequence[int] | None = None,
                  check_files: bool = True, check_rows: bool = False) -> DataFrame:
    """The table as of the chain's last link, or some buckets of it.

    The order of the links is always checked, their files unless ``check_files`` is off, and with ``check_rows`` also
    the restored rows against the last root.  A chain with a fault raises ``DamagedSnapshot``; nothing is restored from its sound links.
    """
    if not chain:
        raise ValueError("a chain has at least its full link")
    check_order(chain)
    if check_files:
        for link in chain:
            check_link(spark, link)
    full, shape, names = chain[0], chain[0].shape, chain[0].schema.names
    trees = [link.tree(spark) for link in chain] if len(chain) > 1 else []
    touched = {b for old, new in zip(trees, trees[1:]) for b in changed_buckets(old, new, shape)}
    if buckets is not None:
        touched &= set(buckets)
    if not touched:
        out = full.rows(spark, buckets).select(*names)
    else:
        rest = sorted(set(range(shape.buckets) if buckets is None else buckets) - touched)
        some = sorted(touched)
        parts = [d.rows(spark, some).withColumn("_seq", F.lit(i)) for i, d in enumerate(chain[1:])]
        changes = parts[0]
        for p in parts[1:]:
            changes = changes.unionByName(p)
        # the latest change of each key: one aggregate over all incremental links, whatever their number
        values = F.struct("change_kind", *[n for n in names if n not in shape.keys])
        latest = changes.groupBy(*shape.keys).agg(F.max_by(values, "_seq").alias("_v"))
        kept = full.rows(spark, some).select(*names).join(latest.select(*shape.keys), list(shape.keys), "left_anti")
        written = latest.filter("_v.change_kind != 'DELETE'").select(*[F.col(n) if n in shape.keys else F.col(f"_v.{n}").alias(n) for n in names])
        out = kept.select(*names).unionByName(written).unionByName(full.rows(spark, rest).select(*names))
    if check_rows and buckets is None and root_of(fingerprint_tree(out, shape), shape) != chain[-1].root:
        raise DamagedSnapshot(chain[-1].path, ["the restored rows do not have the link's root"])
    return out
