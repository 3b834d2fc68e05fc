"""Reading governed tables (A-1, A-2, A-3, J-7)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from govframe.schemas import DRIVER

if TYPE_CHECKING:  # pragma: no cover
    from govframe.operators.security import AccessContext, PolicyRegistry


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def load_table(
    spark: SparkSession,
    base_dir: str | None,
    name: str,
    schema: T.StructType | None = None,
    registry: PolicyRegistry | None = None,
    ctx: AccessContext | None = None,
) -> DataFrame:
    """Scan one table with an explicit schema (or, with ``base_dir=None``, the catalogue table ``name``).

    With a ``registry`` and an access context the table's row policies are
    applied right here, on the scan, so every view built on top of the
    returned frame inherits them (policy injection below the view).
    Filters and projections added later still reach the Parquet reader.
    """
    if base_dir is None:  # a catalogue table (e.g. one written by write_bucketed)
        df = spark.table(name)
    else:
        schema = schema or DRIVER.get(name)
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(table_path(base_dir, name))
    if registry is not None:
        if ctx is None:
            raise ValueError("a policy registry needs an access context")
        df = registry.apply(name, df, ctx)
    return df


def rows(spark: SparkSession, schema: T.StructType | str, data: Iterable[Sequence]) -> DataFrame:
    """Inline row source (``VALUES`` list) with a fixed schema.

    The rows become one Arrow table, checked against the schema: a value of
    another type, or NULL in a NOT NULL column, raises ``TypeError`` whatever
    the number of rows.  Spark keeps the table as a local relation, so it
    knows the size and can broadcast a small one in a join.
    """
    st = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    data = [tuple(row) for row in data]
    if any(len(row) != len(st.fields) for row in data):
        raise TypeError(f"every row needs {len(st.fields)} values")
    columns = []
    for i, (field, kind) in enumerate(zip(st.fields, to_arrow_schema(st).types)):
        values = [row[i] for row in data]
        if not field.nullable and None in values:
            raise TypeError(f"column {field.name} is NOT NULL")
        if isinstance(field.dataType, T.IntegralType) and any(isinstance(v, bool) or not isinstance(v, int | None) for v in values):
            raise TypeError(f"column {field.name} takes whole numbers")
        try:
            columns.append(pa.array(values, kind))
        except (pa.ArrowException, TypeError, ValueError, OverflowError) as exc:
            raise TypeError(f"column {field.name}: {exc}") from exc
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=st.names), st)


def register_governed(spark: SparkSession, base_dir: str, names: Sequence[str], registry: PolicyRegistry,
                      ctx: AccessContext) -> dict[str, DataFrame]:
    """Register each table as a temporary view *with its row policies applied*.

    Plain ``spark.sql`` queries, and SQL views defined over these names,
    then see only the rows the principal in ``ctx`` may see: the policy sits
    under every query, as a security policy bound to the table would.
    Temporary views belong to the Spark session and capture ``ctx``: give
    each principal its own session, or register again when it changes.
    """
    out = {}
    for name in names:
        out[name] = load_table(spark, base_dir, name, registry=registry, ctx=ctx)
        out[name].createOrReplaceTempView(name)
    return out


def view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view and return it (SQL access)."""
    df.createOrReplaceTempView(name)
    return df
