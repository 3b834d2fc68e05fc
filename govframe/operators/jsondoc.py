"""JSON attributes (L-1, L-2): admission check and property extraction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govframe.functions.tsql import is_json, json_marked, json_scalar


def json_violations(df: DataFrame, col: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows whose ``col`` fails ``ISJSON(col) = 1`` (NULL passes, like a CHECK)."""
    keep = list(keep) if keep is not None else df.columns
    return df.filter(~F.coalesce(is_json(col), F.lit(True))).select(*keep)


def json_props(df: DataFrame, col: str, paths: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """``JSON_VALUE(col, path) AS name`` for several paths (scalars only; NULL otherwise).

    Each document is checked and prepared once, whatever the number of paths.
    """
    marked = "_marked"
    while marked in df.columns:
        marked += "_"
    ready = df.select(*df.columns, json_marked(col).alias(marked))
    return ready.select(*keep, *[json_scalar(marked, path).alias(name) for name, path in paths.items()])
