"""Scalar expressions (T-SQL semantics on built-in Spark functions)."""

from govframe.functions.tsql import (
    CONVERT_STYLES,
    add_interval,
    ceil_int,
    ci,
    convert_ts,
    datediff_boundary,
    is_json,
    json_marked,
    json_scalar,
    json_value,
    like_to_regex,
    like_tsql,
    plus,
    snapshot_path,
    ts_literal,
)

__all__ = [
    "CONVERT_STYLES", "add_interval", "ceil_int", "ci", "convert_ts", "datediff_boundary", "is_json",
    "json_marked", "json_scalar", "json_value", "like_to_regex", "like_tsql", "plus", "snapshot_path", "ts_literal",
]
