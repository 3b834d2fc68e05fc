"""The T-SQL-semantics helpers as SQL functions, for ``spark.sql`` users.

``register_sql_functions(spark)`` creates temporary SQL functions
(``CREATE TEMPORARY FUNCTION … RETURN expr``).  Catalyst inlines their
bodies, so a call plans exactly like the built-in expression it stands for:
no Python runs and literals fold away.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from govframe.functions import tsql

_UNITS = ("YEAR", "QUARTER", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")


def _datediff_body() -> str:
    cases = [f"WHEN '{u}' THEN timestampdiff({u}, date_trunc('{u}', a), date_trunc('{u}', b))" for u in _UNITS]
    # weeks are counted at Sunday boundaries: shift one day before truncating to Monday-based weeks
    cases.append("WHEN 'WEEK' THEN timestampdiff(WEEK, date_trunc('WEEK', a + INTERVAL 1 DAY), "
                 "date_trunc('WEEK', b + INTERVAL 1 DAY))")
    return "CASE upper(unit) " + " ".join(cases) + " END"


def _text(pattern: str) -> str:
    """A pattern as a raw SQL string literal (patterns hold double quotes but no single ones)."""
    return f"r'{pattern}'"


def _isjson_body() -> str:
    marked = f"regexp_replace(regexp_replace(x, {_text(tsql._JSON_STRING)}, chr(1)), {_text(tsql._JSON_NUMBER + '|true|false|null')}, chr(2))"
    marked = f"regexp_replace({marked}, {_text(tsql._JSON_SPACE)}, '')"
    depth = rf"greatest(length(regexp_replace({marked}, r'[^\[{{]', '')), 1)"
    reduced = f"aggregate(sequence(1, {depth}), {marked}, (acc, i) -> regexp_replace(acc, {_text(tsql._JSON_FLAT)}, chr(2)))"
    opens = _text(rf"\A{tsql._JSON_SPACE}*+[\[{{]")
    return rf"CASE WHEN x IS NULL THEN NULL WHEN NOT x RLIKE {opens} THEN false ELSE NOT x RLIKE r'[\x01\x02]' AND {reduced} = chr(2) END"


def _json_value_body() -> str:
    tokens = rf'({tsql._JSON_STRING}{tsql._JSON_SPACE}*+:)|"((?:[^"\\]|\\.)*+)"|({tsql._JSON_NUMBER}|true|false)'
    marked = f"regexp_replace(x, {_text(tokens)}, concat('$1', chr(1), '=$2$3', chr(1)))"
    marked = f"regexp_replace({marked}, concat('(:)', chr(1), '=', chr(1)), '$1')"
    found = f"get_json_object(replace({marked}, chr(1), '\"'), path)"
    return f"CASE WHEN ({_isjson_body()}) AND startswith({found}, '=') THEN substr({found}, 2) END"


SQL_FUNCTIONS = {
    "tsql_isjson": ("x STRING", "BOOLEAN", _isjson_body()),
    "tsql_json_value": ("x STRING, path STRING", "STRING", _json_value_body()),
    "tsql_datediff": ("unit STRING, a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", "BIGINT", _datediff_body()),
    "tsql_convert": (
        "style INT, ts TIMESTAMP_NTZ", "STRING",
        "CASE style WHEN 120 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
        "WHEN 112 THEN date_format(ts, 'yyyyMMdd') WHEN 108 THEN date_format(ts, 'HH:mm:ss') END",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in ``spark`` and return their names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
