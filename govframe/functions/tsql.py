"""Column expressions with the SQL-Server semantics the governed model relies on.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- LIKE ----

_REGEX_META = set(".^$*+?()[]{}|\\")


def like_to_regex(pattern: str) -> str:
    """Translate a SQL-Server ``LIKE`` pattern into an anchored Java regex.

    ``%`` -> any run of characters (newlines included), ``_`` -> one
    character, ``[abc]`` / ``[a-z]`` / ``[^x]`` -> a character class.
    Everything else is literal.  The result must match the whole string.
    """
    out: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch == "[":
            close = pattern.find("]", i + 1)
            if close == -1:  # unterminated: literal bracket
                out.append("\\[")
            else:
                body = pattern[i + 1 : close]
                neg = body.startswith("^")
                if neg:
                    body = body[1:]
                cls = "".join("\\" + c if c in "\\[]^&" else c for c in body)
                out.append("[" + ("^" if neg else "") + cls + "]")
                i = close
        else:
            out.append("\\" + ch if ch in _REGEX_META else ch)
        i += 1
    return "(?s)^" + "".join(out) + "\\z"


def like_tsql(col: ColumnOrName, pattern: str, fixed_char: bool = True, case_insensitive: bool = False) -> Column:
    """``col LIKE pattern`` with character classes.

    ``fixed_char`` models a ``CHAR(n)`` column: trailing blanks are padding,
    so the text matches with them or without them.  ``case_insensitive`` models a
    case-insensitive, accent-sensitive collation.  NULL input gives NULL.
    """
    c = _c(col)
    rx = like_to_regex(pattern)
    if case_insensitive:
        rx = "(?iu)" + rx
    return c.rlike(rx) | F.rtrim(c).rlike(rx) if fixed_char else c.rlike(rx)


# Fixed value: the Spark collation that is case-insensitive and accent-sensitive.
CASE_INSENSITIVE_COLLATION = "UTF8_LCASE"


def ci(col: ColumnOrName) -> Column:
    """A string column under a case-insensitive, accent-sensitive collation.

    Comparisons, grouping (UNIQUE checks) and joins on the result ignore
    case but not accents.  The default elsewhere is binary comparison.
    """
    return F.collate(_c(col), CASE_INSENSITIVE_COLLATION)


# ---------------------------------------------------------------- time ----

_UNITS = {"YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND"}


def datediff_boundary(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF(unit, start, end)``: number of unit boundaries crossed.

    00:00:59 -> 00:01:01 is one minute although only two seconds elapsed.
    Truncating both ends to the unit first turns Spark's elapsed-unit
    ``timestampdiff`` into the boundary count.
    """
    u = unit.upper()
    if u not in _UNITS:
        raise ValueError(f"unsupported unit {unit}")
    a, b = _c(start), _c(end)
    if u == "WEEK":
        # weeks are counted at Sunday boundaries; date_trunc weeks start on
        # Monday, so shift both ends by one day before truncating
        a, b = a + F.make_dt_interval(days=F.lit(1)), b + F.make_dt_interval(days=F.lit(1))
    s, e = F.date_trunc(u, a), F.date_trunc(u, b)
    # keep the truncated ends zone-free whatever date_trunc returns
    s, e = s.cast("timestamp_ntz"), e.cast("timestamp_ntz")
    return F.timestamp_diff(u, s, e)


def add_interval(col: ColumnOrName, amount: int, unit: str) -> Column:
    """``DATEADD(unit, amount, col)`` for YEAR / MONTH / WEEK / DAY / HOUR / MINUTE / SECOND.

    Month arithmetic clamps to the last day of the target month
    (Jan 31 + 1 month = Feb 28/29), as DATEADD does.
    """
    u = unit.upper()
    if u in ("YEAR", "MONTH"):
        kw = {"YEAR": "years", "MONTH": "months"}[u]
        return _c(col) + F.make_ym_interval(**{kw: F.lit(amount)})
    if u == "WEEK":
        return _c(col) + F.make_dt_interval(days=F.lit(7 * amount))
    kw = {"DAY": "days", "HOUR": "hours", "MINUTE": "mins", "SECOND": "secs"}[u]
    return _c(col) + F.make_dt_interval(**{kw: F.lit(amount)})


def ts_literal(value: str) -> Column:
    """A ``timestamp_ntz`` literal, e.g. the ``as_of`` clock or 9999-12-31."""
    return F.lit(value).cast("timestamp_ntz")


# CONVERT(VARCHAR, ts, style) output formats.
#   120 -> yyyy-mm-dd hh:mi:ss   112 -> yyyymmdd   108 -> hh:mi:ss
CONVERT_STYLES = {120: "yyyy-MM-dd HH:mm:ss", 112: "yyyyMMdd", 108: "HH:mm:ss"}


def convert_ts(col: ColumnOrName, style: int) -> Column:
    return F.date_format(_c(col), CONVERT_STYLES[style])


def snapshot_path(base: ColumnOrName, db: str, kind: str, at: ColumnOrName) -> Column:
    """``<base><db>_<kind>_yyyymmdd_hhmmss.bak`` (style 112 + style 108 without colons)."""
    return F.concat(
        _c(base), F.lit(f"{db}_{kind}_"), convert_ts(at, 112), F.lit("_"),
        F.replace(convert_ts(at, 108), F.lit(":"), F.lit("")), F.lit(".bak"),
    )


# -------------------------------------------------------------- numbers ----

def ceil_int(expr: Column) -> Column:
    """``CEILING`` of an exact decimal expression, back to INT."""
    return F.ceil(expr).cast("int")


def plus(*parts: ColumnOrName) -> Column:
    """String ``+``: NULL if any operand is NULL (``concat``, never ``concat_ws``)."""
    return F.concat(*[_c(p) for p in parts])


# ----------------------------------------------------------------- JSON ----

# JSON's white space, strings and numbers, as Java patterns.
_JSON_SPACE = r"[ \t\n\r]"
_JSON_STRING = r'"(?:[^"\\\x00-\x1F]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
_JSON_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
# A string becomes \x01, another scalar \x02; a list or object of those is again a value, \x02.
_JSON_FLAT = r"\[(?:[\x01\x02](?:,[\x01\x02])*+)?\]|\{(?:\x01:[\x01\x02](?:,\x01:[\x01\x02])*+)?\}"


def _opens(c: Column) -> Column:
    return c.rlike(rf"\A{_JSON_SPACE}*+[\[{{]")


def is_json(col: ColumnOrName) -> Column:
    """``ISJSON(col) = 1``: a JSON object or array.  NULL stays NULL.

    The first character after JSON white space must open an object or an
    array.  Spark's JSON functions refuse objects that repeat a key, which
    are valid here, and pass text after the document, which is not; so the
    text is reduced by the grammar: scalars to a mark, then innermost
    objects and arrays to a mark, as often as there are brackets.
    """
    c = _c(col)
    marked = F.regexp_replace(F.regexp_replace(c, _JSON_STRING, "\x01"), f"{_JSON_NUMBER}|true|false|null", "\x02")
    marked = F.regexp_replace(marked, _JSON_SPACE, "")
    depth = F.length(F.regexp_replace(marked, r"[^\[{]", ""))
    reduced = F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), marked, lambda acc, _: F.regexp_replace(acc, _JSON_FLAT, "\x02"))
    by_grammar = ~c.rlike(r"[\x01\x02]") & (reduced == F.lit("\x02"))
    return F.when(c.isNotNull(), F.when(_opens(c), by_grammar).otherwise(F.lit(False)))


def json_marked(col: ColumnOrName) -> Column:
    """The document with each scalar value as a string that starts with ``=``; NULL unless ``is_json``.

    So no number is converted, and a text is told from a nested object.  It does not depend on a path: take
    it once per row and read any number of paths from it with ``json_scalar``.
    """
    c = _c(col)
    tokens = rf'({_JSON_STRING}{_JSON_SPACE}*+:)|"((?:[^"\\]|\\.)*+)"|({_JSON_NUMBER}|true|false)'
    marked = F.regexp_replace(c, tokens, "$1\x01=$2$3\x01")
    marked = F.regexp_replace(marked, "(:)\x01=\x01", "$1")  # what a key left behind
    return F.when(is_json(c), F.replace(marked, F.lit("\x01"), F.lit('"')))


def json_scalar(marked: ColumnOrName, path: str) -> Column:
    """The scalar at ``path`` of a document that ``json_marked`` prepared, else NULL."""
    found = F.get_json_object(_c(marked), path)
    return F.when(found.startswith("="), F.substr(found, F.lit(2)))


def json_value(col: ColumnOrName, path: str) -> Column:
    """``JSON_VALUE(col, path)``: the scalar at ``path`` as it is written, else NULL.

    Numbers keep their text (``1.50``, ``1e2``, any number of digits), strings
    are unescaped, and of equal keys the first counts.  Objects, arrays,
    ``null`` and invalid JSON give NULL.
    """
    return json_scalar(json_marked(col), path)
