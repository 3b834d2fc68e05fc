"""Data changes as transforms (I-1 … I-8, I-17 … I-20).

Every change takes the current table(s) and returns the next version
lazily; nothing is modified in place and nothing is collected.  What a
transaction did in the reference (guard, savepoint, rollback) becomes a
choice between two lazily defined frames.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govframe.functions.tsql import plus
from govframe.operators.numbering import dense_ids

Assignments = Mapping[str, Column]


def _true(cond: Column) -> Column:
    """SQL WHERE semantics: NULL is not TRUE."""
    return F.coalesce(cond, F.lit(False))


def update_where(df: DataFrame, cond: Column, assignments: Assignments) -> DataFrame:
    """``UPDATE t SET col = expr WHERE cond`` (all right-hand sides read the old row)."""
    hit = _true(cond)
    exprs = {c: F.when(hit, e).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, e in assignments.items()}
    return df.withColumns(exprs)


def guarded_update(df: DataFrame, cond: Column, assignments: Assignments, max_rows: int) -> DataFrame:
    """Apply the update only if at most ``max_rows`` rows match; else nothing changes.

    The match count is a scalar subquery (one aggregate, run once), so the
    decision stays inside the lazy plan: no count is pulled to the driver
    and no join is needed.
    """
    matched = df.agg(F.count_if(_true(cond))).scalar()
    allowed = matched <= F.lit(max_rows)
    exprs = {c: F.when(allowed & _true(cond), e).otherwise(F.col(c)).cast(df.schema[c].dataType)
             for c, e in assignments.items()}
    return df.withColumns(exprs)


def staged_update(df: DataFrame, stages: Sequence[tuple[Column, Assignments]], keep: int) -> DataFrame:
    """Savepoint semantics: run the stages in order, keep the first ``keep``.

    Stages after the savepoint are discarded, i.e. the frame built after
    stage ``keep`` is the result.
    """
    out = df
    for cond, assign in stages[:keep]:
        out = update_where(out, cond, assign)
    return out


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """``DELETE … WHERE cond``: keep rows for which cond is not TRUE (NULL kept)."""
    return df.filter(~_true(cond))


def delete_matching(df: DataFrame, keys: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """``DELETE … WHERE key IN (subquery)``: anti-join on the key."""
    return df.join(keys, on if isinstance(on, Column) else list(on), "left_anti")


# --------------------------------------------------- referential actions ---

@dataclass(frozen=True)
class ForeignKey:
    child: str
    child_cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]
    on_delete: str = "no_action"  # "cascade" | "set_null" | "no_action"


def _deleted_keys(deleted: DataFrame, cols: Sequence[str], alias: Sequence[str]) -> DataFrame:
    """Distinct deleted parent keys under child column names (hash aggregate)."""
    return deleted.select(*[F.col(c).alias(a) for c, a in zip(cols, alias)]).distinct()


def _cascade_order(fks: Sequence[ForeignKey], start: str) -> list[str]:
    """Tables reachable from ``start`` through CASCADE keys, parents before children.

    A table is visited only after every reachable parent that can cascade
    into it, so its own cascades see all of its deleted rows (diamonds in
    the key graph included).  The graph must be acyclic.
    """
    children: dict[str, list[str]] = {}
    for f in fks:
        if f.on_delete == "cascade":
            children.setdefault(f.parent, []).append(f.child)
    reach, stack = {start}, [start]
    while stack:
        for c in children.get(stack.pop(), []):
            if c not in reach:
                reach.add(c)
                stack.append(c)
    indeg = {t: 0 for t in reach}
    for p in reach:
        for c in children.get(p, []):
            indeg[c] += 1
    order, ready = [], [t for t in reach if indeg[t] == 0]
    while ready:
        t = ready.pop()
        order.append(t)
        for c in children.get(t, []):
            indeg[c] -= 1
            if indeg[c] == 0:
                ready.append(c)
    if len(order) != len(reach):
        raise ValueError("foreign-key cascade graph has a cycle")
    return order


def delete_cascade(
    tables: Mapping[str, DataFrame],
    fks: Sequence[ForeignKey],
    table: str,
    cond: Column,
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """``DELETE FROM table WHERE cond`` with the declared referential actions.

    Walks the foreign-key graph from ``table`` (a DAG) in topological
    order: CASCADE deletes the referencing rows and continues from them,
    SET NULL blanks the referencing columns.  NO ACTION is checked last,
    against the tables as the other actions leave them, so the order of
    ``fks`` does not matter: a referencing row that a cascade has deleted
    or blanked no longer blocks.  Returns ``(new tables, blocking)`` where ``blocking`` holds the
    referencing rows that forbid the delete (``None`` when no NO ACTION
    key is involved); if it is non-empty the caller must keep the old
    tables -- the check is lazy, like the rest.
    """
    new = dict(tables)
    deleted: dict[str, DataFrame] = {table: tables[table].filter(_true(cond))}
    new[table] = delete_where(tables[table], cond)
    blocking: list[DataFrame] = []
    for parent in _cascade_order(fks, table):
        if parent not in deleted:
            continue  # nothing reached this table through a CASCADE
        gone = deleted[parent]
        for fk in [f for f in fks if f.parent == parent]:
            child_df = new[fk.child]
            keys = _deleted_keys(gone, fk.parent_cols, fk.child_cols)
            if fk.on_delete == "cascade":
                hit = child_df.join(keys, list(fk.child_cols), "left_semi")
                deleted[fk.child] = hit if fk.child not in deleted else deleted[fk.child].unionByName(hit)
                new[fk.child] = child_df.join(keys, list(fk.child_cols), "left_anti")
            elif fk.on_delete == "set_null":
                marker = keys.withColumn("_hit", F.lit(True))
                j = child_df.join(marker, list(fk.child_cols), "left")
                new[fk.child] = j.withColumns(
                    {c: F.when(F.col("_hit"), F.lit(None).cast(child_df.schema[c].dataType)).otherwise(F.col(c))
                     for c in fk.child_cols}
                ).drop("_hit").select(*child_df.columns)
    for fk in fks:
        if fk.on_delete not in ("cascade", "set_null") and fk.parent in deleted:
            keys = _deleted_keys(deleted[fk.parent], fk.parent_cols, fk.child_cols)
            refs = new[fk.child].join(keys, list(fk.child_cols), "left_semi")
            blocking.append(refs.select(F.lit(fk.child).alias("child_table"),
                                        F.to_json(F.struct(*fk.child_cols)).alias("child_key")))
    block = None
    if blocking:
        block = blocking[0]
        for b in blocking[1:]:
            block = block.unionByName(b)
    return new, block


def update_key(tables: Mapping[str, DataFrame], fks: Sequence[ForeignKey], table: str, cond: Column,
               new_key: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``UPDATE table SET key = ... WHERE cond`` under ON UPDATE NO ACTION.

    Returns ``(new version, blocking)``: the child rows whose referenced
    key no longer exists after the update (a key that another row takes
    over does not block).  The check is lazy; a caller that finds blocking
    rows keeps the old version.
    """
    old = tables[table]
    hit = F.coalesce(cond, F.lit(False))
    new = old.select(*[F.when(hit, new_key[c]).otherwise(F.col(c)).alias(c) if c in new_key else F.col(c) for c in old.columns])
    blocking = None
    for fk in [f for f in fks if f.parent == table and set(f.parent_cols) & set(new_key)]:
        before = _deleted_keys(old.filter(_true(cond)), fk.parent_cols, fk.child_cols)
        gone = before.join(_deleted_keys(new, fk.parent_cols, fk.child_cols), list(fk.child_cols), "left_anti")
        refs = tables[fk.child].join(gone, list(fk.child_cols), "left_semi").select(
            F.lit(fk.child).alias("child_table"), F.to_json(F.struct(*fk.child_cols)).alias("child_key"))
        blocking = refs if blocking is None else blocking.unionByName(refs)
    if blocking is None:
        blocking = old.limit(0).select(F.lit("").alias("child_table"), F.lit("").alias("child_key"))
    return new, blocking


def restrict_counts(parent_deleted: DataFrame, child: DataFrame, parent_cols: Sequence[str],
                    child_cols: Sequence[str]) -> DataFrame:
    """NO ACTION check per parent row: how many child rows block its delete.

    Only child rows that reference a doomed parent are counted: the child
    is first semi-joined with the doomed keys (broadcast when few), then
    reduced to ``(key, n)`` with a partial aggregate, so a parent with a
    huge number of children costs one row in the shuffle.
    """
    doomed = parent_deleted.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, child_cols)]).distinct()
    refs = child.join(doomed, list(child_cols), "left_semi")
    counts = refs.groupBy(*child_cols).agg(F.count(F.lit(1)).alias("n_blocking"))
    counts = counts.select(*[F.col(c).alias(p) for c, p in zip(child_cols, parent_cols)], "n_blocking")
    return parent_deleted.join(counts, list(parent_cols), "inner")


# -------------------------------------------------------- schema changes ---

def with_computed(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Persisted computed column: materialised when the version is written."""
    return df.withColumn(name, expr)


def with_full_name(df: DataFrame, first: str, last: str, out: str = "full_name") -> DataFrame:
    """The persisted computed column ``first + ' ' + last`` (NULL if either part is NULL)."""
    return with_computed(df, out, plus(first, F.lit(" "), last))


def evolve(df: DataFrame, steps: Sequence[tuple]) -> DataFrame:
    """Apply column evolution steps in order.

    ``("rename", old, new)``, ``("add", name, expr_or_value)`` -- an added
    column that every existing row fills with the default --,
    ``("drop", name)``, ``("cast", name, type)``.
    """
    out = df
    for step in steps:
        op = step[0]
        if op == "rename":
            out = out.withColumnRenamed(step[1], step[2])
        elif op == "add":
            v = step[2]
            out = out.withColumn(step[1], v if isinstance(v, Column) else F.lit(v))
        elif op == "drop":
            out = out.drop(step[1])
        elif op == "cast":
            out = out.withColumn(step[1], F.col(step[1]).cast(step[2]))
        else:
            raise ValueError(f"unknown evolution step {op}")
    return out


def extract_dimension(df: DataFrame, attrs: Sequence[str], key: str, start: int = 1) -> tuple[DataFrame, DataFrame]:
    """Move ``attrs`` into their own table and back-fill a surrogate key.

    Returns ``(dimension, fact)``: ``dimension`` = distinct attribute tuples
    numbered densely in attribute order; ``fact`` = ``df`` without the
    attributes, with ``key``.  The back-fill join is many-to-one against
    the dimension (one row per distinct tuple).
    """
    attrs = list(attrs)
    dim = dense_ids(df, attrs, out=key, start=start)
    fact = df.join(dim, [df[a].eqNullSafe(dim[a]) for a in attrs], "left").drop(*[dim[a] for a in attrs]).drop(*attrs)
    return dim.select(key, *attrs), fact


def explode_attribute(df: DataFrame, key: Sequence[str], attr: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """Multi-valued attribute stored as a delimited string -> N:M child rows.

    ``sep`` is a literal separator; values are trimmed, empty ones dropped,
    and each (key, value) pair is kept once.
    """
    out = out or attr
    return (
        df.select(*key, F.explode(F.split(F.col(attr), re.escape(sep))).alias(out))
        .withColumn(out, F.trim(F.col(out)))
        .filter(F.length(out) > 0)
        .distinct()
    )
