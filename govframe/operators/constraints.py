"""Constraint checks as DataFrame operators (I-9 … I-15).

Each check returns a *violations* frame instead of raising, so a batch
can be split into accepted and rejected rows in one lazy plan.  The
semantics follow SQL Server:

* CHECK passes on NULL: a row violates a rule only when ``NOT(rule)`` is TRUE;
* UNIQUE treats NULLs as equal (at most one NULL);
* a foreign key whose columns are NULL is not checked;
* a primary key is UNIQUE plus NOT NULL.

Scale: every check is one hash aggregate (map-side partial, so a hot key
is collapsed before the shuffle) or one anti/outer join on the key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that break a PRIMARY KEY: ``(keys…, n, reason)``.

    ``reason`` is ``NULL_KEY`` when a key column is NULL, ``DUPLICATE``
    when a non-NULL key occurs more than once.
    """
    keys = list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (
        g.filter(_any_null(keys) | (F.col("n") > 1))
        .withColumn("reason", F.when(_any_null(keys), F.lit("NULL_KEY")).otherwise(F.lit("DUPLICATE")))
    )


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that break UNIQUE (NULL equals NULL): ``(keys…, n)``."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def fk_violations(child: DataFrame, parent: DataFrame, fk: Sequence[str], pk: Sequence[str]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row."""
    fk, pk = list(fk), list(pk)
    probe = child
    for c in fk:
        probe = probe.filter(F.col(c).isNotNull())
    parent_keys = parent.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(pk)])
    cond = [F.col(f) == F.col(f"_pk{i}") for i, f in enumerate(fk)]
    return probe.join(parent_keys, cond, "left_anti")


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Array of the names of the rules whose condition is FALSE (not NULL)."""
    tagged = [F.when(~F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules.items()]
    return F.filter(F.array(*tagged), lambda x: x.isNotNull())


def check_violations(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str] | None = None) -> DataFrame:
    """CHECK constraints evaluated in one pass: one output row per (row, failed rule).

    ``keep`` selects the columns carried along (all by default).
    """
    keep = list(keep) if keep is not None else df.columns
    return (
        df.select(*keep, failed_rules(rules).alias("_failed"))
        .filter(F.size("_failed") > 0)
        .select(*keep, F.explode("_failed").alias("rule"))
    )


def domain_rules(spec: Mapping[str, Mapping[str, object]]) -> dict[str, Column]:
    """Turn a domain spec into named rules.

    ``spec = {col: {"not_null": bool, "max_len": n, "min": a, "max": b}}``.
    NOT NULL is the one rule that NULL breaks.
    """
    rules: dict[str, Column] = {}
    for col, d in spec.items():
        c = F.col(col)
        if d.get("not_null"):
            rules[f"{col}:not_null"] = F.coalesce(c.isNotNull(), F.lit(False))
        if "max_len" in d:
            rules[f"{col}:max_len_{d['max_len']}"] = F.length(c) <= F.lit(d["max_len"])
        if "min" in d and "max" in d:
            rules[f"{col}:range_{d['min']}_{d['max']}"] = c.between(d["min"], d["max"])
        elif "min" in d:
            rules[f"{col}:min_{d['min']}"] = c >= F.lit(d["min"])
        elif "max" in d:
            rules[f"{col}:max_{d['max']}"] = c <= F.lit(d["max"])
    return rules


def domain_violations(df: DataFrame, spec: Mapping[str, Mapping[str, object]], keep: Sequence[str] | None = None) -> DataFrame:
    """NOT NULL / length / numeric-domain violations, one row per (row, rule)."""
    return check_violations(df, domain_rules(spec), keep)


def apply_defaults(df: DataFrame, defaults: Mapping[str, object], schema: T.StructType | None = None) -> DataFrame:
    """DEFAULT fill: add each column that is *absent* from ``df``.

    A column that is present keeps its values, explicit NULLs included.
    With a target ``schema``, absent columns without a default become
    typed NULLs; columns are returned in schema order.
    """
    out = df
    present = set(df.columns)
    for name, value in defaults.items():
        if name not in present:
            if isinstance(value, _dt.datetime) and value.tzinfo is None:
                value = F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")  # wall clock, no zone shift
            out = out.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    if schema is not None:
        cols = []
        for f in schema:
            if f.name in out.columns:
                cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        out = out.select(*cols)
    return out


def keys_present(table: DataFrame, probe: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``keys`` of ``table`` that also occur in ``probe``.

    Semi-join first, de-duplicate after: with a small probe AQE broadcasts
    its keys and the big table is filtered during the scan; with a large
    probe the semi-join output is already partitioned by the key, so the
    ``distinct`` adds no shuffle.
    """
    keys = list(keys)
    wanted = probe.select(*keys).distinct()
    return table.select(*keys).join(wanted, keys, "left_semi").distinct()


def tag_batch(
    target: DataFrame,
    candidates: DataFrame,
    pk: Sequence[str],
    foreign_keys: Sequence[tuple[DataFrame, Sequence[str], Sequence[str], str]] = (),
    checks: Mapping[str, Column] | None = None,
    unique: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The batch with ``rules``: the sorted names of every rule a row breaks, none if it may be appended.

    Rules: primary key (NULL, already in target, repeated inside
    the batch), each UNIQUE key against target and batch, each foreign key
    ``(parent, fk_cols, pk_cols, name)``, each CHECK.  Every rule is a
    column computed with one aggregate or one outer join on its key, so no
    row id is needed and the batch is never collected.
    """
    pk = list(pk)
    flags: list[Column] = []
    df = candidates

    # PRIMARY KEY: null, clash with target, duplicate inside batch.  Only the
    # target keys that occur in the batch matter: the semi-join lets AQE
    # broadcast a small batch's key set and filter the target map-side.
    in_batch = candidates.groupBy(*pk).agg(F.count(F.lit(1)).alias("_pk_batch_n"))
    tgt_keys = target.select(*pk).join(in_batch.select(*pk), pk, "left_semi").distinct().withColumn(
        "_pk_in_target", F.lit(True))
    df = df.join(in_batch, pk, "left").join(tgt_keys, pk, "left")
    flags.append(F.when(_any_null(pk), F.lit("pk:null")))
    flags.append(F.when(F.col("_pk_in_target").isNotNull(), F.lit("pk:exists")))
    flags.append(F.when(~_any_null(pk) & (F.col("_pk_batch_n") > 1), F.lit("pk:duplicate_in_batch")))
    drop = ["_pk_in_target", "_pk_batch_n"]

    for name, ukeys in (unique or {}).items():
        ukeys = list(ukeys)
        # only target rows sharing a value with the batch can clash (NULL = NULL)
        wanted = candidates.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(ukeys)]).distinct()
        clash = target.select(*ukeys).join(
            wanted, [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(ukeys)], "left_semi")
        both = clash.unionByName(candidates.select(*ukeys))
        counts = both.groupBy(*ukeys).agg(F.count(F.lit(1)).alias(f"_u_{name}"))
        renamed = [f"_uk_{name}_{i}" for i in range(len(ukeys))]
        counts = counts.select(*[F.col(k).alias(r) for k, r in zip(ukeys, renamed)], f"_u_{name}")
        df = df.join(counts, [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(ukeys, renamed)], "left").drop(*renamed)
        flags.append(F.when(F.col(f"_u_{name}") > 1, F.lit(f"unique:{name}")))
        drop.append(f"_u_{name}")

    for parent, fk_cols, pk_cols, name in foreign_keys:
        fk_cols, pk_cols = list(fk_cols), list(pk_cols)
        wanted = candidates.select(*[F.col(f).alias(p) for f, p in zip(fk_cols, pk_cols)])
        pkeys = keys_present(parent, wanted, pk_cols).withColumn(f"_fk_{name}", F.lit(True))
        pkeys = pkeys.select(*[F.col(p).alias(f"_fkk_{name}_{i}") for i, p in enumerate(pk_cols)], f"_fk_{name}")
        cond = [F.col(f) == F.col(f"_fkk_{name}_{i}") for i, f in enumerate(fk_cols)]
        df = df.join(pkeys, cond, "left").drop(*[f"_fkk_{name}_{i}" for i in range(len(pk_cols))])
        flags.append(F.when(~_any_null(fk_cols) & F.col(f"_fk_{name}").isNull(), F.lit(f"fk:{name}")))
        drop.append(f"_fk_{name}")

    for name, cond in (checks or {}).items():
        flags.append(F.when(~F.coalesce(cond, F.lit(True)), F.lit(f"check:{name}")))

    broken = F.array_sort(F.filter(F.array(*flags), lambda x: x.isNotNull()))
    return df.withColumn("rules", broken).drop(*drop).select(*candidates.columns, "rules")


def validated_append(
    target: DataFrame,
    candidates: DataFrame,
    pk: Sequence[str],
    foreign_keys: Sequence[tuple[DataFrame, Sequence[str], Sequence[str], str]] = (),
    checks: Mapping[str, Column] | None = None,
    unique: Mapping[str, Sequence[str]] | None = None,
    store: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Validate a batch (``tag_batch``), then split it into ``(accepted, rejected)``; ``rejected`` carries ``rules``.

    Both frames come from the same tagging, which runs again for each frame that is used.  With ``store``, a folder that all
    executors see, it runs once: the batch is written there, divided by outcome, and each frame reads its own part.
    """
    tagged = tag_batch(target, candidates, pk, foreign_keys, checks, unique)
    if store is None:
        ok, bad = tagged.filter(F.size("rules") == 0), tagged.filter(F.size("rules") > 0)
        return ok.select(*candidates.columns), bad
    outcome = "_outcome"
    while outcome in candidates.columns:
        outcome += "_"
    tagged.withColumn(outcome, F.when(F.size("rules") == 0, F.lit("accepted")).otherwise(F.lit("rejected"))).write.mode("overwrite").partitionBy(outcome).parquet(store)
    kept = candidates.sparkSession.read.schema(tagged.select(*tagged.columns, F.lit("").alias(outcome)).schema).parquet(store)
    return kept.filter(F.col(outcome) == "accepted").select(*candidates.columns), kept.filter(F.col(outcome) == "rejected").select(*tagged.columns)
