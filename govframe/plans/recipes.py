"""One recipe per operator of the inventory, on the driver's tables.

Each recipe is ``(spark, sf_dir) -> DataFrame`` and goes through the
library's operators; the matching DuckDB SQL lives in ``oracle.py`` and
computes the same rows independently.  Column names are aliased the same
way on both sides.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.functions import tsql
from govframe.operators import audit as A
from govframe.operators import constraints as C
from govframe.operators import history as H
from govframe.operators import jsondoc as JS
from govframe.operators import joins as J
from govframe.operators import mutate as M
from govframe.operators import numbering as N
from govframe.operators import reports as R
from govframe.operators import retention as RT
from govframe.operators import security as S
from govframe.operators import visibility as VB
from govframe.plans import standins as X
from govframe.schemas import DRIVER, PERIOD_PATTERN
from govframe.session import shared_path
from govframe.sources import chains, sinks
from govframe.sources.keyfilters import write_filtered
from govframe.sources.tables import load_table, rows, view
from govframe.streaming.count_feed import CountFeed

Recipe = Callable[[SparkSession, str], DataFrame]
RECIPES: dict[str, Recipe] = {}


def recipe(fn: Recipe) -> Recipe:
    RECIPES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return load_table(spark, d, name)


# ------------------------------------------------------------ A: sources ----

@recipe
def scan_projection(spark, d):
    """A-1, B-1, B-3: explicit-schema scan, filter and projection pushed to Parquet."""
    c = _t(spark, d, "customer")
    return c.filter((F.col("c_acctbal") > 0) & (F.col("c_nationkey") < 10)).select("c_custkey", "c_name", "c_nationkey")


# Market-segment codes of the inline VALUES list.
SEGMENT_CODES = [("AUTOMOBILE", "AU"), ("BUILDING", "BU"), ("FURNITURE", "FU"), ("HOUSEHOLD", "HO"), ("MACHINERY", "MA")]


@recipe
def inline_values_join(spark, d):
    """A-2: inline VALUES rows joined to a table (broadcast: the list is 5 literal rows)."""
    codes = rows(spark, "segment string, seg_code string", SEGMENT_CODES)
    c = _t(spark, d, "customer")
    return c.join(F.broadcast(codes), c["c_mktsegment"] == codes["segment"]).select("c_custkey", "c_mktsegment", "seg_code")


def customer_summary(customer: DataFrame) -> DataFrame:
    """The summary view: active (non-negative balance) customers, balance hidden."""
    return customer.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


@recipe
def summary_view(spark, d):
    """A-3: view = row filter + column subset over the base table, registered as a temp view
    and read back through the catalogue."""
    view(customer_summary(_t(spark, d, "customer")), "customer_summary")
    return spark.table("customer_summary")


@recipe
def append_rows(spark, d):
    """A-4, I-14, K-6: append a full row, then a row lacking two columns (DEFAULT fill)."""
    c = _t(spark, d, "customer")
    full = rows(spark, DRIVER["customer"], [(1000000001, "Customer#new1", 3, 10.5, "BUILDING")])
    partial = rows(spark, "c_custkey bigint, c_name string, c_nationkey int", [(1000000002, "Customer#new2", 7)])
    out = sinks.append(c, full)
    return sinks.append(out, partial, defaults={"c_acctbal": 0.0, "c_mktsegment": "UNASSIGNED"})


def _supplier_candidates(spark, d) -> DataFrame:
    s = _t(spark, d, "supplier")
    return s.select(
        (F.col("s_suppkey") * 20).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )


@recipe
def insert_if_absent(spark, d):
    """A-6, B-15, C-8: idempotent seed -- candidates whose key exists are skipped."""
    return sinks.insert_if_absent(_t(spark, d, "customer"), _supplier_candidates(spark, d), ["c_custkey"])


SNAPSHOT_TABLES = ("customer", "orders", "lineitem", "part", "supplier")
SNAPSHOT_AT = _dt.datetime(2024, 1, 31)


@recipe
def snapshot_full_manifest(spark, d):
    """A-7, A-10: full snapshot of five tables to the shared folder + run log; the
    manifest is read back from the written snapshot."""
    tables = {name: _t(spark, d, name) for name in SNAPSHOT_TABLES}
    paths, log = sinks.snapshot_full(tables, shared_path(spark, "snapshots"), "academy", SNAPSHOT_AT)
    status = log.select("status").scalar()
    parts = []
    for name in SNAPSHOT_TABLES:
        written = spark.read.schema(DRIVER[name]).parquet(paths[name])
        parts.append(written.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(DRIVER[name].fields)).alias("n_cols"),
            status.alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def changed_orders(orders: DataFrame) -> DataFrame:
    """Orders after a day of changes: urgent open orders finished, low pending
    orders removed, high pending orders re-entered under new keys."""
    prio, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    cur = M.update_where(orders, (prio == "1-URGENT") & (st == "O"), {"o_orderstatus": F.lit("F")})
    cur = M.delete_where(cur, (prio == "5-LOW") & (st == "P"))
    new = orders.filter((prio == "2-HIGH") & (st == "P")).withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return cur.unionByName(new)


@recipe
def snapshot_diff(spark, d):
    """A-8, A-10: full snapshot of orders written, a day of changes applied, the differential
    snapshot (new / changed / removed rows) against the written full one written too; the
    change counts are read back from the written diff."""
    o = _t(spark, d, "orders")
    base = shared_path(spark, "snapshots")
    paths, _ = sinks.snapshot_full({"orders": o}, base, "academy", SNAPSHOT_AT)
    full = spark.read.schema(DRIVER["orders"]).parquet(paths["orders"])
    path, _ = sinks.snapshot_diff_write(changed_orders(o), full, ["o_orderkey"], base, "academy", SNAPSHOT_AT)
    return spark.read.parquet(path).groupBy("change_kind").agg(F.count(F.lit(1)).alias("n"))


ORDER_TREE = chains.TreeShape(("o_orderkey",), buckets=16, fanout=4)  # a file per bucket: few, as the test tables are small


def next_day_orders(day: DataFrame, orders: DataFrame) -> DataFrame:
    """A second day of changes: cheap re-entered orders go, pending medium orders lose their priority,
    dear orders that the first day removed come back."""
    prio, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    cur = M.delete_where(day, (F.col("o_orderkey") < 0) & (F.col("o_totalprice") < 100_000))
    cur = M.update_where(cur, (prio == "3-MEDIUM") & (st == "P"), {"o_orderpriority": F.lit("4-NOT SPECIFIED")})
    return cur.unionByName(orders.filter((prio == "5-LOW") & (st == "P") & (F.col("o_totalprice") > 200_000)))


@recipe
def snapshot_chain_restore(spark, d):
    """A-7, A-8: a full snapshot of orders and two incremental ones (updates, deletes, keys that come and
    go again), then the restore over the three links, each checked against its manifest first."""
    o, base = _t(spark, d, "orders"), shared_path(spark, "chains")
    day1 = changed_orders(o)
    link, _ = chains.write_full(o, base, "academy", SNAPSHOT_AT, ORDER_TREE)
    chain = [link]
    for i, current in enumerate((day1, next_day_orders(day1, o)), 1):
        link, _ = chains.write_incremental(current, chain, base, "academy", SNAPSHOT_AT + _dt.timedelta(days=i))
        chain.append(link)
    return chains.restore_chain(spark, chain)


@recipe
def snapshot_bucket_diff(spark, d):
    """A-8: a day that changes the few dearest pending orders only; fingerprints of key buckets tell which
    buckets are read and compared.  The changes are read back from the written link."""
    o, base = _t(spark, d, "orders"), shared_path(spark, "chains")
    full, _ = chains.write_full(o, base, "academy", SNAPSHOT_AT, ORDER_TREE)
    dear = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 499_000)
    current = M.update_where(o, dear & (F.col("o_orderpriority") != "5-LOW"), {"o_orderstatus": F.lit("F")})
    current = M.delete_where(current, dear & (F.col("o_orderpriority") == "5-LOW"))
    link, log = chains.write_incremental(current, [full], base, "academy", SNAPSHOT_AT + _dt.timedelta(days=1))
    return link.rows(spark).select("o_orderkey", "o_orderstatus", "change_kind", log.select("status").scalar().alias("run_status"))


@recipe
def snapshot_failed_log(spark, d):
    """A-10: a snapshot that fails leaves a FAILED row with its message in the run log; one that does not, a SUCCESS row."""
    o = _t(spark, d, "orders")
    refused = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("pending orders cannot be stored"))).otherwise(F.col("o_orderstatus"))
    logs = []
    for db, table in (("plain", o), ("strict", o.withColumn("o_orderstatus", refused))):
        try:
            _, log = sinks.snapshot_full({"orders": table}, shared_path(spark, "snapshots"), db, SNAPSHOT_AT)
        except sinks.SnapshotError as exc:
            log = exc.log
        logs.append(log.select(F.lit(db).alias("db"), "kind", "status", F.col("error").contains("pending orders cannot be stored").alias("told")))
    return logs[0].unionByName(logs[1])


@recipe
def format_timestamps(spark, d):
    """A-9, H-2, H-3: CONVERT styles 120 / 112 / 108 and the snapshot file name."""
    o = _t(spark, d, "orders")
    ts = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        tsql.convert_ts(ts, 120).alias("fmt120"), tsql.convert_ts(ts, 112).alias("fmt112"),
        tsql.convert_ts(ts, 108).alias("fmt108"),
        tsql.snapshot_path(F.lit("/backups/"), "academy", "FULL", ts).alias("snap_path"),
    )


# ------------------------------------------------------- B: predicates ----

@recipe
def in_list_filter(spark, d):
    """B-5, K-14: IN list filter, sorted."""
    o = _t(spark, d, "orders")
    return (o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", "o_orderpriority", "o_orderstatus").orderBy("o_orderpriority", "o_orderkey"))


@recipe
def like_patterns(spark, d):
    """B-7, B-8, B-9: LIKE prefix / contains / suffix."""
    p = _t(spark, d, "part")
    n = F.col("p_name")
    return p.select("p_partkey", "p_name", n.startswith("red").alias("starts_red"),
                    n.contains("ring").alias("has_ring"), n.endswith("bolt").alias("ends_bolt"))


def order_periods(orders: DataFrame) -> DataFrame:
    """Enrolment period codes (year, 'S', half) as CHAR(6); two priorities carry damaged codes."""
    ts = F.col("o_orderdate")
    good = F.concat(F.year(ts).cast("string"), F.lit("S"), F.when(F.month(ts) <= 6, F.lit("1")).otherwise(F.lit("2")))
    prio = F.col("o_orderpriority")
    code = (F.when(prio == "5-LOW", F.substring(good, 2, 5))
            .when(prio == "4-NOT SPECIFIED", F.concat(F.substring(good, 1, 5), F.lit("3")))
            .otherwise(good))
    return orders.select("o_orderkey", F.rpad(code, 6, " ").alias("periodo"))


@recipe
def like_char_class(spark, d):
    """B-10, I-12: LIKE with character classes on a CHAR(6) column."""
    per = order_periods(_t(spark, d, "orders"))
    return per.withColumn("valid", tsql.like_tsql("periodo", PERIOD_PATTERN))


# Status and price-band labels of the CASE recipe.
STATUS_LABELS = {"F": "Finalizado", "O": "Abierto"}


@recipe
def case_labels(spark, d):
    """B-12, B-13, K-13: simple CASE, searched CASE, format label."""
    o = _t(spark, d, "orders")
    st = F.col("o_orderstatus")
    simple = F.when(st == "F", F.lit(STATUS_LABELS["F"])).when(st == "O", F.lit(STATUS_LABELS["O"])).otherwise(F.lit("Otro"))
    price = F.col("o_totalprice")
    band = F.when(price >= 300000, F.lit("alto")).when(price >= 100000, F.lit("medio")).otherwise(F.lit("bajo"))
    out = o.select("o_orderkey", "o_orderpriority", simple.alias("status_label"), band.alias("price_band"))
    out = R.label_format(out, "o_orderpriority", "%LOW", name="prio_format")
    return out.drop("o_orderpriority")


@recipe
def exists_flag(spark, d):
    """B-14: EXISTS as a boolean column."""
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    finished = o.filter(F.col("o_orderstatus") == "F")
    return J.flag_exists(c.select("c_custkey"), finished, ["c_custkey"], ["o_custkey"], "has_finished_order")


@recipe
def child_count(spark, d):
    """B-17: correlated COUNT(*) subquery, 0 when no child row."""
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    recent = o.filter(F.col("o_orderdate") >= tsql.ts_literal("1998-01-01 00:00:00"))
    return J.add_child_count(c.select("c_custkey"), recent, ["c_custkey"], ["o_custkey"], "n_orders")


@recipe
def scalar_lookup(spark, d):
    """B-18: scalar lookup subquery (id by unique name)."""
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    who = J.lookup_one(c, F.col("c_name") == "Customer#000000007", "c_custkey")
    return o.filter(F.col("o_custkey") == who).select("o_orderkey", "o_custkey", "o_totalprice")


# ------------------------------------------------------------ C: joins ----

@recipe
def inner_join(spark, d):
    """C-1: two-table equi-join (AQE broadcasts the dimension when it measures small)."""
    c, n = _t(spark, d, "customer"), _t(spark, d, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", "c_name", "n_name")


@recipe
def enrollment_detail(spark, d):
    """C-2, F-1: three-table join chain, multi-key mixed-direction sort."""
    li, o, p = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "part")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "p_name", "l_quantity", "o_orderdate").orderBy(
        F.desc("o_orderdate"), "l_orderkey", "l_linenumber", "l_partkey")


@recipe
def left_join_default(spark, d):
    """C-4, H-8: left outer join + ISNULL replacement."""
    c, n = _t(spark, d, "customer"), _t(spark, d, "nation")
    america = n.filter(F.col("n_regionkey") == 1)
    j = c.join(america, c["c_nationkey"] == america["n_nationkey"], "left")
    return j.select("c_custkey", F.coalesce(F.col("n_name"), F.lit("OTHER")).alias("nation_label"))


@recipe
def composite_key_join(spark, d):
    """C-3: equi-join on a two-column key -- each line's per-mille share of the
    quantity of its (part, supplier) pair; the pair side is pre-aggregated."""
    li = _t(spark, d, "lineitem")
    per_pair = li.groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("pair_qty"))
    j = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").join(
        per_pair, ["l_partkey", "l_suppkey"])
    share = F.expr("(CAST(l_quantity AS BIGINT) * 1000) div CAST(pair_qty AS BIGINT)")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_lines", share.alias("qty_share_permille"))


# ----------------------------------------------------- D: aggregation ----

@recipe
def count_where(spark, d):
    """D-1: global COUNT(*) under a predicate."""
    o = _t(spark, d, "orders")
    return o.filter((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)).agg(F.count(F.lit(1)).alias("n"))


@recipe
def enrollments_per_course(spark, d):
    """D-2: COUNT_BIG(*) per key (partial + final hash aggregate)."""
    return _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("total"))


@recipe
def count_distinct_roles(spark, d):
    """D-6: COUNT(DISTINCT) over a join; the order side is reduced to distinct keys first."""
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    buyers = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return c.join(buyers, "c_custkey", "left_semi").agg(F.count_distinct("c_nationkey").alias("n_nations"))


# ------------------------------------------------- E/F/G: window, top-k ----

@recipe
def global_row_number(spark, d):
    """E-1: ROW_NUMBER() OVER (ORDER BY price DESC, key) without a single-partition exchange."""
    p = _t(spark, d, "part").select("p_partkey", "p_retailprice")
    return N.global_row_number(p, [F.desc("p_retailprice"), F.asc("p_partkey")], out="rn")


def _log_order():
    return [F.desc("event_at"), F.desc("seq")]


@recipe
def latest_accesses(spark, d):
    """F-2, K-2: latest 1000 accesses."""
    log = X.access_log(_t(spark, d, "events"))
    return R.latest_accesses(log, 1000).select("usuario", "action", "table_name", "subject", "event_at")


@recipe
def latest_accesses_filtered(spark, d):
    """F-3: filter over the top-1000 view, then the latest 10 errors."""
    log = X.access_log(_t(spark, d, "events"))
    return R.latest_filtered(log, _log_order(), 1000, F.col("action") == "error", 10).select("usuario", "action", "subject", "event_at")


@recipe
def union_all_totals(spark, d):
    """G-1, B-2: UNION ALL of labelled counts (one scan per source)."""
    parts = [_t(spark, d, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("object_type"), "n")
             for name in ("customer", "orders", "lineitem", "part", "supplier")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------- H: scalar ----

def known_segment(c: DataFrame) -> DataFrame:
    """Segment as a nullable attribute: unknown (NULL) for customers in debt."""
    return c.withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))


@recipe
def full_name(spark, d):
    """H-1, I-17: persisted computed column with NULL-propagating string '+'."""
    c = known_segment(_t(spark, d, "customer"))
    return M.with_full_name(c, "c_mktsegment", "c_name").select("c_custkey", "full_name")


# ------------------------------------------------------- I: mutations ----

@recipe
def update_where(spark, d):
    """I-1: UPDATE … SET size = size + 1 WHERE …"""
    p = _t(spark, d, "part")
    cond = (F.col("p_type") == "ECONOMY") & (F.col("p_size") < 10)
    return M.update_where(p, cond, {"p_size": F.col("p_size") + 1}).select("p_partkey", "p_size")


GUARD_LIMIT = 10


@recipe
def guarded_update(spark, d):
    """I-2, H-6: +CEILING(3 %) on parts named like '%red%', applied only if at most
    N rows match; once with a limit that holds and once with the limit 10 that does not."""
    p = _t(spark, d, "part").select("p_partkey", "p_name", "p_size")
    cond = F.col("p_name").like("%red%")
    bump = {"p_size": F.col("p_size") + tsql.ceil_int(F.col("p_size") * F.lit(Decimal("0.03")))}
    passes = M.guarded_update(p, cond, bump, max_rows=1_000_000_000).withColumnRenamed("p_size", "size_guard_pass")
    blocked = M.guarded_update(p, cond, bump, max_rows=GUARD_LIMIT).select("p_partkey", F.col("p_size").alias("size_guard_block"))
    return passes.join(blocked, "p_partkey").select("p_partkey", "size_guard_pass", "size_guard_block")


@recipe
def staged_update(spark, d):
    """I-3: two staged updates, the second rolled back to the savepoint."""
    p = _t(spark, d, "part")
    stages = [
        (F.col("p_type") == "SMALL", {"p_size": F.col("p_size") + 1}),
        (F.col("p_type") == "MEDIUM", {"p_size": F.col("p_size") + 1}),
    ]
    return M.staged_update(p, stages, keep=1).select("p_partkey", "p_size")


@recipe
def delete_where(spark, d):
    """I-4: DELETE … WHERE predicate."""
    o = _t(spark, d, "orders")
    return M.delete_where(o, F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderstatus")


@recipe
def delete_by_subquery(spark, d):
    """I-5, B-16: DELETE … WHERE key IN (subquery)."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    autos = c.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_custkey").alias("o_custkey"))
    return M.delete_matching(o, autos, ["o_custkey"]).select("o_orderkey", "o_custkey")


SALES_FKS = [
    M.ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",), "cascade"),
    M.ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",), "cascade"),
]


@recipe
def fk_cascade_delete(spark, d):
    """I-6: delete customers of one nation; orders and line items follow by CASCADE."""
    tables = {t: _t(spark, d, t) for t in ("customer", "orders", "lineitem")}
    new, _ = M.delete_cascade(tables, SALES_FKS, "customer", F.col("c_nationkey") == 3)
    parts = [new[t].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@recipe
def null_test(spark, d):
    """B-11: customers whose outer-joined order total IS NULL, and those where it is not, per nation."""
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    totals = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    j = c.join(totals, c["c_custkey"] == totals["o_custkey"], "left")
    return j.groupBy("c_nationkey").agg(F.count_if(F.col("total").isNull()).alias("n_without"), F.count_if(F.col("total").isNotNull()).alias("n_with"))


@recipe
def fk_set_null(spark, d):
    """I-7: delete three nations; customers keep their row with a NULL nation."""
    tables = {"nation": _t(spark, d, "nation"), "customer": _t(spark, d, "customer")}
    fks = [M.ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",), "set_null")]
    new, _ = M.delete_cascade(tables, fks, "nation", F.col("n_nationkey").isin(0, 1, 2))
    return new["customer"].select("c_custkey", "c_nationkey")


STATEMENT_FKS = [
    M.ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",), "no_action"),
    M.ForeignKey("supplier", ("s_nationkey",), "nation", ("n_nationkey",), "cascade"),
    M.ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",), "cascade"),
    M.ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",), "cascade"),
    M.ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",), "cascade"),
]


@recipe
def fk_end_of_statement(spark, d):
    """I-6, I-8: NO ACTION inside a cascading delete -- line items of a nation's suppliers block it,
    except those that the cascade through its customers' orders deletes."""
    tables = {t: _t(spark, d, t) for t in ("nation", "supplier", "customer", "orders", "lineitem")}
    new, blocking = M.delete_cascade(tables, STATEMENT_FKS, "nation", F.col("n_nationkey") == 3)
    parts = [new[t].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("what"), "n_rows") for t in tables]
    out = blocking.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("blocking").alias("what"), "n_rows")
    for p in parts:
        out = out.unionByName(p)
    return out


@recipe
def fk_update_key(spark, d):
    """I-8: changing a referenced key (ON UPDATE NO ACTION): the line items that block it, per key."""
    tables = {"part": _t(spark, d, "part").select("p_partkey", "p_size"), "lineitem": _t(spark, d, "lineitem").select("l_partkey")}
    fks = [M.ForeignKey("lineitem", ("l_partkey",), "part", ("p_partkey",), "no_action")]
    _, blocking = M.update_key(tables, fks, "part", F.col("p_size") > 45, {"p_partkey": F.col("p_partkey") + 1_000_000_000})
    return blocking.groupBy("child_table", "child_key").agg(F.count(F.lit(1)).alias("n"))


@recipe
def fk_restrict(spark, d):
    """I-8: parts that cannot be deleted (NO ACTION) and how many line items block each."""
    p, li = _t(spark, d, "part"), _t(spark, d, "lineitem")
    doomed = p.filter(F.col("p_size") > 45).select("p_partkey")
    return M.restrict_counts(doomed, li, ["p_partkey"], ["l_partkey"]).select("p_partkey", "n_blocking")


# ----------------------------------------------------- I: constraints ----

@recipe
def pk_violations(spark, d):
    """I-9: PRIMARY KEY (l_orderkey, l_linenumber) violations."""
    return C.pk_violations(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@recipe
def unique_violations(spark, d):
    """I-10: UNIQUE (nation, segment) with NULL = NULL."""
    c = known_segment(_t(spark, d, "customer"))
    return C.unique_violations(c, ["c_nationkey", "c_mktsegment"])


@recipe
def fk_violations(spark, d):
    """I-11: orders whose customer is not among the active customers."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    return C.fk_violations(o, c.filter(F.col("c_acctbal") >= 0), ["o_custkey"], ["c_custkey"]).select("o_orderkey", "o_custkey")


def line_rules():
    return {
        "qty_range": F.col("l_quantity").between(1, 40),
        "max_discount": F.col("l_discount") <= 0.08,
        "flag_pattern": tsql.like_tsql("l_returnflag", "[AN]", fixed_char=False),
    }


@recipe
def check_violations(spark, d):
    """I-12, B-4: three CHECK rules in one pass; violations per rule."""
    v = C.check_violations(_t(spark, d, "lineitem"), line_rules(), keep=["l_orderkey"])
    return v.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


PART_DOMAIN = {"p_name": {"not_null": True, "max_len": 9}, "size_units": {"min": 0, "max": 255}}


@recipe
def domain_violations(spark, d):
    """I-13: NOT NULL, length and TINYINT-range domain checks."""
    p = _t(spark, d, "part").withColumn("size_units", F.col("p_size") * 10)
    v = C.domain_violations(p, PART_DOMAIN, keep=["p_partkey"])
    return v.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@recipe
def apply_defaults(spark, d):
    """I-14: DEFAULT fill for the columns a batch does not carry."""
    e = _t(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return C.apply_defaults(e, {"value": 0.0, "props": "{}"}, DRIVER["events"])


def order_candidates(orders: DataFrame) -> DataFrame:
    """A batch of orders to insert: urgent ones reuse an existing key, high ones point at
    an unknown customer, low ones carry a negative price; the rest are clean."""
    prio = F.col("o_orderpriority")
    return orders.select(
        F.when(prio == "1-URGENT", F.col("o_orderkey")).otherwise(-1 - F.col("o_orderkey")).alias("o_orderkey"),
        F.when(prio == "2-HIGH", F.col("o_custkey") + 1_000_000_000).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(prio == "5-LOW", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
    )


@recipe
def validated_append(spark, d):
    """I-15: validate a batch (PK, FK, CHECK): accepted and rejected rows by the rules they break, from one tagging."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    tagged = C.tag_batch(
        o, order_candidates(o), ["o_orderkey"],
        foreign_keys=[(c, ["o_custkey"], ["c_custkey"], "customer")],
        checks={"price_nonneg": F.col("o_totalprice") >= 0},
    )
    outcome = F.when(F.size("rules") == 0, F.lit("ACCEPTED")).otherwise(F.lit("REJECTED"))
    return tagged.groupBy(outcome.alias("outcome"), F.array_join("rules", ",").alias("rules")).agg(F.count(F.lit(1)).alias("n"))


@recipe
def validated_append_keys(spark, d):
    """I-15, I-9, I-10: the key rules of a batch -- NULL keys, keys given twice in the batch, and a UNIQUE pair
    (customer, day) that the target or the batch itself has already; a NULL pair equals a NULL pair."""
    o = _t(spark, d, "orders")
    prio, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    later = F.col("o_orderdate") + F.expr("INTERVAL 100 YEARS")
    batch = o.select(
        F.when(prio == "2-HIGH", F.lit(None)).when(prio == "3-MEDIUM", -1 - F.col("o_custkey")).otherwise(-1_000_000_000 - F.col("o_orderkey")).cast("long").alias("o_orderkey"),
        F.when(prio == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_orderstatus", "o_totalprice",
        F.when(prio == "5-LOW", F.lit(None)).when(st == "P", F.col("o_orderdate")).otherwise(later).cast(DRIVER["orders"]["o_orderdate"].dataType).alias("o_orderdate"),
        "o_orderpriority")
    ok, bad = C.validated_append(o, batch, ["o_orderkey"], unique={"cust_day": ["o_custkey", "o_orderdate"]})
    out = ok.select("o_orderpriority", F.lit("").alias("rules")).unionByName(bad.select("o_orderpriority", F.array_join("rules", ",").alias("rules")))
    return out.groupBy("o_orderpriority", "rules").agg(F.count(F.lit(1)).alias("n"))


@recipe
def validated_append_filtered(spark, d):
    """I-15, I-9, I-10, I-11: a small batch against stored versions with key filters: only the files that may hold one
    of its keys are read, of orders for the key rules and of customers for the foreign key."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    files = 8  # so many, to have something to skip in the small test tables
    orders = write_filtered(o.repartitionByRange(files, "o_orderkey"), shared_path(spark, "filtered"), 1, {"pk": ["o_orderkey"], "cust_day": ["o_custkey", "o_orderdate"]})
    people = write_filtered(c.repartitionByRange(files, "c_custkey"), shared_path(spark, "filtered"), 1, {"pk": ["c_custkey"]})
    dear = o.filter((F.col("o_totalprice") > 499_000) & (F.col("o_orderstatus") != "P"))
    prio = F.col("o_orderpriority")
    batch = dear.select(
        F.when(prio == "1-URGENT", F.col("o_orderkey")).otherwise(-1 - F.col("o_orderkey")).alias("o_orderkey"),
        F.when(prio == "2-HIGH", F.col("o_custkey") + 1_000_000_000).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_orderstatus", "o_totalprice",
        F.when(prio == "3-MEDIUM", F.col("o_orderdate")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 100 YEARS")).alias("o_orderdate"), "o_orderpriority")
    known = people.rows_for(batch.select(F.col("o_custkey").alias("c_custkey")))
    ok, bad = C.validated_append(orders.rows_for(batch), batch, ["o_orderkey"], foreign_keys=[(known, ["o_custkey"], ["c_custkey"], "customer")],
                                 unique={"cust_day": ["o_custkey", "o_orderdate"]})
    return ok.select("o_orderkey", F.lit("").alias("rules")).unionByName(bad.select("o_orderkey", F.array_join("rules", ",").alias("rules")))


@recipe
def assign_ids(spark, d):
    """I-16: SEQUENCE START WITH 1000 INCREMENT BY 1, in key order."""
    c = _t(spark, d, "customer").select("c_custkey")
    return N.assign_ids(c, ["c_custkey"], out="new_id", start=1000)


@recipe
def evolve_schema(spark, d):
    """I-18: rename, add computed, add with default."""
    s = _t(spark, d, "supplier")
    return M.evolve(s, [
        ("rename", "s_suppkey", "supplier_key"),
        ("rename", "s_name", "supplier_name"),
        ("add", "s_label", tsql.plus("supplier_name", F.lit(" / "), F.col("s_nationkey").cast("string"))),
        ("add", "status", "ACTIVE"),
    ])


@recipe
def extract_dimension(spark, d):
    """I-19: move (segment, nation) into a contact dimension and back-fill its key."""
    c = _t(spark, d, "customer")
    _, fact = M.extract_dimension(c, ["c_mktsegment", "c_nationkey"], "contact_id")
    return fact.select("c_custkey", "c_name", "c_acctbal", "contact_id")


@recipe
def nm_attribute_join(spark, d):
    """I-20, C-7: N:M attribute (brands a customer bought) in long form, for known customers (semi join)."""
    c, o, li, p = (_t(spark, d, t) for t in ("customer", "orders", "lineitem", "part"))
    bought = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(F.col("o_custkey").alias("c_custkey"), "l_partkey").distinct()
    pairs = bought.join(p, bought["l_partkey"] == p["p_partkey"]).select("c_custkey", "p_brand").distinct()
    return pairs.join(c.select("c_custkey"), "c_custkey", "left_semi")


@recipe
def nm_attribute_explode(spark, d):
    """I-20: a multi-valued attribute kept as delimited text (the words of a part name)
    turned into N:M child rows (part, word), one per distinct pair."""
    p = _t(spark, d, "part")
    return M.explode_attribute(p, ["p_partkey"], "p_name", sep=" ", out="word")


# --------------------------------------------------- J: sessions, RLS ----

@recipe
def session_state(spark, d):
    """J-1, J-2: session table after a batch of LOGIN / LOGOUT events."""
    return X.sessions(spark, d)


@recipe
def purge_expired(spark, d):
    """J-3: purge closed sessions that expired more than one day before the clock."""
    return S.purge_sessions(X.stored_sessions(spark, d), X.AS_OF, days=1)


# Fixed value: the instant that parts the login events into two batches.
SECOND_BATCH = "2024-01-16 00:00:00"
OVERLAP_DAYS = 2  # the second batch repeats that many days of the first: late events


def _two_batches(spark, d):
    """The first batch's sessions as a stored version, and a second batch with late events applied to it."""
    events, customer = X.session_events(_t(spark, d, "events")), _t(spark, d, "customer")
    cut = tsql.ts_literal(SECOND_BATCH)
    first, _, _ = S.apply_session_events(None, events.filter(F.col("event_at") < cut), customer, "c_custkey")
    stored = X.store(spark, first)
    second = events.filter(F.col("event_at") >= cut - F.make_dt_interval(days=F.lit(OVERLAP_DAYS)))
    return S.apply_session_events(stored, second, customer, "c_custkey")


@recipe
def session_merge(spark, d):
    """J-1, J-2: events merged into a stored session table; events older than a stored session change nothing."""
    return _two_batches(spark, d)[0]


@recipe
def session_log(spark, d):
    """J-1, J-2, A-4: the audit rows of the second batch, late events included."""
    return _two_batches(spark, d)[1].select("usuario", "action", "table_name", "subject", "event_at", "seq")


@recipe
def session_rejected(spark, d):
    """J-1: logins whose subject does not exist (every third person is missing from the people table)."""
    people = _t(spark, d, "customer").filter(F.col("c_nationkey") % 3 != 0)
    _, _, rejected = S.apply_session_events(None, X.session_events(_t(spark, d, "events")), people, "c_custkey")
    return rejected.select("usuario", "subject", "event_at", "seq", "reason")

def _rls_setup(spark, d):
    sess = X.stored_sessions(spark, d)
    return sess, X.first_usable_principal(sess)


@recipe
def rls_session_filter(spark, d):
    """J-4, H-14: customers visible to a non-admin principal through its session."""
    sess, who = _rls_setup(spark, d)
    return S.rls_session(_t(spark, d, "customer"), "c_custkey", sess, who, X.AS_OF).select("c_custkey", "c_name")


@recipe
def rls_admin(spark, d):
    """J-4, H-14: the administrator is exempt from the session policy and sees every customer."""
    return S.rls_session(_t(spark, d, "customer"), "c_custkey", None, S.Principal(S.ADMIN_USER), X.AS_OF).select("c_custkey", "c_name")


def _order_policies(spark, d):
    sess, who = _rls_setup(spark, d)
    reg = (S.PolicyRegistry().register("orders", S.session_policy("o_custkey"))
           .register("orders", S.flag_policy(F.col("o_totalprice") >= 1000)))
    return reg, S.AccessContext(who, X.AS_OF, sess)


@recipe
def policy_update(spark, d):
    """J-6, B-19: an UPDATE as a non-admin changes only the orders that both policies show."""
    reg, ctx = _order_policies(spark, d)
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return S.update_visible(orders, ["o_orderkey"], reg, "orders", ctx, F.col("o_orderstatus") != "P", {"o_orderstatus": F.lit("X")})


@recipe
def policy_delete(spark, d):
    """J-6, B-20: a DELETE as a non-admin removes only the orders that both policies show."""
    reg, ctx = _order_policies(spark, d)
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return S.delete_visible(orders, ["o_orderkey"], reg, "orders", ctx, F.lit(True))


@recipe
def policy_listing(spark, d):
    """J-10, C-2: policies with their flag and the tables that their predicates protect."""
    r, n = _t(spark, d, "region"), _t(spark, d, "nation")
    policies = r.select(F.col("r_regionkey").alias("policy_id"), F.col("r_name").alias("name"), (F.col("r_regionkey") % 2 == 0).alias("is_enabled"))
    predicates = n.select(F.col("n_regionkey").alias("policy_id"), F.col("n_nationkey").alias("target_object_id"), F.concat(F.lit("fn_"), "n_name").alias("predicate"))
    targets = n.select(F.col("n_nationkey").alias("object_id"), F.col("n_name").alias("object_name"))
    return S.policy_report(policies, predicates, targets)


@recipe
def rls_child_table(spark, d):
    """J-5: the same predicate bound to a second table (orders)."""
    sess, who = _rls_setup(spark, d)
    reg = S.PolicyRegistry().register("orders", S.session_policy("o_custkey"))
    ctx = S.AccessContext(who, X.AS_OF, sess)
    return load_table(spark, d, "orders", registry=reg, ctx=ctx).select("o_orderkey", "o_custkey")


@recipe
def rls_flag_filter(spark, d):
    """J-6: attribute policy -- only active rows, no admin exemption."""
    reg = S.PolicyRegistry().register("customer", S.flag_policy(F.col("c_acctbal") >= 0))
    ctx = S.AccessContext(S.Principal(S.ADMIN_USER), X.AS_OF)
    return load_table(spark, d, "customer", registry=reg, ctx=ctx).select("c_custkey")


@recipe
def rls_view_inherits(spark, d):
    """J-7: a view over a table with two policies returns the filtered rows (AND)."""
    sess, who = _rls_setup(spark, d)
    reg = (S.PolicyRegistry().register("customer", S.session_policy("c_custkey"))
           .register("customer", S.flag_policy(F.col("c_acctbal") >= 0)))
    ctx = S.AccessContext(who, X.AS_OF, sess)
    return customer_summary(load_table(spark, d, "customer", registry=reg, ctx=ctx))


@recipe
def policy_probe(spark, d):
    """J-8: predicate probe -- for every customer id, would the session policy let the
    non-admin principal see it?"""
    sess, who = _rls_setup(spark, d)
    ids = _t(spark, d, "customer").select("c_custkey")
    return S.probe(ids, "c_custkey", sess, who, X.AS_OF, name="allowed")


@recipe
def rls_all_principals(spark, d):
    """J-9: rows of orders each session holder may see, for all holders in one job."""
    return S.visibility_counts(_t(spark, d, "orders"), "o_custkey", X.stored_sessions(spark, d), X.AS_OF)


@recipe
def rls_policy_bitmaps(spark, d):
    """J-9, J-6: rows of orders each session holder may see under the session policy and either or both of two
    attribute policies, from bitmaps that one pass over orders makes."""
    policies = {"dear": F.col("o_totalprice") >= 150_000, "open": F.col("o_orderstatus") == "O"}
    maps = VB.write_policy_bitmaps(_t(spark, d, "orders"), "o_custkey", policies, shared_path(spark, "policy-bitmaps"))
    sets = {"n_session": [], "n_dear": ["dear"], "n_open": ["open"], "n_both": ["dear", "open"]}
    return VB.visible_to_holders(spark, maps, X.stored_sessions(spark, d), X.AS_OF, sets)


# ------------------------------------------------------- K: reports ----

@recipe
def active_sessions(spark, d):
    """K-1, H-10, H-11: active sessions with full name and minutes open at the as_of clock (boundary count)."""
    return R.active_sessions(X.stored_sessions(spark, d), _t(spark, d, "customer"), "c_custkey", "c_name", "c_mktsegment", X.AS_OF)


def _audit_24h(spark, d):
    log = X.access_log(_t(spark, d, "events"))
    return R.audit_report(log, "event_at", F.col("success"), X.AS_OF, hours=24)


@recipe
def audit_report_24h(spark, d):
    """K-3, H-9, F-4: last-24-hours report with a yes/no label."""
    return _audit_24h(spark, d).select("seq", "event_at", "usuario", "action", "exito", "detail")


@recipe
def audit_top_detail(spark, d):
    """K-4: latest three of the report, detail chosen by action."""
    rep = _audit_24h(spark, d)
    detail = F.when(F.col("action") == "error", F.col("detail")).otherwise(F.col("usuario"))
    top = R.audit_top(rep, 3, detail, F.col("success"), _log_order())
    return top.select("event_at", "action", "detalle", "estado")


@recipe
def audit_action_summary(spark, d):
    """K-5, D-4: per user and action: count, first and last time."""
    return R.action_summary(_t(spark, d, "events"), ["user_id", "event_type"], "ts")


@recipe
def audit_summary_prefix(spark, d):
    """K-5: the same summary for the users whose name starts with a prefix."""
    log = X.access_log(_t(spark, d, "events"))
    return R.action_summary(log, ["usuario", "action"], "event_at", user_prefix="u1")


AUDIT_CALLER = "app_admin"


@recipe
def audit_append(spark, d):
    """K-6, A-4, I-14, I-16: permission changes (time, caller and details from DEFAULTs) and
    failed logins appended to the audit table, ids continuing after the current maximum."""
    e = _t(spark, d, "events")
    changes = e.filter(F.col("event_type") == "click").select(
        F.lit("events").alias("object_name"), F.lit("SELECT").alias("permission_type"),
        (F.col("value") >= 50).alias("granted"), F.col("event_id").alias("_order"))
    fails = e.filter(F.col("event_type") == "error").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("login_name"), F.col("props").alias("details"),
        F.col("ts").alias("event_time"), F.col("event_id").alias("_order"))
    audit = A.append_audit(None, A.permission_changes(changes), AUDIT_CALLER, X.AS_OF)
    return A.append_audit(audit, A.failed_logins(fails), AUDIT_CALLER, X.AS_OF)


def _acl(spark, d):
    s, n, li, p = (_t(spark, d, t) for t in ("supplier", "nation", "lineitem", "part"))
    return X.principals(s, n), X.memberships(s), X.grants(li, s), X.objects(p)


@recipe
def permission_audit(spark, d):
    """K-7, C-5, B-6: user x role x object x permission; principals read as user and as
    role; system principals excluded."""
    pr, mem, gr, ob = _acl(spark, d)
    return R.permission_audit(pr, mem, gr, ob, excluded=X.SYSTEM_PRINCIPALS + ("Supplier#000000000",),
                              allowed_types=X.PRINCIPAL_TYPES)


@recipe
def role_permissions(spark, d):
    """K-8, C-6: permissions granted to one role (inner), object optional (left)."""
    pr, _, gr, ob = _acl(spark, d)
    return R.role_permissions("NATION_3", pr, gr, ob)


# Scope-level (brand) grants of three roles, and one REVOKE.
SCOPE_GRANTS = [("R:1", "SCOPE", "Brand#1", "SELECT", "DENY"), ("R:2", "SCOPE", "Brand#2", "SELECT", "GRANT"),
                ("R:3", "SCOPE", "Brand#3", "SELECT", "DENY"), ("R:4", "SCOPE", "Brand#4", "SELECT", "GRANT")]
SCOPE_REVOKES = [("R:2", "SCOPE", "Brand#2", "SELECT")]


@recipe
def effective_permissions(spark, d):
    """K-9: effective permission per (supplier, part): object + brand level, role membership,
    DENY wins, REVOKE removes a grant row."""
    s, li, p = _t(spark, d, "supplier"), _t(spark, d, "lineitem"), _t(spark, d, "part")
    requests = li.select(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("object_id"),
                         F.lit("SELECT").alias("permission")).distinct()
    members = s.select(F.col("s_suppkey").alias("user_id"), F.col("s_nationkey").cast("long").alias("role_id"))
    objs = p.select(F.col("p_partkey").alias("object_id"), F.col("p_brand").alias("scope"))
    schema = "grantee string, level string, securable string, permission string, state string"
    direct = li.select(
        F.concat(F.lit("U:"), F.col("l_suppkey").cast("string")).alias("grantee"), F.lit("OBJECT").alias("level"),
        F.col("l_partkey").cast("string").alias("securable"), F.lit("SELECT").alias("permission"),
        F.when(F.col("l_returnflag") == "R", F.lit("DENY")).otherwise(F.lit("GRANT")).alias("state"))
    grants = direct.unionByName(rows(spark, schema, SCOPE_GRANTS))
    revokes = rows(spark, "grantee string, level string, securable string, permission string", SCOPE_REVOKES)
    return R.effective_permissions(requests, members, objs, grants, revokes)


NESTED_ROLES = [(200, 100), (200, 300)]  # with 100 -> 200 from the regions, the first closes a cycle
NESTED_GRANTS = [("R:100", "SCOPE", "Brand#5", "SELECT", "GRANT"), ("R:300", "SCOPE", "Brand#1", "SELECT", "DENY"),
                 ("R:102", "SCOPE", "Brand#2", "SELECT", "GRANT"), ("R:103", "SCOPE", "Brand#5", "SELECT", "DENY"),
                 ("R:7", "SCOPE", "Brand#1", "SELECT", "GRANT"), ("R:8", "SCOPE", "Brand#3", "SELECT", "GRANT")]


@recipe
def effective_nested(spark, d):
    """K-9: effective permission through roles inside roles: nation -> region -> all -> top, with a
    cycle; a DENY on any path wins."""
    s, n, r = _t(spark, d, "supplier"), _t(spark, d, "nation"), _t(spark, d, "region")
    li, p = _t(spark, d, "lineitem"), _t(spark, d, "part")
    requests = li.select(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("object_id"), F.lit("SELECT").alias("permission")).distinct()
    members = s.select(F.col("s_suppkey").alias("user_id"), F.col("s_nationkey").cast("long").alias("role_id"))
    nested = (n.select(F.col("n_nationkey").cast("long").alias("role_id"), (F.col("n_regionkey") + 100).cast("long").alias("parent_id"))
              .unionByName(r.select((F.col("r_regionkey") + 100).cast("long").alias("role_id"), F.lit(200).cast("long").alias("parent_id")))
              .unionByName(rows(spark, "role_id bigint, parent_id bigint", NESTED_ROLES)))
    objs = p.select(F.col("p_partkey").alias("object_id"), F.col("p_brand").alias("scope"))
    granted = rows(spark, "grantee string, level string, securable string, permission string, state string", NESTED_GRANTS)
    return R.effective_permissions(requests, members, objs, granted, role_memberships=nested)


@recipe
def archive_split(spark, d):
    """K-10: retention at 20 days -- rows older than that are written to a date-partitioned
    archive; kept rows per day, and archived rows per day read back from the archive."""
    kept, old = R.archive_split(_t(spark, d, "events"), "ts", X.AS_OF, days=20)
    path = shared_path(spark, "archive")
    R.write_archive(old, path, "ts", run_id="as_of_" + X.AS_OF[:10])
    written = T.StructType([*old.schema.fields, T.StructField("archive_day", T.DateType()), T.StructField("run", T.StringType())])
    archived = spark.read.schema(written).parquet(path).groupBy(F.col("archive_day").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    kept_days = kept.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return (kept_days.withColumn("bucket", F.lit("KEEP"))
            .unionByName(archived.withColumn("bucket", F.lit("ARCHIVE"))).select("day", "bucket", "n"))


# Fixed value: a clock inside a day, so that the retention cut divides one.
RETAIN_AT = "2024-01-31 06:30:00"


@recipe
def retention_by_day(spark, d):
    """K-10: retention at 20 days of a log stored by day in two loads -- whole days move, the rows of the divided day are
    rewritten.  Rows per day and part, counted from the files, and how many of them the run wrote."""
    events = _t(spark, d, "events")
    late = F.coalesce(F.col("event_type") == "error", F.lit(False))
    log = RT.write_day_log(events.filter(~late), shared_path(spark, "day-log"), "ts").append(events.filter(late))
    log = log.retain(spark, RETAIN_AT, days=20)
    parts = []
    for bucket, state in (("KEEP", RT.LIVE), ("ARCHIVE", RT.ARCHIVED)):
        parts.append(log.read(spark, state).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", F.lit(bucket)))
    counted = parts[0].unionByName(parts[1])
    wrote = log.catalogue(spark).groupBy(F.col("day").alias("_day"), F.when(F.col("state") == RT.LIVE, F.lit("KEEP")).otherwise(F.lit("ARCHIVE")).alias("_bucket")).agg(
        F.coalesce(F.sum(F.when(F.col("rewritten"), F.col("n"))), F.lit(0).cast("long")).alias("n_rewritten"))
    return counted.join(wrote, F.col("day").eqNullSafe(F.col("_day")) & (F.col("bucket") == F.col("_bucket"))).select("day", "bucket", "n", "n_rewritten")


@recipe
def snapshot_history(spark, d):
    """K-11: run history with duration in seconds (order date -> ship date), top 5 per flag."""
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    runs = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "l_shipdate")
    order = [F.desc("o_orderdate"), F.desc("l_orderkey"), F.desc("l_linenumber"), F.asc("l_partkey"),
             F.asc("l_suppkey"), F.asc("l_shipdate")]
    out = R.snapshot_history(runs, "l_returnflag", "o_orderdate", "l_shipdate", order, k=5)
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate", "duration_s")


@recipe
def quality_checklist(spark, d):
    """K-12, A-5, D-7, G-2, H-5: eight rules -> status + detail, numbered by severity."""
    c, o, li, p, e = (_t(spark, d, t) for t in ("customer", "orders", "lineitem", "part", "events"))
    sess = X.stored_sessions(spark, d)
    n_txt = lambda suffix: (lambda n: F.concat(n.cast("string"), F.lit(suffix)))
    # both event rules read one aggregate: a single scan of the events table
    ev_counts = e.agg(F.count(F.lit(1)).alias("n"),
                      F.count_if(~F.coalesce(tsql.is_json("props"), F.lit(True))).alias("n_bad_json"))
    rules = [
        R.CheckRule("customers present", R.count_of(c), R.status_if(lambda n: n > 0, R.STATUS_WARN), n_txt(" customers")),
        R.CheckRule("order keys unique", R.count_of(C.pk_violations(o, ["o_orderkey"])), R.status_if(lambda n: n == 0), n_txt(" bad keys")),
        R.CheckRule("line keys unique", R.count_of(C.pk_violations(li, ["l_orderkey", "l_linenumber"])), R.status_if(lambda n: n == 0), n_txt(" bad keys")),
        R.CheckRule("orders have customer", R.count_of(C.fk_violations(o, c, ["o_custkey"], ["c_custkey"])), R.status_if(lambda n: n == 0), n_txt(" orphans")),
        R.CheckRule("sessions usable", R.count_of(S.usable_sessions(sess, X.AS_OF)), R.status_if(lambda n: n >= 2), n_txt(" usable sessions")),
        R.CheckRule("event json valid", ev_counts, R.status_if(lambda n: n == 0), n_txt(" invalid"), col="n_bad_json"),
        R.CheckRule("audit records", ev_counts, R.status_if(lambda n: n > 0, R.STATUS_WARN), n_txt(" records")),
        R.CheckRule("parts priced", R.count_of(p.filter(F.col("p_retailprice") <= 0)), R.status_if(lambda n: n == 0), n_txt(" unpriced")),
    ]
    return R.quality_checklist(rules)


# -------------------------------------------- L: JSON, history, metadata ----

def damaged_props(events: DataFrame) -> DataFrame:
    """``events.props`` with some documents damaged: truncated, bare scalar, empty."""
    et, v, pr = F.col("event_type"), F.col("value"), F.col("props")
    bad = (F.when((et == "error") & (v > 40), F.expr("substring(props, 1, length(props) - 1)"))
           .when((et == "view") & (v > 40), F.col("event_id").cast("string"))
           .when((et == "click") & (v > 100), F.lit(""))
           .when((et == "click") & (v > 60), F.concat(F.lit('{"k": 1, "k": '), F.col("event_id").cast("string"), F.lit("}")))
           .when((et == "signup") & (v > 60), F.concat(F.lit("\n\t"), pr))
           .when((et == "signup") & (v > 30), F.concat(pr, F.lit(" x")))
           .otherwise(pr))
    return events.select("event_id", bad.alias("props"))


@recipe
def json_validity(spark, d):
    """H-12: ISJSON per row (the admission flag)."""
    p = damaged_props(_t(spark, d, "events"))
    return p.withColumn("is_valid", tsql.is_json("props"))


def shaped_props(events: DataFrame) -> DataFrame:
    """``events.props`` with nested values for some event types."""
    et = F.col("event_type")
    doc = (F.when(et == "view", F.lit('{"k": {"v": 1}}'))
           .when(et == "click", F.lit('{"k": [1, 2]}'))
           .when((et == "signup") & (F.col("value") < 20), F.lit('[{"k": 1}]'))
           .when((et == "signup") & (F.col("value") < 40), F.concat(F.lit('\n{"k": '), F.col("event_id").cast("string"), F.lit('.50, "origen": 1e2}')))
           .when(et == "signup", F.concat(F.lit('{"k": 1'), F.repeat(F.col("event_id").cast("string"), 9), F.lit(', "k": 0}')))
           .otherwise(F.col("props")))
    return events.select("event_id", doc.alias("props"))


@recipe
def json_admission(spark, d):
    """L-1: JSON admission check -- the rows a CHECK (ISJSON(props) = 1) would refuse."""
    return JS.json_violations(damaged_props(_t(spark, d, "events")), "props")


@recipe
def json_extract(spark, d):
    """L-2, H-13: JSON_VALUE of a present, nested and missing path."""
    p = shaped_props(_t(spark, d, "events"))
    return JS.json_props(p, "props", {"k": "$.k", "origen": "$.origen"}, keep=["event_id"])


@recipe
def scd2_history(spark, d):
    """L-3, H-4: order-status history per customer with half-open validity."""
    o = _t(spark, d, "orders")
    return H.scd2(o, ["o_custkey"], "o_orderdate", ["o_orderkey"], ["o_orderstatus"])


@recipe
def scd2_apply(spark, d):
    """L-4: apply an upsert/delete batch to current + history."""
    c, s = _t(spark, d, "customer"), _t(spark, d, "supplier")
    start = tsql.ts_literal("2024-01-01 00:00:00")
    current = c.select("c_custkey", "c_mktsegment", start.alias("valid_from"))
    history = spark.createDataFrame([], "c_custkey bigint, c_mktsegment string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    changes = c.filter((F.col("c_acctbal") < 0) | (F.col("c_nationkey") == 24)).select(
        "c_custkey", F.when(F.col("c_nationkey") == 24, F.lit("D")).otherwise(F.lit("U")).alias("op"),
        F.lit("DELINQUENT").alias("c_mktsegment"))
    newcomers = s.select((F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.lit("U").alias("op"),
                         F.lit("SUPPLIER").alias("c_mktsegment"))
    cur, hist = H.scd2_apply(current, history, changes.unionByName(newcomers), ["c_custkey"], X.as_of())
    return cur.withColumn("valid_to", tsql.ts_literal(H.OPEN_END)).unionByName(hist)


@recipe
def scd2_merge_runs(spark, d):
    """L-4: orders as runs of changes (several of one customer in one batch, deletes among them) merged into
    current rows and a history that has rows already; changes older than the current version come back as late."""
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    start, before = tsql.ts_literal("1998-03-01 00:00:00"), tsql.ts_literal("1997-01-01 00:00:00")
    current = c.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_mktsegment", start.alias("valid_from"))
    history = c.select("c_custkey", F.lit("PROSPECT").alias("c_mktsegment"), before.alias("valid_from"), start.alias("valid_to"))
    changes = o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"), "o_orderkey",
                       F.when(F.col("o_orderpriority") == "5-LOW", F.lit("D")).otherwise(F.lit("U")).alias("op"),
                       F.col("o_orderpriority").alias("c_mktsegment"))
    cur, hist, late = H.scd2_merge(current, history, changes, ["c_custkey"], "at", ["o_orderkey"])
    late_rows = late.select("c_custkey", F.concat(F.lit("LATE "), "c_mktsegment").alias("c_mktsegment"), F.col("at").alias("valid_from"), F.col("at").alias("valid_to"))
    return cur.withColumn("valid_to", tsql.ts_literal(H.OPEN_END)).unionByName(hist).unionByName(late_rows)


@recipe
def mv_change_feed(spark, d):
    """L-5: the counts kept by a change feed of two batches; both are sent again, one before and one after
    their deltas were folded into the base, and count once."""
    li = _t(spark, d, "lineitem")
    feed = CountFeed(shared_path(spark, "count_feed"), T.StructType([DRIVER["lineitem"]["l_partkey"]]))
    feed.create(li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("total")))
    came = li.filter(F.col("l_returnflag") == "R").select("l_partkey", F.lit(1).alias("sign"))
    went = li.filter((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).select("l_partkey", F.lit(-1).alias("sign"))
    for batch, changes in ((0, came), (0, came), (1, went)):
        feed.write_batch(changes, batch)
    feed.compact(spark, 0)
    for batch, changes in ((0, came), (1, went)):
        feed.write_batch(changes, batch)
    return feed.counts(spark)


@recipe
def mv_incremental(spark, d):
    """L-5: per-course counts materialised to the shared folder, then refreshed with the
    inserted and deleted rows (signed deltas) instead of being recomputed."""
    li = _t(spark, d, "lineitem")
    mv_path = shared_path(spark, "mv_counts")
    li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("total")).write.parquet(mv_path)
    stored = spark.read.parquet(mv_path)
    inserted = li.filter(F.col("l_returnflag") == "R").select("l_partkey")
    deleted = li.filter((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).select("l_partkey")
    refreshed, _ = H.refresh_counts(stored, inserted, deleted, ["l_partkey"])
    return refreshed


@recipe
def objects_by_schema_type(spark, d):
    """L-6, D-3: object count per (brand, flag); line items pre-aggregated per part first."""
    li, p = _t(spark, d, "lineitem"), _t(spark, d, "part")
    per_part = li.groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).alias("_n"))
    j = per_part.join(p.select("p_partkey", "p_brand"), per_part["l_partkey"] == p["p_partkey"])
    return R.object_inventory(j, ["p_brand", "l_returnflag"], weight="_n")


IMPACT_TARGET = 7


@recipe
def dependency_impact(spark, d):
    """L-7: which orders refer to part 7 (one hop)."""
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    refs = R.impact(li, "l_orderkey", "l_partkey", IMPACT_TARGET)
    return o.join(refs, o["o_orderkey"] == refs["l_orderkey"], "left_semi").select("o_orderkey", "o_custkey", "o_orderdate")


@recipe
def storage_stats(spark, d):
    """L-8, C-3, D-5, H-7: rows and SUM(units)*8 DIV 1024 per region and nation,
    pre-aggregated at every join step of the chain."""
    r, n, c, o, li = (_t(spark, d, t) for t in ("region", "nation", "customer", "orders", "lineitem"))
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    per_cust = per_order.join(o.select("o_orderkey", "o_custkey"), per_order["l_orderkey"] == o["o_orderkey"]).groupBy(
        "o_custkey").agg(F.sum("n").alias("n"), F.sum("q").alias("q"))
    per_nation = per_cust.join(c.select("c_custkey", "c_nationkey"), per_cust["o_custkey"] == c["c_custkey"]).groupBy(
        "c_nationkey").agg(F.sum("n").alias("n"), F.sum("q").alias("q"))
    geo = per_nation.join(n, per_nation["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    return R.storage_stats(geo, ["r_name", "n_name"], units="q", rows="n")


# --------------------------------------------------------- entry point ----

def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Protected read end to end: session events -> session table -> policy
    injected at load -> active-sessions view, for a non-admin principal."""
    sess, who = _rls_setup(spark, d)
    reg = S.PolicyRegistry().register("customer", S.session_policy("c_custkey"))
    ctx = S.AccessContext(who, X.AS_OF, sess)
    people = load_table(spark, d, "customer", registry=reg, ctx=ctx)
    return R.active_sessions(sess, people, "c_custkey", "c_name", "c_mktsegment", X.AS_OF)
