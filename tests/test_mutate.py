from decimal import Decimal

from pyspark.sql import functions as F

from govframe.functions import ceil_int
from govframe.operators import constraints as C
from govframe.operators import mutate as M
from govframe.schemas import CREDITS_RANGE

ACADEMY_FKS = [
    M.ForeignKey("enrolments", ("student_id",), "students", ("student_id",), "cascade"),
    M.ForeignKey("enrolments", ("course_id",), "courses", ("course_id",), "cascade"),
    M.ForeignKey("student_languages", ("student_id",), "students", ("student_id",), "cascade"),
    M.ForeignKey("student_networks", ("student_id",), "students", ("student_id",), "cascade"),
    M.ForeignKey("students", ("career_id",), "careers", ("career_id",), "set_null"),
]


def test_cascade_delete_of_a_student(academy):
    new, block = M.delete_cascade(academy, ACADEMY_FKS, "students", F.col("student_id") == 11)
    assert block is None
    assert (new["enrolments"].count(), new["student_languages"].count(), new["student_networks"].count()) == (7, 3, 2)
    for child in ("enrolments", "student_languages", "student_networks"):
        assert C.fk_violations(new[child], new["students"], ["student_id"], ["student_id"]).count() == 0


def test_set_null_on_career_delete(academy):
    new, _ = M.delete_cascade(academy, ACADEMY_FKS, "careers", F.col("career_id") == 3)
    got = {r.student_id: r.career_id for r in new["students"].collect()}
    assert got == {11: 2, 12: 2, 13: 1, 14: None, 15: None, 16: None}


def test_restrict_blocks(spark, academy):
    fks = [M.ForeignKey("students", ("contact_id",), "contacts", ("contact_id",), "no_action")]
    contacts = spark.createDataFrame([(5, "a@x", None), (9, "b@x", None)], "contact_id int, email string, phone string")
    tables = dict(academy, contacts=contacts)
    _, block = M.delete_cascade(tables, fks, "contacts", F.col("contact_id").isin(5, 9))
    assert block.count() == 1


def test_guarded_update_of_matching_courses(academy):
    courses = academy["courses"]
    bump = {"credits": F.col("credits") + ceil_int(F.col("credits") * F.lit(Decimal("0.03")))}
    cond = F.col("course_name").like("%Data%")
    out = M.guarded_update(courses, cond, bump, max_rows=10)
    got = {r.course_name: r.credits for r in out.collect()}
    assert got == {"Tides and Currents": 2, "Data Buoys": 10, "Map Projections": 5, "Field Data Methods": 11, "Chart Reading": 1}
    blocked = M.guarded_update(courses, cond, bump, max_rows=0)
    assert {r.course_name: r.credits for r in blocked.collect()}["Data Buoys"] == 9


def test_guarded_update_can_break_check(spark, academy):
    ten = academy["courses"].withColumn("credits", F.lit(10).cast("short"))
    bump = {"credits": F.col("credits") + ceil_int(F.col("credits") * F.lit(Decimal("0.03")))}
    out = M.guarded_update(ten, F.col("course_name") == "Data Buoys", bump, max_rows=10)
    v = C.check_violations(out, {"credits": F.col("credits").between(*CREDITS_RANGE)}, keep=["course_id"])
    assert [r.course_id for r in v.collect()] == [2]


def test_staged_update_savepoint(academy):
    c = academy["courses"]
    stages = [(F.col("course_id") <= 3, {"credits": F.col("credits") + 1}),
              (F.col("course_id").between(4, 6), {"credits": F.col("credits") + 1})]
    got = {r.course_id: r.credits for r in M.staged_update(c, stages, keep=1).collect()}
    assert got == {1: 3, 2: 10, 3: 6, 4: 10, 5: 1}


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, v string")
    assert sorted(r.id for r in M.delete_where(df, F.col("v") == "a").collect()) == [2, 3]


def test_evolve_and_extract(spark, academy):
    s = M.evolve(academy["students"], [("rename", "age", "edad"), ("add", "country", "MX")])
    assert "edad" in s.columns and s.first().country == "MX"
    dim, fact = M.extract_dimension(academy["students"], ["career_id"], "career_key")
    assert dim.count() == 4  # three careers + NULL
    assert fact.filter(F.col("career_key").isNull()).count() == 0


def test_explode_attribute(spark):
    df = spark.createDataFrame([(1, "es, en"), (2, "fr")], "id int, langs string")
    assert sorted(tuple(r) for r in M.explode_attribute(df, ["id"], "langs", out="lang").collect()) == [
        (1, "en"), (1, "es"), (2, "fr")]


def test_cascade_on_driver_tables_leaves_no_orphans(spark):
    from govframe.sources.tables import load_table
    from tests.conftest import SF_SMALL

    tables = {t: load_table(spark, SF_SMALL, t) for t in ("customer", "orders", "lineitem")}
    fks = [M.ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",), "cascade"),
           M.ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",), "cascade")]
    new, block = M.delete_cascade(tables, fks, "customer", F.col("c_acctbal") < 0)
    assert block is None
    assert C.fk_violations(new["orders"], new["customer"], ["o_custkey"], ["c_custkey"]).count() == 0
    assert C.fk_violations(new["lineitem"], new["orders"], ["l_orderkey"], ["o_orderkey"]).count() == 0
    gone = tables["orders"].count() - new["orders"].count()
    assert gone == tables["orders"].join(tables["customer"].filter("c_acctbal < 0"),
                                         F.col("o_custkey") == F.col("c_custkey"), "left_semi").count()


def test_cascade_diamond_reaches_grandchildren(spark):
    # a -> c is listed before a -> b -> c: c's child d must still lose rows reached via b
    a = spark.createDataFrame([(1,), (2,)], "a int")
    b = spark.createDataFrame([(10, 1), (20, 2)], "b int, a int")
    c = spark.createDataFrame([(100, 2, 10), (200, 1, 20)], "c int, a int, b int")
    d = spark.createDataFrame([(1000, 100), (2000, 200)], "d int, c int")
    fks = [M.ForeignKey("c", ("a",), "a", ("a",), "cascade"),
           M.ForeignKey("b", ("a",), "a", ("a",), "cascade"),
           M.ForeignKey("c", ("b",), "b", ("b",), "cascade"),
           M.ForeignKey("d", ("c",), "c", ("c",), "cascade")]
    new, _ = M.delete_cascade({"a": a, "b": b, "c": c, "d": d}, fks, "a", F.col("a") == 1)
    assert [r.c for r in new["c"].collect()] == []          # 200 via a, 100 via b
    assert [r.d for r in new["d"].collect()] == []          # both grandchildren gone
    assert [r.b for r in new["b"].collect()] == [20]


def test_cascade_cycle_rejected(spark):
    import pytest

    t = spark.createDataFrame([(1,)], "k int")
    fks = [M.ForeignKey("x", ("k",), "y", ("k",), "cascade"), M.ForeignKey("y", ("k",), "x", ("k",), "cascade")]
    with pytest.raises(ValueError):
        M.delete_cascade({"x": t, "y": t}, fks, "x", F.col("k") == 1)


def test_explode_attribute_literal_separator(spark):
    df = spark.createDataFrame([(1, "a|b||c"), (2, None)], "id int, v string")
    got = sorted(tuple(r) for r in M.explode_attribute(df, ["id"], "v", sep="|").collect())
    assert got == [(1, "a"), (1, "b"), (1, "c")]


def test_no_action_is_checked_after_all_other_actions(spark):
    """a cascades to b and to d, d cascades to c, and c refers to b with NO ACTION: whether the
    delete is blocked depends on the rows that are left, not on the order of the keys."""
    import itertools

    a = spark.createDataFrame([(1,), (2,)], "a int")
    b = spark.createDataFrame([(10, 1), (20, 2)], "b int, a int")
    d = spark.createDataFrame([(5, 1), (6, 2)], "d int, a int")
    fks = [M.ForeignKey("b", ("a",), "a", ("a",), "cascade"), M.ForeignKey("d", ("a",), "a", ("a",), "cascade"),
           M.ForeignKey("c", ("d",), "d", ("d",), "cascade"), M.ForeignKey("c", ("b",), "b", ("b",), "no_action")]
    for rows, blocked in (([(100, 5, 10)], []), ([(100, 5, 10), (200, 6, 10)], [200])):
        c = spark.createDataFrame(rows, "c int, d int, b int")
        for order in itertools.permutations(fks):
            new, block = M.delete_cascade({"a": a, "b": b, "c": c, "d": d}, order, "a", F.col("a") == 1)
            assert [r.c for r in new["c"].collect()] == blocked
            assert block.count() == len(blocked)


def test_update_of_a_referenced_key(spark):
    p = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    c = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "c int, k int")
    fks = [M.ForeignKey("child", ("k",), "p", ("k",), "no_action")]
    new, block = M.update_key({"p": p, "child": c}, fks, "p", F.col("k") == 1, {"k": F.col("k") + 100})
    assert sorted(r.k for r in new.collect()) == [2, 3, 101]
    assert [(r.child_table, r.child_key) for r in block.collect()] == [("child", '{"k":1}')]
    _, block = M.update_key({"p": p, "child": c}, fks, "p", F.col("k") == 3, {"k": F.lit(9)})
    assert block.count() == 0
    _, block = M.update_key({"p": p, "child": c}, fks, "p", F.col("k") <= 2, {"k": 3 - F.col("k")})
    assert block.count() == 0  # the two keys change places: every child still finds its key
    _, block = M.update_key({"p": p, "child": c}, [], "p", F.col("k") == 1, {"k": F.lit(7)})
    assert block.count() == 0
