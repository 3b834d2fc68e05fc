from pyspark.sql import functions as F

from govframe.functions import like_tsql
from govframe.operators import constraints as C
from govframe.schemas import ACADEMY, ACADEMY_DOMAINS, CREDITS_RANGE, MIN_STUDENT_AGE, PERIOD_PATTERN


def test_seed_is_clean(academy):
    s, e = academy["students"], academy["enrolments"]
    assert C.pk_violations(s, ["student_id"]).count() == 0
    assert C.pk_violations(e, ["student_id", "course_id", "period"]).count() == 0
    assert C.unique_violations(s, ["email"]).count() == 0
    assert C.fk_violations(e, s, ["student_id"], ["student_id"]).count() == 0
    assert C.fk_violations(s, academy["careers"], ["career_id"], ["career_id"]).count() == 0
    assert C.domain_violations(s, ACADEMY_DOMAINS["students"]).count() == 0


def test_enrolments_per_course(academy):
    got = {r.course_id: r.n for r in academy["enrolments"].groupBy("course_id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 2, 2: 2, 3: 3, 4: 1, 5: 2}


def test_unique_nulls_are_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, email string")
    v = C.unique_violations(df, ["email"]).collect()
    assert len(v) == 1 and v[0].email is None and v[0].n == 2


def test_pk_null_and_duplicate(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    got = {(r.id, r.reason) for r in C.pk_violations(df, ["id"]).collect()}
    assert got == {(1, "DUPLICATE"), (None, "NULL_KEY")}


def test_check_passes_on_null(spark):
    df = spark.createDataFrame([(1, 20), (2, None), (3, 15)], "id int, age int")
    v = C.check_violations(df, {"min_age": F.col("age") >= MIN_STUDENT_AGE}, keep=["id"]).collect()
    assert [(r.id, r.rule) for r in v] == [(3, "min_age")]


def test_rejections_name_their_rule(spark, academy):
    students, courses = academy["students"], academy["courses"]
    # insert with career 999 -> FK rejected, 0 rows accepted
    cand = spark.createDataFrame([(31, "No", "Career", "none@school.test", 20, True, 999, None)], ACADEMY["students"])
    acc, rej = C.validated_append(students, cand, ["student_id"],
                                  foreign_keys=[(academy["careers"], ["career_id"], ["career_id"], "career")])
    assert acc.count() == 0 and rej.first().rules == ["fk:career"]
    # a second course of the same name -> UNIQUE rejected
    dup = spark.createDataFrame([(9, "Chart Reading", 5, None)], ACADEMY["courses"])
    acc, rej = C.validated_append(courses, dup, ["course_id"], unique={"name": ["course_name"]},
                                  checks={"credits": F.col("credits").between(*CREDITS_RANGE)})
    assert acc.count() == 0 and rej.first().rules == ["unique:name"]
    # periods of the wrong length, half or century are rejected
    per = spark.createDataFrame([(12, 1, "31S1"), (12, 2, "2031S3"), (12, 4, "3031S1"), (12, 5, "2031S1")], ACADEMY["enrolments"])
    acc, rej = C.validated_append(academy["enrolments"], per, ["student_id", "course_id", "period"],
                                  checks={"period": like_tsql("period", PERIOD_PATTERN)})
    assert [r.period for r in acc.collect()] == ["2031S1"]
    assert sorted(r.period for r in rej.collect()) == ["2031S3", "3031S1", "31S1"]


def test_validated_append_leaves_no_violations(spark, academy):
    cand = spark.createDataFrame(
        [(11, 2, "2031S1"), (11, 2, "2031S1"), (13, 99, "2031S2"), (15, 5, "2031S2"), (11, 1, "2031S2")], ACADEMY["enrolments"])
    acc, rej = C.validated_append(academy["enrolments"], cand, ["student_id", "course_id", "period"],
                                  foreign_keys=[(academy["courses"], ["course_id"], ["course_id"], "course")])
    new = academy["enrolments"].unionByName(acc)
    assert C.pk_violations(new, ["student_id", "course_id", "period"]).count() == 0
    assert C.fk_violations(new, academy["courses"], ["course_id"], ["course_id"]).count() == 0
    assert acc.count() == 1 and rej.count() == 4


def test_apply_defaults_only_missing(spark):
    df = spark.createDataFrame([(1, None)], "id int, status string")
    out = C.apply_defaults(df, {"status": "ACTIVE", "active": True}).first()
    assert out.status is None and out.active is True


def test_unique_check_with_nulls_against_target(spark):
    target = spark.createDataFrame([(1, None), (2, "a@x")], "id int, email string")
    cand = spark.createDataFrame([(3, None), (4, "a@x"), (5, "b@x")], "id int, email string")
    acc, rej = C.validated_append(target, cand, ["id"], unique={"email": ["email"]})
    assert sorted(r.id for r in acc.collect()) == [5]
    assert sorted((r.id, r.rules[0]) for r in rej.collect()) == [(3, "unique:email"), (4, "unique:email")]


def test_scalar_lookup_errors_on_many_rows(spark):
    import pytest

    from govframe.operators.joins import lookup_one

    people = spark.createDataFrame([(1, "a@x"), (2, "a@x"), (3, "b@x")], "id int, email string")
    orders = spark.createDataFrame([(10, 1), (11, 3)], "oid int, id int")
    ok = orders.filter(F.col("id") == lookup_one(people, F.col("email") == "b@x", "id")).collect()
    assert [r.oid for r in ok] == [11]
    none = orders.filter(F.col("id") == lookup_one(people, F.col("email") == "zz", "id")).collect()
    assert none == []
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        orders.filter(F.col("id") == lookup_one(people, F.col("email") == "a@x", "id")).collect()


def test_governed_table_validate_evolve(spark, academy):
    from govframe.operators.governed import GovernedTable, Reference

    courses = GovernedTable(
        "courses", academy["courses"], ("course_id",), unique={"name": ("course_name",)},
        checks={"credits": (("credits",), lambda c: c.between(*CREDITS_RANGE))},
        domains={"course_name": {"not_null": True, "max_len": 100}},
    )
    assert all(v.count() == 0 for v in courses.violations().values())
    batch = spark.createDataFrame([(9, "Chart Reading", 5, None), (10, "Sonar", 12, None), (11, "Knots", 4, None)],
                                  ACADEMY["courses"])
    nxt, rej = courses.append(batch)
    assert nxt.df.count() == 6
    assert sorted((r.course_id, r.rules[0]) for r in rej.collect()) == [(9, "unique:name"), (10, "check:credits")]
    # rename the checked column: the CHECK and the domain follow it
    renamed = nxt.evolve([("rename", "credits", "ects"), ("rename", "course_name", "title")])
    assert "ects" in renamed.df.columns and renamed.checks["credits"][0] == ("ects",)
    assert renamed.unique["name"] == ("title",) and "title" in renamed.domains
    bad = renamed.df.limit(1).withColumn("course_id", F.lit(99)).withColumn("ects", F.lit(0).cast("short"))
    _, rej2 = renamed.validate(bad)
    assert sorted(rej2.first().rules) == ["check:credits", "unique:name"]
    enrol = GovernedTable("enrolments", academy["enrolments"], ("student_id", "course_id", "period"),
                          references={"course": Reference(("course_id",), renamed.df, ("course_id",))})
    orphan = spark.createDataFrame([(11, 77, "2031S2")], ACADEMY["enrolments"])
    assert enrol.validate(orphan)[1].first().rules == ["fk:course"]


def test_governed_table_refuses_dropping_a_constrained_column(spark, academy):
    import pytest

    from govframe.operators.governed import GovernedTable

    t = GovernedTable("courses", academy["courses"], ("course_id",),
                      checks={"credits": (("credits",), lambda c: c.between(*CREDITS_RANGE))})
    with pytest.raises(ValueError):
        t.evolve([("drop", "credits")])
    assert "credits" not in t.without("credits").evolve([("drop", "credits")]).df.columns


def test_governed_table_add_constraint_if_absent(spark, academy):
    from govframe.operators.governed import GovernedTable, Reference

    students = GovernedTable("students", academy["students"], ("student_id",))
    fk = Reference(("career_id",), academy["careers"], ("career_id",))
    once = students.with_reference("career", fk)
    twice = once.with_reference("career", Reference(("contact_id",), academy["careers"], ("career_id",)))
    assert twice.references["career"].columns == ("career_id",)  # the existing constraint is kept
    assert once.violations()["fk:career"].count() == 0
    checked = once.with_check("adult", ["age"], lambda a: a >= 16).with_unique("email", ["email"])
    assert set(checked.violations()) == {"primary_key", "unique:email", "fk:career", "check"}
    assert all(v.count() == 0 for v in checked.violations().values())


def test_datetime_default_is_wall_clock(spark):
    import datetime as dt

    df = spark.createDataFrame([(1,)], "id int")
    out = C.apply_defaults(df, {"at": dt.datetime(2024, 1, 31, 23, 30)}).first()
    assert out.at == dt.datetime(2024, 1, 31, 23, 30)


def test_a_batch_tagged_once_and_stored_splits_the_same_way(spark, tmp_path):
    target = spark.createDataFrame([(1, "a")], "k int, rules_of string")
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "z"), (None, None)], "k int, _outcome string")
    plain, stored = [C.validated_append(target, batch, ["k"], checks={"no_z": F.col("_outcome") != "z"}, store=s) for s in (None, str(tmp_path / "batch"))]
    for a, b in zip(plain, stored, strict=True):
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert [tuple(r) for r in stored[0].collect()] == [(2, "y")]
    assert "Join" not in stored[1]._jdf.queryExecution().executedPlan().toString()
    empty = C.validated_append(target, batch.limit(0), ["k"], store=str(tmp_path / "none"))
    assert [f.count() for f in empty] == [0, 0]
