"""Walk through the governed academy model with the library's API.

Run: ``python examples/academy_walkthrough.py``.  Uses the small seed rows of
``tests/fixtures.py`` (students, careers, courses, enrolments, languages,
networks) and prints each step's result: seed, reject bad inserts, guarded update, cascade
and SET NULL deletes, login / logout, the session view under row-level
security, the audit report and the numbered checklist.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from govframe.functions import ceil_int, like_tsql  # noqa: E402
from govframe.operators import constraints as C  # noqa: E402
from govframe.operators import mutate as M  # noqa: E402
from govframe.operators import reports as R  # noqa: E402
from govframe.operators import security as S  # noqa: E402
from govframe.operators.governed import GovernedTable  # noqa: E402
from govframe.schemas import ACADEMY, CREDITS_RANGE, PERIOD_PATTERN  # noqa: E402
from govframe.session import build_session  # noqa: E402
from tests.fixtures import build_academy  # noqa: E402

T0 = dt.datetime(2025, 1, 10, 9, 0)


def main() -> None:
    spark = build_session(master="local[*]", app_name="academy-walkthrough", shuffle_partitions=8)
    db = build_academy(spark)

    print("1. enrolments per course")
    db["enrolments"].groupBy("course_id").agg(F.count("*").alias("total")).orderBy("course_id").show()

    print("2. inserts that the constraints reject")
    bad_student = spark.createDataFrame([(31, "No", "Career", "none@school.test", 20, True, 999, None)], ACADEMY["students"])
    _, rej = C.validated_append(db["students"], bad_student, ["student_id"],
                                foreign_keys=[(db["careers"], ["career_id"], ["career_id"], "career")])
    rej.select("student_id", "rules").show(truncate=False)
    periods = spark.createDataFrame([(12, 1, "31S1"), (12, 2, "2031S3"), (12, 5, "2031S1")], ACADEMY["enrolments"])
    acc, rej = C.validated_append(db["enrolments"], periods, ["student_id", "course_id", "period"],
                                  checks={"period": like_tsql("period", PERIOD_PATTERN)})
    rej.show(truncate=False)
    db["enrolments"] = db["enrolments"].unionByName(acc)

    print("2b. courses declared with their constraints; a batch appended; the checked column renamed")
    courses_t = GovernedTable("courses", db["courses"], ("course_id",), unique={"name": ("course_name",)},
                              checks={"credits": (("credits",), lambda c: c.between(*CREDITS_RANGE))})
    batch = spark.createDataFrame([(9, "Chart Reading", 5, None), (10, "Sonar", 12, None), (11, "Knots", 4, None)],
                                  ACADEMY["courses"])
    courses_t, rejected = courses_t.append(batch)
    rejected.select("course_id", "course_name", "rules").show(truncate=False)
    courses_t = courses_t.evolve([("rename", "credits", "ects")])
    print("   CHECK now reads", courses_t.checks["credits"][0], "; courses:", courses_t.df.count())

    print("3. guarded update: +3 % credits on courses named like '%Data%', at most 10 rows")
    bump = {"credits": F.col("credits") + ceil_int(F.col("credits") * F.lit(Decimal("0.03")))}
    courses = M.guarded_update(db["courses"], F.col("course_name").like("%Data%"), bump, max_rows=10)
    C.check_violations(courses, {"credits": F.col("credits").between(*CREDITS_RANGE)}, keep=["course_id"]).show()
    courses.filter(F.col("course_name") == "Data Buoys").show()

    print("4. delete student 11: enrolments, languages and networks follow")
    fks = [M.ForeignKey("enrolments", ("student_id",), "students", ("student_id",), "cascade"),
           M.ForeignKey("student_languages", ("student_id",), "students", ("student_id",), "cascade"),
           M.ForeignKey("student_networks", ("student_id",), "students", ("student_id",), "cascade"),
           M.ForeignKey("students", ("career_id",), "careers", ("career_id",), "set_null")]
    after, _ = M.delete_cascade(db, fks, "students", F.col("student_id") == 11)
    for t in ("enrolments", "student_languages", "student_networks"):
        print(f"   {t}: {db[t].count()} -> {after[t].count()}")
    after, _ = M.delete_cascade(db, fks, "careers", F.col("career_id") == 3)
    after["students"].filter(F.col("student_id").isin(15, 16)).select("student_id", "career_id").show()

    print("5. login Ines, login Bram, logout Ines; the session view; RLS for a non-admin")
    people = db["students"].withColumn("student_id", F.col("student_id").cast("long"))
    ev = spark.createDataFrame(
        [("ines", "LOGIN", 11, T0, 1, None), ("bram", "LOGIN", 12, T0 + dt.timedelta(minutes=1), 2, None),
         ("ines", "LOGOUT", None, T0 + dt.timedelta(minutes=5), 3, None)],
        "usuario string, kind string, subject bigint, event_at timestamp_ntz, seq bigint, expires_at timestamp_ntz")
    sessions, log, _ = S.apply_session_events(None, ev, people, "student_id")
    now = T0 + dt.timedelta(minutes=10)
    R.active_sessions(sessions, people, "student_id", "first_name", "last_name", now).show(truncate=False)
    S.rls_session(people, "student_id", sessions, S.Principal("bram"), now).select("student_id", "first_name").show()
    print("   admin sees", S.rls_session(people, "student_id", sessions, S.Principal("dbo"), now).count(), "students")
    print("   attribute policy (active students only):", S.rls_flag(db["students"], "active").count())

    print("6. audit: latest accesses and summary per user and action")
    R.latest_accesses(log, 20).select("usuario", "action", "subject", "event_at").show()
    R.action_summary(log, ["usuario", "action"], "event_at").orderBy("usuario", "action").show()

    print("7. checklist")
    rules = [
        R.CheckRule("students present", R.count_of(db["students"]), R.status_if(lambda n: n > 0, R.STATUS_WARN),
                    lambda n: F.concat(n.cast("string"), F.lit(" students"))),
        R.CheckRule("enrolment keys unique", R.count_of(C.pk_violations(db["enrolments"], ["student_id", "course_id", "period"])),
                    R.status_if(lambda n: n == 0), lambda n: F.concat(n.cast("string"), F.lit(" duplicates"))),
        R.CheckRule("sessions open", R.count_of(S.usable_sessions(sessions, now)), R.status_if(lambda n: n >= 2),
                    lambda n: F.concat(n.cast("string"), F.lit(" usable sessions"))),
    ]
    R.quality_checklist(rules).orderBy("num").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
