"""A small school of seafarers for the unit tests, made up for their edge cases.

Answers derived by hand from these rows:

* enrolments per course: 1:2, 2:2, 3:3, 4:1, 5:2 (10 in all); four of six students are active;
* student 11 has 3 enrolments, 2 languages and 1 network row, so deleting it leaves 7, 3 and 2;
* career 3 is held by students 15 and 16; careers in use plus none: 4 distinct values;
* the courses with "Data" in their name are 2 and 4; 3 % more credits, rounded up, is one more each:
  course 2 goes from 9 to 10, and course 4 from 10 to 11, past the allowed range;
* one student has no e-mail, one no career, three no contact; the youngest is just old enough.
"""

from __future__ import annotations

from govframe.schemas import ACADEMY

STUDENTS = [
    (11, "Ines", "Okafor", "ines@school.test", 16, True, 2, 5),
    (12, "Bram", "de Wit", None, 41, True, 2, None),
    (13, "Yuki", "Tanaka", "yuki@school.test", 19, False, 1, 6),
    (14, "Oona", "Virtanen", "oona@school.test", 28, True, None, None),
    (15, "Tariq", "Aziz", "tariq@school.test", 33, False, 3, None),
    (16, "Lin", "O'Dowd", "lin@school.test", 22, True, 3, 7),
]
CAREERS = [(1, "Hydrology"), (2, "Cartography"), (3, "Acoustics")]
COURSES = [
    (1, "Tides and Currents", 2, 700), (2, "Data Buoys", 9, 701), (3, "Map Projections", 5, 702),
    (4, "Field Data Methods", 10, 703), (5, "Chart Reading", 1, 704),
]
TERM = "2031S2"
ENROLMENTS = [(11, 1), (11, 3), (11, 5), (12, 3), (13, 2), (13, 4), (14, 1), (16, 2), (16, 3), (16, 5)]
LANGUAGES = [(11, "Igbo", "native"), (11, "Dutch", "basic"), (12, "Dutch", "native"), (13, "Japanese", "native"), (16, "Irish", "fluent")]
NETWORKS = [(11, "ines.o", None), (12, None, "bram.maps"), (16, "lin-od", "lin-od")]
#: A repeated key, a leading line break, a number that must keep its zeros and one too long for a double.
JSON_EVENTS = [
    (1, '{"kind":"dive","depth":18.50,"who":"ines"}'),
    (2, '\n{"kind":"survey","kind":"late","area":{"km2":3}}'),
    (3, '{"kind":"sample","id":70000000000000000000000000001,"tags":["a"]}'),
]


def build_academy(spark):
    return {
        "students": spark.createDataFrame(STUDENTS, ACADEMY["students"]),
        "careers": spark.createDataFrame(CAREERS, ACADEMY["careers"]),
        "courses": spark.createDataFrame(COURSES, ACADEMY["courses"]),
        "enrolments": spark.createDataFrame([(a, c, TERM) for a, c in ENROLMENTS], ACADEMY["enrolments"]),
        "student_languages": spark.createDataFrame(LANGUAGES, ACADEMY["student_languages"]),
        "student_networks": spark.createDataFrame(NETWORKS, ACADEMY["student_networks"]),
        "events_json": spark.createDataFrame(JSON_EVENTS, ACADEMY["events_json"]),
    }
