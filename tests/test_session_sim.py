"""apply_session_events against a sequential simulation of the login / logout procedures."""

import datetime as dt
import random

from pyspark.sql import functions as F

from govframe.operators import security as S

EV = "usuario string, kind string, subject bigint, event_at timestamp_ntz, seq bigint, expires_at timestamp_ntz"
PEOPLE = set(range(1, 9))


def _random_events(seed, n=300):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for seq in range(n):
        user = f"u{rnd.randint(1, 10)}"
        at = base + dt.timedelta(minutes=rnd.randint(0, 400))  # many ties on time, broken by seq
        if rnd.random() < 0.5:
            subject = rnd.randint(1, 11)  # 9..11 do not exist
            exp = at + dt.timedelta(hours=1) if rnd.random() < 0.5 else None
            out.append((user, "LOGIN", subject, at, seq, exp))
        else:
            out.append((user, "LOGOUT", None, at, seq, None))
    return out


def _simulate(events, start=None):
    """Run the events one by one, in time order, like the stored procedures would."""
    sessions = dict(start or {})
    for user, kind, subject, at, _seq, exp in sorted(events, key=lambda e: (e[3], e[4])):
        if kind == "LOGIN":
            if subject not in PEOPLE:
                continue  # procedure raises: no change
            sessions[user] = (subject, True, at, exp)
        elif user in sessions and sessions[user][1]:
            s = sessions[user]
            sessions[user] = (s[0], False, s[2], at)
    return sessions


def _as_dict(df):
    return {r.usuario: (r.subject, r.active, r.started_at, r.expires_at) for r in df.collect()}


def test_one_batch_matches_simulation(spark):
    people = spark.createDataFrame([(p,) for p in PEOPLE], "k bigint")
    for seed in (1, 2, 3):
        events = _random_events(seed)
        got, log, rej = S.apply_session_events(None, spark.createDataFrame(events, EV), people, "k")
        assert _as_dict(got) == _simulate(events)
        assert rej.count() == sum(1 for e in events if e[1] == "LOGIN" and e[2] not in PEOPLE)
        assert log.count() == len(events) - rej.count()


def test_incremental_batches_match_simulation(spark):
    people = spark.createDataFrame([(p,) for p in PEOPLE], "k bigint")
    events = sorted(_random_events(11), key=lambda e: (e[3], e[4]))
    thirds = [events[: len(events) // 3], events[len(events) // 3: 2 * len(events) // 3], events[2 * len(events) // 3:]]
    state = None
    for part in thirds:
        state, _, _ = S.apply_session_events(state, spark.createDataFrame(part, EV), people, "k")
        state = spark.createDataFrame(state.collect(), state.schema)  # materialise like a stored version
    assert _as_dict(state) == _simulate(events)
    assert state.groupBy("usuario").count().filter(F.col("count") > 1).count() == 0
