"""Claims in two times, and entities without activity."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.operators import audits
from ledgerline.plans import claims

LOG = "claim string, seq long, recorded_at timestamp_ntz, valid_from date, valid_to date, value long, retracted boolean"


def _log(seed=1, n=200):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(n):
        day = start + dt.timedelta(days=rng.randrange(20), hours=rng.randrange(0, 24, 6))
        low = day.date() + dt.timedelta(days=rng.randrange(-4, 4))
        high = None if rng.random() < 0.3 else low + dt.timedelta(days=rng.randrange(0, 9))
        rows.append((f"c{rng.randrange(25)}", k, day, low, high, rng.randrange(5), rng.random() < 0.2 or None))
    return rows


def _known(rows, at):
    last = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        if r[2] <= at:
            last[r[0]] = r
    return {c: (r[5], r[3], r[4]) for c, r in last.items() if not r[6]}


def test_views_of_the_log(spark):
    rows = _log()
    log = spark.createDataFrame(rows, LOG)
    for day in (dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 5, 12), dt.datetime(2024, 1, 12), dt.datetime(2024, 2, 1)):
        got = {r.claim: (r.value, r.valid_from, r.valid_to) for r in claims.as_known(log, F.lit(day)).collect()}
        assert got == _known(rows, day)
        # the versions say the same
        held = claims.versions(log).filter((F.col("known_from") <= F.lit(day)) & (F.col("known_to").isNull() | (F.lit(day) < F.col("known_to"))))
        assert {r.claim: (r.value, r.valid_from, r.valid_to) for r in held.collect()} == got
    at = dt.date(2024, 1, 10)
    got = {r.claim for r in claims.as_known(log, F.lit(dt.datetime(2024, 1, 12)), F.lit(at)).collect()}
    assert got == {c for c, (_, low, high) in _known(rows, dt.datetime(2024, 1, 12)).items() if low <= at and (high is None or at < high)}


def test_every_day(spark):
    rows = _log(2)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in (0, 3, 4, 5, 9, 19, 40)]
    got = {(r.day, r.claim): r.value for r in claims.on_days(spark.createDataFrame(rows, LOG), spark.createDataFrame([(d,) for d in [*days, days[0]]], "day date")).collect()}
    want = {}
    for d in days:
        end = dt.datetime.combine(d, dt.time(23, 59, 59))
        want |= {(d, c): v for c, (v, low, high) in _known(rows, end).items() if low <= d and (high is None or d < high)}
    assert got == want and len(want) > 20


def test_changes(spark):
    rows = _log(3)
    a, b = dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 15)
    got = {r.claim: (r.change, r.before, r.after) for r in claims.changes_between(spark.createDataFrame(rows, LOG), F.lit(a), F.lit(b)).collect()}
    x, y = _known(rows, a), _known(rows, b)
    kind = lambda c: "added" if c not in x else "dropped" if c not in y else "changed"
    assert got == {c: (kind(c), x.get(c, [None])[0], y.get(c, [None])[0]) for c in x.keys() | y.keys() if x.get(c) != y.get(c)}
    assert {c for c, _, _ in got.values()} == {"added", "dropped", "changed"}
    assert claims.versions(spark.createDataFrame([], LOG)).count() == 0


def test_entities_without_activity_stay(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    events = spark.createDataFrame([(1, "busy", day(20)), (2, "idle", day(20)), (3, "stranger", day(20)), (4, "idle", None)], "id long, name string, at timestamp")
    active = spark.createDataFrame([("busy", day(10)), ("stranger", day(11))], "name string, active timestamp")
    entities = spark.createDataFrame([("busy",), ("idle",), ("busy",)], "name string")
    got = {r.id: (r.days, r.confidence) for r in audits.preceded(events, active, ["name"], "at", "active", entities=entities).collect()}
    assert got == {1: (10, audits.TEMPORAL), 2: (None, audits.NAME_ONLY), 4: (None, audits.NAME_ONLY)}
