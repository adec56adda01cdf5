"""Jobs that are stopped and started again give what their batch twins give."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.sources import io
from tidemark.streaming import jobs

START = datetime(2024, 1, 1)


def ticks(spark, folder, numbers):
    rows = [(i, START + timedelta(minutes=37 * i % 5000), i % 5, "ab"[i % 2], float(i)) for i in numbers]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    df.coalesce(1).write.mode("append").parquet(folder)
    return jobs.read_ticks(spark, folder)


@pytest.fixture
def halves(spark):
    """A folder that a job drains, then more files in it for the same job started again."""
    folder = io.new_path(spark, "ticks")
    return lambda numbers: ticks(spark, folder, numbers), folder


def test_latest_state_after_a_restart(spark, halves):
    more, folder = halves
    out = jobs._out(spark, "state")
    jobs.latest_state(more(range(2)), out)
    jobs.latest_state(more(range(2, 60)), out)
    jobs.latest_state(more([100]), out)
    rows = spark.read.parquet(out)
    assert {r.user_id for r in rows.filter("batch = 2").collect()} == {0} and rows.filter("batch = 0").count() == 2  # a batch writes its own keys
    got = {(r.user_id, r.event_id) for r in jobs.read_latest(spark, out).collect()}
    twin = spark.read.parquet(folder).groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("e")).collect()
    assert got == {(r.user_id, r.e) for r in twin}


def test_first_write_stays_after_a_restart(spark, halves):
    more, _ = halves
    deadlines = spark.createDataFrame([((START + timedelta(days=k)).date(), START + timedelta(days=k + 1)) for k in range(4)], "day date, deadline timestamp")
    out = jobs._out(spark, "first")
    jobs.first_write_wins(more(range(40, 80)), deadlines, out)
    before = {(r.user_id, r.day, r.event_id) for r in spark.read.parquet(out).collect()}
    jobs.first_write_wins(more(range(40)), deadlines, out)
    after = spark.read.parquet(out).collect()
    assert before <= {(r.user_id, r.day, r.event_id) for r in after} and len({(r.user_id, r.day) for r in after}) == len(after)


def test_notifications_go_once_and_wait_for_room(spark, halves):
    more, _ = halves
    subscribers = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "event_type string, subscriber long")
    out = jobs._out(spark, "notify")
    jobs.notify(more(range(6)), subscribers, out, cap=4)
    jobs.notify(more(range(6, 8)), subscribers, out, cap=4)
    sent = [(r.subscriber, r.event_id, r.batch) for r in spark.read.parquet(out).filter("sent").collect()]
    assert sorted(sent) == [(1, i, 0) for i in range(4)] + [(1, i, 1) for i in range(4, 8)] + [(2, i, 0) for i in (0, 2, 4)] + [(2, 6, 1)]


def test_waiting_events_leave_in_the_order_of_their_ids(spark, halves):
    """Several runs wait at once; a batch's new events may be lower or higher than these; ticks told again are not new."""
    more, _ = halves
    subscribers = spark.createDataFrame([("a", 1), ("b", 1)], "event_type string, subscriber long")
    out = jobs._out(spark, "notify")
    batches, held, told, known = [range(50, 80), [*range(20, 30), *range(50, 60)], [90, 1, 55], [91], range(100, 104)], set(), [], set()
    for n, numbers in enumerate(batches):
        jobs.notify(more(numbers), subscribers, out, cap=7)
        new = set(numbers) - known
        known |= new
        now = sorted(held | new)[:7]
        told += [(i, n, True) for i in now] + [(i, n, False) for i in new - set(now)]
        held = (held | new) - set(now)
    rows = spark.read.parquet(out).collect()
    assert sorted((r.event_id, r.batch, r.sent) for r in rows) == sorted(told)
    assert all(r.event_type == "ab"[r.event_id % 2] and not r.silent for r in rows)


def test_state_is_not_asked_row_by_row(monkeypatch):
    """A batch of 20,000 rows of a subscriber makes a few calls to its state."""
    calls, held = [], {}

    class State:
        def __getattr__(self, name):
            def call(*a):
                calls.append(name)
                return {"keys": lambda: iter(held), "updateValue": held.__setitem__, "getValue": held.get, "removeKey": held.pop}[name](*a)

            return call

    p = jobs._Deliveries(50)
    p.init(type("Handle", (), {"getMapState": lambda *a: State()})())
    part = lambda a: pd.DataFrame({"event_id": range(a, a + 10_000), "event_type": "a", "silent": False})
    got = pd.concat(p.handleInputRows((1,), iter([part(10_000), part(0)]), None))
    assert len(got) == 20_000 and got[got.sent].event_id.tolist() == list(range(50)) and len(calls) < 10


def test_subscriptions_baseline_silence_and_the_latest_one(spark, halves):
    more, _ = halves
    at = lambda i: START + timedelta(minutes=37 * i)
    rows = [("a", 1, 1, at(2), False), ("a", 1, 2, at(0), False), ("a", 2, 5, None, True), ("a", 2, 4, None, False), ("b", 3, 1, at(3), False)]
    subscribers = spark.createDataFrame(rows, "event_type string, subscriber long, created long, since timestamp, silent boolean")
    out = jobs._out(spark, "notify")
    jobs.notify(more(range(5)), subscribers, out, cap=1)
    jobs.notify(more([5, 6]), subscribers, out, cap=1)
    got = sorted((r.subscriber, r.event_id, r.sent, r.silent, r.batch) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2, True, False, 0), (1, 4, False, False, 0), (1, 4, True, False, 1), (1, 6, False, False, 1), (2, 0, False, True, 0), (2, 2, False, True, 0), (2, 4, False, True, 0), (2, 6, False, True, 1), (3, 5, True, False, 1)]


def test_large_deletes_and_lost_rows_are_refused(spark):
    old = spark.createDataFrame([(i, i) for i in range(10)], "id long, v long")
    diff = io.diff_tables(old, old.filter("id < 8"), ["id"], ["v"])
    with pytest.raises(ValueError, match="2 of 10"):
        io.refuse_large_delete(diff, old)
    assert io.refuse_large_delete(diff, old, share=0.5) is diff
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "day long, v string")
    out = {r.day: (r.n, r.same) for r in io.archive_and_verify(rows, io.new_path(spark, "archive"), "day").collect()}
    assert out == {"1": (2, True), "2": (1, True)}
    x, y = (df.agg(F.struct(*io.row_digests(["day", "v"])).alias("d")).first()["d"] for df in (rows, rows.filter("day = 2")))
    assert x != y and x["x"] == y["x"]  # a pair of equal rows cancels in the xor alone
