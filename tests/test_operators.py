"""Generic operators against brute force, with a hot key holding a third of the rows."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hirelens import operators as ops

DAY0 = date(2024, 1, 1)


def day(n):
    return DAY0 + timedelta(days=n)


@pytest.fixture(scope="module")
def visits():
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(200)}"
        when = None if rng.random() < 0.02 else day(rng.randrange(60))
        rows.append((f"v{i:05d}", key, rng.choice([1, 2, 3, 4, None]), when))
    return rows


def brute_force_gaps(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    gaps = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[2] is None, r[2] or 0, r[3] is None, r[3] or DAY0, r[0]))
        for before, row in zip([None, *group], group):
            known = before is not None and before[3] is not None and row[3] is not None
            gaps[row[0]] = (row[3] - before[3]).days if known else None
    return gaps


def test_round_gaps(spark, visits):
    df = spark.createDataFrame(visits, "id string, k string, r int, d date")
    got = ops.round_gaps(df, "k", "r", "d", "id", "gap")
    assert got.columns == ["id", "k", "r", "d", "gap"]
    assert {row.id: row.gap for row in got.collect()} == brute_force_gaps(visits)


def test_max_round_gap(spark, visits):
    df = spark.createDataFrame(visits, "id string, k string, r int, d date")
    gaps = brute_force_gaps(visits)
    expected = {}
    for row in visits:
        known = [g for g in (expected.get(row[1]), gaps[row[0]]) if g is not None]
        expected[row[1]] = max(known) if known else None
    got = ops.max_round_gap(df, "k", "r", "d", "gap")
    assert {row.k: row.gap for row in got.collect()} == expected


def test_repeated_slot_is_a_gap_of_zero(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, day(5)), ("b", "x", 1, day(5)), ("c", "x", 2, day(1)), ("d", "y", 1, day(1))],
        "id string, k string, r int, d date",
    )
    got = {row.k: row.gap for row in ops.max_round_gap(df, "k", "r", "d", "gap").collect()}
    assert got == {"x": 0, "y": None}


def test_open_load_equals_pairwise_count(spark):
    rng = random.Random(3)
    spans = []
    for i in range(400):
        owner = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"o{rng.randrange(20)}"
        opened = None if i % 77 == 0 else day(rng.randrange(100))
        closed = None if rng.random() < 0.3 else day(rng.randrange(-20, 160))
        spans.append((f"s{i}", owner, opened, closed))
    events = []
    for i in range(2000):
        span = rng.choice(spans)
        # far outside every span as well
        events.append((f"e{i}", *span, rng.choice([None, day(-400), day(9000), *[day(rng.randrange(200))] * 9])))
    columns = "span string, owner string, opened date, closed date"
    spans_df = spark.createDataFrame(spans, columns)
    events_df = spark.createDataFrame(events, f"event string, {columns}, at date")
    curve = ops.open_load_curve(spans_df, events_df.select("owner", "at"), "owner", "opened", "closed", "at")
    got = ops.attach_open_load(events_df, curve, "owner", "opened", "closed", "at", "load")

    def pairwise(event):
        _, own, owner, _, _, at = event
        return sum(
            1
            for key, other, opened, closed in spans
            if None not in (owner, at, opened)
            and other == owner
            and key != own
            and opened <= at
            and (closed is None or closed > at)
        )

    assert {row.event: row.load for row in got.collect()} == {e[0]: pairwise(e) for e in events}
    # one row per owner and asked day, whatever the number of spans and events
    assert curve.count() == curve.select("owner", "at").distinct().count()


def test_load_as_of_and_lifetime(spark):
    spans = spark.createDataFrame(
        [("a", day(0), day(10)), ("a", day(5), None), ("a", day(20), None), ("b", None, None)],
        "owner string, opened date, closed date",
    )
    as_of = ops.load_as_of(spans, "owner", "opened", "closed", day(7), "n")
    assert {r.owner: r.n for r in as_of.collect()} == {"a": 2, "b": 0}
    assert {r.owner: r.n for r in ops.lifetime_load(spans, "owner", "n").collect()} == {"a": 2, "b": 0}


def test_first_touch_falls_back_to_the_old_date(spark):
    dim = spark.createDataFrame([("a", day(9)), ("b", day(9))], "k string, d date")
    facts = spark.createDataFrame([("a", day(3)), ("a", day(12))], "k string, d date")
    got = {r.k: r.d for r in ops.first_touch(dim, facts, "k", "d").collect()}
    assert got == {"a": day(3), "b": day(9)}


def test_group_contrast(spark):
    df = spark.createDataFrame(
        [(True, True), (True, False), (True, None), (False, True), (None, True)], "flag boolean, hit boolean"
    )
    rows = {r.grp: r for r in ops.group_contrast(df, F.col("flag"), F.col("hit"), "yes", "no").collect()}
    assert (rows["yes"].n, rows["yes"].value) == (3, 33.3)
    assert (rows["no"].n, rows["no"].value, rows["no"].gap) == (1, 100.0, -66.7)
    empty = ops.group_contrast(df.filter("flag is null"), F.col("flag"), F.col("hit"), "yes", "no").collect()
    assert [(r.n, r.value, r.gap) for r in empty] == [(0, None, None)] * 2
