"""As-of lookups, sessions, time-weighted and consolidated quotes, replays and quarantine."""

import random
from datetime import datetime, timedelta

import pytest
from fixtures import START, messages_frame, random_messages, replay, wide_row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote import L3_SCHEMA, l3_to_l1
from tidequote.operators.asof import ON, asof_join, both_feeds
from tidequote.operators.consolidated import consolidated
from tidequote.operators.ranges import plan_ranges
from tidequote.operators.replays import counted_messages, without_replays
from tidequote.operators.sessions import l1_sessions
from tidequote.operators.weighted import time_weighted
from tidequote.sources.quarantine import intake

LEFT, RIGHT = "k long, at long, id long", "k long, at long, seq_num long, price double"


def feeds(seed, n=150, hot=0.7):
    rng = random.Random(seed)
    key = lambda: None if rng.random() < 0.05 else 0 if rng.random() < hot else rng.randrange(1, 5)
    at = lambda: None if rng.random() < 0.05 else rng.randrange(60)
    lefts = [(key(), at(), i) for i in range(n)]
    rights = [(key(), at(), i, None if rng.random() < 0.1 else float(rng.randrange(9))) for i in range(n)]
    return lefts, rights


def plain_asof(lefts, rights, by, tolerance, strict):
    out = []
    for k, at, i in lefts:
        fits = [
            r for r in rights
            if at is not None and r[1] is not None and (not by or (k is not None and r[0] == k)) and (r[1] < at or not strict and r[1] == at)
        ]
        best = max(fits, key=lambda r: r[1:3], default=None)
        if best is not None and tolerance is not None and at - best[1] > tolerance:
            best = None
        out.append((k, at, i, *((None,) * 3 if best is None else best[1:])))
    return sorted(out, key=str)


@pytest.mark.parametrize(("by", "tolerance", "strict"), [(["k"], None, False), (["k"], 4, True), ([], 3, False), ([], None, True)])
@pytest.mark.parametrize("rows", [10, 10**6])
def test_asof(spark, by, tolerance, strict, rows):
    lefts, rights = feeds(len(by) + strict)
    left, right = spark.createDataFrame(lefts, LEFT).cache(), spark.createDataFrame(rights, RIGHT)
    if not by:
        right = right.withColumnRenamed("k", "other")
    ranges = plan_ranges(both_feeds(left, right, "at", by, ["seq_num"]), ON, by, rows, min_rows=rows)
    assert ranges.is_split == (rows == 10)
    got = asof_join(left, right, "at", by, prefix="r_", tolerance=tolerance, strict=strict, ranges=ranges)
    cells = got.select("k", "at", "id", "r_at", "r_seq_num", "r_price").collect()
    assert sorted(map(tuple, cells), key=str) == plain_asof(lefts, rights, by, tolerance, strict)


def test_asof_by_time_with_a_duration(spark):
    t = lambda s: START + timedelta(seconds=s)
    left = spark.createDataFrame([(1, t(10)), (2, t(100)), (3, t(1))], "id long, time timestamp")
    right = spark.createDataFrame([(7, t(5), "a"), (8, t(10), "b"), (9, t(10), "c")], "seq_num long, time timestamp, x string")
    got = asof_join(left, right, tolerance="1 minute").collect()
    assert {r["id"]: (r["quote_seq_num"], r["quote_x"]) for r in got} == {1: (9, "c"), 2: (None, None), 3: (None, None)}
    assert asof_join(left, right.limit(0)).where("quote_x is not null").isEmpty()


def quotes(seed, n, span, keys=1):
    rng = random.Random(seed)
    return [
        (i, START + timedelta(seconds=rng.randrange(span)), rng.choice(["BUY", "SELL"]), float(rng.randint(90, 99)), rng.randint(1, 9), rng.randrange(keys))
        for i in range(1, n + 1)
    ]


def feed(spark, rows):
    schema = T.StructType([*L3_SCHEMA.fields, T.StructField("k", T.LongType())])
    return spark.createDataFrame([(*wide_row(s, "add", s, side, p, q, t), k) for s, t, side, p, q, k in rows], schema)


def plain_sessions(rows, gap):
    out = []
    for k in {r[-1] for r in rows}:
        own, session = sorted((r for r in rows if r[-1] == k), key=lambda r: r[1]), []
        for r in [*own, None]:
            if session and (r is None or r[1] - session[-1][1] > gap):
                def side(s, best):
                    of = [x for x in session if x[2] == s]
                    top = best((x[3] for x in of), default=None)
                    return (top, None) if top is None else (top, min((x for x in of if x[3] == top), key=lambda x: x[0])[4])

                bid, ask = side("BUY", max), side("SELL", min)
                out.append((k, session[0][1], session[-1][1] + gap, bid[0], ask[0], bid[1], ask[1], len(session)))
                session = []
            session.append(r)
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_range", [8, 10**6])
@pytest.mark.parametrize("keys", [1, 3])
def test_sessions(spark, keys, rows_per_range):
    rows = quotes(keys, 160, 3000, keys)
    if keys > 1:
        rows = [(*r[:-1], 0 if r[0] % 3 else r[-1]) for r in rows]
    l3 = feed(spark, [*rows])
    l3 = l3.unionByName(l3.limit(1).withColumn("time", F.lit(None).cast("timestamp")))
    got = l1_sessions(l3, "20 seconds", ["k"], rows_per_range=rows_per_range).collect()
    assert sorted(map(tuple, got), key=str) == plain_sessions(rows, timedelta(seconds=20))


def test_a_message_at_the_end_of_the_gap_belongs_to_it(spark):
    at = [0, 20, 40.000001, 100]
    rows = [(i, START + timedelta(seconds=s), "BUY", 9.0, 1, 0) for i, s in enumerate(at)]
    got = l1_sessions(feed(spark, rows), "20 seconds").orderBy("window_start").collect()
    assert [r["n"] for r in got] == [2, 1, 1]
    old = [(1, datetime(1901, 1, 1), "BUY", 9.0, 1, 0), (2, datetime(1901, 1, 1, 0, 0, 15), "SELL", 10.0, 1, 0)]
    assert l1_sessions(feed(spark, old), "20 seconds").first()["n"] == 2


def test_time_weighted(spark):
    rng = random.Random(4)
    rows = [(k, START + timedelta(seconds=rng.randrange(0, 4000)), float(rng.randint(1, 9)), float(rng.randint(10, 19)), i) for i in range(80) for k in [0 if i % 4 else 1]]
    l1 = spark.createDataFrame(rows, "k long, time timestamp, bid_price double, ask_price double, seq_num long")
    for per_range in (6, 10**6):
        got = {(r["k"], r["window_start"]): (r["bid_price"], r["ask_price"], r["spread"], r["quoted_micros"]) for r in time_weighted(l1, "10 minutes", ["k"], rows_per_range=per_range).collect()}
        second = {}
        for k in (0, 1):
            own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[4]))
            for s in range(4000):
                t = START + timedelta(seconds=s)
                held = [r for r in own if r[1] <= t]
                if held and t < max(r[1] for r in rows):
                    second.setdefault((k, t.replace(minute=t.minute // 10 * 10, second=0)), []).append(held[-1][2:4])
        assert got.keys() == second.keys()
        for key, prices in second.items():
            bid, ask = (sum(p[i] for p in prices) / len(prices) for i in (0, 1))
            assert got[key] == (pytest.approx(bid), pytest.approx(ask), pytest.approx(ask - bid), len(prices) * 1_000_000)


@pytest.mark.parametrize("rows_per_range", [20, 10**6])
def test_consolidated(spark, rows_per_range):
    rng = random.Random(8)
    rows = [(s, rng.choice([0, 0, 0, 1, 2]), float(rng.randint(90, 95)), float(rng.randint(96, 99)), rng.randint(1, 9), rng.randint(1, 9)) for s in range(1, 200)]
    l1 = spark.createDataFrame([(k, START, b, a, bs, as_, s) for s, k, b, a, bs, as_ in rows], "k long, time timestamp, bid_price double, ask_price double, bid_size int, ask_size int, seq_num long")
    latest, expected = {}, {}
    for s, k, b, a, bs, as_ in rows:
        latest[k] = (b, bs, a, as_)
        bid, ask = max(q[0] for q in latest.values()), min(q[2] for q in latest.values())
        expected[s] = (bid, sum(q[1] for q in latest.values() if q[0] == bid), ask, sum(q[3] for q in latest.values() if q[2] == ask))
    got = consolidated(l1.repartition(3), ["k"], rows_per_range).collect()
    assert {r["seq_num"]: (r["bid_price"], r["bid_size"], r["ask_price"], r["ask_size"]) for r in got} == expected


def test_replays_do_not_count_twice(spark):
    messages = random_messages(random.Random(11), 120)
    once = messages_frame(spark, messages)
    other = once.where("seq_num = 5").withColumn("qty", F.lit(77))
    unnumbered = once.limit(2).withColumn("seq_num", F.lit(None).cast("long"))
    twice = once.unionByName(once).unionByName(other).unionByName(unnumbered).unionByName(unnumbered)
    kept, conflicts = without_replays(twice)
    assert kept.where("seq_num is not null").count() == 119 and kept.where("seq_num is null").count() == 4
    assert sorted((r["seq_num"], r["copies"], r["versions"]) for r in conflicts.collect()) == [(5, 1, 2), (5, 2, 2)]
    assert counted_messages(once.limit(0)).isEmpty()
    clean, apart = without_replays(once.unionByName(once))
    got = l3_to_l1(clean.cache(), "full_book").collect()
    assert {r["seq_num"] for r in got} == set(replay(messages, "full_book")) and apart.isEmpty()


def test_quarantine(spark, tmp_path):
    good = "{s},{s},BUY,1.5,3,,,,,,,,,,,2021-08-03 01:00:00 UTC"
    lines = [good.format(s=1), good.format(s=2)]
    bad = {
        "number of fields": ["1,2,3", good.format(s=3) + ",9"],
        "add_price: not double": ["4,4,BUY,dear,3,,,,,,,,,,,2021-08-03 01:00:00 UTC"],
        "time: not timestamp": ["5,5,BUY,1.5,3,,,,,,,,,,,later"],
        "seq_num: missing": [",6,BUY,1.5,3,,,,,,,,,,,2021-08-03 01:00:00 UTC"],
        "several kinds of message": ["7,7,BUY,1.5,3,8,,,,,,,,,,2021-08-03 01:00:00 UTC"],
        "side: unknown": ["8,8,HOLD,1.5,3,,,,,,,,,,,2021-08-03 01:00:00 UTC"],
        "qty: negative": ["9,9,BUY,1.5,-3,,,,,,,,,,,2021-08-03 01:00:00 UTC"],
    }
    file = tmp_path / "feed.csv"
    file.write_text("\n".join([",".join(L3_SCHEMA.names), *lines, *(x for xs in bad.values() for x in xs)]) + "\n")
    got = intake(spark, str(file))
    assert (got.rows, got.good_rows, got.bad_rows) == (10, 2, 8)
    assert sorted(r["seq_num"] for r in got.good.collect()) == [1, 2] and got.good.schema == L3_SCHEMA
    reasons = {}
    for r in got.bad.collect():
        reasons.setdefault(r["reason"], []).append(r["line"])
    assert {k: len(v) for k, v in reasons.items()} == {k: len(v) for k, v in bad.items()}
    assert set(reasons["number of fields"]) == set(bad["number of fields"])
    empty = tmp_path / "empty.csv"
    empty.write_text(",".join(L3_SCHEMA.names) + "\n")
    assert intake(spark, str(empty)).rows == 0
