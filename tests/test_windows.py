import random
from datetime import datetime

from fixtures import messages_frame, random_messages, sample_l3
from pyspark.sql import functions as F

from tidequote import l1_windows
from tidequote.functions.messages import quote_messages
from tidequote.operators.quotes import first_at_price


def _cells(df):
    return {
        r["window_start"]: (r["bid_price"], r["bid_size"], r["ask_price"], r["ask_size"], r["n"])
        for r in df.collect()
    }


def test_tumbling_sample(spark):
    got = _cells(l1_windows(sample_l3(spark), "1 second"))
    assert got == {
        datetime(2021, 8, 2, 22, 11, 21): (228.0, 50, None, None, 2),
        datetime(2021, 8, 3, 1, 0, 1): (228.4, 300, 230.2, 300, 3),
        datetime(2021, 8, 3, 1, 0, 3): (229.13, 1000, 229.35, 1000, 4),
    }


def test_both_sides(spark):
    got = _cells(l1_windows(sample_l3(spark), "1 second", both_sides=True))
    assert len(got) == 2


def test_panes_equal_plain_sliding_windows(spark):
    messages = messages_frame(spark, random_messages(random.Random(2), 400, gaps=400))
    panes = l1_windows(messages, "10 seconds", "2 seconds")
    plain = (
        quote_messages(messages)
        .groupBy(F.window("time", "10 seconds", "2 seconds"))
        .agg(
            F.count("*").alias("n"), F.max(F.when(F.col("is_bid"), F.col("price"))).alias("bid_price")
        )
    )
    want = {r["window"]["start"]: (r["bid_price"], r["n"]) for r in plain.collect()}
    got = {r["window_start"]: (r["bid_price"], r["n"]) for r in panes.collect()}
    assert got == want
    assert all((r.window_end - r.window_start).seconds == 10 for r in panes.collect())


def test_slide_that_does_not_divide_the_width(spark):
    messages = messages_frame(spark, random_messages(random.Random(3), 100, gaps=400))
    df = l1_windows(messages, "5 seconds", "2 seconds")
    assert df.agg(F.sum("n")).first()[0] >= 2 * 100


def test_keys(spark):
    rows = [(*m, i % 3) for i, m in enumerate(random_messages(random.Random(4), 300, gaps=400))]
    df = messages_frame(spark, rows, "venue")
    keyed = l1_windows(df, "10 seconds", "5 seconds", ["venue"])
    for k in range(3):
        alone = l1_windows(df.where(F.col("venue") == k), "10 seconds", "5 seconds")
        assert _cells(keyed.where(F.col("venue") == k)) == _cells(alone)


def test_a_batch_is_folded_without_a_sort(spark):
    plan = l1_windows(sample_l3(spark), "1 hour", "15 minutes")._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rfind("HashAggregate") :]
    assert "SortAggregate" not in first and "Sort [" not in first


def test_first_at_price(spark):
    rng = random.Random(4)
    seqs = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    rows = [
        (rng.choice(seqs), rng.random() < 0.5, float(rng.randint(1, 3)), rng.choice([None, 0, 5, 2**31 - 1]), rng.randint(0, 2))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "seq_num long, is_bid boolean, price double, qty int, g int")
    got = {(r.g, r.is_bid, r.price): (r.seq_num, r.qty, r.n) for r in first_at_price(df, ["g"], F.count("*").alias("n")).collect()}
    want = {}
    for seq, bid, price, qty, g in rows:
        key = (g, bid, price)
        order = (seq is not None, seq or 0, -1 if qty is None else -qty - 2)
        old = want.get(key)
        best = min([order] + ([old[0]] if old else []), key=lambda o: (o[0], o[1], 1 if o[2] == -1 else o[2]))
        want[key] = (best, (old[1] if old else 0) + 1)
    for key, (order, n) in want.items():
        seq = order[1] if order[0] else None
        qty = None if order[2] == -1 else -order[2] - 2
        assert got[key] == (seq, qty, n)
