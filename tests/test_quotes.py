import random
from datetime import timedelta

import pytest
from fixtures import (
    EDGE_QUOTES,
    SAMPLE_QUOTES,
    SEQ,
    START,
    edge_l3,
    messages_frame,
    quotes_by_seq,
    random_messages,
    replay,
    sample_l3,
)
from pyspark.sql import functions as F

from tidequote import MODES, l3_messages, l3_to_l1
from tidequote.functions.messages import quote_messages
from tidequote.operators.quotes import quote_state
from tidequote.operators.ranges import LONG_MAX, RANGE, SeqRanges, plan_ranges
from tidequote.operators.scan import Running, scan, summarise
from tidequote.schema import L1_SCHEMA
from tidequote.sources.events import l3_from_events

QUOTE_MODES = ("best_quote", "event_quote", "full_book")


def cut(df, rows_per_range, keys=()):
    return plan_ranges(df, "seq_num", keys, rows_per_range)


@pytest.mark.parametrize("mode", SAMPLE_QUOTES)
@pytest.mark.parametrize("rows_per_range", [1, 3, 100])
def test_sample(spark, mode, rows_per_range):
    l3 = sample_l3(spark)
    l1 = l3_to_l1(l3, mode, ranges=cut(l3, rows_per_range))
    assert l1.columns == L1_SCHEMA.names
    assert quotes_by_seq(l1, SEQ) == SAMPLE_QUOTES[mode]


@pytest.mark.parametrize("mode", EDGE_QUOTES)
@pytest.mark.parametrize("rows_per_range", [1, 4, 100])
def test_edges(spark, mode, rows_per_range):
    l3 = edge_l3(spark)
    assert quotes_by_seq(l3_to_l1(l3, mode, ranges=cut(l3, rows_per_range))) == EDGE_QUOTES[mode]


def test_one_shape_input_gives_the_same(spark):
    l3 = edge_l3(spark)
    for mode in MODES:
        assert quotes_by_seq(l3_to_l1(l3_messages(l3), mode)) == EDGE_QUOTES[mode]


def test_sizes_keep_the_schema_types(spark):
    l1 = l3_to_l1(edge_l3(spark))
    assert [f.dataType for f in l1.schema] == [f.dataType for f in L1_SCHEMA]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        l3_to_l1(edge_l3(spark), "mid_quote")


@pytest.mark.parametrize("seed", range(4))
def test_replay(spark, seed):
    rng = random.Random(seed)
    messages = random_messages(rng, 300, gaps=[1, 5, 1000, 10**9][seed])
    shuffled = rng.sample(messages, len(messages))
    df = messages_frame(spark, shuffled).repartition(5).cache()
    for rows_per_range in (7, 64):
        ranges = cut(df, rows_per_range)
        assert ranges.is_split
        for mode in QUOTE_MODES:
            assert quotes_by_seq(l3_to_l1(df, mode, ranges=ranges)) == replay(messages, mode), mode


@pytest.mark.parametrize("mode", MODES)
def test_keys_are_independent(spark, mode):
    rng = random.Random(11)
    per_key = {k: random_messages(rng, n) for k, n in ((1, 250), (2, 40), (3, 3))}
    rows = [(*m, k) for k, ms in per_key.items() for m in ms]
    df = messages_frame(spark, rng.sample(rows, len(rows)), "venue").cache()
    ranges = cut(df, 20, ["venue"])
    assert ranges.hot_keys and ranges.is_split
    for plan in (ranges, SeqRanges(key_cols=("venue",), partitions=3)):
        l1 = l3_to_l1(df, mode, ["venue"], plan).cache()
        for k, ms in per_key.items():
            got = quotes_by_seq(l1.where(F.col("venue") == k))
            if mode in QUOTE_MODES:
                assert got == replay(ms, mode)
            else:
                alone = messages_frame(spark, ms)
                assert got == quotes_by_seq(l3_to_l1(alone, mode))


def _peers(spark, count=400, base=0):
    """A third of the rows share one seq_num, as many have none."""
    rng = random.Random(5)
    messages = random_messages(rng, count, orders=40)
    out = []
    for i, m in enumerate(messages):
        seq = (base + 200, None, base + m[0] * 3)[i % 3]
        out.append((seq, *m[1:], i % 2))
    schema = messages_frame(spark, [], "venue").schema
    return spark.createDataFrame([(o[0], START, *o[1:]) for o in out], schema).cache()


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("keys", [(), ("venue",)])
@pytest.mark.parametrize("base", [0, SEQ - 28])
def test_hot_seq_numbers_do_not_change_the_result(spark, mode, keys, base):
    df = _peers(spark, base=base)
    plan = cut(df, 20, keys)
    assert plan.hot_seqs == (base + 200,) and plan.hot_nulls
    whole = SeqRanges(key_cols=tuple(keys))

    def rows(ranges):
        return sorted(map(repr, l3_to_l1(df, mode, keys, ranges).collect()))

    assert rows(plan) == rows(whole)


@pytest.mark.parametrize("keys", [(), ("venue",)])
def test_carried_state_equals_one_long_feed(spark, keys):
    rng = random.Random(21)
    rows = [(*m, i % 7 // 5) for i, m in enumerate(random_messages(rng, 400))]
    feed = messages_frame(spark, rows, "venue").cache()
    middle = rows[200][0]
    head, tail = feed.where(F.col("seq_num") < middle), feed.where(F.col("seq_num") >= middle)
    for mode in ("best_quote", "event_quote"):
        state = quote_state(mode)
        opening = summarise(quote_messages(head, keys), state, keys)
        whole = l3_to_l1(feed, mode, keys, SeqRanges(key_cols=keys))
        want = sorted(map(repr, whole.where(F.col("seq_num") >= middle).collect()))
        for n in (15, 70, 1000):
            got = l3_to_l1(tail, mode, keys, cut(tail, n, keys), opening)
            assert sorted(map(repr, got.collect())) == want


def test_input_layout_does_not_matter(spark):
    df = _peers(spark)
    for mode in MODES:
        rows = [
            sorted(map(repr, l3_to_l1(d, mode, ranges=cut(df, n)).collect()))
            for d, n in (
                (df.repartition(1), 50),
                (df.repartition(13), 7),
                (df.orderBy(F.rand(3)), 1000),
            )
        ]
        assert rows[0] == rows[1] == rows[2]


def test_unusable_prices_and_sides(spark):
    nan = float("nan")
    messages = [
        (1, "add", 1, "BUY", nan, 1),
        (2, "add", 2, "SELL", None, 1),
        (3, "add", 3, "buy", 200.0, 1),
        (4, "add", 4, "BUY", 10.0, 1),
        (5, "add", 5, "SELL", 11.0, 2),
        (6, "add", 6, "SELL", nan, 2),
    ]
    for mode in QUOTE_MODES:
        got = quotes_by_seq(l3_to_l1(messages_frame(spark, messages), mode))
        assert got == {5: (10.0, 1, 11.0, 2), 6: (10.0, 1, 11.0, 2)}


def test_prices_that_are_not_positive_are_not_shown(spark):
    messages = [
        (1, "add", 1, "BUY", -2.0, 1),
        (2, "add", 2, "SELL", 0.0, 1),
        (3, "add", 3, "BUY", 5.0, 1),
    ]
    for mode in QUOTE_MODES:
        assert quotes_by_seq(l3_to_l1(messages_frame(spark, messages), mode)) == {}


def _by_rule(messages, mode):
    """Quotes of messages with ties and nulls: all up to each order value, peers included."""
    order = sorted({m[0] for m in messages}, key=lambda s: (s is not None, s or 0))
    rank = {s: k for k, s in enumerate(order)}
    out = {}
    for s in order:
        seen = [m for m in messages if rank[m[0]] <= rank[s] and m[4] is not None and m[3]]
        seen = [m for m in seen if m[1] in ("add", "update")]
        bids, asks = ([m for m in seen if m[3] == side] for side in ("BUY", "SELL"))
        if not bids or not asks:
            continue
        bid = max(bids, key=lambda m: (m[4], -rank[m[0]], m[5]))
        ask = min(asks, key=lambda m: (m[4], rank[m[0]], -m[5]))
        shown = {"BUY": (bid[4], bid[5]), "SELL": (ask[4], ask[5])}
        if mode == "event_quote":
            last = max(seen, key=lambda m: (rank[m[0]], m[3] == "BUY", m[4], m[5]))
            shown[last[3]] = last[4:6]
        out[s] = (*shown["BUY"], *shown["SELL"])
    return out


@pytest.mark.parametrize("mode", ["best_quote", "event_quote"])
@pytest.mark.parametrize("seqs", [(0, None, 1, 2, 3), (-(2**63), None, -(2**63) + 1, 0, 2**63 - 1)])
def test_ties_nulls_and_extremes(spark, mode, seqs):
    rng = random.Random(3)
    messages = [(rng.choice(seqs), *m[1:]) for m in random_messages(rng, 60, orders=20)]
    schema = messages_frame(spark, []).schema
    df = spark.createDataFrame([(m[0], START, *m[1:]) for m in messages], schema).cache()
    for ranges in (SeqRanges(), cut(df, 10)):
        got = l3_to_l1(df, mode, ranges=ranges).collect()
        want = _by_rule(messages, mode)
        assert {r.seq_num for r in got} == set(want)
        for r in got:
            assert (r.bid_price, r.bid_size, r.ask_price, r.ask_size) == want[r.seq_num]


def test_peers_show_the_larger_size(spark):
    null_first = [(None, "add", 1, "BUY", 100.0, 10), (None, "add", 2, "SELL", 105.0, 10)]
    later = [(1, "add", 3, "BUY", 100.0, 5), (1, "add", 4, "SELL", 105.0, 5)]
    peers = [(1, "add", 5, "BUY", 100.0, 7), (1, "add", 6, "SELL", 105.0, 7)]
    for messages, size in ((null_first + later, 10), (later + peers, 7)):
        got = quotes_by_seq(l3_to_l1(messages_frame(spark, [m for m in messages]), "best_quote").where("seq_num = 1"))
        assert got == {1: (100.0, size, 105.0, size)}


def test_empty_feed(spark):
    for mode in MODES:
        assert l3_to_l1(messages_frame(spark, []), mode).count() == 0


def test_ranges_are_balanced_and_ordered(spark):
    seqs = [i if i < 900 else 10**15 + i * 10**9 for i in range(1000)]
    df = spark.createDataFrame([(s,) for s in seqs], "seq_num long")
    ranges = plan_ranges(df, rows_per_range=50)
    placed = df.select("seq_num", ranges.range_of("seq_num").alias(RANGE))
    sizes = placed.groupBy(RANGE).agg(
        F.count("*").alias("n"), F.min("seq_num").alias("lo"), F.max("seq_num").alias("hi")
    )
    rows = sorted(sizes.collect())
    assert len(rows) == ranges.count >= 20 and ranges.count % ranges.partitions == 0
    assert max(r.n for r in rows) <= 100
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))


def test_range_of_extremes(spark):
    ranges = SeqRanges(cuts=(0, 10, 11))
    seqs = [None, -(2**63), -1, 0, 9, 10, 11, LONG_MAX]
    df = spark.createDataFrame([(s,) for s in seqs], "seq_num long")
    got = [r[0] for r in df.select(ranges.range_of("seq_num")).collect()]
    assert got == [-1, 0, 0, 1, 1, 2, 3, 3]


@pytest.mark.parametrize("ranges", [SeqRanges(), SeqRanges(cuts=(3, 5, 6, 9), partitions=2)])
def test_scan_sums_with_an_opening(spark, ranges):
    df = spark.createDataFrame([(s, s) for s in (1, 2, 3, 5, 5, 8, 9)], "seq_num long, x long")
    opening = spark.createDataFrame([(100, 100)], "upto long, before long")
    running = [Running("upto", F.sum, F.col("x")), Running("before", F.sum, F.col("x"), before=True)]
    got = sorted(tuple(r) for r in scan(df, running, ranges, opening=opening).collect())
    assert got == [
        (1, 1, 101, 100),
        (2, 2, 103, 101),
        (3, 3, 106, 103),
        (5, 5, 116, 106),
        (5, 5, 116, 106),
        (8, 8, 124, 116),
        (9, 9, 133, 124),
    ]


def test_feed_of_a_busy_user_does_not_depend_on_ranges(spark):
    kinds = ["click", "view", "signup", "error", "purchase", "unknown"]
    rng = random.Random(8)
    rows = [
        (i, START + timedelta(seconds=i), rng.choice([1, 1, 2, 3, 4]), rng.choice(kinds), i % 97 / 4)
        for i in range(900)
    ]
    events = spark.createDataFrame(
        rng.sample(rows, len(rows)),
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    )
    ranges = plan_ranges(events, "event_id", ["user_id"], rows_per_range=200)
    assert len(ranges.hot_keys) == 1 and ranges.is_split
    got = [
        sorted(map(repr, l3_from_events(events, r).collect()))
        for r in (ranges, SeqRanges(key_cols=("user_id",)))
    ]
    assert got[0] == got[1] and len(got[0]) == 900
