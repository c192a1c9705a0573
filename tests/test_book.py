import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtures import messages_frame, quotes_by_seq, random_messages, replay
from tidequote import l3_to_l1
from tidequote.operators import book, cover
from tidequote.operators.ranges import SeqRanges, plan_ranges


def _rows(seed, count):
    """Moves and questions of two groups, in the order in which a partition has them."""
    rng = random.Random(seed)
    rows = [
        (g, at, 0, side, float(rng.randint(95, 99) + (side < 0) * 5), rng.randint(1, 9))
        if side
        else (g, at, at, 0, 0.0, 0)
        for g in (0, 1)
        for at in range(count)
        for side in rng.choice([(1, 0), (-1, 0), (1, -1, 0, 0), (0,)])
    ]
    return pd.DataFrame(rows, columns=["g", "at", "micros", "side", "price", "amount"])


@pytest.mark.parametrize("chunk", [1, 3, 50])
def test_chunks_give_the_same(monkeypatch, chunk):
    rows = _rows(chunk, 60)
    sizes = []
    real = cover._chunk_quotes
    monkeypatch.setattr(cover, "_chunk_quotes", lambda own: sizes.append(len(own)) or real(own))

    def run(size, batches):
        return pd.concat(cover.partition_quotes(["g"], ["g"], -1, size)(iter(batches)), ignore_index=True)

    whole = run(10**6, [rows])
    sizes.clear()
    cut = run(chunk, [rows.iloc[:37], rows.iloc[37:41], rows.iloc[41:]])
    pd.testing.assert_frame_equal(whole, cut, check_dtype=False)
    # a chunk and the ten levels that there are
    assert max(sizes) <= chunk + 10


def test_a_feed_in_small_chunks(spark, monkeypatch):
    real = cover.partition_quotes
    monkeypatch.setattr(book, "partition_quotes", lambda *a: real(*a, chunk_rows=5))
    messages = random_messages(random.Random(2), 300)
    df = messages_frame(spark, random.Random(3).sample(messages, 300)).cache()
    for rows_per_range in (30, 1000):
        ranges = plan_ranges(df, rows_per_range=rows_per_range)
        assert quotes_by_seq(l3_to_l1(df, "full_book", ranges=ranges)) == replay(messages, "full_book")


def test_a_long_order_is_cut_alone(spark):
    rng = random.Random(6)
    messages = [(s, "trade" if s % 3 else "update", 0 if s % 2 else s % 11, "BUY", 90.0 + s % 4, 1 + s % 5) for s in range(1, 400)]
    df = messages_frame(spark, rng.sample(messages, len(messages))).withColumn(book.AT, F.col("seq_num"))
    ranges = plan_ranges(df, book.AT, ["order_id"], rows_per_range=40)
    assert ranges.is_split and len(ranges.hot_keys) == 1
    whole = SeqRanges(key_cols=("order_id",))
    cut, plain = (sorted(map(repr, book.level_moves(df, (), r).collect())) for r in (ranges, whole))
    assert cut == plain


def plain_depth(messages, depth):
    """The best levels of both sides after each message, from a plain book."""
    orders, dead, out = {}, set(), {}
    for seq, action, order, side, price, qty in messages:
        if order is not None and order not in dead:
            if action in ("add", "update"):
                orders[order] = [side, price, qty]
            elif action == "trade" and order in orders:
                orders[order][2] = max(0, orders[order][2] - qty)
            elif action == "delete":
                dead.add(order)
                orders.pop(order, None)
        sides = []
        for s, sign in (("BUY", -1), ("SELL", 1)):
            levels = {}
            for of, p, q in orders.values():
                if of == s and p is not None and q > 0:
                    levels[p] = levels.get(p, 0) + q
            best = sorted(levels.items(), key=lambda x: sign * x[0])[:depth]
            sides.append(best + [(None, None)] * (depth - len(best)))
        if sides[0][0][0] and sides[1][0][0]:
            out[seq] = sides
    return out


@pytest.mark.parametrize(("rows_per_range", "chunk"), [(10**6, 1 << 18), (25, 1 << 18), (25, 7)])
def test_depth(spark, monkeypatch, rows_per_range, chunk):
    real = cover.partition_quotes
    monkeypatch.setattr(book, "partition_quotes", lambda *a, **k: real(*a, chunk_rows=chunk, **k))
    messages = random_messages(random.Random(4), 260)
    df = messages_frame(spark, random.Random(5).sample(messages, 260)).cache()
    ranges = plan_ranges(df, rows_per_range=rows_per_range, min_rows=rows_per_range)
    got = {}
    for r in book.book_depth(df, 3, ranges=ranges).collect():
        got[r["seq_num"]] = [[(r[f"{s}_price_{i}"], r[f"{s}_size_{i}"]) for i in (1, 2, 3)] for s in ("bid", "ask")]
    assert got == plain_depth(messages, 3)


def test_depth_of_one_hot_seq(spark):
    messages = [(7, "add", i, "BUY" if i % 2 else "SELL", 90.0 + i % 10, 1 + i) for i in range(300)] + [(9, "delete", 1, "BUY", None, None)]
    df = messages_frame(spark, messages)
    ranges = plan_ranges(df, rows_per_range=40)
    assert ranges.hot_seqs
    cut, whole = (sorted(map(tuple, book.book_depth(df, 2, ranges=r).collect())) for r in (ranges, SeqRanges()))
    assert cut == whole and len(cut) == 301


def test_greatest_of_several():
    rng = random.Random(3)
    spans = [(a, a + rng.randint(1, 40)) for a in (rng.randrange(60) for _ in range(80))]
    start, end = (pd.Series(x).to_numpy() for x in zip(*spans))
    top = cover.top_cover(start, end, 100, 4)
    for t in range(100):
        want = sorted((i for i, (a, b) in enumerate(spans) if a <= t < b), reverse=True)[:4]
        assert top[:, t].tolist() == want + [-1] * (4 - len(want))
