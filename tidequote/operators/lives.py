"""The lives of orders: every add with the deletes and trades that follow it within a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.functions.messages import l3_messages

ENDINGS = ("delete", "trade")


def _only(actions: Sequence[str]) -> Column:
    """Rows of these actions that have a time.

    Put as a condition on ``time``, so that it stays above a watermark: every message of a
    stream then moves the watermark of both sides, whatever it is.
    """
    return F.when(F.col("action").isin(*actions), F.col("time")).isNotNull()


def order_lives(l3: DataFrame, most: str = "1 hour", key_cols: Sequence[str] = ()) -> DataFrame:
    """One row per add and delete or trade of the same order at most ``most`` later.

    An add that none follows is one row with nulls in ``ended_by``, ``ended``, ``ended_seq`` and
    ``ended_qty``. What ends an order has a greater ``seq_num`` and no earlier time; keys that are null
    match each other. Rows without a time are left out, an add without a ``seq_num`` has no followers, and an
    add that is repeated is as many rows. The join is by order, so only the messages of one order within
    ``most`` have to meet in a task. Works on a stream as well, see ``life_stream``.
    """
    messages = l3_messages(l3, key_cols)
    adds = messages.where(_only(["add"])).select(
        *key_cols, "order_id", "side", "price", "qty", F.col("time").alias("opened"), F.col("seq_num").alias("opened_seq")
    )
    ends = messages.where(_only(ENDINGS)).select(
        *[F.col(k).alias(f"_right_{k}") for k in (*key_cols, "order_id")],
        F.col("action").alias("ended_by"),
        F.col("time").alias("ended"),
        F.col("seq_num").alias("ended_seq"),
        F.col("qty").alias("ended_qty"),
    )
    on = F.col("order_id") == F.col("_right_order_id")
    for k in key_cols:
        on = on & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    on = on & (F.col("ended") >= F.col("opened")) & (F.col("ended") <= F.col("opened") + F.expr(f"interval {most}"))
    on = on & (F.col("ended_seq") > F.col("opened_seq"))
    return adds.join(ends, on, "left").drop(*[f"_right_{k}" for k in (*key_cols, "order_id")])
