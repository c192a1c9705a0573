"""Level-3 messages derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.functions.messages import GROUPS
from tidequote.operators.ranges import SeqRanges, plan_ranges
from tidequote.operators.scan import Running, scan
from tidequote.schema import BUY, L3_SCHEMA, SELL

# What each event type stands for.
ACTION = {"click": "add", "view": "add", "signup": "update", "error": "delete", "purchase": "trade"}
ADD_SIDE = {"click": BUY, "view": SELL}
MID_PRICE = 500
INSTRUMENTS = 8


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.coalesce(*[F.when(key == k, F.lit(v)) for k, v in table.items()])


def l3_from_events(events: DataFrame, ranges: SeqRanges | None = None) -> DataFrame:
    """The sixteen feed columns plus ``instrument``.

    Adds open an order of their own; every other message refers to its user's latest add.
    """
    ranges = ranges or plan_ranges(events, "event_id", ["user_id"])
    tagged = events.select("event_id", "ts", "user_id", "event_type", "value")
    add_side = _lookup(ADD_SIDE, F.col("event_type"))
    order = Running(
        "order",
        F.max,
        F.when(add_side.isNotNull(), F.struct(F.col("event_id").alias("id"), add_side.alias("side"))),
    )
    linked = scan(
        tagged, [order], ranges, "event_id", ["user_id"], moves=F.col("event_type").isin(*ADD_SIDE)
    )
    offset = F.floor("value")
    fields = {
        "order_id": F.col("order.id"),
        "side": F.col("order.side"),
        "price": F.when(F.col("order.side") == BUY, MID_PRICE - offset)
        .otherwise(MID_PRICE + offset)
        .cast("double"),
        "qty": (F.floor(F.col("value") * 10) + 1).cast("int"),
    }
    action = F.when(F.col("order").isNotNull(), _lookup(ACTION, F.col("event_type")))
    groups = [
        F.when(action == g, fields[f]).alias(f"{g}_{f}")
        for g, own in GROUPS.items()
        for f in ("order_id", *own)
    ]
    wide = linked.select(
        F.col("event_id").alias("seq_num"),
        *groups,
        F.col("ts").cast("timestamp").alias("time"),
        (F.col("user_id") % INSTRUMENTS).alias("instrument"),
    )
    return wide.select(*L3_SCHEMA.names, "instrument")
